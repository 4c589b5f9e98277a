"""Schemas of the raw layer and of the normalized parcel table."""

from __future__ import annotations

from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
POLYGON = T.ArrayType(T.ArrayType(POINT))
MULTIPOLYGON = T.ArrayType(POLYGON)
BOX = T.StructType([T.StructField(n, T.DoubleType()) for n in ("xmin", "ymin", "xmax", "ymax")])


def _fields(kind: T.DataType, names: str) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names.split()]


PARCEL_RAW = T.StructType(
    _fields(T.LongType(), "lrid")
    + _fields(T.StringType(), "parcelid parcelid2 geoid statefp countyfp taxacctnum")
    + _fields(T.IntegerType(), "taxyear")
    + _fields(T.StringType(), "usecode usedesc zoningcode zoningdesc")
    + _fields(T.IntegerType(), "numbldgs numunits yearbuilt numfloors bldgsqft bedrooms halfbaths fullbaths")
    + _fields(T.LongType(), "imprvalue landvalue agvalue totalvalue")
    + _fields(T.DoubleType(), "assdacres")
    + _fields(T.LongType(), "saleamt")
    + _fields(T.TimestampType(), "saledate")
    + _fields(T.StringType(), "ownername owneraddr ownercity ownerstate ownerzip")
    + _fields(T.StringType(), "parceladdr parcelcity parcelstate parcelzip")
    + _fields(T.StringType(), "legaldesc township section qtrsection range plssdesc book page block lot")
    + _fields(T.TimestampType(), "updated")
    + _fields(T.StringType(), "lrversion")
    + _fields(T.DoubleType(), "centroidx centroidy surfpointx surfpointy")
    + [T.StructField("geom", POLYGON)]
)

# Normalized column <- raw column, with the SQL type of the normalized column and, for
# text, its declared maximum length (None: unbounded or not text).
PARCEL_COLUMNS = [
    ("parcel_id_alt", "parcelid2", "string", 100),
    ("geoid", "geoid", "string", 5),
    ("tax_account_num", "taxacctnum", "string", 50),
    ("tax_year", "taxyear", "smallint", None),
    ("use_code", "usecode", "string", 20),
    ("use_description", "usedesc", "string", 255),
    ("zoning_code", "zoningcode", "string", 50),
    ("zoning_description", "zoningdesc", "string", 255),
    ("num_buildings", "numbldgs", "smallint", None),
    ("num_units", "numunits", "smallint", None),
    ("year_built", "yearbuilt", "smallint", None),
    ("num_floors", "numfloors", "smallint", None),
    ("building_sqft", "bldgsqft", "int", None),
    ("bedrooms", "bedrooms", "smallint", None),
    ("half_baths", "halfbaths", "smallint", None),
    ("full_baths", "fullbaths", "smallint", None),
    ("improvement_value", "imprvalue", "bigint", None),
    ("land_value", "landvalue", "bigint", None),
    ("agricultural_value", "agvalue", "bigint", None),
    ("total_value", "totalvalue", "bigint", None),
    ("assessed_acres", "assdacres", "decimal(10,4)", None),
    ("sale_amount", "saleamt", "bigint", None),
    ("sale_date", "saledate", "date", None),
    ("owner_name", "ownername", "string", 255),
    ("owner_address", "owneraddr", "string", 500),
    ("owner_city", "ownercity", "string", 100),
    ("owner_state", "ownerstate", "string", 50),
    ("owner_zip", "ownerzip", "string", 20),
    ("parcel_address", "parceladdr", "string", 500),
    ("parcel_city", "parcelcity", "string", 100),
    ("parcel_state", "parcelstate", "string", 50),
    ("parcel_zip", "parcelzip", "string", 20),
    ("legal_description", "legaldesc", "string", None),
    ("plss_township", "township", "string", 20),
    ("plss_section", "section", "string", 20),
    ("plss_quarter_section", "qtrsection", "string", 20),
    ("plss_range", "range", "string", 20),
    ("plss_description", "plssdesc", "string", 255),
    ("plat_book", "book", "string", 50),
    ("plat_page", "page", "string", 50),
    ("plat_block", "block", "string", 50),
    ("plat_lot", "lot", "string", 50),
    ("source_updated", "updated", "date", None),
    ("source_version", "lrversion", "string", 20),
]

# Columns of the normalized table that must not be null, with their maximum lengths.
REQUIRED = {"parcel_id": 100, "geoid": 5}

# Properties published with the two tile layers.
TILE_PROPERTIES = {
    "parcels": [
        "id", "parcel_id", "geoid", "parcel_address", "parcel_city", "parcel_state", "owner_name", "total_value",
        "year_built", "use_description", "sale_amount", "assessed_acres",
    ],
    "parcel-centroids": ["id", "parcel_id", "geoid", "total_value"],
}
