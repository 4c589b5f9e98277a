"""Small fixed lookup tables, as local relations (no Python rows shipped to executors)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# State FIPS code, name and postal abbreviation.
STATES = [
    ("01", "Alabama", "AL"), ("02", "Alaska", "AK"), ("04", "Arizona", "AZ"), ("05", "Arkansas", "AR"),
    ("06", "California", "CA"), ("08", "Colorado", "CO"), ("09", "Connecticut", "CT"), ("10", "Delaware", "DE"),
    ("11", "District of Columbia", "DC"), ("12", "Florida", "FL"), ("13", "Georgia", "GA"), ("15", "Hawaii", "HI"),
    ("16", "Idaho", "ID"), ("17", "Illinois", "IL"), ("18", "Indiana", "IN"), ("19", "Iowa", "IA"),
    ("20", "Kansas", "KS"), ("21", "Kentucky", "KY"), ("22", "Louisiana", "LA"), ("23", "Maine", "ME"),
    ("24", "Maryland", "MD"), ("25", "Massachusetts", "MA"), ("26", "Michigan", "MI"), ("27", "Minnesota", "MN"),
    ("28", "Mississippi", "MS"), ("29", "Missouri", "MO"), ("30", "Montana", "MT"), ("31", "Nebraska", "NE"),
    ("32", "Nevada", "NV"), ("33", "New Hampshire", "NH"), ("34", "New Jersey", "NJ"), ("35", "New Mexico", "NM"),
    ("36", "New York", "NY"), ("37", "North Carolina", "NC"), ("38", "North Dakota", "ND"), ("39", "Ohio", "OH"),
    ("40", "Oklahoma", "OK"), ("41", "Oregon", "OR"), ("42", "Pennsylvania", "PA"), ("44", "Rhode Island", "RI"),
    ("45", "South Carolina", "SC"), ("46", "South Dakota", "SD"), ("47", "Tennessee", "TN"), ("48", "Texas", "TX"),
    ("49", "Utah", "UT"), ("50", "Vermont", "VT"), ("51", "Virginia", "VA"), ("53", "Washington", "WA"),
    ("54", "West Virginia", "WV"), ("55", "Wisconsin", "WI"), ("56", "Wyoming", "WY"), ("60", "American Samoa", "AS"),
    ("66", "Guam", "GU"), ("69", "Northern Mariana Islands", "MP"), ("72", "Puerto Rico", "PR"),
    ("78", "Virgin Islands", "VI"),
]

# Bounds in degrees (xmin, ymin, xmax, ymax) of the states that have a published extract.
STATE_BOUNDS = {
    "01": (-88.47, 30.22, -84.89, 35.01),
    "04": (-114.82, 31.33, -109.04, 37.00),
    "05": (-94.62, 33.00, -89.64, 36.50),
    "06": (-124.48, 32.53, -114.13, 42.01),
    "08": (-109.06, 36.99, -102.04, 41.00),
    "09": (-73.73, 40.95, -71.79, 42.05),
    "10": (-75.79, 38.45, -75.05, 39.84),
    "11": (-77.12, 38.79, -76.91, 38.99),
    "12": (-87.63, 24.52, -80.03, 31.00),
    "13": (-85.61, 30.36, -80.84, 35.00),
    "16": (-117.24, 41.99, -111.04, 49.00),
    "17": (-91.51, 36.97, -87.50, 42.51),
    "18": (-88.10, 37.77, -84.78, 41.76),
    "19": (-96.64, 40.38, -90.14, 43.50),
    "20": (-102.05, 36.99, -94.59, 40.00),
    "21": (-89.57, 36.50, -81.96, 39.15),
    "22": (-94.04, 28.93, -88.82, 33.02),
    "24": (-79.49, 37.91, -75.05, 39.72),
    "25": (-73.51, 41.24, -69.93, 42.89),
    "26": (-90.42, 41.70, -82.41, 48.19),
    "27": (-97.24, 43.50, -89.49, 49.38),
    "29": (-95.77, 35.99, -89.10, 40.61),
    "34": (-75.56, 38.93, -73.89, 41.36),
    "36": (-79.76, 40.50, -71.86, 45.02),
    "37": (-84.32, 33.84, -75.46, 36.59),
    "39": (-84.82, 38.40, -80.52, 42.33),
    "42": (-80.52, 39.72, -74.69, 42.27),
    "47": (-90.31, 34.98, -81.65, 36.68),
    "48": (-106.65, 25.84, -93.51, 36.50),
    "51": (-83.68, 36.54, -75.24, 39.47),
    "53": (-124.85, 45.54, -116.92, 49.00),
}

WORLD = (-180.0, -90.0, 180.0, 90.0)

# Land-use categories, numbered from 1.
LAND_USE_CATEGORIES = [
    "residential", "commercial", "industrial", "agricultural", "vacant", "exempt", "mixed_use", "other",
]

# Keywords that put a free-text use description into a category; the first match wins.
LAND_USE_KEYWORDS = [
    ("mixed_use", ["mixed"]),
    ("vacant", ["vacant", "undeveloped", "unimproved"]),
    ("exempt", ["exempt", "government", "church", "school", "public"]),
    ("agricultural", ["agric", "farm", "ranch", "timber", "crop", "machinery"]),
    ("industrial", ["industr", "warehouse", "manufact", "automobile"]),
    ("commercial", ["commerc", "retail", "office", "store", "furniture"]),
    ("residential", ["resid", "dwelling", "family", "condo", "apartment", "household", "building"]),
]


def _quote(value: object) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else f"CAST({value!r} AS DOUBLE)"


def _values(spark: SparkSession, rows: Iterable[tuple], names: list[str]) -> DataFrame:
    body = ", ".join("(" + ", ".join(_quote(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")


def states(spark: SparkSession) -> DataFrame:
    """State lookup (56 rows): statefp, state_name, state_abbr."""
    return _values(spark, STATES, ["statefp", "state_name", "state_abbr"])


def state_bounds(spark: SparkSession) -> DataFrame:
    """State bounds (31 rows): statefp, xmin, ymin, xmax, ymax."""
    return _values(spark, [(k, *v) for k, v in STATE_BOUNDS.items()], ["statefp", "xmin", "ymin", "xmax", "ymax"])


def land_use_categories(spark: SparkSession) -> DataFrame:
    """Land-use categories (8 rows): category_id, category_name."""
    body = ", ".join(f"({i}, '{name}')" for i, name in enumerate(LAND_USE_CATEGORIES, 1))
    return spark.sql(f"SELECT * FROM VALUES {body} AS t(category_id, category_name)")


def bounds_of(statefp: str) -> tuple[float, float, float, float]:
    """Bounds of one state; an unknown code is an error, never the world."""
    if statefp not in STATE_BOUNDS:
        raise ValueError(f"no bounds for state {statefp!r}")
    return STATE_BOUNDS[statefp]


def land_use_category(description: Column) -> Column:
    """Category of a free-text use description; null stays null, no keyword is 'other'."""
    text = F.lower(description)
    result = F.lit("other")
    for category, words in reversed(LAND_USE_KEYWORDS):
        result = F.when(text.rlike("|".join(words)), category).otherwise(result)
    return F.when(description.isNotNull(), result)


def county_table(counties: DataFrame) -> DataFrame:
    """One row per five-digit geoid (geoid, county_name), so at most 100,000 rows: safe to broadcast."""
    return (
        counties.where(F.col("geoid").rlike("^[0-9]{5}$"))
        .groupBy("geoid")
        .agg(F.min("county_name").alias("county_name"))
    )
