"""Equi-join enrichments: raster values at points and property records by key or address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions.geometry import all_of
from cadastra.functions.text import address_key, trigrams
from cadastra.operators.skew import ROWS_PER_SPLIT, salted, salted_join
from cadastra.operators.steps import stored


def sample_raster(
    points: DataFrame,
    pixels: DataFrame,
    x: str,
    y: str,
    key: list[str],
    origin: tuple[float, float],
    pixel: tuple[float, float],
) -> DataFrame:
    """Add the value of the raster pixel under each point; points outside the raster get null.

    `pixels` has one row per (row, col) with a value; `origin` is the upper-left corner of the raster.
    """
    located = points.withColumns({
        "col": F.floor((F.col(x) - origin[0]) / F.lit(pixel[0])),
        "row": F.floor((F.lit(origin[1]) - F.col(y)) / F.lit(pixel[1])),
    })
    values = pixels.select(F.col("row").cast("bigint"), F.col("col").cast("bigint"), "value")
    return salted_join(located, values, ["row", "col"], key, "left")


def match_properties(
    parcels: DataFrame,
    properties: DataFrame,
    key: list[str],
    parcel_id: str = "parcel_id",
    parcel_address: str = "parcel_address",
) -> DataFrame:
    """Add property_id and match_kind ('id', 'address' or null) from a property table.

    `properties` has property_id, parcel_ref and address. A parcel is matched by its id, else by its normalized address.
    Where several properties share an id or an address the lowest property_id is taken and `candidates` says how many
    there were, so a popular address does not multiply rows.
    """
    def reduced(name: str, column, suffix: str) -> DataFrame:
        return (
            properties.select(column.alias(name), "property_id")
            .where(F.col(name).isNotNull())
            .groupBy(name)
            .agg(F.min("property_id").alias(f"_property_{suffix}"), F.count("*").alias(f"_n_{suffix}"))
        )

    by_id = reduced("_ref", F.col("parcel_ref"), "id")
    by_address = reduced("_address", address_key(F.col("address")), "address")
    rows = parcels.withColumn("_ref", F.col(parcel_id)).withColumn("_address", address_key(F.col(parcel_address)))
    matched = salted_join(
        salted_join(rows, by_id, ["_ref"], key, "left"), by_address, ["_address"], key, "left"
    )
    has_id, has_address = F.col("_property_id").isNotNull(), F.col("_property_address").isNotNull()
    return matched.select(
        *parcels.columns,
        F.coalesce("_property_id", "_property_address").alias("property_id"),
        F.when(has_id, "id").when(has_address, "address").alias("match_kind"),
        F.when(has_id, F.col("_n_id")).when(has_address, F.col("_n_address")).alias("candidates"),
    )


def _packed(gram: Column) -> Column:
    """Three characters as one number: 21 bits hold any code point."""
    codes = [F.ascii(F.substring(gram, k, 1)).cast("long") for k in (1, 2, 3)]
    return codes[0] * F.lit(1 << 42) + codes[1] * F.lit(1 << 21) + codes[2]


def _ranked_grams(texts: DataFrame, frequency: DataFrame, key: list[str]) -> DataFrame:
    """The trigrams of each text, rarest first."""
    grams = texts.select(*key, F.explode("grams").alias("gram")).join(frequency, "gram")
    ordered = F.sort_array(F.collect_list(F.struct("df", "gram")))
    return grams.groupBy(*key).agg(F.transform(ordered, lambda g: g["gram"]).alias("grams"))


def similar_texts(
    left: DataFrame, right: DataFrame, percent: int, block: list[str], rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """Pairs of texts in the same block that share at least `percent` of all their trigrams.

    Both sides have `text` and the block columns, each combination once, which are written to the shared folder with their trigrams; the result has the block columns, text, other and
    similarity. Two such texts have a common trigram among their first n - ceil(percent * n / 100) + 1, in any one order
    of all trigrams; with the rarest first few texts meet there. Sizes and places rule out further pairs, and a pair is
    tried only at its first common trigram. Blocks with a null meet nothing. Trigrams that many texts of the left side
    have among their first are salted.
    """
    def prepared(df: DataFrame) -> DataFrame:
        known = df.where(all_of([F.col(c).isNotNull() for c in [*block, "text"]]))
        grams = F.transform(trigrams(F.col("text")), _packed)
        return known.select(*block, "text", grams.alias("grams")).where(F.size("grams") > 0)

    a, b = stored(prepared(left)), stored(prepared(right))
    frequency = a.unionAll(b).select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("df"))

    def prefixed(df: DataFrame, names: dict[str, str]) -> DataFrame:
        n = F.size("grams")
        length = n - F.ceil(F.lit(percent) * n / 100).cast("int") + 1
        ranked = _ranked_grams(df, frequency, [*block, "text"])
        first = ranked.withColumn("_first", F.slice("grams", F.lit(1), length))
        rows = first.select(*block, "text", "grams", "_first", F.posexplode("_first").alias("_at", "gram"))
        return stored(rows.withColumnsRenamed(names))

    lefts = prefixed(a, {"grams": "_a", "_first": "_first_a", "_at": "_at_a"})
    rights = prefixed(b, {"text": "other", "grams": "_b", "_first": "_first_b", "_at": "_at_b"})
    met = salted(lefts, rights, [*block, "gram"], ["text"], "inner", rows_per_split)
    na, nb = F.size("_a"), F.size("_b")
    fits = (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (
        # what can still be shared from these places on
        (F.least(na - F.col("_at_a"), nb - F.col("_at_b")) * (100 + percent)) >= (na + nb) * percent
    )
    once = F.get(F.array_intersect("_first_a", "_first_b"), F.lit(0)) == F.col("gram")
    shared = F.size(F.array_intersect("_a", "_b"))
    pairs = met.where(fits & once).withColumn("_shared", shared).withColumn("_all", na + nb - F.col("_shared"))
    near = pairs.where(F.col("_shared") * 100 >= F.col("_all") * percent)
    return near.select(*block, "text", "other", (F.col("_shared") / F.col("_all")).alias("similarity"))


def match_properties_fuzzy(
    parcels: DataFrame,
    properties: DataFrame,
    key: list[str],
    parcel_id: str = "parcel_id",
    parcel_address: str = "parcel_address",
    percent: int = 60,
    block: tuple[str, ...] = (),
) -> DataFrame:
    """As `match_properties`, and for parcels without a match the property whose address is most alike.

    Addresses of the same `block` (columns of both tables, such as county or postal code) are alike when they share
    `percent` of their trigrams; the most similar wins, then the lowest property_id. `match_kind` is 'similar' there, and
    `similarity` says how much; it is null for other kinds. `candidates` counts the properties that are as similar. Each address
    is compared once, however many parcels or properties have it.
    """
    matched = match_properties(parcels, properties, key, parcel_id, parcel_address).withColumn("similarity", F.lit(None).cast("double"))
    names = list(block)
    if not names:  # one block for everything
        found = match_properties_fuzzy(
            parcels.withColumn("_everywhere", F.lit(0)), properties.withColumn("_everywhere", F.lit(0)), key, parcel_id, parcel_address, percent, ("_everywhere",)
        )
        return found.drop("_everywhere")
    matched = stored(matched)
    rest = matched.where(F.col("match_kind").isNull())
    asked = rest.select(*names, address_key(F.col(parcel_address)).alias("text")).distinct()
    known = (
        properties.select(*names, address_key(F.col("address")).alias("text"), "property_id")
        .where(F.col("text").isNotNull())
        .groupBy(*names, "text")
        .agg(F.min("property_id").alias("_id"), F.count("*").alias("_n"))
    )
    known = stored(known)
    pairs = similar_texts(asked, known.select(*names, "text"), percent, names)
    offered = pairs.join(known.withColumnRenamed("text", "other"), [*names, "other"])
    ranked = offered.groupBy(*names, "text", "similarity").agg(F.min("_id").alias("_id"), F.sum("_n").alias("_n"))
    best = ranked.groupBy(*names, "text").agg(F.max_by(F.struct("_id", "_n", "similarity"), "similarity").alias("_best"))
    located = rest.drop("property_id", "match_kind", "candidates", "similarity").withColumn("_address", address_key(F.col(parcel_address)))
    joined = salted_join(located, best.withColumnRenamed("text", "_address"), [*names, "_address"], key, "left")
    similar = joined.select(
        *parcels.columns, F.col("_best._id").alias("property_id"), F.when(F.col("_best").isNotNull(), "similar").alias("match_kind"),
        F.col("_best._n").alias("candidates"), F.col("_best.similarity").alias("similarity"),
    )
    return matched.where(F.col("match_kind").isNotNull()).unionByName(similar)
