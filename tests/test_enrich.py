"""Similar addresses: the join against brute force, ties, blocks and hot trigrams."""

import random

import pytest

from cadastra.operators import enrich


def grams(text):
    out = set()
    for word in "".join(c if c.isalnum() else " " for c in text.lower()).split():
        padded = f"  {word} "
        out |= {padded[i : i + 3] for i in range(len(padded) - 2)}
    return out


def similarity(a, b):
    x, y = grams(a), grams(b)
    return len(x & y), len(x | y)


def texts(seed, count):
    rng = random.Random(seed)
    names = ["peachtree", "peechtree", "main", "maine", "oak hill", "st", "street", "north"]
    return sorted({(rng.choice("ab"), f"{rng.randrange(90, 140)} {rng.choice(names)} {rng.choice(names)} {rng.randrange(12)}") for _ in range(count)})


@pytest.mark.parametrize(("percent", "rows_per_split"), [(40, 1_000_000), (60, 20), (80, 3)])
def test_similar_texts_equal_brute_force(spark, percent, rows_per_split):
    left, right = texts(1, 120), texts(2, 120)
    schema = "block string, text string"
    odd = [(None, "100 main st"), ("a", None), ("b", ""), ("b", " ,. ")]
    found = enrich.similar_texts(spark.createDataFrame(left + odd, schema), spark.createDataFrame(right + odd, schema), percent, ["block"], rows_per_split)
    got = sorted((r.block, r.text, r.other, round(r.similarity, 9)) for r in found.collect())
    want = []
    for b, x in left:
        for c, y in right:
            shared, total = similarity(x, y)
            if b == c and shared * 100 >= total * percent:
                want.append((b, x, y, round(shared / total, 9)))
    assert got == sorted(want) and want


def test_the_most_similar_property_wins_and_ties_go_by_id(spark):
    parcels = spark.createDataFrame(
        [(1, "A", "1 oak st"), (2, None, "12 peachtree st 4"), (3, None, "99 nowhere"), (4, None, None), (5, None, "12 Peachtree St. 4"), (6, None, "7 elm st")],
        "k long, parcel_id string, parcel_address string",
    )
    properties = spark.createDataFrame(
        [(50, None, "12 peechtree st 4"), (40, None, "12 peechtree st 4"), (30, None, "12 peachtre avenue"), (20, "A", "somewhere"), (60, None, "7 ELM st")],
        "property_id long, parcel_ref string, address string",
    )
    found = {r.k: (r.property_id, r.match_kind, r.candidates) for r in enrich.match_properties_fuzzy(parcels, properties, ["k"], percent=50).collect()}
    assert found == {
        1: (20, "id", 1), 2: (40, "similar", 2), 3: (None, None, None), 4: (None, None, None), 5: (40, "similar", 2), 6: (60, "address", 1),
    }
    nothing = enrich.match_properties_fuzzy(parcels, properties.where("false"), ["k"]).collect()
    assert len(nothing) == 6 and all(r.match_kind is None for r in nothing)
