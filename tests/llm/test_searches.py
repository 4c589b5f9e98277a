"""Hard negatives, lexical search and SimHash groups against brute force."""

import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cadastra.llm import hard_negatives, lexical, simhash
from cadastra.llm.common import buffers

MOST = (1 << 63) - 1
NAN = float("nan")


# --- hard negatives


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "s", 0.5) for r in rows], "vec_id long, embedding array<double>, label int, anchor string, place double")


def mined(rows, every=10, low=80):
    clean = [
        (i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v])
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for anchor in sorted({r[0] for r in clean if r[0] % every == 0}):
        _, label, v = min(r for r in clean if r[0] == anchor)
        others = [
            (-max(-MOST, min(MOST, sum(x * y for x, y in zip(v, w, strict=True)))), i, k == label)
            for i, k, w in clean if i != anchor and len(w) == len(v)
        ]
        for p, positive, _ in sorted(r for r in others if r[2])[:5]:
            fits = sorted(r for r in others if not r[2] and low * -p <= 100 * -r[0] <= 100 * -p)[:5]
            out += [(anchor, positive, n + 1, i, -p, -s) for n, (s, i, _) in enumerate(fits)]
    return sorted(out)


def negatives(spark, rows, every=10):
    found = hard_negatives.mine(hard_negatives.usable(vectors(spark, rows)), F.col("vec_id") % every == 0)
    assert [c for c, _ in found.dtypes] == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("scale", [1.0, 3e4, 1e9, 1e18])
def test_products_are_exact(scale):
    rng = np.random.default_rng(3)
    a, c = np.floor(rng.normal(size=(6, 9)) * scale), np.floor(rng.normal(size=(53, 9)) * scale)
    want = [[max(-MOST, min(MOST, sum(int(x) * int(y) for x, y in zip(p, q, strict=True)))) for q in c] for p in a]
    assert hard_negatives.products(a, c).tolist() == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-(1 << 45), 1 << 45), min_size=3, max_size=3), min_size=2, max_size=12))
def test_products_of_any_integers(rows):
    x = np.array(rows, np.float64)
    want = [[max(-MOST, min(MOST, sum(int(p) * int(q) for p, q in zip(a, b, strict=True)))) for b in x] for a in x]
    assert hard_negatives.products(x, x).tolist() == want


def test_hard_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (v / np.linalg.norm(v)).tolist(), int(rng.integers(0, 4))) for i, v in enumerate(rng.normal(size=(240, 6)) + 1)]
    rows += [(1000 + i, rows[20][1], 1 + i % 2) for i in range(60)]  # one very common vector
    assert negatives(spark, rows) == mined(rows)


def test_hard_negatives_of_odd_rows(spark):
    rows = [
        (10, [1.0, 0.5], 1), (11, [1.0, 0.5], 1), (12, [1.0, 0.5], 2), (12, [1.0, 0.5], 2), (13, None, 1), (14, [NAN, 1.0], 1), (15, [None, 1.0], 1),
        (16, [float("inf"), 1.0], 2), (17, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (18, [0.9, 0.5], 2), (19, [1.0, 2.0, 3.0], 2), (20, [], 1), (22, [], 1), (23, [], 2),
        (30, [-1.0, -1.0], 1), (31, [1.0, 1.0], 1), (32, [1e20, 0.0], 1), (33, [9e19, 1.0], 2), (40, [0.0, 0.0], 3), (41, [5.0, 5.0], 3),
    ]
    assert negatives(spark, rows) == mined(rows)
    assert negatives(spark, rows, every=1) == mined(rows, every=1)
    assert negatives(spark, []) == [] and negatives(spark, rows[:1]) == []
    assert negatives(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []  # no anchors


def test_anchor_blocks_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, v.tolist(), int(rng.integers(0, 3))) for i, v in enumerate(rng.normal(size=(90, 4)))]
    want = negatives(spark, rows)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", 100)
    assert negatives(spark, rows) == want == mined(rows)


# --- lexical search

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def ranked(docs, items, k=10):
    texts = [(i, words(t)) for i, t in docs]
    texts = [(i, w) for i, w in texts if w]
    count, total = len(texts), sum(len(w) for _, w in texts)
    out = []
    for item in sorted({i for i, _ in items}):
        terms = {t for i, text in items if i == item for t in words(text)}
        scores = []
        for i, w in texts:
            m = 100 - 90 + 90 * len(w) * count // total
            score = 0
            for t in terms & set(w):
                df, tf = sum(t in set(x) for _, x in texts), w.count(t)
                score += math.floor(1000 * math.log((2 * count + 2) / (2 * df + 1))) * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, n + 1, i, -s) for n, (s, _, i) in enumerate(sorted(scores, key=lambda x: x[:2] + ((x[2] or 0),))[:k])]
    return out


def searched(spark, docs, items):
    table = spark.createDataFrame([(i, t, 7, "x") for i, t in docs], "doc_id long, text string, n long, terms string")
    queries = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, rank int")
    found = lexical.search(table, queries)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return [tuple(r) for r in found.orderBy("item_id", "rank").collect()]


def prose(seed, count, vocabulary=120):
    rng = random.Random(seed)
    names = [f"w{k}" for k in range(vocabulary)]
    return [(i, " ".join(rng.choices(names, [1 / (k + 1) for k in range(vocabulary)], k=rng.choice([1, 5, 30, 200])))) for i in range(count)]


def test_lexical_search_equals_brute_force(spark):
    docs = prose(1, 300)
    docs += [(1000 + i, docs[17][1]) for i in range(40)]  # ties
    items = [(i, t) for i, t in prose(2, 25)] + [(90, docs[17][1] + " Absent, W3!")]
    assert searched(spark, docs, items) == ranked(docs, items)


def test_lexical_search_of_odd_rows(spark, odd_rows):
    docs = [*odd_rows, (20, "ONE two-two 12345"), (21, "ünïcode\x00stop 🙂"), (22, "ÜNÏCODE half½half"), (9, "one")]
    items = [(1, None), (2, ""), (3, "  .,"), (4, "one one TWO"), (5, "Ünïcode 🙂 don"), (6, "word1x1 word5x5"), (6, "12345"), (7, "a" * 5_000), (8, "ünïcode")]
    got = searched(spark, docs, items)
    assert [r for r in got if r[0] != 6] == [r for r in ranked(docs, items) if r[0] != 6]
    assert {r[2] for r in got if r[0] == 6} == {6, 8, 20}
    assert searched(spark, [], items) == [] and searched(spark, docs, []) == [] and searched(spark, [(1, ""), (2, None)], items) == []


def test_query_blocks_change_nothing(spark, monkeypatch):
    docs, items = prose(3, 80), prose(4, 12)
    want = searched(spark, docs, items)
    monkeypatch.setattr(lexical, "QUERY_BYTES", 200)
    monkeypatch.setattr(lexical, "TREE_CELLS", 300)
    assert searched(spark, docs, items) == want == ranked(docs, items)


def test_bounds_hold_and_leaves_are_skipped():
    rng = np.random.default_rng(8)
    topics = [rng.choice(400, 30, replace=False) for _ in range(8)]
    rows = [np.unique(rng.choice(topics[i % 8], 12)) for i in range(2_000)]
    ptr = np.cumsum([0, *map(len, rows)])
    terms, values = np.concatenate(rows), rng.integers(1, 1_000_000, ptr[-1])
    tree = lexical.BallTree(ptr, terms, values, 400)
    skipped = 0
    for topic in topics:
        wanted, weights = np.sort(topic[:10]), rng.integers(1, 9_000, 10)
        q = np.zeros(400, np.int64)
        q[wanted] = weights
        scores = np.array([int((q[r] * values[a:b]).sum()) for r, a, b in zip(rows, ptr[:-1], ptr[1:], strict=True)])
        for (low, high), bound in zip(tree.span, tree.bounds(wanted, weights.astype(float)), strict=True):
            assert scores[tree.rows[low:high]].max() <= bound
        best = lexical.Best(1, 10)
        best.ids = list(range(2_000))
        opened = tree.search(wanted, weights, np.zeros(400, np.int64), best, 0)
        assert [(-s, i) for s, _, i in best.kept[0]] == [(int(scores[i]), i) for i in np.lexsort((np.arange(2_000), -scores))[:10]]
        skipped += sum(c[0] < 0 for c in tree.children) - opened
    assert skipped > 0


def test_lengths_don_t_overflow():
    n = np.array([10**8, 7], np.int64)
    assert lexical.lengths(n, 10**11, 10**13).tolist() == [10 + 90 * x * 10**11 // 10**13 for x in (10**8, 7)]


# --- SimHash


def fingerprint(text):
    w = (text or "").encode().lower().split()
    runs = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def grouped(rows):
    prints = [(i, fingerprint(t)) for i, t in rows]
    part = list(range(len(prints)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for x, y in itertools.combinations(range(len(prints)), 2):
        if (prints[x][1] ^ prints[y][1]).bit_count() <= 3:
            part[root(x)] = root(y)
    least = {}
    for x, (i, _) in enumerate(prints):
        if i is not None:
            least[root(x)] = min(i, least.get(root(x), i))
    return sorted(((i, f"{f:016x}", least.get(root(x))) for x, (i, f) in enumerate(prints)), key=repr)


def test_fingerprints_by_definition():
    texts = ["A b C d", "", "one", "one Two", " x  y\tz\n", None, "é É ß straße q", "a" * 10, "lorem ipsum dolor " * 400, "\x0b\x0c", "x\x1cy z"]
    values, owner = simhash.shingle_hashes(*buffers(pa.array(texts)))
    assert simhash.majority(values, owner, len(texts)).tolist() == [fingerprint(t) for t in texts]


def test_golay_code_is_perfect():
    code = simhash.Golay()
    words_ = np.arange(1 << 23, dtype=np.int64)
    errors = code.nearest[code.syndrome(words_)]
    assert len(np.unique(code.nearest)) == 2048 and (code.syndrome(words_ ^ errors) == 0).all()
    assert (np.bincount((words_ ^ errors) >> 11) == 2048).all()


def test_keys_meet_at_three_bits():
    rng = np.random.default_rng(1)
    code = simhash.Golay()
    f = rng.integers(0, 2**63, 4_000).astype(np.uint64)
    g = f.copy()
    for k in range(len(g)):
        for bit in rng.choice(64, k % 4, replace=False):
            g[k] ^= np.uint64(1 << int(bit))
    key, row, asks = simhash.keys_of(f, code)
    other, at, _ = simhash.keys_of(g, code)
    met = set(zip(key[asks].tolist(), row[asks].tolist(), strict=True)) & set(zip(other.tolist(), at.tolist(), strict=True))
    assert {x[1] for x in met} == set(range(len(f)))


def test_simhash_groups_equal_brute_force(spark, make_docs, odd_rows):
    rng = random.Random(4)
    base = [f"w{rng.randrange(500)}" for _ in range(400)]
    rows = list(odd_rows)
    for k in range(60):
        text = list(base)
        for _ in range(k % 6):
            text[rng.randrange(400)] = f"n{rng.randrange(500)}"
        rows.append((100 + k, " ".join(text)))
    rows += [(200 + i, t) for i, t in prose(9, 60)] + [(7, "another text under seven")]
    got = simhash.groups(make_docs(rows))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == grouped(rows)
    assert simhash.groups(make_docs([])).count() == 0


def components_of(values):
    part = {v: v for v in values}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for x, y in itertools.combinations(values, 2):
        if (x ^ y).bit_count() <= 3:
            part[root(x)] = root(y)
    return {frozenset(v for v in values if root(v) == r) for r in {root(v) for v in values}}


@pytest.mark.parametrize("heavy", [0, 3, 64])
def test_full_buckets_lose_no_link(spark, monkeypatch, heavy):
    """Dense clusters with bridges of three bits, whatever the bucket size from which fingerprints meet at words."""
    rng = random.Random(heavy)
    values = set()
    for _ in range(6):
        centre = rng.getrandbits(63)
        values |= {centre ^ sum(1 << b for b in rng.sample(range(63), rng.choice([0, 1, 2, 3, 4, 6]))) for _ in range(40)}
        far = centre
        for _ in range(5):  # a chain of steps of three bits
            far ^= sum(1 << b for b in rng.sample(range(63), 3))
            values.add(far)
    monkeypatch.setattr(simhash, "HEAVY", heavy)
    pairs = [tuple(r) for r in simhash.links(spark.createDataFrame([(v,) for v in sorted(values)], "f long")).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
    part = {v: {v} for v in values}
    for a, b in pairs:
        if part[a] is not part[b]:
            part[a] |= part[b]
            for v in part[b]:
                part[v] = part[a]
    assert {frozenset(s) for s in part.values()} == components_of(values)
