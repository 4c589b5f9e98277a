"""Operators on texts against brute-force versions of them."""

import collections
import hashlib
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from cadastra.llm import byte_bpe, line_dedup, minhash, packing, quality, substring_dedup, token_files, toxicity
from cadastra.llm.common import buffers, components, hot_keys, spread_join, table, written
from cadastra.llm.elias_fano import EliasFano
from cadastra.llm.pieces import PieceEncoder

WORD, BYTE, RANKS = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken"))
FRAGMENTS = [
    "a", "B", "é", "ß", " ", "  ", "\n", "\n ", "\t", "\r\n", "'s", "'", "'ll", "'re", "'v", "1", "23", ".", "!!", "don't", "<|endoftext|>", "<|ENDOFTEXT|>",
    "|", "　", "\xa0", "\x1c", "J̌", "İ", "中", "🙂", "½", "the", "word", " word", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
]
TEXTS = st.lists(st.lists(st.sampled_from(FRAGMENTS), max_size=25).map("".join), min_size=1, max_size=20)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def given_docs(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in rows}


def tiktoken_encoding():
    merger = byte_bpe.codec(RANKS).merger
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merger.ranks, special_tokens={})


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=60, deadline=None)
@given(texts=TEXTS)
def test_pieces_give_the_ids_of_whole_texts(path, texts):
    own = _CACHE.setdefault(path, (PieceEncoder(path), Tokenizer.from_file(path)))
    ids, at = own[0].encode(*buffers(pa.array(texts)))
    want = [e.ids for e in own[1].encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want


_CACHE: dict = {}


def test_ids_above_16_bits(tmp_path):
    chars = [*PieceEncoder(BYTE).chars.values()]
    vocabulary = {c: k for k, c in enumerate([*chars, *(f"filler{k}" for k in range(70_000)), "on", "one", "Ġone"])}
    large = Tokenizer(models.BPE(vocab=vocabulary, merges=[("o", "n"), ("on", "e"), ("Ġ", "one")]))
    large.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    large.save(str(tmp_path / "large.json"))
    texts = ["one one two", "", "one"]
    ids, at = PieceEncoder(str(tmp_path / "large.json")).encode(*buffers(pa.array(texts)))
    want = [e.ids for e in large.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want and max(want[0]) > 1 << 16


@settings(max_examples=80, deadline=None)
@given(texts=TEXTS)
def test_ranks_give_the_ids_of_tiktoken(texts):
    codec, library = byte_bpe.codec(RANKS), _CACHE.setdefault("tiktoken", tiktoken_encoding())
    data, offsets = buffers(pa.array(texts))
    ids, at = codec.encode(data, offsets)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [library.encode_ordinary(t) for t in texts]
    assert codec.merger.decode(ids).tobytes() == data.tobytes()


def test_byte_bpe_round_trip(spark, sf_dir, make_docs, odd_rows):
    library = tiktoken_encoding()
    for docs, texts in ((table(spark, sf_dir, "documents"), list(given_docs(spark, sf_dir).items())), (make_docs(odd_rows), odd_rows)):
        want = []
        for doc, text in texts:
            ids = library.encode_ordinary(text or "")
            digest = hashlib.sha256((text or "").encode()).hexdigest()
            want.append((doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), digest))
        assert sorted(map(tuple, byte_bpe.digests(docs, RANKS).collect()), key=repr) == sorted(want, key=repr)
    full = byte_bpe.round_trip(make_docs(odd_rows), RANKS).collect()
    assert all(len(r["ids"]) == r["n_tokens"] for r in full) and {bytes(r["decoded"]).decode() for r in full} == {t or "" for _, t in odd_rows}
    assert byte_bpe.digests(make_docs([]), RANKS).count() == 0


@settings(max_examples=100, deadline=None)
@given(gaps=st.lists(st.integers(0, 5_000), max_size=300))
def test_elias_fano(gaps):
    values = np.cumsum(gaps).astype(np.int64)
    coded = EliasFano.encode(values)
    assert coded.all().tolist() == values.tolist() if gaps else coded.n == 0
    assert [coded.select(k) for k in range(len(values))] == values.tolist()
    with pytest.raises(IndexError):
        coded.select(len(values))


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(0, 2_000, 100_000))
    coded = EliasFano.encode(values)
    assert len(coded.low) + len(coded.high) + len(coded.samples) < 2 * len(values)  # 8 bytes each in a table


def test_token_files(spark, sf_dir, make_docs, odd_rows):
    library = Tokenizer.from_file(WORD)
    given_texts = list(given_docs(spark, sf_dir).items())
    for docs, texts in ((table(spark, sf_dir, "documents"), given_texts), (make_docs(odd_rows), odd_rows)):
        files = written(token_files.blocks(docs, WORD))
        start, want = 0, []
        for doc, text in sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
            ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
            want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
        got = sorted(map(tuple, token_files.read(files).collect()), key=lambda r: r[1])
        assert got == want
        row = files.orderBy("part", "block").first().asDict()
        assert len(token_files.document(row, 0)) == want[0][2]
    assert token_files.read(written(token_files.blocks(make_docs([]), WORD))).count() == 0


def test_packing_of_documents(spark, sf_dir, make_docs, odd_rows):
    library = Tokenizer.from_file(BYTE)
    for docs, texts in ((table(spark, sf_dir, "documents"), list(given_docs(spark, sf_dir).items())), (make_docs(odd_rows), odd_rows)):
        rows = packing.pack(written(packing.cut(docs, BYTE))).collect()
        have = collections.Counter()
        for doc, text in texts:
            ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
            first = len(ids) % 1024 or 1024
            for piece, a in enumerate([0, *range(first, len(ids), 1024)]):
                b = first if a == 0 else a + 1024
                have[doc, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
        assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == have
        bins = collections.defaultdict(list)
        for r in rows:
            bins[r["sequence_id"]].append((r["offset"], r["length"]))
        for content in bins.values():
            at = 0
            for offset, length in sorted(content):
                assert offset == at
                at += length
            assert at <= 1024
        assert len(bins) <= 1.03 * -(-sum(r["length"] for r in rows) // 1024) + 1
    assert packing.pack(written(packing.cut(make_docs([]), BYTE))).count() == 0


@settings(max_examples=60, deadline=None)
@given(lengths=st.lists(st.integers(1, 64), max_size=200))
def test_packing_plan_is_complete(lengths):
    histogram = dict(collections.Counter(lengths))
    groups = packing.plan(histogram, 64)
    total = collections.Counter()
    for count, content in groups:
        assert count > 0 and sum(x * n for x, n in content.items()) <= 64
        for x, n in content.items():
            total[x] += count * n
    assert dict(total) == histogram


def test_packing_plan_of_many_pieces_is_tight():
    rng = np.random.default_rng(3)
    histogram = {int(x): int(n) * 1_000_000 for x, n in zip(range(1, 1025), rng.integers(1, 50, 1024))}
    bound = sum(x * n for x, n in histogram.items()) / 1024
    assert sum(c for c, _ in packing.plan(histogram)) <= 1.01 * bound


def brute_lines(texts):
    keys = collections.defaultdict(set)

    def key(line):
        value = line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
        return value if len(value) >= 20 else None

    for doc, text in texts:
        if doc is not None:
            for line in (text or "").split("\n"):
                keys[key(line)].add(doc)
    for doc, text in texts:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or key(x) is None or len(keys[key(x)]) < 3 or max(keys[key(x)]) == doc]
        yield doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()


def test_line_dedup(spark, sf_dir, make_docs, odd_rows):
    shared = "  This LINE is long enough to count \r"
    rows = [
        *odd_rows, (20, f"{shared}\nb"), (21, f"a\n{shared.strip()}\n{shared}"), (22, shared.lower()), (23, f"{shared}\n\n"), (24, "x\x1c" * 10 + "\n" + "é" * 19),
        (25, "x\x1c" * 10), (26, "x\x1c" * 10), (27, "é" * 19), (28, "é" * 19), (29, "é" * 20), (30, "é" * 20), (31, "É" * 20), (32, "é" * 20),
    ]
    for docs, texts in ((table(spark, sf_dir, "documents"), list(given_docs(spark, sf_dir).items())), (make_docs(rows), rows)):
        assert sorted(map(tuple, line_dedup.digests(docs).collect()), key=repr) == sorted(brute_lines(texts), key=repr)
    out = line_dedup.drop_lines(make_docs(rows))
    assert out.columns == make_docs(rows).columns and out.count() == len(rows)
    assert line_dedup.digests(make_docs([])).count() == 0


def brute_groups(texts, size, percent):
    sets = {}
    for doc, text in texts:
        w = words(text)
        sets[doc] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    docs = sorted(d for d in sets if sets[d])
    for k, a in enumerate(docs):
        for b in docs[k + 1 :]:
            p, q = sets[a], sets[b]
            if 100 * min(len(p), len(q)) >= percent * max(len(p), len(q)):
                both = len(p & q)
                if 100 * both >= percent * (len(p) + len(q) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def test_minhash_groups(spark, sf_dir, make_docs, odd_rows):
    base = [f"w{k}" for k in range(120)]
    near = [(100 + j, " ".join([*base[: 20 + j], f"x{j}", *base[21 + j :]])) for j in range(60)]  # one word changed in each
    rows = [r for r in [*odd_rows, *near, (200, "ONE\ttwo"), (201, "one  two three"), (202, "two one")] if r[0] is not None]
    for docs, texts, what in (
        (table(spark, sf_dir, "documents"), list(given_docs(spark, sf_dir).items()), minhash.Near(size=3, percent=85)),
        (make_docs(rows), rows, minhash.Near(size=3, percent=85)), (make_docs(rows), rows, minhash.Near()),
    ):
        want = brute_groups(texts, what.size, what.percent)
        got = minhash.groups(docs, what).collect()
        assert collections.Counter(r["doc_id"] for r in got) == collections.Counter(d for d, _ in texts)
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert minhash.groups(make_docs([])).count() == 0 and minhash.groups(make_docs([(1, None), (None, "x")])).count() == 1


def test_minhash_groups_of_copies_edited_from_one_text(spark, make_docs, monkeypatch):
    rng = np.random.default_rng(11)
    master = [f"m{k}" for k in range(300)]
    rows = [(9_999, " ".join(master))]
    for j in range(160):  # each is near the master, no two are near each other
        at = set((rng.choice(42, 7, replace=False) * 7 + 3).tolist())
        rows.append((j, " ".join(f"e{j}x{k}" if k in at else w for k, w in enumerate(master))))
    what = minhash.Near(size=3, percent=85)
    want = brute_groups(rows, what.size, what.percent)
    assert {c for _, c in want.values()} == {0}
    for members in (10,):
        monkeypatch.setattr(minhash, "BLOCK_MEMBERS", members, raising=False)
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.groups(make_docs(rows), what).collect()} == want


def test_minhash_end_alone_finds_all_links(spark, make_docs):
    rng = np.random.default_rng(12)
    rows = []
    for family in range(4):
        base = [f"f{family}w{k}" for k in range(80 + 20 * family)]
        for j in range(40):  # chains: each text is near the last one and drifts away from the first
            at = int(rng.integers(0, len(base) - 1))
            base = [*base[:at], f"f{family}n{j}", *base[at + int(rng.integers(0, 2)) :]]
            rows.append((int(rng.integers(0, 1 << 40)), " ".join(base)))
    what = minhash.Near(size=3, percent=85, rounds=1)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.groups(make_docs(rows), what).collect()} == brute_groups(rows, 3, 85)


def test_minhash_pairs_of_a_template_grow_with_its_members(spark, make_docs, monkeypatch):
    met = []
    confirmed = minhash._confirmed
    monkeypatch.setattr(minhash, "_confirmed", lambda pairs, *rest: met.append(pairs.count()) or confirmed(pairs, *rest))
    rng = np.random.default_rng(13)
    for members in (100, 200):  # any two share about 70 % of their shingles
        texts = []
        for j in range(members):
            at = set(rng.choice(200, 10, replace=False).tolist())
            texts.append((j, " ".join(f"e{j}x{k}" if k in at else f"t{k}" for k in range(200))))
        got = minhash.groups(make_docs(texts), minhash.Near(size=3, percent=85, rounds=1)).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_groups(texts, 3, 85)
    assert met[3] <= 3 * max(met[1], 50)  # the end step: all pairs would be four times as many


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    shared, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (800, 100, 100))
    value = np.concatenate([shared, a, shared, b])
    owner = np.repeat([0, 1], 900)
    table = minhash.signatures(value, owner, 2, 252)
    assert abs((table[0] == table[1]).mean() - 0.8) < 0.1
    few = minhash.signatures(value[:3], np.zeros(3, np.int64), 2, 252)
    assert len(np.unique(few[0])) <= 3 and (few[1] == np.iinfo(np.uint64).max).all()


@settings(max_examples=60, deadline=None)
@given(values=st.lists(st.integers(0, 40), min_size=1, max_size=60), split=st.integers(0, 60), least=st.integers(1, 8))
def test_compact_windows_cover_each_passage_once(values, split, least):
    doc = (np.arange(len(values)) >= split).astype(np.int64)
    hashed = np.array(values, np.uint64) << np.uint64(40)
    left, c, right = substring_dedup.compact_windows(hashed, doc, least)
    for i in range(len(values)):
        for j in range(i + least - 1, len(values)):
            if doc[i] == doc[j]:
                centre = i + int(np.argmin(values[i : j + 1]))
                assert [int(x) for a, x, b in zip(left, c, right) if a <= i <= x <= j <= b] == [centre]


def test_repeated_passages(spark, sf_dir, make_docs, odd_rows):
    texts = given_docs(spark, sf_dir)
    passage = " ".join(f"p{k}" for k in range(60))
    edited = " ".join(f"p{k}" if k != 30 else "other" for k in range(60))
    planted = {doc: f"{' '.join(f'own{doc}x{k}' for k in range(70))}\n{p} {' '.join(f'end{doc}x{k}' for k in range(40))}" for doc, p in ((900, passage), (901, passage), (902, edited), (903, ""))}
    short = {910: " ".join(f"s{k}" for k in range(49)), 911: " ".join(f"s{k}" for k in range(49))}
    for docs, known in ((table(spark, sf_dir, "documents"), texts), (make_docs([r for r in odd_rows if r[0] != 7] + list({**planted, **short}.items())), {**planted, **short})):
        rows = substring_dedup.repeated_passages(docs).collect()
        spans = collections.defaultdict(list)
        for r in rows:
            assert r["words"] >= 50 and r["similarity"] >= 0.8 and r["source_id"] < r["doc_id"]
            spans[r["doc_id"]].append((r["start"], r["end"]))
        first = {}
        for doc in sorted(known):
            w = words(known[doc])
            at = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", known[doc].encode())]
            for k in range(len(w) - 49):
                if first.setdefault(tuple(w[k : k + 50]), doc) < doc:
                    assert all(any(a <= s and e <= b for a, b in spans[doc]) for s, e in at[k : k + 50])
    assert set(spans) == {901, 902}
    cut = {r["doc_id"]: r["text"] for r in substring_dedup.without_passages(make_docs(list(planted.items()))).collect()}
    assert cut[900] == planted[900] and cut[903] == planted[903]
    assert "p5 " not in cut[901] and "own901x69" in cut[901] and "end901x0" in cut[901] and "p29" not in cut[902]
    assert substring_dedup.repeated_passages(make_docs([])).count() == 0


def test_passages_that_the_first_document_has_in_part(spark, make_docs):
    """Later documents share more around a passage than the first one that has it."""
    whole = [f"p{k}" for k in range(140)]
    cuts = {1: (40, 91), 2: (0, 140), 3: (5, 130), 4: (0, 140), 5: (44, 98), 6: (60, 140), 7: (20, 75), 8: (41, 92)}
    rows = []
    for copy in range(8):  # other words, so other minima
        for doc, (a, b) in cuts.items():
            own = [f"own{copy}x{doc}x{k}" for k in range(60)]
            rows.append((100 * copy + doc, " ".join([*own[:30], *(f"{w}v{copy}" for w in whole[a:b]), *own[30:]])))
    spans = collections.defaultdict(list)
    for r in substring_dedup.repeated_passages(make_docs(rows)).collect():
        spans[r["doc_id"]].append((r["start"], r["end"]))
    first = {}
    for doc, text in sorted(rows):
        at = [(m.start(), m.end()) for m in re.finditer(r"\S+", text)]
        w = text.split()
        for k in range(len(w) - 49):
            if first.setdefault(tuple(w[k : k + 50]), doc) < doc:
                assert any(a <= at[k][0] and at[k + 49][1] <= b for a, b in spans[doc]), (doc, k)


def test_passages_of_repeated_ids_with_different_texts(spark, make_docs):
    passage = " ".join(f"p{k}" for k in range(70))
    shared = f"{'a ' * 40}{passage} end"
    other = "\u00e9\u4e2d" * 400  # spans of the first text would cut characters of this one
    rows = [(1, passage), (2, shared), (2, other), (2, shared), (3, None)]
    cut = [(r["doc_id"], r["text"]) for r in substring_dedup.without_passages(make_docs(rows)).collect()]
    assert cut.count((2, other)) == 1 and (1, passage) in cut and (3, None) in cut and len(cut) == 5
    assert sum(doc == 2 and "p5 " not in text and text.endswith("end") for doc, text in cut) == 2


def test_shuffle_files_go_with_the_table_that_needed_them(spark):
    def files():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for k in range(disk.size()) if (name := disk.apply(k).getName()).startswith("shuffle_")}

    earlier = files()
    counts = written(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count())
    until = time.time() + 5
    while (left := files() - earlier) and time.time() < until:
        time.sleep(0.1)
    assert not left and counts.count() == 100


def test_passages_are_the_same_in_any_number_of_turns(spark, make_docs):
    passage = [f"p{k}" for k in range(90)]
    rows = [(doc, " ".join([*(f"own{doc}x{k}" for k in range(60)), *passage[doc : doc + 70]])) for doc in range(8)] + [(9, ""), (10, None)]
    found = [sorted(map(tuple, substring_dedup.repeated_passages(make_docs(rows), substring_dedup.Passages(slices=n)).collect())) for n in (1, 4)]
    assert found[0] == found[1] and {r[0] for r in found[0]} == set(range(1, 8))


def test_passages_are_measured_before_they_are_split():
    what = substring_dedup.Passages()

    def elements(tokens):
        return substring_dedup._elements(pa.array([" ".join(tokens).encode()]), what.size)[0]

    base = [f"p{k}" for k in range(98)]
    for n in range(7, 13):  # neither half has 50 words
        longer = [*base[:49], *(f"new{k}" for k in range(n)), *base[49:]]
        for left, right in ((longer, base), (base, longer)):
            around = [*(f"x{k}" for k in range(30)), *left, *(f"y{k}" for k in range(30))]
            ((start, end, count, *_, similarity),) = substring_dedup._verified(elements(around), elements(right), what)
            assert " ".join(around).encode()[start:end].decode().split() == left and count == len(left)
            assert similarity == pytest.approx(90 / (98 + n))
    twice = [f"p{k}" if k not in (45, 51) else f"q{k}" for k in range(98)]
    assert [r[2] for r in substring_dedup._verified(elements(twice), elements(base), what)] == [98]


def test_near_passages_that_earlier_documents_have_in_parts(spark, make_docs):
    """Two later documents are near over 70 words; no earlier document is near either of them."""
    cuts = {1: (0, 38), 2: (34, 70), 3: (12, 58), 4: (20, 60), 5: (0, 70), 6: (0, 70)}
    rows, later = [], {}
    for copy in range(8):  # other words, so other minima
        for doc, (a, b) in cuts.items():
            body = [f"p{k}v{copy}" if doc < 6 or k != 44 + copy % 5 else f"new{copy}" for k in range(a, b)]
            own = [f"own{copy}x{doc}x{k}" for k in range(60)]
            rows.append((100 * copy + doc, " ".join([*own[:30], *body, *own[30:]])))
        later[100 * copy + 6] = " ".join(body)
    found = {(r["doc_id"], r["source_id"], r["words"]): (r["start"], r["end"]) for r in substring_dedup.repeated_passages(make_docs(rows)).collect()}
    texts = dict(rows)
    for doc, body in later.items():
        start, end = found[doc, doc - 1, 70]
        assert texts[doc][start:end] == body
    assert {doc for doc, _, _ in found} == set(later)  # what the parts share is too short


def test_exact_passages_of_repeated_words_and_in_another_order(spark, make_docs):
    what = substring_dedup.Passages()

    def elements(tokens):
        return substring_dedup._elements(pa.array([" ".join(tokens).encode()]), what.size)[0]

    def own(name, n):
        return [f"{name}{k}" for k in range(n)]

    line, p, q = own("line", 8), own("p", 60), own("q", 70)
    left = [*line, *own("a", 30), *["so"] * 61, *own("b", 30)]
    right = [*own("c", 40), *line, *own("d", 200), *["so"] * 148]  # the line stands elsewhere
    (found,) = substring_dedup._verified(elements(left), elements(right), what)
    assert found[2] == 61 and " ".join(left).encode()[found[0] : found[1]].decode().split() == ["so"] * 61
    assert sorted(r[2] for r in substring_dedup._verified(elements(p + q), elements(q + p), what)) == [60, 70]
    left, right = ([*own("l", 8), *["so"] * 3000], [*own("k", 300), *own("l", 8), *own("m", 200), *["so"] * 3000])
    spans = sorted(r[:2] for r in substring_dedup._verified(elements(left), elements(right), what))
    ends = [0, *(e for _, e in spans)]
    assert spans[-1][1] == len(" ".join(left)) and all(start <= end for (start, _), end in zip(spans[1:], ends[1:], strict=False))
    docs = [(1, " ".join(right)), (2, " ".join([*own("x", 20), *["so"] * 61, *own("y", 20)]))]
    assert max(r["words"] for r in substring_dedup.repeated_passages(make_docs(docs)).collect()) == 61


def test_regions_of_a_pair_that_lie_side_by_side():
    pieces = [{"start": 10 * k + 30 * t, "end": 10 * k + 30 * t + 45, "source_start": 1000 * k + 30 * t, "source_end": 1000 * k + 30 * t + 45} for k in range(8) for t in range(10)]
    kind = pa.list_(pa.struct([(x, pa.int32()) for x in ("start", "end", "source_start", "source_end")]))
    (regions,) = substring_dedup._merged.func(pa.array([pieces], kind)).to_pylist()
    assert [(r["source_start"], r["end"] - r["start"]) for r in regions] == [(1000 * k, 315) for k in range(8)]


def held_out(doc, modulus, rest):
    return zlib.crc32(str(doc).encode()) % modulus == rest


def test_quality_on_held_out_labels(spark, make_docs, odd_rows):
    docs, labels = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    rows = {r["doc_id"]: r for r in quality.scored(docs, labels).collect()}
    want = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(r["held_out"] == held_out(d, 3, 1) and r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for d, r in rows.items())
    fresh = [d for d in want if rows[d]["held_out"]]
    assert np.mean([rows[d]["predicted"] == want[d] for d in fresh]) > 0.96
    # held-out labels have no say
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {r["doc_id"]: round(r["score"], 6) for r in quality.scored(docs, flipped).collect()} == {d: round(r["score"], 6) for d, r in rows.items()}
    odd = make_docs(odd_rows)
    assert quality.scored(odd, labels.limit(0)).select("score").distinct().collect()[0][0] == 0.5
    nulls = spark.createDataFrame([(1, None), (None, 1), (4, 1), (4, 0), (5, 0)], "doc_id long, quality int")
    assert quality.scored(odd, nulls).count() == len(odd_rows) and quality.scored(make_docs([]), labels).count() == 0
    assert quality.good(odd, labels).columns == odd.columns
    kept = {r["doc_id"] for r in quality.good(docs, labels).collect()}
    assert kept == {d for d, r in rows.items() if r["predicted"] == 1}


def test_toxicity_on_held_out_labels(spark, make_docs, odd_rows):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    rows = {r["doc_id"]: r for r in toxicity.scored(docs, labels).collect()}
    want = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    assert all(r["held_out"] == held_out(d, 5, 0) and r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for d, r in rows.items())
    fresh = [d for d in want if rows[d]["held_out"]]
    assert np.mean([rows[d]["predicted"] == want[d] for d in fresh]) > 0.97
    odd = make_docs(odd_rows)
    assert toxicity.scored(odd, labels.limit(0)).select("score").distinct().collect()[0][0] == 0.5
    nulls = spark.createDataFrame([(1, None), (None, 1), (4, 1), (4, 0), (5, 0)], "doc_id long, toxic int")
    assert toxicity.scored(odd, nulls).count() == len(odd_rows) and toxicity.scored(make_docs([]), labels).count() == 0


def test_counterfactual_penalty_frees_group_names(spark, make_docs):
    rng = np.random.default_rng(2)
    words_ = [f"w{k}" for k in range(60)]
    rows, labels = [], []
    for k in range(600):
        toxic = k % 2
        text = " ".join(rng.choice(words_, 20)) + (" awful" if toxic else " nice")
        named = rng.random() < (0.8 if toxic else 0.05)  # in these labels the name goes with attacks
        rows.append((k, text + (" immigrants" if named else "")))
        labels.append((k, toxic))
    docs = make_docs([*rows, (10_000, "immigrants"), (10_001, "refugees")])
    known = spark.createDataFrame(labels, "doc_id long, toxic int")

    table_, _ = toxicity.fit(docs, known)
    buckets = [toxicity.features(*buffers(pa.array([t])))[0] for t in ("immigrants", "refugees", "awful")]
    name, other, attack = (float(table_[b].sum()) for b in buckets)
    assert abs(name - other) < 0.35 * attack and attack > 0
    own, changed = [[0, 1], [0, 1], [2], [2, 1]] * 10, [[0, 3], [0, 3], None, [2, 3]] * 10
    y = np.array([1, 1, 0, 0] * 10)
    free, _ = toxicity.train(own, changed, y, 4, penalty=0.0)
    tied, _ = toxicity.train(own, changed, y, 4, penalty=10.0)
    assert abs(tied[1] - tied[3]) < 0.2 * abs(free[1] - free[3])
    assert np.isfinite(toxicity.train([[0], [1]], [[0], None], np.array([0, 1]), 2)[0]).all()  # a swap that changes nothing
    assert toxicity.swapped("Women and MEN met", ("women", "men")) == "men and women met"


def test_components_and_joins_with_hot_keys(spark):
    edges = [(k, k + 1) for k in range(0, 200)] + [(300, k) for k in range(301, 400)] + [(500, 500), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(201)) and all(got[k] == 300 for k in range(300, 400)) and 500 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    left = spark.createDataFrame([(1, k) for k in range(500)] + [(2, k) for k in range(5)] + [(None, 1)], "k int, x int")
    right = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "k int, y string")
    hot = hot_keys(left, ["k"], rows=50)
    assert [(r["k"], r["_parts"]) for r in hot.collect()] == [(1, 10)]
    assert spread_join(left, right, ["k"], ["x"], hot).count() == 505
