"""Exact duplicates, collocations and runs against plain versions of themselves."""

from __future__ import annotations

import hashlib
import tracemalloc
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foreledger.llm import collocations, exact, repeats
from foreledger.llm.queries import QUERIES
from foreledger.llm.sql import ORACLE
from tests.conftest import SMALL, sorted_rows
from tools.check import compare

DOCS = "doc_id long, text string, lang string"


def plain_runs(words):
    """Every maximal stretch of equal words q apart, for every q."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        t = 0
        while t < n - q:
            start = t
            while t < n - q and words[t] == words[t + q]:
                t += 1
            if t > start and t + q - start >= max(24, 3 * q):
                found.setdefault((start, t + q), q)
            t += t == start
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


word = st.sampled_from("abcd")
periodic = st.builds(
    lambda head, unit, times, cut, tail: (head + (unit * times)[: len(unit) * times - cut] + tail),
    st.lists(word, max_size=20), st.lists(word, min_size=1, max_size=30), st.integers(2, 30),
    st.integers(0, 5), st.lists(word, max_size=40),
)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(periodic, st.lists(word, max_size=60)), max_size=5))
def test_runs_of_any_texts(texts):
    assert repeats.find_runs(texts) == [plain_runs(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=2, max_size=400), st.randoms())
def test_common_extensions(seq, rnd):
    ext = repeats.Extensions(np.array(seq), v=16)
    pairs = [(i, j) for i, j in ((rnd.randrange(len(seq)), rnd.randrange(len(seq))) for _ in range(50)) if i != j]
    if not pairs:
        return
    i, j = np.array(pairs).T
    want = []
    for a, b in pairs:
        k = 0
        while max(a, b) + k < len(seq) and seq[a + k] == seq[b + k]:
            k += 1
        want.append(k)
    assert ext(i, j).tolist() == want


def test_long_text_of_one_word():
    assert repeats.find_runs([["a"] * 5000 + ["b"] + ["c", "d"] * 20]) == [[(0, 5000, 1), (5001, 40, 2)]]


def test_run_digests(spark):
    got = {r["doc_id"]: r for r in QUERIES["op13_periodic_runs"](spark, SMALL).collect()}
    rows = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()
    assert set(got) == {r["doc_id"] for r in rows}
    several = 0
    for r in rows:
        words = (r["text"] or "").encode().split()
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            a, g = (h // 10) % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        gone = {i for a, size, q in runs for i in range(a + q, a + size)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{a},{size},{q}\n" for a, size, q in runs)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        several += len(runs) > 0
        assert tuple(got[r["doc_id"]])[1:] == (
            len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
        )
    assert several > 10


number = st.integers(1, collocations.OTHER - 1)


@settings(max_examples=100, deadline=None)
@given(st.integers(2, 4).flatmap(lambda k: st.dictionaries(st.tuples(*[number] * k), st.integers(1, 10**12), min_size=1, max_size=300)), st.integers(0, 6))
def test_filters_lose_nothing(counts, prefix):
    words, n = np.array(list(counts), np.uint32), np.array(list(counts.values()))
    k = words.shape[1]
    shard = (*collocations.key_of(list(words.T)), n)
    keys, last, n = collocations.merge([shard, shard])
    back = Counter()
    parts = (keys >> np.uint64(64 - prefix)).astype(int) if prefix else np.zeros(len(keys), int)
    for part in set(parts.tolist()):
        at = parts == part
        raw = collocations.pack_filter(keys[at], last[at], n[at], prefix)
        again, fourth, m = collocations.unpack_filter(raw, prefix, part)
        back.update(dict(zip(map(tuple, collocations.words_in(again, fourth, k).tolist()), m.tolist(), strict=True)))
    assert back == Counter({w: 2 * c for w, c in counts.items()})


def test_equal_keys_of_different_phrases():
    keys, ones = np.full(6, 7, np.uint64), np.ones(6, np.int64)
    keys, last, n = collocations.merge([(keys, np.array([3, 1, 3, 2, 1, 3], np.uint64), ones)])
    assert keys.tolist() == [7] * 3 and last.tolist() == [1, 2, 3] and n.tolist() == [2, 1, 3]


def plain_phrases(rows, least):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for c in ".,;:!?\x0b\x0c\r":
            t = t.replace(c, "\n")
        for piece in t.split("\n"):
            words = tuple(w for w in piece.replace("\t", " ").split(" ") if w)
            n[lang or "und"] += len(words)
            for k in range(1, 5):
                f[lang or "und"].update(words[i : i + k] for i in range(len(words) - k + 1))
    out = []
    for lang, own in f.items():
        many = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, a in many.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    if 100 * a >= 80 * own[p[i : i + size]]:
                        covered.add(p[i : i + size])
        for p, a in many.items():
            if p not in covered:
                score, cut = min((2_000_000 * a // (own[p[:c]] + own[p[c:]]), c) for c in range(1, len(p)))
                out.append((a, cut, len(p), own[p[:cut]], lang, n[lang], " ".join(p), own[p[cut:]], score))
    return sorted(out, key=str)


def test_phrases_with_words_out_of_hand(spark):
    """Few words at hand, small filters and many ranges give the counts of the plain version."""
    texts = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()[:120]
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in texts]
    rows += [(1, None, None), (2, "A b. a B; A b", None), (3, "x\ty\vx y", "und"), (None, "é É a b", "und")] * 2
    docs = spark.createDataFrame(rows, DOCS)
    want = plain_phrases(rows, 5)
    assert len(want) > 100
    for sizes in ({}, {"at_hand": 50, "shard": 500}, {"at_hand": 3}):
        got = collocations.mined(docs, least=5, **sizes)
        assert sorted(map(tuple, got.select(*sorted(got.columns)).collect()), key=str) == want


def test_ranges_of_filters(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = sorted_rows(collocations.mined(docs))
    monkeypatch.setattr(collocations, "RANGE_TOKENS", 2000)
    assert sorted_rows(collocations.mined(docs, shard=3000)) == want


def test_exact_scores_beyond_64_bits(spark):
    big = 9 * 10**17
    rows = spark.createDataFrame([("en", "a b", 2, big)], "lang string, phrase string, k int, a long")
    words = spark.createDataFrame([("en", "a", big + 1), ("en", "b", big)], "lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", 4 * big)], "lang string, n long")
    assert collocations._scored(rows, words, totals).first()["score"] == 2_000_000 * big // (2 * big + 1)


def plain_copies(rows):
    of = defaultdict(list)
    for doc_id, text, _ in rows:
        of[text or ""].append(doc_id)
    out = []
    for text, ids in of.items():
        best = max((i for i in ids if i is not None), default=None)
        first = ids.index(best)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, best, len(ids), k == first, digest) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def test_directory_doubles_and_slots_chain(spark):
    rows = [(i, f"text {i % 700}", "en") for i in range(2000)] + [(None, "only null", None)] * 3
    rows += [(5000, "twice", "a")] * 4 + [(7, None, "x"), (8, "", "y"), (9, "A", None), (10, "a ", None)]
    docs = spark.createDataFrame(rows, DOCS)
    want = plain_copies(rows)
    index = exact.build_index(docs, capacity=20)
    held = index.directory.groupBy("bucket").agg(F.sum("n").alias("n"))
    buckets, most = held.agg(F.count("*"), F.max("n")).first()
    assert buckets > 30 and most <= 20
    assert index.directory.select("depth").distinct().count() > 1
    # hashes that collide: by length only, in few cells
    for sizes in ({}, {"capacity": 20}, {"slot": F.length(F.coalesce("text", F.lit(""))).cast("long")}, {"capacity": 1, "finer": 1}):
        assert sorted(map(tuple, exact.groups(docs, **sizes).collect()), key=str) == want
    chained = exact.build_index(docs, slot=F.lit(5).cast("long")).entries
    assert chained.agg(F.max("link"), F.count("*")).first() == (len({r[1] or "" for r in rows}),) * 2


def test_hot_texts_are_found_too(spark, monkeypatch):
    monkeypatch.setattr(exact, "HOT", 4)
    rows = [(i, "hot" if i % 3 else f"t{i}", "en") for i in range(300)]
    got = exact.groups(spark.createDataFrame(rows, DOCS))
    assert sorted(map(tuple, got.collect()), key=str) == plain_copies(rows)


def test_sql_on_odd_rows(spark, tmp_path):
    rows = [(1, "", "en"), (2, None, None), (None, "A b. a b", None), (3, "a b\vA B", "und"), (3, "A b. a b", "x"), (3, "A b. a b", "x")]
    spark.createDataFrame(rows * 20, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    for name in ("op11_exact_dedup", "op12_collocations"):
        text, ok = compare(spark, db, name, QUERIES[name], ORACLE[name], str(tmp_path))
        assert ok, text


def test_filters_are_written_in_little_memory():
    """Three million phrases pass through a task that holds about one million of them."""
    rng, want, pieces = np.random.default_rng(3), Counter(), 24

    def found():
        for i in range(pieces):
            keys = rng.integers(0, 1 << 63, 1 << 17, np.uint64)
            keys[:50] = np.arange(50)
            want.update(dict.fromkeys(range(50), 1) if i % 2 else {})
            yield i % 2, keys, np.zeros(len(keys), np.uint32)

    held, n, seen = Counter(), 0, 0
    tracemalloc.start(1)
    for lang, part, raw in collocations.filters_of(found(), [3, 2]):
        keys, _, counts = collocations.unpack_filter(raw, [3, 2][lang], part)
        seen = max(seen, len(keys))
        n += int(counts.sum())
        held.update({int(k): int(c) for k, c in zip(keys[keys < 50], counts[keys < 50], strict=True)} if lang else {})
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == pieces << 17 and held == want
    assert peak < 120 << 20 and seen <= 1 << 20


def test_ranges_follow_the_words_of_a_language():
    """No range has more words of a language than `RANGE_TOKENS`, up to the most ranges."""
    for n in (0, 1, collocations.RANGE_TOKENS, collocations.RANGE_TOKENS + 1, 10**9, 10**11):
        bits = collocations.prefix_of(n)
        assert n <= collocations.RANGE_TOKENS << bits and (bits == 0 or n > collocations.RANGE_TOKENS << bits - 1)
    assert 1 << collocations.prefix_of(10**15) == collocations.MOST_RANGES
