"""Collocations: phrases of two to four words, counted without loss in quotient filters.

Words that occur often enough are numbered within their language, `AT_HAND` in all at
most, which bounds what tasks are sent. Numbers of 21 bits make a key: up to three
words in 64 bits, which an invertible permutation spreads; of four, the last is mixed
into the others before and kept beside them, which can be undone as well. The first
bits of a key are the quotient, the others the remainder, kept whole. A filter is the
sorted keys of a shard: a bit per quotient that occurs, a bit per slot that ends a run,
remainders in as few bytes as they need, one byte per counter with larger ones apart. Filters are cut by
ranges of quotients, as many as a language's words need, and merged in key order across
shards, so no two phrases share a counter. A task holds `SHARD` phrases before it writes
them and `RANGE_TOKENS` before it merges them, at any size. Phrases of k words are counted where both phrases of k - 1 words in them may be
frequent: the occupied quotients of those, a bitmap of fixed size, let every frequent
one through.

A phrase with a word that occurs often enough but is not at hand is counted
spelled out, by an ordinary grouping; a bitmap of fixed size leaves out words that
cannot be frequent. Both ways give the same counts at any size.

Null texts are empty, a null lang is `und`. Repeated rows count each. A phrase is a
candidate from `least` occurrences on; its score is that of its worst cut, the first of
equal ones. Without a candidate the result is empty. Only text and lang are read.
"""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foreledger.llm.common import stored

LEAST = 30
LONGEST = 4
AT_HAND = 1 << 20
BITS = 21  # of a word's number
OTHER = (1 << BITS) - 1  # a word that may be frequent and is not at hand
CELLS = 1 << 22  # bits of a bitmap
SHARD = 1 << 20  # different phrases a task holds before it writes filters of them
WORDS = 1 << 19  # different words a task holds before it sends them on
PACKET = 4 << 20  # bytes of filters sent on at a time
RANGE_TOKENS = 2 << 20  # words of a language for each range of its quotients, at most
PORTION = 1 << 20  # bytes of text split at a time
MOST_RANGES = 1 << 16
FILES = 8  # of a table much smaller than the input, unless it outgrows them
SCALE = 2_000_000

_BREAK = b"\xff"  # not a byte of UTF-8
_TABLE = bytes(
    0xFF if chr(b) in ".,;:!?\n\x0b\x0c\r" else 0x20 if b == 9 else b + 32 if 65 <= b <= 90 else b
    for b in range(256)
)


def tokens(text: bytes) -> list[bytes]:
    """Words of a text, with a break between pieces."""
    return text.translate(_TABLE).replace(_BREAK, b" \xff ").split(b" ")


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """Tokens of a batch in portions of one language, texts apart by a break."""
    found: dict[str, list[bytes]] = {}
    held: Counter = Counter()

    def split(lang: str) -> tuple[str, list[bytes]]:
        return lang, [t for t in tokens(_BREAK.join(found.pop(lang))) if t]

    texts = batch.column("text").cast(pa.binary())
    for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
        if text.is_valid:
            raw = text.as_buffer().to_pybytes()
            found.setdefault(lang, []).append(raw)
            held[lang] += len(raw)
            if held[lang] >= PORTION:
                held[lang] = 0
                yield split(lang)
    for lang in list(found):
        yield split(lang)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, own in counts.items():
            own.pop(_BREAK, None)
            yield pa.record_batch(
                [
                    pa.array([lang] * len(own), pa.string()),
                    pa.array(list(own), pa.binary()).cast(pa.string()),
                    pa.array(list(own.values()), pa.int64()),
                ],
                names=["lang", "phrase", "f"],
            )
        counts.clear()

    for batch in batches:
        for lang, words in _by_lang(batch):
            counts.setdefault(lang, Counter()).update(words)
            if sum(map(len, counts.values())) > WORDS:
                yield from flush()
    yield from flush()


# ---- keys, their permutation and filters of them

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_BACK = tuple(pow(c, -1, 1 << 64) for c in _ODD)
_HALF = np.uint64(32)


def permute(key: np.ndarray) -> np.ndarray:
    x = key ^ (key >> _HALF)
    for c in _ODD:
        x = x * np.uint64(c)
        x ^= x >> _HALF
    return x


def restore(x: np.ndarray) -> np.ndarray:
    for c in reversed(_BACK):
        x = x ^ (x >> _HALF)
        x = x * np.uint64(c)
    return x ^ (x >> _HALF)


Filter = tuple[np.ndarray, np.ndarray, np.ndarray]  # keys, last words of four, counts


def merge(parts: list[Filter]) -> Filter:
    """Sorted different keys and the sums of their counts; `parts` is emptied to make room."""
    columns = [list(x) for x in zip(*parts, strict=True)]
    parts.clear()

    def joined(column: list[np.ndarray]) -> np.ndarray:
        whole = column[0] if len(column) == 1 else np.concatenate(column)
        column.clear()
        return whole

    keys, last = joined(columns[0]), joined(columns[1])
    if not len(keys):
        return keys, last, joined(columns[2])
    order = np.argsort(keys)
    last = last[order]
    by_key = keys[order]
    same = by_key[1:] == by_key[:-1]
    if (same & (last[1:] != last[:-1])).any():  # equal keys of four different words
        last[order] = last.copy()
        order = np.lexsort((last, keys))
        last, by_key = last[order], keys[order]
        same = by_key[1:] == by_key[:-1]
    first = np.flatnonzero(np.append(True, ~(same & (last[1:] == last[:-1]))))
    keys, last = by_key[first], last[first]
    del by_key, same
    return keys, last, np.add.reduceat(joined(columns[2])[order], first)


def pack_filter(keys: np.ndarray, last: np.ndarray, counts: np.ndarray, prefix: int) -> bytes:
    """A filter of sorted permuted keys that agree in their first `prefix` bits."""
    m = len(keys)
    q_bits = max(1, min(24, m.bit_length() - 1, 63 - prefix))
    r_bits = 64 - prefix - q_bits
    own = keys << np.uint64(prefix) if prefix else keys
    quotient = (own >> np.uint64(64 - q_bits)).astype(np.int64)
    occupied = np.zeros(1 << q_bits, bool)
    occupied[quotient] = True
    run_end = np.append(quotient[1:] != quotient[:-1], True)
    remainder = keys & np.uint64((1 << r_bits) - 1)
    fourth = bool(last.any())

    def low_bytes(values: np.ndarray, size: int) -> bytes:
        return values.astype("<u8", copy=False).view(np.uint8).reshape(m, 8)[:, :size].tobytes()

    large = counts >= 255
    return b"".join(
        (
            struct.pack("<IBB", m, q_bits, fourth),
            np.packbits(occupied).tobytes(),
            np.packbits(run_end).tobytes(),
            low_bytes(remainder, -(-r_bits // 8)),
            low_bytes(last, 3) if fourth else b"",
            np.where(large, 255, counts).astype(np.uint8).tobytes(),
            counts[large].astype("<i8").tobytes(),
        )
    )


def unpack_filter(raw: bytes, prefix: int, part: int) -> Filter:
    """Sorted keys and counts of a filter; `part` holds the first `prefix` bits."""
    m, q_bits, fourth = struct.unpack_from("<IBB", raw)
    r_bits, at = 64 - prefix - q_bits, 6

    def take(size: int, kind: str) -> np.ndarray:
        nonlocal at
        at += size
        return np.frombuffer(raw[at - size : at], kind)

    def numbers(size: int) -> np.ndarray:
        full = np.zeros((m, 8), np.uint8)
        full[:, :size] = take(m * size, "u1").reshape(m, size)
        return full.view("<u8").ravel()

    occupied = np.unpackbits(take(-(-(1 << q_bits) // 8), "u1"), count=1 << q_bits)
    run_end = np.unpackbits(take(-(-m // 8), "u1"), count=m).astype(np.int64)
    remainder = numbers(-(-r_bits // 8))
    last = numbers(3).astype(np.uint32) if fourth else np.zeros(m, np.uint32)
    counts = take(m, "u1").astype(np.int64)
    large = counts == 255
    counts[large] = take(8 * int(large.sum()), "<i8")
    quotient = np.flatnonzero(occupied)[np.cumsum(run_end) - run_end].astype(np.uint64)
    keys = remainder | quotient << np.uint64(r_bits)
    return keys | np.uint64(part << (64 - prefix)) if prefix else keys, last, counts


def key_of(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Permuted keys of phrases, given by the numbers of their words, and what is kept beside."""
    key = words[0].astype(np.uint64)
    for more in words[1:3]:
        key = key << np.uint64(BITS) | more.astype(np.uint64)
    if len(words) < 4:
        return permute(key), np.zeros(len(key), np.uint32)
    last = words[3].astype(np.uint32)
    return permute(key ^ last.astype(np.uint64) * np.uint64(_ODD[1])), last


def words_in(keys: np.ndarray, last: np.ndarray, k: int) -> np.ndarray:
    """The numbers of the words of permuted keys, a row per phrase."""
    plain = restore(keys) ^ last.astype(np.uint64) * np.uint64(_ODD[1])
    shifts = [np.uint64(BITS * (min(k, 3) - 1 - j)) for j in range(min(k, 3))]
    parts = [plain >> s & np.uint64(OTHER) for s in shifts] + ([last] if k > 3 else [])
    return np.stack(parts, 1).astype(np.int64)


def cell(permuted: np.ndarray, lang: int) -> np.ndarray:
    """Bit of the bitmap: the quotient, turned by the language."""
    shift = np.uint64(64 - CELLS.bit_length() + 1)
    return ((permuted >> shift) + np.uint64(lang * 2654435761 % CELLS)) % np.uint64(CELLS)


def windows(
    ids: np.ndarray, k: int, lang: int, shorter: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the phrases of k words at hand, both parts of k - 1 words in the bitmap."""
    n = max(0, len(ids) - k + 1)
    known = (ids > 0) & (ids < OTHER)
    good = known[:n].copy()
    for j in range(1, k):
        good &= known[j : j + n]
    at = np.flatnonzero(good)

    def key(start: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        return key_of([ids[start + j] for j in range(size)])

    if shorter is not None:
        at = at[shorter[cell(key(at, k - 1)[0], lang)]]
        at = at[shorter[cell(key(at + 1, k - 1)[0], lang)]]
    return key(at, k)


class Numbers(dict):
    """Word to number; other words are OTHER if the bitmap has them and 0 if not."""

    def __init__(self, known: pa.BinaryArray, lang: str, rest: np.ndarray | None):
        super().__init__(zip(known.to_pylist(), range(1, len(known) + 1), strict=True))
        self[_BREAK] = 0
        self.lang, self.rest = lang.encode() + b" ", rest

    def __missing__(self, word: bytes) -> int:
        if self.rest is None:
            return 0
        return OTHER if self.rest[xxhash.xxh64_intdigest(self.lang + word, 42) % CELLS] else 0


def _spelled(words: list[bytes], ids: np.ndarray) -> Counter:
    """Phrases with a word that is not at hand."""
    found: Counter = Counter()
    last = -1  # the place before which a phrase has been counted by an earlier word
    for i in np.flatnonzero(ids == OTHER).tolist():
        for start in range(max(0, i - LONGEST + 1, last + 1), i + 1):
            for stop in range(max(i + 1, start + 2), min(len(words), start + LONGEST) + 1):
                if ids[start:stop].all():
                    found[b" ".join(words[start:stop])] += 1
        last = i
    return found


def _bitmap(cells: DataFrame) -> np.ndarray:
    """At most CELLS different numbers as a bitmap."""
    out = np.zeros(CELLS, bool)
    out[cells.select(F.col("cell").cast("int")).distinct().toArrow()["cell"].to_numpy()] = True
    return out


def _gathered(df: DataFrame, label: str) -> DataFrame:
    """`df` stored in few files, however many tasks made it; large parts are split again."""
    return stored(df.hint("rebalance", FILES), label)


def mined(
    docs: DataFrame, least: int = LEAST, at_hand: int = AT_HAND, shard: int = SHARD
) -> DataFrame:
    """lang, phrase, k, a, l, r, cut, score, n of every candidate that no longer one covers."""
    spark = docs.sparkSession
    slim = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    words = slim.mapInArrow(_count_words, "lang string, phrase string, f long")
    words = words.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    frequent = _gathered(words.where(F.col("f") >= least), "words")
    best = Window.partitionBy("lang").orderBy(F.desc("f"), "phrase")
    common = frequent.orderBy(F.desc("f"), "lang", "phrase").limit(at_hand)
    chosen = stored(common.withColumn("id", F.row_number().over(best)), "words-at-hand")
    rest = frequent.join(chosen, ["lang", "phrase"], "left_anti")
    # the bytes that tasks hash: lang, blank, word
    rest_cells = F.expr(f"pmod(xxhash64(concat(lang, ' ', phrase)), {CELLS})").alias("cell")
    others = _bitmap(rest.select(rest_cells))
    others = others if others.any() else None
    hand = chosen.select("lang", "phrase", "id").toArrow()  # at most at_hand
    hand = hand.sort_by([("lang", "ascending"), ("id", "ascending")])
    spelling = hand["phrase"].cast(pa.binary()).combine_chunks()
    per: dict[str, tuple[int, int]] = {}  # place of a language's words, in the order of their numbers
    start = 0
    for own in pc.value_counts(hand["lang"]).to_pylist():
        per[own["values"]] = start, own["counts"]
        start += own["counts"]
    for lang, *_ in rest.select("lang").distinct().collect() if others is not None else ():
        per.setdefault(lang, (0, 0))
    langs = sorted(per)
    shared = spark.sparkContext.broadcast((langs, per, spelling, others))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, per, spelling, others = shared.value
        numbers = {x: Numbers(spelling.slice(*per[x]), x, others) for x in langs}
        for batch in batches:
            for lang, found in _by_lang(batch):
                if lang not in numbers:
                    continue
                ids = np.fromiter(map(numbers[lang].__getitem__, found), np.uint32, len(found))
                spelled = _spelled(found, ids) if others is not None else {}
                m, n = len(spelled), len(found) - found.count(_BREAK)
                yield pa.record_batch(
                    [
                        pa.array([lang] * (m + 1), pa.string()),
                        pa.array([*spelled, None], pa.binary()).cast(pa.string()),
                        pa.array([*spelled.values(), n], pa.int64()),
                        pa.array([None] * m + [ids.tobytes()], pa.binary()),
                    ],
                    names=["lang", "phrase", "f", "ids"],
                )

    coded = stored(slim.mapInArrow(encode, "lang string, phrase string, f long, ids binary"), "coded")
    spelled = coded.where("phrase IS NOT NULL").groupBy("lang", "phrase").agg(F.sum("f").alias("a"))
    found = [spelled.where(F.col("a") >= least).select("lang", "phrase", "a")]
    totals = coded.where("phrase IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    sizes = dict(totals.collect())  # a row per language with a frequent word
    prefixes = [prefix_of(sizes.get(x, 0)) for x in langs]
    coded_ids = coded.where("ids IS NOT NULL").select("lang", "ids")
    shorter = None
    for k in range(2, LONGEST + 1):
        level = _counted(coded_ids, k, shared, shorter, prefixes, least, shard)
        found.append(level.select("lang", "phrase", "a"))
        shorter = _bitmap(level)
    candidates = found[0]
    for more in found[1:]:
        candidates = candidates.unionByName(more)
    candidates = _gathered(candidates.withColumn("k", F.size(F.split("phrase", " "))), "candidates")
    return _scored(candidates, frequent, totals)


def prefix_of(n: int) -> int:
    """Bits that tell the ranges of a language of n words apart."""
    return (min(MOST_RANGES, max(1, -(-n // RANGE_TOKENS))) - 1).bit_length()


def filters_of(
    found: Iterator[tuple[int, np.ndarray, np.ndarray]], prefixes: list[int], shard: int = SHARD
) -> Iterator[tuple[int, int, bytes]]:
    """Language, range and filter of phrases, given as language, keys and last words.

    Half a shard of phrases is held as found and then merged with those before, which are
    written as they pass a shard.
    """
    merged: dict[int, Filter] = {}
    fresh: dict[int, list[Filter]] = {}

    def settle() -> None:
        for lang in list(fresh):
            new = [merge(fresh.pop(lang))]
            if lang in merged:
                new.append(merged.pop(lang))
            merged[lang] = merge(new) if len(new) > 1 else new[0]
            del new

    def flush() -> Iterator[tuple[int, int, bytes]]:
        for lang in list(merged):
            keys, last, n = merged.pop(lang)
            prefix = prefixes[lang]
            ends = (np.arange(1, 1 << prefix).astype(np.uint64) << np.uint64(64 - prefix)) if prefix else []
            cuts = [0, *np.searchsorted(keys, ends).tolist(), len(keys)]
            for part, (a, b) in enumerate(pairwise(cuts)):
                if a < b:
                    yield lang, part, pack_filter(keys[a:b], last[a:b], n[a:b], prefix)

    held = 0
    for lang, keys, last in found:
        fresh.setdefault(lang, []).append((keys, last, np.broadcast_to(np.int64(1), len(keys))))
        held += len(keys)
        if held >= shard // 2:
            settle()
            held = 0
            if sum(len(x[0]) for x in merged.values()) >= shard:
                yield from flush()
    settle()
    yield from flush()


def _counted(
    coded: DataFrame, k: int, shared, shorter: np.ndarray | None, prefixes: list[int], least: int, shard: int
) -> DataFrame:
    """lang, phrase, a, cell of the phrases of k words at hand that occur `least` times."""
    allowed = coded.sparkSession.sparkContext.broadcast(shorter)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {x: i for i, x in enumerate(shared.value[0])}
        schema = pa.schema([("lang", pa.int32()), ("part", pa.int32()), ("filter", pa.binary())])

        def found() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            for batch in batches:
                for lang, ids in zip(batch.column("lang").to_pylist(), batch.column("ids"), strict=True):
                    own = place[lang]
                    yield own, *windows(np.frombuffer(ids.as_buffer(), np.uint32), k, own, allowed.value)

        packet, size = [], 0
        for row in filters_of(found(), prefixes, shard):
            packet.append(row)
            size += len(row[2])
            if size >= PACKET:
                yield pa.record_batch(list(zip(*packet, strict=True)), schema)
                packet, size = [], 0
        if packet:
            yield pa.record_batch(list(zip(*packet, strict=True)), schema)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, per, spelling, _ = shared.value
        at, parts = None, []

        def close() -> pa.RecordBatch:
            lang = at[0]
            keys, last, n = merge(parts)
            often = n >= least
            keys, last, n = keys[often], last[often], n[often]
            places = words_in(keys, last, k).T + (per[langs[lang]][0] - 1)
            words = [spelling.take(pa.array(own)) for own in places]
            return pa.record_batch(
                [
                    pa.array([langs[lang]] * len(n), pa.string()),
                    pc.binary_join_element_wise(*words, b" ").cast(pa.string()),
                    pa.array(n, pa.int64()),
                    pa.array(cell(keys, lang).astype(np.int32)),
                ],
                names=["lang", "phrase", "a", "cell"],
            )

        for batch in batches:
            rows = zip(batch.column("lang").to_pylist(), batch.column("part").to_pylist(), batch.column("filter"), strict=True)
            for lang, part, raw in rows:
                if (lang, part) != at:
                    if parts:
                        yield close()
                    at, parts = (lang, part), []
                parts.append(unpack_filter(raw.as_buffer().to_pybytes(), prefixes[lang], part))
                if sum(len(x[0]) for x in parts[1:]) > max(SHARD, len(parts[0][0])) // 2:
                    parts.append(merge(parts))
        if parts:
            yield close()

    filters = coded.mapInArrow(count, "lang int, part int, filter binary")
    ordered = filters.repartition("lang", "part").sortWithinPartitions("lang", "part")
    return _gathered(ordered.mapInArrow(combine, "lang string, phrase string, a long, cell int"), f"phrases-{k}")


def _scored(candidates: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    known = words.select("lang", "phrase", "f").unionByName(
        candidates.select("lang", "phrase", F.col("a").alias("f"))
    )
    cut = candidates.withColumn("cut", F.explode(F.expr("sequence(1, k - 1)"))).withColumn(
        "parts", F.split("phrase", " ")
    )
    cut = cut.select(
        "lang", "phrase", "k", "a", "cut",
        F.expr("array_join(slice(parts, 1, cut), ' ')").alias("left"),
        F.expr("array_join(slice(parts, cut + 1, k - cut), ' ')").alias("right"),
    )
    first = known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    second = known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    both = cut.join(first, ["lang", "left"]).join(second, ["lang", "right"])
    score = F.expr(f"CAST({SCALE} AS DECIMAL(38, 0)) * a div (l + r)")
    worst = both.groupBy("lang", "phrase", "k", "a").agg(
        F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("worst")
    )
    longer = candidates.where("k > 2").withColumn("parts", F.split("phrase", " "))
    longer = longer.withColumn("size", F.explode(F.expr("sequence(2, k - 1)")))
    longer = longer.withColumn("start", F.explode(F.expr("sequence(1, k - size + 1)")))
    inside = longer.groupBy(
        "lang", F.expr("array_join(slice(parts, start, size), ' ')").alias("phrase")
    ).agg(F.max("a").alias("longest"))
    free = worst.join(inside, ["lang", "phrase"], "left").where("longest IS NULL OR 100 * longest < 80 * a")
    return free.join(totals, "lang").select(
        "lang", "phrase", "k", "a", "worst.l", "worst.r", "worst.cut", "worst.score", "n"
    )


def ranked(phrases: DataFrame, most: int) -> DataFrame:
    """The best phrases of each language; tasks cut their own rows to `most` before the shuffle."""
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        phrases.withColumn("rank", F.row_number().over(best).cast("long"))
        .where(F.col("rank") <= most)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
