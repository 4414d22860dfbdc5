"""Near duplicates by SimHash, over an inverted index of positional bytes.

Fingerprints of 64 bits link at four or fewer differing bits. At most four of
the eight bytes can then differ, so a linked pair shares four positional bytes
or more. Twenty triples of positions are such that any four positions contain
one of them (Turan's bound for 4 of 8), so the postings are keyed by the bytes
at three positions. Pairs that meet in a posting list are tallied over all
positions, kept if they share four bytes, and verified bit by bit.

Equal fingerprints are one entry of the index, whatever the number of copies. A
list longer than `LIST_MOST` is not paired up: two fingerprints are within four
bits exactly if some value is within two bits of both, so each entry of such a
list is linked to the smallest of those that share such a value, which takes a
number of rows in proportion to the list. Nothing is capped or dropped.

A null or blank text has fingerprint zero and is linked like any other. Only id
and text are read. Rows with a null id are grouped but never name a group that
has another id; repeated ids are rows like others.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foreledger.llm.common import stored
from foreledger.llm.components import components

SHINGLE = 4
RADIUS = 4
LEAST_BYTES = 8 - RADIUS
LIST_MOST = 8192
SEED = 42


def _triples() -> list[tuple[int, int, int]]:
    """The 20 triples of 8 positions of which any four positions contain one.

    Positions are dealt to three classes in a ring; a triple is taken if it lies
    in one class, or has two of one class and one of the next.
    """
    ring = [p % 3 for p in range(8)]
    out = []
    for triple in combinations(range(8), 3):
        held = [ring[p] for p in triple]
        ordered = sorted(set(held), key=held.count, reverse=True)
        if len(ordered) == 1 or (len(ordered) == 2 and (ordered[0] + 1) % 3 == ordered[1]):
            out.append(triple)
    return out


TRIPLES = _triples()


def fingerprint(text: str) -> int:
    """SimHash of the word shingles of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    first = [0, *(ends[: n - 1] + 1).tolist()]
    last = ends[SHINGLE - 1 :].tolist() if len(words) >= SHINGLE else [len(joined)]
    digest = xxhash.xxh64_intdigest
    set_bits, counted = np.zeros(64, np.int64), 0
    for at in range(0, n, 65536):
        spans = zip(first[at : at + 65536], last[at : at + 65536], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(0, dtype=np.int64)
        counted += len(hashes)
    return int(np.packbits(2 * set_bits > counted, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(t.as_py() or "") for t in batch.column("text")]
        signed = pa.array(np.array(prints, np.uint64).view(np.int64))
        yield pa.record_batch(
            [batch.column("doc_id"), batch.column("text_key"), signed],
            names=["doc_id", "text_key", "fp"],
        )


def _id(doc_id: Column) -> Column:
    return doc_id.cast("long")


def _text_key(text: Column) -> Column:
    """Tells apart rows that share an id."""
    return F.xxhash64(text.cast("string"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and fp, a signed 64-bit number, of every row."""
    slim = docs.select(
        _id(F.col("doc_id")).alias("doc_id"), _text_key(F.col("text")).alias("text_key"), "text"
    )
    return slim.mapInArrow(_fingerprints, "doc_id long, text_key long, fp long")


def _key(fp: Column, place: int, triple: tuple[int, int, int]) -> Column:
    mask = sum(0xFF << 8 * p for p in triple)
    masked = fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))
    return F.struct(F.lit(place).alias("place"), masked.alias("held"))


def postings(prints: DataFrame) -> DataFrame:
    """place, held and fp: every fingerprint under each of its 20 keys."""
    keys = F.array(*[_key(F.col("fp"), i, t) for i, t in enumerate(TRIPLES)])
    return prints.select("fp", F.explode(keys).alias("k")).select("k.place", "k.held", "fp")


def forest(prints: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join what is linked among the prints, fewer than there are prints.

    A walk: each print reached is compared once with those not yet reached, so a
    list of near copies is reached at once and costs no pair for each two of them.
    """
    left = np.unique(np.asarray(prints, np.int64)).view(np.uint64)
    edges, waiting = [], []
    while len(left):
        if not waiting:
            waiting.append(int(left[0]))
            left = left[1:]
        at = waiting.pop()
        differ = left ^ np.uint64(at)
        shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(1)
        linked = shared >= LEAST_BYTES
        linked[linked] = np.bitwise_count(differ[linked]) <= RADIUS
        if linked.any():
            reached = left[linked]
            edges += [(at, x) for x in reached.tolist()]
            waiting += reached.tolist()
            left = left[~linked]
    signed = np.array(edges, np.uint64).view(np.int64).reshape(-1, 2)
    return [(a, b) for a, b in signed.tolist()]


def _pair_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        edges = [e for prints in frame["prints"] for e in forest(np.asarray(prints))]
        yield pd.DataFrame(edges, columns=["a", "b"], dtype="int64")


def _within_two(free: Column, fp: Column) -> Column:
    """All values within two bits of fp that differ from it only in the free bits."""
    ones = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit(free, i) == 1),
        lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i),
    )
    pairs = F.flatten(F.transform(ones, lambda a: F.transform(ones, lambda b: a.bitwiseOR(b))))
    flips = F.array_distinct(F.concat(F.array(F.lit(0).cast("long")), pairs))
    return F.transform(flips, lambda flip: fp.bitwiseXOR(flip))


def links(prints: DataFrame, most: int = LIST_MOST) -> DataFrame:
    """Edges a, b over distinct fingerprints that connect exactly what is linked."""
    listed = stored(postings(prints.select("fp").distinct()), "postings")
    # counted in each task before the shuffle; lists of one have no pair
    lengths = listed.groupBy("place", "held").agg(F.count("*").alias("n")).where("n > 1")
    shared = listed.join(lengths, ["place", "held"])
    short = (
        shared.where(F.col("n") <= most)
        .groupBy("place", "held")
        .agg(F.collect_list("fp").alias("prints"))  # at most `most` numbers
        .select("prints")
        .mapInPandas(_pair_up, "a long, b long")
    )
    masks = [sum(0xFF << 8 * p for p in range(8) if p not in t) for t in TRIPLES]
    free = F.element_at(
        F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in masks]), F.col("place") + 1
    )
    near = shared.where(F.col("n") > most).select(
        "fp", F.explode(_within_two(free, F.col("fp"))).alias("value")
    )
    centre = near.groupBy("value").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    long = near.join(centre, "value").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return short.unionByName(long).distinct()


def members(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, fp, component (a fingerprint) and component_id of every row."""
    prints = stored(fingerprints(docs), "fingerprints")
    # each print goes by its smallest id from here on
    named = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "named-prints")
    found = components(links(named)).withColumnRenamed("node", "fp")
    of_print = named.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = of_print.groupBy("component").agg(F.min("first_id").alias("component_id"))
    ids = of_print.join(smallest, "component").select("fp", "component", "component_id")
    return prints.join(ids, "fp")


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of every row."""
    return members(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of `docs` for each group: that with the smallest id, a null id last."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    chosen = members(docs).groupBy("component").agg(first.alias("c")).select("c.*")
    chosen = stored(chosen.select("doc_id", "text_key"), "chosen").alias("c")
    own = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(
        *own,
        _id(F.col("doc_id")).alias("_fl_id"),
        _text_key(F.col("text")).alias("_fl_key"),
    )
    kept = keyed.join(
        chosen,
        F.col("_fl_id").eqNullSafe(F.col("c.doc_id")) & (F.col("_fl_key") == F.col("c.text_key")),
        "left_semi",
    )
    # rows that repeat id and text
    return kept.dropDuplicates(["_fl_id", "_fl_key"]).select(*own)
