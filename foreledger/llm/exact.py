"""Exact duplicates through an extendible-hash index on shared files, in SQL functions only.

A text's slot is its 64-bit hash. The directory doubles as long as a bucket holds more
slots than it may: the overfull bucket's range of hashes is halved, the others keep
their depth. It starts with an eighth of the buckets that all rows would fill, and counts
in cells finer than a bucket. A bucket belongs to one owner task, which
chains the different texts of one hash and writes its part of the index. Which texts
are different is decided on their bytes: copies are combined within each task before
they are shuffled, so a text that a third of all rows share moves once per task.

A bucket of one cell is not halved further and chains its slots beyond capacity. Rows
find their entry by hash and digest. At most HOT texts can each hold more than a
HOT-th of the rows; those entries are broadcast, all others are joined by shuffle.

Null counts as empty. Of equal texts the row with the largest id stays, a null id
only where there is no other; rows that repeat both id and text are told
apart by their place in the table, so exactly one row of each text stays. Only the
columns asked for are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foreledger.llm.common import stored

CAPACITY = 4096  # slots in a bucket
FINER = 8  # doublings that the cells leave from the first directory on
HOT = 4096


@dataclass
class Index:
    """members: a row per document; directory: a row per cell; entries: a row per different text."""

    members: DataFrame
    directory: DataFrame
    entries: DataFrame


def _cell(h: Column, fine: int) -> Column:
    return F.shiftrightunsigned(h, 64 - fine)


def grow_directory(slots: DataFrame, start: int, fine: int, capacity: int = CAPACITY) -> DataFrame:
    """cell, n, depth and bucket for each occupied cell, from the different hashes `h`.

    A cell is the first `fine` bits of a hash, a bucket is named by its first cell.
    """
    cells = slots.groupBy(_cell(F.col("h"), fine).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    grown = stored(cells.withColumn("depth", F.lit(start)), "directory")
    unused = F.lit(fine) - F.col("depth")
    bucket = F.call_function("shiftleft", F.call_function("shiftright", F.col("cell"), unused), unused)
    for depth in range(start, fine):  # each round doubles the directory
        held = F.sum("n").over(Window.partitionBy("depth", bucket))
        over = (held > capacity) & (F.col("depth") == depth)
        wider = stored(grown.withColumn("depth", F.col("depth") + F.when(over, 1).otherwise(0)), "directory")
        if wider.where(F.col("depth") > depth).isEmpty():
            break
        grown = wider
    return stored(grown.withColumn("bucket", bucket), "directory")


def build_index(
    docs: DataFrame, capacity: int = CAPACITY, finer: int = FINER, slot: Column | None = None
) -> Index:
    """Index of all rows of `docs` (doc_id, text). `slot` replaces the hash in tests of collisions."""
    text = F.coalesce(F.col("text"), F.lit(""))
    h = F.xxhash64(text) if slot is None else slot
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), h.alias("h"))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    numbered = rows.select("doc_id", "h", digest.alias("digest"), F.monotonically_increasing_id().alias("row"))
    members = stored(numbered, "dedup-members")
    start = max(0, (members.count() // capacity).bit_length() - 3)
    fine = min(60, start + finer)
    directory = grow_directory(members.select("h").distinct(), start, fine, capacity)

    # copies combine by bytes before and after the shuffle
    different = rows.groupBy("h", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    slim = different.select("h", digest.alias("digest"), "keep_id", "group_size", _cell(F.col("h"), fine).alias("cell"))
    # written, so the planner knows whether the directory is small
    placed = slim.join(directory.select("cell", "bucket"), "cell")
    chain = F.row_number().over(Window.partitionBy("bucket", "h").orderBy("digest"))
    entries = placed.repartition("bucket").withColumn("link", chain).drop("cell")
    return Index(members, directory, stored(entries, "dedup-index"))


def grouped(index: Index) -> DataFrame:
    """doc_id, row, digest, keep_id, group_size of every row, by its entry."""
    total = index.members.count()
    entries = index.entries.select("h", "digest", "keep_id", "group_size")
    many = F.col("group_size") > max(1, total // HOT)
    hot = F.broadcast(entries.where(many))
    found = index.members.join(hot, ["h", "digest"])
    rest = index.members.join(hot, ["h", "digest"], "left_anti").join(entries.where(~many), ["h", "digest"])
    return stored(found.unionByName(rest).drop("h"), "dedup-groups")


def groups(docs: DataFrame, **sizes) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    rows = grouped(build_index(docs, **sizes))
    first = (
        rows.where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("digest")
        .agg(F.min("row").alias("row"))
        .select("row", F.lit(True).alias("stays"))
    )
    return rows.join(first, "row", "left").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce("stays", F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
