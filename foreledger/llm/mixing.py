"""Mixing sources to target weights by Pfair scheduling.

Each source is dealt into blocks. A target weight is a whole number of shares of
a cycle; block j of a source with a of Q shares may run from slot floor((j-1)Q/a)
and must have run by slot ceil(jQ/a). Taking in each slot the released block with
the earliest deadline meets all deadlines, so in every prefix each source is less
than one block away from its target. Cycles of the same sources are alike: one is
scheduled, for every set of sources that are left as others run out, and every
row finds its place in it by arithmetic. All rows are kept.

Blocks hold `BLOCK_ROWS` rows of one source in the order of the ids' hashes.
Null is a source like any other; null and repeated ids are rows like others, in
no fixed order among equals. Without targets the weights are the square roots of
the sources' sizes. A source without a target takes one share.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foreledger.llm.common import stored

BLOCK_ROWS = 16
SHARES = 1000  # of a cycle, so weights are met to a thousandth
_BUCKET_BITS = 12


def _source(source: Column) -> Column:
    """A key that tells null from every name."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def _ranked(docs: DataFrame) -> DataFrame:
    """`docs` with the source's key and the row's index in its source.

    A source may hold most rows, so it is ranked in buckets of the hash: the
    index in a bucket plus the sizes of the buckets before.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    h = F.xxhash64(F.col("doc_id").cast("long"))
    keyed = docs.select(
        *own,
        _source(F.col("source")).alias("_fl_source"),
        h.alias("_fl_h"),
        F.shiftrightunsigned(h, 64 - _BUCKET_BITS).alias("_fl_bucket"),
    )
    # the hash is ordered as an unsigned number, as the buckets are
    unsigned = F.col("_fl_h").bitwiseXOR(F.lit(-(1 << 63)))
    in_bucket = Window.partitionBy("_fl_source", "_fl_bucket").orderBy(unsigned, "doc_id")
    so_far = Window.partitionBy("_fl_source").orderBy("_fl_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = (
        keyed.groupBy("_fl_source", "_fl_bucket")
        .agg(F.count("*").alias("n"))
        .select(
            "_fl_source",
            "_fl_bucket",
            F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("_fl_before"),
        )
    )
    return (
        keyed.withColumn("_fl_row", F.row_number().over(in_bucket))
        .join(before, ["_fl_source", "_fl_bucket"])
        .select(*own, "_fl_source", (F.col("_fl_before") + F.col("_fl_row") - 1).alias("_fl_index"))
    )


def sources(docs: DataFrame, targets: Mapping[str | None, float] | None = None) -> DataFrame:
    """One row per source: rows, blocks, shares, cycles it lasts, and lists over all sources.

    The window over all of it runs over as many rows as there are sources.
    """
    counted = docs.groupBy(_source(F.col("source")).alias("src")).agg(F.count("*").alias("n"))
    if targets is None:
        weight = F.sqrt("n")
    else:
        keys = {"-" if k is None else f"={k}": float(v) for k, v in targets.items()}
        pairs = [x for kv in keys.items() for x in map(F.lit, kv)]
        weight = F.coalesce(F.element_at(F.create_map(*pairs), F.col("src")), F.lit(0.0))
    whole = Window.partitionBy()
    share = F.round(F.col("weight") * SHARES / F.greatest(F.sum("weight").over(whole), F.lit(1e-9)))
    one = (
        counted.withColumn("weight", weight)
        .withColumn("shares", F.greatest(F.lit(1), share.cast("int")))
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS))
        .withColumn("cycles", F.ceil(F.col("blocks") / F.col("shares")))
    )
    row = F.struct("src", "shares", "blocks", "cycles")
    return one.select(
        "*",
        F.sort_array(F.collect_set("cycles").over(whole)).alias("ends"),
        F.sort_array(F.collect_list(row).over(whole)).alias("every"),
    )


def _schedule(active: Column, length: Column) -> Column:
    """The slots of a cycle: for each, the place of the source that runs and what ran before.

    `active` holds the shares of every source, zero for one that has run out.
    Each slot takes the released block with the earliest deadline, the first
    source among equals.
    """
    size = F.size(active)
    never = F.lit(1 << 62)

    def slot(state: Column, t: Column) -> Column:
        def due_at(a: Column, i: Column) -> Column:
            ran = F.get(state["done"], i)
            share = F.greatest(a, F.lit(1))
            ready = (ran < a) & (F.floor(ran * length / share) <= t)
            return F.when(ready, F.ceil((ran + 1) * length / share) * size + i).otherwise(never)

        due = F.transform(active, due_at)
        chosen = F.pmod(F.array_min(due), size.cast("long")).cast("int")

        def after(who: Column) -> Column:
            ran = F.transform(
                state["done"], lambda d, i: d + F.when(i == who, F.lit(1)).otherwise(F.lit(0))
            )
            entry = F.struct(who.alias("who"), state["done"].alias("done"))
            return F.struct(
                ran.alias("done"), F.array_append(state["slots"], entry).alias("slots")
            )

        # a list of one, so that the choice is made once and not for each source
        return F.get(F.transform(F.array(chosen), after), 0)

    start = F.struct(
        F.transform(active, lambda a: F.lit(0)).alias("done"),
        F.array().cast("array<struct<who:int,done:array<int>>>").alias("slots"),
    )
    return F.aggregate(F.sequence(F.lit(0), length - 1), start, slot, lambda s: s["slots"])


def cycle_table(src: DataFrame) -> DataFrame:
    """src, phase, turn (of the source in the cycle), slot, done (blocks of each source before).

    A phase is a run of cycles with the same sources left. At most sources times
    the slots of a cycle rows.
    """
    phases = src.select(
        "every", F.posexplode("ends").alias("phase", "until")
    ).distinct().repartition("phase")
    active = F.transform(
        F.col("every"),
        lambda s: F.when(s["cycles"] >= F.col("until"), s["shares"]).otherwise(F.lit(0)),
    )
    length = F.aggregate("active", F.lit(0), lambda acc, x: acc + x)
    slots = (
        phases.withColumn("active", active)
        .withColumn("length", length)
        .withColumn("slots", _schedule(F.col("active"), F.col("length")))
        .select("every", "phase", F.posexplode("slots").alias("slot", "s"))
    )
    return slots.select(
        F.element_at("every", F.col("s.who") + 1)["src"].alias("src"),
        "phase",
        F.get(F.col("s.done"), F.col("s.who")).alias("turn"),
        "slot",
        F.col("s.done").alias("done"),
    )


def mixed(docs: DataFrame, targets: Mapping[str | None, float] | None = None) -> DataFrame:
    """`docs` with `_fl_block`, `_fl_cycle`, `_fl_slot`, `_fl_position` and `_fl_place`.

    The block's number in its source, its cycle and slot, its position among all
    blocks, and the row's place in it. Ordering by position and place is the mix.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    src = stored(sources(docs.select("source"), targets), "mix-sources")
    table = stored(cycle_table(src), "mix-cycles")
    block = F.floor(F.col("_fl_index") / BLOCK_ROWS)
    rows = (
        _ranked(docs)
        .join(src.select(F.col("src").alias("_fl_source"), "shares", "ends", "every"), "_fl_source")
        .withColumn("_fl_block", block)
        .withColumn("_fl_cycle", F.floor(F.col("_fl_block") / F.col("shares")))
        .withColumn("_fl_turn", F.pmod("_fl_block", "shares").cast("int"))
        .withColumn(
            "_fl_phase", F.size(F.filter("ends", lambda end: end <= F.col("_fl_cycle")))
        )
    )
    slots = table.select(
        F.col("src").alias("_fl_source"),
        F.col("phase").alias("_fl_phase"),
        F.col("turn").alias("_fl_turn"),
        F.col("slot").alias("_fl_slot"),
        "done",
    )
    cycle = F.col("_fl_cycle")

    def ahead(s: Column, done: Column) -> Column:
        """Blocks of one source before this slot: of earlier cycles and of this one."""
        earlier = F.least(s["blocks"], cycle * s["shares"])
        return earlier + F.least(done.cast("long"), s["blocks"] - earlier)

    position = F.aggregate(
        F.zip_with("every", "done", ahead), F.lit(0).cast("long"), lambda acc, x: acc + x
    )
    return rows.join(slots, ["_fl_source", "_fl_phase", "_fl_turn"]).select(
        *own,
        "_fl_block",
        "_fl_cycle",
        "_fl_slot",
        position.alias("_fl_position"),
        F.pmod("_fl_index", F.lit(BLOCK_ROWS)).alias("_fl_place"),
    )


def in_order(docs: DataFrame, targets: Mapping[str | None, float] | None = None) -> DataFrame:
    """The rows of `docs` in the order of the mix, part by part."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["_fl_position", "_fl_place"]
    return (
        mixed(docs, targets)
        .repartitionByRange(parts, *by)
        .sortWithinPartitions(*by)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
