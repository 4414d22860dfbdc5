"""Benchmark passages in documents, by SimHash of item-sized windows.

Words are lower-cased runs without white space, shingles are five words. An item
of n shingles is compared with windows of n shingles. A window whose weighted
Jaccard similarity with the item is `LEAST` or more shares with it, counted with
repeats, at least 2 n LEAST / (1 + LEAST) shingles; other windows cannot qualify
and get no fingerprint. A document of fewer shingles than the item is one window,
whole, and m of them share at least (m + n) LEAST / (1 + LEAST); it is verified at
once, by its exact similarity. The 64-bit SimHash of each window left is looked up
among those of the items of its size: the bits are cut into `RADIUS` + 1 blocks,
so two fingerprints within the radius agree in a block. Pairs within the radius
are verified by their exact similarity.

The hashes of a window or item are numbered by occurrence first: the second copy
of a shingle is another element than the first. So the similarity with repeats is
that of plain sets, and a shingle that repeats weighs on many bits evenly.

The radius is far above the 9.7 bits by which fingerprints at similarity 0.8
differ on average, so that one pair in a thousand at that very edge is lost, and
practically none above.

Null and short texts (fewer than five words) hold no shingle and match nothing,
nor do such items. Equal rows are answered once: results are per id and text.
Items that repeat under several ids are all reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foreledger.llm.common import stored, words_of

SHINGLE = 5
LEAST = 0.8
RADIUS = 18
BROADCAST_MOST = 1 << 21  # rows of eight bytes


def _text_key(text: Column) -> Column:
    """Tells apart rows that share an id."""
    return F.xxhash64(text)


def _hashes(words: str) -> Column:
    """Hash of each five words in a row of a column of words."""
    each = F.transform(
        words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, SHINGLE)])
    )
    return F.slice(each, 1, F.greatest(F.size(words) - (SHINGLE - 1), F.lit(0)))


def hash_lists(texts: DataFrame, *keys: str) -> DataFrame:
    """The keys and `hashes`, those of all shingles of `text` in order."""
    words = texts.select(*keys, words_of(F.lower("text")).alias("words"))
    return words.select(*keys, _hashes("words").alias("hashes"))


def shingles(texts: DataFrame, *keys: str) -> DataFrame:
    """The keys, place and hash of every shingle of `text`, and `n`, how many there are."""
    lists = hash_lists(texts, *keys).select(*keys, F.size("hashes").alias("n"), "hashes")
    # outer, as the optimizer would filter by the inner form's size where the text is
    # read, and there split it once more for every word
    each = lists.select(*keys, "n", F.posexplode_outer("hashes").alias("place", "h"))
    return each.where("place IS NOT NULL")


def _occurrence(h: Column, k: Column) -> Column:
    """Hash of the copy k, from zero, of a shingle."""
    return F.when(k == 0, h).otherwise(F.xxhash64(h, k.cast("long")))


def numbered(hashes: str) -> Column:
    """A column of sorted hashes with the copies of one told apart."""

    def one(h: Column, i: Column) -> Column:
        first = F.array_position(hashes, h) - 1
        return F.when((i > 0) & (F.get(hashes, i - 1) == h), _occurrence(h, i - first)).otherwise(h)

    return F.transform(hashes, one)


def fingerprints(each: DataFrame, *keys: str) -> DataFrame:
    """The keys and the SimHash of the different hashes `h` under them."""
    ones = [F.sum(F.getbit("h", F.lit(b)).cast("int")).alias(f"b{b}") for b in range(64)]
    counted = each.groupBy(*keys).agg(F.count("*").alias("shingles"), *ones)
    bits = [
        F.when(2 * F.col(f"b{b}") > F.col("shingles"), F.lit(1 << b if b < 63 else -(1 << 63)))
        .otherwise(F.lit(0)).cast("long")
        for b in range(64)
    ]
    value = bits[0]
    for bit in bits[1:]:
        value = value.bitwiseOR(bit)
    return counted.select(*keys, value.alias("fp"))


def _blocks(fp: Column, radius: int) -> Column:
    """Number and bits of each of the radius + 1 blocks."""
    edges = [round(64 * i / (radius + 1)) for i in range(radius + 2)]
    parts = []
    for place, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        bits = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        parts.append(F.struct(F.lit(place).alias("block"), bits.alias("bits")))
    return F.explode(F.array(*parts))


def _starts(places: Column, n: Column, last: Column, need: Column) -> Column:
    """Starts of the windows of n shingles that hold `need` or more of the places."""
    runs = F.transform(
        F.slice(places, 1, F.greatest(F.size(places) - need + 1, F.lit(0))),
        lambda first, i: F.struct(
            F.greatest(F.lit(0), F.get(places, i + need - 1) - n + 1).alias("low"),
            F.least(first, last).alias("high"),
        ),
    )
    fitting = F.filter(runs, lambda r: r["low"] <= r["high"])
    return F.array_distinct(
        F.flatten(F.transform(fitting, lambda r: F.sequence(r["low"], r["high"])))
    )


def passages(docs: DataFrame, items: DataFrame, least: float = LEAST, radius: int = RADIUS) -> DataFrame:
    """doc_id, text_key, item_id, window_start, n_shingles, shared, similarity.

    The best window of each text and item, the first among equals.
    """
    items = items.select(F.col("item_id"), F.col("text").cast("string").alias("text")).distinct()
    item_shingles = stored(shingles(items, "item_id"), "item-shingles")
    item_hashes = item_shingles.select("item_id", "n", "h").distinct()
    known = stored(item_hashes.select("h").distinct(), "item-hashes")
    if known.count() <= BROADCAST_MOST:  # else the join is shuffled
        known = F.broadcast(known)

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("text_key", _text_key(F.col("text")))
    hits = stored(
        shingles(texts, "doc_id", "text_key").join(known, "h", "left_semi").distinct(), "hits"
    )
    size = F.least("n", "n_doc")  # of the windows; a shorter document is one, whole
    need = F.ceil((size + F.col("n")) * least / (1 + least) - 1e-9).cast("int")
    last = F.greatest(F.col("n_doc") - F.col("n"), F.lit(0))
    by_item = (
        hits.withColumnRenamed("n", "n_doc")
        .join(item_hashes, "h")
        .groupBy("doc_id", "text_key", "n_doc", "item_id", "n")
        .agg(F.sort_array(F.collect_list("place")).alias("places"))  # of one text
        .where(F.size("places") >= need)
    )
    by_item = stored(by_item, "window-items")
    windows = by_item.select(
        "doc_id",
        "text_key",
        "n",
        size.alias("size"),
        F.explode(_starts(F.col("places"), F.col("n"), last, need)).alias("start"),
    ).distinct()
    windows = stored(windows, "windows")

    # the words of the windows, from the few texts that have any
    holders = windows.select("doc_id", "text_key").distinct().hint("shuffle_hash").alias("w")
    held = texts.alias("t").join(
        holders,
        F.col("t.doc_id").eqNullSafe(F.col("w.doc_id"))
        & F.col("t.text_key").eqNullSafe(F.col("w.text_key")),
        "left_semi",
    )
    lists = hash_lists(held.distinct(), "doc_id", "text_key")
    cut = windows.alias("w").join(
        lists.alias("l"),
        F.col("l.doc_id").eqNullSafe(F.col("w.doc_id"))
        & F.col("l.text_key").eqNullSafe(F.col("w.text_key")),
    )
    keys = ["doc_id", "text_key", "n", "size", "start"]
    in_window = stored(
        cut.select(
            *[f"w.{k}" for k in keys],
            F.sort_array(F.slice("l.hashes", F.col("w.start") + 1, F.col("w.n"))).alias("hs"),
        ),
        "window-hashes",
    ).withColumn("hs", numbered("hs"))
    whole_size = in_window.where(F.col("size") == F.col("n"))
    prints = fingerprints(whole_size.select(*keys, F.explode("hs").alias("h")), *keys)
    counted = item_shingles.groupBy("item_id", "n", "h").agg(F.count("*").alias("in_item"))
    copies = F.sequence(F.lit(0).cast("long"), F.col("in_item") - 1)
    in_items = counted.select(
        "item_id", "n", F.explode(F.transform(copies, lambda k: _occurrence(F.col("h"), k))).alias("h")
    )
    item_prints = fingerprints(in_items, "item_id", "n").withColumnRenamed("fp", "item_fp")

    blocked = prints.select("*", _blocks(F.col("fp"), radius).alias("k")).select(
        *keys, "fp", "k.block", "k.bits"
    )
    index = item_prints.select("*", _blocks(F.col("item_fp"), radius).alias("k")).select(
        "item_id", "n", "item_fp", "k.block", "k.bits"
    )
    near = (
        blocked.join(index, ["n", "block", "bits"])
        .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
        .select(*keys, "item_id")
        .distinct()
    )
    # of few shingles and another number than the item's, so not left to fingerprints
    shorter = by_item.where(F.col("n_doc") < F.col("n")).withColumn("size", size)
    near = near.unionByName(shorter.withColumn("start", F.lit(0)).select(*keys, "item_id"))

    pairs = near.alias("p").join(
        in_window.alias("w"),
        F.col("p.doc_id").eqNullSafe(F.col("w.doc_id"))
        & F.col("p.text_key").eqNullSafe(F.col("w.text_key"))
        & (F.col("p.n") == F.col("w.n"))
        & (F.col("p.start") == F.col("w.start")),
    )
    shared = (
        pairs.select(*[f"p.{k}" for k in keys], "p.item_id", F.explode("w.hs").alias("h"))
        .join(in_items.select("item_id", "h"), ["item_id", "h"])
        .groupBy(*keys, "item_id")
        .agg(F.count("*").alias("shared"))
    )
    # the larger counts add up to the shingles of both sides less the smaller ones
    either = F.col("size") + F.col("n") - F.col("shared")
    similar = shared.where(F.col("shared") >= F.lit(least) * either - 1e-9)
    best = similar.groupBy("doc_id", "text_key", "item_id", "n", "size").agg(
        F.max(F.struct("shared", (-F.col("start")).alias("start"))).alias("best")
    )
    return best.select(
        "doc_id",
        "text_key",
        "item_id",
        (-F.col("best.start")).cast("long").alias("window_start"),
        F.col("n").cast("long").alias("n_shingles"),
        F.col("best.shared").alias("shared"),
        (F.col("best.shared") / (F.col("size") + F.col("n") - F.col("best.shared"))).alias(
            "similarity"
        ),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs` whose text holds no benchmark passage."""
    found = passages(docs, items).select("doc_id", "text_key").distinct().alias("f")
    own = F.col("d.doc_id").cast("long").eqNullSafe(F.col("f.doc_id"))
    key = _text_key(F.col("d.text").cast("string")).eqNullSafe(F.col("f.text_key"))
    return docs.alias("d").join(found, own & key, "left_anti")
