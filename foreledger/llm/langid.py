"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts up to `ORDER` bytes, counted over its
training texts. A byte is coded in its longest context that the tree holds; a
context of n bytes seen with d different successors gives a seen one n_b/(n+d)
and an escape d/(n+d) to the next shorter context, and below the empty context
all 256 bytes are alike. Statistics are frozen after training, so a text's code
length in a language is a sum over its bytes, and the shortest code names the
language. The score is the language's share of the probability over all.

A context is kept if it has at least one in 2^`KEEP_BITS` of its language's
bytes, which bounds each order of each tree by 2^`KEEP_BITS` contexts whatever
the corpus, so the model can be sent to every task.

Null text and text without a letter get `und` and score 0, as does every text if
no language is known. Rows with null language teach nothing; rows with a null id
are training rows if they have a language. Only id, text and language are read,
the language in training alone. Ties go to the first language by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foreledger.llm.common import stored

ORDER = 3
KEEP_BITS = 13
_PAD = b"\0" * ORDER


def as_bytes(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def grams(raw: bytes) -> np.ndarray:
    """For each byte the ORDER bytes before it and itself, as one 32-bit number."""
    padded = np.frombuffer(_PAD + raw, np.uint8).astype(np.uint32)
    out = padded[ORDER:].copy()
    for back in range(1, ORDER + 1):
        out |= padded[ORDER - back : len(padded) - back] << np.uint32(8 * back)
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counted grams per language of each batch."""
    for batch in batches:
        texts = {}
        for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
            texts.setdefault(lang.as_py(), []).append(text.as_py())
        for lang, own in texts.items():
            # in portions: a gram takes more room than its byte
            for at in range(0, len(own), 1000):
                part = [grams(as_bytes(t)) for t in own[at : at + 1000]]
                values, n = np.unique(np.concatenate(part), return_counts=True)
                yield pa.record_batch(
                    [pa.array([lang] * len(values), pa.string()), pa.array(values.astype(np.int64)), pa.array(n)],
                    names=["lang", "gram", "n"],
                )


def counted_contexts(docs: DataFrame) -> DataFrame:
    """lang, size (of the context), context, byte, n for the contexts that are kept.

    Longest contexts are counted in the texts; a shorter one is the sum of those
    that end in it.
    """
    rows = docs.select("lang", F.coalesce("text", F.lit("")).alias("text")).where(
        F.col("lang").isNotNull()
    )
    longest = stored(
        rows.mapInArrow(_count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n")),
        "grams",
    )
    sizes = F.explode(F.array(*[F.lit(k) for k in range(ORDER + 1)]))
    tails = F.element_at(F.array(*[F.lit((1 << 8 * (k + 1)) - 1) for k in range(ORDER + 1)]), F.col("size") + 1)
    each = (
        longest.select("lang", "gram", "n", sizes.alias("size"))
        .select("lang", "size", F.col("gram").bitwiseAND(tails).alias("tail"), "n")
        .groupBy("lang", "size", "tail")
        .agg(F.sum("n").alias("n"))
        .select(
            "lang",
            "size",
            F.shiftright("tail", 8).alias("context"),
            F.col("tail").bitwiseAND(F.lit(255)).cast("int").alias("byte"),
            "n",
        )
    )
    each = stored(each, "contexts")
    totals = longest.groupBy("lang").agg(F.sum("n").alias("bytes"))
    kept = (
        each.groupBy("lang", "size", "context")
        .agg(F.sum("n").alias("seen"))
        .join(F.broadcast(totals), "lang")  # a row per language
        .where(F.col("seen") * (1 << KEEP_BITS) >= F.col("bytes"))
        .select("lang", "size", "context")
    )
    return each.join(kept, ["lang", "size", "context"])


@dataclass
class Model:
    """Frozen code lengths.

    `state` finds the longest kept context of the bytes before, in any language;
    `cost` has the bits of each next byte in it, per language.
    """

    langs: list[str]
    rank: np.ndarray  # byte -> number among the bytes that occur, 0 for the others
    width: int
    state: np.ndarray  # three ranks -> row of cost
    cost: np.ndarray  # row, byte, language

    def bits(self, raw: bytes) -> np.ndarray:
        """Code length of a text in every language."""
        total = np.zeros(len(self.langs))
        for at in range(0, len(raw), 1 << 20):
            part = np.frombuffer((_PAD + raw)[at : at + (1 << 20) + ORDER], np.uint8)
            r = self.rank[part]
            where = self.state[(r[:-3] * self.width + r[1:-2]) * self.width + r[2:-1]]
            total += self.cost[where, part[ORDER:]].sum(0, dtype=np.float64)
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return "und", 0.0
        bits = self.bits(as_bytes(text))
        best = int(bits.argmin())
        return self.langs[best], float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum())


def model_of(rows: pd.DataFrame) -> Model:
    """The model of counted contexts; as many rows as KEEP_BITS and the languages allow."""
    langs = sorted(rows["lang"].unique())
    if not langs:
        return Model([], np.zeros(256, np.int64), 1, np.zeros(1, np.int32), np.zeros((1, 256, 0)))
    tables: dict[str, list[dict[int, np.ndarray]]] = {}
    for lang, own in rows.groupby("lang"):
        tables[lang] = per_size = [{} for _ in range(ORDER + 1)]
        for (size, context), seen in own.groupby(["size", "context"]):
            counts = np.zeros(256)
            counts[seen["byte"].to_numpy()] = seen["n"].to_numpy()
            per_size[size][context] = counts

    def code(lang: str, context: int, size: int) -> np.ndarray:
        """Probability of each byte after the last `size` bytes of a context."""
        p = np.full(256, 1 / 256)
        for k in range(size + 1):
            counts = tables[lang][k].get(context & ((1 << 8 * k) - 1))
            if counts is None:
                break  # no longer context can be there either
            total, kinds = counts.sum(), np.count_nonzero(counts)
            p = np.where(counts > 0, counts, kinds * p) / (total + kinds)
        return p

    used = sorted({b for x in rows["context"].unique() for b in (x & 255, x >> 8 & 255, x >> 16)})
    rank = np.zeros(256, np.int64)
    rank[used] = np.arange(1, len(used) + 1)
    width = len(used) + 1
    state = np.zeros((width,) * ORDER, np.int32)
    cost = [np.stack([-np.log2(code(x, 0, 0)) for x in langs], 1)]
    for size in range(1, ORDER + 1):  # longer contexts over shorter ones
        for context in sorted(set().union(*[tables[x][size] for x in langs])):
            at = tuple(rank[context >> 8 * k & 255] for k in reversed(range(size)))
            state[(slice(None),) * (ORDER - size) + at] = len(cost)
            cost.append(np.stack([-np.log2(code(x, context, size)) for x in langs], 1))
    return Model(langs, rank, width, state.ravel(), np.stack(cost).astype(np.float32))


def train(docs: DataFrame) -> Model:
    return model_of(counted_contexts(docs).toPandas())


def predicted(docs: DataFrame, model: Model, *keep: Column) -> DataFrame:
    """The columns asked for, lang_pred and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(*keep, F.col("text").alias("_fl_text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.predict(t.as_py()) for t in batch.column("_fl_text")]
            rest = batch.drop_columns(["_fl_text"])
            yield pa.RecordBatch.from_arrays(
                [
                    *rest.columns,
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                ],
                names=[*rest.schema.names, "lang_pred", "score"],
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema if f.name != "_fl_text"]
    return slim.mapInArrow(score, ", ".join([*fields, "lang_pred string", "score double"]))
