"""Runs: stretches of words that repeat with a period, found through longest common extensions.

A run is a stretch with smallest period q, at least `LEAST` words and `TIMES` * q
words long, that no neighbouring word extends. Two words q apart are compared on a
harmonic grid: the multiples of q, or of `DENSE` where q is smaller. Every run holds
a grid point from which `DENSE` words in a row are equal to those q further on, so
only such points are extended, to both sides.

Extensions are answered by a difference cover: of each `v` neighbouring suffixes
only some are sorted, chosen so that any two positions reach two sorted
suffixes within the same number of words, less than v. Those words are compared
directly; from there the sparse table over the common lengths of neighbours in
the sorted order gives the whole blocks of v words that follow.

A task works on some 250,000 words at a time, texts joined by separators that are all
different, or on one longer text. Null and empty texts have no words and no run.
Repeated ids are each a row of their own. Only doc_id and text are read.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 24
TIMES = 3
DENSE = 8
COVER = 64  # v, a square
GROUP_WORDS = 250_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")

Words = Callable[[int | None, str], list[str]]


def plain_words(doc_id: int | None, text: str) -> list[str]:
    return _WORD.findall(text)


def planted_words(doc_id: int | None, text: str) -> list[str]:
    """Words of a text; in every tenth document, by its id's crc, a tail made periodic."""
    words = _WORD.findall(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[: n - a]


class Extensions:
    """Forward common extensions of a sequence of positive ids."""

    def __init__(self, seq: np.ndarray, v: int = COVER):
        self.v, self.n = v, len(seq)
        root = int(round(v**0.5))
        # every difference modulo v is a multiple of the root less a number below it
        cover = np.zeros(v, bool)
        cover[:root] = cover[::root] = True
        self.low = (-np.arange(v)) % root
        self.seq = np.concatenate([seq, np.zeros(2 * v + DENSE, np.int64)]).astype(">i4")
        places = np.flatnonzero(np.resize(cover, self.n))
        m = self.m = len(places)
        self.index = np.full(self.n + 1, m)
        self.index[places] = np.arange(m)
        blocks = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(self.seq, v)[places])
        _, first = np.unique(blocks.view(f"V{4 * v}").ravel(), return_inverse=True)
        levels = [np.append(first.ravel() + 1, 0)]  # 0: past the end
        while levels[-1].max(initial=0) < m:
            step = v << (len(levels) - 1)
            key = levels[-1][:m] * (m + 2) + levels[-1][self._at(places + step)]
            levels.append(np.append(np.unique(key, return_inverse=True)[1] + 1, 0))
        self.rank = levels[-1][:m] - 1
        order = np.empty(m, np.int64)
        order[self.rank] = np.arange(m)
        # blocks that neighbours in the order share
        a, b = places[order[:-1]], places[order[1:]]
        shared = np.zeros(max(0, m - 1), np.int32)
        for k in range(len(levels) - 1, -1, -1):
            left, right = levels[k][self._at(a)], levels[k][self._at(b)]
            same = ((left == right) & (left > 0)).astype(np.int64) << k
            shared += same.astype(np.int32)
            a, b = a + same * v, b + same * v
        self.table = [shared]
        while 2 << (len(self.table) - 1) <= len(shared):
            half = 1 << (len(self.table) - 1)
            last = self.table[-1]
            self.table.append(np.minimum(last[:-half], last[half:]))

    def _at(self, places: np.ndarray) -> np.ndarray:
        return self.index[np.minimum(places, self.n)]

    def _least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum of the shared blocks in [lo, hi)."""
        level = np.frexp((hi - lo).astype(float))[1] - 1
        out = np.empty(len(lo), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.table[k][lo[at]], self.table[k][hi[at] - (1 << int(k))])
        return out

    def _direct(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, at most `most`."""
        out = np.zeros(len(i), np.int64)
        open_ = np.flatnonzero(most > 0)
        while len(open_):
            t = out[open_]
            open_ = open_[self.seq[i[open_] + t] == self.seq[j[open_] + t]]
            out[open_] += 1
            open_ = open_[out[open_] < most[open_]]
        return out

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common extension of different positions, pair by pair."""
        i, j = np.minimum(i, j), np.maximum(i, j)
        meet = (self.low[(j - i) % self.v] - i) % self.v
        out = self._direct(i, j, meet)
        on = np.flatnonzero((out == meet) & (j + meet < self.n))
        a, b = i[on] + meet[on], j[on] + meet[on]
        left, right = self.rank[self.index[a]], self.rank[self.index[b]]
        whole = self._least(np.minimum(left, right), np.maximum(left, right)) * self.v
        rest = self._direct(a + whole, b + whole, np.full(len(on), self.v))
        out[on] += whole + rest
        return out


def _grid_points(seq: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods from which DENSE words repeat; texts are sorted by falling size."""
    padded = np.concatenate([seq, np.zeros(DENSE, seq.dtype)])
    longest = int(sizes[0]) if len(sizes) else 0
    places, periods = [], []
    # texts long enough for a period come first
    fitting = np.searchsorted(-sizes, -np.maximum(LEAST, TIMES * np.arange(longest // TIMES + 1)), "right")
    for p in range(1, longest // TIMES + 1):
        if not fitting[p]:
            break
        end = int(ends[fitting[p] - 1])
        step = max(p, DENSE)
        at = np.flatnonzero(padded[: end - p : step] == padded[p:end:step]) * step
        for c in range(1, DENSE):
            if not len(at):
                break
            at = at[at + c + p < end]
            at = at[padded[at + c] == padded[at + c + p]]
        if len(at):
            places.append(at)
            periods.append(np.full(len(at), p))
    none = [np.zeros(0, np.int64)]
    return np.concatenate(places or none), np.concatenate(periods or none)


def find_runs(texts: list[list[str]]) -> list[list[tuple[int, int, int]]]:
    """start, length and period of every run of each text, by start, then period."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    number: dict[str, int] = defaultdict()
    number.default_factory = lambda: len(number) + 1
    order = sorted((k for k, w in enumerate(texts) if len(w) >= LEAST), key=lambda k: -len(texts[k]))
    if not order:
        return found
    coded = [np.fromiter(map(number.__getitem__, texts[k]), np.int32, len(texts[k])) for k in order]
    top = len(number) + 1

    def joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(x) for x in parts])
        ends = np.cumsum(sizes + 1)
        seq = np.empty(ends[-1], np.int32)
        for x, end in zip(parts, ends.tolist(), strict=True):
            seq[end - 1 - len(x) : end - 1] = x
        seq[ends - 1] = top + np.arange(len(parts))
        return seq, ends, sizes

    seq, ends, sizes = joined(coded)
    at, period = _grid_points(seq, ends, sizes)
    if not len(at):
        return found
    # from here on only texts with a grid point
    owner = np.searchsorted(ends, at, "right")
    used = np.unique(owner)
    seq, ends, sizes = joined([coded[k] for k in used])
    new = np.searchsorted(used, owner)
    at = at - (np.append(0, np.cumsum([len(x) + 1 for x in coded]))[owner]) + (ends - sizes - 1)[new]
    forward, backward = Extensions(seq), Extensions(seq[::-1])
    n, rows = len(seq), []
    for k in range(0, len(at), 1 << 18):
        i, p = at[k : k + (1 << 18)], period[k : k + (1 << 18)]
        stop = i + p + forward(i, i + p)
        back = np.zeros(len(i), np.int64)
        inner = np.flatnonzero(i > 0)
        back[inner] = backward(n - i[inner], n - i[inner] - p[inner])
        start = i - back
        good = stop - start >= np.maximum(LEAST, TIMES * p)
        rows.append(np.stack([start, stop, p], 1)[good])
    every = np.concatenate(rows)
    every = every[np.lexsort(every.T[::-1])]
    first = np.ones(len(every), bool)  # multiples of a period give the same stretch
    first[1:] = (every[1:, :2] != every[:-1, :2]).any(1)
    every = every[first]
    owner = np.searchsorted(ends, every[:, 0], "right")
    begin = (ends - sizes - 1)[owner]
    for k, (start, stop, p), base in zip(used[owner].tolist(), every.tolist(), begin.tolist(), strict=True):
        found[order[k]].append((start - base, stop - start, p))
    for mine in found:
        mine.sort(key=lambda r: (r[0], r[2]))
    return found


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The text without what repeats the first period of a run."""
    if not runs:
        return " ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(change)[:-1] == 0)
    return " ".join([words[k] for k in kept.tolist()])


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def analysed(docs: DataFrame, words: Words = plain_words) -> DataFrame:
    """doc_id, n_words, runs and the collapsed text of every row."""
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held = [], [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids.append(doc_id.as_py())
                texts.append(words(ids[-1], text.as_py() or ""))
                held += len(texts[-1])
                if held >= GROUP_WORDS:
                    yield answer(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield answer(ids, texts)

    def answer(ids: list[int | None], texts: list[list[str]]) -> pa.RecordBatch:
        runs = find_runs(texts)
        shown = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in mine] for mine in runs]
        return pa.record_batch(
            [
                pa.array(ids, pa.int64()),
                pa.array([len(w) for w in texts], pa.int64()),
                pa.array(shown, kind),
                pa.array([collapse(w, r) for w, r in zip(texts, runs, strict=True)], pa.string()),
            ],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(work, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def digests(docs: DataFrame, words: Words = planted_words) -> DataFrame:
    """Per document the number of runs, the run that repeats most often, and digests of runs and text."""
    better = "r.length * best.period > best.length * r.period"
    best = F.expr(
        "aggregate(slice(runs, 2, greatest(size(runs) - 1, 0)), get(runs, 0),"
        f" (best, r) -> CASE WHEN {better} THEN r ELSE best END)"
    )
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return (
        analysed(docs, words)
        .withColumn("best", best)
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            F.col("best.start").alias("start"),
            F.col("best.length").alias("length"),
            F.col("best.period").alias("period"),
            F.expr("1000 * best.length div best.period").alias("exponent_milli"),
            F.sha2(lines, 256).alias("runs_sha256"),
            F.sha2("collapsed", 256).alias("collapsed_sha256"),
        )
    )
