"""Language-model scores from a probabilistic suffix tree over all words.

Symbols are all words and the end of a text. A context is the one or two words
before a symbol (or the start of the text). A context seen at least twice becomes
a state if its next symbols differ from what the shorter context predicts by more
than describing them costs (counted divergence against half a logarithm for each
different symbol). A state's counts are smoothed with the shorter context's
distribution, down to that of single words; a text is scored in the longest state
each time. Nothing is cut by a share of the corpus: states and successors grow
with it.

The tree is never at hand as a whole. Texts form portions of rows; a portion sends
each n-gram it holds once, as sorted hashes in packets dealt by range of the hash,
so a frequent n-gram costs one entry in a portion. The counts that are not plain
from the portion itself come back to it, written by portion, and a task reads those
of its own portions only. The sums of the divergence test travel the same way.

Words are told apart by 63 bits. N-grams are told apart by `SPARE_BITS` more bits
than the corpus' size has, so one in 2^`SPARE_BITS` shares the counts of another.

Null is the empty text, which has the end as its only token. A null `training`
counts as true; repeated rows are rows like others. Only the columns asked for,
the text and `training` are read. With no training text every token has
probability one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby, pairwise
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foreledger.llm.common import filesystem, run_dir, shuffles_freed, stored

PORTION_BYTES = 16 << 20
PIECE_BYTES = 64 << 20
SCORED_BYTES = 4 << 20  # texts scored at a time
HASHED_ROWS = 1024  # texts split at a time
BUCKET_BYTES = 16 << 20
SPARE_BITS = 16
SMOOTHING = (4.0, 2.0)  # weight of the shorter context, for states of one and two words
LEAST_SEEN = 2
UNIT = 256  # the divergence is summed in whole parts of this
END = b""  # no word is empty
WORD_BITS = 63  # one bit is left for a flag when keys are sorted
START = np.uint64(0x1E3779B97F4A7C15)
_PAIR, _TRIPLE = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def symbols_of(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, each text followed by the end, and the tokens of each."""
    flat = pc.fill_null(texts, "").combine_chunks()
    if isinstance(flat, pa.ChunkedArray):  # a table without rows, or chunks too large to join
        flat = pa.concat_arrays([c.cast(pa.large_string()) for c in flat.chunks])
    lists = pc.ascii_split_whitespace(pc.ascii_lower(flat))
    words, count = lists.flatten(), pc.list_value_length(lists).to_numpy()
    blank = pc.equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if blank.any():  # from white space at the ends of a text
        owner = np.repeat(np.arange(len(count)), count)
        count = count - np.bincount(owner[blank], minlength=len(count))
        words = words.filter(pa.array(~blank))
    sizes = count.astype(np.int64) + 1
    symbols = np.full(int(sizes.sum()), hashed(END), np.uint64)
    if len(words):
        own = words.dictionary_encode()
        distinct = own.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
        values = np.fromiter(map(hashed, distinct), np.uint64, len(distinct))
        inner = np.ones(len(symbols), bool)
        inner[np.cumsum(sizes) - 1] = False
        symbols[inner] = values[own.indices.to_numpy()]
    return symbols, sizes


def hashed(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) >> (64 - WORD_BITS)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers, in place."""
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x ^= x >> np.uint64(33)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(33)
    return x


@dataclass
class Positions:
    """Every token of some texts: its n-grams of one to three words and its contexts."""

    first: np.ndarray  # places at which the texts start
    train: np.ndarray  # place -> whether it counts
    later: np.ndarray  # places that are not a text's first, which have two-word contexts
    grams: list[np.ndarray]  # keys by size; those of three words for `later` alone
    before: np.ndarray  # the word before, START at the first

    @classmethod
    def of(cls, texts: pa.ChunkedArray, train: np.ndarray, bits: int) -> Positions:
        some = [symbols_of(texts.slice(i, HASHED_ROWS)) for i in range(0, len(texts), HASHED_ROWS)]
        symbols, sizes = (np.concatenate(x) for x in zip(*some, strict=True))
        pa.default_memory_pool().release_unused()
        first = np.cumsum(sizes) - sizes
        before = np.concatenate(([START], symbols[:-1]))
        before[first] = START
        rest = np.ones(len(symbols), bool)
        rest[first] = False
        later = np.flatnonzero(rest)
        pair = mixed(before * _PAIR + symbols)
        triple = pair[later - 1]
        triple *= _TRIPLE
        triple += symbols[later]
        mixed(triple)
        pair >>= np.uint64(64 - bits)
        triple >>= np.uint64(64 - bits)
        return cls(first, np.repeat(train, sizes), later, [symbols, pair, triple], before)


def pieces(batches: Iterator[pa.RecordBatch], most: int = PIECE_BYTES) -> Iterator[tuple[int, pa.Table]]:
    """Neighbouring rows of one portion, in pieces of bounded size."""
    held: list[pa.RecordBatch] = []
    at, room = None, 0
    for batch in batches:
        own = batch.column("_fl_portion").to_numpy()
        cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
        for a, b in pairwise(cuts):
            if a == b:
                continue
            if held and own[a] != at:
                yield at, pa.Table.from_batches(held)
                held, room = [], 0
            # some rows at a time, so that a piece may end within a portion
            for start in range(a, b, 256):
                part = batch.slice(start, min(256, b - start))
                if held and room > most:
                    yield at, pa.Table.from_batches(held)
                    held, room = [], 0
                at, room = int(own[a]), room + part.nbytes
                held.append(part)
    if held:
        yield at, pa.Table.from_batches(held)


def packed_planes(numbers: np.ndarray) -> bytes:
    """Unsigned numbers as planes of bytes, each compressed by itself, as plain if that is shorter.

    Together the planes would share one code, though some are random and some nearly constant.
    """
    planes = np.ascontiguousarray(numbers.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8).T)
    codec, sizes, parts = pa.Codec("zstd", 1), [len(numbers)], []
    for plane in planes:
        part = codec.compress(plane, asbytes=True) if plane.any() else b""
        parts.append(part if len(part) < len(plane) else plane.tobytes())
        sizes.append(len(parts[-1]))
    return np.array(sizes, "<u4").tobytes() + b"".join(parts)


def unpacked_planes(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    n, *sizes = np.frombuffer(data, "<u4", 9).tolist()
    codec, at = pa.Codec("zstd"), 36
    planes = np.zeros((8, n), np.uint8)
    for plane, size in zip(planes, sizes, strict=True):
        part = data[at : at + size]
        at += size
        if size:
            plane[:] = np.frombuffer(part if size == n else codec.decompress(part, n), np.uint8)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers, the sign in the lowest bit so that high planes of small ones are empty."""
    numbers = numbers.astype(np.int64, copy=False)
    return packed_planes(((numbers << 1) ^ (numbers >> 63)).view(np.uint64))


def unpacked(data: bytes) -> np.ndarray:
    folded = unpacked_planes(data)
    return (folded >> np.uint64(1)).view(np.int64) ^ -(folded & np.uint64(1)).view(np.int64)


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences."""
    return packed_planes(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked_planes(data), dtype=np.uint64)


def borders(keys: np.ndarray) -> np.ndarray:
    """Where each distinct one of the sorted keys begins."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of the values at each."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = borders(keys)
    return keys[starts], np.add.reduceat(values[order], starts) if len(starts) else values[:0]


def tallied(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys; twice the number in training rows, and one more where another row has it."""
    flagged = keys << np.uint64(1)
    flagged |= ~train
    flagged.sort()
    starts = borders(flagged)
    times = np.diff(starts, append=len(flagged))
    flagged = flagged[starts]
    number = np.where(flagged & np.uint64(1), 1, 2 * times)
    flagged >>= np.uint64(1)
    starts = borders(flagged)
    return flagged[starts], np.add.reduceat(number, starts) if len(starts) else number


PACKET = "portion long, size int, bucket int, keys binary, numbers binary"
REPLY = "size int, keys binary, numbers binary, portion long"


def rows(schema: str, values: list[tuple]) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*values, strict=True)) if values else [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), types[t]) for c, (_, t) in zip(columns, fields, strict=True)],
        names=[n for n, _ in fields],
    )


@dataclass
class Plan:
    """What follows from the corpus' size: bits of an n-gram's key, and buckets (a power of two)."""

    bits: int
    bucket_bits: int

    def width(self, size: int) -> int:
        """Bits of the keys of n-grams of so many words."""
        return WORD_BITS if size == 1 else self.bits

    def packets(self, portion: int, size: int, keys: np.ndarray, numbers: np.ndarray) -> list[tuple]:
        bucket = (keys >> np.uint64(self.width(size) - self.bucket_bits)) if self.bucket_bits else keys * 0
        cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(keys)]
        return [
            (portion, size, int(bucket[a]), packed_keys(keys[a:b]), packed(numbers[a:b]))
            for a, b in pairwise(cuts)
            if a < b
        ]


def gathered(table: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray, list[int], np.ndarray]:
    """Portions, keys and numbers of packets, where each ends, and the place of each key among the distinct."""
    parts = [unpacked_keys(k.as_py()) for k in table["keys"]]
    ends = np.cumsum([0, *map(len, parts)]).tolist()
    numbers = np.concatenate([unpacked(n.as_py()) for n in table["numbers"]])
    keys = np.concatenate(parts)
    _, place = np.unique(keys, return_inverse=True)
    return table["portion"].to_pylist(), keys, numbers, ends, place


def count_packets(plan: Plan):
    """Each n-gram of a portion once: twice its training count, and one more where a row to score alone has it."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion, piece in pieces(batches):
            train = piece["_fl_train"].to_numpy()
            at = Positions.of(piece["_fl_text"], train, plan.bits)
            for size, keys in enumerate(at.grams, start=1):
                own = at.train if size < 3 else at.train[at.later]
                yield rows(PACKET, plan.packets(portion, size, *tallied(keys, own)))

    return emit


def count_replies(table: pa.Table) -> pa.Table:
    """Counts a portion cannot tell by itself; for portion -1 the distinct n-grams and the total."""
    portions, keys, numbers, ends, place = gathered(table)
    size = table["size"][0].as_py()
    total = np.bincount(place, numbers >> 1).astype(np.int64)
    each = total[place]
    send = (each >= 2) | ((each == 1) & (numbers & 1 == 1))
    made = [(size, b"", packed(np.array([np.count_nonzero(total), total.sum()])), -1)]
    for portion, (a, b) in zip(portions, pairwise(ends), strict=True):
        own = send[a:b]
        if own.any():
            made.append((size, packed_keys(keys[a:b][own]), packed(each[a:b][own]), portion))
    return pa.Table.from_batches([rows(REPLY, made)])


def state_replies(table: pa.Table) -> pa.Table:
    """The contexts that do not become states, which are few, for each portion that has them."""
    portions, keys, numbers, ends, place = gathered(table)
    total = np.zeros(place.max() + 1, np.int64)
    np.add.at(total, place, numbers)
    refused = total[place] < 0
    size = table["size"][0].as_py()
    made = []
    for portion, (a, b) in zip(portions, pairwise(ends), strict=True):
        own = refused[a:b]
        if own.any():
            made.append((size, packed_keys(keys[a:b][own]), b"", portion))
    return pa.Table.from_batches([rows(REPLY, made)])


def answered(packets: DataFrame, replies, label: str) -> str:
    """The folder of the replies, by portion.

    Written before they are dealt, so that the disk never holds the packets' shuffle and both copies.
    """
    spark = packets.sparkSession
    folder = run_dir(spark, label)
    with shuffles_freed(spark):
        made = stored(packets.groupBy("size", "bucket").applyInArrow(replies, REPLY), f"{label}-made")
        made.repartition("portion").write.partitionBy("portion").parquet(folder)
    return folder


def replies_of(folder: str, portion: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Size to sorted keys and numbers, of one portion."""
    from pyarrow import fs

    where, path = filesystem(folder)
    found: dict[int, tuple[list, list]] = {}
    choice = fs.FileSelector(f"{path}/portion={portion}", allow_not_found=True)
    for info in where.get_file_info(choice):
        if not info.base_name.endswith(".parquet"):
            continue
        with where.open_input_file(info.path) as source:
            table = pq.ParquetFile(source).read()
        for row in table.to_pylist():
            keys, numbers = found.setdefault(row["size"], ([], []))
            keys.append(unpacked_keys(row["keys"]))
            numbers.append(unpacked(row["numbers"]))
    whole = {}
    for size, (keys, numbers) in found.items():
        joined = np.concatenate(keys)
        order = np.argsort(joined)
        values = np.concatenate(numbers)
        whole[size] = joined[order], values[order] if len(values) else values
    return whole


def place_in(table: np.ndarray, keys: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each key its place in the sorted table, and whether it is there.

    Keys are spread evenly over `width` bits, so their first bits lead within a few places.
    """
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    lead = len(table).bit_length()
    shift = np.uint64(width - lead)
    sizes = np.bincount((table >> shift).view(np.int64), minlength=1 << lead)
    begin = np.cumsum(sizes) - sizes
    closed = np.append(table, np.uint64((1 << 64) - 1))
    place = begin[(keys >> shift).view(np.int64)]
    behind = np.flatnonzero(closed[place] < keys)
    while len(behind):
        place[behind] += 1
        behind = behind[closed[place[behind]] < keys[behind]]
    there = closed[place] == keys
    return np.minimum(place, len(table) - 1), there


_NOTHING = (np.zeros(0, np.uint64), np.zeros(0, np.int64))


@dataclass
class Model:
    """Where the counts and the contexts that are no states are, and the totals."""

    plan: Plan
    total: int  # training tokens
    distinct: int
    texts: int  # training texts
    divergence: float
    counts: str
    refused: str = ""

    def counted(self, at: Positions, found: dict) -> list[np.ndarray]:
        """Training counts of the n-grams of every position."""
        counts = []
        for size, keys in enumerate(at.grams, start=1):
            table, numbers = found.get(size, _NOTHING)
            # what did not come back is once in the training texts, if in a training row
            n = (at.train if size < 3 else at.train[at.later]).astype(np.int64)
            place, there = place_in(table, keys, self.plan.width(size))
            n[there] = numbers[place[there]]
            counts.append(n)
        return counts

    def seen(self, at: Positions, counts: list[np.ndarray]) -> list[np.ndarray]:
        """How often the contexts of one and two words occur in the training texts."""
        one = np.concatenate(([0], counts[0][:-1]))
        one[at.first] = self.texts
        return [one, counts[1][at.later - 1]]

    def single(self, counts: list[np.ndarray]) -> np.ndarray:
        return (counts[0] + 1) / (self.total + self.distinct + 1)

    def contexts(self, at: Positions) -> list[np.ndarray]:
        return [at.before, at.grams[1][at.later - 1]]

    def told(self, at: Positions, found: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Size, contexts seen often enough, and the divergence less its cost summed at each."""
        counts = self.counted(at, found)
        seen = self.seen(at, counts)
        shorter = self.single(counts)
        for size, keys in enumerate(self.contexts(at), start=1):
            train = at.train
            if size == 2:
                shorter, train = shorter[at.later], train[at.later]
            n, often = counts[size], seen[size - 1]
            told = np.zeros(len(n), np.int64)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.log(n / (often * shorter)) - self.divergence * np.log(often + 1) / n
                told[train] = np.rint(gain[train] * UNIT)
            often_enough = often >= LEAST_SEEN
            yield size, *summed(keys[often_enough], told[often_enough])
            shorter = self.smoothed(size, n, often, shorter, often_enough)

    def smoothed(
        self, size: int, n: np.ndarray, often: np.ndarray, shorter: np.ndarray, state: np.ndarray
    ) -> np.ndarray:
        weight = SMOOTHING[size - 1]
        return np.where(state, (n + weight * shorter) / (often + weight), shorter)

    def logs(self, at: Positions, found: dict, refused: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every position its word's count, and both logarithms: of single words and of the tree."""
        counts = self.counted(at, found)
        seen = self.seen(at, counts)
        single = self.single(counts)
        p = single.copy()
        for size, keys in enumerate(self.contexts(at), start=1):
            state = seen[size - 1] >= LEAST_SEEN
            often = np.flatnonzero(state)
            state[often] = ~place_in(refused.get(size, _NOTHING)[0], keys[often], self.plan.width(size))[1]
            where = slice(None) if size == 1 else at.later
            p[where] = self.smoothed(size, counts[size], seen[size - 1], p[where], state)
        return counts[0], np.log10(single), np.log10(p)


def located(docs: DataFrame, training: Column, per_portion: int, *keep: Column) -> DataFrame:
    """The columns asked for, the text, whether a row counts, and its portion.

    Portions are rows that lie together in a file.
    """
    meta = docs.metadataColumn("_metadata")
    portion = F.xxhash64(meta["file_path"], F.floor(meta["row_index"] / per_portion)).bitwiseAND(
        F.lit((1 << 62) - 1)
    )
    return docs.select(
        *keep,
        F.col("text").alias("_fl_text"),
        F.coalesce(training, F.lit(True)).alias("_fl_train"),
        portion.alias("_fl_portion"),
    )


def in_files(docs: DataFrame) -> DataFrame:
    """`docs` if its rows still have a place in a file, otherwise written to files."""
    try:
        docs.select(docs.metadataColumn("_metadata")["row_index"])
    except AnalysisException:
        return stored(docs, "lm-texts")
    return docs


def train(docs: DataFrame, training: Column, divergence: float = 0.5) -> tuple[Model, int]:
    """The tree of the training rows, with replies for all rows of `docs`, and rows in a portion.

    `docs` has to be in files (see `in_files`).
    """
    size = F.octet_length("text")
    n_rows, volume, texts = docs.agg(
        F.count("*"),
        F.coalesce(F.sum(size), F.lit(0)),
        F.count_if(F.coalesce(training, F.lit(True))),
    ).first()
    per_portion = max(1, n_rows * PORTION_BYTES // max(volume, 1))
    reach = int(volume + n_rows).bit_length()
    plan = Plan(min(WORD_BITS, max(48, reach + SPARE_BITS)), int(volume // BUCKET_BYTES).bit_length())
    slim = located(docs, training, per_portion)
    packets = slim.mapInArrow(count_packets(plan), PACKET)
    counts = answered(packets, count_replies, "lm-counts")
    spark = docs.sparkSession
    totals = [
        unpacked(bytes(r["numbers"]))
        for r in spark.read.schema(REPLY).parquet(counts).where("portion = -1 AND size = 1").collect()
    ]  # a pair of numbers from each bucket
    distinct, total = (int(sum(t[i] for t in totals)) for i in (0, 1))
    model = Model(plan, total, distinct, texts, divergence, counts)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion, own in groupby(pieces(batches, SCORED_BYTES), itemgetter(0)):
            found = replies_of(model.counts, portion)
            parts: dict[int, list] = {1: [], 2: []}
            for _, piece in own:
                counted = piece["_fl_train"].to_numpy()
                at = Positions.of(piece["_fl_text"], counted, model.plan.bits)
                for size, keys, sums in model.told(at, found):
                    parts[size].append((keys, sums))
            for size, some in parts.items():
                keys, sums = (np.concatenate(x) for x in zip(*some, strict=True))
                yield rows(PACKET, model.plan.packets(portion, size, *summed(keys, sums)))

    refused = answered(slim.mapInArrow(emit, PACKET), state_replies, "lm-refused")
    return Model(plan, total, distinct, texts, divergence, counts, refused), per_portion


def scored(docs: DataFrame, training: Column, *keep: Column, divergence: float = 0.5) -> DataFrame:
    """The columns asked for, n_tokens, n_known, train_tokens, base_score and score of every row.

    The tree learns from the rows that `training` marks.
    """
    docs = in_files(docs)
    model, per_portion = train(docs, training, divergence)
    slim = located(docs, training, per_portion, *keep)
    kept = [f for f in slim.schema if not f.name.startswith("_fl_")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for portion, piece in pieces(batches, SCORED_BYTES):
            if portion != last:
                found, refused = replies_of(model.counts, portion), replies_of(model.refused, portion)
                last = portion
            counted = piece["_fl_train"].to_numpy()
            at = Positions.of(piece["_fl_text"], counted, model.plan.bits)
            n, base, full = model.logs(at, found, refused)
            sizes = np.diff(at.first, append=len(n))
            out = piece.drop_columns(["_fl_text", "_fl_train", "_fl_portion"]).combine_chunks()
            made = [
                sizes.astype(np.int64),
                np.add.reduceat((n > 0).astype(np.int64), at.first),
                np.full(len(sizes), model.total, np.int64),
                np.add.reduceat(base, at.first),
                np.add.reduceat(full, at.first),
            ]
            names = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
            for name, values in zip(names, made, strict=True):
                out = out.append_column(name, pa.array(values))
            yield from out.to_batches()

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
    outputs = "n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return slim.mapInArrow(score, ", ".join([*fields, outputs]))
