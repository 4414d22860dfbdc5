"""Token ids in files: ids ranked by frequency, variable-length bytes, control bytes apart.

An id is replaced by its rank in the corpus, so the commonest 256 take one byte.
A control byte holds the lengths of four ranks in two bits each; all control
bytes of a file come before its data bytes, so numpy decodes by looking up, for
each control byte, which of 16 output bytes are there.

A file holds a run of documents in the order asked for (ascending id, null ids
first), and files follow each other by name. Null and empty text give the end id
alone. Repeated ids are each written, ties in the order of their ids. Only the
columns asked for are read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foreledger.llm.common import run_dir, stored, write_file

END_ID = 2
IDS_PER_FILE = 4 << 20
MAGIC = b"FRVB0001"
BLOCK = 1 << 20  # ids coded at a time, a multiple of four

# Text of these characters alone is split here as the tokenizer splits it: lower
# case and composed form change one character into one, and words end at blanks.
_PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ]*")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
_TRIED = ["the", "zqxjk", "7", "...", "'s", "internationalisation", "~", "$%"]
_MARKS = frozenset(".,;:!?")
_MAX_CACHED = 1_200_000


def _cut(word: str) -> tuple[str, str] | list[str]:
    """Pieces of a word; letters with one mark after them need no pattern."""
    if word[-1] in _MARKS and word[:-1].isalpha():
        return word[:-1], word[-1]
    return _PIECE.findall(word)


class Encoder:
    """Ids of texts. Words and pieces seen before come from caches; new pieces go to the tokenizer.

    New pieces are tokenized as one text. The vocabulary marks the last token of
    a piece, which tells the pieces apart again. Where the model alone gives the same
    ids for ASCII pieces, which is tried on a few, those go to it directly.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.ends = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[i] = token.endswith("</w>")
        self.pieces: dict[str, bytes] = {}  # and whole words
        self.direct = self.model_parts(_TRIED) == [self.ids(p).tobytes() for p in _TRIED]

    def model_parts(self, new: list[str]) -> list[bytes]:
        """Ids of pieces from the model alone."""
        tokenize, code = self.tokenizer.model.tokenize, self.dtype.char
        return [array(code, [t.id for t in tokenize(p)]).tobytes() for p in new]

    def ids(self, text: str) -> np.ndarray:
        coded = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(coded, self.dtype)

    def learn_pieces(self, new: list[str]) -> None:
        if self.direct:
            plain = [p for p in new if p.isascii()]
            self.pieces.update(zip(plain, self.model_parts(plain), strict=True))
            new = [p for p in new if not p.isascii()]
        if not new:
            return
        ids = self.ids(" ".join(new))
        raw, size = ids.tobytes(), ids.itemsize
        ends = ((np.flatnonzero(self.ends[ids]) + 1) * size).tolist()
        if len(ends) == len(new):
            parts = [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        else:  # a vocabulary without word ends
            parts = [self.ids(p).tobytes() for p in new]
        self.pieces.update(zip(new, parts, strict=True))

    def learn_words(self, split: list[list[str]]) -> None:
        """A word without marks is a piece itself; the others are joined from their pieces."""
        if len(self.pieces) > _MAX_CACHED:
            self.pieces.clear()
        new = set(chain.from_iterable(split)).difference(self.pieces)
        rest = [w for w in new if not w.isalpha()]
        cut = list(map(_cut, rest))
        fresh = new.difference(rest)
        fresh.update(set(chain.from_iterable(cut)).difference(self.pieces))
        self.learn_pieces(list(fresh))
        known = self.pieces.__getitem__
        self.pieces.update(zip(rest, [b"".join(map(known, c)) for c in cut], strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [_PLAIN.fullmatch(t) is not None and "<|" not in t for t in texts]
        split = [t.lower().split() if p else [] for t, p in zip(texts, plain, strict=True)]
        self.learn_words(split)
        known = self.pieces.__getitem__
        return [
            b"".join(map(known, words)) if p else self.ids(t).tobytes()
            for t, p, words in zip(texts, plain, split, strict=True)
        ]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker and vocabulary, so that the cache outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _groups(texts: pa.Array, most_chars: int = 2_000_000) -> Iterator[tuple[int, list[str]]]:
    start, group, chars = 0, [], 0
    for i, text in enumerate(texts):
        group.append(text.as_py() or "")
        chars += len(group[-1])
        if chars >= most_chars:
            yield start, group
            start, group, chars = i + 1, [], 0
    if group:
        yield start, group


def tokenized(docs: DataFrame, path: str, order: Column, end_id: int = END_ID) -> DataFrame:
    """ord, doc_id and ids (bytes, the end id included) of every row."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        end = np.array([end_id], coder.dtype).tobytes()
        for batch in batches:
            for start, texts in _groups(batch.column("text")):
                ids = pa.array([x + end for x in coder.encode(texts)], pa.binary())
                part = batch.slice(start, len(texts))
                yield pa.record_batch(
                    [part.column("ord"), part.column("doc_id"), ids], names=["ord", "doc_id", "ids"]
                )

    slim = docs.select(
        order.alias("ord"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text")
    )
    kind = slim.schema["ord"].dataType.simpleString()
    return slim.mapInArrow(encode, f"ord {kind}, doc_id long, ids binary")


def frequencies(coded: DataFrame, dtype: str, size: int) -> DataFrame:
    """id and n of every id that occurs; each task counts into one array."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                total += np.bincount(np.frombuffer(ids.as_buffer(), dtype), minlength=size)
        there = np.flatnonzero(total)
        yield pa.record_batch([pa.array(there), pa.array(total[there])], names=["id", "n"])

    return coded.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n")
    )


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of ranks."""
    control, data = [], []
    for start in range(0, len(ranks), BLOCK):
        part = ranks[start : start + BLOCK].astype("<u4")
        part = np.pad(part, (0, -len(part) % 4))
        extra = (part >= 1 << 8).astype(np.uint8) + (part >= 1 << 16) + (part >= 1 << 24)
        codes = extra.reshape(-1, 4)
        control.append((codes << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8).tobytes())
        data.append(part.view(np.uint8)[_THERE[np.frombuffer(control[-1], np.uint8)].ravel()].tobytes())
    return b"".join(control), b"".join(data)


def _there() -> np.ndarray:
    """For each control byte, which of the 16 bytes of four ranks are stored."""
    codes = np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3
    return (np.arange(4) <= codes[:, :, None]).reshape(256, 16)


_THERE = _there()
_LENGTH = _THERE.sum(1)


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """Ranks from control and data bytes."""
    out, at = np.empty(n, np.uint32), 0
    for start in range(0, n, BLOCK):
        codes = control[start // 4 : (start + BLOCK) // 4]
        took = int(_LENGTH[codes].sum())
        full = np.zeros((len(codes), 16), np.uint8)
        full[_THERE[codes]] = data[at : at + took]
        at += took
        out[start : start + BLOCK] = full.reshape(-1).view("<u4")[: n - start]
    return out


def pack_file(doc_ids: list[int | None], lengths: list[int], ranks: np.ndarray) -> bytes:
    """A file: magic, counts, ids of the documents with a null flag, lengths, control, data."""
    control, data = pack(ranks)
    head = np.array([len(doc_ids), len(ranks), len(control), len(data)], "<u8")
    return b"".join(
        (
            MAGIC,
            head.tobytes(),
            np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
            np.array([x is None for x in doc_ids], "u1").tobytes(),
            np.array(lengths, "<u8").tobytes(),
            control,
            data,
        )
    )


def unpack_file(raw: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, lengths and ranks of a file."""
    if raw[:8] != MAGIC:
        raise ValueError("not a token file")
    docs, n, n_control, n_data = (int(x) for x in np.frombuffer(raw, "<u8", 4, 8))
    at = 40
    ids = np.frombuffer(raw, "<i8", docs, at)
    null = np.frombuffer(raw, "u1", docs, at + 8 * docs)
    lengths = np.frombuffer(raw, "<u8", docs, at + 9 * docs).astype(np.int64)
    control = np.frombuffer(raw, "u1", n_control, at + 17 * docs)
    data = np.frombuffer(raw, "u1", n_data, at + 17 * docs + n_control)
    shown = [None if gone else int(i) for i, gone in zip(ids, null, strict=True)]
    return shown, lengths, unpack(control, data, n)


def write_tokens(
    docs: DataFrame, path: str, folder: str, order: Column | None = None, end_id: int = END_ID
) -> DataFrame:
    """Tokenize, rank and write all rows. Returns the written manifest: path, documents, ids.

    The ids are kept once in between, since ranks need all of them counted. The
    codebook, which a vocabulary bounds, is the only thing the driver holds.
    """
    spark = docs.sparkSession
    coder = Encoder(path)
    size, dtype = max(len(coder.ends), end_id + 1), coder.dtype.str
    between = run_dir(spark, "token-ids")
    rows = tokenized(docs, path, F.col("doc_id") if order is None else order, end_id)
    rows.write.option("compression", "zstd").parquet(between)
    coded = spark.read.schema(rows.schema).parquet(between)

    counted = frequencies(coded, dtype, size).toPandas()
    best = counted.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy(np.int64)
    rank_of = np.zeros(size, np.uint32)
    rank_of[best] = np.arange(len(best), dtype=np.uint32)
    write_file(f"{folder}/codebook.u32", best.astype("<u4").tobytes())
    files = max(1, -(-int(counted["n"].sum()) // IDS_PER_FILE))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        docs, lengths, ranks, held, part = [], [], [], 0, 0

        def close() -> pa.RecordBatch:
            name = f"{folder}/part-{task:06d}-{part:04d}.frvb"
            write_file(name, pack_file(docs, lengths, np.concatenate(ranks)))
            return pa.RecordBatch.from_pydict(
                {"path": [name], "documents": [len(docs)], "ids": [held]}
            )

        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                mine = rank_of[np.frombuffer(ids.as_buffer(), dtype)]
                docs.append(doc)
                lengths.append(len(mine))
                ranks.append(mine)
                held += len(mine)
                if held >= IDS_PER_FILE:
                    yield close()
                    docs, lengths, ranks, held, part = [], [], [], 0, part + 1
        if docs:
            yield close()

    # in order, so that a repeated task makes the very same files
    ordered = coded.repartitionByRange(files, "ord").sortWithinPartitions("ord", "doc_id", "ids")
    written = ordered.select("doc_id", "ids").mapInArrow(
        write, "path string, documents long, ids long"
    )
    return stored(written, "token-manifest")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    binary = spark.read.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary"
    )
    books = binary.load(f"{folder}/codebook.u32").select("content").collect()  # one row
    # an empty file is not listed
    id_of = np.frombuffer(bytes(books[0][0]) if books else b"", "<u4")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, raw in zip(batch.column("path"), batch.column("content"), strict=True):
                docs, lengths, ranks = unpack_file(raw.as_buffer().to_pybytes())
                ids = id_of[ranks] if len(ranks) else ranks
                ends = np.cumsum(lengths)
                starts = ends - lengths
                sums = [zlib.crc32(ids[a:b].data) for a, b in zip(starts, ends, strict=True)]
                yield pa.record_batch(
                    [
                        pa.array([path.as_py()] * len(docs), pa.string()),
                        pa.array(docs, pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["path", "doc_id", "within", "n_tokens", "ids_crc32"],
                )

    files = binary.option("pathGlobFilter", "*.frvb").load(folder).select("path", "content")
    rows = stored(
        files.mapInArrow(
            decode, "path string, doc_id long, within long, n_tokens long, ids_crc32 long"
        ),
        "token-rows",
    )
    # a row per file, each of millions of ids
    totals = rows.groupBy("path").agg(F.sum("n_tokens").alias("n"))
    before = totals.selectExpr(
        "path",
        "coalesce(sum(n) OVER (ORDER BY path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
        " AS base",
    )
    return rows.join(before, "path").select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )
