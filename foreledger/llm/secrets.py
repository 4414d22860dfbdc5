"""Secret scans over an incremental ledger of blobs.

A version of a text is addressed by the SHA-256 of its UTF-8 bytes. The ledger
holds the findings of every (blob, rule version) pair scanned so far, so a scan
reads the texts of unseen pairs alone, each once however many paths and
versions share it, and joins the findings back to all paths.

Null text is the empty blob. Rows with a null id or a repeated id are answered
like any other row. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULE_VERSION = "2"

# fixed values: the base patterns
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # runs of 32 or more; a shorter run holds no longer one

# what any assignment contains, to pass over texts without
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

# a key block begins and ends with such a line
_KEY_BEGIN = re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----")
_KEY_END = re.compile(r"-----END [A-Z ]{0,40}PRIVATE KEY-----")

# further kinds: a plain string every match contains, and the pattern
_MORE = (
    ("jwt", "eyJ", re.compile(
        r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    ("forge_token", "gh", re.compile(r"\bgh[pousr]_[A-Za-z0-9]{36,}")),
    ("chat_token", "xox", re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{10,}")),
    ("url_password", "://", re.compile(
        r"\b[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:[^\s/:@]{3,64}@[A-Za-z0-9.-]+")),
)
KINDS = ("assign", "access", "hex", "private_key", *(name for name, _, _ in _MORE))

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end

_FINDINGS = pa.schema(
    [
        ("blob", pa.string()),
        ("n_assign", pa.int64()),
        ("n_access", pa.int64()),
        ("n_hex", pa.int64()),
        ("base_sha256", pa.string()),
        ("spans", pa.string()),
    ]
)
_DDL = (
    "blob string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
)


def base_spans(text: str) -> list[Span]:
    lower = text.lower()
    found = []
    # lower() may change letters outside ASCII, never drop an ASCII name
    if any(name in lower for name in _NAMES):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def key_blocks(text: str) -> list[Span]:
    """Each begin line outside a block with the next end line; every line is looked at once."""
    found, ends, closed = [], None, 0
    for begin in _KEY_BEGIN.finditer(text):
        if begin.start() < closed:
            continue
        if ends is None:
            ends = [(m.start(), m.end()) for m in _KEY_END.finditer(text)]
        at = bisect_left(ends, (begin.end(), 0))
        if at == len(ends):
            break
        closed = ends[at][1]
        found.append((begin.start(), 3, closed))
    return found


def more_spans(text: str) -> list[Span]:
    blocks = key_blocks(text) if "-----BEGIN " in text else []
    return blocks + [
        (m.start(), place, m.end())
        for place, (_, needle, pattern) in enumerate(_MORE, start=4)
        if needle in text
        for m in pattern.finditer(text)
    ]


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def finding(text: str) -> tuple[int, int, int, str, str]:
    base = base_spans(text)
    per_kind = [sum(kind == k for _, kind, _ in base) for k in range(3)]
    digest = hashlib.sha256(listed(base).encode()).hexdigest()
    return (*per_kind, digest, listed(sorted(base + more_spans(text))))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blobs, texts = batch.column("blob").to_pylist(), batch.column("text").to_pylist()
        rows = [(blob, *finding(text)) for blob, text in zip(blobs, texts, strict=True)]
        columns = zip(*rows, strict=True) if rows else [[] for _ in _FINDINGS]
        yield pa.record_batch([list(c) for c in columns], schema=_FINDINGS)


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def scan_unseen(versions: DataFrame, ledger: DataFrame | None, key: str, text: str) -> DataFrame:
    """Ledger rows of the blobs in `versions` that this rule version has not scanned.

    The addresses are reduced to one carrier per unseen blob first, over ids and
    digests alone; only the carriers' texts are then moved to be scanned. `key`
    tells rows apart; where rows share one, or it is null, a blob may be read
    more than once, which changes nothing but the work.
    """
    addressed = versions.select(
        F.col(f"`{key}`").alias("key"), blob_of(F.col(f"`{text}`")).alias("blob")
    )
    carriers = addressed.groupBy("blob").agg(F.min("key").alias("key"))
    if ledger is not None:
        seen = ledger.where(F.col("rule_version") == RULE_VERSION).select("blob").distinct()
        carriers = carriers.join(seen, "blob", "left_anti")
    texts = versions.select(
        F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    ).withColumn("own", blob_of(F.col("text")))
    due = carriers.alias("c")
    unseen = texts.alias("t").join(
        due, F.col("t.key").eqNullSafe(F.col("c.key")) & (F.col("t.own") == F.col("c.blob"))
    )
    found = unseen.select("c.blob", "t.text").mapInArrow(_scan, _DDL)
    return found.dropDuplicates(["blob"]).withColumn("rule_version", F.lit(RULE_VERSION))


def findings_by_path(versions: DataFrame, ledger: DataFrame, key: str, text: str) -> DataFrame:
    """Every path of `versions` with the findings of its blob."""
    known = ledger.where(F.col("rule_version") == RULE_VERSION).dropDuplicates(["blob"])
    paths = versions.select(
        F.col(f"`{key}`").alias("_fl_path"), blob_of(F.col(f"`{text}`")).alias("blob")
    )
    return paths.join(known, "blob").select(
        F.col("_fl_path").alias(key),
        *[c for c in known.columns if c not in ("blob", "rule_version")],
        "blob",
        "rule_version",
    )
