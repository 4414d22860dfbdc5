"""What the operators share: the shared folder, word splitting, hold-out remainders, files."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foreledger.session import materialize, shared_dir

# white space that separates words: blank and 9 to 13
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def run_dir(spark: SparkSession, label: str) -> str:
    """A new folder that driver and executors share."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that tasks can import it."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    # on the driver's own disk, from where it serves the archive as long as it runs
    archive = f"{tempfile.mkdtemp()}/{package.name}-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, f"{package.name}/{file.relative_to(package)}")
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(application)


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared folder and read back: survives lost executors."""
    return materialize(df, label)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within, a query's shuffle files are dropped as it ends, not when the driver next collects garbage.

    For writes only: a frame run again after this would have to shuffle anew.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def words_of(text: Column) -> Column:
    """Array of the words of a text; no words for a null or blank one."""
    inner = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(inner) > 0, F.split(inner, SPACE_RUN)).otherwise(
        F.array().cast("array<string>")
    )


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text modulo `mod`; -1 for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(mod)), F.lit(-1))


def filesystem(uri: str):
    """The file system of a URI and the path within it, for code that runs in tasks."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, data: bytes) -> None:
    """Write one file so that it is there whole or not at all.

    The bytes go to a name of this attempt's own and are then renamed, so a
    repeated or speculative task leaves the same file.
    """
    where, path = filesystem(uri)
    where.create_dir(os.path.dirname(path), recursive=True)
    own = f"{os.path.dirname(path)}/.{os.path.basename(path)}.{uuid.uuid4().hex}"
    with where.open_output_stream(own) as out:
        out.write(data)
    where.move(own, path)
