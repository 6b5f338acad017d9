"""Shared helpers: the cluster's shared folder, cutting lineage, reading tables, words."""

from __future__ import annotations

import ctypes
import itertools
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Java patterns of the two kinds of word.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
LETTER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: bytes.translate tables after which bytes.split() yields the same words in UTF-8.
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
LETTER_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

_own_dir: list[str] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder below spark.checkpoint.dir, which the whole cluster sees.

    Where the setting is absent a temporary folder takes its place if the master is local; on a cluster, whose
    machines don't share one, that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _own_dir:
            _own_dir.append(tempfile.mkdtemp(prefix="sigforge-"))
        base = _own_dir[0]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Whether Spark (from 4.1) deletes a query's shuffle files as it ends, and not when the driver next collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}
#: On a local file system Hadoop starts a process for every file to set its rights, one more for a file of checksums beside it.
#: Here pages carry checksums, which are verified as they are read, so that the files beside them are left out.
_PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true", "parquet.page.write-checksum.enabled": "true"}
_VERIFIED = {"parquet.page.verify-checksum.enabled": "true"}


def materialize(df: DataFrame, name: str, lean: bool = False) -> DataFrame:
    """Write to the shared folder and read again: lineage is cut and a lost executor costs nothing.

    lean: more tightly packed, and the shuffle files of the writing don't outlast it.
    """
    path, conf = shared_dir(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    if lean:
        conf.set(_CLEANUP, "true")
    try:
        df.write.options(**_PLAIN_FILES, **(_PACKED if lean else {})).parquet(path)
    finally:
        if lean and before is None:
            conf.unset(_CLEANUP)
        elif lean:
            conf.set(_CLEANUP, before)
    out = df.sparkSession.read.options(**_VERIFIED).schema(df.schema).parquet(path)
    out._sigforge_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what materialize() wrote, once nothing reads it any more."""
    path = getattr(df, "_sigforge_path", None)
    if path:
        jvm = df.sparkSession._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        hadoop_path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(hadoop_path, True)


#: What a Python worker keeps from one task of a pass to the next.
kept: dict = {}


def in_arrow(df: DataFrame, run, schema, keeps: bool = False) -> DataFrame:
    """df.mapInArrow(run, schema) whose workers, which stay for later passes, hold on to no memory that they have freed.

    keeps: `kept` is for this pass; others clear it.
    """

    def tidy(batches):
        if not keeps:
            forget()
        try:
            yield from run(batches)
        finally:
            release()

    return df.mapInArrow(tidy, schema)


def forget() -> None:
    """Empty `kept`; a function of the module, as tasks get copies of the variables that they name themselves."""
    kept.clear()


def release() -> None:
    """Give back to the system what Arrow and the C library hold free."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


def fresh(columns, *names: str) -> list[str]:
    """The names, lengthened so that none is among the columns (case doesn't count)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; null is the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def chunks(items, size_of, most: int):
    """Lists of consecutive items of about `most` in total size; one larger item stands alone."""
    batch, total = [], 0
    for item in items:
        n = size_of(item)
        if batch and total + n > most:
            yield batch
            batch, total = [], 0
        batch.append(item)
        total += n
    if batch:
        yield batch


def rows_of(batches, columns):
    """Tuples of the named columns from Arrow record batches, a few rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            yield from zip(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in columns), strict=True)


def take(rows, n: int):
    rows = iter(rows)
    while part := list(itertools.islice(rows, n)):
        yield part
