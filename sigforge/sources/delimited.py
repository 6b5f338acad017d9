"""Delimited members of zip files: lines, rejects, headers, restartable loading."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tables

REJECTS = "source_zip string, source_txt string, file_type string, line_no int, expected_cols int, actual_cols int, raw_line string"
MANIFEST = "pipeline string, source_zip string, file_type string, status string, row_count int, rejected_count int"
#: Columns renamed by file type.
RENAMES = {"DEMO": {"gndr_cod": "sex"}, "DRUG": {"lot_nbr": "lot_num"}, "OUTC": {"outc_code": "outc_cod"}}


def zip_lines(spark: SparkSession, path: str, file_type: str) -> DataFrame:
    """source_zip, source_txt, line_no (from 1), raw_line of the first member of each zip file whose upper-case name has the type and ends in .TXT.

    Zips are read on the executors, a line at a time; undecodable bytes become replacement characters.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
                    member = next((m for m in z.namelist() if file_type in m.upper() and m.upper().endswith(".TXT")), None)
                    if member is None:
                        continue
                    rows = []
                    with z.open(member) as f:
                        for k, line in enumerate(f, 1):
                            rows.append((name.rsplit("/", 1)[-1], member, k, line.decode("utf-8", "replace").strip()))
                            if len(rows) == 10_000:
                                yield _rows(rows)
                                rows = []
                    if rows:
                        yield _rows(rows)

    return files.mapInArrow(run, "source_zip string, source_txt string, line_no int, raw_line string")


def _rows(rows):
    types = (pa.string(), pa.string(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["source_zip", "source_txt", "line_no", "raw_line"])


def classify(lines: DataFrame, header: list[str], legacy: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good, rejected) of lines (line_no, raw_line): fields split at $ as columns of the header, or with expected and actual number of fields.

    legacy: one trailing $ is dropped first. Empty lines are neither.
    """
    text = F.trim("raw_line")
    parts = F.split(F.regexp_replace(text, r"[$]$", "") if legacy else text, "[$]")
    marked = lines.filter(text != "").withColumn("_f", parts)
    fits = F.size("_f") == len(header)
    good = marked.filter(fits).select(*(F.get("_f", F.lit(i)).alias(c) for i, c in enumerate(header)), *(c for c in lines.columns if c.startswith("source_")))
    extra = [c for c in lines.columns if c not in ("line_no", "raw_line")]
    rejected = marked.filter(~fits).select(*extra, "line_no", F.lit(len(header)).alias("expected_cols"), F.size("_f").alias("actual_cols"), "raw_line")
    return good, rejected


def clean_name(name: str) -> str:
    return name.replace("﻿", "").strip().lower()


def harmonize(rows: DataFrame, columns: list[str], renames: dict[str, str] | None = None) -> DataFrame:
    """The columns of a table from a file's: names cleaned of byte order marks, spaces and case, renamed, missing ones null."""
    names = {(renames or {}).get(clean_name(c), clean_name(c)): c for c in rows.columns}
    return rows.select(*((F.col(f"`{names[c]}`") if c in names else F.lit(None)).cast("string").alias(c) for c in columns))


def unknown_columns(header: list[str], known: list[str], renames: dict[str, str] | None = None) -> list[str]:
    """Columns of a header that harmonize() would drop."""
    return sorted({(renames or {}).get(clean_name(c), clean_name(c)) for c in header} - set(known))


class Manifest:
    """State of each batch in a table of files: absent, in_progress, complete."""

    def __init__(self, spark: SparkSession, path: str, pipeline: str):
        self.spark, self.path, self.pipeline = spark, path, pipeline

    def rows(self) -> DataFrame:
        return self.spark.read.schema(MANIFEST + ", seq long").parquet(self.path)

    def status(self, source_zip: str, file_type: str) -> str | None:
        """The state written last."""
        try:
            found = self.rows().filter((F.col("pipeline") == self.pipeline) & (F.col("source_zip") == source_zip) & (F.col("file_type") == file_type))
            last = found.agg(F.max(F.struct("seq", "status")).alias("s")).first()["s"]
        except Exception as e:  # the first run has no table yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None
        return last and last["status"]

    def write(self, source_zip: str, file_type: str, status: str, row_count: int = 0, rejected_count: int = 0) -> None:
        seq = {"in_progress": 0, "complete": 1}[status]
        tables.append(self.spark.createDataFrame([(self.pipeline, source_zip, file_type, status, row_count, rejected_count, seq)], MANIFEST + ", seq long").coalesce(1), self.path)


def load(spark: SparkSession, zips: str, file_type: str, columns: list[str], out: str, rejects: str, manifest: Manifest, legacy: bool = False) -> int:
    """Load every zip below the glob that isn't complete; returns how many. A batch that broke off is loaded again:
    its partition is replaced, so nothing is there twice."""
    files = [r.path for r in spark.read.format("binaryFile").load(zips).select("path").orderBy(F.desc("path")).collect()]
    done = 0
    for path in files:
        name = path.rsplit("/", 1)[-1]
        if manifest.status(name, file_type) == "complete":
            continue
        manifest.write(name, file_type, "in_progress")
        lines = zip_lines(spark, path, file_type)
        head = lines.filter("line_no = 1").first()
        if head is None:
            continue
        good, bad = classify(lines.filter("line_no > 1"), head.raw_line.rstrip("$").split("$") if legacy else head.raw_line.split("$"), legacy)
        rows = harmonize(good, [*columns, "source_zip"], RENAMES.get(file_type))
        bad = bad.withColumn("file_type", F.lit(file_type))
        tables.replace_partitions(rows, out, "source_zip")
        tables.replace_partitions(bad, rejects, "source_zip")
        part = F.col("source_zip") == name
        manifest.write(name, file_type, "complete", spark.read.parquet(out).filter(part).count(), bad.count())
        done += 1
    return done
