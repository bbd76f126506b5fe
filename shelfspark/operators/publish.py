"""Tables whose contents change by one commit record.

A table folder holds data folders (``load=<id>``, one per write) and
``_commits/<number>.json``. A record lists the data files that make up the
table from then on, with the schema. Writers first write new data files, which
nobody reads yet, then create the next record; readers take the newest whole
record and read the files it lists. A writer that stops anywhere before its
record leaves the table as it was, one that stops after it has changed the
table whole. A record's number can be taken once: of two writers that started
from the same table the second is refused. Old files stay until ``vacuum``, so
a running reader or a plan that overwrites what it reads keeps its files.

Records also hold the number of the last batch of every stream that was merged
with them, so a replayed batch is recognised.

A folder without ``_commits`` is read as plain Parquet.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

COMMITS = "_commits"
LOAD = "load"


class CommitRefused(RuntimeError):
    """Another writer has committed since this one read the table."""


@dataclass(frozen=True)
class Commit:
    number: int
    files: tuple[str, ...]  # relative to the table's folder
    schema: StructType
    batches: dict[str, int] = field(default_factory=dict)  # stream -> last batch merged


def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, folder = file_system(spark, f"{path}/{COMMITS}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _record(spark: SparkSession, path: str, number: int) -> Commit | None:
    """The record, or None where its writer stopped while writing it."""
    fs, file = file_system(spark, f"{path}/{COMMITS}/{number:010d}.json")
    stream = fs.open(file)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        r = json.loads(text)
    except ValueError:
        return None
    return Commit(number, tuple(r["files"]), StructType.fromJson(r["schema"]), r["batches"])


def newest(spark: SparkSession, path: str) -> Commit | None:
    for n in reversed(_numbers(spark, path)):
        record = _record(spark, path, n)
        if record:
            return record
    return None


def is_published(spark: SparkSession, path: str) -> bool:
    """Whether the folder is one of commit records, be it without any yet."""
    fs, folder = file_system(spark, f"{path}/{COMMITS}")
    return fs.exists(folder)


def scan(spark: SparkSession, path: str, commit: Commit, files: Sequence[str] | None = None) -> DataFrame:
    """The rows of a commit, or of some of its files, as the file source gives them (with ``load`` and file metadata)."""
    files = commit.files if files is None else files
    return spark.read.schema(commit.schema.add(LOAD, StringType()) if LOAD not in commit.schema.names else commit.schema) \
                     .option("basePath", path).parquet(*[f"{path}/{f}" for f in files])


def read(spark: SparkSession, path: str, commit: Commit) -> DataFrame:
    if not commit.files:
        return spark.createDataFrame([], commit.schema)
    names = [n for n in commit.schema.names if n != LOAD]
    return scan(spark, path, commit).select(*names)


def write_files(df: DataFrame, path: str, partition_col: str | None = None) -> list[str]:
    """Write new data files; nobody reads them before a commit lists them."""
    spark = df.sparkSession
    fs, commits = file_system(spark, f"{path}/{COMMITS}")
    fs.mkdirs(commits)
    load = f"{LOAD}=v{uuid.uuid4().hex[:16]}"
    writer = df.write.partitionBy(partition_col) if partition_col else df.write
    writer.parquet(f"{path}/{load}")
    fs, root = file_system(spark, f"{path}/{load}")
    found, files = fs.listFiles(root, True), []
    while found.hasNext():
        name = found.next().getPath().toString()
        if name.endswith(".parquet"):
            files.append(f"{load}/" + name.rsplit(f"/{load}/", 1)[1])
    return sorted(files)


def commit(spark: SparkSession, path: str, base: Commit | None, files: Sequence[str], schema: StructType,
           batches: dict[str, int] | None = None) -> Commit:
    """Make ``files`` the table. Refused if a record was created since ``base`` was read."""
    taken = _numbers(spark, path)
    after = base.number if base else 0
    # a broken record after the base is one whose writer stopped: its number stays unused
    if any(n > after and _record(spark, path, n) for n in taken):
        raise CommitRefused(f"{path}: commit {after} is no longer the newest")
    done = Commit(max([after, *taken]) + 1, tuple(files), StructType([f for f in schema.fields if f.name != LOAD]),
                  {**(base.batches if base else {}), **(batches or {})})
    text = json.dumps({"files": done.files, "schema": json.loads(done.schema.json()), "batches": done.batches})
    fs, file = file_system(spark, f"{path}/{COMMITS}/{done.number:010d}.json")
    try:
        out = fs.create(file, False)
    except Exception as e:  # the file exists: another writer took the number
        raise CommitRefused(f"{path}: commit {done.number} is taken") from e
    out.write(bytearray(text.encode()))
    out.close()
    return done


def overwrite(df: DataFrame, path: str, partition_col: str | None = None) -> Commit:
    """Replace the table by ``df``, which may read the table itself."""
    spark = df.sparkSession
    base = newest(spark, path)
    return commit(spark, path, base, write_files(df, path, partition_col), df.schema)


def merge(path: str, batch: DataFrame, key: Sequence[str], laid_out: Callable[[DataFrame], DataFrame], partition_col: str,
          partition_from_key: bool, batches: dict[str, int] | None = None) -> Commit:
    """Delete + insert of ``batch`` (read several times) that rewrites only the files holding one of its keys.

    Files are chosen by a scan of the key columns within the batch's key ranges,
    which the file statistics prune, and, if the partition follows from the
    key, within the batch's partitions. All other files stay as they are.
    """
    spark, key = batch.sparkSession, list(key)
    base = newest(spark, path)
    if base is None or not base.files:
        return commit(spark, path, base, write_files(laid_out(batch), path, partition_col), batch.schema, batches)
    keys = batch.select(*key).dropna().distinct()  # a NULL part never matches
    span = batch.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in key for f in (F.min, F.max)]).first()
    if span is None or any(v is None for v in span):  # no key without a NULL part: nothing is replaced
        touched: set[str] = set()
    else:
        held = scan(spark, path, base).withColumn("__file", F.xxhash64("_metadata.file_path"))  # the path itself is wide
        for c in key:
            held = held.where(F.col(c).between(F.lit(span[f"min_{c}"]), F.lit(span[f"max_{c}"])))
        if partition_from_key:
            months = [r[0] for r in batch.select(partition_col).distinct().collect()]  # bounded by the calendar
            inside = F.col(partition_col).isin([m for m in months if m is not None])
            held = held.where(inside | F.col(partition_col).isNull() if None in months else inside)
        hit = [r[0] for r in held.select(*key, "__file").join(keys, key, "left_semi").select("__file").distinct().collect()]
        # two files of one hash are both rewritten; no data column is read for the names
        names = scan(spark, path, base).select(F.col("_metadata.file_path").alias("__file"))
        touched = _files(base, names.where(F.xxhash64("__file").isin(hit))) if hit else set()
    return _rewritten(path, base, touched, lambda rows: rows.join(keys, key, "left_anti"), batch, laid_out, partition_col, batches)


def replace_range(path: str, batch: DataFrame, column: str, start, end, laid_out: Callable[[DataFrame], DataFrame],
                  partition_col: str, batches: dict[str, int] | None = None) -> Commit:
    """Put ``batch`` (read several times) in the place of all rows with ``column BETWEEN start AND end``.

    Rows outside the range and rows without a value stay, and so do the files
    that hold no row of the range (file statistics prune the scan that finds
    them). An empty batch empties the range. A batch row outside the range, or
    without a value, is refused: another backfill could never replace it.
    """
    spark = batch.sparkSession
    inside = F.coalesce(F.col(column).between(F.lit(start), F.lit(end)), F.lit(False))
    if not batch.where(~inside).isEmpty():
        raise ValueError(f"{path}: rows of the batch lie outside {column} {start} .. {end}")
    base = newest(spark, path)
    if base is None or not base.files:
        return commit(spark, path, base, write_files(laid_out(batch), path, partition_col), batch.schema, batches)
    held = scan(spark, path, base).where(F.col(column).between(F.lit(start), F.lit(end)))
    touched = _files(base, held.select(F.col("_metadata.file_path").alias("__file")))
    return _rewritten(path, base, touched, lambda rows: rows.where(~inside), batch, laid_out, partition_col, batches)


def _files(base: Commit, names: DataFrame) -> set[str]:
    """The files of ``base`` whose paths are in the only column of ``names``."""
    known = set(base.files)
    found = (f"{LOAD}=" + r[0].rsplit(f"/{LOAD}=", 1)[1] for r in names.distinct().collect())  # files of the table
    return {f if f in known else unquote(f) for f in found}


def _rewritten(path: str, base: Commit, touched: set[str], kept: Callable[[DataFrame], DataFrame], batch: DataFrame,
               laid_out: Callable[[DataFrame], DataFrame], partition_col: str, batches: dict[str, int] | None) -> Commit:
    """Commit of ``batch`` with what ``kept`` leaves of the ``touched`` files; the other files stay as they are."""
    spark = batch.sparkSession
    content = batch
    if touched:
        names = [n for n in base.schema.names if n != LOAD]
        rest = kept(scan(spark, path, base, sorted(touched)).select(*names))
        content = rest.unionByName(batch, allowMissingColumns=True)
    files = write_files(laid_out(content), path, partition_col)
    whole = spark.createDataFrame([], base.schema).unionByName(spark.createDataFrame([], batch.schema), allowMissingColumns=True).schema
    return commit(spark, path, base, [f for f in base.files if f not in touched] + files, whole, batches)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove data files that none of the newest ``keep`` commits lists; returns them.

    Run it when no writer is at work: files of a write that has not committed go too.
    """
    kept = [c for c in (_record(spark, path, n) for n in _numbers(spark, path)) if c][-keep:]
    if not kept:
        return []
    listed = {f for c in kept for f in c.files}
    fs, root = file_system(spark, path)
    found, gone = fs.listFiles(root, True), []
    while found.hasNext():
        file = found.next().getPath()
        name = file.toString()
        if name.endswith(".parquet") and f"/{LOAD}=" in name:
            name = f"{LOAD}=" + name.rsplit(f"/{LOAD}=", 1)[1]
            if name not in listed:
                fs.delete(file, False)
                gone.append(name)
    return sorted(gone)
