"""A lake table of micro-batches on plain Parquet.

    data/batch_id=N/[day=D/]            the rows of batch N, published whole by one rename
    base/upto=N/gen=G/op=X/[day=D/]     all live rows of batches up to N rewritten (compaction, folding)
    retained/column=C/from=US/upto=N    rows with C before that microsecond are gone

There is no log: folder names say all there is to know, and Spark's partition pruning reads
what they say. Batch readers take the newest base and the batches after it; streaming
readers follow ``data/`` only, which no rewrite touches, so a compaction is never seen as
new rows. Days are those of a column chosen by the writer, so retention can drop whole
folders unread. One writer per table is assumed.
"""

from __future__ import annotations

import datetime as dt
import math
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import interval_ms

TARGET_FILE_BYTES = 134_217_728  # 128 MB
DAY_US = 86_400_000_000


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def _values(spark: SparkSession, path: str, key: str) -> list[str]:
    """The values V of the folders ``key=V`` of a path."""
    return [n.split("=", 1)[1] for n in _names(spark, path) if n.startswith(f"{key}=")]


# --- what is there -------------------------------------------------------------------------------

def committed_batches(spark: SparkSession, path: str) -> set[int]:
    return {int(v) for v in _values(spark, f"{path}/data", "batch_id")}


def _base(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """(upto, generation) of the newest base."""
    upto = max((int(v) for v in _values(spark, f"{path}/base", "upto")), default=None)
    if upto is None:
        return None
    return upto, max(int(v) for v in _values(spark, f"{path}/base/upto={upto}", "gen"))


def live_dirs(spark: SparkSession, path: str) -> list[str]:
    """The folders that batch readers take."""
    base = _base(spark, path)
    dirs = [f"base/upto={base[0]}/gen={base[1]}"] if base else []
    return dirs + [f"data/batch_id={b}" for b in sorted(committed_batches(spark, path)) if not base or b > base[0]]


def _limits(spark: SparkSession, path: str) -> dict[str, int]:
    """Column -> epoch microsecond before which rows are gone."""
    return {c: max(int(v) for v in _values(spark, f"{path}/retained/column={c}", "from"))
            for c in _values(spark, f"{path}/retained", "column")}


def history(spark: SparkSession, path: str) -> DataFrame:
    """Every write of the table, one row each (M2): an aggregate over its batches and its newest
    base (a rewrite of batches up to N is version N + 1), and its retentions."""
    parts = []
    changed = F.max("_metadata.file_modification_time").alias("timestamp")
    n = F.count(F.lit(1)).alias("rows")
    if committed_batches(spark, path):
        data = spark.read.parquet(f"{path}/data")
        parts.append(data.groupBy(F.col("batch_id").cast("long").alias("version")).agg(changed, n).select(
            "version", "timestamp", F.lit("append").alias("operation"), F.col("version").alias("batch_id"), "rows"))
    if base := _base(spark, path):
        rewritten = spark.read.parquet(f"{path}/base/upto={base[0]}/gen={base[1]}")
        parts.append(rewritten.groupBy(F.col("op").alias("operation")).agg(changed, n).select(
            F.lit(base[0] + 1).cast("long").alias("version"), "timestamp", "operation",
            F.lit(None).cast("long").alias("batch_id"), "rows"))
    fs = _fs(spark, path)[0]
    gone = []
    for c in _values(spark, f"{path}/retained", "column"):
        for v in _values(spark, f"{path}/retained/column={c}", "from"):
            for name in _names(spark, f"{path}/retained/column={c}/from={v}"):
                made = fs.getFileStatus(_fs(spark, f"{path}/retained/column={c}/from={v}/{name}")[1]).getModificationTime()
                gone.append((int(name.split("=")[1]) + 1, dt.datetime.fromtimestamp(made / 1000), "delete", None, None))
    parts.append(spark.createDataFrame(gone, "version long, timestamp timestamp, operation string, batch_id long, rows long"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def recent_history(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """The last ``n`` writes, newest first: version, operation, timestamp (L3)."""
    return history(spark, path).orderBy(F.col("version").desc(), F.col("timestamp").desc()).limit(n).select(
        "version", "operation", "timestamp", "batch_id", "rows")


# --- writing -------------------------------------------------------------------------------------

def _publish(df: DataFrame, path: str, target: str, day_of: str | None = None, mark: str | None = None) -> int:
    """Writes beside the table and renames into place (``mark``: an empty file, which readers skip); the
    number of rows."""
    spark = df.sparkSession
    staged = f"{path}/_staging/{uuid.uuid4().hex}"
    obs = Observation()
    out = df.observe(obs, F.count(F.lit(1)).alias("n"))
    if day_of:
        out.withColumn("day", F.floor(F.unix_micros(day_of) / F.lit(DAY_US)).cast("long")).write.partitionBy("day").parquet(staged)
    else:
        out.write.parquet(staged)
    fs, to = _fs(spark, f"{path}/{target}")
    if mark:
        fs.create(_fs(spark, f"{staged}/{mark}")[1], False).close()
    fs.mkdirs(to.getParent())
    if fs.exists(to) or not fs.rename(_fs(spark, staged)[1], to):
        raise RuntimeError(f"{target} of {path} could not be published")
    return int(obs.get["n"])


def write_batch(df: DataFrame, path: str, batch_id: int, *, stamp_ingestion: bool = True,
                day_of: str | None = None) -> int:
    """Write one micro-batch (K1), once; the number of rows, or -1 if it is there already.

    A replayed batch is not written again, so a stream that reads the table's files never
    sees its rows twice. A batch id that another streaming query has written (a new
    checkpoint on an old table) is an error. ``day_of``: a timestamp column whose day
    (days since 1970, UTC) becomes a folder level, for ``retain``.
    """
    spark = df.sparkSession
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    target = f"data/batch_id={batch_id}"
    if _exists(spark, f"{path}/{target}"):
        by = [n.removeprefix("_query-") for n in _names(spark, f"{path}/{target}") if n.startswith("_query-")]
        if query and by and by[0] != query:
            raise ValueError(f"batch {batch_id} of {path} was written by another query; a new checkpoint needs a new table")
        return -1
    out = df.withColumn("ingestion_time", F.current_timestamp()) if stamp_ingestion else df
    return _publish(out, path, target, day_of, f"_query-{query}" if query else None)


# --- reading -------------------------------------------------------------------------------------

def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Batch handle on the live rows (S3). ``batch_id`` is a column everywhere."""
    base, parts, limits = _base(spark, path), [], _limits(spark, path)
    batches = committed_batches(spark, path)
    if limits and not base and not table_bytes(spark, path)[1]:
        batches = set()             # all of it is gone
    if base:
        parts.append(spark.read.parquet(f"{path}/base/upto={base[0]}/gen={base[1]}").drop("op"))
    if any(not base or b > base[0] for b in batches):
        data = spark.read.parquet(f"{path}/data")
        parts.append(data.where(F.col("batch_id") > base[0]) if base else data)
    if not parts:
        if schema is None:
            raise FileNotFoundError(f"empty table at {path}")
        return spark.createDataFrame([], schema)
    parts = [p.withColumn("batch_id", F.col("batch_id").cast("long")).drop("day") for p in parts]
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    for column, us in limits.items():
        out = out.where(F.col(column).isNull() | (F.col(column) >= F.timestamp_micros(F.lit(us))))
    return out


def read_table_stream(spark: SparkSession, path: str, schema: T.StructType,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """The table's appends as a stream (S2): new ``data/batch_id=N`` folders."""
    full = T.StructType(list(schema.fields) + [T.StructField("batch_id", T.LongType())])
    r = spark.readStream.schema(full)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(f"{path}/data")


def table_bytes(spark: SparkSession, path: str) -> tuple[int, int]:
    """(total bytes, data file count) of the live folders, from the file system listing."""
    total, files = 0, 0
    for d in live_dirs(spark, path):
        fs, p = _fs(spark, f"{path}/{d}")
        it = fs.listFiles(p, True)
        while it.hasNext():
            st = it.next()
            if not st.getPath().getName().startswith(("_", ".")):
                total, files = total + st.getLen(), files + 1
    return total, files


# --- rewriting -----------------------------------------------------------------------------------

def _rewrite(spark: SparkSession, path: str, rows: DataFrame, upto: int, operation: str, target_bytes: int,
             sort_by: list[str] | None = None) -> int:
    """A new base of batches up to ``upto`` in files of about the target size; the version it makes."""
    size, _ = table_bytes(spark, path)
    n = max(1, math.ceil(size / target_bytes))
    rows = rows.repartitionByRange(n, *sort_by).sortWithinPartitions(*sort_by) if sort_by else rows.repartition(n)
    gens = [int(v) for v in _values(spark, f"{path}/base/upto={upto}", "gen")]
    gen = max(gens, default=-1) + 1
    _publish(rows, path, f"base/upto={upto}/gen={gen}/op={operation}")
    return upto + 1


def _upto(spark: SparkSession, path: str) -> int:
    base = _base(spark, path)
    return max([*committed_batches(spark, path), *([base[0]] if base else [])], default=-1)


def fold_before(spark: SparkSession, path: str, batch_id: int, transform, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Replace every live row of batches ``< batch_id`` by ``transform(rows)``, tagged
    ``batch_id - 1``. Reads "as of before N" are unchanged, so a replay of batch N still
    sees the same rows."""
    if not live_dirs(spark, path):
        return -1
    old = read_table(spark, path).where(F.col("batch_id") < batch_id)
    folded = transform(old).withColumn("batch_id", F.lit(batch_id - 1).cast("bigint"))
    return _rewrite(spark, path, folded, batch_id - 1, "fold", target_bytes)


def compact(spark: SparkSession, path: str, target_bytes: int = TARGET_FILE_BYTES,
            keys: list[str] | None = None, order: list[str] | None = None, sort_by: list[str] | None = None) -> int:
    """Rewrite small files into about ``target_bytes`` files (M1).

    A table whose files average half the target or more is left alone. With ``keys`` it
    is folded to its latest row per key (ordered by ``order``), which is how an
    update-policy table is cleaned up. With ``sort_by`` rows are dealt to files by range
    and sorted in them (L5), so that a reader of some keys skips the other files and row
    groups by their statistics. Returns the new version, or -1 when there is nothing to do. Data folders stay for the streams that read them.
    """
    from ..operators.latest import latest_per_key

    size, files = table_bytes(spark, path)
    if not files or not keys and not sort_by and (files < 2 or size / files >= target_bytes / 2):
        return -1
    rows = read_table(spark, path)
    if keys:
        rows = latest_per_key(rows, keys, order or ["batch_id", "ingestion_time"])
    return _rewrite(spark, path, rows, _upto(spark, path), "compact", target_bytes, sort_by)


def retain(spark: SparkSession, path: str, column: str, keep: str, now: dt.datetime | None = None) -> int:
    """Delete rows with ``column < now - keep`` (K11) without reading any.

    The limit is noted as a folder name, and readers filter by it (pushed down to Parquet
    statistics). Day folders of ``column`` (``write_batch(day_of=column)``) that lie before it are
    removed; what is left before the limit goes with the next compaction. ``now`` defaults to
    the current time; pass it to make the cut reproducible. A row exactly ``keep`` old
    stays; NULLs stay (``NULL < x`` is not true).
    """
    since = retention_cutoff(now, keep).astimezone(dt.timezone.utc) - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    us = since // dt.timedelta(microseconds=1)
    upto = _upto(spark, path)
    if upto < 0:
        return -1
    fs, note = _fs(spark, f"{path}/retained/column={column}/from={us}/upto={upto}")
    fs.mkdirs(note)
    for b in committed_batches(spark, path):
        for day in _values(spark, f"{path}/data/batch_id={b}", "day"):
            if day.lstrip("-").isdigit() and int(day) < us // DAY_US:       # NULLs have a folder of another name
                fs.delete(_fs(spark, f"{path}/data/batch_id={b}/day={day}")[1], True)
    return upto + 1


def retention_cutoff(now: dt.datetime | None, keep: str) -> dt.datetime:
    now = now or dt.datetime.now(dt.timezone.utc)
    return now - dt.timedelta(milliseconds=interval_ms(keep))
