"""Topic sources and JSON decoding.

Production reads a Kafka topic (``value`` bytes, key = symbol). Where the
Kafka connector is not on the classpath the same ``value`` column comes from a
directory of JSON-lines files (``text`` source); the parsing is identical.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import INFO_SCHEMA, TRADE_SCHEMA


def read_topic(spark: SparkSession, topic: str, *, bootstrap: str | None = None, path: str | None = None,
               start: str = "earliest", max_per_trigger: int | None = None, fail_on_loss: bool = True,
               stream: bool = True) -> DataFrame:
    """One topic as a DataFrame with a string ``value`` column (and ``offset`` when from Kafka).

    ``bootstrap`` -> Kafka (``maxOffsetsPerTrigger`` caps intake per trigger);
    ``path`` -> JSON-lines files (``maxFilesPerTrigger`` caps intake).
    Offsets that the broker has dropped stop the query unless ``fail_on_loss`` is False.
    """
    reader = spark.readStream if stream else spark.read
    if bootstrap:
        r = (reader.format("kafka").option("kafka.bootstrap.servers", bootstrap)
             .option("subscribe", topic).option("failOnDataLoss", str(fail_on_loss).lower()))
        if stream:
            r = r.option("startingOffsets", start)
            if max_per_trigger:
                r = r.option("maxOffsetsPerTrigger", str(max_per_trigger))
        df = r.load()
        return df.select(F.col("value").cast("string").alias("value"), "offset", "partition")
    if path is None:
        raise ValueError("read_topic needs bootstrap servers or a path")
    r = reader.format("text")
    if stream and max_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_per_trigger))
    return r.load(path).select(F.col("value").cast("string").alias("value"))


def to_json_lines(df: DataFrame) -> DataFrame:
    """Rows -> one JSON document per row in ``value`` (the wire format)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def parse_json(raw: DataFrame, schema: T.StructType, *, required: tuple[str, ...] = (),
               value_col: str = "value", seq_from: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Decode JSON under a fixed schema; split into (valid rows, rejects).

    ``from_json`` is PERMISSIVE: a malformed document becomes an all-NULL
    struct. Rejects keep the raw text and a ``reason`` (malformed / null field).
    ``seq_from`` names a source column (e.g. Kafka ``offset``) to use as ``seq``
    when the payload carries none.
    """
    parsed = raw.select(
        F.col(value_col).cast("string").alias("_raw"),
        F.from_json(F.col(value_col).cast("string"), schema).alias("_d"),
        *([F.col(seq_from).alias("_src_seq")] if seq_from else []),
    )
    fields = [f.name for f in schema.fields]
    all_null = F.lit(True)
    for f in fields:
        all_null = all_null & F.col(f"_d.{f}").isNull()
    reasons = [F.when(F.col("_d").isNull() | all_null, F.lit("malformed"))]
    reasons += [F.when(F.col(f"_d.{f}").isNull(), F.lit(f"null {f}")) for f in required]
    parsed = parsed.withColumn("reason", F.coalesce(*reasons)) if reasons else parsed
    cols = [F.col(f"_d.{f}").alias(f) for f in fields]
    if seq_from and "seq" in fields:
        cols = [F.coalesce(F.col("_d.seq"), F.col("_src_seq")).alias("seq") if f == "seq" else c
                for f, c in zip(fields, cols)]
    elif seq_from:
        cols.append(F.col("_src_seq").alias("seq"))
    extra = [T.StructField("seq", T.LongType())] if seq_from and "seq" not in fields else []
    valid = conform(parsed.where(F.col("reason").isNull()).select(*cols), T.StructType([*schema.fields, *extra]))
    rejects = parsed.where(F.col("reason").isNotNull()).select(F.col("_raw").alias("value"), "reason")
    return valid, rejects


def parse_trades(raw: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    return parse_json(raw, TRADE_SCHEMA, required=("symbol", "trade_timestamp"), **kw)


def parse_info(raw: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    return parse_json(raw, INFO_SCHEMA, required=("symbol", "info_timestamp"), **kw)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Strict column list and types (P4): cast and order exactly as ``schema``."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
