"""Sources: the history table (batch or stream), the dimension, wire records, JSON events, rate."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import micros_to_ts
from tidemark.sources.files import FileSystem


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A static table (a catalog name or a Parquet path)."""
    if "/" not in path and spark.catalog.tableExists(path):
        return spark.table(path)
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def stream_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 max_files_per_trigger: int | None = None, max_bytes_per_trigger: str | None = None) -> DataFrame:
    """Incremental read of an append-only Parquet table: a folder, or one file.

    New files are picked up in arrival order; ``max_files_per_trigger`` bounds
    one micro-batch (backpressure).  A file (the file system is asked, the
    name does not decide) is read through a glob filter on its folder.
    """
    if "/" not in path and spark.catalog.tableExists(path):
        return spark.readStream.table(path)
    if schema is None:
        schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    folder = path
    if FileSystem(spark, path).is_file(path):
        # Only that file, and no partition columns guessed from neighbouring folders.
        folder = posixpath.dirname(path)
        r = r.option("pathGlobFilter", posixpath.basename(path)).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return r.parquet(folder)


def stream_history(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The history table as a stream, with its declared schema."""
    return stream_table(spark, path, schemas.HISTORY, max_files_per_trigger)


def from_wire(df: DataFrame) -> DataFrame:
    """Wire records (times as epoch microseconds) to history rows."""
    return df.select(
        "sensor_asset_id", "scada_tag", "site_code",
        micros_to_ts("reading_ts").alias("reading_ts"),
        F.col("value").cast("double").alias("value"),
        F.col("quality_code").cast("int").alias("quality_code"),
        micros_to_ts("ingest_ts").alias("ingest_ts"))


def parse_json_events(df: DataFrame, schema: T.StructType = schemas.DEVICE_EVENT,
                      column: str = "value") -> DataFrame:
    """Message-bus records whose value is JSON text (or bytes) → typed columns."""
    return (df.select(F.from_json(F.col(column).cast("string"), schema).alias("e"))
              .select("e.*"))


def kafka_events(spark: SparkSession, servers: str, topic: str,
                 schema: T.StructType = schemas.DEVICE_EVENT, **options: str) -> DataFrame:
    """A Kafka topic of JSON events (needs the Kafka connector on the classpath)."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers).option("subscribe", topic))
    for k, v in options.items():
        r = r.option(k, v)
    try:
        raw = r.load()
    except Exception as e:
        if "kafka" in str(e).lower() and ("not found" in str(e).lower() or "find data source" in str(e).lower()):
            raise RuntimeError("the Kafka source needs the spark-sql-kafka connector on the classpath "
                               "(spark.jars.packages)") from e
        raise
    return parse_json_events(raw, schema)


def rate_events(spark: SparkSession, rows_per_second: int = 100, devices: int = 10,
                micro_batch: bool = False) -> DataFrame:
    """The rate source as a stand-in device feed (columns derived from ``value``).

    ``micro_batch=True`` uses ``rate-micro-batch``, which emits a fixed number
    of rows per batch and suits tests.
    """
    if micro_batch:
        src = (spark.readStream.format("rate-micro-batch")
               .option("rowsPerBatch", str(rows_per_second)).load())
    else:
        src = spark.readStream.format("rate").option("rowsPerSecond", str(rows_per_second)).load()
    v = F.col("value")
    return src.select(
        F.concat(F.lit("device-"), (v % devices).cast("string")).alias("device_id"),
        (F.lit(20.0) + (v % 17).cast("double")).alias("temperature"),
        (F.lit(40.0) + (v % 23).cast("double")).alias("humidity"),
        F.when(v % 50 == 0, F.lit("ALERT")).otherwise(F.lit("OK")).alias("status"),
        F.col("timestamp").alias("event_ts"))
