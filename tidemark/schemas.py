"""Declared schemas of the data model.

All four tables are declared rather than inferred: inference types an
all-null alarm band badly, and a stream source needs a fixed schema.
"""

from pyspark.sql import types as T

HISTORY = T.StructType([
    T.StructField("sensor_asset_id", T.StringType()),
    T.StructField("scada_tag", T.StringType()),
    T.StructField("site_code", T.StringType()),
    T.StructField("reading_ts", T.TimestampType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("quality_code", T.IntegerType()),
    T.StructField("ingest_ts", T.TimestampType()),
])

# The record as it travels: both times as epoch microseconds.
WIRE = T.StructType([
    T.StructField("sensor_asset_id", T.StringType()),
    T.StructField("scada_tag", T.StringType()),
    T.StructField("site_code", T.StringType()),
    T.StructField("reading_ts", T.LongType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("quality_code", T.IntegerType()),
    T.StructField("ingest_ts", T.LongType()),
])

DIMENSION = T.StructType([
    T.StructField("sensor_asset_id", T.StringType()),
    T.StructField("scada_tag", T.StringType()),
    T.StructField("site_code", T.StringType()),
    T.StructField("site_name", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("energy_source", T.StringType()),
    T.StructField("business_category", T.StringType()),
    T.StructField("equipment", T.StringType()),
    T.StructField("unit_id", T.StringType()),
    T.StructField("measurement_type", T.StringType()),
    T.StructField("unit_of_measure", T.StringType()),
    T.StructField("alarm_low", T.DoubleType()),
    T.StructField("alarm_high", T.DoubleType()),
])

LIVE_STATE = T.StructType([
    T.StructField("sensor_asset_id", T.StringType(), False),
    T.StructField("scada_tag", T.StringType()),
    T.StructField("site_code", T.StringType()),
    T.StructField("site_name", T.StringType()),
    T.StructField("energy_source", T.StringType()),
    T.StructField("measurement_type", T.StringType()),
    T.StructField("unit_of_measure", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("quality_code", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("reading_ts", T.TimestampType()),
    T.StructField("updated_ts", T.TimestampType()),
])
LIVE_STATE_KEY = ["sensor_asset_id"]
LIVE_STATE_DEFAULTS = {"updated_ts": "current_timestamp()"}

PROGRESS = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("event_ts", T.TimestampNTZType()),  # UTC wall clock
    T.StructField("num_input_rows", T.LongType()),
    T.StructField("num_output_rows", T.LongType()),
    T.StructField("input_rps", T.DoubleType()),
    T.StructField("processed_rps", T.DoubleType()),
    T.StructField("batch_duration_ms", T.DoubleType()),
])

# Fields of a streaming progress JSON document that the progress log reads.
PROGRESS_JSON = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("batchId", T.LongType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("numInputRows", T.LongType()),
    T.StructField("inputRowsPerSecond", T.DoubleType()),
    T.StructField("processedRowsPerSecond", T.DoubleType()),
    T.StructField("durationMs", T.StructType([T.StructField("triggerExecution", T.LongType())])),
    T.StructField("sink", T.StructType([T.StructField("numOutputRows", T.LongType())])),
])

# Device events of the message-bus example, carried as JSON text.
DEVICE_EVENT = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("event_ts", T.TimestampType()),
])
