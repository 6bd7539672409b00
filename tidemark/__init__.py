"""tidemark: live keyed state from an append-only history, on Spark.

An append-only history of readings is reduced to the newest row per key,
enriched from a dimension, classified against per-key limits and upserted
into a keyed table.  Batch reports (alarms, freshness, latency percentiles,
throughput), delivery-latency matching, dimension expansion, table sync and
change history run over the same data as DataFrame plans.
"""

from tidemark.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
