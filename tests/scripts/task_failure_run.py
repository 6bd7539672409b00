"""Run in a separate JVM whose tasks may be retried (local[2,3]): the first
attempt of partition 0 of selected stages fails, as if its executor died."""

import json
import os
import sys

sys.path.insert(0, sys.argv[1])

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators.ranking import group_row_number  # noqa: E402
from tidemark.session import shared_dir  # noqa: E402
from tidemark.streaming.keyed import KeyedTable  # noqa: E402

spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")


work = shared_dir(spark, "failures")
markers = f"{work}/failed_attempts"
os.makedirs(markers, exist_ok=True)


@F.udf("double")
def flaky(v):
    from pyspark import TaskContext
    tc = TaskContext.get()
    if tc.attemptNumber() == 0 and tc.partitionId() == 0:
        open(os.path.join(markers, f"{tc.stageId()}-{tc.taskAttemptId()}"), "w").close()
        raise RuntimeError("simulated loss of the executor running this task")
    return v


out = {}
t = KeyedTable.create(spark, f"{work}/t", spark.createDataFrame([], "k long, v double").schema, "k", buckets=4)
batch = spark.range(0, 1000, numPartitions=4).select(F.col("id").alias("k"), F.col("id").cast("double").alias("v"))
out["written"] = t.merge(batch.withColumn("v", flaky("v")), writer="w", batch_id=0)
upd = spark.range(0, 1000, 2, numPartitions=4).select(F.col("id").alias("k"), (F.col("id") * 10).cast("double").alias("v"))
out["written2"] = t.merge(upd.withColumn("v", flaky("v")), writer="w", batch_id=1)
rows = {r.k: r.v for r in t.read().collect()}
out["rows"] = len(rows)
out["ok_values"] = all(rows[k] == (k * 10.0 if k % 2 == 0 else float(k)) for k in range(1000))

df = spark.range(0, 3000, numPartitions=4).select(
    F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 17).alias("g"),
    flaky(F.col("id").cast("double")).alias("o"), F.col("id").alias("tb"))
got = {(r.g, r.tb): r.rn for r in group_row_number(df, ["g"], ["o", "tb"], "rn").collect()}
want = {(r.g, r.tb): r.rn for r in df.withColumn("rn", F.row_number().over(
    Window.partitionBy("g").orderBy("o", "tb"))).collect()}
out["ranks_equal"] = got == want
out["failed_attempts"] = len(os.listdir(markers))
print("RESULT " + json.dumps(out))
