"""Exact dedup by content sort (native: DataFrame functions only).

Texts are equal when identical after each run of ASCII white space is replaced by one space.  The rows
are range-partitioned on the normalised text with Spark's sampled splitters, sorted within each
partition (an external sort, so equal texts are adjacent) and compared in full with their neighbours by
a window over the sorted run, which needs no further exchange.  The splitters are made of a short prefix
and a 64-bit hash of the text, so their size does not depend on the length of the texts.

A group of copies that would overfill a partition never enters the sort.  Such groups are found by a
pre-aggregated weight per hash; their smallest id and size come from a map-side-combined aggregate over
the full text.  There are at most four of them per partition, so their table is broadcast.

Cases: null text is empty text, and all empty texts are one group.  A null id is larger than any other
id.  Rows repeated with one id and one text are all ``kept`` in :func:`mark_copies`, as the rule is
``id = keep_id``; :func:`drop_copies` returns exactly one row of each text.  An empty table gives an
empty result.  Input columns are carried in one struct, so their names cannot clash with ours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import partitions_for, text_or_empty, written

WHITE_RUN = r"[\x20\x09-\x0D]+"
#: Leading characters of the normalised text in a splitter.
PREFIX_CHARS = 16
#: Weight of a row besides its text, in bytes.
ROW_BYTES = 64
#: A group of copies is hot when it weighs more than this part of a mean partition.
HOT_PART = 0.25


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, WHITE_RUN, " ")


def _prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col(id_col).alias("id"),
                       normalised(text_or_empty(text_col)).alias("norm")) \
        .withColumn("h", F.xxhash64("norm"))


def _hot_hashes(src: DataFrame, parts: int, total: int) -> DataFrame | None:
    """Hashes whose rows outweigh ``HOT_PART`` of a mean partition: at most ``parts / HOT_PART`` rows."""
    weights = src.select("h", (F.octet_length("norm") + ROW_BYTES).alias("w")).groupBy("h") \
        .agg(F.sum("w").alias("w"), F.count("*").alias("n"))
    hot = written(weights.where((F.col("n") > 1) & (F.col("w") > total * HOT_PART / parts)).select("h"), "hot_texts")
    return None if hot.isEmpty() else hot


def _split(docs: DataFrame, id_col: str, text_col: str):
    """The sorted runs of ordinary texts, the rows of hot texts and the table of hot groups."""
    spark = docs.sparkSession
    src = _prepared(docs, id_col, text_col)
    total = docs.agg(F.sum(F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)) + ROW_BYTES)).first()[0] or 0
    parts = partitions_for(spark, total)
    hot = _hot_hashes(src, parts, total)
    cold = src if hot is None else src.join(F.broadcast(hot), "h", "left_anti")
    ranged = cold.withColumn("prefix", F.substring("norm", 1, PREFIX_CHARS)).repartitionByRange(parts, "prefix", "h")
    group = Window.partitionBy("prefix", "h", "norm")
    run = group.orderBy(F.col("id").asc_nulls_last())
    cold = ranged.select("row", "id", "norm", F.first("id").over(run).alias("keep_id"), F.row_number().over(run).alias("nth"),
                         F.count("*").over(run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("group_size"))
    if hot is None:
        return cold, None, None
    rows = src.join(F.broadcast(hot), "h", "left_semi")
    # One row for each hot text (compared in full); the join back uses its SHA-256.
    groups = rows.groupBy("norm").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size")) \
        .select(F.sha2("norm", 256).alias("sha"), "keep_id", "group_size")
    return cold, rows.withColumn("sha", F.sha2("norm", 256)), groups


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``row`` (all input columns), id, keep_id, group_size, kept, text_sha256."""
    cold, rows, groups = _split(docs, id_col, text_col)
    out = cold.select("row", "id", "keep_id", "group_size", F.sha2("norm", 256).alias("text_sha256"))
    if rows is not None:
        out = out.unionByName(rows.join(F.broadcast(groups), "sha").select(
            "row", "id", "keep_id", "group_size", F.col("sha").alias("text_sha256")))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the copies: of each text exactly one row with the smallest id stays, whole."""
    cold, rows, groups = _split(docs, id_col, text_col)
    out = cold.where(F.col("nth") == 1).select("row")
    if rows is not None:
        first = rows.join(F.broadcast(groups), "sha").where(F.col("id").eqNullSafe(F.col("keep_id")))
        out = out.unionByName(first.groupBy("sha").agg(F.first("row").alias("row")).select("row"))
    return out.select("row.*")


def op10(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with its group of equal texts."""
    from tidemark.llm.common import load
    return mark_copies(load(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


OP10_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)
"""
