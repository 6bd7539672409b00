r"""Preference formatting (native: DataFrame functions only).

A pair has a chosen and a rejected conversation.  Their longest common prefix of equal turns (role and
text) is rendered once as the prompt; the turns behind it are rendered as two completions.  A mask lists
the spans of a completion (code points, end exclusive) that are learned: the text and the end mark of
assistant turns.  A turn is rendered as ``<|role|>\n`` + text + ``<|end|>\n``.

One shuffle by pair brings the turns of both sides together with their pair; only the turns of one pair
ever meet in a task.

Cases: null roles and texts are empty strings, and a null turn number sorts last.  Turns with equal
numbers are ordered by role, then text.  Repeated rows are turns of their own.  Equal conversations have
two empty completions.  A pair with one side has an empty prompt and null for the other side.  Rows with a
null pair id are left out.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import load

LEARNED = "assistant"
END = "<|end|>\n"


def _rendered(t: Column) -> Column:
    return F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit(END))


def _completion(turns: Column) -> Column:
    return F.concat_ws("", F.transform(turns, _rendered))


def _mask(turns: Column) -> Column:
    """array of ``start:stop`` of what is learned."""
    zero = F.expr("named_struct('at', 0, 'out', cast(array() as array<string>))")

    def step(acc, t):
        start = acc["at"] + F.length(t["role"]) + 5
        stop = start + F.length(t["text"]) + len(END)
        span = F.concat_ws(":", start.cast("string"), stop.cast("string"))
        return F.struct(stop.alias("at"), F.when(t["role"] == LEARNED, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(turns, zero, step)["out"]


def format_pairs(turns: DataFrame, pair_col: str, chosen_col: str, turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per pair: pair_id, n_prompt_turns, prompt, chosen, rejected and their masks.

    ``turns`` has one row per turn; ``chosen_col`` (boolean) tells the sides of a pair apart.
    """
    one = F.struct(F.col(turn_col).isNull().alias("late"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                   F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sides = turns.where(F.col(pair_col).isNotNull() & F.col(chosen_col).isNotNull()).groupBy(F.col(pair_col).alias("pair_id")).agg(
        F.array_sort(F.collect_list(F.when(F.col(chosen_col), one))).alias("c"),
        F.array_sort(F.collect_list(F.when(~F.col(chosen_col), one))).alias("r"))
    equal = F.zip_with("c", "r", lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    differ = F.array_position(equal, F.lit(False))
    both = (F.size("c") > 0) & (F.size("r") > 0)
    prefix = F.when(~both, 0).when(differ == 0, F.size("c")).otherwise(differ - 1).cast("int")
    cut = sides.select("pair_id", prefix.alias("n_prompt_turns"), F.slice("c", F.lit(1), prefix).alias("p"),
                       F.when(F.size("c") > 0, F.slice("c", prefix + 1, F.size("c"))).alias("c"),
                       F.when(F.size("r") > 0, F.slice("r", prefix + 1, F.size("r"))).alias("r"))
    out = {"chosen": F.col("c"), "rejected": F.col("r")}
    return cut.select("pair_id", "n_prompt_turns", _completion(F.col("p")).alias("prompt"),
                      *[F.when(t.isNotNull(), _completion(t)).alias(n) for n, t in out.items()],
                      *[F.when(t.isNotNull(), F.concat_ws(",", _mask(t))).alias(f"{n}_mask") for n, t in out.items()])


def op5(spark, sf_dir: str) -> DataFrame:
    """All conversations; an even one is chosen over the odd one that follows it."""
    turns = load(spark, sf_dir, "conversations").withColumn("pair", F.floor(F.col("conv_id") / 2).cast("long")) \
        .withColumn("is_chosen", F.col("conv_id") % 2 == 0)
    return format_pairs(turns, "pair", "is_chosen")


OP5_SQL = r"""
WITH t AS (
  SELECT CAST(floor(conv_id / 2) AS BIGINT) AS pair_id, conv_id % 2 = 0 AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, coalesce(role, ''), coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
a AS (
  SELECT coalesce(x.pair_id, y.pair_id) AS pair_id, coalesce(x.n, y.n) AS n,
         coalesce(x.role = y.role AND x.text = y.text, false) AS same
  FROM (SELECT * FROM t WHERE c) x FULL JOIN (SELECT * FROM t WHERE NOT c) y ON x.pair_id = y.pair_id AND x.n = y.n),
k AS (
  SELECT pair_id, CAST(coalesce(min(n) FILTER (WHERE NOT same) - 1, max(n)) AS INTEGER) AS n_prompt_turns FROM a GROUP BY pair_id),
m AS (
  SELECT t.pair_id, k.n_prompt_turns, c, n, role, '<|' || role || E'|>\n' || text || E'<|end|>\n' AS turn,
         n <= k.n_prompt_turns AS shared,
         coalesce(sum(length(role) + length(text) + 13) FILTER (WHERE n > k.n_prompt_turns)
                  OVER (PARTITION BY t.pair_id, c ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(role) + 5 AS start,
         length(text) + 8 AS size
  FROM t JOIN k ON t.pair_id = k.pair_id)
SELECT pair_id, n_prompt_turns,
       coalesce(string_agg(turn, '' ORDER BY n) FILTER (WHERE c AND shared), '') AS prompt,
       CASE WHEN count(*) FILTER (WHERE c) > 0 THEN coalesce(string_agg(turn, '' ORDER BY n) FILTER (WHERE c AND NOT shared), '') END AS chosen,
       CASE WHEN count(*) FILTER (WHERE NOT c) > 0 THEN coalesce(string_agg(turn, '' ORDER BY n) FILTER (WHERE NOT c AND NOT shared), '') END AS rejected,
       CASE WHEN count(*) FILTER (WHERE c) > 0 THEN coalesce(string_agg(start || ':' || (start + size), ',' ORDER BY n) FILTER (WHERE c AND NOT shared AND role = 'assistant'), '') END AS chosen_mask,
       CASE WHEN count(*) FILTER (WHERE NOT c) > 0 THEN coalesce(string_agg(start || ':' || (start + size), ',' ORDER BY n) FILTER (WHERE NOT c AND NOT shared AND role = 'assistant'), '') END AS rejected_mask
FROM m GROUP BY pair_id, n_prompt_turns
"""
