"""Preference formatting: one prompt and two masked completions per pair, with DataFrame functions only.

The longest common prefix of turns of a chosen and a rejected conversation is rendered once as the
prompt; what follows on either side is a completion. The mask of a completion is the list of code point
ranges of assistant texts with their end marker: what is trained on. Role headers and other roles' turns
are outside. A pair becomes one row, so its turns meet in one group, as the row itself demands; nothing
else is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def preference_pairs(turns: DataFrame) -> DataFrame:
    """One row per pair of ``turns`` (pair_id, chosen boolean, turn, role, text).

    Columns: pair_id, n_prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask, n_chosen_turns,
    n_rejected_turns, complete. Turns are ordered by turn, then role, then text; repeated turns all count.
    A null role renders as empty, a null text as empty, and nulls equal each other in the common prefix.
    If one side is missing the prompt is empty and ``complete`` false; if one side is a prefix of the
    other its completion is empty. Rows with a null pair_id or side go together under null or as rejected.
    Extra columns are ignored; an empty table gives no rows.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = turns.select("pair_id", F.coalesce("chosen", F.lit(False)).alias("is_chosen"), turn.alias("t"))
    sides = rows.groupBy("pair_id").agg(*[F.sort_array(F.collect_list(F.when(F.col("is_chosen") == side, F.col("t")))).alias(name) for name, side in (("c", True), ("r", False))])
    same = F.expr("filter(sequence(0, least(size(c), size(r))), i -> i >= least(size(c), size(r)) OR c[i].role <> r[i].role OR c[i].text <> r[i].text)[0]")
    cut = sides.withColumn("n", same)
    head = lambda x: F.concat(F.lit(OPEN), x["role"], F.lit("\n"))
    whole = lambda x: F.concat(head(x), x["text"], F.lit(CLOSE + "\n"))

    def completion(side: str):
        rest = F.slice(side, F.col("n") + 1, F.greatest(F.size(side) - F.col("n"), F.lit(0)))
        start = F.struct(F.lit(0).alias("p"), F.array().cast("array<string>").alias("m"))
        end = lambda a, x: a["p"] + F.length(head(x)) + F.length(x["text"]) + len(CLOSE)
        span = lambda a, x: F.concat((a["p"] + F.length(head(x))).cast("string"), F.lit(":"), end(a, x).cast("string"))
        mask = F.aggregate(rest, start, lambda a, x: F.struct((a["p"] + F.length(whole(x))).alias("p"), F.when(x["role"] == "assistant", F.concat(a["m"], F.array(span(a, x)))).otherwise(a["m"]).alias("m")), lambda a: F.array_join(a["m"], ","))
        return F.array_join(F.transform(rest, whole), ""), mask

    chosen, rejected = completion("c"), completion("r")
    return cut.select(
        "pair_id", F.col("n").cast("long").alias("n_prompt_turns"),
        F.array_join(F.transform(F.slice("c", 1, F.col("n")), whole), "").alias("prompt"),
        chosen[0].alias("chosen"), chosen[1].alias("chosen_mask"), rejected[0].alias("rejected"), rejected[1].alias("rejected_mask"),
        (F.size("c") - F.col("n")).cast("long").alias("n_chosen_turns"), (F.size("r") - F.col("n")).cast("long").alias("n_rejected_turns"),
        ((F.size("c") > 0) & (F.size("r") > 0)).alias("complete"),
    )


def op3_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations``, paired by neighbouring ids: the even one counts as chosen, the odd one as rejected."""
    turns = table(spark, sf_dir, "conversations")
    return preference_pairs(turns.select(F.floor(F.col("conv_id") / 2).alias("pair_id"), (F.pmod(F.col("conv_id"), F.lit(2)) == 0).alias("chosen"), "turn", "role", "text"))


def _sql() -> str:
    piece = f"concat('{OPEN}', x.role, chr(10), x.text, '{CLOSE}', chr(10))"
    mask = (
        "array_to_string(list_transform(list_filter(range(1, len({s}) + 1), lambda i: {s}[i].role = 'assistant'), lambda i: concat("
        f"coalesce(list_sum(list_transform({{s}}[1 : i - 1], lambda x: length({piece}))), 0) + length(concat('{OPEN}', {{s}}[i].role, chr(10))), ':', "
        f"coalesce(list_sum(list_transform({{s}}[1 : i - 1], lambda x: length({piece}))), 0) + length(concat('{OPEN}', {{s}}[i].role, chr(10), {{s}}[i].text, '{CLOSE}')))), ',')"
    )
    return f"""
WITH t AS (SELECT CAST(floor(conv_id / 2.0) AS BIGINT) AS pair_id, conv_id % 2 = 0 AS side, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
g AS (SELECT pair_id, coalesce(list(struct_pack(role := role, text := text) ORDER BY turn, role, text) FILTER (WHERE side), []) AS c,
  coalesce(list(struct_pack(role := role, text := text) ORDER BY turn, role, text) FILTER (WHERE NOT side), []) AS r FROM t GROUP BY pair_id),
n AS (SELECT *, coalesce(list_min(list_filter(range(1, least(len(c), len(r)) + 1), lambda i: c[i].role <> r[i].role OR c[i].text <> r[i].text)) - 1, least(len(c), len(r))) AS n FROM g),
p AS (SELECT pair_id, n, c[1 : n] AS p, c[n + 1 :] AS c, r[n + 1 :] AS r, len(c) > 0 AND len(r) > 0 AS complete FROM n)
SELECT pair_id, CAST(n AS BIGINT) AS n_prompt_turns, coalesce(array_to_string(list_transform(p, lambda x: {piece}), ''), '') AS prompt,
  coalesce(array_to_string(list_transform(c, lambda x: {piece}), ''), '') AS chosen, coalesce({mask.format(s="c")}, '') AS chosen_mask,
  coalesce(array_to_string(list_transform(r, lambda x: {piece}), ''), '') AS rejected, coalesce({mask.format(s="r")}, '') AS rejected_mask,
  CAST(len(c) AS BIGINT) AS n_chosen_turns, CAST(len(r) AS BIGINT) AS n_rejected_turns, complete FROM p"""


QUERIES = {"op3_preference_format": op3_preference_format}
ORACLE = {"op3_preference_format": _sql()}
