"""Operator 9, preference formatting of conversation pairs, in DataFrame functions only.

The longest common prefix of turns of a chosen and a rejected conversation is rendered
once as the prompt. What follows on either side becomes a completion of segments, each
with a flag that says whether it is trained on (assistant turns) or masked (all others).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import shared

TRAINED = "assistant"


def _turn(x: Column) -> Column:
    return F.concat(F.lit("<|"), x["role"], F.lit("|>\n"), x["text"], F.lit("<|end|>\n"))


def conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, turns`` (array of role and text in order); null roles and texts become empty, null ids go.

    Turns that tie are ordered by role and text; a row given twice is two turns. Very long
    turns are kept whole. An empty table gives no rows; other columns are not looked at.
    """
    rows = turns.filter(turns["conv_id"].isNotNull()).select(
        turns["conv_id"].cast("long").alias("conv_id"),
        F.struct(turns["turn"].alias("turn"), F.coalesce(turns["role"], F.lit("")).alias("role"), F.coalesce(turns["text"], F.lit("")).alias("text")).alias("t"),
    )
    ordered = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return rows.groupBy("conv_id").agg(ordered.alias("turns"))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """One row per pair (chosen_id, rejected_id, kind, c, r): n_prompt_turns, prompt, chosen, rejected.

    ``c`` and ``r`` are the two sides' turns; ``chosen`` and ``rejected`` become arrays of
    (text, trained). If one conversation is the other's beginning, its completion is empty;
    if both are equal, both completions are. A repeated pair has one row each time.
    """
    differs = F.array_position(F.zip_with("c", "r", lambda a, b: a.eqNullSafe(b)), F.lit(False)).cast("int")
    n = F.when(differs > 0, differs - 1).otherwise(F.least(F.size("c"), F.size("r")))
    after = lambda side: F.transform(F.slice(side, F.col("n") + 1, F.size(side)), lambda x: F.struct(_turn(x).alias("text"), (x["role"] == TRAINED).alias("trained")))
    return pairs.withColumn("n", n).select(
        "chosen_id", "rejected_id", "kind", F.col("n").alias("n_prompt_turns"),
        F.array_join(F.transform(F.slice("c", F.lit(1), F.col("n")), _turn), "").alias("prompt"), after("c").alias("chosen"), after("r").alias("rejected"),
    )


def pairs_by_opening(convs: DataFrame) -> DataFrame:
    """Preference pairs among conversations that open with the same turn.

    Of each such group the conversation with the most characters (then the smallest id) is
    chosen over every other one, so a group of n conversations gives n - 1 pairs.
    """
    chars = F.aggregate("turns", F.lit(0).cast("long"), lambda n, x: n + F.length(x["text"]))
    slim = convs.select("conv_id", F.sha2(_turn(F.col("turns")[0]), 256).alias("opening"), chars.alias("chars"))
    best = slim.groupBy("opening").agg(F.max(F.struct("chars", (-F.col("conv_id")).alias("minus"))).alias("best"), F.count("*").alias("n"))
    best = shared.materialize(best.filter("n > 1").select("opening", "n", (-F.col("best.minus")).alias("chosen_id")), "openings")
    ids = shared.salted_join(slim, best, ["opening"], shared.hot_keys(best, ["opening"], "n"), F.col("conv_id"))
    ids = ids.filter("conv_id <> chosen_id").select("chosen_id", F.col("conv_id").alias("rejected_id"))
    left = ids.join(convs.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("r")), "rejected_id")
    chosen = convs.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("c"))
    return shared.salted_join(left, chosen, ["chosen_id"], shared.hot_keys(best, ["chosen_id"], "n"), F.col("rejected_id")).select("chosen_id", "rejected_id", F.lit("opening").alias("kind"), "c", "r")


def pairs_with_stale_answers(convs: DataFrame) -> DataFrame:
    """Preference pairs of a conversation and itself with its first answer given again as the last one.

    A conversation with fewer than two answers, or with its first and last alike, has none.
    """
    answers = F.filter("turns", lambda x: x["role"] == TRAINED)
    last = F.size("turns") - F.array_position(F.transform(F.reverse("turns"), lambda x: x["role"] == TRAINED), F.lit(True)).cast("int")
    stale = F.transform("turns", lambda x, i: F.when(i == F.col("last"), F.col("answers")[0]).otherwise(x))
    rows = convs.withColumn("answers", answers).filter("size(answers) > 1").filter(F.col("answers")[0] != F.element_at("answers", -1)).withColumn("last", last)
    return rows.select(F.col("conv_id").alias("chosen_id"), F.col("conv_id").alias("rejected_id"), F.lit("stale").alias("kind"), F.col("turns").alias("c"), stale.alias("r"))


def op9_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = shared.materialize(conversations(shared.read(spark, sf_dir, "conversations")), "conversations")
    out = format_pairs(pairs_by_opening(convs).union(pairs_with_stale_answers(convs)))
    text = lambda side: F.array_join(F.transform(side, lambda x: x["text"]), "")
    trained = lambda side: F.aggregate(side, F.lit(0).cast("long"), lambda n, x: n + F.when(x["trained"], F.length(x["text"])).otherwise(0))
    return out.select(
        "chosen_id", "rejected_id", "kind", F.col("n_prompt_turns").cast("long").alias("n_prompt_turns"), F.sha2("prompt", 256).alias("prompt_sha256"),
        F.sha2(text("chosen"), 256).alias("chosen_sha256"), F.sha2(text("rejected"), 256).alias("rejected_sha256"),
        trained("chosen").alias("chosen_trained_chars"), trained("rejected").alias("rejected_trained_chars"),
    )


OP9_SQL = r"""
WITH conv AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns,
         sum(length(coalesce(text, ''))) AS chars
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
ranked AS (SELECT *, first_value(conv_id) OVER (PARTITION BY turns[1] ORDER BY chars DESC, conv_id) AS chosen_id FROM conv),
answers AS (SELECT *, [i FOR i IN range(1, len(turns) + 1) IF turns[i].role = 'assistant'] AS places FROM conv),
sides AS (
  SELECT r.chosen_id, r.conv_id AS rejected_id, 'opening' AS kind, c.turns AS c, r.turns AS r FROM ranked r JOIN conv c ON c.conv_id = r.chosen_id WHERE r.conv_id <> r.chosen_id
  UNION ALL
  SELECT conv_id, conv_id, 'stale', turns, [CASE WHEN i = places[-1] THEN turns[places[1]] ELSE turns[i] END FOR i IN range(1, len(turns) + 1)] FROM answers
  WHERE len(places) > 1 AND turns[places[1]] <> turns[places[-1]]),
both_sides AS (SELECT *, least(len(c), len(r)) AS m FROM sides),
cut AS (SELECT *, coalesce(list_position([c[i] = r[i] FOR i IN range(1, m + 1)], false) - 1, m) AS n FROM both_sides),
said AS (SELECT *, ['<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10) FOR x IN c] AS cs,
                   ['<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10) FOR x IN r] AS rs FROM cut)
SELECT chosen_id, rejected_id, kind, CAST(n AS BIGINT) AS n_prompt_turns,
       sha256(array_to_string(cs[1:n], '')) AS prompt_sha256, sha256(array_to_string(cs[n + 1:], '')) AS chosen_sha256, sha256(array_to_string(rs[n + 1:], '')) AS rejected_sha256,
       CAST(coalesce(list_sum([CASE WHEN c[i].role = 'assistant' THEN length(cs[i]) ELSE 0 END FOR i IN range(n + 1, len(c) + 1)]), 0) AS BIGINT) AS chosen_trained_chars,
       CAST(coalesce(list_sum([CASE WHEN r[i].role = 'assistant' THEN length(rs[i]) ELSE 0 END FOR i IN range(n + 1, len(r) + 1)]), 0) AS BIGINT) AS rejected_trained_chars
FROM said
"""
