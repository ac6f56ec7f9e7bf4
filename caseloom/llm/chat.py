"""Preference formatting: chosen and rejected conversations as one prompt and two masked completions.

The longest common prefix of turns is rendered once, as the prompt. The turns
after it are the completions; in them only what an assistant says, with the
mark that ends its turn, counts for the loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.shared import saved, small_side, table

#: fixed values of the chat format
START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


def conversations(turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(id, turns) with one row per non-null id: its turns (role, text) by turn, role and text.

    Null roles and texts are empty; a null turn comes first; rows that repeat a
    turn stay. Rows without an id belong to no conversation and are left out.
    """
    said = F.struct(
        F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")
    )
    whole = turns.where(F.col(id).isNotNull()).groupBy(F.col(id).alias("id")).agg(F.array_sort(F.collect_list(said)).alias("turns"))
    return whole.select("id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def _following(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (their columns are ``order``, none null, rows distinct) with next, the row after it in the whole table; null for the last.

    Rows are dealt by ranges; within a range the next row is its neighbour, for
    the last of a range it is the first of the next one.
    """
    ranged = saved(rows.select(*order).repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    row = F.struct(*order)
    starts = ranged.groupBy("part").agg(F.min(row).alias("start"))
    after = starts.select("part", F.lead("start").over(Window.orderBy("part")).alias("after"))  # one row per range
    inside = F.lead(row).over(Window.partitionBy("part").orderBy(*order))
    return ranged.withColumn("inside", inside).join(small_side(saved(after)), "part").select(*order, F.coalesce("inside", "after").alias("next"))


def _others(whole: DataFrame) -> DataFrame:
    """(id, other, diverges): which conversation each is set against.

    Equal conversations form a class, known by its smallest id. A class is set
    against the next one, by that id, of those with the same first turn, after
    the last the first: they diverge somewhere after it. One that is alone with
    its first turn takes the next class of the whole table, round again, which
    is itself only where there is no other.
    """
    first = F.md5(F.coalesce(F.to_json(F.get("turns", F.lit(0))), F.lit("")).cast("binary"))
    digests = saved(whole.select("id", first.alias("first"), F.md5(F.to_json("turns").cast("binary")).alias("same")))
    classes = saved(digests.groupBy("same").agg(F.min("id").alias("rep"), F.min("first").alias("first")))
    alike = classes.groupBy("first").agg(F.min("rep").alias("start"), F.count(F.lit(1)).alias("n"))
    near = _following(classes, ["first", "rep"]).join(alike, "first")
    around = _following(classes, ["rep"]).select("rep", F.col("next.rep").alias("around"))
    least = classes.agg(F.min("rep")).first()[0]
    round_ = F.when(F.col("next.first") == F.col("first"), F.col("next.rep")).otherwise(F.col("start"))
    chosen = near.join(around, "rep").select(
        "rep",
        F.when(F.col("n") > 1, round_).otherwise(F.coalesce("around", F.lit(least))).alias("other"),
        (F.col("n") > 1).alias("diverges"),
    )
    return digests.join(classes.select("same", "rep"), "same").join(chosen, "rep").select("id", "other", "diverges")


def paired(whole: DataFrame) -> DataFrame:
    """(id, other, chosen, rejected): each conversation up to its last reply, and one to set it against.

    See ``_others``. Where the other one begins alike, it is the rejected one, up
    to its own last reply. Else the rejected one is the chosen one with its last
    reply replaced by the other's last reply, or without it if the other has
    none; a conversation without a reply is then its own rejected one.
    """
    places = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: F.element_at("turns", i)["role"] == ASSISTANT)
    last = F.when(F.size("turns") > 0, F.coalesce(F.array_max(places), F.lit(0))).otherwise(0)
    upto = F.when(F.col("last") > 0, F.slice("turns", F.lit(1), F.col("last"))).otherwise(F.col("turns"))
    placed = whole.withColumn("last", last).select("id", "last", upto.alias("chosen"))
    reply = F.when(F.col("last") > 0, F.element_at("chosen", -1))
    theirs = placed.select(F.col("id").alias("other"), F.col("chosen").alias("theirs"), reply.alias("reply"))
    joined = placed.join(_others(whole), "id").join(theirs, "other")
    before = F.slice("chosen", F.lit(1), F.greatest(F.col("last") - 1, F.lit(0)))
    replaced = F.when(F.col("reply").isNull(), before).otherwise(F.concat(before, F.array("reply")))
    against = F.when(F.col("diverges"), F.col("theirs")).when(F.col("last") > 0, replaced).otherwise(F.col("chosen"))
    return joined.select("id", "other", "chosen", against.alias("rejected"))


def common_turns(a: Column, b: Column) -> Column:
    """How many turns two arrays share from the start on."""
    n = F.least(F.size(a), F.size(b))
    same = F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.element_at(a, i) == F.element_at(b, i))).otherwise(F.array())
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(n).cast("int")


def segments(turns: Column) -> Column:
    """The rendered turns as (text, loss) in order: loss is true where training counts."""
    return F.flatten(
        F.transform(
            turns,
            lambda t: F.array(
                F.struct(F.concat(F.lit(START), t["role"], F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
                F.struct(F.concat(t["text"], F.lit(END)).alias("text"), (t["role"] == ASSISTANT).alias("loss")),
                F.struct(F.lit("\n").alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )


def rendered(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda s: s["text"]), "")


def loss_chars(parts: Column) -> Column:
    counted = F.transform(parts, lambda s: F.when(s["loss"], F.length(s["text"])).otherwise(0).cast("long"))
    return F.aggregate(counted, F.lit(0).cast("long"), lambda a, b: a + b)


def format_preferences(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """``pairs`` with n_common, prompt, and the segments chosen_parts and rejected_parts of the two completions.

    Columns of ``pairs`` with one of these names are replaced. Both
    conversations are arrays of (role, text); a null one is empty. If one
    is the start of the other its completion is empty; if they are equal both are.
    """
    pairs = pairs.drop(*{"n_common", "prompt", "chosen_parts", "rejected_parts"} - {chosen, rejected})
    none = F.array().cast("array<struct<role:string,text:string>>")
    a, b = F.coalesce(F.col(chosen), none), F.coalesce(F.col(rejected), none)
    out = pairs.withColumn("n_common", common_turns(a, b))
    rest = lambda c: F.slice(c, F.col("n_common") + 1, F.greatest(F.size(c) - F.col("n_common"), F.lit(0)))
    return out.select(
        "*",
        rendered(segments(F.slice(a, F.lit(1), F.col("n_common")))).alias("prompt"),
        segments(rest(a)).alias("chosen_parts"),
        segments(rest(b)).alias("rejected_parts"),
    )


def op6_chat_preferences(spark, folder: str) -> DataFrame:
    """Every conversation as a preference pair against the next one that begins alike, or the next one's last reply."""
    out = format_preferences(paired(conversations(table(spark, folder, "conversations"))))
    return out.select(
        F.col("id").alias("conv_id"),
        F.col("other").alias("rejected_from"),
        "n_common",
        "prompt",
        rendered(F.col("chosen_parts")).alias("chosen"),
        rendered(F.col("rejected_parts")).alias("rejected"),
        loss_chars(F.col("chosen_parts")).alias("chosen_loss_chars"),
        loss_chars(F.col("rejected_parts")).alias("rejected_loss_chars"),
    )


_TURN = "'<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)"
_LOSS = "CASE WHEN x.role = 'assistant' THEN length(x.text) + 10 ELSE 0 END"
OP6_SQL = f"""
WITH c AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
k AS (SELECT *, coalesce(list_max([i FOR i IN range(1, len(turns) + 1) IF turns[i].role = 'assistant']), 0) AS last FROM c),
g AS (SELECT turns, turns[1] AS first, min(conv_id) AS rep FROM c GROUP BY turns),
o AS (SELECT turns, count(*) OVER f > 1 AS diverges, CASE WHEN count(*) OVER f > 1 THEN coalesce(lead(rep) OVER n, first_value(rep) OVER n)
    ELSE coalesce(lead(rep) OVER (ORDER BY rep), first_value(rep) OVER (ORDER BY rep)) END AS other
    FROM g WINDOW f AS (PARTITION BY first), n AS (PARTITION BY first ORDER BY rep)),
p AS (SELECT k.conv_id, o.other, CASE WHEN k.last > 0 THEN k.turns[1:k.last] ELSE k.turns END AS a,
    CASE WHEN diverges THEN CASE WHEN r.last > 0 THEN r.turns[1:r.last] ELSE r.turns END
      WHEN k.last = 0 THEN k.turns WHEN r.last = 0 THEN k.turns[1:k.last - 1]
      ELSE list_concat(k.turns[1:k.last - 1], [r.turns[r.last]]) END AS b
    FROM k JOIN o ON o.turns = k.turns JOIN k AS r ON r.conv_id = o.other),
m AS (SELECT *, coalesce(list_min([i FOR i IN range(1, least(len(a), len(b)) + 1) IF a[i] <> b[i]]) - 1, least(len(a), len(b))) AS n_common FROM p)
SELECT conv_id, other AS rejected_from, CAST(n_common AS INT) AS n_common,
  array_to_string([{_TURN} FOR x IN a[1:n_common]], '') AS prompt,
  array_to_string([{_TURN} FOR x IN a[n_common + 1:]], '') AS chosen,
  array_to_string([{_TURN} FOR x IN b[n_common + 1:]], '') AS rejected,
  CAST(coalesce(list_sum([{_LOSS} FOR x IN a[n_common + 1:]]), 0) AS BIGINT) AS chosen_loss_chars,
  CAST(coalesce(list_sum([{_LOSS} FOR x IN b[n_common + 1:]]), 0) AS BIGINT) AS rejected_loss_chars
FROM m"""
