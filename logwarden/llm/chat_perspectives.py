"""Chat formatting: every participant's view of a multi-party dialogue.

For each conversation and each participant the dialogue is rendered with
that participant as the assistant and everyone else as a named user; the
loss mask covers exactly the participant's own words and their end mark.
System turns stay system turns in every view and take no view of their own.

A turn is rendered as ``<|im_start|>ROLE name=NAME\\nTEXT<|im_end|>\\n``; the
assistant and the system carry no name.  A name's spaces are written as
``_``, and ``_``, ``%`` and other white space as ``%`` and two hex digits, so that
different speakers have different names.  A marker inside a text or a name
is broken with a space (``< |``), so no text can forge a turn.

Long dialogues are rendered in parts of ``PART_TURNS`` turns: the parts of a
view, in order, are the whole rendering, and no task ever holds more than a
part.  The place of a turn comes from a distributed sort (range partitions,
counts, prefix sums), so one conversation that holds a large share of all
turns is spread like any other.

Cases: turns are ordered by turn number (nulls first), then speaker and
text; repeated rows are repeated turns.  A null or blank speaker is rendered
as a user without a name and takes no view.  A null text is an empty turn.
Rows without a conversation id form one conversation, with a null id.  A
conversation of system turns alone, and an empty table, give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fenced, ordered_positions, read, stored, whole_text

#: turns of a rendered part
PART_TURNS = 64
# --- fixed values: markers and role names ---
START, END = "<|im_start|>", "<|im_end|>"
SYSTEM_ROLES = ("system",)
NAME_ESCAPES = (("%", "%25"), ("_", "%5F"), (" ", "_"), ("\t", "%09"), ("\n", "%0A"), ("\x0b", "%0B"), ("\f", "%0C"), ("\r", "%0D"))
# --- end of fixed values ---


def _safe(c: Column) -> Column:
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def _name(c: Column) -> Column:
    for plain, written in NAME_ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(written))
    return c


def perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
                 text_col: str = "text", part_turns: int = PART_TURNS) -> DataFrame:
    """One row per conversation, participant and part.

    ``conv_id, perspective, part, n_turns, text, mask, n_masked``: ``mask``
    lists the spans (start, end; code points of ``text``) that carry loss,
    ``n_masked`` is their total length.
    """
    speaker = F.trim(F.coalesce(F.col(speaker_col).cast("string"), F.lit("")))
    t = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("__turn"),
                     speaker.alias("__speaker"),
                     (speaker == "").alias("__anonymous"), whole_text(text_col).alias("__text"))
    t = ordered_positions(t, ["conv_id", "__turn", "__speaker", "__text"], "turns")
    # the place within the conversation: minus the conversation's first place
    first = t.groupBy("conv_id").agg(F.min("__pos").alias("__first")).withColumnRenamed("conv_id", "__conv")
    t = t.join(first, F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv")
    place = F.col("__pos") - F.col("__first")
    turn = F.struct(place.alias("place"), "__speaker", "__anonymous", "__text")
    # at most part_turns turns meet in one group
    parts = t.groupBy("conv_id", F.floor(place / part_turns).cast("long").alias("part")).agg(
        F.sort_array(F.collect_list(turn)).alias("__turns"))
    parts = stored(parts, "dialogue-parts")
    rotating = ~F.col("__speaker").isin(*SYSTEM_ROLES) & ~F.col("__anonymous")
    who = t.where(rotating).groupBy("conv_id", "__speaker").agg(F.count(F.lit(1)).alias("__n")).select(
        F.col("conv_id").alias("__conv"), F.col("__speaker").alias("perspective"))
    v = parts.join(who, F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv")
    me = F.col("perspective")

    def render(x: Column) -> Column:
        mine = (x["__speaker"] == me) & ~x["__anonymous"]
        head = F.when(mine, F.lit("assistant")).when(
            x["__speaker"].isin(*SYSTEM_ROLES), F.lit("system")).when(
            x["__anonymous"], F.lit("user")).otherwise(F.concat(F.lit("user name="), _safe(_name(x["__speaker"]))))
        return F.struct(F.concat(F.lit(START), head, F.lit("\n")).alias("head"),
                        F.concat(_safe(x["__text"]), F.lit(END)).alias("body"), mine.alias("mine"))

    v = fenced(v.select("conv_id", "perspective", "part", "__turns"), __said=F.transform("__turns", render)).drop("__turns")
    # running length: where each turn's body starts
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        at = acc["at"] + F.length(x["head"])
        end = at + F.length(x["body"])
        span = F.array(F.struct(at.alias("start"), end.alias("end")))
        return F.struct((end + 1).alias("at"), F.when(x["mine"], F.concat(acc["spans"], span)).otherwise(
            acc["spans"]).alias("spans"))

    text = F.array_join(F.transform("__said", lambda x: F.concat(x["head"], x["body"], F.lit("\n"))), "")
    v = fenced(v, text=text, mask=F.aggregate("__said", start, step, lambda a: a["spans"]))
    return v.select("conv_id", "perspective", "part", F.size("__said").alias("n_turns"), "text", "mask",
                    F.aggregate("mask", F.lit(0), lambda a, s: a + s["end"] - s["start"]).alias("n_masked"))


def _name_sql(c: str) -> str:
    for plain, written in NAME_ESCAPES:
        c = f"replace({c}, chr({ord(plain)}), '{written}')"
    return c


ORACLE = f"""
WITH t AS (
  SELECT conv_id, turn, trim(coalesce(role, '')) AS speaker, trim(coalesce(role, '')) = '' AS anonymous, coalesce(text, '') AS text FROM conversations),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, text) - 1 AS place FROM t),
who AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system' AND NOT anonymous),
r AS (
  SELECT n.conv_id, perspective, place // {PART_TURNS} AS part, place, (speaker = perspective AND NOT anonymous) AS mine,
    '{START}' || CASE WHEN speaker = perspective AND NOT anonymous THEN 'assistant'
                      WHEN speaker = 'system' THEN 'system' WHEN anonymous THEN 'user'
                      ELSE 'user name=' || replace({_name_sql("speaker")}, '<|', '< |') END || chr(10) AS head,
    replace(text, '<|', '< |') || '{END}' AS body
  FROM n JOIN who ON n.conv_id IS NOT DISTINCT FROM who.conv_id),
p AS (
  SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, perspective, part ORDER BY place) - length(body) - 1 AS beg
  FROM r)
SELECT conv_id, perspective, CAST(part AS BIGINT) AS part, CAST(count(*) AS INTEGER) AS n_turns,
  string_agg(head || body || chr(10), '' ORDER BY place) AS text,
  coalesce(string_agg(CASE WHEN mine THEN CAST(beg AS BIGINT) || '-' || CAST(beg + length(body) AS BIGINT) END, ',' ORDER BY place), '') AS mask,
  CAST(sum(CASE WHEN mine THEN length(body) ELSE 0 END) AS INTEGER) AS n_masked
FROM p GROUP BY conv_id, perspective, part
"""


def query(spark, sf_dir) -> DataFrame:
    v = perspectives(read(spark, sf_dir, "conversations"))
    return v.withColumn("mask", F.array_join(F.transform("mask", lambda s: F.concat_ws("-", s["start"], s["end"])), ","))
