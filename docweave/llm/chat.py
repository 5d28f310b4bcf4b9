"""Chat formatting by prefix-target expansion, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.session import read_table

#: A turn is ``[ROLE]role[INST]text[/INST]``, an assistant's ``<s>text</s>``.
_MARKS = r"([<\[])(/?s>|/?INST\]|ROLE\])"
_ESCAPED = r"([<\[])\\(/?s>|/?INST\]|ROLE\])"
_TURN = r"(?s)\[ROLE\].*?\[INST\].*?\[/INST\]|<s>.*?</s>"


def escape(text: Column) -> Column:
    """Backslashes doubled, and one put into every control string: reversible for any text."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _MARKS, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.replace(F.regexp_replace(text, _ESCAPED, "$1$2"), F.lit("\\\\"), F.lit("\\"))


def _render(role: Column, text: Column) -> Column:
    return F.when(role == "assistant", F.concat(F.lit("<s>"), escape(text), F.lit("</s>"))).otherwise(
        F.concat(F.lit("[ROLE]"), escape(role), F.lit("[INST]"), escape(text), F.lit("[/INST]")))


def chat_examples(conversations: DataFrame) -> DataFrame:
    """One training example per assistant turn (columns ``conv_id, turn, role, text``).

    Returns ``conv_id, target`` (index of the trainable turn in its conversation), ``formatted``
    (all turns up to and with it), ``loss_start, loss_chars`` (code points of ``formatted`` under the loss
    mask: the reply alone). Turns after the last reply, or all turns of a conversation without one, are one more
    example with ``target`` null and an empty mask, so no turn is lost. Control strings inside roles
    and texts are escaped reversibly.

    Turns go by ``turn`` (nulls first), then role, then text; repeated rows are turns of their own. Null
    roles and texts are empty. Rows without ``conv_id`` are one conversation. Other
    columns are ignored; an empty table gives no rows.

    A conversation is formatted once; its examples are prefixes of that string, so one exchange by
    ``conv_id`` is all that moves. The output is quadratic in a conversation's turns by the method.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.select("conv_id", F.struct("turn", role.alias("role"), text.alias("text")).alias("t"))
    listed = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    parts = F.transform("ts", lambda t: F.struct((t["role"] == "assistant").alias("reply"), _render(t["role"], t["text"]).alias("s")))
    rendered = listed.select("conv_id", parts.alias("ps")).withColumn(
        "ends", F.aggregate("ps", F.array().cast("array<int>"), lambda ends, p: F.concat(
            ends, F.array(F.coalesce(F.element_at(ends, F.when(F.size(ends) > 0, F.lit(-1))), F.lit(0)) + F.char_length(p["s"])))))
    whole = rendered.select("conv_id", "ps", "ends", F.array_join(F.transform("ps", lambda p: p["s"]), "").alias("all"))
    marks = F.filter(F.transform("ps", lambda p, i: F.struct(i.alias("i"), p["reply"].alias("reply"))),
                     lambda m: m["reply"] | (m["i"] == F.size("ps") - 1))
    each = whole.select("conv_id", "all", "ends", "ps", F.explode(marks).alias("m"))
    end = F.get("ends", F.col("m.i"))
    begin = F.coalesce(F.when(F.col("m.i") > 0, F.get("ends", F.col("m.i") - 1)), F.lit(0))
    return each.select(
        "conv_id", F.when(F.col("m.reply"), F.col("m.i")).alias("target"), F.substring("all", F.lit(1), end).alias("formatted"),
        F.when(F.col("m.reply"), begin + 3).alias("loss_start"),
        F.when(F.col("m.reply"), end - begin - 7).otherwise(0).alias("loss_chars"))


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the formatted examples alone: ``conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars`` (code points of all its examples)."""
    masked = F.when(F.col("target").isNotNull(), F.struct("target", unescape(
        F.substring("formatted", F.col("loss_start") + 1, F.col("loss_chars"))).alias("text")))
    per = examples.groupBy("conv_id").agg(
        F.max_by("formatted", F.char_length("formatted")).alias("longest"), F.array_sort(F.collect_list(masked)).alias("masked"),
        F.sum(F.char_length("formatted").cast("long")).alias("formatted_chars"))

    def turn(t: Column) -> Column:
        reply = t.startswith("<s>")
        cut = F.instr(t, "[INST]")
        role = F.when(reply, F.lit("assistant")).otherwise(unescape(F.substring(t, F.lit(7), cut - 7)))
        text = F.when(reply, F.substring(t, F.lit(4), F.char_length(t) - 7)).otherwise(
            F.substring(t, cut + 6, F.char_length(t) - cut - 12))
        return F.concat(role, F.lit("\n"), unescape(text), F.lit("\n"))

    turns = F.regexp_extract_all("longest", F.lit(_TURN), F.lit(0))
    loss = F.array_join(F.transform("masked", lambda m: m["text"]), "")
    return per.select("conv_id", turns.alias("turns"), loss.alias("loss"), "formatted_chars").select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(F.array_join(F.transform("turns", turn), ""), "UTF-8"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"), "formatted_chars")


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "conversations")
    kinds = dict(table.dtypes)
    probe = "</s>[INST] ok [/INST]"
    planted = spark.range(2).select(F.lit(-1).cast(kinds["conv_id"]).alias("conv_id"), F.col("id").cast(kinds["turn"]).alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    return read_back(chat_examples(table.select("conv_id", "turn", "role", "text").unionByName(planted)))


ORACLE_OP10 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
    count(*) OVER (PARTITION BY conv_id) AS n,
    CASE WHEN role = 'assistant' THEN 7 ELSE 19
      + length(regexp_replace(replace(role, '\', '\\'), '([<\[])(/?s>|/?INST\]|ROLE\])', '\1.\2', 'g')) END
      + length(regexp_replace(replace(text, '\', '\\'), '([<\[])(/?s>|/?INST\]|ROLE\])', '\1.\2', 'g')) AS chars FROM t),
c AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM e)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  coalesce(sum(upto) FILTER (role = 'assistant' OR k = n), 0)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
