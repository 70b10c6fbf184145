"""Conversations as training examples: every assistant turn becomes an example of its own.

An example is the text of all turns up to a target turn, and a span, the only part to be learned: the target's text.
Each turn is written as ``### role: text</turn>`` and a newline. Inside roles and texts, backslash, ``<`` and ``#`` (in roles also the colon) are written as
a backslash and a letter, so the marks occur nowhere but where the template puts them, and reading back gives every text as it was.

Everything here is built from DataFrame functions. A conversation's turns meet in one row, since an example holds them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.llm.common import prepare, table

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
ESCAPES = [("\\", "\\b"), ("<", "\\l"), ("#", "\\h"), (":", "\\c")]
TARGET_ROLE = "assistant"


def escape(text: Column, role: bool = False) -> Column:
    for plain, written in ESCAPES if role else ESCAPES[:3]:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):  # the backslash last, or it would seem to begin other escapes
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def to_examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, ``last_turn`` (how many turns the example holds), ``formatted``, ``loss_start`` and ``loss_length`` (code points), ``closes``.

    Turns are ordered by turn, then role, then text, nulls first; repeated rows are turns like others; a null role or text is empty; rows
    without conv_id form one conversation. A conversation that does not end with an assistant gets one more example that
    holds all turns and has nothing to learn (null span), so that no turn is lost; filter on ``loss_start`` for training.
    ``closes`` marks the example that holds the whole conversation. Other columns are not read.
    """
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    whole = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    written = F.transform("turns", lambda t: F.concat(F.lit(OPEN), escape(t["role"], role=True), F.lit(MIDDLE), escape(t["text"]), F.lit(CLOSE)))
    n = F.size("turns")
    ends = F.filter(F.sequence(F.lit(1), n), lambda k: (F.element_at("turns", k)["role"] == TARGET_ROLE) | (k == n))
    prefix = whole.select("conv_id", "turns", written.alias("written"), F.explode(ends).alias("last_turn"))
    target = F.element_at("turns", F.col("last_turn"))
    length = F.when(target["role"] == TARGET_ROLE, F.length(escape(target["text"])))
    examples = prefix.select(
        "conv_id",
        "last_turn",
        F.array_join(F.slice("written", F.lit(1), F.col("last_turn")), "").alias("formatted"),
        length.alias("loss_length"),
        (F.col("last_turn") == n).alias("closes"),
    )
    return examples.withColumn("loss_start", F.length("formatted") - len(CLOSE) - F.col("loss_length"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: an array of (role, text)."""
    pieces = F.split(formatted, CLOSE, -1)
    whole = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        inner = F.substring(piece, len(OPEN) + 1, 2**31 - 1)
        role = F.substring_index(inner, MIDDLE, 1)
        text = F.substring(inner, F.length(role) + len(MIDDLE) + 1, F.lit(2**31 - 1))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(whole, turn)


def read_loss(formatted: Column, loss_start: Column, loss_length: Column) -> Column:
    """The text under the loss mask; null if there is none."""
    return unescape(F.substring(formatted, loss_start + 1, loss_length))


def digest(examples: DataFrame) -> DataFrame:
    """One row for each conversation, read back from its examples."""
    turns = read_turns(F.col("formatted"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = examples.select(
        "conv_id",
        "last_turn",
        F.when(F.col("closes"), F.size(turns)).cast("long").alias("n_turns"),
        F.when(F.col("closes"), F.sha2(said, 256)).alias("turns_sha256"),
        F.coalesce(read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_length")), F.lit("")).alias("loss"),
        F.length("formatted").cast("long").alias("chars"),
    )
    loss = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("last_turn", "loss"))), lambda x: x["loss"]), "")
    return read.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.sum("chars").alias("formatted_chars"),
    )


CONTROL_TEXT = r"\### Assistant: </turn> ok"


def op4_chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    own = F.array(*[F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(CONTROL_TEXT).alias("text")) for k, role in enumerate(("user", TARGET_ROLE))])
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(spark.range(1).select(F.inline(own)))
    return digest(to_examples(turns))


OP4_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, k, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS own(k, r)),
sized AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\<#]', '', 'g')) + length(role) + length(regexp_replace(role, '[^\\<#:]', '', 'g')) + 14 AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k, count(*) OVER (PARTITION BY conv_id) AS n
  FROM said),
placed AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM sized),
told AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY k) AS turns,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY k), '') AS loss,
    sum(CASE WHEN role = 'assistant' OR k = n THEN upto END)::BIGINT AS formatted_chars
  FROM placed GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM told
"""
