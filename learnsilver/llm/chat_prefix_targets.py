"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns as
context, and that reply alone trainable. A turn is written as an opening mark
of its role, its escaped text, and a closing mark. Inside texts and roles a
backslash follows every ``[``, ``<`` and backslash, so that no mark can occur
there, and taking those backslashes out again gives the text back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPENING = {"system": "[SYS]", "user": "[INST]", "assistant": "[ANS]"}
#: Any other role stands, escaped, between these two.
OTHER, OTHER_END = "[ROLE]", "[:]"
CLOSING = "</s>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[<\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[<\\])\\", "$1")


def opening(role: Column) -> Column:
    known = reduce(
        lambda case, mark: case.when(role == mark[0], F.lit(mark[1])), OPENING.items(), F
    )
    return known.otherwise(F.concat(F.lit(OTHER), escape(role), F.lit(OTHER_END)))


def examples(turns: DataFrame) -> DataFrame:
    """(conv_id, example, text, loss_start, loss_length) of rows (conv_id, turn, role, text).

    ``example`` is the place of the target among the turns, from 0; the mask
    covers ``loss_length`` code points of ``text`` after the first
    ``loss_start``. Turns are in the order of ``turn`` (null first, ties by
    role and text). A null text or role is empty, a null conv_id is a
    conversation like any other, repeated rows are turns of their own. Turns
    after the last assistant turn make one more example, in which nothing is
    trainable, so that no turn is lost. Other columns are not looked at.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    said = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    marked = said.select(
        "conv_id", "turn", "role", "text",
        opening(F.col("role")).alias("mark"), escape(F.col("text")).alias("escaped"),
    )
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    written = F.concat("mark", "escaped", F.lit(CLOSING))
    placed = marked.select(
        "*",
        (F.row_number().over(order) - 1).cast("long").alias("example"),
        F.lead(F.lit(1)).over(order).isNull().alias("last"),
        F.collect_list(written).over(before).alias("written"),
    )
    target = F.col("role") == "assistant"
    formatted = placed.filter(target | F.col("last")).select(
        "conv_id", "example", target.alias("target"), "escaped",
        F.array_join("written", "").alias("text"),
    )
    length = F.when(F.col("target"), F.length("escaped")).otherwise(0).cast("long")
    start = F.length("text").cast("long") - len(CLOSING) - F.length("escaped")
    return formatted.select(
        "conv_id", "example", "text", start.alias("loss_start"), length.alias("loss_length")
    )


def read_turns(text: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""

    def turn(written: Column) -> Column:
        rest = F.substring_index(written, OTHER_END, -1)
        case = F
        for role, mark in OPENING.items():
            case = case.when(
                written.startswith(mark),
                F.struct(
                    F.lit(role).alias("role"),
                    unescape(F.substr(written, F.lit(len(mark) + 1))).alias("text"),
                ),
            )
        role = F.substr(F.substring_index(written, OTHER_END, 1), F.lit(len(OTHER) + 1))
        return case.otherwise(
            F.struct(unescape(role).alias("role"), unescape(rest).alias("text"))
        )

    pieces = F.split(text, CLOSING)  # the last is what follows the last closing mark: nothing
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def read_target(text: Column, start: Column, length: Column) -> Column:
    """The text under the mask."""
    return unescape(F.substr(text, (start + 1).cast("int"), length.cast("int")))


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from its examples.

    The turns come from its last example, which holds them all, and the loss
    text from the masks of all its examples.
    """
    masked = read_target(F.col("text"), F.col("loss_start"), F.col("loss_length"))
    read = formatted.select(
        "conv_id", "example", "text", F.length("text").alias("chars"), masked.alias("masked")
    )
    grouped = read.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("text"),
        F.array_sort(F.collect_list(F.struct("example", "masked"))).alias("masked"),
        F.sum("chars").alias("formatted_chars"),
    )
    parsed = grouped.select(
        "conv_id",
        "formatted_chars",
        read_turns(F.col("text")).alias("turns"),
        F.array_join("masked.masked", "").alias("loss"),
    )
    told = F.transform("turns", lambda turn: F.concat(turn.role, F.lit("\n"), turn.text, F.lit("\n")))
    return parsed.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


#: The turns that the query adds to the table: control strings as text.
TRAP = "</s>[INST] ok [/INST]"

ORACLE_SQL = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{TRAP}' UNION ALL SELECT -1, 1, 'assistant', '{TRAP}'
), sized AS (
  SELECT *,
    CASE role WHEN 'system' THEN 5 WHEN 'user' THEN 6 WHEN 'assistant' THEN 5
         ELSE 9 + length(role) + length(regexp_replace(role, '[^\\[<\\\\]', '', 'g')) END
      + length(text) + length(regexp_replace(text, '[^\\[<\\\\]', '', 'g')) + 4 AS chars
  FROM said
), placed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto,
         lead(1) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS NULL AS at_end
  FROM sized
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR at_end) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""
