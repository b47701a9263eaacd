r"""Chat formatting with a checked round trip. Native.

A turn is rendered as ``### role: text</turn>`` and a line break. The rendered turn is parsed
again by the same deterministic parser that reads whole conversations; where the turn found is
not the turn given, or a control string would stand inside it, the turn is rendered escaped
instead, under the header ``##! role: ``. Escapes: ``\\`` for a backslash, ``\e`` for the turn
end, ``\h`` and ``\i`` for the headers, ``\c`` for a colon. An escaped turn holds no control
string and its backslashes pair up from the left, so it always reads back identical.

Cases. NULL text and NULL role count as empty. Turns are in the order (turn, role, text), NULL
turns first, so ties and repeated rows have a fixed place. A NULL conversation id is one
conversation. An empty table gives no rows. Only the four named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

# The control strings and their escapes, in the order in which they are replaced.
PLAIN, ESCAPED, END = "### ", "##! ", "</turn>"
CODES = (("\\", "\\\\"), (END, "\\e"), ("###", "\\h"), ("##!", "\\i"), (":", "\\c"))
CONTROLS = (END, "###", "##!")


def escape(text: Column) -> Column:
    for raw, code in CODES:
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    """Pairs of backslashes are split off first, so that ``\\\\e`` is not read as an end."""

    def part(p: Column) -> Column:
        for raw, code in CODES[1:]:
            p = F.replace(p, F.lit(code), F.lit(raw))
        return p

    return F.array_join(F.transform(F.split(text, r"\\\\"), part), "\\")


def render(role: Column, text: Column, escaped: bool) -> Column:
    if escaped:
        role, text = escape(role), escape(text)
    return F.concat(F.lit(ESCAPED if escaped else PLAIN), role, F.lit(": "), text, F.lit(END + "\n"))


def parse_turn(block: Column) -> Column:
    """(role, text, escaped) of what stands before a turn's end."""
    rest = F.substring(block, 5, 2147483647)
    colon = F.instr(rest, ": ")
    role, body = rest.substr(F.lit(1), colon - 1), rest.substr(colon + 2, F.length(rest))
    escaped = F.startswith(block, F.lit(ESCAPED))
    return F.struct(
        F.when(escaped, unescape(role)).otherwise(role).alias("role"),
        F.when(escaped, unescape(body)).otherwise(body).alias("text"),
    )


def parse(formatted: Column) -> Column:
    """Turns of a formatted conversation, in order: array of (role, text)."""
    blocks = F.split(formatted, END + "\n", -1)
    return F.transform(F.slice(blocks, F.lit(1), F.size(blocks) - 1), parse_turn)


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, identical, and loss_spans: (start, length, escaped) of assistant texts.

    Starts count code points from 0 and point at the text as it stands in ``formatted``. Turns
    are rendered and checked row by row; only finished pieces meet in their conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    role, text = F.col("role"), F.col("text")
    given = F.array(F.struct(role.alias("role"), text.alias("text")))
    clash = role.contains(":")
    for control in CONTROLS:
        clash = clash | role.contains(control) | text.contains(control)
    plain = render(role, text, escaped=False)
    fits = (parse(plain) == given) & ~clash
    rows = rows.withColumn("plain", fits).withColumn(
        "piece", F.when(F.col("plain"), plain).otherwise(render(role, text, escaped=True))
    )
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    head = F.length(F.when(F.col("plain"), role).otherwise(escape(role))) + F.lit(len(PLAIN) + 2)
    rows = rows.withColumn("at", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + head)
    rows = rows.withColumn("span", F.struct(
        F.col("at").alias("start"),
        (F.length("piece") - head - F.lit(len(END) + 1)).cast("long").alias("length"),
        (~F.col("plain")).alias("escaped"),
    ))
    made = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "role", "text", "piece", "span"))).alias("t"))
    made = made.withColumn("formatted", F.array_join(F.transform("t", lambda t: t["piece"]), ""))
    source = F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    marked = F.transform(F.filter("t", lambda t: t["role"] == "assistant"), lambda t: t["span"])
    return made.select("conv_id", "formatted", (parse(F.col("formatted")) == source).alias("identical"), marked.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The digests of formatted conversations, from nothing but the text and its loss mask."""

    def masked(span: Column) -> Column:
        cut = F.col("formatted").substr((span["start"] + 1).cast("int"), span["length"].cast("int"))
        return F.when(span["escaped"], unescape(cut)).otherwise(cut)

    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = formatted.withColumns(
        {"turns": parse(F.col("formatted")), "loss": F.array_join(F.transform("loss_spans", masked), "")}
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.when(F.col("identical"), True).otherwise(F.raise_error(F.concat(F.lit("does not read back identical: "), F.col("conv_id").cast("string"))).cast("boolean")).alias("identical"),
    )


# The conversation that every run formats besides the table's.
PROBE_TEXT = "\\### Assistant: </turn> ok"
PROBE_ID = -7


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    return read_back(format_conversations(turns.unionByName(probe)))


OP4_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, role || chr(1) || text AS both_parts,
    replace(replace(replace(replace(replace(role, '\', '\\'), '</turn>', '\e'), '###', '\h'), '##!', '\i'), ':', '\c') AS er,
    replace(replace(replace(replace(replace(text, '\', '\\'), '</turn>', '\e'), '###', '\h'), '##!', '\i'), ':', '\c') AS et
  FROM c),
f AS (
  SELECT *, CASE WHEN contains(role, ':') OR contains(both_parts, '</turn>') OR contains(both_parts, '###') OR contains(both_parts, '##!')
                 THEN length(er) + length(et) ELSE length(role) + length(text) END + 14 AS len
  FROM e)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(len) AS BIGINT) AS formatted_chars, true AS identical
FROM f GROUP BY conv_id
"""
