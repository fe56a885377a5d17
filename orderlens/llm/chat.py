"""Chat formatting: typed content parts flattened into one escaped, reversible template per conversation.

A visitor maps each part of a turn to text: text parts are escaped, an image, audio or document part becomes a
placeholder that carries its ordinal within the conversation, its reference is recorded under that ordinal, and
its expanded token count is summed. Everything is DataFrame functions.

Layout of a turn: ``<turn ROLE>BODY</turn>`` and a line break. ``<``, ``>``, ``#`` and the backslash of roles and
texts become ``\\l``, ``\\g``, ``\\h`` and ``\\b``, so no text can hold a control string and the way back is unique.

Defined cases: a null role, text, kind or part list is empty; turns sort by (turn, role, body), nulls first, and
repeated rows are turns of their own; rows without a conv_id form one conversation under null; an unknown kind is
handled as a document; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Character and its escape letter; the backslash is escaped first and restored last.
ESCAPES = [("\\", "\\b"), ("<", "\\l"), (">", "\\g"), ("#", "\\h")]

CLOSE = "</turn>\n"

#: Tokens that one unit of an attachment takes: an image patch, a second of audio, a page.
TOKENS_PER_UNIT = {"image": 1, "audio": 25, "document": 400}

PARTS = "array<struct<kind:string,text:string,ref:string,units:bigint>>"


def escape(text: Column) -> Column:
    for raw, code in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for raw, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def text_parts(text: Column) -> Column:
    """A plain text as its only part."""
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            text.alias("text"),
            F.lit(None).cast("string").alias("ref"),
            F.lit(0).cast("bigint").alias("units"),
        )
    )


def _visit(part: Column, ordinal: Column) -> Column:
    attachment = F.concat(
        F.lit("<"), F.when(part["kind"].isin("image", "audio"), part["kind"]).otherwise(F.lit("document")),
        F.lit(" "), ordinal.cast("string"), F.lit(">"),
    )
    return F.when(part["kind"] == "text", escape(F.coalesce(part["text"], F.lit("")))).otherwise(attachment)


def _tokens(part: Column) -> Column:
    units = F.coalesce(part["units"], F.lit(0))
    return (
        F.when(part["kind"] == "text", F.lit(0))
        .when(part["kind"] == "image", units * TOKENS_PER_UNIT["image"])
        .when(part["kind"] == "audio", units * TOKENS_PER_UNIT["audio"])
        .otherwise(units * TOKENS_PER_UNIT["document"])
        .cast("bigint")
    )


def format_conversations(turns: DataFrame) -> DataFrame:
    """One formatted conversation per conv_id from rows (conv_id, turn, role, parts of type ``PARTS``).

    Returns conv_id, formatted, loss_spans (start and length in characters of each assistant body), attachments
    (ordinal, kind, ref, tokens in order of appearance) and expanded_tokens (of all attachments).
    """
    parts = F.transform(
        F.coalesce(F.col("parts"), F.expr(f"cast(array() as {PARTS})")),
        lambda p: F.struct(F.coalesce(p["kind"], F.lit("text")).alias("kind"), p["text"].alias("text"),
                           p["ref"].alias("ref"), p["units"].alias("units")),
    )
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts"))
    rows = rows.withColumn("held", F.filter("parts", lambda p: p["kind"] != "text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "parts")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("offset", F.coalesce(F.sum(F.size("held")).over(before), F.lit(0))).withColumn(
        "place", F.row_number().over(order)
    )
    pieces = F.transform(
        "parts",
        lambda p, i: _visit(
            p, F.col("offset") + F.size(F.filter(F.slice("parts", F.lit(1), i), lambda q: q["kind"] != "text"))
        ),
    )
    head = F.concat(F.lit("<turn "), escape(F.col("role")), F.lit(">"))
    rows = rows.select(
        "conv_id", "place", "role", "offset", "held", head.alias("head"), F.array_join(pieces, "").alias("body")
    ).withColumn("piece", F.concat("head", "body", F.lit(CLOSE)))
    start = F.coalesce(F.sum(F.length("piece")).over(
        Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("start", start + F.length("head"))
    turn = F.struct("place", "piece", "role", "start", F.length("body").alias("size"), "offset", "held")
    rows = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    spans = F.transform(
        F.filter("turns", lambda t: t["role"] == "assistant"),
        lambda t: F.struct(t["start"].alias("start"), t["size"].alias("size")),
    )
    attachments = F.flatten(F.transform("turns", lambda t: F.transform(t["held"], lambda p, i: F.struct(
        (t["offset"] + i).alias("ordinal"), p["kind"].alias("kind"), p["ref"].alias("ref"), _tokens(p).alias("tokens")
    ))))
    return rows.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        spans.alias("loss_spans"),
        attachments.alias("attachments"),
    ).withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]))


def read_back(formatted: Column) -> Column:
    """Roles and bodies of a formatted conversation; a body is unescaped, placeholders stay as they stand."""
    pieces = F.filter(F.split(formatted, "</turn>\n", -1), lambda piece: piece != "")
    return F.transform(pieces, lambda piece: F.struct(
        unescape(F.substring_index(F.substr(piece, F.lit(7)), ">", 1)).alias("role"),
        unescape(F.substr(piece, F.locate(">", piece) + 1)).alias("text"),
    ))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["size"]))), ""
    )


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """Digests of the formatted conversations, taken from the output: see ``format_conversations``."""
    turns = conversations.select("conv_id", "turn", "role", text_parts(F.col("text")).alias("parts"))
    done = format_conversations(turns).select(
        "conv_id", "formatted", "expanded_tokens",
        read_back(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "expanded_tokens",
    )


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations plus conversation -7, whose texts hold control strings."""
    probe = conversations.sparkSession.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


ORACLE = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, length(role || text) + length(regexp_replace(role || text, '[^\\<>#]', '', 'g')) + 15 AS n FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars, CAST(0 AS BIGINT) AS expanded_tokens
FROM sized GROUP BY conv_id
"""
