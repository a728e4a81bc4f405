r"""Chat formatting by a grammar round trip, in DataFrame functions alone.

A turn is rendered as ``### role: text``, a line break, ``</turn>`` and a line break. The parser cuts the output
at turn ends, takes the role from the head, refuses a body with a bare control string (a head or ``</turn>``), and
drops one backslash before each control string. Every turn is first rendered as it is and parsed; where the
recovered turn differs from its source, its control strings get one backslash more and it is parsed again. The
escape keeps what stood before (``k`` backslashes become ``k + 1``), so one round always suffices, and a turn's
parse does not depend on its neighbours, so round trips of the turns are one of the conversation;
``round_trip`` tells the comparison of whole outputs with their sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Roles are URL-encoded in heads, so that any role is one word of these characters.
_ROLE = "[A-Za-z0-9.*_+%-]*"
_CONTROL = f"(### {_ROLE}: |</turn>)"
_END = "\n</turn>\n"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\{_CONTROL}", "$1")


def _head(role: Column) -> Column:
    return F.concat(F.lit("### "), F.url_encode(role), F.lit(": "))


def render(role: Column, body: Column) -> Column:
    return F.concat(_head(role), body, F.lit(_END))


def parse(formatted: Column) -> Column:
    """The turns of an output as an array of (role, text); a turn outside the grammar has nulls."""
    pieces = F.split(formatted, _END)
    pieces = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        role = F.regexp_extract(piece, f"^### ({_ROLE}): ", 1)
        head = F.concat(F.lit("### "), role, F.lit(": "))
        body = piece.substr(F.length(head) + 1, F.length(piece))
        right = piece.startswith(head) & ~body.rlike(rf"(?<!\\){_CONTROL}")
        return F.struct(F.when(right, F.try_url_decode(role)).alias("role"), F.when(right, unescape(body)).alias("text"))

    return F.transform(pieces, turn)


def format_chats(rows: DataFrame) -> DataFrame:
    """Per ``conv_id``: ``n_turns``, ``formatted``, ``loss_spans`` (code-point start and end of each assistant body
    in ``formatted``, from 0), ``n_escaped`` turns, and ``round_trip``.

    Rows (conv_id, turn, role, text) go by turn, then role and text; a null turn comes first, and repeated rows
    all count. A null role or text is empty. Rows with a null conv_id are one conversation. Other columns are
    left out. An empty table gives an empty result. A conversation's output is one string of one row.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    source = F.array(F.struct("role", "text"))
    bare = parse(render(F.col("role"), F.col("text")))
    turns = turns.withColumn("escaped", ~bare.eqNullSafe(source))
    turns = turns.withColumn("body", F.when(F.col("escaped"), escape(F.col("text"))).otherwise(F.col("text")))
    turns = turns.withColumn("start", F.length(_head(F.col("role")))).withColumn("long", F.length(render(F.col("role"), F.col("body"))))
    own = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = turns.withColumn("upto", F.sum("long").over(own)).withColumn("start", F.col("upto") - F.col("long") + F.col("start"))
    parts = F.array_sort(F.collect_list(F.struct("upto", "role", "text", "body", "start")))
    chats = placed.groupBy("conv_id").agg(parts.alias("parts"), F.count_if("escaped").alias("n_escaped"))
    masked = F.filter("parts", lambda p: p["role"] == ASSISTANT)
    chats = chats.select(
        "conv_id",
        F.size("parts").cast("long").alias("n_turns"),
        F.array_join(F.transform("parts", lambda p: render(p["role"], p["body"])), "").alias("formatted"),
        F.transform(masked, lambda p: F.struct(p["start"].alias("start"), (p["start"] + F.length(p["body"])).alias("end"))).alias("loss_spans"),
        "n_escaped",
        F.transform("parts", lambda p: F.struct(p["role"].alias("role"), p["text"].alias("text"))).alias("source"),
    )
    return chats.withColumn("round_trip", parse(F.col("formatted")) == F.col("source")).drop("source")


def chat_digest(chats: DataFrame) -> DataFrame:
    """What can be read back from the outputs and masks of ``format_chats``: counts and digests per conversation."""
    read = chats.select("conv_id", "formatted", "loss_spans", parse(F.col("formatted")).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    cut = lambda s: F.col("formatted").substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
    read = read.withColumn("loss", F.array_join(F.transform("loss_spans", lambda s: unescape(cut(s))), ""))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
