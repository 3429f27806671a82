r"""Chat formatting with a grammar that reads its own output back.

    conversation := turn*
    turn         := "<s>" role "\n" text "</s>"             for the assistant
                  | "[INST]" role "\n" text "[/INST]"       for all others

Each turn is rendered, read back by the parser (one regular expression, leftmost and shortest) and
compared; where the result differs, its text is escaped and the turn rendered and compared again, until it is
identical. Escaping puts one more backslash behind the first character of each control
string, ``</s>`` to ``<\/s>`` and ``<\/s>`` to ``<\\/s>``; the parser takes one away. So one round is enough
for any text, and texts without control strings stay as they are. A role writes ``%``, ``<``, ``[`` and line ends
as percent codes. The whole conversation is then read back once more, and everything returned comes from there.

Built-in functions only. A conversation is one training sample and becomes one string in one row;
turns are gathered per conversation and nothing wider.

Defined results: NULL roles and texts count as empty; turns with equal numbers stand in the order of
role and text, NULL numbers first; repeated rows are turns of their own; a NULL conv_id is a conversation; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 2
ASSISTANT = "assistant"
TURN = r"(?s)(<s>|\[INST\])([^\n]*)\n(.*?)(</s>|\[/INST\])"
ROLE_CODES = (("%", "%25"), ("\n", "%0A"), ("<", "%3C"), ("[", "%5B"))


def escape(text: Column) -> Column:
    text = F.regexp_replace(text, r"<(\\*)(/?s>)", r"<\\$1$2")
    return F.regexp_replace(text, r"\[(\\*)(/?INST\])", r"[\\$1$2")


def unescape(text: Column) -> Column:
    text = F.regexp_replace(text, r"<\\(\\*)(/?s>)", r"<$1$2")
    return F.regexp_replace(text, r"\[\\(\\*)(/?INST\])", r"[$1$2")


def encode_role(role: Column) -> Column:
    for plain, code in ROLE_CODES:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def decode_role(role: Column) -> Column:
    for plain, code in reversed(ROLE_CODES):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def render(role: Column, body: Column) -> Column:
    ours = role == ASSISTANT
    return F.concat(
        F.when(ours, F.lit("<s>")).otherwise(F.lit("[INST]")),
        encode_role(role),
        F.lit("\n"),
        body,
        F.when(ours, F.lit("</s>")).otherwise(F.lit("[/INST]")),
    )


def reads_back(rendered: Column, text: Column) -> Column:
    """Whether the parser takes the rendered turn as one turn with this very text."""
    whole = F.regexp_extract(rendered, TURN, 0) == rendered
    return whole & (unescape(F.regexp_extract(rendered, TURN, 3)) == text)


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``formatted``, the turns read back from it, and whether
    they are ``identical`` to the source."""
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("rendered", render(F.col("role"), F.col("text")))
    body = F.col("text")
    for _ in range(ROUNDS - 1):
        body = escape(body)
        same = reads_back(F.col("rendered"), F.col("text"))
        rows = rows.withColumn("rendered", F.when(same, F.col("rendered")).otherwise(render(F.col("role"), body)))
    source = F.sort_array(F.collect_list(F.struct("turn", "role", "text", "rendered")))
    whole = rows.groupBy("conv_id").agg(source.alias("source"))
    whole = whole.select(
        "conv_id",
        F.transform("source", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"),
        F.array_join(F.transform("source", lambda t: t["rendered"]), "").alias("formatted"),
    )
    parts = [F.regexp_extract_all("formatted", F.lit(TURN), F.lit(i)) for i in (1, 2, 3)]
    parsed = whole.select("conv_id", "formatted", "source", F.arrays_zip(*[
        p.alias(n) for p, n in zip(parts, ("mark", "role", "text"))
    ]).alias("parsed"))
    turns_back = F.transform(
        "parsed",
        lambda t: F.struct(
            decode_role(t["role"]).alias("role"), unescape(t["text"]).alias("text"), (t["mark"] == "<s>").alias("loss")
        ),
    )
    read = parsed.select("conv_id", "formatted", "source", turns_back.alias("turns"))
    plain = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return read.select("conv_id", "formatted", "turns", (plain == F.col("source")).alias("identical"))


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what was read back."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    ours = F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"])
    held = formatted.select(
        "conv_id",
        "identical",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(lines, "").alias("lines"),
        F.array_join(ours, "").alias("loss"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
    return held.select(
        "conv_id",
        "n_turns",
        F.sha2("lines", 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "identical",
    )
