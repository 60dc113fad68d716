"""Chat formatting by prefix-target expansion, in built-in expressions only.

Template of one turn: ``### <role>: <text></turn>`` and a line feed. Inside roles and texts the characters of the control
strings are written as codes, so that no text can open or close a turn, and ``unescape`` gives back every character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, MID, END = "### ", ": ", "</turn>\n"
TRAINED_ROLE = "assistant"

# Each character that control strings are made of, and its code. The backslash comes first, and is undone last.
CODES = [("\\", "\\b"), ("#", "\\h"), ("<", "\\l")]
ROLE_CODES = [*CODES, (":", "\\c")]


def _escape(value: Column, codes: list[tuple[str, str]]) -> Column:
    for raw, code in codes:
        value = F.replace(value, F.lit(raw), F.lit(code))
    return value


def _unescape(value: Column, codes: list[tuple[str, str]]) -> Column:
    for raw, code in reversed(codes):
        value = F.replace(value, F.lit(code), F.lit(raw))
    return value


def escape(text: Column) -> Column:
    return _escape(text, CODES)


def unescape(text: Column) -> Column:
    """Every backslash of an escaped text belongs to one code, so undoing the codes one after the other is exact."""
    return _unescape(text, CODES)


def prefix_examples(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One example for each assistant turn: the turns before it are context, and only its own text is trainable.

    Returns ``conv_id, position, n_context, trainable, is_last, text, loss_start, loss_end``. ``text`` is the formatted
    conversation up to and with this turn, and the loss mask is its code points from ``loss_start`` up to ``loss_end``.
    A conversation that does not end with an assistant turn gets one more row for its remaining turns, with
    ``trainable`` false and an empty mask, so that the output holds every turn. ``is_last`` marks the row with them all.

    Turns are ordered by ``turn``, then role, then text; a null turn number comes first. Null roles and texts count as
    empty. Repeated rows stay repeated turns. Rows without conversation id are one conversation. An empty table gives no
    rows. Other columns are ignored, whatever their names.

    The turns of a conversation meet in one row, as they must for the last example to be one; the shuffle moves each turn
    once, before the expansion, and the examples are made where the conversation lies.
    """
    roles, texts = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    body = escape(texts)
    turns = conversations.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            roles.alias("role"),
            F.concat(F.lit(HEAD), _escape(roles, ROLE_CODES), F.lit(MID), body, F.lit(END)).alias("piece"),
            F.length(body).alias("body_chars"),
        ).alias("t"),
    )
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    ends = F.filter(
        F.sequence(F.lit(1), F.size("turns")),
        lambda k: (F.element_at("turns", k)["role"] == TRAINED_ROLE) | (k == F.size("turns")),
    )
    rows = whole.select("conv_id", "turns", F.explode(ends).alias("k"))
    target = F.element_at("turns", F.col("k"))
    trained = target["role"] == TRAINED_ROLE
    pieces = F.transform(F.slice("turns", F.lit(1), F.col("k")), lambda t: t["piece"])
    rows = rows.select(
        "conv_id",
        F.col("k").alias("position"),
        (F.col("k") - 1).alias("n_context"),
        trained.alias("trainable"),
        (F.col("k") == F.size("turns")).alias("is_last"),
        F.when(trained, target["body_chars"]).otherwise(0).alias("loss_chars"),
        F.array_join(pieces, "").alias("text"),
    )
    end = F.length("text") - len(END)
    return rows.select(
        "conv_id", "position", "n_context", "trainable", "is_last", "text",
        (end - F.col("loss_chars")).alias("loss_start"),
        end.alias("loss_end"),
    )


def read_turns(text: Column) -> Column:
    """The turns of a formatted text again, as an array of ``role`` and ``text``."""
    pieces = F.slice(F.split(text, END, -1), F.lit(1), F.size(F.split(text, END, -1)) - 1)

    def turn(piece: Column) -> Column:
        inner = F.substr(piece, F.lit(len(HEAD) + 1))
        role = F.substring_index(inner, MID, 1)
        return F.struct(
            _unescape(role, ROLE_CODES).alias("role"),
            unescape(F.substr(inner, F.length(role) + len(MID) + 1)).alias("text"),
        )

    return F.transform(pieces, turn)


def trained_text(text: Column, loss_start: Column, loss_end: Column) -> Column:
    """What an example trains, unescaped."""
    return unescape(F.substr(text, loss_start + 1, loss_end - loss_start))


def conversation_digests(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from the examples: its turns, and the trained texts in order, as digests."""
    turns = read_turns(F.col("text"))
    said = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    rows = examples.select(
        "conv_id",
        F.when(F.col("is_last"), F.size(turns).cast("long")).alias("n_turns"),
        F.when(F.col("is_last"), F.sha2(F.array_join(said, ""), 256)).alias("turns_sha256"),
        F.when(
            F.col("trainable"),
            F.struct("position", trained_text(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("said")),
        ).alias("trained"),
        F.length("text").cast("long").alias("chars"),
    )
    trained = F.array_join(F.transform(F.array_sort(F.collect_list("trained")), lambda t: t["said"]), "")
    return (
        rows.groupBy("conv_id")
        .agg(
            F.max("n_turns").alias("n_turns"),
            F.max("turns_sha256").alias("turns_sha256"),
            trained.alias("trained"),
            F.max("chars").alias("formatted_chars"),
            F.count("trained").alias("n_examples"),
        )
        .select(
            "conv_id", "n_turns", "turns_sha256",
            F.length("trained").cast("long").alias("loss_chars"),
            F.sha2("trained", 256).alias("loss_sha256"),
            "formatted_chars", "n_examples",
        )
    )
