"""Conversations as training text, checked by parsing them back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A turn is ``<s>role[INST] text [/INST]</s>`` and a line feed.
OPEN, BEGIN, END, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
TURN_MARKS = (OPEN, BEGIN, END, CLOSE)
CONTROL = r"</?s>|\[/?INST\]"
#: A control string with any number of backslashes behind its bracket.
LIKE_CONTROL = (r"<(\\*/?s>)", r"\[(\\*/?INST\])")
ESCAPED = (r"<\\(\\*/?s>)", r"\[\\(\\*/?INST\])")


def escape(text: Column) -> Column:
    """Put one more backslash behind the bracket of everything that looks like a control string."""
    for pattern, bracket in zip(LIKE_CONTROL, "<[", strict=True):
        text = F.regexp_replace(text, pattern, bracket + r"\\$1")
    return text


def unescape(text: Column) -> Column:
    """Take one backslash away again: the inverse of ``escape`` for every text."""
    for pattern, bracket in zip(ESCAPED, "<[", strict=True):
        text = F.regexp_replace(text, pattern, bracket + "$1")
    return text


def render(role: Column, text: Column) -> Column:
    return F.concat(
        F.lit(OPEN), role, F.lit(BEGIN + " "), text, F.lit(f" {END}{CLOSE}\n")
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted text as structs (``role``, ``text``), NULL if it is none.

    The text is cut at every control string, so the marks alone decide: those of ``n``
    turns leave ``4 n + 1`` pieces, of which each turn's second is the role, the third the
    text between two blanks, the fourth empty, and the fifth a line feed.
    """
    marks = F.regexp_extract_all(formatted, F.lit(CONTROL), F.lit(0))
    cut = F.struct(F.split(formatted, CONTROL, -1).alias("pieces"), marks.alias("marks"))
    return _once(cut, lambda c: _turns(c["pieces"], c["marks"]))


def _turns(pieces: Column, marks: Column) -> Column:
    n = F.floor(F.size(marks) / 4).cast("int")
    number = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    expected = F.array_join(F.array_repeat(F.lit("".join(TURN_MARKS)), n), "")

    def sound(i: Column) -> Column:
        text = F.get(pieces, i * 4 + 2)
        return (
            (F.length(text) >= 2) & text.startswith(" ") & text.endswith(" ")
            & (F.get(pieces, i * 4 + 3) == "") & (F.get(pieces, i * 4 + 4) == "\n")
        )

    whole = (
        (F.get(pieces, F.lit(0)) == "") & (F.array_join(marks, "") == expected) & F.forall(number, sound)
    )
    turns = F.transform(
        number,
        lambda i: F.struct(
            unescape(F.get(pieces, i * 4 + 1)).alias("role"),
            unescape(_between_blanks(F.get(pieces, i * 4 + 2))).alias("text"),
        ),
    )
    return F.when(whole, turns)


def _once(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _between_blanks(piece: Column) -> Column:
    return F.substring(piece, F.lit(2), F.length(piece) - 2)


def format_chats(
    conversations: DataFrame, trained: tuple[str, ...] = ("assistant",)
) -> DataFrame:
    """Format each conversation of ``conversations`` (``conv_id``, ``turn``, ``role``, ``text``).

    Returns ``conv_id``, ``formatted``, ``loss_spans`` (start and end in code points of the
    texts of ``trained`` roles within ``formatted``), and ``turns``, read back from it.

    Each turn is rendered as it is and parsed; if what comes back is not the turn, its
    role and text are escaped and it is compared again. At last the whole conversation
    is parsed and compared with its source; a difference, which escaping rules out, is
    an error. Everything but the collecting of a conversation's turns is done per turn.

    NULL texts and roles are empty. Turns stand by (``turn``, ``role``, ``text``), NULL first;
    repeated rows are repeated turns. Rows with a NULL ``conv_id`` are one conversation. No
    rows give no rows. A conversation is one row of the result and so is held whole.
    """
    turns = conversations.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    # An array of one, exploded, is a column that is computed once for all its uses.
    comes_back = F.explode(F.array(_comes_back(render(F.col("role"), F.col("text")))))
    turns = turns.select("*", comes_back.alias("_same"))
    role, text = (F.when(F.col("_same"), F.col(c)).otherwise(escape(F.col(c))) for c in ("role", "text"))
    turns = turns.select("conv_id", "turn", "role", "text", role.alias("_role"), render(role, text).alias("_turn"))
    turns = turns.withColumn("_head", F.length("_role") + len(f"{OPEN}{BEGIN} ")).drop("_role")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("_n", F.row_number().over(order)).withColumn(
        "_start", F.coalesce(F.sum(F.length("_turn")).over(before), F.lit(0)) + F.col("_head")
    )
    end = F.col("_start") - F.col("_head") + F.length("_turn") - len(f" {END}{CLOSE}\n")
    span = F.when(
        F.col("role").isin(*trained), F.struct(F.col("_start").alias("start"), end.alias("end"))
    )
    chats = turns.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(F.struct("_n", "_turn", "role", "text", span.alias("span")))
        ).alias("_turns")
    )
    formatted = F.array_join(F.transform("_turns", lambda t: t["_turn"]), "")
    chats = chats.select("*", F.explode(F.array(formatted)).alias("formatted"))
    chats = chats.select("*", F.explode(F.array(parse(F.col("formatted")))).alias("_read"))
    source = F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    lost = F.raise_error(F.concat(F.lit("not read back: conversation "), F.col("conv_id").cast("string")))
    return chats.select(
        "conv_id",
        "formatted",
        F.filter(F.transform("_turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
        F.when(F.col("_read").eqNullSafe(source), F.col("_read")).otherwise(lost).alias("turns"),
    )


def _comes_back(rendered: Column) -> Column:
    """Whether parsing one rendered turn gives its role and text."""
    read = F.get(parse(rendered), F.lit(0))
    return F.coalesce((read["role"] == F.col("role")) & (read["text"] == F.col("text")), F.lit(False))


def chat_digests(chats: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Counts and hashes of what was read back from ``format_chats``."""
    texts = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(
        F.transform(F.filter("turns", lambda t: t["role"].isin(*trained)), lambda t: t["text"]), ""
    )
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(texts, ""), 256).alias("turns_sha256"),
        F.explode(F.array(loss)).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    ).select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
