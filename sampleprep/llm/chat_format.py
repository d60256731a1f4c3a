r"""Chat formatting by a grammar round trip.

A conversation is rendered as turns "### Role: text\n</turn>\n". A deterministic parser reads the result back.
To the parser every "### " opens a turn and every "</turn>" ends one, wherever they stand, unless a backslash is in front. Where
the recovered turns differ from the source, the texts are escaped: each run of backslashes in front of a
control string ("</turn>" or "### ") gets one more. The parser takes one off such a run. So a control string inside a text is
always escaped, and texts without one stay as they are. What isn't identical after that fails.

Roles other than user, assistant and system are written as "@" and the hexadecimal digits of their UTF-8.

Defined cases: null text is empty; null role is the empty role; turns go by turn, null last, then role and
text; an empty conversation table gives no rows; each row with a null conversation id is a conversation of its own.
A conversation is one string, so its turns meet in one task, as any output of it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OPEN, _CLOSE = "### ", "\n</turn>\n"
_CONTROL = r"(</turn>|### )"
_NAMES = {"user": "User", "assistant": "Assistant", "system": "System"}


def _escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(\\*){_CONTROL}", r"$1\\$2")


def _unescape(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, rf"\\(\\*){_CONTROL}", r"$1$2")).otherwise(text)


def _shown(role: Column) -> Column:
    shown = F.concat(F.lit("@"), F.hex(F.encode(role, "UTF-8")))
    for name, label in _NAMES.items():
        shown = F.when(role == name, F.lit(label)).otherwise(shown)
    return shown


def _role(shown: Column) -> Column:
    role = F.decode(F.unhex(F.substring(shown, F.lit(2), F.length(shown))), "UTF-8")
    for name, label in _NAMES.items():
        role = F.when(shown == label, F.lit(name)).otherwise(role)
    return role


def render(turns: Column, escaped: Column) -> Column:
    """The string of an array of (role, text)."""

    def turn(t: Column) -> Column:
        text = F.when(escaped, _escape(t["text"])).otherwise(t["text"])
        return F.concat(F.lit(_OPEN), _shown(t["role"]), F.lit(": "), text, F.lit(_CLOSE))

    return F.array_join(F.transform(turns, turn), "")


def parse(formatted: Column) -> Column:
    """The array of (role, text) that the grammar gives; text is null in a turn that isn't ended by one end mark."""

    def turn(part: Column) -> Column:
        # a one-element array binds the pieces, so that a turn is split once
        return F.get(F.transform(F.array(F.split(part, rf"(?<!\\){_CLOSE.strip()}", -1)), read), 0)

    def read(ended: Column) -> Column:
        body = F.get(ended, 0)
        shown = F.substring_index(body, ":", 1)
        whole = (F.size(ended) == 2) & (F.get(ended, 1) == "\n") & F.startswith(body, F.concat(shown, F.lit(": "))) & F.endswith(body, F.lit("\n"))
        text = F.substring(body, F.length(shown) + 3, F.length(body) - F.length(shown) - 3)
        return F.struct(_role(F.when(whole, shown).otherwise("")).alias("role"), F.when(whole, _unescape(text)).alias("text"))

    parts = F.split(formatted, rf"(?<!\\){_OPEN}", -1)
    # nothing stands in front of the first turn
    return F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def gather(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id and its turns in order."""
    key = F.struct(
        F.col(turn_col).isNull().alias("none"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    turns = F.transform(F.array_sort(F.collect_list(key)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    alone = F.when(F.col(conv_col).isNull(), F.monotonically_increasing_id()).alias("alone")
    return rows.groupBy(F.col(conv_col).alias("conv_id"), alone).agg(turns.alias("turns")).select("conv_id", "turns")


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, turns and formatted of each row of gather(); fails if a text can't be read back as it was."""
    first = conversations.withColumn("formatted", render(F.col("turns"), F.lit(False)))
    first = first.withColumn("conflict", parse(F.col("formatted")) != F.col("turns"))
    second = first.withColumn("formatted", F.when(F.col("conflict"), render(F.col("turns"), F.lit(True))).otherwise(F.col("formatted")))
    same = ~F.col("conflict") | (parse(F.col("formatted")) == F.col("turns"))
    checked = F.when(same, F.col("formatted")).otherwise(F.raise_error(F.lit("a conversation does not survive the round trip")))
    return second.select("conv_id", "turns", "conflict", checked.alias("formatted"))


def loss_text(turns: Column, roles: tuple[str, ...] = ("assistant",)) -> Column:
    """All text under the loss mask: the texts of these roles, in order, nothing between."""
    return F.array_join(F.transform(F.filter(turns, lambda t: t["role"].isin(*roles)), lambda t: t["text"]), "")
