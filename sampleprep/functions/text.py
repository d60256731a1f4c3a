"""Text and identifier expressions, Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.strip() and \s have it; needs the (?U) flag.
SPACE = r"[\s\x1c-\x1f]"
_IN_LINE = r"[\s\x1c-\x1f&&[^\n]]"
_STRIP = rf"(?U)\A{SPACE}+|{SPACE}+\z"
#: Fixed value: the image placeholders; they take the white space around them along.
TOKEN = rf"(?iuU){SPACE}*(?:<\|image(?:_pad)?\|>|<image(?:_pad)?(?:{SPACE}[^>]*)?>){SPACE}*"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, _STRIP, "")


def normalise_question(text: Column) -> Column:
    """Placeholders and white space as single spaces, stripped, in lower case."""
    return F.lower(strip(F.regexp_replace(F.regexp_replace(text, TOKEN, " "), rf"(?U){SPACE}+", " ")))


def clean_lines(text: Column) -> Column:
    """One kind of line end; in each line single spaces and none at the ends; none around the whole."""
    single = F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), r"[ \t\f\x0B]+", " ")
    return strip(F.regexp_replace(single, rf"(?U){_IN_LINE}+(?=\n)|(?<=\n){_IN_LINE}+", ""))


def strip_tokens(text: Column) -> Column:
    return clean_lines(F.regexp_replace(text, TOKEN, " "))


def chunks(text: Column) -> Column:
    """The texts before, between and after the placeholders; one more than there are placeholders."""
    return F.split(text, TOKEN, -1)


def slot_count(text: Column) -> Column:
    return F.size(chunks(text)) - 1


def layout(text: Column) -> Column:
    """Struct: placeholders, whether text stands before the first or between two, and whether that deviates."""

    def found(parts: Column) -> Column:
        slots = F.size(parts) - 1
        leading = (slots > 0) & F.get(parts, 0)
        between = F.when(slots > 1, F.exists(F.slice(parts, F.lit(2), F.greatest(slots - 1, F.lit(1))), lambda x: x)).otherwise(F.lit(False))
        return F.struct((leading | between).alias("deviant"), slots.alias("slots"), leading.alias("leading"), between.alias("between"))

    parts = F.transform(chunks(F.coalesce(text, F.lit(""))), lambda c: c.rlike(r"(?U)[^\s\x1c-\x1f]"))
    # one array element, so that the text is split once
    return F.get(F.transform(F.array(parts), found), 0)


def normalise_source(source: Column) -> Column:
    """Known spellings of two sources as one each; else the stripped name; unknown_source without one."""
    raw = strip(F.when(source.isNull() | (source == ""), "unknown_source").otherwise(source))
    key = F.replace(F.replace(F.lower(raw), F.lit("_"), F.lit("-")), F.lit(" "), F.lit(""))
    return (
        F.when(key.isin("matterport3d", "matterpod3d", "matterpot3d"), "matterport3d")
        .when(key.isin("egoexo4d", "ego-exo4d"), "Ego-Exo4D")
        .when(raw == "", "unknown_source")
        .otherwise(raw)
    )


def row_ordinal(file_index: Column, row_in_file: Column) -> Column:
    return file_index.cast("long") * F.lit(1_000_000_000) + row_in_file


def sample_id(source: Column, raw_id: Column, ordinal: Column) -> Column:
    name = F.coalesce(F.when(raw_id != "", raw_id), F.concat(F.lit("sample_"), ordinal.cast("string")))
    return F.concat(F.coalesce(F.when(source != "", source), F.lit("unknown_source")), F.lit("__"), name)


def safe_name(text: Column) -> Column:
    cut = F.btrim(F.regexp_replace(text, "[^A-Za-z0-9._-]+", "_"), F.lit("._"))
    return F.when(cut == "", "sample").otherwise(cut)


def extension(mime: Column) -> Column:
    return F.when(mime == "image/png", ".png").otherwise(".jpg")


def member_name(sample: Column, slot: Column, mime: Column) -> Column:
    return F.format_string("%s_%02d%s", safe_name(sample), slot, extension(mime))


def source_of_id(sample: Column) -> Column:
    return F.when(F.contains(sample, F.lit("__")), F.substring_index(sample, "__", 1)).otherwise("unknown_source")


def first_human_text(conversations: Column) -> Column:
    """The text of the first turn from a human; empty without one."""
    human = F.filter(conversations, lambda t: F.lower(strip(t["from"])) == "human")
    return F.coalesce(F.get(human, 0)["value"], F.lit(""))


def snippet(text: Column, most: int) -> Column:
    return text if most <= 0 else F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most)), F.lit("…"))).otherwise(text)


def kilobytes(size: Column) -> Column:
    return size / F.lit(1024.0)
