"""Conversations to samples: turn checks, content parts, sample records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sampleprep.functions import text as t

#: Fixed value: roles of the source and of the samples.
ROLES = {"human": "user", "gpt": "assistant"}


def role_of(raw: Column) -> Column:
    key = F.lower(t.strip(raw))
    role = F.lit(None).cast("string")
    for name, to in ROLES.items():
        role = F.when(key == name, to).otherwise(role)
    return role


def is_valid(conversations: Column) -> Column:
    """At least one turn; user and assistant strictly in turn, the user first; an odd number of turns is fine."""
    roles = F.transform(conversations, lambda turn, i: role_of(turn["from"]).eqNullSafe(F.when(i % 2 == 0, "user").otherwise("assistant")))
    return F.coalesce((F.size(conversations) > 0) & F.forall(roles, lambda ok: ok), F.lit(False))


def text_part(text: Column) -> Column:
    return F.struct(
        F.lit("text").alias("type"),
        F.struct(F.lit("string").alias("type"), F.lit("utf-8").alias("format"), text.alias("string")).alias("text"),
        F.lit(None).cast("struct<type:string,format:string,relative_path:string,width:int,height:int>").alias("image"),
    )


def image_part(image: Column) -> Column:
    """image: struct relative_path, format, width, height."""
    fields = [F.lit("relative_path").alias("type"), *[image[k].alias(k) for k in ("format", "relative_path")], *[image[k].cast("int").alias(k) for k in ("width", "height")]]
    return F.struct(F.lit("image").alias("type"), F.lit(None).cast("struct<type:string,format:string,string:string>").alias("text"), F.struct(*fields).alias("image"))


def _texts(text: Column) -> Column:
    """An array of the text's part, or an empty one; the text is worked out once."""
    return F.transform(F.filter(F.array(text), lambda x: x != ""), text_part)


def interleave(text: Column, images: Column) -> Column:
    """Parts of the first user turn.

    As many placeholders as images: each placeholder becomes its image, with the cleaned texts between them. Else all images, then
    the text without placeholders. Empty texts are left out.
    """

    def parts(bound: Column) -> Column:
        cut, shown = bound["cut"], bound["shown"]

        def chunk(c: Column, i: Column) -> Column:
            before = F.slice(shown, F.greatest(i, F.lit(1)), F.when(i > 0, 1).otherwise(0))
            return F.concat(before, _texts(t.clean_lines(c)))

        aligned = (F.size(shown) > 0) & (F.size(cut) - 1 == F.size(shown))
        return F.when(aligned, F.flatten(F.transform(cut, chunk))).otherwise(F.concat(shown, _texts(t.clean_lines(F.array_join(cut, " ")))))

    # one array element, so that the text is split once and the images are shown once, not for each chunk
    bound = F.struct(t.chunks(text).alias("cut"), F.transform(images, image_part).alias("shown"))
    return F.get(F.transform(F.array(bound), parts), 0)


def turns(conversations: Column, images: Column) -> Column:
    """data of a sample: the first turn interleaved, later ones with their raw text."""
    value = lambda turn: F.coalesce(turn["value"], F.lit(""))

    def turn(x: Column, i: Column) -> Column:
        content = F.when(i == 0, interleave(value(x), images)).otherwise(F.array(text_part(value(x))))
        return F.struct(role_of(x["from"]).alias("role"), content.alias("content"))

    return F.transform(conversations, turn)


def sample(conversations: Column, images: Column, sample_id: Column, category: Column) -> Column:
    return F.struct(F.array(F.lit("")).alias("meta_prompt"), turns(conversations, images).alias("data"), sample_id.alias("id"), category.alias("category"))


def first_user_images(data: Column) -> Column:
    """Image structs of the first turn, if it is a user's, in part order."""
    parts = F.when(F.get(data, 0)["role"] == "user", F.get(data, 0)["content"])
    return F.transform(F.filter(parts, lambda p: p["type"] == "image"), lambda p: p["image"])


def image_paths(data: Column) -> Column:
    return F.filter(F.transform(first_user_images(data), lambda i: i["relative_path"]), lambda p: p != "")


def image_count(data: Column) -> Column:
    return F.coalesce(F.size(first_user_images(data)), F.lit(0))


def turn_text(content: Column) -> Column:
    """A turn's text parts, joined by line ends."""
    return F.array_join(F.transform(F.filter(content, lambda p: p["type"] == "text"), lambda p: p["text"]["string"]), "\n")


def matches(sample_id: Column, category: Column, data: Column, want_category: str = "", want_source: str = "", images: str = "") -> Column:
    """The browser's filter; an empty argument is no constraint. images: "single" (exactly 1) or "multi" (2 or more)."""
    found = F.lit(True)
    if want_category:
        found = found & (F.coalesce(category, F.lit("")) == want_category)
    if want_source:
        found = found & (t.normalise_source(t.source_of_id(sample_id)) == t.normalise_source(F.lit(want_source)))
    if images:
        found = found & (image_count(data) == 1 if images == "single" else image_count(data) > 1)
    return found
