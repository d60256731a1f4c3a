"""License scans by diagonal voting.

Every text gives a row for each place: the rolling hashes of the k words from there, for two k. Spark joins them to the places
of the templates (a broadcast table of some hundred rows, as large as the templates). A hit votes for its diagonal, the place in
the text minus the place in the template; votes are counted by text, template and diagonal before the shuffle. Neighbouring
diagonals of a template that may vary (words put in or left out) are merged, and each span is verified on the text's words:
equal words for a phrase, else an alignment whose share of common words is at least the template's.

A template is found by hashes of its own k, the longest that it has words for. A phrase needs all its votes, a template that may vary one,
so a varied text is missed only if no k words in a row are left.

Defined cases: null text is the empty text; no words: no spans, 0 words; a null id is an id like any other; repeated rows
give a row each; overlapping spans all count; texts of any length are read whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sampleprep.llm.common import bitmaps, checkpointed, filter_size, maybe_in, text_or_empty
from sampleprep.session import map_arrow

#: Words of the contract, on UTF-8 in which A-Z is lower-cased: digits, letters and all beyond ASCII.
_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_PIECE, _ROWS = 1 << 20, 1 << 17
_FACTOR = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Template:
    """Words that tell a license. least: the share of words that must agree; 1: a phrase, word by word. base: the phrases of the contract."""

    label: str
    text: str
    least: float = 1.0
    base: bool = False

    @property
    def words(self) -> list[bytes]:
        return _WORDS.findall(self.text.encode().lower())


#: Phrases that always count.
BASE = [
    Template("gpl", "gnu general public license", base=True),
    Template("apache", "apache license", base=True),
    Template("cc-by", "cc by", base=True),
    Template("mit", "mit license", base=True),
]
#: The method's own: exact names of licenses, and the notices that licenses ask to be put into files, which are often changed.
OWN = [
    Template("apache-2.0", "Apache License, Version 2.0"),
    Template("gpl-2.0", "GNU General Public License, version 2"),
    Template("gpl-3.0", "GNU General Public License, version 3"),
    Template("lgpl", "GNU Lesser General Public License"),
    Template("agpl", "GNU Affero General Public License"),
    Template("mpl-2.0", "Mozilla Public License, version 2.0"),
    Template("epl-2.0", "Eclipse Public License, version 2.0"),
    Template("bsl-1.0", "Boost Software License, Version 1.0"),
    Template("cc-by-nc", "CC BY-NC"),
    Template("cc-by-nd", "CC BY-ND"),
    Template("cc-by-sa", "CC BY-SA"),
    Template("cc-by-nc-nd", "CC BY-NC-ND"),
    Template("cc-by-nc-sa", "CC BY-NC-SA"),
    Template("cc-by-nc", "Creative Commons Attribution-NonCommercial"),
    Template("cc-by-nd", "Creative Commons Attribution-NoDerivatives"),
    Template("cc-by-sa", "Creative Commons Attribution-ShareAlike"),
    Template("cc-by-nc-nd", "Creative Commons Attribution-NonCommercial-NoDerivatives"),
    Template("cc-by-nc-sa", "Creative Commons Attribution-NonCommercial-ShareAlike"),
    Template("cc0-1.0", "CC0 1.0 Universal"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        0.8,
    ),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", 0.8),
    Template(
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        0.8,
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        0.8,
    ),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at", 0.8),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice "
        "and this permission notice appear in all copies",
        0.8,
    ),
    Template(
        "zlib",
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software",
        0.8,
    ),
    Template("unlicense", "This is free and unencumbered software released into the public domain", 0.8),
]


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word, in order."""
    from xxhash import xxh64_intdigest

    raw, at, parts = (text or "").encode("utf-8", "replace").lower(), 0, []
    while at < len(raw):
        gap = _GAP.search(raw, at + _PIECE)
        end = gap.start() if gap else len(raw)
        found = _WORDS.findall(raw, at, end)
        parts.append(np.fromiter(map(xxh64_intdigest, found), dtype=np.uint64, count=len(found)))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k words from each place that has so many, as signed 64-bit numbers."""
    if len(hashes) < k:
        return np.zeros(0, dtype=np.int64)
    total = np.zeros(len(hashes) - k + 1, dtype=np.uint64)
    for j in range(k):
        total = total * np.uint64(_FACTOR) + hashes[j : len(hashes) - k + 1 + j]
    return total.view(np.int64)


def gram_rows(docs: DataFrame, id_col: str, text_col: str, grams: tuple[int, int]) -> DataFrame:
    """id, mark (of the text), n_words, pos, short and long (hashes): a row for each place with words enough for the short one, place 0 always."""
    schema = T.StructType(
        [T.StructField("id", docs.schema[id_col].dataType)]
        + [T.StructField(n, t) for n, t in (("mark", T.LongType()), ("n_words", T.LongType()), ("pos", T.LongType()), ("short", T.LongType()), ("long", T.LongType()))]
    )

    def padded(found: np.ndarray, n: int) -> pa.Array:
        return pa.array(np.append(found, np.zeros(n - len(found), dtype=np.int64)), mask=np.arange(n) >= len(found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, waiting = [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                hashes = word_hashes(batch.column(2)[k].as_py())
                short, long = (rolling(hashes, g) for g in grams)
                n = max(1, len(short))
                for at in range(0, n, _ROWS):
                    m = min(_ROWS, n - at)
                    fixed = [pa.repeat(x, m) for x in (batch.column(0)[k], batch.column(1)[k], pa.scalar(len(hashes), pa.int64()))]
                    made.append(pa.RecordBatch.from_arrays([*fixed, pa.array(np.arange(at, at + m)), padded(short[at : at + m], m), padded(long[at : at + m], m)], schema.names))
                    waiting += m
                    if waiting >= _ROWS:
                        yield pa.Table.from_batches(made).combine_chunks().to_batches()[0]
                        made, waiting = [], 0
        if made:
            yield pa.Table.from_batches(made).combine_chunks().to_batches()[0]

    text = text_or_empty(text_col)
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"), text.alias("text")), run, schema)


def template_places(spark, templates: list[Template], grams: tuple[int, int]) -> list[DataFrame]:
    """For each k, hash and places (template, at) of the templates that are found by it."""
    tables: list[dict[int, list[tuple[int, int]]]] = [{}, {}]
    for number, template in enumerate(templates):
        words = template.words
        if len(words) < grams[0]:
            raise ValueError(f"{template.text!r}: at least {grams[0]} words")
        which = int(len(words) >= grams[1])
        for at, h in enumerate(rolling(word_hashes(template.text), grams[which])):
            tables[which].setdefault(int(h), []).append((number, at))
    return [spark.createDataFrame(list(t.items()), "hash long, places array<struct<template:int,at:int>>") for t in tables]


def votes(docs: DataFrame, templates: list[Template], id_col: str, text_col: str, grams: tuple[int, int]) -> DataFrame:
    """id, mark, template, diagonal, voted (template places), n_words and copies; a row with null template for each text.

    copies: how many rows have this id and text (null template only).
    """
    rows = gram_rows(docs, id_col, text_col, grams)
    short, long = template_places(docs.sparkSession, templates, grams)
    rows = rows.join(F.broadcast(short.withColumnsRenamed({"hash": "short", "places": "short_at"})), "short", "left")
    rows = rows.join(F.broadcast(long.withColumnsRenamed({"hash": "long", "places": "long_at"})), "long", "left")
    rows = rows.where("pos = 0 or short_at is not null or long_at is not null")
    kind = "array<struct<template:int,at:int>>"
    own = F.when(F.col("pos") == 0, F.array(F.struct(F.lit(None).cast("int").alias("template"), F.lit(None).cast("int").alias("at"))))
    every = F.concat(*[F.coalesce(c, F.array().cast(kind)) for c in (own, F.col("short_at"), F.col("long_at"))])
    hits = rows.select("id", "mark", "n_words", "pos", F.explode(every).alias("hit")).select("id", "mark", "n_words", "hit.*", (F.col("pos") - F.col("hit.at")).alias("diagonal"))
    return checkpointed(hits.groupBy("id", "mark", "template", "diagonal").agg(F.collect_set("at").alias("voted"), F.max("n_words").alias("n_words"), F.count("*").alias("copies")))


def candidates(voted: DataFrame, templates: list[Template], grams: tuple[int, int], shift: int) -> DataFrame:
    """id, mark and spans (template, low and high diagonal) of the texts with spans to verify."""
    facts = []
    for number, template in enumerate(templates):
        n = len(template.words)
        k = grams[int(n >= grams[1])]
        exact = template.least >= 1
        facts.append((number, 0 if exact else min(shift, n // 2), n - k + 1 if exact else 1))
    known = voted.sparkSession.createDataFrame(facts, "template int, reach int, least_votes int")
    hits = voted.where("template is not null").join(F.broadcast(known), "template")
    order = Window.partitionBy("id", "mark", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(order) > F.col("reach")).cast("int")
    hits = hits.withColumn("apart", F.coalesce(apart, F.lit(0))).withColumn("cluster", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = hits.groupBy("id", "mark", "template", "cluster", "least_votes").agg(
        F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.size(F.array_distinct(F.flatten(F.collect_list("voted")))).alias("votes")
    )
    return merged.where("votes >= least_votes").groupBy("id", "mark").agg(F.collect_list(F.struct("template", "low", "high")).alias("spans"))


def common_words(words: list[bytes], template: list[bytes]) -> tuple[int, int, int]:
    """Length of the longest common subsequence, and the first and last place in words of one such."""
    codes = {w: i for i, w in enumerate(dict.fromkeys(template))}
    text = np.array([codes.get(w, -1) for w in words])
    table = np.zeros((len(template) + 1, len(words) + 1), dtype=np.int32)
    for i, w in enumerate(template):
        step = np.where(text == codes[w], table[i, :-1] + 1, 0)
        table[i + 1, 1:] = np.maximum.accumulate(np.maximum(table[i, 1:], step))
    i, j, places = len(template), len(words), []
    while i and j:
        if table[i, j] == table[i - 1, j]:
            i -= 1
        elif table[i, j] == table[i, j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            places.append(j)
    return len(places), places[-1] if places else 0, places[0] if places else 0


def verified(text: str, spans: Iterable[dict], templates: list[Template], reach: int) -> list[dict]:
    """label, base, first, last (words from 0) and share of the spans that hold, in order; an own one within a longer own one is left out."""
    raw = text.encode("utf-8", "replace").lower()
    at = np.fromiter((x for m in _WORDS.finditer(raw) for x in m.span()), dtype=np.int64).reshape(-1, 2)
    found = {}
    for span in spans:
        template = templates[span["template"]]
        words = template.words
        exact = template.least >= 1
        low = max(0, span["low"] - (0 if exact else reach))
        high = span["high"] + len(words) + (0 if exact else reach)
        part = [raw[a:b] for a, b in at[low:high]]
        if exact:
            if part == words:
                found[template.label, template.base, low, high - 1] = 1.0
            continue
        n, first, last = common_words(part, words)
        share = 2 * n / (len(words) + last - first + 1)
        if share >= template.least:
            key = (template.label, template.base, low + first, low + last)
            found[key] = max(share, found.get(key, 0.0))
    inner = _inner([k for k in found if not k[1]])
    return [dict(zip(("label", "base", "first", "last", "share"), (*k, v), strict=True)) for k, v in sorted(found.items(), key=lambda x: (x[0][2], x[0])) if k not in inner]


def _inner(own: list[tuple]) -> set[tuple]:
    """Those within a longer one, by a sweep over starts."""
    inner, reach, begun = set(), -1, -1
    for k in sorted(own, key=lambda k: (k[2], -k[3])):
        if k[3] <= reach and (k[2], k[3]) != (begun, reach):
            inner.add(k)
        if k[3] > reach:
            begun, reach = k[2], k[3]
    return inner


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[Template] | None = None, grams: tuple[int, int] = (2, 4), shift: int = 8
) -> DataFrame:
    """id, n_words and spans (label, base, first, last, share) of each row, spans in order of their first word."""
    templates = [*BASE, *OWN] if templates is None else templates
    voted = votes(docs, templates, id_col, text_col, grams)
    asked = checkpointed(candidates(voted, templates, grams, shift))
    bits = filter_size(asked.count())
    text = text_or_empty(text_col)
    read = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    hashed = F.xxhash64("id", "mark")
    likely = maybe_in(read, hashed, bitmaps(asked.select(hashed.alias("hash")), bits), bits, "maybe").where("maybe").drop("maybe")
    named = asked.withColumnsRenamed({"id": "asked_id", "mark": "asked_mark"})
    found = likely.join(named, (F.col("mark") == F.col("asked_mark")) & F.col("id").eqNullSafe(F.col("asked_id"))).select("id", "mark", "text", "spans")
    kind = T.ArrayType(T.StructType.fromDDL("label string, base boolean, first long, last long, share double"))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("mark", T.LongType()), T.StructField("spans", kind)])
    arrow = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("first", pa.int64()), ("last", pa.int64()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [verified(t.as_py(), s.as_py(), templates, shift) for t, s in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(held, type=arrow)], schema.names)

    held = map_arrow(found, run, schema).where(F.size("spans") > 0).groupBy("id", "mark").agg(F.first("spans").alias("spans"))
    held = held.withColumnsRenamed({"id": "held_id", "mark": "held_mark"})
    texts = voted.where("template is null").select("id", "mark", "n_words", "copies")
    joined = texts.join(held, (F.col("mark") == F.col("held_mark")) & F.col("id").eqNullSafe(F.col("held_id")), "left")
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))  # repeated rows give a row each
    return joined.select("id", "n_words", F.coalesce("spans", F.array().cast(kind)).alias("spans"), each.alias("copy")).drop("copy")
