"""Toxicity with a noisy-channel deobfuscation in front of a bag-of-words score.

A character 4-gram language model is counted over all texts. Tokens that look disguised (digits or symbols for
letters, asterisks in place of letters, single letters set apart, letters repeated) become lattices: each place may be one of several
letters, or nothing, or between single letters a gap, at a channel cost. Viterbi decoding under the language model restores them, whatever
their length, in time that grows with it. Letters and digits outside the model's classes stay as they are, and a word of
letters alone stays beside its restored form. A token with symbols at its ends gives both readings, as letters ("a$$") and as punctuation ("so$$"). The restored text is then
scored by a logistic regression on words and word beginnings, which learns from labelled rows only.

Counts of the language model: each task folds letters to a-z, one class for other characters and one for gaps, and
gives at most 28**4 sums, so what meets is bounded by the alphabet. Features are counted over the labelled rows, which
are restored once; all that tell enough (least_gain) are kept.

Defined cases: null text counts as empty; an empty text gets the score of the intercept; without labels of both kinds every score is
0; rows without a label and labels without a row are not learned from; repeated rows are scored alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleprep.llm.common import checkpointed
from sampleprep.session import map_arrow

#: Classes of characters: 0 a gap, 1 to 26 a to z, 27 any other.
CLASSES, _OTHER, _ORDER = 28, 27, 4
#: Letters that a digit or symbol may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
    "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "#": "h",
}
_PLAIN = {
    c: p for p, many in {"a": "àáâãäå", "c": "ç", "e": "èéêë", "i": "ìíîï", "n": "ñ", "o": "òóôõöø", "u": "ùúûü", "y": "ýÿ", "s": "ß"}.items() for c in many
}
#: Stands for any letter inside a word, one or two at a time.
_ANY = "*"
_MARKS = re.escape("".join(LEET) + _ANY)
#: What may stand between single letters.
_BETWEEN = " \t\n\r.,*_/|~·-"
_DISGUISED = re.compile(
    rf"(?<![^\W_])[^\W\d_](?:[{re.escape(_BETWEEN)}]+[^\W\d_](?![^\W_])){{2,}}"  # single letters set apart
    rf"|(?<![\w{_MARKS}])[\w{_MARKS}]*?(?:[^\W\d_][{_MARKS}]|[{_MARKS}][^\W\d_])[\w{_MARKS}]*"  # marks beside letters
    rf"|(?<![^\W\d_])[^\W\d_]*?([a-z{''.join(_PLAIN)}])\1\1[^\W\d_]*"  # a letter with a class three times or more; a run of letters is tried once
)
_THRICE = re.compile(rf"([a-z{''.join(_PLAIN)}])\1\1")
#: Symbols at the ends of a token, which may be punctuation.
_ENDS = re.compile(r"^[^\w\s]+|[^\w\s]+$")
_ZERO_WIDTH = re.compile("[\xad​-‍⁠﻿]")
_GAPS = re.compile(r"[\W_]+")
#: For Latin-1 text: 1 a letter, 2 a mark that may stand for one; and the text with spaces for all but letters and digits.
_KIND = np.array([1 if chr(i).isalpha() else 2 if chr(i) in LEET or chr(i) == _ANY else 0 for i in range(256)], dtype=np.uint8)
_SEPARATES = np.array([chr(i) in _BETWEEN for i in range(256)])
_COUNTS = np.array([chr(i).isalnum() for i in range(256)])
_SPACED = bytes(i if chr(i).isalnum() else 32 for i in range(256))


def _class_table() -> np.ndarray:
    """Classes by Latin-1 code."""
    table = np.full(256, _OTHER, np.int32)
    for code in range(256):
        c = chr(code).lower()
        c = _PLAIN.get(c, c)
        if "a" <= c <= "z":
            table[code] = ord(c) - 96
        elif not c.isalnum():
            table[code] = 0
    return table


_TABLE = _class_table()
_CLASSED = (_TABLE >= 1) & (_TABLE < _OTHER)


def _classes(text: str) -> np.ndarray:
    """Classes of a text with one gap before, between and after its words."""
    found = _TABLE[np.frombuffer(f" {text} ".encode("latin-1", "replace"), dtype=np.uint8)]
    return found[np.concatenate([[True], (found[1:] != 0) | (found[:-1] != 0)])]


def count_grams(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of all character 4-grams of all texts, as an array of 28**4 numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CLASSES**_ORDER, np.int64)
        held: list[str] = []
        size = 0

        def add(texts: list[str]) -> None:
            nonlocal counts
            c = np.concatenate([np.zeros(2, np.int32), _classes(" ".join(texts))])
            counts += np.bincount(((c[:-3] * CLASSES + c[1:-2]) * CLASSES + c[2:-1]) * CLASSES + c[3:], minlength=len(counts))

        for batch in batches:
            for value in batch.column(0):
                text = value.as_py()
                if text:
                    held.append(text)
                    size += len(text)
                if size > 1 << 20:
                    add(held)
                    held, size = [], 0
        add(held)
        codes = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int32)), pa.array(counts[codes])], ["gram", "n"])

    rows = map_arrow(docs.select(F.col(text_col).alias("text")), run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(CLASSES**_ORDER, np.int64)
    for r in rows:
        counts[r.gram] = r.n
    return counts


def language_model(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of the fourth character after three, mixed with those after two, one and none."""
    shape = (CLASSES,) * _ORDER
    found = np.full(CLASSES, 1 / CLASSES)
    for order in range(1, _ORDER + 1):
        c = counts.reshape(shape).sum(axis=tuple(range(_ORDER - order))).astype(float)
        found = (c + 3.0 * found) / (c.sum(axis=-1, keepdims=True) + 3.0)
    return np.log(found).astype(np.float32)


class Decoder:
    """Viterbi decoding of disguised tokens; tokens seen before are looked up."""

    def __init__(self, model: np.ndarray, keep: int = 200_000) -> None:
        self.model, self.keep, self.known = model, keep, {}

    @staticmethod
    def lattice(token: str) -> list[list[tuple[str, float]]]:
        """Per place the letters it may be, "" for nothing, " " for a gap, and their log channel probabilities."""
        places: list[list[tuple[str, float]]] = []
        for run in re.finditer(r"(.)\1*", token, re.DOTALL):
            c, n = run[1], len(run[0])
            letter = _PLAIN.get(c, c)
            inside = 0 < run.start() and run.end() < len(token)
            if "a" <= letter <= "z":
                options = [(letter, -0.1 if n < 3 else -0.7)]
                if n > 1:
                    options = [(letter * 2, -0.1 if n == 2 else -0.7), (letter, -2.0 if n == 2 else -0.7)]
            elif c in LEET:
                options = [(x, -1.0) for x in LEET[c]]
                if n > 1:
                    options += [(x * 2, -1.0) for x in LEET[c]]
                options.append(("", -6.0))
                if c in _BETWEEN:
                    options.append((" ", -3.0))
            elif c == _ANY and inside and n < 3 and token[run.start() - 1].isalnum() and token[run.end()].isalnum():
                places += [[(chr(97 + k), -3.0) for k in range(26)]] * (n - 1)
                options = [(chr(97 + k), -3.0) for k in range(26)] + [("", -0.5), (" ", -3.0)]
            elif c in _BETWEEN:
                options = [("", -0.5), (" ", -0.5)] if n == 1 else [(" ", -0.3), ("", -1.5)]
            elif c.isalnum():
                options = [(c * n, 0.0)]  # no class of its own: it stays as it is
            else:
                options = [("", -0.5)]
            places.append(options)
        return places

    def decode(self, token: str) -> str:
        """The likeliest letters of the token, as words of its own."""
        # by state the score, and the letters so far as a chain
        best: dict[tuple[int, int, int], tuple[float, tuple | None]] = {(0, 0, 0): (0.0, None)}
        for options in [*self.lattice(token), [(" ", 0.0)]]:
            following: dict[tuple[int, int, int], tuple[float, tuple | None]] = {}
            for state, (score, chain) in best.items():
                for letters, cost in options:
                    s, total = state, score + cost
                    for x in letters:
                        k = 0 if x == " " else ord(x) - 96 if "a" <= x <= "z" else _OTHER
                        total += float(self.model[(*s, k)])
                        s = (s[1], s[2], k)
                    if s not in following or total > following[s][0]:
                        following[s] = (total, (chain, letters))
            best = following
        chain, made = max(best.values(), key=lambda x: x[0])[1], []
        while chain:
            made.append(chain[1])
            chain = chain[0]
        return "".join(reversed(made)).strip()

    def restore(self, match: re.Match) -> str:
        token = match[0]
        found = self.known.get(token)
        if found is None:
            core = _ENDS.sub("", token)
            read = dict.fromkeys(self.decode(x) if not x.isalpha() or _THRICE.search(x) else x for x in (token, core))
            if core.isalpha():
                read[core] = None  # a word of letters alone may be what it is
            found = f" {' '.join(read)} "
            if len(token) <= 64:  # longer ones hardly return
                if len(self.known) >= self.keep:
                    self.known.clear()
                self.known[token] = found
        return found

    def text(self, text: str) -> str:
        """Lower-case words, disguised ones restored, with spaces around them."""
        low = text.lower()
        try:
            raw = low.encode("latin-1")
        except UnicodeEncodeError:
            return f" {_GAPS.sub(' ', _DISGUISED.sub(self.restore, _ZERO_WIDTH.sub('', low)))} "
        if b"\xad" in raw:
            raw = raw.replace(b"\xad", b"")
        if _may_hide(raw):
            raw = _DISGUISED.sub(self.restore, raw.decode("latin-1")).encode("latin-1")
        return f" {raw.translate(_SPACED).decode('latin-1')} "


def _may_hide(raw: bytes) -> bool:
    """False if _DISGUISED can match nothing in this text."""
    x = np.frombuffer(raw, dtype=np.uint8)
    if len(x) < 2:
        return False
    kind = _KIND[x]
    letter, mark = kind == 1, kind == 2
    if (mark[1:] & letter[:-1]).any() or (mark[:-1] & letter[1:]).any():
        return True
    if (_CLASSED[x[2:]] & (x[2:] == x[1:-1]) & (x[1:-1] == x[:-2])).any():
        return True
    counts = _COUNTS[x]
    alone = np.flatnonzero(np.concatenate([[True], ~counts[:-1]]) & letter & np.concatenate([~counts[1:], [True]]))
    # nothing but what may separate single letters between one and the next
    other = np.cumsum(~_SEPARATES[x])
    near = other[alone[1:] - 1] == other[alone[:-1]]
    return bool((near[1:] & near[:-1]).any())


def _features(restored: str) -> set[str]:
    """Words " word " and word beginnings " wor" of 4 to 7 characters."""
    words = set(restored.split())
    return {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in range(4, min(7, len(w)) + 1)}


def _vectors(texts: list[str], automaton, n: int) -> np.ndarray:
    """Two columns for each feature: found, and found at least twice."""
    x = np.zeros((len(texts), 2 * n), np.float32)
    for i, text in enumerate(texts):
        if automaton is not None:
            for k, c in Counter(k for _, k in automaton.iter(text)).items():
                x[i, 2 * k] = 1
                x[i, 2 * k + 1] = c > 1
    return x


def _automaton(features: list[str]):
    import ahocorasick

    made = ahocorasick.Automaton()
    for k, f in enumerate(features):
        made.add_word(f, k)
    if not features:
        return None
    made.make_automaton()
    return made


def _fit(row: np.ndarray, column: np.ndarray, columns: int, y: np.ndarray, n: np.ndarray, strength: float = 0.02, again: float = 0.5, steps: int = 60) -> tuple[np.ndarray, float]:
    """Logistic regression with a quadratic penalty on the ones at (row, column), by Newton steps solved by conjugate gradients.

    Row i counts n[i] times. again is the penalty of the columns for a second find, so that one find tells as much as it can.
    """
    penalty = np.full(columns + 1, strength)
    penalty[1:-1:2], penalty[-1] = again, 1e-6

    def times(w: np.ndarray) -> np.ndarray:
        return np.bincount(row, w[column], minlength=len(y)) + w[-1]

    def back(v: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(column, v[row], minlength=columns), v.sum())

    w = np.zeros(columns + 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(times(w), -30, 30)))
        slope, curve = back(n * (p - y)) + penalty * w, n * p * (1 - p) + 1e-6
        scale = back(curve) + penalty
        step, left = np.zeros_like(w), slope.copy()
        along = left / scale
        fit = left @ along
        for _ in range(300):
            if fit < 1e-18:
                break
            bent = back(curve * times(along)) + penalty * along
            rate = fit / (along @ bent)
            step, left = step + rate * along, left - rate * bent
            following = left @ (left / scale)
            along, fit = left / scale + following / fit * along, following
        w -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-5:
            break
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = 12_000, least_gain: float = 2.5, weight: float = 2.0) -> dict:
    """The language model of all docs, and a classifier fitted on labelled (id, text, label).

    max_rows bounds the labelled rows that the classifier is fitted on, chosen by a hash of the id. A row with label 1
    counts weight times. least_gain is the log-likelihood ratio from which on a feature is used.
    """
    model = language_model(count_grams(docs, text_col))
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(model)
    mark = F.xxhash64(F.col(id_col).cast("string"))
    rows = labelled.where(F.col(label_col).isin(0, 1)).select(mark.alias("mark"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(label_col).cast("int").alias("label"))
    # a range of the hash that holds about max_rows rows; it depends on the number of rows only
    n = rows.count()
    if n > max_rows:
        rows = rows.where(F.shiftrightunsigned("mark", 33) < int(2**31 * max_rows / n))

    def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([decoder.text(x.as_py()) for x in batch.column(0)], pa.string()), batch.column(1)], ["text", "label"])

    # joined and restored once
    rows = checkpointed(map_arrow(rows.select("text", "label"), restored, "text string, label int"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[Counter] = [Counter(), Counter()]
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1), strict=True):
                seen[label.as_py()].update(_features(text.as_py()))
        names = list(seen[0].keys() | seen[1].keys())
        ones, zeros = (pa.array([seen[k][f] for f in names], pa.int64()) for k in (1, 0))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), ones, zeros], ["feature", "ones", "zeros"])

    totals = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    empty = {"model": model, "features": [], "weights": np.zeros(0), "bias": -30.0}
    if len(totals) < 2:
        return empty
    counted = map_arrow(rows, count, "feature string, ones long, zeros long").groupBy("feature").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    a, b = (F.col("ones") + 0.5) / (totals[1] + 1.0), (F.col("zeros") + 0.5) / (totals[0] + 1.0)
    # signed log-likelihood ratio of the feature among both labels
    both = (F.col("ones") + F.col("zeros") + 1.0) / (totals[0] + totals[1] + 2.0)
    gain = F.col("ones") * F.log(a / both) + F.col("zeros") * F.log(b / both)
    # bounded by the words of the bounded sample
    features = [r.feature for r in counted.where((F.col("ones") >= 3) & (a > 2 * b) & (gain >= least_gain)).orderBy(gain.desc(), "feature").select("feature").collect()]

    def spot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(features)
        for batch in batches:
            found = [np.flatnonzero(_vectors([text.as_py()], automaton, len(features))[0]).astype(np.int32) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["label", "found"])

    fitted = map_arrow(rows, spot, "label int, found array<int>").groupBy("label", "found").agg(F.count("*").alias("n")).collect()
    row, column = np.repeat(np.arange(len(fitted)), [len(r.found) for r in fitted]), np.array([k for r in fitted for k in r.found], dtype=np.int64)
    counts = np.array([r.n * (weight if r.label else 1.0) for r in fitted])
    weights, bias = _fit(row, column, 2 * len(features), np.array([r.label for r in fitted], float), counts)
    return {"model": model, "features": features, "weights": weights, "bias": bias}


def score(docs: DataFrame, trained: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score (0 to 1) of each row's whole text."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(trained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = shared.value
        decoder, automaton = Decoder(told["model"]), _automaton(told["features"])
        weights, bias = told["weights"], told["bias"]
        for batch in batches:
            z = np.full(batch.num_rows, bias)
            for i, value in enumerate(batch.column(1)):
                text = value.as_py()
                if text and automaton is not None:
                    for k, n in Counter(k for _, k in automaton.iter(decoder.text(text))).items():
                        z[i] += weights[2 * k] + (weights[2 * k + 1] if n > 1 else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], ["id", "score"])

    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, schema)
