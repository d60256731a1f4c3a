"""Language ID with a byte convolutional network.

Filters of several widths over byte embeddings, max pooling over a window of fixed length, softmax over the labels;
trained in numpy on windows of labelled rows. For scoring, embedding and filters are folded into tables by byte pair, and
all windows of a text (the whole text, the last one padded with spaces) are scored in batches; a text's result is
the mean over its windows.

Defined cases: null text, or text without a letter, is "und" with score 0; labels that are null are not learned; without
any labelled text everything is "und"; ties go to the first label by code point; repeated rows are scored alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleprep.session import map_arrow

_LETTER = re.compile(r"[^\W\d_]")
WIDTHS = (2, 3, 4)


def has_letter(text: str | None) -> bool:
    if not text:
        return False
    found = _LETTER.search(text)
    return bool(found) and (found[0].isalpha() or any(c.isalpha() for c in text))


def windows_of(data: bytes, length: int) -> np.ndarray:
    """Rows of length bytes that hold all of data, the last one padded with spaces."""
    rows = max(1, -(-len(data) // length))
    return np.frombuffer(data.ljust(rows * length, b" "), dtype=np.uint8).reshape(rows, length)


class ByteCNN:
    """The network; labels are sorted by code point."""

    def __init__(self, labels: list[str], length: int = 128, dims: int = 8, filters: int = 8, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        self.labels, self.length, self.dims, self.filters = sorted(labels), length, dims, filters
        self.weights = {"embed": rng.normal(0, 0.5, (256, dims)).astype(np.float32)}
        for w in WIDTHS:
            self.weights[f"w{w}"] = rng.normal(0, (w * dims) ** -0.5, (w * dims, filters)).astype(np.float32)
            self.weights[f"b{w}"] = np.zeros(filters, np.float32)
        self.weights["out"] = rng.normal(0, 0.1, (len(WIDTHS) * filters, len(self.labels))).astype(np.float32)
        self.weights["bias"] = np.zeros(len(self.labels), np.float32)

    def _step(self, x: np.ndarray, y: np.ndarray, row_weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients of a batch of windows x with label numbers y."""
        p, d, n = self.weights, self.dims, len(x)
        rows = np.arange(n)[:, None]
        e = p["embed"][x]
        kept, pooled = [], []
        for w in WIDTHS:
            columns = np.concatenate([e[:, j : self.length - w + 1 + j] for j in range(w)], axis=2)
            value = columns @ p[f"w{w}"]
            best = value.argmax(axis=1)
            kept.append((columns, best))
            pooled.append(value[rows, best, np.arange(self.filters)[None]] + p[f"b{w}"])
        z = np.concatenate(pooled, axis=1)
        h = np.maximum(z, 0)
        logits = h @ p["out"] + p["bias"]
        logits -= logits.max(axis=1, keepdims=True)
        q = np.exp(logits)
        q /= q.sum(axis=1, keepdims=True)
        loss = float(-(row_weight * np.log(q[np.arange(n), y] + 1e-9)).sum())
        q[np.arange(n), y] -= 1
        q *= row_weight[:, None]
        g = {"out": h.T @ q, "bias": q.sum(axis=0), "embed": np.zeros_like(p["embed"])}
        back = (q @ p["out"].T) * (z > 0)
        for k, w in enumerate(WIDTHS):
            columns, best = kept[k]
            part = back[:, k * self.filters : (k + 1) * self.filters]
            chosen = columns[rows, best]
            g[f"w{w}"] = np.einsum("nfc,nf->cf", chosen, part)
            g[f"b{w}"] = part.sum(axis=0)
            for j in range(w):
                np.add.at(g["embed"], x[rows, best + j], part[:, :, None] * p[f"w{w}"][j * d : (j + 1) * d].T[None])
        return loss, g

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 128, rate: float = 0.01, seed: int = 2) -> None:
        """Adam over shuffled batches; classes weigh alike."""
        rng, t = np.random.default_rng(seed), 0
        share = np.bincount(y, minlength=len(self.labels)).astype(float)
        weight = (len(y) / np.maximum(share, 1) / len(self.labels)).astype(np.float32)[y]
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for epoch in range(epochs):
            order = rng.permutation(len(y))
            for at in range(0, len(y), batch):
                some = order[at : at + batch]
                _, g = self._step(x[some], y[some], weight[some] / len(some))
                t += 1
                for k, v in self.weights.items():
                    first[k] = 0.9 * first[k] + 0.1 * g[k]
                    second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
                    v -= rate * 0.7**epoch * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)

    def folded(self) -> dict[str, np.ndarray]:
        """Tables of filter responses: by byte pair for widths 2 and 4, and the third byte's part of width 3."""
        p, d = self.weights, self.dims
        part = lambda w, j: p["embed"] @ p[f"w{w}"][j * d : (j + 1) * d]
        pair = lambda w, j: (part(w, j)[:, None] + part(w, j + 1)[None]).reshape(65536, -1)
        both = np.concatenate([pair(2, 0), pair(3, 0), pair(4, 0), pair(4, 2)], axis=1)
        return {"pair": np.ascontiguousarray(both, dtype=np.float32), "third": np.ascontiguousarray(part(3, 2), dtype=np.float32)}


def probabilities(x: np.ndarray, model: dict, tables: dict[str, np.ndarray], block: int = 256) -> np.ndarray:
    """A row of label probabilities for each window."""
    f, out = model["filters"], np.empty((len(x), len(model["labels"])), np.float32)
    bias = np.concatenate([model["weights"][f"b{w}"] for w in WIDTHS])
    for at in range(0, len(x), block):
        b = x[at : at + block]
        g = tables["pair"].take(b[:, :-1].astype(np.int32) * 256 + b[:, 1:], axis=0)
        h2 = g[:, :, :f].max(axis=1)
        h3 = (g[:, :-1, f : 2 * f] + tables["third"].take(b[:, 2:], axis=0)).max(axis=1)
        h4 = (g[:, :-2, 2 * f : 3 * f] + g[:, 2:, 3 * f :]).max(axis=1)
        logits = np.maximum(np.concatenate([h2, h3, h4], axis=1) + bias, 0) @ model["weights"]["out"] + model["weights"]["bias"]
        q = np.exp(logits - logits.max(axis=1, keepdims=True))
        out[at : at + block] = q / q.sum(axis=1, keepdims=True)
    return out


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = 4000, per_row: int = 3, length: int = 128) -> dict | None:
    """Fit the network on per_row windows, at places given by a hash, of about max_rows rows chosen by a hash of the id.

    max_rows bounds the sample that the driver gets (max_rows * per_row * length characters). None without labels.
    """
    mark = F.xxhash64(F.col(id_col).cast("string"))
    span = F.greatest(F.length(text_col) - length, F.lit(0)) + 1
    cuts = F.array(*[F.substring(F.col(text_col), (F.pmod(F.xxhash64(mark, F.lit(k)), span.cast("long")) + 1).cast("int"), F.lit(length)) for k in range(per_row)])
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    n = rows.count()
    if n > max_rows:
        rows = rows.where(F.shiftrightunsigned(mark, 33) < int(2**31 * max_rows / n))
    rows = sorted(rows.select(mark.alias("mark"), F.col(lang_col).alias("lang"), cuts.alias("cuts")).collect())
    if not rows:
        return None
    net = ByteCNN(sorted({r.lang for r in rows}), length)
    at = {name: k for k, name in enumerate(net.labels)}
    parts = [(windows_of(c.encode().lower(), length)[0], at[r.lang]) for r in rows for c in r.cuts]
    net.train(np.stack([x for x, _ in parts]), np.array([y for _, y in parts]))
    return {"labels": net.labels, "length": length, "filters": net.filters, "weights": net.weights, "tables": net.folded()}


def identify(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text", most_windows: int = 2048) -> DataFrame:
    """id, lang_pred and score of each row. Texts are taken together up to about most_windows windows at a time."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    session = docs.sparkSession.sparkContext
    shared = session.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value

        def scored(texts: list[str]) -> list[tuple[str, float]]:
            """Windows of these texts together; then the mean over each one's own."""
            parts = [windows_of(t.encode("utf-8", "replace").lower(), net["length"]) for t in texts]
            sizes = np.array([len(p) for p in parts])
            found = probabilities(np.concatenate(parts), net, net["tables"])
            mean = np.add.reduceat(found, np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0) / sizes[:, None]
            best = mean.argmax(axis=1)
            return [(net["labels"][k], float(min(1.0, m[k]))) for k, m in zip(best, mean, strict=True)]

        for batch in batches:
            results: list[tuple[str, float]] = [("und", 0.0)] * batch.num_rows
            waiting: list[tuple[int, str]] = []
            size = 0
            for i, value in enumerate(batch.column(1)):
                text = value.as_py()
                if net is None or not has_letter(text):
                    continue
                waiting.append((i, text))
                size += len(text) // net["length"] + 1
                if size >= most_windows:
                    for (k, _), r in zip(waiting, scored([t for _, t in waiting]), strict=True):
                        results[k] = r
                    waiting, size = [], 0
            if waiting:
                for (k, _), r in zip(waiting, scored([t for _, t in waiting]), strict=True):
                    results[k] = r
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r[0] for r in results], pa.string()), pa.array([r[1] for r in results], pa.float64())], ["id", "lang_pred", "score"])

    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, schema)


def fold_of(id_col: str, folds: int) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def keep_identified(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text", least_confidence: float = 1 / 15) -> DataFrame:
    """The rows whose language is known, with all their columns.

    Confidence is the mean score of the best label between chance (0, whatever the number of labels) and certainty (1). With four
    labels the default asks for 0.3. A model of a few hundred rows is unsure of good texts too, so the default is low: it only rejects what
    resembles all labels alike, and texts without letters. A text in a language that was not learned can resemble one that was, and stays then.

    The decision is made where the row is, so no text is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        at = names.index(text_col)
        for batch in batches:
            keep = []
            for value in batch.column(at):
                text = value.as_py()
                if net is None or not has_letter(text):
                    keep.append(False)
                    continue
                found = probabilities(windows_of(text.encode("utf-8", "replace").lower(), net["length"]), net, net["tables"])
                chance = 1 / len(net["labels"])
                keep.append(bool(found.mean(axis=0).max() >= chance + least_confidence * (1 - chance)))
            yield batch.filter(pa.array(keep, pa.bool_()))

    names = docs.columns
    return map_arrow(docs, run, docs.schema)
