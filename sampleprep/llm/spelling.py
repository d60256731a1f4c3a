"""Spelling variant grouping with a bit-sliced position index.

Words of a vocabulary that differ by one inserted, deleted or replaced letter are near. A class m compares words of m
letters with each other and with those of m + 1. Two near words first differ behind some number of letters, their common
prefix; where that number lies in [a, b), they share a letters at the start and m - b at the end, so a class is dealt into
buckets by halves of the word, and a bucket over most_words is dealt again by halves of its interval. At an interval of one place
a bucket holds as many words as two free letters can make, so no bucket grows with the vocabulary and each pair meets in one.

In a bucket, the index has a bitset of its words for each position and letter. For each word, and 64 words of the bucket at a time,
two sets are carried along its letters: those without an error so far and those with exactly one, the latter with positions shifted by
one for an insertion or a deletion. Bits stand in the order of falling counts, so a word's best neighbour is the first bit of
its set and the number of neighbours its bit count; a bucket gives one row for a word, never the pairs.

Defined cases: null text has no words; a null id counts as an empty one; repeated rows count each; ties go to the smaller word
in code-point order; words of any length are read whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleprep.llm.common import checkpointed
from sampleprep.session import map_arrow

LETTERS = "A-Za-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A bucket's bound falls for long words, so that its letters fit in a worker; so do the letters and sets of one round.
_BUCKET_LETTERS, _ROUND_LETTERS, _ROUND_SETS = 1 << 22, 1 << 22, 1 << 20


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 7, least_n: int = 2, noise: int = 31) -> DataFrame:
    """word and n of all words of texts; one in noise occurrences, by a checksum of id and word, loses a letter first."""
    # a shorter run gives no word: it can only lose letters
    runs = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(F.regexp_extract_all(text_col, F.lit(f"[{LETTERS}]{{{least_chars},}}"), F.lit(0))).alias("run"))
    lower = runs.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    sums = lower.select("run", F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), F.col("run")).cast("binary")).alias("h"))
    place = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), place), F.substring(F.col("run"), place + 2, F.length("run")))
    words = sums.select(F.when(F.col("h") % noise == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least_chars)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n)


def _key(m: Column, a: Column, b: Column) -> Column:
    """What the words of a bucket share: class, interval, first a letters, last m - b letters."""
    tail = F.greatest(m - b, F.lit(0))
    first, last = F.substring(F.col("word"), F.lit(1), a), F.substring(F.col("word"), F.length("word") - tail + 1, tail)
    return F.concat_ws(":", m, a, b, first, last)


def _split(postings: DataFrame, cut: Column) -> DataFrame:
    """The postings under both parts of their intervals."""
    halves = F.array(F.struct(F.col("a").alias("a"), cut.alias("b")), F.struct(cut.alias("a"), F.col("b").alias("b")))
    dealt = postings.select("word", "n", "m", F.explode(halves).alias("half")).select("word", "n", "m", "half.a", "half.b")
    return dealt.withColumn("key", _key(F.col("m"), F.col("a"), F.col("b")))


def buckets(words: DataFrame, most_words: int = 4096) -> DataFrame:
    """word, n, m, a, b and key: each word under the buckets where its near words are."""
    m = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("m")
    whole = words.select("word", "n", m).where("m > 0").withColumns({"a": F.lit(0), "b": F.col("m") + 1})
    open_ = _split(whole, ((F.col("m") + 1) / 2).cast("int"))
    most = F.greatest(F.lit(64), F.least(F.lit(most_words), (F.lit(_BUCKET_LETTERS) / F.col("m")).cast("int")))
    done = None
    while True:
        heavy = checkpointed(open_.where("b - a > 1").groupBy("key", "m").agg(F.count("*").alias("many")).where(F.col("many") > most).select("key"))
        if heavy.isEmpty():
            return open_ if done is None else done.unionByName(open_)
        light = open_.join(heavy, "key", "left_anti")
        done = light if done is None else done.unionByName(light)
        open_ = checkpointed(_split(open_.join(heavy, "key", "left_semi"), ((F.col("a") + F.col("b")) / 2).cast("int")))


def _letters(words: list[str], width: int) -> tuple[np.ndarray, int]:
    """The words' letters as small numbers, a row for each, and how many numbers there are."""
    points = np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)
    seen = np.bincount(points.ravel()) > 0
    return (np.cumsum(seen) - 1).astype(np.int32)[points], int(seen.sum())


class Index:
    """Words of several buckets of one class and interval, as bitsets of 64 words by position and letter.

    A group is a bucket's words of one length, m or m + 1 letters; sizes has its letters a word, starts its first word.
    """

    def __init__(self, words: list[str], sizes: np.ndarray, starts: np.ndarray, m: int):
        self.codes, self.letters = _letters(words, m + 1)
        self.sizes, self.starts = sizes, starts
        counts = np.diff(np.append(starts, len(words)))
        self.group = np.repeat(np.arange(len(starts)), counts)
        self.slots = -(-counts // 64)
        self.base = np.cumsum(self.slots) - self.slots
        rank = np.arange(len(words)) - starts[self.group]
        self.slot = self.base[self.group] + rank // 64
        self.bit = np.uint64(1) << (rank % 64).astype(np.uint64)
        self.full = np.zeros(int(self.slots.sum()), dtype=np.uint64)
        np.add.at(self.full, self.slot, self.bit)

    def bitsets(self, place: int) -> np.ndarray:
        """For each 64 words and letter, the words with that letter at place."""
        made = np.zeros(len(self.full) * self.letters, dtype=np.uint64)
        if 0 <= place < self.codes.shape[1]:
            there = self.sizes[self.group] > place
            np.add.at(made, self.slot[there] * self.letters + self.codes[there, place], self.bit[there])
        return made

    def questions(self, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, slot) for each word and each 64 words of the group that other has for the word's group (-1: none)."""
        asked = other[self.group]
        many = np.where(asked >= 0, self.slots[asked], 0)
        word = np.repeat(np.arange(len(self.group)), many)
        nth = np.arange(len(word)) - np.repeat(np.cumsum(many) - many, many)
        return word, self.base[asked[word]] + nth


def one_error(index: Index, asked: dict[int, tuple[np.ndarray, np.ndarray]], m: int, a: int, b: int) -> dict[int, np.ndarray]:
    """For each question the set of words with exactly one error whose common prefix has from a to b - 1 letters.

    asked: questions by how many letters the asked words have more than the asking one (0, 1, -1).
    """
    state = {d: (index.full[slot], np.zeros(len(slot), dtype=np.uint64)) for d, (_, slot) in asked.items()}
    before, here = np.zeros(0, dtype=np.uint64), index.bitsets(a)
    for i in range(a, min(b, m) + 1):
        after = index.bitsets(i + 1)
        for d, (word, slot) in asked.items():
            none, one = state[d]
            at = slot * index.letters + index.codes[word, i]
            if d == -1:  # the asking word has m + 1 letters; behind the interval no new error begins
                shifted = one & before[at] if i > a else one
                same = here[at]
                state[d] = none & same, shifted | (none & ~same) if i < b else shifted
            elif i < min(b, m):
                same = here[at]
                state[d] = none & same, (one & same) | (none & ~same) if d == 0 else (one | (none & ~same)) & after[at]
            elif d == 1 and i < b:  # the letter more is the last
                state[d] = none, one | none
        before, here = here, after
    return {d: one for d, (_, one) in state.items()}


def neighbours(words: list[str], n: np.ndarray, new_bucket: np.ndarray, m: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """asking word, number of near words and the best of them, as places in words, of buckets of one class and interval.

    new_bucket: True where a bucket begins; in it words stand by length, then falling n, then code points.
    """
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    begins = new_bucket | np.append(True, size[1:] != size[:-1])
    starts = np.flatnonzero(begins)
    bucket = np.cumsum(new_bucket)[starts]
    index = Index(words, size[starts], starts, m)
    short, alike = index.sizes == m, np.append(bucket[1:] == bucket[:-1], False)
    own, up = np.arange(len(starts)), np.full(len(starts), -1)
    up[alike] = own[alike] + 1
    down = np.full(len(starts), -1)
    down[1:][alike[:-1]] = own[:-1][alike[:-1]]
    asked = {0: index.questions(np.where(short, own, -1)), 1: index.questions(up), -1: index.questions(down)}
    asking, many, best = [], [], []
    for d, one in one_error(index, asked, m, a, b).items():
        word, slot = asked[d]
        hit = np.flatnonzero(one)
        if not len(hit):
            continue
        who, first, back = np.unique(word[hit], return_index=True, return_inverse=True)
        low = one[hit[first]]
        bit = np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        at = slot[hit[first]]
        group = np.searchsorted(index.base, at, side="right") - 1
        asking.append(who)
        many.append(np.bincount(back, weights=np.bitwise_count(one[hit])).astype(np.int64))
        best.append(starts[group] + (at - index.base[group]) * 64 + bit)
    none = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate(x) if x else none for x in (asking, many, best))


def _rounds(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Whole buckets with two words or more, of one class and interval, in rounds whose letters and sets are bounded."""
    keys, m, a, b = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("key", "m", "a", "b"))
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    counts = np.diff(np.append(starts, len(keys)))
    starts, counts = starts[counts > 1], counts[counts > 1]
    letters, sets = counts * (m[starts].astype(np.int64) + 1), counts * (counts // 64 + 2)
    at = 0
    while at < len(starts):
        k = starts[at]
        same = (m[starts[at:]] == m[k]) & (a[starts[at:]] == a[k]) & (b[starts[at:]] == b[k])
        fits = same & (np.cumsum(letters[at:]) <= _ROUND_LETTERS) & (np.cumsum(sets[at:]) <= _ROUND_SETS)
        end = at + max(1, int(np.argmin(fits)) if not fits.all() else len(fits))
        yield rows.take(np.concatenate([np.arange(s, s + c) for s, c in zip(starts[at:end], counts[at:end], strict=True)]))
        at = end


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: list[pa.RecordBatch] = []

    def answers(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for some in _rounds(rows):
            keys, n = some.column("key").to_numpy(zero_copy_only=False), some.column("n").to_numpy()
            m, a, b = (some.column(c)[0].as_py() for c in ("m", "a", "b"))
            who, many, best = neighbours(some.column("word").to_pylist(), n, np.append(True, keys[1:] != keys[:-1]), m, a, b)
            if len(who):
                yield pa.RecordBatch.from_arrays([some.column("word").take(who), pa.array(many), some.column("word").take(best), pa.array(n[best])], ["word", "n_near", "form", "form_n"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([*kept, batch]).combine_chunks().to_batches()[0]
        keys = rows.column("key").to_numpy(zero_copy_only=False)
        changes = np.flatnonzero(keys[1:] != keys[:-1])
        end = int(changes[-1]) + 1 if len(changes) else 0  # the last bucket may go on in the next batch
        yield from answers(rows.slice(0, end))
        kept = [rows.slice(end)]
    if kept:
        yield from answers(kept[0])


def near_words(words: DataFrame, most_words: int = 4096) -> DataFrame:
    """word, n_near, form and form_n (the near word of largest n and its n) of the words (word, n) that have a near one."""
    dealt = buckets(words, most_words).withColumn("chars", F.length("word"))
    dealt = dealt.repartition("key").sortWithinPartitions("m", "a", "b", "key", "chars", F.desc("n"), "word").drop("chars")
    found = map_arrow(dealt, _near, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", "best.form", (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root: where the forms (word, form) lead. A form's count is larger than its word's, so every way ends."""
    steps = checkpointed(forms.select("word", "form"))
    state = steps.select("word", F.col("form").alias("root"))
    while True:
        onward = steps.select(F.col("word").alias("root"), "form")
        moved = checkpointed(state.join(onward, "root", "left").select("word", F.coalesce("form", "root").alias("root"), F.col("form").isNotNull().alias("moved")))
        state = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return state


def group_variants(words: DataFrame, times: int = 10, most_words: int = 4096) -> DataFrame:
    """word, form, root, n, n_near and form_n of a vocabulary (word, n): a word's form is its near word of largest n, if that n is times its own."""
    if times < 2:
        raise ValueError("times: 2 or more")
    words = checkpointed(words)
    near = words.join(near_words(words, most_words), "word", "left")
    formed = F.col("form_n") >= times * F.col("n")
    judged = checkpointed(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("form")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n")))
    ended = judged.join(roots(judged.where("form is not null")), "word", "left")
    return ended.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
