"""Tokens of whole texts, with each word's ids kept, so that a word is encoded once in a task.

The tokenizer splits a text into words by a pattern and encodes each on its own. For texts of plain Latin characters the
same split is made here: new words go to the tokenizer's model, the ids of words (and of whole runs between white space)
seen before are joined. Every other text (combining marks, characters whose case or class depends on a Unicode version,
special tokens) goes to the tokenizer as a whole. A test holds both ways against each other.
"""

from __future__ import annotations

import re
import struct

import numpy as np

#: Texts of these characters only are split here.
_PLAIN = re.compile("[\t-\r -~\xa0-\xac\xae-\xffŒœ–—‘’“”…€]*")
#: The words of a lower-cased text: contractions, runs of letters, single digits, runs of other characters.
_LETTER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xffœ"
_DIGIT = "0-9\xb2\xb3\xb9\xbc-\xbe"
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^\\s{_LETTER}{_DIGIT}]+")
_SPECIAL = re.compile(r"<\|(?:startoftext|endoftext)\|>")


class WordTokens:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, keep: int = 1_000_000) -> None:
        """keep bounds the words, and the runs between white space, whose ids are held; beyond it a table starts anew."""
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer, self.keep = Tokenizer.from_file(path), keep
        # how the tokenizer's model sees each plain character: by the bytes of its UTF-8
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.shown = {ord(c): as_bytes(c)[0][0] for c in map(chr, range(33, 0x2100)) if _PLAIN.fullmatch(c)}
        self.words: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn_words(self, words: set[str]) -> None:
        if len(self.words) + len(words) > self.keep:
            self.words.clear()
        tokenize, shown = self.tokenizer.model.tokenize, self.shown
        for w in words:
            if w not in self.words:
                ids = [x.id for x in tokenize(w.translate(shown))]
                self.words[w] = struct.pack(f"<{len(ids)}I", *ids)

    def _learn_runs(self, runs: set[str]) -> None:
        """Words don't reach over white space, so a run's ids are those of its words."""
        if len(self.runs) + len(runs) > self.keep:
            self.runs.clear()
        split = {r: _WORDS.findall(r) for r in runs if r not in self.runs}
        self._learn_words({w for words in split.values() for w in words})
        known = self.words
        for run, words in split.items():
            self.runs[run] = known[words[0]] if len(words) == 1 else b"".join([known[w] for w in words])

    def encode(self, text: str) -> bytes:
        if not (_PLAIN.fullmatch(text) and not ("<|" in text and _SPECIAL.search(text))):
            return self.whole(text)
        runs = text.lower().split()
        try:
            return b"".join(map(self.runs.__getitem__, runs))
        except KeyError:
            self._learn_runs(set(runs))
            return b"".join(map(self.runs.__getitem__, runs))
