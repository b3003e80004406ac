"""Token ids of whole texts with a word vocabulary whose words end in a marked token.

White space never joins two words, so a text's ids are those of its runs of non-space characters.
A worker keeps the ids of the runs it has met; a new run is split into the vocabulary's words, and
words that are new are encoded many in one call and told apart by their end tokens. Texts with
strings of special tokens, and vocabularies of another kind, are left to the library as a whole.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np

#: Runs and words whose ids a worker keeps, and their characters.
CACHE_WORDS, CACHE_CHARS = 1_600_000, 24 << 20
#: Texts looked at together, and words in one call of the library.
TEXTS, WORDS = 200, 500

# fixed values: the split of the vocabulary file, and its form for Latin-1 characters
RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_L, _N = "a-zA-Zªµºß-öø-ÿÀ-ÖØ-Þ", "0-9²³¹¼-¾"
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_L}{_N}]+")
# end of fixed values
#: str.split() takes these for white space, the vocabulary does not.
_SEPARATORS = "\x1c\x1d\x1e\x1f"


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Numbers(dict):
    """Numbers strings from 0 as they come, and lists the new ones."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        return n

    def taken(self) -> list[str]:
        new, self.new = self.new, []
        return new


class Table:
    """Ids of numbered strings, in one array."""

    def __init__(self):
        self.size, self.stop = 0, np.zeros(1 << 12, np.int64)  # the end of each string's ids
        self.flat = np.zeros(1 << 14, np.uint32)

    def append(self, ids: np.ndarray, counts: np.ndarray) -> None:
        """The next numbers' ids."""
        first = int(self.stop[self.size])
        for name, need in (("stop", self.size + len(counts) + 1), ("flat", first + len(ids))):
            old = getattr(self, name)
            if need > len(old):
                grown = np.zeros(max(need, 2 * len(old)), old.dtype)
                grown[:len(old)] = old
                setattr(self, name, grown)
        self.flat[first:first + len(ids)] = ids
        self.stop[self.size + 1:self.size + len(counts) + 1] = first + np.cumsum(counts)
        self.size += len(counts)

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these numbers in a row, and where each one's end."""
        start = self.stop[numbers]
        count = self.stop[numbers + 1] - start
        ends = np.cumsum(count)
        if not len(ends):
            return np.zeros(0, np.uint32), ends
        return self.flat[np.arange(ends[-1]) + np.repeat(start - ends + count, count)], ends


class WordIds:
    """Token ids of texts as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        suffix = told["model"].get("end_of_word_suffix")
        self.by_word = bool(suffix) and RULE in json.dumps(told["pre_tokenizer"], ensure_ascii=False).replace("\\\\", "\\")
        self.ends = np.zeros(self.size, bool)
        for token, i in self.tokenizer.get_vocab().items() if suffix else ():
            self.ends[i] = token.endswith(suffix)
        self.clear()

    def clear(self) -> None:
        self.runs, self.words, self.chars = Numbers(), Numbers(), 0
        self.run_ids, self.word_ids = Table(), Table()

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _learn(self, words: list[str]) -> None:
        """Ids of new words, each of which is one word of the vocabulary's split or a run left as it is."""
        for i in range(0, len(words), WORDS):
            part = words[i:i + WORDS]
            stop = np.zeros(0, np.int64)
            if all(map(_latin, part)):
                ids = self._encode(" ".join(part))
                stop = np.flatnonzero(self.ends[ids]) + 1
            if len(stop) == len(part):
                self.word_ids.append(ids, np.diff(stop, prepend=0))
            else:
                each = [self._encode(w) for w in part]
                self.word_ids.append(np.concatenate(each), np.array([len(x) for x in each]))
        self.chars += sum(map(len, words))

    def _meet(self, runs: list[str]) -> None:
        """Ids of new runs of non-space characters, from those of their words."""
        split = [_WORDS.findall(r.lower()) if _latin(r) else [r] for r in runs]
        numbers = np.fromiter(map(self.words.__getitem__, chain.from_iterable(split)), np.int64)
        self._learn(self.words.taken())
        ids, ends = self.word_ids.take(numbers)
        per = np.concatenate([[0], ends])[np.cumsum([len(x) for x in split])]
        self.run_ids.append(ids, np.diff(per, prepend=0))
        self.chars += sum(map(len, runs))

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        for i in range(0, len(texts), TEXTS):
            if len(self.runs) + len(self.words) > CACHE_WORDS or self.chars > CACHE_CHARS:
                self.clear()
            part, numbers = texts[i:i + TEXTS], []
            for t in part:
                if not self.by_word or "<|" in t or any(c in t for c in _SEPARATORS):
                    numbers.append(None)
                else:
                    runs = (t.lower() if _latin(t) else t).split()
                    numbers.append(np.fromiter(map(self.runs.__getitem__, runs), np.int64, len(runs)))
            if self.runs.new:
                self._meet(self.runs.taken())
            for t, n in zip(part, numbers, strict=True):
                yield (self._encode(t) if n is None else self.run_ids.take(n)[0]).astype("<u4").tobytes()


@functools.lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    return WordIds(path)
