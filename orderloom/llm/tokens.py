"""Token ids of whole texts in Arrow batches."""

from __future__ import annotations

import json
import os
import re
import string
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import chain

import numpy as np
from tokenizers import Tokenizer

# Documents are tokenised in groups of about this many characters. Between groups a
# worker keeps the ids of about this many distinct words, the most frequent ones.
GROUP_CHARS = 1 << 20
MOST_WORDS = 250_000

# Letters that stay one word through normalisation, and what may close a word. An
# apostrophe may open a part of its own, and <| the name of a special token.
PLAIN = re.compile(rb"(?:[a-zA-Z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+\Z")
CLOSING = b"".join(bytes([c]) for c in string.punctuation.encode() if c not in b"'<|")
PLAIN_PER_CALL = 500


class Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __init__(self, words: Sequence[bytes] = ()):
        super().__init__(zip(words, range(len(words)), strict=True))
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class WordTokenizer:
    """Ids of a tokenizer that lowers case and drops white space, word by word.

    Such a tokenizer never joins text across ASCII white space, so each distinct
    word goes through it once and repeats are looked up. The result equals that of
    encoding the whole text. New words of plain letters go through it together;
    the end-of-word mark of their last tokens tells them apart. Marks that close
    such a word make a part of their own, so its ids are those of the letters and
    those of the marks, and most words that are new with their marks need no call.
    """

    def __init__(self, path: str, separator: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks use the cores
        self.tokenizer = Tokenizer.from_file(path)
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, nr in vocabulary.items():
            self.is_end[nr] = bool(suffix) and token.endswith(suffix)
        # The empty word, which splitting never gives, stands for the separator.
        self.numbers = Numbers([b""])
        self.starts = np.array([0], np.int64)
        self.lengths = np.array([1], np.int64)
        self.uses = np.array([1], np.int64)
        self.ids = np.array([separator], np.uint32)

    def _keep_frequent(self) -> None:
        floor = max(2, np.partition(self.uses, -MOST_WORDS // 2)[-MOST_WORDS // 2] + 1)
        keep = self.uses >= floor
        keep[0] = True
        words = [w for w, kept in zip(self.numbers, keep.tolist(), strict=True) if kept]
        starts, self.lengths, self.uses = self.starts[keep], self.lengths[keep], self.uses[keep] // 2
        ends = np.cumsum(self.lengths)
        self.ids = self.ids[np.repeat(starts - (ends - self.lengths), self.lengths) + np.arange(ends[-1])]
        self.starts, self.numbers = ends - self.lengths, Numbers(words)

    def _encode_each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum())), lengths

    def _encode_plain(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        runs = [b" ".join(words[i : i + PLAIN_PER_CALL]).decode() for i in range(0, len(words), PLAIN_PER_CALL)]
        flat, _ = self._encode_each(runs)
        return flat, np.diff(np.flatnonzero(self.is_end[flat]) + 1, prepend=0)

    def _learn_new(self) -> None:
        plain, other, closed, parts = [], [], [], []
        joint, known = self.is_end.any(), len(self.starts)
        # Letters and marks that are new as well are added to the words while these are gone through.
        words = self.numbers.new
        for number, word in enumerate(words, known):
            if not joint:
                other.append(number)
            elif word.isalpha():  # ASCII letters only
                plain.append(number)
            else:
                letters = word.rstrip(CLOSING)
                if not (letters.isalpha() or PLAIN.match(letters)):
                    other.append(number)
                elif letters == word:
                    plain.append(number)
                else:
                    closed.append(number)
                    parts += (self.numbers[letters], self.numbers[word[len(letters) :]])
        self.numbers.new = []
        plain_ids, plain_lengths = self._encode_plain([words[n - known] for n in plain])
        other_ids, other_lengths = self._encode_each([words[n - known].decode() for n in other])
        added = np.zeros(len(words), np.int64)
        self.uses = np.concatenate([self.uses, added])
        self.starts, self.lengths = np.concatenate([self.starts, added]), np.concatenate([self.lengths, added])
        self._append(plain + other, np.concatenate([plain_ids, other_ids]), np.concatenate([plain_lengths, other_lengths]))
        if closed:
            parts = np.array(parts, np.int64)
            self.uses += np.bincount(parts, minlength=len(self.uses))
            ids, ends = self._ids_of(parts)
            self._append(closed, ids, np.diff(ends[1::2], prepend=0))

    def _append(self, numbers: list[int], ids: np.ndarray, lengths: np.ndarray) -> None:
        """The ids of the words with these numbers, one after the other."""
        at = np.array(numbers, np.int64)
        self.starts[at] = len(self.ids) + np.cumsum(lengths) - lengths
        self.lengths[at] = lengths
        self.ids = np.concatenate([self.ids, ids])

    def _ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words in a row, and where each word ends."""
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[numbers] - (ends - lengths), lengths)
        shift += np.arange(len(shift))
        return self.ids[shift], ends

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by the separator, and where each one ends."""
        if len(self.numbers) > MOST_WORDS:
            self._keep_frequent()
        # Lower case makes fewer distinct words; the names of special tokens need theirs.
        data = (text.encode() for text in texts)
        words = [(d if b"<|" in d else d.lower()).split() + [b""] for d in data]
        in_text = np.fromiter(map(len, words), np.int64, len(words))
        flat = chain.from_iterable(words)
        at = np.fromiter(map(self.numbers.__getitem__, flat), np.int64, int(in_text.sum()))
        if self.numbers.new:
            self._learn_new()
        self.uses += np.bincount(at, minlength=len(self.uses))
        ids, ends = self._ids_of(at)
        return ids, ends[np.cumsum(in_text) - 1]


@cache
def word_tokenizer(path: str, separator: int) -> WordTokenizer:
    """One per worker process and file."""
    return WordTokenizer(path, separator)


def groups(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``GROUP_CHARS``, with the place of the first one."""
    first, chars, run = 0, 0, []
    for nr, text in enumerate(texts):
        run.append(text or "")
        chars += len(run[-1])
        if chars >= GROUP_CHARS:
            yield first, run
            first, chars, run = nr + 1, 0, []
    if run:
        yield first, run
