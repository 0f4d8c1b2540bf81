"""Statistics of each text in a slice, from its bytes and the hashes of its words and lines."""

from __future__ import annotations

import numpy as np

from clickloom.llm.text import (
    LOWER,
    hash_sums,
    in_text,
    owners,
    span_hashes,
    sums_by_text,
    windows,
    words,
)

#: Kinds of bytes, in the order of ``KIND``'s numbers.
KINDS = "lower upper digit space newline sentence symbol pipe bracket other_ascii control non_ascii inside".split()
KIND = np.full(256, KINDS.index("control"), np.uint8)
for _byte in range(256):
    _c = chr(_byte)
    if _byte >= 0xC0:
        KIND[_byte] = KINDS.index("non_ascii")
    elif _byte >= 0x80:
        KIND[_byte] = KINDS.index("inside")
    elif "a" <= _c <= "z":
        KIND[_byte] = KINDS.index("lower")
    elif "A" <= _c <= "Z":
        KIND[_byte] = KINDS.index("upper")
    elif "0" <= _c <= "9":
        KIND[_byte] = KINDS.index("digit")
    elif _c == "\n":
        KIND[_byte] = KINDS.index("newline")
    elif _c in " \t\r\x0b\x0c":
        KIND[_byte] = KINDS.index("space")
    elif _c in ".,;:!?'\"-":
        KIND[_byte] = KINDS.index("sentence")
    elif _c == "|":
        KIND[_byte] = KINDS.index("pipe")
    elif _c in "#*$%&<>":
        KIND[_byte] = KINDS.index("symbol")
    elif _c in "()[]{}/\\@_=+~^`":
        KIND[_byte] = KINDS.index("bracket")
    elif 33 <= _byte < 127:
        KIND[_byte] = KINDS.index("other_ascii")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


class Texts:
    """Words of a slice of texts and what is counted in them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, self.n = data, offsets, len(offsets) - 1
        self.starts, self.ends, self.first = words(data, offsets)
        self.sums = hash_sums(data)
        self.hashes = span_hashes(data, self.starts, self.ends, self.sums)
        self.n_words = np.diff(self.first)
        self.owner = owners(self.n_words)
        inside = (data & 0xC0) == 0x80
        run = np.concatenate(([0], np.cumsum(~inside)))
        self.word_lengths = run[self.ends] - run[self.starts]  # in code points
        self.n_chars = run[offsets[1:]] - run[offsets[:-1]]
        self.word_chars = sums_by_text(self.word_lengths, self.first)

    def symbols(self) -> np.ndarray:
        return sums_by_text(_SYMBOL[self.data], self.offsets)

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Number of lines with a word, and how many of them equal an earlier line of their text."""
        newline = np.flatnonzero(self.data == 10)
        starts = np.sort(np.concatenate((self.offsets[:-1], newline + 1)))
        ends = np.sort(np.concatenate((newline, self.offsets[1:])))
        count = np.searchsorted(newline, self.offsets)
        lines_of = owners(np.diff(count) + 1)
        has_word = np.searchsorted(self.starts, ends) > np.searchsorted(self.starts, starts)
        starts, ends, owner = starts[has_word], ends[has_word], lines_of[has_word]
        total = np.bincount(owner, minlength=self.n)
        different, at = np.unique(in_text(span_hashes(self.data, starts, ends, self.sums), owner), return_index=True)
        return total, total - np.bincount(owner[at], minlength=self.n)

    def repeated_words(self, size: int = 3) -> np.ndarray:
        """Words that lie in a window of ``size`` words which the text has twice or more."""
        at, code = windows(self.hashes, self.first, size)
        marked = np.zeros(len(self.hashes), bool)
        if len(at):
            code = in_text(code, self.owner[at])
            order = np.argsort(code)
            code, at = code[order], at[order]
            again = np.zeros(len(at), bool)
            again[1:] = code[1:] == code[:-1]
            again[:-1] |= again[1:]
            for k in range(size):
                marked[at[again] + k] = True
        return sums_by_text(marked, self.first)

    def different_words(self) -> tuple[np.ndarray, np.ndarray]:
        """Number of different words of each text, and the count of its most frequent one."""
        values, at, count = np.unique(in_text(self.hashes, self.owner), return_index=True, return_counts=True)
        most = np.zeros(self.n, np.int64)
        np.maximum.at(most, self.owner[at], count)
        return np.bincount(self.owner[at], minlength=self.n), most

    def kinds(self) -> np.ndarray:
        """Counts of the kinds of bytes, a row for each text."""
        owner = owners(np.diff(self.offsets))
        return np.bincount(owner * len(KINDS) + KIND[self.data], minlength=self.n * len(KINDS)).reshape(self.n, -1)

    def plain_words(self) -> np.ndarray:
        """Hashes of the words with A-Z in lower case and without one closing punctuation mark."""
        lower = LOWER[self.data]
        last = KIND[lower[self.ends - 1]] if len(self.ends) else KIND[:0]
        closing = (last == KINDS.index("sentence")) & (self.ends - self.starts > 1)
        return span_hashes(lower, self.starts, self.ends - closing)


FEATURES = [
    "log_chars", "log_words", "word_length", "word_length_spread", "long_words", "short_words",
    "symbols", "repeated", "duplicate_lines", "words_per_line", "different", "most_frequent", "capitalised",
    "all_capitals", "closing", *(f"kind_{k}" for k in KINDS),
]


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``FEATURES`` for each text; a text without words has zeros where a share has no base."""
    texts = Texts(data, offsets)
    n_words = np.maximum(texts.n_words, 1)
    lengths = texts.word_lengths
    mean = texts.word_chars / n_words
    square = sums_by_text(lengths * lengths, texts.first) / n_words
    lines, copies = texts.lines()
    different, most = texts.different_words()
    kinds = texts.kinds()
    size = np.maximum(np.diff(offsets), 1)
    upper = KIND == KINDS.index("upper")
    capital = upper[data[texts.starts]] if len(lengths) else np.zeros(0, bool)
    run = np.concatenate(([0], np.cumsum(upper[data])))
    capitals = run[texts.ends] - run[texts.starts]
    last = KIND[data[texts.ends - 1]] if len(lengths) else np.zeros(0, np.uint8)

    def share(mask: np.ndarray) -> np.ndarray:
        return sums_by_text(mask, texts.first) / n_words

    return np.column_stack(
        [
            np.log1p(texts.n_chars),
            np.log1p(texts.n_words),
            mean,
            np.sqrt(np.maximum(square - mean * mean, 0)),
            share(lengths >= 7),
            share(lengths <= 3),
            texts.symbols() / np.maximum(texts.n_chars, 1),
            texts.repeated_words() / n_words,
            copies / np.maximum(lines, 1),
            texts.n_words / np.maximum(lines, 1),
            different / n_words,
            most / n_words,
            share(capital),
            share(capitals * 2 > lengths),
            share(last == KINDS.index("sentence")),
            kinds / size[:, None],
        ]
    )
