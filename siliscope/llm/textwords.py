"""Words and shingles of many texts at once, as 64-bit hashes in numpy arrays.

Used inside Arrow batches. A word's hash is a polynomial in its bytes, taken from running sums; it is mixed afterwards.
Memory follows the piece of text in hand (half a MB), not the batch: long texts are cut between words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)
STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on each other."""
    x = x ^ (x >> _S33)
    x = x * _MIX1
    x = x ^ (x >> _S33)
    x = x * _MIX2
    return x ^ (x >> _S33)


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins; NULL is empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text, at least one row each."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = text_arrays(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


class Words:
    """How bytes make words: which belong to a word, and A-Z as a-z."""

    def __init__(self, inside: np.ndarray):
        self.inside = inside
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[ord("A") : ord("Z") + 1] += 32
        self._powers = np.ones(1, np.uint64)
        self._inverse = np.ones(1, np.uint64)

    def _tables(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._powers) < n:
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            self._powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, BASE)]))
            self._inverse = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, inverse)]))
        return self._powers, self._inverse

    def hashes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word in order, and the place of each text's first word in that list (one more at the end)."""
        is_word = self.inside[data]
        first = is_word.copy()
        first[1:] &= ~is_word[:-1]
        heads = offsets[:-1][offsets[:-1] < len(data)]
        first[heads] = is_word[heads]
        last = is_word.copy()
        last[:-1] &= ~is_word[1:]
        tails = offsets[1:][offsets[1:] > 0] - 1
        last[tails] = is_word[tails]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        parts, done = [], 0
        while done < len(starts):  # pieces that end with a word
            base = starts[done]
            stop = max(int(np.searchsorted(ends, base + PIECE, "right")), done + 1)
            piece = self.lower[data[base : ends[stop - 1]]].astype(np.uint64)
            powers, inverse = self._tables(len(piece))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((piece + np.uint64(1)) * powers[: len(piece)])])
            a, b = starts[done:stop] - base, ends[done:stop] - base
            parts.append(mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64) * STEP))
            done = stop
        found = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        return found, np.searchsorted(starts, offsets)


def _inside(bytes_of_words) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(bytes_of_words)] = True
    return table


def blank_separated() -> Words:
    """Words are what stands between ASCII blanks."""
    return Words(_inside(set(range(256)) - {0x20, *range(0x09, 0x0E)}))


def letters_and_digits() -> Words:
    """Words are runs of ASCII letters and digits and of all bytes beyond ASCII."""
    return Words(_inside([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]))


def shingles(words: np.ndarray, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words of a text and the text's number; a text with fewer words is one shingle as a whole."""
    counts = np.diff(firsts)
    texts = np.repeat(np.arange(len(counts)), counts)
    n = len(words) - size + 1
    full = np.zeros(0, np.uint64)
    full_texts = np.zeros(0, np.int64)
    if n > 0:
        whole = texts[:n] == texts[size - 1 :]
        at = np.flatnonzero(whole)
        acc = words[at]
        for step in range(1, size):
            acc = mix(acc * STEP + words[at + step])
        full, full_texts = acc, texts[at]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if not len(short):
        return full, full_texts
    acc = words[firsts[short]]
    for step in range(1, size - 1):
        more = counts[short] > step
        acc[more] = mix(acc[more] * STEP + words[firsts[short[more]] + step])
    acc = mix(acc ^ mix(counts[short].astype(np.uint64) + STEP))
    everything, owners = np.concatenate([full, acc]), np.concatenate([full_texts, short])
    order = np.argsort(owners, kind="stable")
    return everything[order], owners[order]
