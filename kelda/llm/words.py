"""Words of many texts at once: byte classes, word borders and hashes in numpy.

Texts stay in their Arrow buffer; words are runs of bytes of a class. Every word gets a 64-bit
hash from one running sum over the buffer, so no Python string is made for it. Two different
words share a hash about once in 2**64 pairs; operators that must be exact compare the bytes of
what the hashes found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
# Odd, so that they have inverses modulo 2**64.
BYTE_STEP, WORD_STEP = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
# Bytes of text worked on together: intermediate arrays take some 60 times as much.
BLOCK_BYTES = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all of them."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


@lru_cache(maxsize=4)
def _powers(step: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """step**i and its inverse modulo 2**64, for i below size."""
    both = []
    for base in (step, pow(step, -1, 1 << 64)):
        powers = np.full(size, base, U64)
        powers[0] = 1
        both.append(np.multiply.accumulate(powers))
    return both[0], both[1]


def powers(step: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    found = _powers(step, max(BLOCK_BYTES, 1 << max(size, 1).bit_length()))
    return found[0][:size], found[1][:size]


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int) -> np.ndarray:
    """A hash of values[start:end] for each pair, by the difference of running sums."""
    up, down = powers(step, len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


@dataclass(frozen=True)
class ByteClass:
    """Which bytes make up words, and the number each stands for in a hash."""

    member: np.ndarray
    value: np.ndarray


def byte_class(member: np.ndarray, fold_case: bool) -> ByteClass:
    byte = np.arange(256)
    if fold_case:
        byte = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
    return ByteClass(member, mix(byte.astype(U64) + U64(0x5851F42D4C957F2D)))


_BYTE = np.arange(256)
_SPACE = (_BYTE == 0x20) | ((_BYTE >= 9) & (_BYTE <= 13))
# [^\x20\x09-\x0D]+
SPACED = byte_class(~_SPACE, fold_case=False)
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
PLAIN = byte_class(
    (_BYTE >= 0x80)
    | ((_BYTE >= 48) & (_BYTE <= 57))
    | ((_BYTE >= 65) & (_BYTE <= 90))
    | ((_BYTE >= 97) & (_BYTE <= 122)),
    fold_case=True,
)


@dataclass(frozen=True)
class Texts:
    """Some texts one after the other: text i is data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def sums(self, per_byte: np.ndarray) -> np.ndarray:
        """Sum of a number per byte over each text."""
        total = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(per_byte, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def borders(self) -> tuple[np.ndarray, np.ndarray]:
        """Whether a byte is its text's first, and its last."""
        first = np.zeros(len(self.data) + 1, bool)
        first[self.offsets] = True
        return first[:-1], first[1:]


def texts_of(strings: pa.Array) -> Texts:
    """The texts of a string column; null is an empty text."""
    array = strings.fill_null("") if strings.null_count else strings
    if not pa.types.is_large_string(array.type):
        array = array.cast(pa.large_string())
    _, offsets, data = array.buffers()
    places = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    first, last = (int(places[0]), int(places[-1])) if len(places) else (0, 0)
    raw = np.frombuffer(data, np.uint8)[first:last] if data is not None else np.empty(0, np.uint8)
    return Texts(raw, places - first)


@dataclass(frozen=True)
class Words:
    """Borders and hashes of all words; word j of text i is at offsets[i] + j."""

    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    hashes: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def text_numbers(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts())


def words_of(texts: Texts, kind: ByteClass) -> Words:
    inside = kind.member[texts.data]
    first, last = texts.borders()
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(inside), bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (first | ~before))
    ends = np.flatnonzero(inside & (last | ~after)) + 1
    values = np.where(inside, kind.value[texts.data], U64(0))
    return Words(
        starts,
        ends,
        np.searchsorted(starts, texts.offsets),
        range_hashes(values, starts, ends, BYTE_STEP),
    )


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of ``size`` words that lies within one text."""
    numbers = words.text_numbers()
    n = len(numbers) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, U64)
    at = np.flatnonzero(numbers[:n] == numbers[size - 1 :])
    return at, range_hashes(words.hashes, at, at + size, WORD_STEP)


def blocks(batch: pa.RecordBatch, column: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each, never less than a row."""
    lengths = np.diff(texts_of(batch.column(column)).offsets)
    if not len(lengths):
        return
    upto = np.cumsum(lengths)
    start = 0
    while start < len(lengths):
        base = upto[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(upto, base + size, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def block_pass(make, column: str, size: int = BLOCK_BYTES):
    """A function for mapInArrow that turns each block of texts into one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for block in blocks(batch, column, size):
                    yield make(block)

    return run
