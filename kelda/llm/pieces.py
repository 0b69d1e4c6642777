"""Byte-level BPE over whole columns: texts to pieces to ids, each distinct piece encoded once.

The tokenizer first cuts a text into pieces (a word with the space before it, a run of digits,
of signs or of white space, an English contraction) and merges only within a piece. Here the
borders of all pieces of a block are found at once in numpy, pieces are told apart by a 64-bit
hash, and each worker keeps the ids of the pieces it has met, up to ``MAX_PIECES``. How a
single piece becomes ids is the caller's: see ``bpe`` and ``token_files``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np

from kelda.llm.words import BYTE_STEP, U64, mix, range_hashes

SPECIAL = "<|endoftext|>"
#: Pieces a worker remembers before it starts afresh (some 50 bytes each).
MAX_PIECES = 1_500_000
#: Code points worked on together.
BLOCK_CHARS = 1 << 19
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# White space of the tokenizer's pattern.
SPACES = "\t\n\v\f\r \x85\xa0     　" + "".join(
    map(chr, range(0x2000, 0x200B))
)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter(
        (kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)),
        np.uint8,
        0x110000,
    )
    table[[ord(c) for c in SPACES]] = SPACE
    return table


@lru_cache(maxsize=1)
def _values() -> np.ndarray:
    """What each code point stands for in a hash."""
    return mix(np.arange(0x110000, dtype=U64) + U64(0x2545F4914F6CDD1D))


def piece_starts(points: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each code point; none reaches over the places in ``cuts``."""
    n = len(points)
    kind = _classes()[points]
    cut = np.zeros(n + 1, bool)
    cut[cuts] = True
    cut[0] = cut[n] = True
    space = kind == SPACE
    before = np.empty(n, np.uint8)
    before[0], before[1:] = 255, kind[:-1]
    after_blank = np.zeros(n, bool)
    after_blank[1:] = points[:-1] == 32
    last_of_run = np.zeros(n, bool)
    last_of_run[:-1] = space[:-1] & ~space[1:]
    last_of_run &= ~cut[1:]
    # A run of white space gives its last character away; a blank joins what follows it.
    starts = np.where(space, (before != SPACE) | last_of_run, (before != kind) & ~after_blank)
    starts |= cut[:-1]
    for at in np.flatnonzero((points == 39) & starts).tolist():
        tail = points[at + 1 : at + 3].tolist()
        size = next((len(t) for t in _TAILS if tail[: len(t)] == t), 0)
        if size and not cut[at + 1 : at + 1 + size].any():
            starts[at + 1 : at + 1 + size] = False
            if at + 1 + size < n:
                starts[at + 1 + size] = True
    return starts


# What may follow an apostrophe in a contraction.
_TAILS = [[ord(c) for c in tail] for tail in ("s", "t", "re", "ve", "m", "ll", "d")]


class Slots:
    """Numbers of hashes: an open-addressing table of a fixed size in numpy."""

    def __init__(self, most: int) -> None:
        size = 1 << (2 * most - 1).bit_length()
        self.mask = U64(size - 1)
        self.keys = np.zeros(size, U64)
        self.numbers = np.zeros(size, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for hashes not met."""
        found = np.full(len(hashes), -1, np.int32)
        left = np.arange(len(hashes))
        place = hashes & self.mask
        while len(left):
            keys = self.keys[place]
            same = keys == hashes[left]
            found[left[same]] = self.numbers[place[same]]
            on = ~same & (keys != U64(0))
            left, place = left[on], (place[on] + U64(1)) & self.mask
        return found

    def add(self, hashes: np.ndarray, first: int) -> None:
        """Number different new hashes from ``first`` on."""
        numbers = np.arange(first, first + len(hashes), dtype=np.int32)
        place = hashes & self.mask
        while len(hashes):
            free = self.keys[place] == U64(0)
            self.keys[place[free]] = hashes[free]
            # Of several hashes that took one place, the last one has it.
            done = self.keys[place] == hashes
            self.numbers[place[done]] = numbers[done]
            hashes, numbers = hashes[~done], numbers[~done]
            place = (place[~done] + U64(1)) & self.mask


class PieceCoder:
    """Ids of texts, with a memory of the pieces met so far.

    ``encode`` turns a list of different pieces into their lists of ids.
    """

    def __init__(
        self, encode: Callable[[list[str]], Sequence[Sequence[int]]], most: int = MAX_PIECES
    ) -> None:
        self.encode = encode
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.slots = Slots(self.most)
        self.known = 0
        self.starts = np.zeros(1 << 16, np.int64)
        self.sizes = np.zeros(1 << 16, np.int64)
        self.ids = np.zeros(1 << 18, np.int32)
        self.used = 0

    def _remember(self, hashes: np.ndarray, pieces: list[str]) -> None:
        found = self.encode(pieces)
        first, need = self.known, self.known + len(pieces)
        while need > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(flat)] = flat
        self.sizes[first:need] = sizes
        self.starts[first:need] = self.used + np.cumsum(sizes) - sizes
        self.used += len(flat)
        self.slots.add(hashes, first)
        self.known = need

    def __call__(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's begin (one more at the end)."""
        with np.errstate(over="ignore"):
            return self._code([t or "" for t in texts])

    def _code(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        whole = "".join(texts)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        borders = np.concatenate([[0], np.cumsum(lengths)])
        if not whole:
            return np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        specials = _places(texts, borders) if SPECIAL in whole else []
        cuts = [borders]
        if specials:
            cuts.append(np.array(specials))
            cuts.append(np.array(specials) + len(SPECIAL))
        starts = piece_starts(points, np.concatenate(cuts))
        for at in specials:
            starts[at + 1 : at + len(SPECIAL)] = False
        begin = np.flatnonzero(starts)
        end = np.append(begin[1:], len(points))
        hashes = range_hashes(_values()[points], begin, end, BYTE_STEP)
        np.maximum(hashes, U64(1), out=hashes)
        place = self.slots.find(hashes)
        fresh = np.flatnonzero(place < 0)
        if len(fresh):
            new, first = np.unique(hashes[fresh], return_index=True)
            if self.known + len(new) > self.most:
                self._forget()
                new, first = np.unique(hashes, return_index=True)
                fresh = np.arange(len(hashes))
                if len(new) > self.most:
                    self.slots = Slots(len(new))
            at = fresh[first]
            pieces = [whole[a:b] for a, b in zip(begin[at].tolist(), end[at].tolist())]
            self._remember(new, pieces)
            place[fresh] = self.slots.find(hashes[fresh])
        sizes = self.sizes[place]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        shift = self.starts[place] - upto[:-1]
        ids = self.ids[np.arange(upto[-1]) + np.repeat(shift, sizes)]
        return ids, upto[np.searchsorted(begin, borders)]


def _places(texts: Sequence[str], borders: np.ndarray) -> list[int]:
    """Where the special token's string stands in the texts joined."""
    found = []
    for text, base in zip(texts, borders.tolist()):
        at = text.find(SPECIAL)
        while at >= 0:
            found.append(base + at)
            at = text.find(SPECIAL, at + len(SPECIAL))
    return found


def char_blocks(texts: Sequence[str | None], size: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``size`` characters each, never less than a row."""
    start, total = 0, 0
    for i, text in enumerate(texts):
        length = len(text or "")
        if i > start and total + length > size:
            yield start, i
            start, total = i, 0
        total += length
    if start < len(texts):
        yield start, len(texts)
