"""Counting quotient filters over n-grams of word ids: exact, compact counters in numpy.

An n-gram of ids of ``b`` bits is packed as a head, its first two ids (2b bits), and a tail, the
others. The head is permuted: the tail's hash is mixed in by exclusive or, then come steps that
can each be undone, so the n-gram can be read back from the permuted head and the tail. The top
bits of the permuted head say in which segment of the filter an n-gram is, the next are its
quotient; what is left of the head and the whole tail are its remainder. Nothing is cut off, so
two n-grams never share a counter.

A segment is stored as a filter of its own: a bit for each quotient that occurs, and slots with
the remainders in order of quotient and remainder, where one bit marks the last slot of a
quotient's run. A counter above one takes more slots behind its remainder, marked by a second
bit, which hold the count less one in digits of a slot's width.

Filters are built from sorted entries and read back as such. Those of many segments are built
together, and those of many shards read together, so that a small filter costs no numpy calls of
its own. Arrays of n-grams are (m, n) of uint32 with ids from 1.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

from kelda.llm.words import U64, mix

#: Odd multipliers of the permutation.
STEPS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_HEAD = struct.Struct("<BBBBQ")


def id_bits(ids: int) -> int:
    """Bits of an id, in whole bytes, for ids up to ``ids``."""
    for bits in (16, 24, 32):
        if ids < 1 << bits:
            return bits
    raise ValueError(f"{ids} ids do not fit in 32 bits")


def _mask(bits: int) -> np.uint64:
    return U64((1 << bits) - 1)


def _tail_hash(tail: np.ndarray) -> np.ndarray:
    found = np.zeros(len(tail), U64)
    for k in range(tail.shape[1]):
        found = mix(found + tail[:, k].astype(U64) + U64(k + 1) * U64(STEPS[0]))
    return found


def permute(grams: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Permuted heads and tails of n-grams."""
    tail = grams[:, 2:]
    mask, half = _mask(2 * bits), U64(bits)
    with np.errstate(over="ignore"):
        x = grams[:, 0].astype(U64) << half | grams[:, 1].astype(U64)
        if tail.shape[1]:
            x ^= _tail_hash(tail) & mask
        for step in STEPS:
            x = x * U64(step) & mask
            x ^= x >> half
    return x, tail


def restore(head: np.ndarray, tail: np.ndarray, bits: int) -> np.ndarray:
    """The n-grams that ``permute`` was given."""
    mask, half = _mask(2 * bits), U64(bits)
    x = head.copy()
    with np.errstate(over="ignore"):
        for step in reversed(STEPS):
            x ^= x >> half  # undoes itself: the upper half is as it was
            x = x * U64(pow(step, -1, 1 << 64)) & mask
        if tail.shape[1]:
            x ^= _tail_hash(tail) & mask
    first, second = x >> half, x & _mask(bits)
    return np.column_stack([first.astype(np.uint32), second.astype(np.uint32), tail])


def _unlike(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether rows differ."""
    found = np.zeros(len(left), bool)
    for k in range(left.shape[1]):
        found |= left[:, k] != right[:, k]
    return found


def sorted_order(head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Order by head, then tail."""
    order = np.argsort(head)
    if not tail.shape[1] or len(head) < 2:
        return order
    # Heads that are alike with unlike tails are few: only they are sorted by tail.
    h, t = head[order], tail[order]
    begins = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    sizes = np.diff(np.append(begins, len(h)))
    unlike = _unlike(t, np.repeat(t[begins], sizes, axis=0))
    mixed = np.repeat(np.logical_or.reduceat(unlike, begins), sizes)
    at = np.flatnonzero(mixed)
    if len(at):
        columns = [t[at, k] for k in reversed(range(t.shape[1]))]
        order[at] = order[at][np.lexsort([*columns, h[at]])]
    return order


@dataclass(frozen=True)
class Entries:
    """Different n-grams in order of permuted head and tail, with their counts."""

    head: np.ndarray
    tail: np.ndarray
    counts: np.ndarray

    def __len__(self) -> int:
        return len(self.head)

    def grams(self, bits: int) -> np.ndarray:
        return restore(self.head, self.tail, bits)

    def part(self, chosen: slice | np.ndarray) -> Entries:
        return Entries(self.head[chosen], self.tail[chosen], self.counts[chosen])


def gather(head: np.ndarray, tail: np.ndarray, counts: np.ndarray | None = None) -> tuple[Entries, np.ndarray]:
    """Entries of n-grams in any order, counts of equal ones added up; and each one's entry."""
    order = sorted_order(head, tail)
    h, t = head[order], tail[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | _unlike(t[1:], t[:-1])
    begins = np.flatnonzero(new)
    if counts is None:
        sums = np.diff(np.append(begins, len(h)))
    else:
        sums = np.add.reduceat(counts[order], begins) if len(begins) else np.empty(0, np.int64)
    place = np.empty(len(h), np.int64)
    place[order] = np.cumsum(new) - 1
    return Entries(h[begins], t[begins], sums.astype(np.int64)), place


def merge(parts: Sequence[Entries]) -> tuple[Entries, np.ndarray]:
    """The entries of several shards as one; and for each shard's entries, one after the other,
    their place in it."""
    return gather(*(np.concatenate([getattr(p, name) for p in parts]) for name in ("head", "tail", "counts")))


def segments_of(entries: Entries, bits: int, segment_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Segments that have entries, and where each begins (one more border at the end)."""
    segment = entries.head >> U64(2 * bits - segment_bits) if segment_bits else np.zeros(len(entries), U64)
    known, begins = np.unique(segment, return_index=True)
    return known.astype(np.int64), np.append(begins, len(entries))


def borders(sizes: np.ndarray) -> np.ndarray:
    """Where parts of these sizes begin that lie one after the other, and where the last one ends."""
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    cuts = borders(sizes)
    return np.arange(cuts[-1]) + np.repeat(starts - cuts[:-1], sizes)


def _filled(flags: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """How many flags each part has."""
    upto = borders(flags)
    return upto[cuts[1:]] - upto[cuts[:-1]]


def pack_parts(flags: np.ndarray, sizes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """A bit for each flag, whole bytes for each part; and the parts' borders in these bytes."""
    cuts = borders(-(-sizes // 8))
    padded = np.zeros(8 * cuts[-1], bool)
    padded[ranges(8 * cuts[:-1], sizes)] = flags
    return np.packbits(padded, bitorder="little").tobytes(), cuts


def unpack_parts(packed: bytes, sizes: np.ndarray) -> np.ndarray:
    """The flags that ``pack_parts`` was given."""
    bits = np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little").astype(bool)
    return bits[ranges(8 * borders(-(-sizes // 8))[:-1], sizes)]


def _quotient_bits(sizes: np.ndarray, rest: int) -> np.ndarray:
    """As many bits as entries ask for, so that whole bytes of the head are left over."""
    wanted = np.maximum(1, np.frexp(sizes.astype(np.float64))[1])
    low = rest % 8
    return np.minimum(rest, np.where(wanted >= low, wanted - (wanted - low) % 8, low))


def encode_parts(entries: Entries, sizes: np.ndarray, bits: int, segment_bits: int) -> list[bytes]:
    """The filters of segments that have ``sizes`` entries, one segment after the other."""
    quotient_bits = _quotient_bits(sizes, 2 * bits - segment_bits)
    found = [b""] * len(sizes)
    for own_bits in np.unique(quotient_bits).tolist():
        own = quotient_bits == own_bits
        part = entries if own.all() else entries.part(np.repeat(own, sizes))
        for k, raw in zip(np.flatnonzero(own).tolist(), _encoded(part, sizes[own], own_bits, bits, segment_bits)):
            found[k] = raw
    return found


def _encoded(entries: Entries, sizes: np.ndarray, quotient_bits: int, bits: int, segment_bits: int) -> list[bytes]:
    rest = 2 * bits - segment_bits
    m, tails = len(entries), entries.tail.shape[1]
    head_bytes, id_bytes = (rest - quotient_bits) // 8, bits // 8
    width = max(1, head_bytes + tails * id_bytes)
    cuts = borders(sizes)
    segment = np.repeat(np.arange(len(sizes)), sizes)
    local = entries.head & _mask(rest) if rest < 64 else entries.head
    quotient = (local >> U64(8 * head_bytes)).astype(np.int64) if head_bytes < 8 else np.zeros(m, np.int64)
    more = entries.counts - 1
    digits = np.zeros(m, np.int64)
    left = more.copy()
    while left.any():
        digits += left > 0
        left = left >> (8 * width) if width < 8 else np.zeros_like(left)
    upto = borders(1 + digits)
    place, slot_cuts = upto[:-1], upto[cuts]
    slots = np.zeros((int(upto[-1]), width), np.uint8)
    slots[place, :head_bytes] = local.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :head_bytes]
    for j in range(tails):
        at = head_bytes + j * id_bytes
        own_tail = np.ascontiguousarray(entries.tail[:, j]).astype("<u4").view(np.uint8).reshape(-1, 4)
        slots[place, at : at + id_bytes] = own_tail[:, :id_bytes]
    counter = np.zeros(len(slots), bool)
    for d in range(int(digits.max()) if m else 0):
        own = np.flatnonzero(digits > d)
        at = place[own] + 1 + d
        counter[at] = True
        for k in range(min(width, 8 - d * width)):
            slots[at, k] = more[own] >> (8 * (d * width + k)) & 0xFF
    # A segment's quotients have whole bytes, too.
    row_bits = max(8, 1 << quotient_bits)
    occupied = np.zeros(len(sizes) * row_bits, bool)
    occupied[segment * row_bits + quotient] = True
    last = np.ones(m, bool)
    last[:-1] = (quotient[1:] != quotient[:-1]) | (segment[1:] != segment[:-1])
    run_end = np.zeros(len(slots), bool)
    run_end[upto[1:][last] - 1] = True
    in_slots = np.diff(slot_cuts)
    runs, bytes_cuts = pack_parts(run_end, in_slots)
    counters, _ = pack_parts(counter, in_slots)
    quotients, remainders, step = np.packbits(occupied, bitorder="little").tobytes(), slots.tobytes(), row_bits // 8
    heads = [_HEAD.pack(bits, tails, segment_bits, quotient_bits, n) for n in in_slots.tolist()]
    b, s = bytes_cuts.tolist(), (slot_cuts * width).tolist()
    return [
        b"".join(
            [
                heads[k],
                quotients[k * step : (k + 1) * step],
                runs[b[k] : b[k + 1]],
                counters[b[k] : b[k + 1]],
                remainders[s[k] : s[k + 1]],
            ]
        )
        for k in range(len(sizes))
    ]


def encode(entries: Entries, bits: int, segment_bits: int) -> bytes:
    """The filter of one segment's entries."""
    return encode_parts(entries, np.array([len(entries)]), bits, segment_bits)[0]


def decode_parts(raws: Sequence[bytes], segment: int) -> tuple[Entries, np.ndarray]:
    """The entries of filters of one segment, one filter's after the other's, and how many each has."""
    heads = [_HEAD.unpack_from(raw) for raw in raws]
    quotient_bits = np.array([h[3] for h in heads])
    kinds = np.unique(quotient_bits).tolist()
    if len(kinds) == 1:
        return _decoded(raws, [h[4] for h in heads], heads[0][:3], kinds[0], segment)
    sizes, which, found = np.zeros(len(raws), np.int64), [], []
    for own_bits in kinds:
        own = np.flatnonzero(quotient_bits == own_bits)
        chosen = own.tolist()
        part, sizes[own] = _decoded([raws[k] for k in chosen], [heads[k][4] for k in chosen], heads[0][:3], own_bits, segment)
        which.append(np.repeat(own, sizes[own]))
        found.append(part)
    order = np.argsort(np.concatenate(which), kind="stable")
    whole = [np.concatenate([getattr(p, name) for p in found]) for name in ("head", "tail", "counts")]
    return Entries(*whole).part(order), sizes


def _decoded(
    raws: Sequence[bytes], in_slots: list[int], shape: tuple[int, int, int], quotient_bits: int, segment: int
) -> tuple[Entries, np.ndarray]:
    bits, tails, segment_bits = shape
    rest = 2 * bits - segment_bits
    head_bytes, id_bytes = (rest - quotient_bits) // 8, bits // 8
    width = max(1, head_bytes + tails * id_bytes)
    sizes, slot_cuts = np.array(in_slots), borders(np.array(in_slots))
    first = _HEAD.size + max(1, (1 << quotient_bits) // 8)
    quotients, runs, counters, remainders = [], [], [], []
    for raw, m in zip(raws, in_slots):
        a, b = first + -(-m // 8), first + 2 * -(-m // 8)
        quotients.append(raw[_HEAD.size : first])
        runs.append(raw[first:a])
        counters.append(raw[a:b])
        remainders.append(raw[b : b + m * width])
    occupied = np.unpackbits(np.frombuffer(b"".join(quotients), np.uint8), bitorder="little")
    quotient = np.flatnonzero(occupied) % max(8, 1 << quotient_bits)
    run_end, counter = unpack_parts(b"".join(runs), sizes), unpack_parts(b"".join(counters), sizes)
    slots = np.frombuffer(b"".join(remainders), np.uint8).reshape(-1, width)
    place = np.flatnonzero(~counter)
    # Runs of all filters in turn, as their quotients.
    run = (np.cumsum(run_end) - run_end)[place]
    head = quotient[run].astype(U64)
    head = head << U64(8 * head_bytes) if head_bytes < 8 else np.zeros(len(place), U64)
    low = np.zeros((len(place), 8), np.uint8)
    low[:, :head_bytes] = slots[place, :head_bytes]
    head |= low.view("<u8").ravel()
    if segment_bits:
        head |= U64(segment) << U64(rest)
    tail = np.zeros((len(place), tails), np.uint32)
    for j in range(tails):
        at, low = head_bytes + j * id_bytes, np.zeros((len(place), 4), np.uint8)
        low[:, :id_bytes] = slots[place, at : at + id_bytes]
        tail[:, j] = low.view("<u4").ravel()
    digits = np.diff(np.append(place, len(slots))) - 1
    counts = np.ones(len(place), np.int64)
    for d in range(int(digits.max()) if len(place) else 0):
        own = np.flatnonzero(digits > d)
        for k in range(min(width, 8 - d * width)):
            counts[own] += slots[place[own] + 1 + d, k].astype(np.int64) << (8 * (d * width + k))
    return Entries(head, tail, counts), _filled(~counter, slot_cuts)


def decode(raw: bytes, segment: int) -> Entries:
    """The entries of a segment's filter."""
    return decode_parts([raw], segment)[0]
