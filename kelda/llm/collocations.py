"""Phrase collocation mining with counting quotient filters (operator 11).

Texts become blocks of one language: a stream of word numbers and the block's own list of words.
A block's words go in arrays to segments of their hash, where they are counted; those with ``least``
occurrences or more get an id (one for each language and word), and the block is told its words' ids. Then n-grams of two words are counted, of three, and so on. A phrase that is
frequent has only frequent parts, so a block's stream is first cut down to runs of words in
which every shorter phrase is frequent. Nothing that could reach ``least`` is left out, and the
counts are exact.

Each round, a block counts its own n-grams and hands them on as quotient filters, one for each
segment of the filter's range (see ``quotient_filter``); small streams are joined first, so that
filters do not become many and tiny. A segment's filters of all blocks are merged, and every block
is told which of its entries are frequent: a bit for each, in the filter's order. No set of phrases is broadcast or sent to the driver. A phrase that is
everywhere is one entry of each block; where there are more than ``FAN`` blocks their filters
are merged in lots first, and the lots' in lots again, so no task gets more than ``FAN`` filters.

Scores, the removal of contained phrases and the first ``top`` of each language are joins and
aggregates over the frequent phrases. Arithmetic is in decimals of 38 digits. Equal texts and
repeated rows count each. A null text has no words, a null language is ``und``. A text is held
whole. Columns other than text and language are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kelda.llm.quotient_filter import Entries, borders, decode, decode_parts, encode, encode_parts, gather, id_bits
from kelda.llm.quotient_filter import pack_parts, permute, ranges, segments_of, unpack_parts
from kelda.llm.tables import LONG_ROWS, stored
from kelda.llm.words import blocks, texts_of

WORDS, LEAST, TOP, SCALE = 5, 100, 2000, 1000
#: Bytes of one block's words, four for each at least (a longer text is a block alone), and bytes of text
#: that are cut into words together.
BLOCK_BYTES, CUT_BYTES = 4 << 20, 1 << 19
#: n-grams of a segment at most on average, least segments, and filters that meet in one task.
SEGMENT_GRAMS, LEAST_SEGMENT_BITS, FAN = 1 << 19, 8, 4096
#: n-grams that streams are joined to on average where they have less than a quarter of it, and least streams then.
UNIT_GRAMS, LEAST_UNITS = 1 << 19, 16
#: Different words of blocks that a segment has on average, and least segments of words.
SEGMENT_WORDS, LEAST_WORD_SEGMENTS = 1 << 22, 256
#: Shares of a language that are ranked apart before they meet.
SALTS = 64
UNKNOWN = "und"

_BYTE = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
_BREAK = np.isin(_BYTE, np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8))
_WORD = ~(_BREAK | np.isin(_BYTE, np.frombuffer(b" \t", np.uint8)))


def cut_words(strings: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and whether a word begins a piece."""
    texts = texts_of(strings)
    inside = _WORD[texts.data]
    first, last = texts.borders()
    before = np.concatenate([[False], inside[:-1]]) if len(inside) else inside
    after = np.concatenate([inside[1:], [False]]) if len(inside) else inside
    starts = np.flatnonzero(inside & (first | ~before))
    ends = np.flatnonzero(inside & (last | ~after)) + 1
    # The next word behind a break; the border of a text is one, too.
    begins = np.zeros(len(starts) + 1, bool)
    begins[np.searchsorted(starts, np.flatnonzero(_BREAK[texts.data] | first))] = True
    begins = begins[:-1]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    data = _LOWER[texts.data[inside]]
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))
    return words, begins


def with_breaks(numbers: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Numbers from 1 with a 0 before each that begins a piece."""
    found = np.zeros(len(numbers) + int(begins.sum()), np.uint32)
    found[np.arange(len(numbers)) + np.cumsum(begins)] = numbers
    return found


class _Held:
    """Words of one language's texts until they make a block."""

    def __init__(self) -> None:
        self.words: list[pa.Array] = []
        self.begins: list[np.ndarray] = []
        self.bytes = 0

    def add(self, strings: pa.Array) -> None:
        words, begins = cut_words(strings)
        self.words.append(words.dictionary_encode())
        self.begins.append(begins)
        # Of a text in words of one letter, their numbers are more than their letters.
        self.bytes += max(words.buffers()[2].size, 4 * len(words))


BLOCKS = "block bigint, lang string, stream binary, words array<string>, counts array<bigint>"


def _block_row(number: int, lang: str, held: _Held) -> pa.RecordBatch:
    joined = pa.chunked_array(held.words).unify_dictionaries().combine_chunks()
    joined = joined if isinstance(joined, pa.DictionaryArray) else joined.chunk(0)
    place = joined.indices.to_numpy(zero_copy_only=False)
    words = joined.dictionary.cast(pa.string())
    stream = with_breaks(place + 1, np.concatenate(held.begins))
    counts = np.bincount(place, minlength=len(words))
    whole = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            pa.array([lang]),
            pa.array([stream.astype("<u4").tobytes()], pa.binary()),
            whole(words),
            whole(pa.array(counts, pa.int64())),
        ],
        names=["block", "lang", "stream", "words", "counts"],
    )


def word_blocks(texts: DataFrame) -> DataFrame:
    """Blocks of the words of (lang, text): stream, different words and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Numbers are those of the attempt whose rows are stored.
        number = TaskContext.get().partitionId() << 33
        held: dict[str, _Held] = {}
        for batch in batches:
            for piece in blocks(batch, "text", CUT_BYTES):
                langs = piece.column("lang").dictionary_encode()
                which = langs.indices.to_numpy(zero_copy_only=False)
                for k, lang in enumerate(langs.dictionary.to_pylist()):
                    own = piece.column("text").take(pa.array(np.flatnonzero(which == k)))
                    held.setdefault(lang, _Held()).add(own)
                # Full ones, and the largest while together they are much.
                total = sum(h.bytes for h in held.values())
                for lang in sorted(held, key=lambda x: held[x].bytes, reverse=True):
                    if held[lang].bytes < BLOCK_BYTES and total < 2 * BLOCK_BYTES:
                        break
                    own = held.pop(lang)
                    total -= own.bytes
                    yield _block_row(number, lang, own)
                    number += 1
        for lang, own in held.items():
            if sum(map(len, own.words)):
                yield _block_row(number, lang, own)
                number += 1

    return texts.where(F.col("text").isNotNull()).select("lang", "text").mapInArrow(run, BLOCKS)


WORD_ANSWERS = "block bigint, places array<int>, ids array<bigint>, langs array<string>, words array<string>, ns array<bigint>"


def _dealt(segments: int):
    """Of each block, its words by segment of their hash: (block, lang, segment, places, words, counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c) for c in ("block", "lang", "words", "counts")))
            for block, lang, words, counts in rows:
                segment = hash_array(words.values.to_numpy(zero_copy_only=False), categorize=False) % np.uint64(segments)
                order = np.argsort(segment, kind="stable")
                known, first = np.unique(segment[order], return_index=True)
                offsets = pa.array(np.append(first, len(order)), pa.int32())
                listed = lambda values: pa.ListArray.from_arrays(offsets, values)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block.as_py()] * len(known), pa.int64()),
                        pa.array([lang.as_py()] * len(known), pa.string()),
                        pa.array(known.astype(np.int32)),
                        listed(pa.array(order.astype(np.int32))),
                        listed(words.values.take(pa.array(order))),
                        listed(counts.values.take(pa.array(order))),
                    ],
                    names=["block", "lang", "segment", "places", "words", "counts"],
                )

    return run


def _known_words(segments: int, least: int):
    """Of a segment's words: those with ``least`` occurrences or more in a language, with ids (block null), and for each
    block the places and ids of such words of it."""

    def run(table: pa.Table) -> pa.Table:
        flat = lambda c: table.column(c).combine_chunks().flatten()
        sizes = pc.list_value_length(table.column("places")).to_numpy()
        lang, word = table.column("lang").combine_chunks().dictionary_encode(), flat("words").dictionary_encode()
        of_lang = np.repeat(lang.indices.to_numpy(), sizes).astype(np.int64)
        both = of_lang * len(word.dictionary) + word.indices.to_numpy()
        different, place = np.unique(both, return_inverse=True)
        n = np.zeros(len(different), np.int64)
        np.add.at(n, place, flat("counts").to_numpy())
        frequent = n >= least
        # Segments take turns, so ids are nearly without gaps.
        ids = np.where(frequent, (np.cumsum(frequent) - 1) * segments + table.column("segment")[0].as_py() + 1, 0)
        kept = frequent[place]
        upto = np.append(0, np.cumsum(kept))[np.append(0, np.cumsum(sizes))]
        has = np.flatnonzero(np.diff(upto) > 0)
        cuts = pa.array(np.append(upto[has], upto[-1]), pa.int32())
        shown = different[frequent]
        whole = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        mine = [
            pa.array([None], pa.int64()),
            pa.array([None], pa.list_(pa.int32())),
            whole(pa.array(ids[frequent])),
            whole(lang.dictionary.take(pa.array(shown // len(word.dictionary)))),
            whole(word.dictionary.take(pa.array(shown % len(word.dictionary)))),
            whole(pa.array(n[frequent])),
        ]
        none = lambda kind: pa.nulls(len(has), pa.list_(kind))
        told = [
            table.column("block").combine_chunks().take(pa.array(has)),
            pa.ListArray.from_arrays(cuts, pa.array(flat("places").to_numpy()[kept], pa.int32())),
            pa.ListArray.from_arrays(cuts, pa.array(ids[place][kept], pa.int64())),
            none(pa.string()),
            none(pa.string()),
            none(pa.int64()),
        ]
        names = ["block", "places", "ids", "langs", "words", "ns"]
        return pa.concat_tables(
            [pa.Table.from_arrays([c.cast(k) for c, k in zip(cs, _ANSWER_KINDS)], names=names) for cs in (mine, told)]
        )

    return run


_ANSWER_KINDS = [
    pa.int64(),
    pa.list_(pa.int32()),
    pa.list_(pa.int64()),
    pa.list_(pa.string()),
    pa.list_(pa.string()),
    pa.list_(pa.int64()),
]


def known_words(made: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, word, n, id) of the words with ``least`` occurrences or more, and (block, places, ids) of each
    block's by segment: words move in arrays, a row for each block and segment."""
    pairs = made.agg(F.sum(F.size("words")).alias("n")).first()["n"] or 0
    segments = max(LEAST_WORD_SEGMENTS, -(-pairs // SEGMENT_WORDS))
    dealt = made.select("block", "lang", "words", "counts").mapInArrow(
        _dealt(segments),
        "block bigint, lang string, segment int, places array<int>, words array<string>, counts array<bigint>",
    )
    answers = stored(dealt.groupBy("segment").applyInArrow(_known_words(segments, least), WORD_ANSWERS), "word-answers")
    rows = answers.where(F.col("block").isNull()).select(F.explode(F.arrays_zip("langs", "words", "ns", "ids")).alias("w"))
    known = rows.select(
        F.col("w.langs").alias("lang"), F.col("w.words").alias("word"), F.col("w.ns").alias("n"), F.col("w.ids").alias("id")
    )
    return stored(known, "vocabulary"), answers.where(F.col("block").isNotNull()).select("block", "places", "ids")


def _windows(stream: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of runs of n ids, and the n-grams there."""
    m = len(stream) - n + 1
    if m <= 0:
        return np.empty(0, np.int64), np.empty((0, n), np.uint32)
    whole = np.ones(m, bool)
    for k in range(n):
        whole &= stream[k : k + m] != 0
    at = np.flatnonzero(whole)
    return at, np.column_stack([stream[at + k] for k in range(n)])


def _runs(stream: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The stream cut down to words of n-grams at ``at`` that have another one right beside them;
    runs of such are apart by a 0."""
    if not len(at):
        return np.empty(0, np.uint32)
    new = np.concatenate([[True], np.diff(at) > 1])
    begins = at[new]
    ends = at[np.append(new[1:], True)] + n
    long = ends - begins > n
    begins, ends = begins[long], ends[long]
    if not len(begins):
        return np.empty(0, np.uint32)
    sizes = ends - begins + 1
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    found = stream[np.minimum(np.repeat(begins, sizes) + within - 1, len(stream) - 1)]
    found[within == 0] = 0
    return found


def _stream_row(block: int, stream: np.ndarray, n: int) -> pa.Table:
    """A block's stream for phrases of n words; none if it has no such."""
    grams = len(_windows(stream, n)[0])
    kept = [(block, stream.astype("<u4").tobytes(), grams)] if grams else []
    columns = [pa.array([r[k] for r in kept], kind) for k, kind in enumerate((pa.int64(), pa.binary(), pa.int64()))]
    return pa.Table.from_arrays(columns, names=["block", "stream", "grams"])


STREAMS = "block bigint, stream binary, grams bigint"


def _ids_of_words(words: pa.Table, own: pa.Table) -> pa.Table:
    """A block's stream by ids, words without one being breaks."""
    if not len(own):
        return _stream_row(0, np.empty(0, np.uint32), 2)
    stream = np.frombuffer(own.column("stream")[0].as_py(), "<u4")
    ids = np.zeros(int(stream.max()) + 1, np.uint32)
    for places, own_ids in zip(words.column("places"), words.column("ids")):
        ids[places.values.to_numpy() + 1] = own_ids.values.to_numpy()
    found = ids[stream]
    return _stream_row(own.column("block")[0].as_py(), _runs(found, np.flatnonzero(found), 1), 2)


def _one_stream(table: pa.Table) -> pa.Table:
    """Several streams as one; each begins with a break."""
    raw = b"".join(table.column("stream").to_pylist())
    columns = [table.column("block").slice(0, 1), pa.array([raw], pa.binary())]
    columns.append(pa.array([pc.sum(table.column("grams")).as_py()], pa.int64()))
    return pa.Table.from_arrays(columns, names=["block", "stream", "grams"])


def fewer_streams(streams: DataFrame, units: int, grams: int, n: int) -> tuple[DataFrame, int]:
    """Streams and how many they are at most, small ones joined: each stream has a filter in nearly every
    segment, so many small streams would make filters of a few entries."""
    wanted = max(LEAST_UNITS, -(-grams // UNIT_GRAMS))
    if 4 * wanted > units:
        return streams, units
    dealt = streams.withColumn("unit", F.pmod(F.xxhash64("block"), F.lit(wanted)))
    return stored(dealt.groupBy("unit").applyInArrow(_one_stream, STREAMS), f"joined-{n}", **LONG_ROWS), wanted


def _filters(n: int, bits: int, segment_bits: int):
    """Of each stream, its n-grams as filters: (unit, segment, filter)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("stream")):
                _, grams = _windows(np.frombuffer(raw.as_buffer(), "<u4"), n)
                entries, _ = gather(*permute(grams, bits))
                known, cuts = segments_of(entries, bits, segment_bits)
                made = encode_parts(entries, np.diff(cuts), bits, segment_bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(known), pa.int64()), pa.array(known, pa.int64()), pa.array(made, pa.binary())],
                    names=["unit", "segment", "filter"],
                )

    return run


ANSWERS = "unit bigint, segment bigint, flags binary, filter binary"


def _answer_rows(units: list, segment: int, flags: list, filters: list) -> pa.Table:
    columns = [
        pa.array(units, pa.int64()),
        pa.array([segment] * len(units), pa.int64()),
        pa.array(flags, pa.binary()),
        pa.array(filters, pa.binary()),
    ]
    return pa.Table.from_arrays(columns, names=["unit", "segment", "flags", "filter"])


def _merged(table: pa.Table) -> tuple[int, list[int], np.ndarray, Entries, np.ndarray]:
    segment = table.column("segment")[0].as_py()
    entries, sizes = decode_parts(table.column("filter").to_pylist(), segment)
    return segment, table.column("unit").to_pylist(), sizes, *gather(entries.head, entries.tail, entries.counts)


def _flagged(units: list[int], sizes: np.ndarray, frequent: np.ndarray) -> tuple[list[int], list[bytes]]:
    """For each shard with a frequent entry, a bit for every entry."""
    upto = borders(frequent)[borders(sizes)]
    kept = np.flatnonzero(upto[1:] > upto[:-1]).tolist()
    packed, cuts = pack_parts(frequent, sizes)
    return [units[k] for k in kept], [packed[cuts[k] : cuts[k + 1]] for k in kept]


def _settle(bits: int, segment_bits: int, least: int):
    """Of a segment's filters: the merged filter of the frequent n-grams (unit null), and flags
    for each shard."""

    def run(table: pa.Table) -> pa.Table:
        segment, units, sizes, total, place = _merged(table)
        frequent = total.counts >= least
        if not frequent.any():
            return _answer_rows([], segment, [], [])
        found = encode(total.part(frequent), bits, segment_bits)
        kept, flags = _flagged(units, sizes, frequent[place])
        return _answer_rows([None, *kept], segment, [None, *flags], [found] + [None] * len(kept))

    return run


def _lot_filter(bits: int, segment_bits: int):
    """Of a lot's filters of one segment: their merged filter."""

    def run(table: pa.Table) -> pa.Table:
        segment, _, _, total, _ = _merged(table)
        columns = [table.column("lot").slice(0, 1), pa.array([segment], pa.int64())]
        columns.append(pa.array([encode(total, bits, segment_bits)], pa.binary()))
        return pa.Table.from_arrays(columns, names=["unit", "segment", "filter"])

    return run


def _pass_on(lot: pa.Table, answer: pa.Table) -> pa.Table:
    """Flags for a lot's shards from those for the lot."""
    if not len(lot) or not len(answer):
        return _answer_rows([], 0, [], [])
    segment, units, sizes, total, place = _merged(lot)
    raw = np.frombuffer(answer.column("flags")[0].as_py(), np.uint8)
    frequent = np.unpackbits(raw, count=len(total), bitorder="little").astype(bool)
    kept, flags = _flagged(units, sizes, frequent[place])
    return _answer_rows(kept, segment, flags, [None] * len(kept))


def settled(filters: DataFrame, units: int, bits: int, segment_bits: int, least: int, fan: int = FAN) -> DataFrame:
    """(unit, segment, flags, filter): merged filters of the n-grams with ``least`` occurrences or
    more (unit null), and for each shard which of its entries are among them."""
    if units <= fan:
        return filters.groupBy("segment").applyInArrow(_settle(bits, segment_bits, least), ANSWERS)
    lots = -(-units // fan)
    dealt = stored(filters.withColumn("lot", F.pmod(F.xxhash64("unit"), F.lit(lots))), "filters")
    partial = dealt.groupBy("lot", "segment").applyInArrow(
        _lot_filter(bits, segment_bits), "unit bigint, segment bigint, filter binary"
    )
    above = stored(settled(partial, lots, bits, segment_bits, least, fan), "lots")
    told = above.where(F.col("unit").isNotNull()).withColumnRenamed("unit", "lot")
    passed = dealt.groupBy("lot", "segment").cogroup(told.groupBy("lot", "segment")).applyInArrow(_pass_on, ANSWERS)
    return passed.unionByName(above.where(F.col("unit").isNull()))


def _shorter(n: int, bits: int, segment_bits: int):
    """Of a block's stream and its flags: the stream for phrases of one word more."""

    def run(answers: pa.Table, own: pa.Table) -> pa.Table:
        if not len(own):
            return _stream_row(0, np.empty(0, np.uint32), n + 1)
        stream = np.frombuffer(own.column("stream")[0].as_py(), "<u4")
        at, grams = _windows(stream, n)
        entries, place = gather(*permute(grams, bits))
        frequent = np.zeros(len(entries), bool)
        known, cuts = segments_of(entries, bits, segment_bits)
        told = np.searchsorted(known, answers.column("segment").to_numpy())
        sizes = np.diff(cuts)[told]
        frequent[ranges(cuts[told], sizes)] = unpack_parts(b"".join(answers.column("flags").to_pylist()), sizes)
        kept = _runs(stream, at[frequent[place]], n)
        return _stream_row(own.column("block")[0].as_py(), kept, n + 1)

    return run


def _phrases_of(answers: DataFrame, bits: int) -> DataFrame:
    """(ids, a) from the merged filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, raw in zip(batch.column("segment").to_pylist(), batch.column("filter").to_pylist()):
                entries = decode(raw, segment)
                grams = entries.grams(bits)
                size = grams.shape[1]
                offsets = np.arange(len(grams) + 1, dtype=np.int32) * size
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(grams.astype(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(entries.counts)], names=["ids", "a"])

    merged = answers.where(F.col("unit").isNull()).select("segment", "filter")
    return merged.mapInArrow(run, "ids array<bigint>, a bigint")


def frequent_phrases(
    streams: DataFrame, ids: int, most: int = WORDS, least: int = LEAST, fan: int = FAN
) -> DataFrame | None:
    """(ids, a): all phrases of two to ``most`` words that occur ``least`` times or more."""
    bits, found = id_bits(ids), []
    for n in range(2, most + 1):
        sizes = streams.agg(F.sum("grams").alias("grams"), F.count("*").alias("units")).first()
        if not sizes["grams"]:
            break
        streams, units = fewer_streams(streams, sizes["units"], sizes["grams"], n)
        needed = max(LEAST_SEGMENT_BITS, (sizes["grams"] // SEGMENT_GRAMS).bit_length())
        segment_bits = min(needed, 2 * bits)
        filters = streams.select("block", "stream").mapInArrow(
            _filters(n, bits, segment_bits), "unit bigint, segment bigint, filter binary"
        )
        answers = stored(settled(filters, units, bits, segment_bits, least, fan), f"answers-{n}")
        found.append(_phrases_of(answers, bits))
        if n < most:
            told = answers.where(F.col("unit").isNotNull()).select(F.col("unit").alias("block"), "segment", "flags")
            pairs = told.groupBy("block").cogroup(streams.groupBy("block"))
            streams = stored(pairs.applyInArrow(_shorter(n, bits, segment_bits), STREAMS), f"streams-{n + 1}", **LONG_ROWS)
    if not found:
        return None
    phrases = found[0]
    for more in found[1:]:
        phrases = phrases.unionByName(more)
    return stored(phrases, "phrases")


def _scored(phrases: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """(ids, a, lang, n, l, r, score): each phrase with its lowest-scoring cut."""
    parts = words.select(F.array("id").alias("part"), F.col("n").alias("f")).unionByName(
        phrases.select(F.col("ids").alias("part"), F.col("a").alias("f"))
    )
    parts = stored(parts, "parts")
    named = phrases.join(words.select(F.col("id").alias("first"), "lang"), F.get("ids", F.lit(0)) == F.col("first"))
    named = named.join(totals, "lang").select("ids", "a", "lang", "total")
    cut = F.explode(F.sequence(F.lit(1), F.size("ids") - 1))
    cuts = named.select("*", cut.alias("k"))
    left = F.slice("ids", F.lit(1), F.col("k"))
    right = F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k"))
    cuts = cuts.withColumn("part", left).join(parts.withColumnRenamed("f", "l"), "part").drop("part")
    cuts = cuts.withColumn("part", right).join(parts.withColumnRenamed("f", "r"), "part").drop("part")
    # A quotient is at most SCALE * total / least, the products are decimals of 38 digits.
    wide = lambda c: F.col(c).cast("decimal(17,0)")
    cuts = cuts.withColumn("above", F.lit(SCALE).cast("decimal(4,0)") * wide("a") * wide("total"))
    cuts = cuts.withColumn("below", wide("l") * wide("r"))
    score = F.expr("above div below").cast("bigint")
    best = cuts.groupBy("ids", "a", "lang", F.col("total").alias("n")).agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    )
    return best.select("ids", "a", "lang", "n", "best.score", "best.l", "best.r")


def _uncontained(scored: DataFrame, phrases: DataFrame) -> DataFrame:
    """Without phrases that some longer one contains each time they occur.

    A phrase's occurrences are no fewer than those of one that contains it. So if a longer one
    has as many, all in between have, too: those longer by one word tell.
    """
    longer = phrases.where(F.size("ids") > 2)
    part = lambda start: longer.select(F.slice("ids", F.lit(start), F.size("ids") - 1).alias("part"), "a")
    most = part(1).unionByName(part(2)).groupBy("part").agg(F.max("a").alias("most"))
    joined = scored.join(most, F.col("ids") == F.col("part"), "left")
    return joined.where(F.col("most").isNull() | (F.col("most") < F.col("a"))).drop("part", "most")


def _first(rows: DataFrame, top: int, salts: int = SALTS) -> DataFrame:
    """Those that may be among a language's first ``top`` by score and a, ties included."""
    order = [F.col("score").desc(), F.col("a").desc()]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(salts)))
    for by in (["lang", "salt"], ["lang"]):
        place = F.rank().over(Window.partitionBy(*by).orderBy(*order))
        salted = salted.withColumn("place", place).where(F.col("place") <= top)
    return salted.drop("place", "salt")


def _spelled(rows: DataFrame, words: DataFrame) -> DataFrame:
    """Rows with their phrase as text."""
    spelled = (
        rows.select("ids", F.posexplode("ids").alias("pos", "id"))
        .join(words.select("id", "word"), "id")
        .groupBy("ids")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("w"))
        .select("ids", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("phrase"))
    )
    return rows.join(spelled, "ids")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    most: int = WORDS,
    least: int = LEAST,
    top: int = TOP,
    fan: int = FAN,
) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.col(text_col).cast("string").alias("text"),
    )
    made = stored(word_blocks(texts), "word-blocks", **LONG_ROWS)
    known, told = known_words(made, least)
    totals = stored(
        made.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda x, y: x + y)).alias("total")),
        "totals",
    )
    pairs = told.groupBy("block").cogroup(made.select("block", "stream").groupBy("block"))
    streams = stored(pairs.applyInArrow(_ids_of_words, STREAMS), "streams-2", **LONG_ROWS)
    phrases = frequent_phrases(streams, known.agg(F.max("id")).first()[0] or 0, most, least, fan)
    if phrases is None:
        return _nothing(docs.sparkSession)
    scored = _uncontained(_scored(phrases, known, totals), phrases)
    near = stored(_first(scored, top), "first")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
    ranked = _spelled(near, known).withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.select(*COLUMNS)


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def _nothing(spark: SparkSession) -> DataFrame:
    kinds = ["string", "bigint", "string", *["bigint"] * 5]
    return spark.createDataFrame([], ", ".join(f"{c} {k}" for c, k in zip(COLUMNS, kinds)))


SQL = rf"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), pieces AS (
  SELECT lang, d, p, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, d, unnest(s) AS piece, unnest(range(len(s))) AS p
        FROM (SELECT lang, d, regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]') AS s FROM texts))
), grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM pieces, (VALUES (1), (2), (3), (4), (5)) AS sizes(k) WHERE len(w) >= k)
), counted AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(f) AS n FROM counted WHERE k = 1 GROUP BY lang
), known AS (
  SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM counted WHERE f >= {LEAST}
), cuts AS (
  SELECT lang, k, phrase, f AS a, w, unnest(range(1, k)) AS cut FROM known WHERE k > 1
), scored AS (
  SELECT c.lang, c.k, c.phrase, a, cut, x.f AS l, y.f AS r, n,
         {SCALE}::HUGEINT * a::HUGEINT * n::HUGEINT // (x.f::HUGEINT * y.f::HUGEINT) AS score
  FROM cuts AS c JOIN totals AS t ON t.lang = c.lang
  JOIN known AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : cut], ' ')
  JOIN known AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1 : c.k], ' ')
), best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM scored)
  WHERE nth = 1
), inside AS (
  SELECT DISTINCT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, f
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i
        FROM (SELECT *, unnest(range(2, k)) AS m FROM known WHERE k > 2))
), kept AS (
  SELECT * FROM best AS b
  WHERE NOT EXISTS (SELECT 1 FROM inside AS i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.f >= 100 * b.a)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
       CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= {TOP}
"""
