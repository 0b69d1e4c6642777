"""Benchmark decontamination (operator 4).

The benchmark's windows of 13 consecutive normalised words (all words of a shorter item) become
a sorted table of hashes, broadcast in blocks of at most ``max_windows`` windows; every text
is scanned for every block, so a benchmark of any size is checked whole. Words that a
hash says are hit are compared with the window's own words before they count.

Words: A-Z in lower case, then runs of letters, digits and all beyond ASCII. Null and empty
texts and items have no words and match nothing. A repeated window, or items that share windows,
count for every item that has them. Extra columns are not read by the scan. No shuffle of
texts: a passage that many documents share is found in each where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelda.llm.tables import fresh_names, quoted, stored
from kelda.llm.words import PLAIN, U64, Texts, Words, block_pass, blocks, texts_of
from kelda.llm.words import windows, words_of

WINDOW = 13
#: Windows of the benchmark held in a broadcast at once (some 100 bytes each).
MAX_WINDOWS = 1_000_000
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256))
_LOWER = _LOWER.astype(np.uint8)


def _spelled(texts: Texts, words: Words, first: int, size: int) -> bytes:
    """Words first..first+size-1 in lower case with one space between."""
    return b" ".join(
        _LOWER[texts.data[a:b]].tobytes()
        for a, b in zip(words.starts[first : first + size], words.ends[first : first + size])
    )


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """(size, hash, words, item_id) for each window of each item, as often as it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for block in blocks(batch, "text"):
                    yield make(block)

    def make(block: pa.RecordBatch) -> pa.RecordBatch:
        texts = texts_of(block.column("text"))
        words = words_of(texts, PLAIN)
        ids, counts, numbers = block.column("id").to_pylist(), words.counts(), words.text_numbers()
        rows = []
        for size in sorted({min(window, n) for n in counts.tolist() if n}):
            at, hashes = windows(words, size)
            for first, h in zip(at.tolist(), hashes.tolist()):
                number = numbers[first]
                if min(window, counts[number]) == size:
                    rows.append((size, h, _spelled(texts, words, first, size), ids[number]))
        size, h, spelled, item = zip(*rows) if rows else ((), (), (), ())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(size, pa.int32()),
                pa.array(np.array(h, U64).view(np.int64)),
                pa.array(spelled, pa.binary()),
                pa.array(item, pa.string()),
            ],
            names=["size", "hash", "words", "item"],
        )

    slim = items.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "size int, hash bigint, words binary, item string")


@dataclass(frozen=True)
class Known:
    """Windows of one size: sorted hashes, a bit table over them, and what they stand for."""

    hashes: np.ndarray
    seen: np.ndarray
    words: list[bytes]
    items: list[tuple[str, ...]]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes may be known, and the places of those among the windows."""
        maybe = np.flatnonzero(self.seen[hashes >> U64(44)])
        place = np.searchsorted(self.hashes, hashes[maybe])
        place[place == len(self.hashes)] = 0
        same = self.hashes[place] == hashes[maybe]
        return maybe[same], place[same]


def _known(rows: list) -> dict[int, Known]:
    by_size: dict[int, list] = {}
    for row in rows:
        by_size.setdefault(row["size"], []).append(row)
    found = {}
    for size, own in by_size.items():
        own.sort(key=lambda r: (r["hash"] & 0xFFFFFFFFFFFFFFFF, bytes(r["words"])))
        hashes = np.array([r["hash"] for r in own], np.int64).view(U64)
        seen = np.zeros(1 << 20, bool)
        seen[hashes >> U64(44)] = True
        words = [bytes(r["words"]) for r in own]
        found[size] = Known(hashes, seen, words, [tuple(r["items"]) for r in own])
    return found


def _scan(known: dict[int, Known], texts: Texts, words: Words) -> tuple[list, list]:
    """Per text the hit words (numbers within the text) and the items they belong to."""
    numbers = words.text_numbers()
    hit: list[set[int]] = [set() for _ in range(len(texts))]
    items: list[set[str]] = [set() for _ in range(len(texts))]
    for size, k in known.items():
        at, hashes = windows(words, size)
        which, place = k.find(hashes)
        for first, p in zip(at[which].tolist(), place.tolist()):
            spelled, h, number = _spelled(texts, words, first, size), k.hashes[p], numbers[first]
            # Different windows with one hash stand next to each other.
            while p < len(k.hashes) and k.hashes[p] == h:
                if k.words[p] == spelled:
                    begin = first - int(words.offsets[number])
                    hit[number].update(range(begin, begin + size))
                    items[number].update(k.items[p])
                p += 1
    return hit, items


def mark(
    docs: DataFrame,
    items: DataFrame,
    names: Sequence[str],
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """All rows with three more columns: number of words, sorted numbers of the hit words, and
    the sorted ids of the items they belong to. ``names`` (new to the table) names the three.

    One pass over the texts for each block of the benchmark, each adding to what is found.
    """
    spark = docs.sparkSession
    every = item_windows(items, item_id, item_text, window)
    grouped = stored(
        every.groupBy("size", "hash", "words").agg(F.sort_array(F.collect_set("item")).alias("items")),
        "windows",
    )
    parts = max(1, -(-grouped.count() // max_windows))
    kinds = dict(zip(names, ("bigint", "array<bigint>", "array<string>")))
    marked = docs.withColumns({n: F.lit(None).cast(kind) for n, kind in kinds.items()})
    schema = marked.schema
    for part in range(parts):
        mine = grouped.where(F.pmod(F.xxhash64("words"), F.lit(parts)) == part)
        table = spark.sparkContext.broadcast(_known(mine.collect()))

        def make(block: pa.RecordBatch, table=table) -> pa.RecordBatch:
            texts = texts_of(block.column(block.schema.get_field_index(text_col)))
            words = words_of(texts, PLAIN)
            hit, items = _scan(table.value, texts, words)
            known = [block.schema.get_field_index(name) for name in names]
            for found, place in ((hit, known[1]), (items, known[2])):
                for own, before in zip(found, block.column(place).to_pylist()):
                    own.update(before or ())
            columns = list(block.columns)
            columns[known[0]] = pa.array(words.counts(), pa.int64())
            columns[known[1]] = pa.array([sorted(h) for h in hit], pa.list_(pa.int64()))
            columns[known[2]] = pa.array([sorted(i) for i in items], pa.list_(pa.string()))
            return pa.RecordBatch.from_arrays(columns, names=block.schema.names)

        marked = marked.mapInArrow(block_pass(make, text_col), schema)
    return marked


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents without the contaminated ones, in which a twentieth of the words is hit."""
    names = fresh_names(docs, "n_words", "hit", "items")
    marked = mark(docs, items, names, **options)
    n_hit = F.size(names[1]).cast("bigint")
    return marked.where(~is_contaminated(n_hit, F.col(names[0]))).select(quoted(docs.columns))


def _without(text: str, hit: list[int]) -> str:
    raw = text.encode()
    with np.errstate(over="ignore"):
        words = words_of(texts_of(pa.array([text])), PLAIN)
    out, done, numbers = [], 0, sorted(hit)
    k = 0
    while k < len(numbers):
        last = k
        while last + 1 < len(numbers) and numbers[last + 1] == numbers[last] + 1:
            last += 1
        out.append(raw[done : words.starts[numbers[k]]].rstrip())
        done = int(words.ends[numbers[last]])
        k = last + 1
    out.append(raw[done:].lstrip())
    return b" ".join(p for p in out if p).decode()


def remove_passages(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """All documents with the hit words cut out of their texts: the other form of removal.

    A run of hit words goes with what stands between them; one space takes its place.
    """
    names = fresh_names(docs, "n_words", "hit", "items")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(text_col)
            hits = batch.column(batch.schema.get_field_index(names[1])).to_pylist()
            pairs = zip(batch.column(place).to_pylist(), hits)
            texts = [_without(text, hit) if hit else text for text, hit in pairs]
            yield batch.set_column(place, text_col, pa.array(texts, pa.string())).drop_columns(names)

    marked = mark(docs, items, names, text_col=text_col, **options)
    return marked.mapInArrow(cut, docs.schema)


def report(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """id, n_words, n_hit, n_items, items_sha256, contaminated for every document."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = mark(slim, items, ["n_words", "hit", "items"], **options)
    n_hit = F.size("hit").cast("bigint")
    return found.select(
        F.col("id").alias(id_col),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated(n_hit, F.col("n_words")).alias("contaminated"),
    )


def _sql_words(table: str, key: str) -> str:
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return (
        f"SELECT {key}, regexp_extract_all({lowered}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w "
        f"FROM {table}"
    )


SQL = f"""
WITH d AS ({_sql_words("documents", "doc_id")}),
b AS (SELECT *, least(13, len(w)) AS size FROM ({_sql_words("benchmark", "item_id")}) WHERE len(w) > 0),
iw AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS span
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM b)
),
dw AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS span
  FROM (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
    FROM d, (SELECT DISTINCT size FROM iw)
  )
),
hits AS (SELECT doc_id, i, size, item_id FROM dw JOIN iw USING (size, span)),
hit_words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM hits) GROUP BY doc_id
),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
