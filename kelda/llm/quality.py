"""Quality rules as a short-circuit cascade (operator 2).

Every text gets its base figures, which decide ``base_failed``. Texts that pass go through a
cascade of rules: a rule sees only what the rules before it let through. On a bounded sample
each rule's cost (seconds a text) and selectivity (share rejected) are measured, and the rules
run in order of rejections per cost. A text is kept if no rule rejects it, so the order changes
the work and never the verdict.

Null and empty texts have no words, so they fail the base rule. Equal texts get equal verdicts.
Columns of the input other than the id and the text are not read, whatever their names. One
narrow pass without a shuffle, so hot sources and copies weigh no more than other rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelda.llm.words import BYTE_STEP, SPACED, U64, Texts, block_pass, mix, range_hashes
from kelda.llm.words import texts_of, windows, words_of

SYMBOLS = "#*$%&|<>"
#: Rows the costs and selectivities are measured on.
SAMPLE_ROWS = 300

_BYTE = np.arange(256)
_IS_SYMBOL = np.isin(_BYTE, [ord(c) for c in SYMBOLS])
_IS_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_IS_LOWER = (_BYTE >= 97) & (_BYTE <= 122)
_IS_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_IS_START = (_BYTE & 0xC0) != 0x80  # first byte of a code point


def _repeats(texts_no: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item, whether its text has it more than once, and whether it came before."""
    if not len(hashes):
        return np.empty(0, bool), np.empty(0, bool)
    keys = hashes ^ mix(texts_no.astype(U64) + U64(1))
    _, first, place, counts = np.unique(
        keys, return_index=True, return_inverse=True, return_counts=True
    )
    return counts[place] > 1, first[place] != np.arange(len(keys))


@dataclass
class Block:
    """Some texts and their figures, each made when a rule first asks for it."""

    texts: Texts
    _chosen: np.ndarray | None = field(default=None)

    def part(self, chosen: np.ndarray) -> Block:
        """The block of the chosen texts only."""
        t = self.texts
        lengths = np.diff(t.offsets)[chosen]
        keep = np.zeros(len(t), bool)
        keep[chosen] = True
        data = t.data[np.repeat(keep, np.diff(t.offsets))]
        return Block(Texts(data, np.concatenate([[0], np.cumsum(lengths)])))

    @cached_property
    def words(self):
        return words_of(self.texts, SPACED)

    @cached_property
    def n_words(self) -> np.ndarray:
        return self.words.counts().astype(np.int64)

    @cached_property
    def word_chars(self) -> np.ndarray:
        return self.texts.sums(SPACED.member[self.texts.data] & _IS_START[self.texts.data])

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return self.texts.sums(_IS_SYMBOL[self.texts.data])

    @cached_property
    def _lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Text number of each line with a word, and whether it equals an earlier such line."""
        t = self.texts
        breaks = np.flatnonzero(t.data == 10)
        ends = np.sort(np.concatenate([breaks, t.offsets[1:]]))
        starts = np.sort(np.concatenate([breaks + 1, t.offsets[:-1]]))
        # A break that ends a text leaves an empty line after it; it has no word.
        upto = np.zeros(len(t.data) + 1, np.int64)
        np.cumsum(SPACED.member[t.data], out=upto[1:])
        worded = upto[ends] > upto[starts]
        starts, ends = starts[worded], ends[worded]
        number = np.searchsorted(t.offsets, starts, "right") - 1
        hashes = range_hashes(SPACED.value[t.data], starts, ends, BYTE_STEP)
        return number, _repeats(number, hashes)[1]

    @cached_property
    def n_lines(self) -> np.ndarray:
        return np.bincount(self._lines[0], minlength=len(self.texts)).astype(np.int64)

    @cached_property
    def n_dup_lines(self) -> np.ndarray:
        number, again = self._lines
        return np.bincount(number[again], minlength=len(self.texts)).astype(np.int64)

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        at, hashes = windows(self.words, 3)
        number = self.words.text_numbers()
        twice = at[_repeats(number[at], hashes)[0]]
        hit = np.zeros(len(number), bool)
        for k in range(3):
            hit[twice + k] = True
        return np.bincount(number[hit], minlength=len(self.texts)).astype(np.int64)


Rule = Callable[[Block], np.ndarray]


def base_failed(b: Block) -> np.ndarray:
    return (b.n_words < 50) | (100 * b.n_repeat_words > 50 * b.n_words)


def _shouting(b: Block) -> np.ndarray:
    upper, lower = b.texts.sums(_IS_UPPER[b.texts.data]), b.texts.sums(_IS_LOWER[b.texts.data])
    return upper > lower


def _exclaiming(b: Block) -> np.ndarray:
    return 10 * b.texts.sums(b.texts.data == ord("!")) > 3 * b.n_words


#: Each returns True for texts to reject.
RULES: dict[str, Rule] = {
    "symbols": lambda b: 10 * b.n_symbols > 3 * b.n_words,
    "repeated_lines": lambda b: 2 * b.n_dup_lines > b.n_lines,
    "shouting": _shouting,
    "exclaiming": _exclaiming,
    "word_length": lambda b: (b.word_chars < 2 * b.n_words) | (b.word_chars > 20 * b.n_words),
    "digits": lambda b: 2 * b.texts.sums(_IS_DIGIT[b.texts.data]) > b.word_chars,
}


def order_of(rules: dict[str, Rule], texts: Sequence[str | None]) -> list[str]:
    """Names of the rules by rejections per second on the sample, best first.

    Each rule is timed on its own, with nothing made for it by others. Rules that reject
    nothing come last, the cheapest of them first.
    """
    sample = texts_of(pa.array(list(texts), pa.string()))
    found = {}
    with np.errstate(over="ignore"):
        for name, rule in rules.items():
            begun = time.perf_counter()
            rejected = int(rule(Block(sample)).sum())
            found[name] = (rejected, max(time.perf_counter() - begun, 1e-9))
    return sorted(rules, key=lambda n: (-found[n][0] / found[n][1], found[n][1]))


def verdicts(block: Block, rules: dict[str, Rule], order: Sequence[str]) -> np.ndarray:
    """Whether each text passes all rules; a rule sees only what passed those before it."""
    alive = np.arange(len(block.texts))
    rest = block
    for name in order:
        if not len(alive):
            break
        passed = np.flatnonzero(~rules[name](rest))
        if len(passed) < len(alive):
            alive = alive[passed]
            rest = rest.part(passed)
    kept = np.zeros(len(block.texts), bool)
    kept[alive] = True
    return kept


def quality_cascade(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: dict[str, Rule] | None = None,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Base figures and the verdict for every text.

    ``sample_rows`` bounds the rows (those of the smallest hash of their id) on which the order
    of the rules is measured. Returns id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept.
    """
    rules = RULES if rules is None else rules
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    chosen = slim.select("id").orderBy(F.xxhash64("id")).limit(sample_rows)
    sample = slim.join(chosen.distinct(), "id", "left_semi").limit(sample_rows)
    order = order_of(rules, [row["text"] for row in sample.select("text").collect()])

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        block = Block(texts_of(batch.column("text")))
        failed = base_failed(block)
        kept = ~failed
        passing = np.flatnonzero(kept)
        kept[passing] = verdicts(block.part(passing), rules, order)
        columns = [
            batch.column("id"),
            *(
                pa.array(getattr(block, name), pa.int64())
                for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            ),
            pa.array(failed),
            pa.array(kept),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    names = ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    names += ["base_failed", "kept"]
    kind = slim.schema["id"].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"{n} bigint" for n in names[1:6])
    found = slim.mapInArrow(block_pass(make, "text"), schema + ", base_failed boolean, kept boolean")
    return found.withColumnRenamed("id", id_col)


#: The same figures and verdict in DuckDB's SQL.
SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), lines AS (
  SELECT doc_id, line FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words
  ) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), line_figures AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines GROUP BY doc_id
), spans AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS span
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)
), repeated AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, span) AS n FROM spans
  ) WHERE n > 1
), repeat_figures AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM repeated, (VALUES (0), (1), (2)) AS t(k) GROUP BY doc_id
), figures AS (
  SELECT doc_id, text, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM words LEFT JOIN line_figures USING (doc_id) LEFT JOIN repeat_figures USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words
         OR 10 * n_symbols > 3 * n_words
         OR 2 * n_dup_lines > n_lines
         OR length(regexp_replace(text, '[^A-Z]', '', 'g'))
            > length(regexp_replace(text, '[^a-z]', '', 'g'))
         OR 10 * length(regexp_replace(text, '[^!]', '', 'g')) > 3 * n_words
         OR word_chars < 2 * n_words OR word_chars > 20 * n_words
         OR 2 * length(regexp_replace(text, '[^0-9]', '', 'g')) > word_chars
       ) AS kept
FROM figures
"""
