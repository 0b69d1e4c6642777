"""Language identification by cross-parsing (operator 9).

For each language a suffix automaton is built of a bounded sample of labelled text. A text is
parsed against each automaton into phrases, each the longest match with anything in that
language's sample; the language that needs the fewest phrases wins, where a phrase counts for
the logarithm of the sample's length (what it takes to name a place in it) and the sum is
divided by the text's length.

All automata are one transition table. Texts are cut in lanes of ``LANE`` symbols, and all lanes of a
block walk through the table together, one symbol a step. A lane first starts as if a phrase did; then
lanes whose predecessor ends in another state are walked again from that one, beside the first walk, until
both agree. The result is that of one walk over each whole text.

Letters that are frequent in the sample are symbols; every other one of the sample is two, the digits of
its number, so no two letters of the sample are alike. A letter that is not in the sample is a phrase.

Null texts and texts without a letter are ``und`` with score 0, as is every text if no language
could be learned. Equal texts get equal answers; ties go to the first language by name. Language,
source and id are not read when predicting. One pass without a shuffle.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelda.llm.tables import bounded_sample, fold
from kelda.llm.words import block_pass

UNKNOWN = "und"
#: The sample: documents of a language, characters of a document, characters of a language.
SAMPLE_DOCS, DOC_CHARS, SAMPLE_CHARS = 64, 4000, 32_000
#: Entries of the transition table, at most; many languages get shorter samples.
TABLE_CELLS = 24_000_000
LANE = 512
#: Letters with a symbol of their own; the sample's others have two.
OWN_LETTERS = 200
#: Rounds in which lanes are joined side by side; what is left is walked in order.
ROUNDS = 4


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


def symbol_table(texts: Sequence[str]) -> tuple[np.ndarray, int]:
    """Symbol and, if it needs another, second symbol of each code point; and the number of symbols.

    0 is what is no letter, 1 a letter that the sample does not have."""
    counts = Counter()
    for text in texts:
        counts.update(text.lower())
    letters = sorted((c for c in counts if c.isalpha()), key=lambda c: (-counts[c], c))
    table = np.zeros((2, 0x110000), np.uint16)
    table[0] = _is_letter()
    own, rare = letters[:OWN_LETTERS], letters[OWN_LETTERS:]
    for number, letter in enumerate(own, 2):
        table[0, ord(letter)] = number
    base, zero = math.isqrt(max(len(rare) - 1, 0)) + 1, 2 + len(own)
    for number, letter in enumerate(rare):
        table[:, ord(letter)] = zero + number // base, zero + number % base
    return table, zero + (base if rare else 0)


def symbols_of(texts: Sequence[str | None], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, runs of non-letters as one 0, and each text's borders."""
    lowered = [(t or "").lower() for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le"), np.uint32)
    borders = np.concatenate([[0], np.cumsum([len(t) for t in lowered])]).astype(np.int64)
    symbols, second = table[0][points], table[1][points]
    first = np.zeros(len(points) + 1, bool)
    first[borders] = True
    gap = symbols == 0
    again = np.zeros(len(points), bool)
    again[1:] = gap[:-1]
    sizes = np.where(gap & (again | first[:-1]), 0, np.where(second > 0, 2, 1))
    upto = np.concatenate([[0], np.cumsum(sizes)])
    found = np.repeat(symbols, sizes)
    found[upto[1:][second > 0] - 1] = second[second > 0]
    return found, upto[borders]


def suffix_automaton(symbols: Sequence[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that reads just the substrings of ``symbols``."""
    goto: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        state = len(goto)
        goto.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in goto[p]:
            goto[p][c] = state
            p = link[p]
        if p >= 0:
            q = goto[p][c]
            if length[p] + 1 == length[q]:
                link[state] = q
            else:
                clone = len(goto)
                goto.append(dict(goto[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and goto[p].get(c) == q:
                    goto[p][c] = clone
                    p = link[p]
                link[q] = link[state] = clone
        last = state
    return goto


@dataclass(frozen=True)
class Model:
    """Automata of all languages in one table: entry = next state * 4 + phrases that end here."""

    names: list[str]
    symbols: np.ndarray
    alphabet: int
    table: np.ndarray
    roots: np.ndarray
    phrase_cost: np.ndarray

    def costs(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cost of each text in each language, and the number of its symbols that are letters."""
        symbols, borders = symbols_of(texts, self.symbols)
        letters = np.concatenate([[0], np.cumsum(symbols != 0)])[borders]
        lengths = np.diff(borders)
        lanes = -(-lengths // LANE)
        text_of = np.repeat(np.arange(len(lengths)), lanes)
        nth = np.arange(len(text_of)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        starts = borders[:-1][text_of] + nth * LANE
        sizes = np.minimum(LANE, lengths[text_of] - nth * LANE)
        order = np.argsort(-sizes, kind="stable")
        starts, sizes, text_of = starts[order], sizes[order], text_of[order]
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        later = np.flatnonzero(nth > 0)
        active = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), "left")
        state = np.repeat(self.roots[:, None], len(starts), axis=1)
        phrases = np.zeros(state.shape, np.int32)
        for step, n in enumerate(active.tolist()):
            at = state[:, :n] * self.alphabet
            at += symbols[starts[:n] + step]
            found = self.table[at]
            phrases[:, :n] += found & 3
            state[:, :n] = found >> 2
        self._join_lanes(symbols, starts, sizes, place[later - 1], place[later], state, phrases)
        ends = np.ones(len(starts), bool)
        ends[place[later - 1]] = False
        phrases += (state != self.roots[:, None]) & ends
        total = np.zeros((len(lengths), len(self.names)))
        np.add.at(total, text_of, phrases.T)
        return total * self.phrase_cost, np.diff(letters)

    def _join_lanes(self, symbols, starts, sizes, before, own, state, phrases) -> None:
        """Correct ``state`` and ``phrases`` of lanes ``own`` that go on where lanes ``before`` end.

        A round walks the lanes whose start has changed, from the old and the new one side by side, up to
        where they agree. From there on the first walk was right. Only a lane that does not agree up to its
        end changes its successor's start. Texts of one long repetition hardly ever agree, so after some
        rounds the lanes left are walked one after the other.
        """
        began = np.repeat(self.roots[:, None], len(starts), axis=1)
        for _ in range(ROUNDS):
            lang, which = np.nonzero(began[:, own] != state[:, before])
            lane = own[which]
            was, now = began[lang, lane], state[lang, before[which]]
            began[lang, lane] = now
            step = 0
            while len(lang):
                symbol = symbols[starts[lane] + step]
                first, second = self.table[was * self.alphabet + symbol], self.table[now * self.alphabet + symbol]
                phrases[lang, lane] += (second & 3) - (first & 3)
                was, now, step = first >> 2, second >> 2, step + 1
                over = (sizes[lane] == step) & (was != now)
                state[lang[over], lane[over]] = now[over]
                going = (was != now) & ~over
                lang, lane, was, now = lang[going], lane[going], was[going], now[going]
        entry, last = self.table.item, len(own)
        left = np.nonzero(began[:, own] != state[:, before])
        for lang, k in zip(left[0].tolist(), left[1].tolist()):
            while k < last and began[lang, own[k]] != state[lang, before[k]]:
                lane, now, count = own[k], int(state[lang, before[k]]), 0
                began[lang, lane] = now
                for symbol in symbols[starts[lane] : starts[lane] + sizes[lane]].tolist():
                    found = entry(now * self.alphabet + symbol)
                    now = found >> 2
                    count += found & 3
                phrases[lang, lane], state[lang, lane] = count, now
                k += 1

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text: the share of the best one if costs are read as
        negative log-likelihoods of equally likely languages."""
        costs, letters = self.costs(texts)
        best = costs.argmin(axis=1)
        scores = 1 / np.exp(costs.min(axis=1, keepdims=True) - costs).sum(axis=1)
        names = [self.names[b] if n else UNKNOWN for b, n in zip(best, letters)]
        return names, np.where(letters > 0, np.clip(scores, 0, 1), 0.0)


def build(samples: dict[str, str]) -> Model | None:
    """A model from labelled text; languages without a letter in it are left out."""
    samples = {n: t for n, t in sorted(samples.items()) if any(c.isalpha() for c in t)}
    if not samples:
        return None
    table, alphabet = symbol_table(list(samples.values()))
    # An automaton has at most twice as many states as symbols read.
    most = max(1000, min(SAMPLE_CHARS, TABLE_CELLS // (2 * alphabet * len(samples))))
    parts, roots, cost, base = [], [], [], 0
    for text in samples.values():
        symbols = symbols_of([text], table)[0][:most].tolist()
        goto = suffix_automaton(symbols)
        start = goto[0]
        # Not readable: a phrase ends, and the symbol begins the next one; if no phrase of
        # this language begins so, the symbol is a phrase by itself.
        own = np.empty((len(goto), alphabet), np.int32)
        for c in range(alphabet):
            own[:, c] = (base + start[c]) * 4 + 1 if c in start else base * 4 + 2
        own[0, :] = [(base + start[c]) * 4 if c in start else base * 4 + 1 for c in range(alphabet)]
        for s, out in enumerate(goto):
            for c, t in out.items():
                own[s, c] = (base + t) * 4
        parts.append(own)
        roots.append(base)
        cost.append(math.log(len(symbols) + 1))
        base += len(goto)
    return Model(
        list(samples), table, alphabet, np.concatenate(parts).ravel(), np.array(roots, np.int32), np.array(cost)
    )


def shares(texts: Sequence[str], total: int) -> list[str]:
    """The texts, long ones cut to one length, so that all have a part in ``total`` characters."""
    left, limit = total, 0
    for k, size in enumerate(sorted(len(t) for t in texts)):
        limit = max(left // (len(texts) - k), 1)
        if size > limit:
            break
        left, limit = left - size, size
    return [t[:limit] for t in texts]


def learn(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """A model from a bounded sample of the labelled rows: by language the ``SAMPLE_DOCS``
    documents of the smallest hashes of id and text, up to ``DOC_CHARS`` characters of each and cut to
    ``SAMPLE_CHARS`` together. Null and repeated ids are spread by their texts; repeated rows are one."""
    known = rows.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"),
        F.substring(F.col(text_col), 1, DOC_CHARS).alias("text"),
        F.col(lang_col).alias("lang"),
    )
    picked = bounded_sample(known, "lang", "id", SAMPLE_DOCS, "text")
    texts: dict[str, list[str]] = {}
    for row in picked.orderBy("lang", F.xxhash64("id", "text"), "text").collect():
        texts.setdefault(row["lang"], []).append(row["text"])
    return build({lang: " ".join(shares(own, SAMPLE_CHARS)) for lang, own in texts.items()})


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred and score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def make(block: pa.RecordBatch) -> pa.RecordBatch:
        texts = block.column("text").to_pylist()
        if shared.value is None:
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        else:
            names, scores = shared.value.predict(texts)
        columns = [block.column("id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
        return pa.RecordBatch.from_arrays(columns, names=["id", "lang_pred", "score"])

    kind = slim.schema["id"].dataType.simpleString()
    schema = f"id {kind}, lang_pred string, score double"
    return slim.mapInArrow(block_pass(make, "text", 2 << 20), schema).withColumnRenamed("id", id_col)


def report(docs: DataFrame, id_col: str = "doc_id", parts: int = 4, held: int = 2) -> DataFrame:
    """Learn from all folds but ``held`` of ``parts`` and predict every row."""
    # coalesce: a null id has no fold and is learned from.
    in_fold = F.coalesce(fold(id_col, parts) == held, F.lit(False))
    found = identify(docs, learn(docs.where(~in_fold), id_col), id_col)
    return found.select(id_col, in_fold.alias("held_out"), "lang_pred", "score")
