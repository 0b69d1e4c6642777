"""Toxicity by a convolutional text classifier (operator 5), trained in numpy.

A word is looked up in two tables of embeddings by two hashes, so that two words are confused only
if they share both places. Filters over one, two and three words run along the text, each
filter's largest value counts, and a logistic layer makes the score. The tables start from
how much more toxic texts use a place and are trained with the filters.

All labelled rows are learned from, whole texts. Few are trained on by the driver. More are dealt over
shards by the hash of their id: what the tables start from is counted over all rows, each shard's task trains a
net from that start, chunk after chunk, and the nets' mean is the result, a place's over the shards that use it.

The score sees words only. What counts as toxic is decided by a threshold for each language,
calibrated on the part of the learning rows that was kept from training; languages with too few
of them, and unknown ones, take the threshold of all. Texts without words, null ones among them,
have nothing to be scored and get 0, which is below every threshold. Equal texts get equal scores. One pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelda.llm.tables import fold, fresh_names, quoted, stored
from kelda.llm.words import PLAIN, U64, block_pass, blocks, texts_of, words_of

#: Rows and bytes of text that the driver trains on by itself; rows of a shard, shards at most, and rows
#: and words that a shard's task holds at once.
FEW_ROWS, FEW_BYTES = 8000, 32 << 20
SHARD_ROWS, MOST_SHARDS, CHUNK_ROWS, CHUNK_WORDS = 32_000, 256, 8000, 4_000_000
BUCKETS, DIMS, FILTERS, WIDTHS = 1 << 18, 8, 8, (1, 2, 3)
EPOCHS, LEAST_STEPS, BATCH, RATE = 4, 400, 64, 0.01
#: Words of a batch at most, but for a longer text alone; parts that tables are added up in.
BATCH_WORDS, PARTS = BATCH * 6000, 64
#: Thresholds stay in this range; a language needs so many rows of each class for its own.
THRESHOLDS, CLASS_LEAST = (0.3, 0.7), 20
PAD = max(WIDTHS) - 1
#: The value of windows that begin in padding: less than any other.
PAST = np.float32(-1e9)


def places(hashes: np.ndarray) -> np.ndarray:
    """The two places of each word: (words, 2); place 0 of each table is padding."""
    low, high = hashes & U64(BUCKETS - 1), (hashes >> U64(32)) & U64(BUCKETS - 1)
    return np.maximum(np.stack([low, high], axis=1).astype(np.int64), 1)


def padded(found: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with ``PAD`` padding rows after each text, and where each text begins."""
    sizes = counts + PAD
    begins = np.cumsum(sizes) - sizes
    rows = np.zeros((int(sizes.sum()), 2), np.int64)
    at = np.arange(len(found)) + np.repeat(np.arange(len(counts)) * PAD, counts)
    rows[at] = found
    return rows, begins


@dataclass
class Net:
    """Embeddings, filters by width (width * 2 * DIMS, FILTERS), and the logistic layer."""

    tables: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    @classmethod
    def start(cls, first: np.ndarray) -> Net:
        """``first``: (2, BUCKETS), the first dimension of each table."""
        random = np.random.default_rng(7)
        tables = np.empty((2, BUCKETS, DIMS), np.float32)
        for part in tables.reshape(PARTS, -1):  # the numbers that one call would draw
            part[:] = random.normal(0, 0.05, part.size)
        tables[:, :, 0] = first
        tables[:, 0] = 0
        filters = [random.normal(0, 0.1, (w * 2 * DIMS, FILTERS)).astype(np.float32) for w in WIDTHS]
        for own in filters:  # half of the filters begin by looking at that dimension
            for k in range(0, len(own), DIMS):
                own[k, : FILTERS // 2] += 0.5
        biases = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        out = random.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32)
        return cls(tables, filters, biases, out, np.zeros(1, np.float32))

    def words(self, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([self.tables[0][rows[:, 0]], self.tables[1][rows[:, 1]]], axis=1)

    def forward(self, rows: np.ndarray, begins: np.ndarray) -> tuple[list, np.ndarray, np.ndarray]:
        """By width the values of all windows and the largest by text; those of all widths
        side by side, negative ones as 0; and the scores.

        Every text ends in padding, so no window that begins with a text's word reaches the next
        text's. Windows that begin in padding may; they count for nothing (see ``PAST``).
        """
        n, width = len(rows), 2 * DIMS
        # One product for all filters: a window's value is the sum over its words.
        split = [f[k * width : (k + 1) * width] for f in self.filters for k in range(len(f) // width)]
        parts = self.words(rows) @ np.concatenate(split, axis=1)
        past = rows[:, 0] == 0
        past[begins] = False
        found, column = [], 0
        for w, bias in zip(WIDTHS, self.biases):
            z = parts[:, column : column + FILTERS] + bias
            for k in range(1, w):
                column += FILTERS
                z[: n - k] += parts[k:, column : column + FILTERS]
            column += FILTERS
            z[past] = PAST
            found.append((z, np.maximum.reduceat(z, begins, axis=0)))
        top = np.maximum(np.concatenate([t for _, t in found], axis=1), 0)
        logit = top @ self.out + self.out_bias
        return found, top, 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def scores(self, rows: np.ndarray, begins: np.ndarray) -> np.ndarray:
        return self.forward(rows, begins)[2]


class Adam:
    def __init__(self, value: np.ndarray) -> None:
        self.value, self.m, self.v, self.t = value, np.zeros_like(value), np.zeros_like(value), 0

    def step(self, gradient: np.ndarray, rate: float) -> None:
        self.t += 1
        self.m += 0.1 * (gradient - self.m)
        self.v += 0.001 * (gradient**2 - self.v)
        m, v = self.m / (1 - 0.9**self.t), self.v / (1 - 0.999**self.t)
        self.value -= rate * m / (np.sqrt(v) + 1e-8)


def use_counts(texts: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """(2, 2, BUCKETS): how many texts of each class use a place of each table."""
    counts = np.zeros((2, 2, BUCKETS))
    for rows, label in zip(texts, toxic):
        for k in range(2):
            counts[label, k, np.unique(rows[:, k])] += 1
    return counts


def log_odds(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(2, BUCKETS): log of how much more often toxic texts use a place, in quarters and within
    -1 and 1; 0 for places that none uses. ``sizes`` are those of the classes."""
    rates = (counts + 1) / (sizes[:, None, None] + 2)
    odds = np.log(rates[1] / rates[0])
    odds[counts.sum(axis=0) == 0] = 0
    return np.clip(odds, -4, 4) / 4


def _batches(order: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """``BATCH`` texts each, fewer where they are very long."""
    first = words = 0
    for k, size in enumerate(sizes[order].tolist()):
        if k - first == BATCH or k > first and words + size > BATCH_WORDS:
            yield order[first:k]
            first, words = k, 0
        words += size
    yield order[first:]


def train(
    texts: list[np.ndarray], toxic: np.ndarray, epochs: int = EPOCHS, net: Net | None = None, least_steps: int = LEAST_STEPS
) -> Net:
    """A net from the places of each text's words and its label; ``net`` is trained on if given."""
    net = net or Net.start(log_odds(use_counts(texts, toxic), np.bincount(toxic, minlength=2)))
    lengths = np.array([len(t) for t in texts])
    dense = [Adam(x) for x in (*net.filters, *net.biases, net.out, net.out_bias)]
    squares = np.zeros(net.tables.shape[:2], np.float32)
    random = np.random.default_rng(11)
    steps_each = -(-len(texts) // BATCH)
    for _ in range(max(epochs, -(-least_steps // steps_each))):
        order = random.permutation(len(texts))
        for chosen in _batches(order, lengths):
            counts = np.array([len(texts[i]) for i in chosen])
            rows, begins = padded(np.concatenate([texts[i] for i in chosen]), counts)
            found, top, score = net.forward(rows, begins)
            error = ((score - toxic[chosen]) / len(chosen)).astype(np.float32)
            back = (error[:, None] * net.out) * (top > 0)
            gradients, biases, sparse = [], [], []
            places_of = np.arange(len(rows), dtype=np.int32)[:, None]
            sizes = np.diff(np.append(begins, len(rows)))
            for k, (w, (z, most)) in enumerate(zip(WIDTHS, found)):
                own = back[:, k * FILTERS : (k + 1) * FILTERS]
                is_top = np.where(z == np.repeat(most, sizes, axis=0), places_of, np.int32(len(rows)))
                at = np.minimum.reduceat(is_top, begins, axis=0).astype(np.int64)
                inputs = [np.minimum(at + j, len(rows) - 1) for j in range(w)]
                seen = np.concatenate([net.words(rows[i.ravel()]).reshape(*i.shape, -1) for i in inputs], axis=2)
                gradients.append(np.einsum("tfi,tf->if", seen, own))
                biases.append(own.sum(axis=0))
                sparse.append((at, own[:, :, None] * net.filters[k].T[None]))
            steps = [*gradients, *biases, top.T @ error, np.array([error.sum()])]
            for adam, gradient in zip(dense, steps):
                adam.step(gradient.astype(np.float32), RATE)
            _update_tables(net, squares, rows, sparse)
    return net


def _update_tables(net: Net, squares: np.ndarray, rows: np.ndarray, sparse: list) -> None:
    """Adagrad on the embeddings of the words in the windows that counted."""
    at_all, grad_all = [], []
    for at, to_words in sparse:
        parts = to_words.reshape(*to_words.shape[:2], -1, 2 * DIMS)
        for k in range(parts.shape[2]):
            at_all.append(np.minimum(at + k, len(rows) - 1).ravel())
            grad_all.append(parts[:, :, k].reshape(-1, 2 * DIMS))
    at, grad = np.concatenate(at_all), np.concatenate(grad_all)
    for t in range(2):
        used, place = np.unique(rows[at, t], return_inverse=True)
        total = np.zeros((len(used), DIMS), np.float32)
        np.add.at(total, place, grad[:, t * DIMS : (t + 1) * DIMS])
        total[used == 0] = 0
        squares[t, used] += (total**2).mean(axis=1)
        net.tables[t, used] -= 0.1 * total / (np.sqrt(squares[t, used])[:, None] + 1e-6)


TRIES = np.linspace(*THRESHOLDS, 41)


def best_threshold(scores: np.ndarray, toxic: np.ndarray) -> float:
    """The middle of the thresholds with the best F1, kept within ``THRESHOLDS``."""
    upto = np.searchsorted(TRIES, scores, side="right")
    return best_of(np.stack([np.bincount(upto[toxic == k], minlength=len(TRIES) + 1) for k in (0, 1)]))


def best_of(counts: np.ndarray) -> float:
    """The same from (2, tries + 1): texts of each class by the number of ``TRIES`` their score reaches."""
    hit, said = counts[1][::-1].cumsum()[::-1][1:], counts.sum(axis=0)[::-1].cumsum()[::-1][1:]
    f1 = 2 * hit / np.maximum(1, said + counts[1].sum())
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    return float(round(TRIES[best[len(best) // 2]], 3))


def calibrate(net: Net, texts: list[np.ndarray], toxic: np.ndarray, langs: list[str | None]) -> None:
    """Thresholds of the languages and of all rows, from rows that were not trained on."""
    if not len(texts):
        return
    scores = np.concatenate([net.scores(*padded(t, np.array([len(t)]))) for t in texts])
    enough = lambda y: min((y == 1).sum(), (y == 0).sum()) >= CLASS_LEAST
    if enough(toxic):
        net.threshold = best_threshold(scores, toxic)
    for lang in sorted({x for x in langs if x is not None}):
        own = np.array([x == lang for x in langs])
        if enough(toxic[own]):
            net.thresholds[lang] = best_threshold(scores[own], toxic[own])


def _places_of(block: pa.RecordBatch) -> list[np.ndarray]:
    """The places of each text's words."""
    words = words_of(texts_of(block.column("text")), PLAIN)
    found, cuts = places(words.hashes).astype("<i4"), words.offsets.tolist()
    return [found[a:b] for a, b in zip(cuts, cuts[1:])]


def _looked_up(rows: DataFrame) -> DataFrame:
    """(id, toxic, lang, words) of labelled texts, words as places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for block in blocks(batch, "text"):
                    raw = [own.tobytes() for own in _places_of(block)]
                    columns = [block.column("id").cast(pa.string()), block.column("toxic"), block.column("lang")]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array(raw, pa.binary())], names=["id", "toxic", "lang", "words"]
                    )

    return rows.select("id", "toxic", "lang", "text").mapInArrow(run, "id string, toxic int, lang string, words binary")


def _texts(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(raw.as_buffer(), "<i4").reshape(-1, 2) for raw in batch.column("words")]


_PARTS_OF = "part int, shard int, data binary"


def _added_up(pieces: DataFrame, add) -> dict[int, np.ndarray]:
    """Of pieces (part, shard, data) each part's sum as ``add`` makes it, on the driver: tables are of fixed size."""

    def run(table: pa.Table) -> pa.Table:
        ordered = table.sort_by("shard")
        raw = [np.frombuffer(x.as_buffer(), "<f4") for x in ordered.column("data").combine_chunks()]
        made = np.asarray(add(table.column("part")[0].as_py(), raw), "<f4").tobytes()
        return pa.table({"part": table.column("part").slice(0, 1), "data": pa.array([made], pa.binary())})

    found = pieces.groupBy("part").applyInArrow(run, "part int, data binary").collect()
    return {r["part"]: np.frombuffer(r["data"], "<f4") for r in found}


def _piece_batch(parts: list[np.ndarray], shard: int, first: int = 0) -> pa.RecordBatch:
    columns = [
        pa.array(range(first, first + len(parts)), pa.int32()),
        pa.array([shard] * len(parts), pa.int32()),
        pa.array([np.ascontiguousarray(p, "<f4").tobytes() for p in parts], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["part", "shard", "data"])


def _all_use_counts(rows: DataFrame) -> np.ndarray:
    """``use_counts`` of all labelled texts. Looked up and counted in one pass: a second one behind it would be
    a second Python worker for each task, and Spark keeps a worker, with what it holds, for the steps after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 2, BUCKETS), np.float32)
        with np.errstate(over="ignore"):
            for batch in batches:
                for block in blocks(batch, "text"):
                    for own, label in zip(_places_of(block), block.column("toxic").to_pylist()):
                        for k in range(2):
                            counts[label, k, np.unique(own[:, k])] += 1
        if counts.any():
            yield _piece_batch(np.split(counts.ravel(), PARTS), 0)

    # Whole numbers, so their order doesn't show.
    found = _added_up(rows.select("toxic", "text").mapInArrow(run, _PARTS_OF), lambda part, raw: np.sum(raw, axis=0, dtype=np.float64))
    empty = np.zeros(4 * BUCKETS // PARTS, np.float32)
    return np.concatenate([found.get(k, empty) for k in range(PARTS)]).astype(np.float64).reshape(2, 2, BUCKETS)


def _dense(net: Net) -> list[np.ndarray]:
    return [*net.filters, *net.biases, net.out, net.out_bias]


def _trained_in_shards(words: DataFrame, odds: np.ndarray, shards: int) -> Net:
    """The mean of the nets of all shards."""
    start = words.sparkSession.sparkContext.broadcast(odds.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, net, texts, toxic, held = None, None, [], [], 0

        def go_on() -> None:
            nonlocal net, held
            if texts:
                least = LEAST_STEPS if net is None else 0
                net = train(texts, np.array(toxic), net=net or Net.start(start.value), least_steps=least)
            texts.clear()
            toxic.clear()
            held = 0

        def told() -> Iterator[pa.RecordBatch]:
            go_on()
            if net is not None:
                yield _piece_batch([np.concatenate([x.ravel() for x in _dense(net)])], shard, PARTS)
                net.tables -= Net.start(start.value).tables
                for k, part in enumerate(np.split(net.tables.reshape(-1, DIMS), PARTS)):
                    yield _piece_batch([part], shard, k)

        for batch in batches:
            for own, label, rows in zip(batch.column("shard").to_pylist(), batch.column("toxic").to_pylist(), _texts(batch)):
                if own != shard:
                    yield from told()
                    shard, net = own, None
                elif len(texts) >= CHUNK_ROWS or held + len(rows) > CHUNK_WORDS:
                    go_on()
                texts.append(rows)
                toxic.append(label)
                held += len(rows)
        yield from told()

    def mean(part: int, raw: list[np.ndarray]) -> np.ndarray:
        if part == PARTS:
            return np.mean(raw, axis=0, dtype=np.float64)
        total, used = np.zeros((len(raw[0]) // DIMS, DIMS)), np.zeros((len(raw[0]) // DIMS, 1))
        for own in raw:
            rows = own.reshape(-1, DIMS)
            total += rows
            used += rows.any(axis=1, keepdims=True)
        return total / np.maximum(used, 1)

    place = F.xxhash64("id")
    dealt = words.withColumn("shard", F.pmod(place, F.lit(shards)).cast("int")).repartitionById(shards, "shard")
    dealt = dealt.sortWithinPartitions("shard", F.xxhash64("id", F.lit("order")), "id")
    found = _added_up(dealt.select("shard", "toxic", "words").mapInArrow(run, _PARTS_OF), mean)
    net = Net.start(start.value)
    net.tables += np.concatenate([found[k] for k in range(PARTS)]).reshape(net.tables.shape)
    at = 0
    for value in _dense(net):
        value[...] = found[PARTS][at : at + value.size].reshape(value.shape)
        at += value.size
    return net


def _calibrated(net: Net, rows: DataFrame) -> Net:
    """``calibrate`` by counts of scores, one row for each language, class and place among ``TRIES``."""
    reached = sum(((F.col("score") >= float(t)).cast("int") for t in TRIES), F.lit(0))
    scored = with_scores(rows.select("text", "lang", "toxic"), net, "score")
    tables: dict[str | None, np.ndarray] = {}
    every = np.zeros((2, len(TRIES) + 1), np.int64)
    for r in scored.groupBy("lang", "toxic", reached.alias("reached")).count().collect():
        for counts in (every, tables.setdefault(r["lang"], np.zeros_like(every))):
            counts[r["toxic"], r["reached"]] += r["count"]
    enough = lambda counts: counts.sum(axis=1).min() >= CLASS_LEAST
    if enough(every):
        net.threshold = best_of(every)
    net.thresholds = {k: best_of(v) for k, v in tables.items() if k is not None and enough(v)}
    return net


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
    label_col: str = "toxic",
    few_rows: int = FEW_ROWS,
    shard_rows: int = SHARD_ROWS,
) -> Net | None:
    """A net from all labelled rows, with one text of each id; a fifth of them is for calibration. None if a
    class is missing. Up to ``few_rows`` rows are trained on by the driver, more in shards of about ``shard_rows``."""
    told = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
    told = told.where(F.col("toxic").isin(0, 1) & F.col("id").isNotNull()).groupBy("id").agg(F.max("toxic").alias("toxic"))
    has_lang = lang_col is not None and lang_col in docs.columns
    texts = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).cast("string").alias("text"),
        (F.col(lang_col).cast("string") if has_lang else F.lit(None).cast("string")).alias("lang"),
    )
    joined = texts.join(told, "id").where(F.col("text").isNotNull())
    # One text of an id, that of the smallest hash, however many rows repeat it.
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text", "lang")).alias("one")
    joined = joined.groupBy("id", "toxic").agg(one).select("id", "one.text", "one.lang", "toxic")
    every = stored(joined, "labelled-texts")
    aside = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("aside")), F.lit(5)) == 0
    sizes = every.groupBy("toxic", aside.alias("aside")).agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    sizes = sizes.collect()
    if len({r["toxic"] for r in sizes}) < 2:
        return None
    total = sum(r["n"] for r in sizes)
    if total <= few_rows and sum(r["bytes"] for r in sizes) <= FEW_BYTES:
        return _learned_from_few(_looked_up(every).collect())
    train_sizes = np.array([sum(r["n"] for r in sizes if r["toxic"] == k and not r["aside"]) for k in (0, 1)])
    learned = every.where(~aside)
    odds = log_odds(_all_use_counts(learned), train_sizes)
    shards = min(MOST_SHARDS, max(1, -(-int(train_sizes.sum()) // shard_rows)))
    return _calibrated(_trained_in_shards(_looked_up(learned), odds, shards), every.where(aside))


def _learned_from_few(rows: list) -> Net:
    rows = sorted(rows, key=lambda r: (r["id"], bytes(r["words"])))
    texts_rows = [np.frombuffer(r["words"], "<i4").reshape(-1, 2) for r in rows]
    toxic = np.array([r["toxic"] for r in rows])
    aside = np.arange(len(rows)) % 5 == 0
    net = train([t for t, a in zip(texts_rows, aside) if not a], toxic[~aside])
    calibrate(
        net,
        [t for t, a in zip(texts_rows, aside) if a],
        toxic[aside],
        [r["lang"] for r, a in zip(rows, aside) if a],
    )
    return net


def with_scores(docs: DataFrame, net: Net | None, score_col: str, text_col: str = "text") -> DataFrame:
    """All rows with one more column, the score of the text; 0 where nothing could be learned."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    marked = docs.withColumn(score_col, F.lit(0.0))

    def make(block: pa.RecordBatch) -> pa.RecordBatch:
        if shared.value is None:
            return block
        words = words_of(texts_of(block.column(block.schema.get_field_index(text_col))), PLAIN)
        scores = shared.value.scores(*padded(places(words.hashes), words.counts()))
        scores = np.where(words.counts() > 0, scores, 0)
        place = block.schema.get_field_index(score_col)
        # Rounded, so that the order of sums in a block doesn't show.
        return block.set_column(place, score_col, pa.array(np.round(scores.astype(np.float64), 5)))

    return marked.mapInArrow(block_pass(make, text_col), marked.schema)


def threshold_of(net: Net | None, lang: Column) -> Column:
    """The calibrated threshold for a language column."""
    if net is None:
        return F.lit(1.1)
    found = F.lit(net.threshold)
    for name, value in net.thresholds.items():
        found = F.when(lang == name, F.lit(value)).otherwise(found)
    return found


def drop_toxic(docs: DataFrame, net: Net | None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents whose score is below the threshold of their language."""
    (score,) = fresh_names(docs, "score")
    lang = F.col(lang_col) if lang_col in docs.columns else F.lit(None).cast("string")
    kept = with_scores(docs, net, score, text_col).where(F.col(score) < threshold_of(net, lang))
    return kept.select(quoted(docs.columns))


def report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", parts: int = 5) -> DataFrame:
    """id, held_out, score, predicted, and threshold and toxic by the calibrated thresholds."""
    held = F.coalesce(fold(id_col, parts) == 0, F.lit(False))
    net = learn(docs, labels.where(~held), id_col)
    slim = docs.select(id_col, "text", "lang")
    scored = with_scores(slim, net, "score")
    limit = threshold_of(net, F.col("lang"))
    return scored.select(
        id_col,
        held.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        limit.alias("threshold"),
        (F.col("score") >= limit).alias("toxic"),
    )
