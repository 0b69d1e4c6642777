"""Near-duplicates by consistent weighted sampling (operator 3).

A text is the weighted set of its shingles of five words (all its words if it has fewer). A
shingle weighs its count in the text times 1 + ln(N / df) / ln(N), with N texts of which df have
it: between one and two, so a passage that very many texts share counts for half of a rare one.
df is counted exactly, whatever the size of the corpus: texts are dealt to blocks, each block asks
for its different shingles in buckets of the hash's range, and a bucket adds up what the blocks have
and answers. A shingle is sent once a block, however many texts have it. A text's frequencies stay
with it, so that verifying weighs as sampling did.

Improved consistent weighted sampling draws ``BANDS * ROWS`` samples from each set; two sets agree
on a sample with the probability of their weighted Jaccard similarity. Texts that agree on a whole
band are compared: weighted Jaccard of all their shingles must be ``THRESHOLD`` or more. Links
make classes (connected components).

Equal texts are one node, whatever their ids. In a bucket of a band every member is compared with one hub. Then only
members that are still in different classes are compared, those of the bucket's largest class on
one side only: a bucket's others are a query set that meets its members in blocks of bounded
size, and only links come out of a block. So near copies of one text cost a comparison each, and
no pair of a bucket that could join two classes is left out.

Null texts, texts without words and rows without id are classes of their own and never copies.
Repeated rows (same id and text) are counted and compared once. Of an id with several texts each is a row
of the result, with the class of that text. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kelda.llm.components import components
from kelda.llm.tables import fresh_names, quoted, stored
from kelda.llm.words import BYTE_STEP, PLAIN, U64, blocks, mix, range_hashes
from kelda.llm.words import WORD_STEP, texts_of, words_of

SHINGLE, THRESHOLD = 5, 0.8
#: At a similarity of 0.8 a pair meets in some band with probability 0.9992, at 0.9 with 1 - 2e-6.
BANDS, ROWS = 10, 3
#: Bytes of text whose shingles are asked for together, and that a bucket answers for; least buckets.
ASK_BYTES, BUCKET_BYTES, LEAST_BUCKETS = 3 << 20, 8 << 20, 256
#: A text with a word, as ``PLAIN`` has them.
WORDED = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
#: Texts, and bytes of text, that one side of a block has at most (a longer text is alone).
BLOCK_TEXTS, BLOCK_TEXT_BYTES = 512, 3 << 20


def shingles(texts, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and count of every different shingle, by text."""
    words = words_of(texts, PLAIN)
    counts, numbers = words.counts(), words.text_numbers()
    n = len(numbers)
    ends = words.offsets[1:][numbers]
    first = np.arange(n) == words.offsets[:-1][numbers]
    stop = np.minimum(np.arange(n) + size, ends)
    whole = np.flatnonzero((stop - np.arange(n) == size) | (first & (counts[numbers] < size)))
    hashes = range_hashes(words.hashes, whole, stop[whole], WORD_STEP)
    number = numbers[whole]
    _, at, times = np.unique(hashes ^ mix(number.astype(U64) + U64(1)), return_index=True, return_counts=True)
    order = np.argsort(number[at], kind="stable")
    return number[at][order], hashes[at][order], times[order]


def sorted_shingles(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``shingles``, those of a text by their hashes: the order of its frequencies."""
    number, hashes, times = shingles(texts)
    order = np.lexsort((hashes, number))
    return number[order], hashes[order], times[order]


def weigh(df: np.ndarray, times: np.ndarray, total: int) -> np.ndarray:
    """Weights of shingles that are ``times`` in their text and in ``df`` of ``total`` texts."""
    rare = np.log(total / df) / np.log(total) if total > 1 else np.zeros(len(df))
    return times * (1 + rare)


def _narrow(counts: np.ndarray) -> bytes:
    kind = next(k for k in ("u1", "<u2", "<u4", "<u8") if counts.max() <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + counts.astype(kind).tobytes()


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Fixed random numbers: a multiplier and a shift for each sample, and tables of draws from
    Gamma(2, 1) and of logarithms of such draws."""
    random = np.random.default_rng(20240229)
    n = BANDS * ROWS
    odd = random.integers(0, 1 << 63, n, dtype=np.uint64) * U64(2) + U64(1)
    shift = random.integers(0, 1 << 63, n, dtype=np.uint64)
    gamma = random.gamma(2, 1, 1 << 16).astype(np.float32)
    log_gamma = np.log(random.gamma(2, 1, 1 << 16)).astype(np.float32)
    return odd, shift, np.maximum(gamma, np.float32(1e-3)), log_gamma


def samples(number: np.ndarray, hashes: np.ndarray, weights: np.ndarray, texts: int) -> np.ndarray:
    """(texts, samples): what each text draws; NaN for texts without shingles.

    For a shingle of weight w a sample has r, c ~ Gamma(2, 1) and b ~ U(0, 1) fixed by the shingle;
    t = floor(ln w / r + b) and ln a = ln c - r (t - b) - r. The shingle with the least a is drawn,
    with its t. As a follows from shingle and t alone, the least a itself stands for both.
    """
    odd, shift, gamma, log_gamma = _draws()
    found = np.full((texts, len(odd)), np.nan, np.float32)
    if not len(number):
        return found
    begins = np.flatnonzero(np.diff(number, prepend=-1))
    log_w = np.log(weights).astype(np.float32)
    for j in range(len(odd)):
        x = (hashes + shift[j]) * odd[j]
        x ^= x >> U64(29)
        r = gamma[(x >> U64(48)).astype(np.int64)]
        b = ((x & U64(0xFFFF)).astype(np.float32) + np.float32(0.5)) / np.float32(65536)
        t = np.floor(log_w / r + b)
        log_a = log_gamma[((x >> U64(32)) & U64(0xFFFF)).astype(np.int64)] - r * (t - b) - r
        found[number[begins], j] = np.minimum.reduceat(log_a, begins)
    return found


def band_keys(drawn: np.ndarray) -> np.ndarray:
    """(texts, BANDS) hashes of the samples of each band."""
    bits = np.ascontiguousarray(drawn).view(np.uint32).astype(U64).reshape(len(drawn), BANDS, ROWS)
    keys = np.zeros(bits.shape[:2], U64)
    for k in range(ROWS):
        keys = mix(keys * U64(0x9E3779B97F4A7C15) + bits[:, :, k] + U64(k + 1))
    return keys


def _pieces(table: pa.Table) -> Iterator[pa.RecordBatch]:
    for batch in table.to_batches():
        yield from blocks(batch, "text")


def _by_pieces(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``sorted_shingles``, a piece of the texts at a time."""
    found, begin = [], 0
    for piece in _pieces(table):
        number, hashes, times = sorted_shingles(texts_of(piece.column("text")))
        found.append((number + begin, hashes, times))
        begin += len(piece)
    return tuple(np.concatenate(x) for x in zip(*found))


def _ask(parts: int):
    """Of a block of texts: its different shingles, sorted, and how many of its texts have each, in
    pieces by bucket of the hash's range."""

    def run(table: pa.Table) -> pa.Table:
        with np.errstate(over="ignore"):
            own = [shingles(texts_of(piece.column("text")))[1] for piece in _pieces(table)]
            hashes, counts = np.unique(np.concatenate(own), return_counts=True)
            bucket = ((hashes >> U64(32)) * U64(parts)) >> U64(32)
        known, begins = np.unique(bucket, return_index=True)
        ends = np.append(begins, len(hashes))[1:]
        columns = [
            pa.array(np.full(len(known), table.column("block")[0].as_py()), pa.int64()),
            pa.array(known.astype(np.int64)),
            pa.array([hashes[x:y].astype("<u8").tobytes() for x, y in zip(begins, ends)], pa.binary()),
            pa.array([_narrow(counts[x:y]) for x, y in zip(begins, ends)], pa.binary()),
        ]
        return pa.Table.from_arrays(columns, names=["block", "bucket", "hashes", "counts"])

    return run


def _answer(table: pa.Table) -> pa.Table:
    """Of a bucket: for each block the frequencies of the shingles it asked for, in their order."""
    asked = [np.frombuffer(raw, "<u8") for raw in table.column("hashes").to_pylist()]
    counts = np.concatenate([_wide(raw) for raw in table.column("counts").to_pylist()])
    known, place = np.unique(np.concatenate(asked), return_inverse=True)
    sums = np.zeros(len(known), np.int64)
    np.add.at(sums, place, counts)
    cuts = np.cumsum([len(x) for x in asked])[:-1]
    found = [_narrow(x) for x in np.split(sums[place], cuts)]
    columns = [table.column("block"), table.column("bucket"), pa.array(found, pa.binary())]
    return pa.Table.from_arrays(columns, names=["block", "bucket", "df"])


def _draw(total: int):
    """Of a block of texts and the answers to it: each text's signature and frequencies."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        with np.errstate(over="ignore"):
            pieces = [(p, *sorted_shingles(texts_of(p.column("text")))) for p in _pieces(table)]
            known = np.unique(np.concatenate([hashes for _, _, hashes, _ in pieces] or [np.empty(0, U64)]))
            order = np.argsort(answers.column("bucket").to_numpy())
            raw = answers.column("df").to_pylist()
            df = np.concatenate([_wide(raw[k]) for k in order] or [np.empty(0, np.int64)])
            if len(df) != len(known):
                raise ValueError(f"a block has {len(known)} shingles, the answers to it {len(df)}")
            done = [_signed(p, n, h, t, df[np.searchsorted(known, h)], total) for p, n, h, t in pieces]
        return pa.Table.from_batches(done, SIGNED)

    return run


SIGNED = pa.schema(
    [("id", pa.int64()), ("h", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("bytes", pa.int64())]
    + [("bands", pa.list_(pa.int64())), ("df", pa.binary())]
)


def _signed(
    block: pa.RecordBatch, number: np.ndarray, hashes: np.ndarray, times: np.ndarray, df: np.ndarray, total: int
) -> pa.RecordBatch:
    own = texts_of(block.column("text"))
    keys = band_keys(samples(number, hashes, weigh(df, times, total), len(own)))
    worded = np.zeros(len(own), bool)
    worded[number] = True
    starts, ends = own.offsets[:-1], own.offsets[1:]
    exact = [range_hashes(mix(own.data.astype(U64) + U64(s)), starts, ends, BYTE_STEP) for s in (1, 1000)]
    lists = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(worded * BANDS)]), pa.int32()),
        pa.array(keys[worded].view(np.int64).ravel()),
    )
    cuts = np.searchsorted(number, np.arange(len(own) + 1))
    kept = [_narrow(df[x:y]) if y > x else None for x, y in zip(cuts, cuts[1:])]
    columns = [block.column("id"), block.column("h"), *(pa.array(x.view(np.int64)) for x in exact)]
    columns += [pa.array(np.diff(own.offsets)), lists, pa.array(kept, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, schema=SIGNED)


def signatures(texts: DataFrame) -> tuple[DataFrame, int]:
    """(id, h, a, b, bytes, bands, df) of the texts with words, and their number: a 128-bit hash of
    each text, its length, its band keys, and its shingles' frequencies. ``texts`` has id, text and h,
    each pair of id and text once."""
    worded = texts.where(F.col("text").rlike(WORDED))
    sizes = worded.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    total, size = sizes["n"], sizes["bytes"] or 0
    # By id and text: neither a repeated or null id nor a repeated text is one block's.
    block = F.pmod(F.xxhash64("id", "h"), F.lit(-(-size // ASK_BYTES) or 1))
    dealt = worded.select(block.alias("block"), "id", "h", "text")
    parts = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    asked = dealt.groupBy("block").applyInArrow(_ask(parts), "block bigint, bucket bigint, hashes binary, counts binary")
    answers = asked.groupBy("bucket").applyInArrow(_answer, "block bigint, bucket bigint, df binary")
    # Both passes read one exchange of the texts.
    drawn = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _draw(total), "id bigint, h bigint, a bigint, b bigint, bytes bigint, bands array<bigint>, df binary"
    )
    return drawn, total


def weighted_jaccard(first: tuple, second: tuple) -> float:
    """Of two sets given as (sorted hashes, weights)."""
    (h, w), (g, v) = first, second
    at = np.searchsorted(g, h)
    at[at == len(g)] = 0
    same = g[at] == h if len(g) else np.zeros(len(h), bool)
    shared = np.minimum(w[same], v[at[same]]).sum()
    return float(shared / (w.sum() + v.sum() - shared))


def compare(pairs: DataFrame, texts: DataFrame, total: int) -> DataFrame:
    """(a, b, similarity) of pairs of ids; the texts and their frequencies meet by joins on either id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int | None, tuple] = (None, ())

        def vector(text: str, df: bytes) -> tuple:
            _, hashes, times = sorted_shingles(texts_of(pa.array([text], pa.string())))
            return hashes, weigh(_wide(df), times, total)

        with np.errstate(over="ignore"):
            for batch in batches:
                hubs, others = batch.column("a").to_pylist(), batch.column("b").to_pylist()
                sides = (batch.column(c).to_pylist() for c in ("text_a", "df_a", "text_b", "df_b"))
                found = []
                for hub, text, df, other, other_df in zip(hubs, *sides):
                    if last[0] != hub:  # pairs come by hub
                        last = (hub, vector(text, df))
                    found.append(weighted_jaccard(last[1], vector(other, other_df)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hubs, pa.int64()), pa.array(others, pa.int64()), pa.array(found, pa.float64())],
                    names=["a", "b", "similarity"],
                )

    side = lambda c: texts.select(
        F.col("id").alias(c), F.col("text").alias(f"text_{c}"), F.col("df").alias(f"df_{c}")
    )
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    shown = both.select("a", "b", "text_a", "df_a", "text_b", "df_b")
    return shown.mapInArrow(run, "a bigint, b bigint, similarity double")


def _in_classes(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of buckets with their component so far."""
    labels = found.select("id", F.col("component").alias("_c"))
    return members.join(labels, "id", "left").withColumn("component", F.coalesce("_c", "id")).drop("_c")


def _mixed(members: DataFrame) -> DataFrame:
    """Members of those buckets that hold more than one component."""
    spread = members.groupBy("band", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    buckets = spread.where("lo != hi").select("band", "key")
    return members.join(stored(buckets, "mixed-buckets"), ["band", "key"], "left_semi")


def _hub_pairs(members: DataFrame) -> DataFrame:
    """Each member with its bucket's hub, the smallest id."""
    hubs = members.groupBy("band", "key").agg(F.min("id").alias("hub"))
    return (
        members.join(stored(hubs, "hubs"), ["band", "key"])
        .where(F.col("id") != F.col("hub"))
        .select(F.col("hub").alias("a"), F.col("id").alias("b"))
        .distinct()
    )


def _blocks_of(members: DataFrame) -> DataFrame:
    """(band, key, i, j, id, component, asks): the members of mixed buckets in blocks.

    Members outside the bucket's largest component (ties: the smallest) ask; they are cut into
    parts i, all members into parts j, and block (i, j) has both parts.
    """
    sizes = members.groupBy("band", "key", "component").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("bytes")
    )
    buckets = sizes.groupBy("band", "key").agg(
        F.max_by(F.struct("component", "n", "bytes"), F.struct("n", -F.col("component"))).alias("most"),
        F.sum("n").alias("n"),
        F.sum("bytes").alias("bytes"),
    )
    parts = lambda n, size: F.greatest(
        F.ceil(n / BLOCK_TEXTS), F.ceil(size / BLOCK_TEXT_BYTES), F.lit(1)
    ).cast("int")
    cut = buckets.select(
        "band",
        "key",
        F.col("most.component").alias("largest"),
        parts(F.col("n") - F.col("most.n"), F.col("bytes") - F.col("most.bytes")).alias("ni"),
        parts(F.col("n"), F.col("bytes")).alias("nj"),
    )
    placed = members.join(stored(cut, "bucket-parts"), ["band", "key"])
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    named = ["band", "key", "id", "component"]
    answer = placed.select(*named, every("ni").alias("i"), part("nj").alias("j"), F.lit(False).alias("asks"))
    rest = placed.where("component != largest")
    ask = rest.select(*named, part("ni").alias("i"), every("nj").alias("j"), F.lit(True).alias("asks"))
    return answer.unionByName(ask)


def _block_links(members: DataFrame, texts: DataFrame, total: int, threshold: float) -> DataFrame:
    """(a, b): pairs of components that a link of texts joins, each once."""

    def run(table: pa.Table) -> pa.Table:
        with np.errstate(over="ignore"):
            found = _links_in_block(table, total, threshold)
        a, b = zip(*sorted(found)) if found else ((), ())
        return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    placed = _blocks_of(members).join(texts, "id")
    return placed.groupBy("band", "key", "i", "j").applyInArrow(run, "a bigint, b bigint").distinct()


def _links_in_block(table: pa.Table, texts: int, threshold: float) -> set[tuple[int, int]]:
    """Pairs of components that links join, as many as it takes to connect what a block's links do: fewer
    than the block has components."""
    component = np.array(table.column("component").to_pylist(), np.int64)
    asks = np.array(table.column("asks").to_pylist(), bool)
    number, hashes, times = _by_pieces(table)
    df = np.concatenate([_wide(raw) for raw in table.column("df").to_pylist()])
    weight = weigh(df, times, texts)
    total = np.bincount(number, weights=weight, minlength=len(asks))
    # Postings: who of those that answer has a shingle, and with what weight.
    answers = np.flatnonzero(~asks[number])
    by_hash = answers[np.argsort(hashes[answers], kind="stable")]
    known, first, counts = np.unique(hashes[by_hash], return_index=True, return_counts=True)
    if not len(known):
        return set()
    begins = np.searchsorted(number, np.arange(len(asks) + 1))
    names, place = np.unique(component, return_inverse=True)
    root = np.arange(len(names))
    found = set()
    for x in np.flatnonzero(asks):
        own = slice(begins[x], begins[x + 1])
        at = np.minimum(np.searchsorted(known, hashes[own]), len(known) - 1)
        has = known[at] == hashes[own]
        at, mine = at[has], weight[own][has]
        sizes = counts[at]
        ends = np.cumsum(sizes)
        if not len(ends):
            continue
        posts = by_hash[np.arange(ends[-1]) + np.repeat(first[at] - (ends - sizes), sizes)]
        least = np.minimum(weight[posts], np.repeat(mine, sizes))
        shared = np.bincount(number[posts], weights=least, minlength=len(asks))
        similarity = shared / (total + total[x] - shared)
        near = np.flatnonzero((similarity >= threshold) & ~asks & (component != component[x]))
        for r in np.unique(root[place[near]]).tolist():
            own = root[place[x]]
            if r != own:
                found.add((int(names[own]), int(names[r])))
                root[root == r] = own
    return found


def _classes(docs: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """(id, h, class_id, copy_of) for every different row of id and text; h is the text's hash."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = _once(texts.withColumn("h", F.xxhash64("text")))
    signed, total = signatures(texts)
    drawn = stored(signed, "signatures")
    nodes = drawn.where((F.size("bands") > 0) & F.col("id").isNotNull())
    # Nodes are texts; a number of its own tells one from the other, the row of the smallest id has its text.
    grouped = nodes.groupBy("a", "b").agg(
        F.min("id").alias("rep"), F.first("h").alias("h"), F.first("bands").alias("bands"), F.first("bytes").alias("bytes")
    )
    copies = stored(grouped.withColumn("node", F.monotonically_increasing_id()), "texts")
    buckets = copies.select(F.col("node").alias("id"), "bytes", F.posexplode("bands").alias("band", "key"))
    shared = buckets.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1").select("band", "key")
    members = stored(buckets.join(stored(shared, "shared-buckets"), ["band", "key"], "left_semi"), "members")
    wanted = copies.select(F.col("rep").alias("id"), "h", "node").join(
        members.select(F.col("id").alias("node")).distinct(), "node", "left_semi"
    )
    # Texts are moved by merge joins at every size: the same plan for a small and a large corpus.
    candidates = stored(wanted, "candidates").hint("merge")
    met = texts.join(candidates, ["id", "h"])
    # By id and hash: the frequencies of the very text that is compared.
    rates = drawn.select("id", "h", "df").join(candidates.select("id", "h"), ["id", "h"], "left_semi")
    compared = met.join(rates.hint("merge"), ["id", "h"]).select(F.col("node").alias("id"), "text", "df")
    compared = stored(compared, "compared")

    tested = stored(compare(stored(_hub_pairs(members), "pairs"), compared, total), "similarities")
    near = tested.where(F.col("similarity") >= threshold)
    first = components(near)
    open_members = stored(_mixed(_in_classes(members, first)), "open-members")
    # Buckets of two texts are settled: their pair has been compared.
    crowds = open_members.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 2")
    crowded = open_members.join(stored(crowds.select("band", "key"), "crowds"), ["band", "key"], "left_semi")
    across = stored(_block_links(crowded, compared, total, threshold), "links")
    # Links across join whole components, so the second time only these are the nodes.
    second = components(across).select(F.col("id").alias("part"), F.col("component").alias("whole"))
    found = first.select(F.col("id").alias("node"), F.col("component").alias("own"))

    # A class is named by the smallest id of its texts.
    placed = copies.select("a", "b", "node", F.col("rep").alias("copy_of")).join(found, "node", "left")
    placed = placed.withColumn("part", F.coalesce("own", "node")).join(second, "part", "left")
    placed = stored(placed.withColumn("class", F.coalesce("whole", "part")).select("a", "b", "class", "copy_of"), "placed")
    named = placed.groupBy("class").agg(F.min("copy_of").alias("class_id"))
    known = nodes.select("id", "h", "a", "b").join(placed.join(named, "class"), ["a", "b"])
    rows = known.select("id", "h", "class_id", "copy_of")
    wordless = texts.where(~F.coalesce(F.col("text").rlike(WORDED), F.lit(False))).select("id", "h")
    alone = drawn.where((F.size("bands") <= 0) | F.col("bands").isNull() | F.col("id").isNull()).select("id", "h")
    rest = alone.unionByName(wordless)
    return rows.unionByName(rest.select("id", "h", F.col("id").alias("class_id"), F.col("id").alias("copy_of")))


def _once(texts: DataFrame) -> DataFrame:
    """Each different row of id and text once. Rows that are repeated are told by their hashes
    first, so that texts are only moved where an id and a hash come twice."""
    repeated = texts.groupBy("id", "h").agg(F.count("*").alias("n")).where("n > 1").select("id", "h")
    twice = stored(repeated, "repeated-rows")
    if twice.isEmpty():
        return texts
    other = twice.select(F.col("id").alias("_id"), F.col("h").alias("_h"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h"))
    single = texts.join(other, same, "left_anti")
    return single.unionByName(texts.join(other, same, "left_semi").groupBy("id", "h", "text").agg(F.lit(1)).select("id", "text", "h"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """(id, class_id, copy_of) for every row: the smallest id of its class, and the smallest id
    with exactly its text; repeated rows once."""
    found = _classes(docs, id_col, text_col, threshold)
    return found.select(F.col("id").alias(id_col), "class_id", "copy_of")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """One document of each class, that of the smallest id; repeated rows of it are one.

    Rows without id, text or words are no copies and all stay.
    """
    classes = stored(_classes(docs, id_col, text_col, threshold), "classes")
    near_id, near_h, own_h, nth = fresh_names(docs, "near_id", "near_h", "h", "nth")
    dropped = classes.where(F.col("id") != F.col("class_id")).select(F.col("id").alias(near_id), F.col("h").alias(near_h))
    near = stored(dropped, "near-copies").hint("merge")
    hashed = docs.withColumn(own_h, F.xxhash64(F.col(text_col).cast("string")))
    same = (F.col(id_col).cast("bigint") == F.col(near_id)) & (F.col(own_h) == F.col(near_h))
    kept = hashed.join(near, same, "left_anti").select(quoted(docs.columns))
    repeated = docs.groupBy(id_col).count().where(F.col(id_col).isNotNull() & (F.col("count") > 1))
    if repeated.isEmpty():
        return kept
    twice = stored(repeated.select(id_col), "repeated-ids")
    by_text = Window.partitionBy(id_col, text_col).orderBy(F.lit(0))
    once = kept.join(twice, id_col, "left_semi").withColumn(nth, F.row_number().over(by_text)).where(F.col(nth) == 1)
    return kept.join(twice, id_col, "left_anti").select(quoted(docs.columns)).unionByName(
        once.select(quoted(docs.columns))
    )


def report(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, class_id, copy_of and whether the document stays."""
    found = near_duplicates(docs, id_col)
    return found.withColumn("kept", F.coalesce(F.col(id_col) == F.col("class_id"), F.lit(True)))
