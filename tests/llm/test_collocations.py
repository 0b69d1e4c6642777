"""Operator 11: filters read back as they were, counts and phrases equal to brute force."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kelda.llm import collocations
from kelda.llm import quotient_filter as qf
from kelda.llm.tables import stored
from tests.llm.common import LONG_TEXT


@pytest.mark.parametrize("bits", [16, 24, 32])
@pytest.mark.parametrize("n", [2, 3, 5])
def test_filters_lose_nothing(bits, n):
    random = np.random.default_rng(bits + n)
    for size in (0, 1, 7, 20_000):
        grams = random.integers(1, min(1 << bits, 300 if size > 7 else 1 << bits), (size, n)).astype(np.uint32)
        head, tail = qf.permute(grams, bits)
        assert (qf.restore(head, tail, bits) == grams).all()
        entries, place = qf.gather(head, tail)
        wanted = Counter(map(tuple, grams.tolist()))
        assert dict(zip(map(tuple, entries.grams(bits).tolist()), entries.counts.tolist())) == wanted
        assert (entries.grams(bits)[place] == grams).all()
        factors = random.choice([1, 2, 255, 256, 257, 70_000, 1 << 45], len(entries))
        entries = qf.Entries(entries.head, entries.tail, entries.counts * factors)
        for segment_bits in (0, 5, 8):
            known, cuts = qf.segments_of(entries, bits, segment_bits)
            for k, a, b in zip(known.tolist(), cuts, cuts[1:]):
                own = entries.part(slice(a, b))
                got = qf.decode(qf.encode(own, bits, segment_bits), k)
                for name in ("head", "tail", "counts"):
                    assert (getattr(got, name) == getattr(own, name)).all()


def test_merged_filters_add_up():
    random = np.random.default_rng(3)
    shards = [random.integers(1, 40, (500, 3)).astype(np.uint32) for _ in range(5)]
    total, place = qf.merge([qf.gather(*qf.permute(s, 16))[0] for s in shards])
    wanted = Counter(map(tuple, np.concatenate(shards).tolist()))
    assert dict(zip(map(tuple, total.grams(16).tolist()), total.counts.tolist())) == wanted
    assert len(place) == sum(len(np.unique(s, axis=0)) for s in shards)


@pytest.mark.parametrize("n", [2, 4])
def test_filters_of_many_segments_and_shards(n):
    """Built and read together, filters are those built and read one by one, in their order."""
    random = np.random.default_rng(n)
    shards = []
    for size in (30_000, 40, 1):
        entries, _ = qf.gather(*qf.permute(random.integers(1, 60, (size, n)).astype(np.uint32), 16))
        counts = entries.counts * random.choice([1, 300, 1 << 40], len(entries))
        shards.append(qf.Entries(entries.head, entries.tail, counts))
    made = {}
    for shard in shards:
        known, cuts = qf.segments_of(shard, 16, 5)
        raws = qf.encode_parts(shard, np.diff(cuts), 16, 5)
        parts = [shard.part(slice(a, b)) for a, b in zip(cuts, cuts[1:])]
        assert raws == [qf.encode(p, 16, 5) for p in parts]
        for k, part, raw in zip(known.tolist(), parts, raws):
            made.setdefault(k, []).append((part, raw))
    assert max(map(len, made.values())) > 1
    for k, own in made.items():
        got, sizes = qf.decode_parts([raw for _, raw in own], k)
        assert sizes.tolist() == [len(p) for p, _ in own]
        for name in ("head", "tail", "counts"):
            assert (getattr(got, name) == np.concatenate([getattr(p, name) for p, _ in own])).all()


def test_flags_of_parts():
    random = np.random.default_rng(4)
    sizes = np.array([0, 3, 8, 17, 0, 64, 1])
    flags = random.random(sizes.sum()) < 0.5
    packed, cuts = qf.pack_parts(flags, sizes)
    assert np.diff(cuts).tolist() == [0, 1, 1, 3, 0, 8, 1]
    assert (qf.unpack_parts(packed, sizes) == flags).all()
    at = np.split(flags, np.cumsum(sizes)[:-1])
    assert [packed[a:b] for a, b in zip(cuts, cuts[1:])] == [np.packbits(x, bitorder="little").tobytes() for x in at]


def brute_force(rows, least, top):
    counts, lower = {}, lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    for text, lang in rows:
        own = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            own.update(tuple(words[i : i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    found = []
    for lang, f in counts.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        known = {p: v for p, v in f.items() if 2 <= len(p) and v >= least}
        kept = []
        for p, a in known.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: E731, B023
            if any(len(q) > len(p) and v >= a and inside(q) for q, v in known.items()):
                continue
            cuts = [(1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]], n))
        for rank, (s, _, phrase, a, left, right, n) in enumerate(sorted(kept)[:top], 1):
            found.append((lang, rank, phrase.decode(), a, left, right, n, -s))
    return sorted(found)


@pytest.fixture(scope="module")
def rows():
    random = np.random.default_rng(5)
    vocabulary = ["The", "of", "and", "é", "new", "york", "x", "Ünï", "B"]
    marks = [" ", " ", " ", " ", "\t", ", ", ".\n", " \x0b", "\x85 ", "\u00a0"]
    texts = ["".join(f"{random.choice(vocabulary)}{random.choice(marks)}" for _ in range(30)) for _ in range(60)]
    langs = ["en", "de", None, "und"]
    made = [(t, langs[k % 4]) for k, t in enumerate(texts)]
    return made + [(None, "en"), ("", "fr"), (" ,. \n", "fr"), made[0], made[0], ("New York " * 50, "en")]


@pytest.mark.parametrize("fan", [1, 2, 4096])
def test_phrases_equal_brute_force(spark, rows, monkeypatch, fan):
    monkeypatch.setattr(collocations, "_first", lambda rows, top: first(rows, top, salts=3))
    docs = spark.createDataFrame([(t, x, "clash", 1) for t, x in rows], "text string, lang string, block string, ids int")
    fan = max(fan, 2)
    got = collocations.collocations(docs.repartition(5), least=4, top=25, fan=fan)
    assert sorted(map(tuple, got.collect())) == brute_force(rows, 4, 25)


first = collocations._first


def test_long_empty_and_null(spark):
    docs = spark.createDataFrame([(LONG_TEXT, None), (None, None), ("", "en")], "text string, lang string")
    got = sorted(map(tuple, collocations.collocations(docs).collect()))
    assert got == brute_force([(LONG_TEXT, None)], 100, 2000) != []
    assert collocations.collocations(docs.where(F.col("text") == "")).count() == 0
    assert collocations.collocations(docs.where("false")).columns == collocations.COLUMNS


def test_small_streams_share_filters(spark, rows, monkeypatch):
    """Filters are of streams of some size, not of each block: else their number grows with the input's square."""
    units, settled = [], collocations.settled

    def seen(filters, *rest):
        units.append(filters.select("unit").distinct().count())
        return settled(filters, *rest)

    monkeypatch.setattr(collocations, "settled", seen)
    docs = spark.createDataFrame(rows * 4, "text string, lang string").repartition(60).persist()
    made = collocations.word_blocks(docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text"))
    assert made.count() > 100
    got = collocations.collocations(docs, least=16, top=25)
    assert sorted(map(tuple, got.collect())) == brute_force(rows * 4, 16, 25)
    docs.unpersist()
    assert len(units) == 4 and max(units) <= 16


def test_blocks_are_filled(spark):
    """Languages that take turns share a task's memory, and a block is of about 4 MB of words."""
    text = F.repeat(F.concat_ws(" ", F.lit("a few words"), F.col("id") % 100, F.lit("and more.")), 100)
    lang = F.element_at(F.array(*map(F.lit, ["en", "en", "en", "de", "fr", "es"])), (F.col("id") % 6 + 1).cast("int"))
    texts = spark.range(9000).coalesce(1).select(lang.alias("lang"), text.alias("text"))
    size = texts.agg(F.sum(F.length("text"))).first()[0]
    made = stored(collocations.word_blocks(texts), "blocks")
    assert size > 5 * collocations.BLOCK_BYTES and made.count() <= 4 + size // collocations.BLOCK_BYTES
    n = made.agg(F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda x, y: x + y))).first()[0]
    assert n == 9000 * 100 * 6


def test_counts_beyond_64_bits(spark):
    big = 3 * 10**12
    phrases = spark.createDataFrame([([1, 2], big)], "ids array<bigint>, a bigint")
    words = spark.createDataFrame([(1, "en", "a", big + 1), (2, "en", "b", big + 2)], "id bigint, lang string, word string, n bigint")
    totals = spark.createDataFrame([("en", 10**15)], "lang string, total bigint")
    got = collocations._scored(phrases, words, totals).collect()
    assert [r["score"] for r in got] == [1000 * big * 10**15 // ((big + 1) * (big + 2))]


def test_words_of_blocks_move_in_arrays(spark):
    """A row for each block and segment, however many words a block has; ids differ by language and word."""
    texts = spark.range(3000).select(
        F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("lang"),
        F.concat_ws(" ", F.lit("both"), *[F.concat(F.lit(f"w{k}_"), (F.col("id") % 40).cast("string")) for k in range(40)]).alias("text"),
    )
    made = stored(collocations.word_blocks(texts), "blocks")
    known, told = collocations.known_words(made, 50)
    words = {(r["lang"], r["word"]): (r["n"], r["id"]) for r in known.collect()}
    assert len(words) == 2 * (1 + 20 * 40) == known.count() == len({i for _, i in words.values()})
    assert words["x", "both"][0] == 1500 and words["x", "w3_4"][0] == 75 and ("y", "w3_4") not in words
    of = {r["block"]: (r["lang"], r["words"]) for r in made.collect()}
    rows = told.collect()
    assert len(rows) <= 256 * len(of)
    for r in rows:
        lang, own = of[r["block"]]
        assert [words[lang, own[p]][1] for p in r["places"]] == r["ids"]
    assert sum(len(r["ids"]) for r in rows) == sum(len(own) for _, own in of.values())
