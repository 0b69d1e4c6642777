"""Operator 3's document frequencies are exact, however many shingles the corpus has."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from kelda.llm import minhash
from tests.llm.common import plain_words


def test_frequencies_of_every_shingle(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = docs.select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("h"))
    drawn, total = minhash.signatures(texts)
    got = {r["id"]: Counter(minhash._wide(r["df"]).tolist()) for r in drawn.collect()}
    sets = {}
    for r in docs.collect():
        w = plain_words(r["text"])
        if w:
            sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    df = Counter(s for own in sets.values() for s in own)
    assert total == len(sets)
    assert got == {k: Counter(df[s] for s in own) for k, own in sets.items()}


def test_classes_among_millions_of_shingles(spark):
    """Two texts share a passage that 200 texts have and are 0.795 alike; that the other 4,000,000
    shingles of the corpus are found once must not be lost among each other."""
    random = np.random.default_rng(7)
    words = lambda n: " ".join(f"w{x}" for x in random.integers(0, 1_000_000, n))
    passage = words(1004)
    long = [f"{passage} {words(20_000)}" for _ in range(198)]
    short = [words(20) for _ in range(400)]
    total, own = 600, 151
    usual, rare = 1 + math.log(total / 200) / math.log(total), 2
    least = lambda n: 1000 * usual / (1000 * usual + n * rare)
    while least(own) >= 0.796:
        own += 1
    # A shingle across the border counts for the rest of a text.
    pair = [f"{passage} {words(own // 2)}", f"{passage} {words(own - own // 2)}"]
    assert 0.79 < least(own) < 0.8
    rows = list(enumerate(pair + long + short))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    found = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs).collect()}
    assert found == {k: k for k, _ in rows}


def test_an_id_with_several_texts_loses_no_link(spark):
    random = np.random.default_rng(9)
    words = lambda n: " ".join(f"w{x}" for x in random.integers(0, 10_000, n))
    a, b, c = words(80), words(80), words(80)
    rows = [(1, a), (1, b), (2, f"{a} more"), (3, f"{b} more"), (4, c), (0, f"{c} more"), (4, a), (1, a), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(tuple, minhash.near_duplicates(docs).collect()), key=repr)
    wanted = [(0, 0, 0), (1, 1, 1), (1, 1, 1), (2, 1, 2), (3, 1, 3), (4, 0, 4), (4, 1, 1), (None, None, None)]
    assert got == sorted(wanted, key=repr)
    kept = sorted(map(tuple, minhash.drop_near_duplicates(docs).collect()), key=repr)
    assert kept == sorted([(0, f"{c} more"), (1, a), (1, b), (None, a)], key=repr)


def test_repeated_rows_are_one(spark):
    text = " ".join(f"w{k}" for k in range(50))
    rows = [(None, text)] * 300 + [(7, text)] * 300 + [(8, f"{text} more")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = sorted(map(tuple, minhash.near_duplicates(docs).collect()), key=repr)
    assert got == [(7, 7, 7), (8, 7, 8), (None, None, None)]
    assert minhash.signatures(minhash._once(docs.select(docs.doc_id.alias("id"), "text", F.xxhash64("text").alias("h"))))[1] == 3
