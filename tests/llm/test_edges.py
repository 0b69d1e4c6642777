"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing extra columns."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kelda.llm import bpe, decontaminate, language, licenses, line_dedup, minhash, quality, token_files
from kelda.llm import toxicity, warc
from tests.llm.common import LONG_TEXT

NOTE = "Released under the MIT licence!"
COPY = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
CLASH = ["id", "a", "b", "bands", "score", "_score", "n_words", "_n_words", "hit", "items", "_covered", "words", "count"]
ROWS = [
    (1, COPY),
    (2, COPY),
    (2, COPY),
    (3, None),
    (4, ""),
    (5, " \n\t\n "),
    (6, LONG_TEXT),
    (None, COPY),
    (None, None),
    (7, NOTE),
    (8, "x"),
    (9, "\n".join([COPY, "b", "c", COPY, "b", "c"])),
]
IDS = sorted((r[0] for r in ROWS), key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    made = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    made = made.withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text")})
    return made.withColumns({c: F.lit(f"extra {c}") for c in CLASH})


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, " ".join(COPY.split()[:13])), (2, None), (3, ""), (4, "X"), (5, " ".join(COPY.split()[:13]))]
    return spark.createDataFrame(rows, "item_id bigint, text string")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, 1, i % 2) for i in range(1, 9)] + [(None, 1, 1), (1, 1, None), (1, 0, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def ids(df, name="doc_id"):
    return sorted((r[name] for r in df.select(name).collect()), key=repr)


def by_id(df, name="doc_id"):
    return {r[name]: r for r in df.collect()}


def test_licenses(docs, none, spark):
    got = by_id(licenses.license_scan(docs))
    assert len(got) == len({r[0] for r in ROWS})
    assert (got[7]["licenses"], got[7]["notices"], got[7]["n_notices"]) == ("MIT", "MIT", 1)
    assert all(r["licenses"] == r["notices"] == "" for k, r in got.items() if k != 7)
    assert licenses.license_scan(none).count() == 0
    known = spark.createDataFrame([("a", "x"), ("b", "X."), ("c", None), (None, "y"), ("d", "")], "license_id string, text string")
    assert by_id(licenses.license_scan(docs, known))[8]["licenses"] == "a,b"
    whole = "Copyright (c) 2020 Somebody\n" + licenses.KNOWN[0][1].upper().replace(" ", "   ")
    one = spark.createDataFrame([(1, whole)], "doc_id bigint, text string")
    assert by_id(licenses.license_scan(one))[1]["licenses"] == "MIT"


def test_quality(docs, none):
    found = quality.quality_cascade(docs)
    assert ids(found) == IDS
    got = by_id(found)
    assert (got[3]["n_words"], got[4]["n_words"], got[5]["word_chars"]) == (0, 0, 0)
    assert got[9]["n_dup_lines"] == 3 and got[9]["n_repeat_words"] == 32
    assert got[6]["n_words"] > 100_000 and not any(got[k]["kept"] for k in (3, 4, 5))
    assert quality.quality_cascade(none).count() == 0


def test_quality_order_changes_no_verdict():
    texts = quality.texts_of(quality.pa.array([COPY * 9, "a!! b!! " * 40, "AA BB CC " * 30, LONG_TEXT, None]))
    with quality.np.errstate(over="ignore"):
        block = quality.Block(texts)
        names = list(quality.RULES)
        wanted = quality.verdicts(block, quality.RULES, names).tolist()
        assert quality.verdicts(block, quality.RULES, names[::-1]).tolist() == wanted
        assert [bool(all(~quality.RULES[n](block)[i] for n in names)) for i in range(5)] == wanted
    rules = {"cheap": lambda b: b.n_words < 1, "all": lambda b: b.n_words >= 0}
    assert quality.order_of(rules, ["a", "b"])[0] == "all"


def test_minhash(docs, none):
    found = minhash.near_duplicates(docs)
    got = {(r["doc_id"], r["class_id"], r["copy_of"]) for r in found.collect()}
    assert {(1, 1, 1), (2, 1, 1), (3, 3, 3), (4, 4, 4), (5, 5, 5), (6, 6, 6), (None, None, None)} <= got
    assert minhash.near_duplicates(none).count() == 0
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert ids(kept) == sorted([1, 3, 4, 5, 6, 7, 8, 9, None, None], key=repr)
    assert minhash.drop_near_duplicates(none).count() == 0


def test_minhash_keeps_one_of_repeated_rows(spark):
    rows = spark.createDataFrame([(1, COPY)] * 3 + [(2, "other words entirely")], "doc_id bigint, text string")
    assert ids(minhash.drop_near_duplicates(rows)) == [1, 2]


def test_minhash_chain_of_near_copies(spark):
    """Every text is similar to the next one only, and all are one class."""
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(30):
        words[i * 12 : i * 12 + 4] = [f"n{i}x{k}" for k in range(4)]
        rows.append((i, " ".join(words)))
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r["class_id"] for r in found.collect()} == {0}


def test_decontamination(docs, none, items):
    got = by_id(decontaminate.report(docs, items))
    empty = hashlib.sha256(b"").hexdigest()
    assert (got[1]["n_hit"], got[1]["n_items"], got[1]["contaminated"]) == (13, 2, True)
    assert got[1]["items_sha256"] == hashlib.sha256(b"1,5").hexdigest()
    assert (got[8]["n_hit"], got[8]["n_items"]) == (1, 1)
    assert all((got[k]["n_words"], got[k]["items_sha256"], got[k]["contaminated"]) == (0, empty, False) for k in (3, 4, 5))
    assert decontaminate.report(none, items).count() == 0
    assert decontaminate.report(docs, items.where("false")).where("n_hit > 0").count() == 0
    kept = decontaminate.decontaminate(docs, items)
    assert kept.columns == docs.columns and ids(kept) == sorted([3, 4, 5, 6, 7, None], key=repr)
    cut = by_id(decontaminate.remove_passages(docs, items))
    assert (cut[1]["text"], cut[8]["text"], cut[3]["text"]) == ("fourteen", "", None)


def test_decontamination_in_blocks(docs, items):
    """A benchmark in several broadcasts gives what one gives."""
    one = decontaminate.report(docs, items).collect()
    many = decontaminate.report(docs, items, max_windows=1).collect()
    assert sorted(map(repr, one)) == sorted(map(repr, many))


def test_toxicity(docs, none, labels, spark):
    got = toxicity.report(docs, labels)
    assert ids(got) == IDS
    assert all(0 <= r["score"] <= 1 for r in got.collect())
    assert toxicity.report(none, labels).count() == 0
    assert {r["score"] for r in toxicity.report(docs, labels.where("false")).collect()} == {0.0}
    net = toxicity.learn(docs, labels)
    assert toxicity.drop_toxic(docs, net).columns == docs.columns
    same = spark.createDataFrame([(i, COPY, "en") for i in range(50)], "doc_id bigint, text string, lang string")
    assert len({r["s"] for r in toxicity.with_scores(same, net, "s").collect()}) == 1


def test_bpe(docs, none):
    encoded = bpe.encode(docs)
    assert ids(encoded) == IDS
    said = {(r["doc_id"], r["text"]) for r in bpe.decode(encoded).collect()}
    assert said == {(k, t or "") for k, t in ROWS}
    got = by_id(bpe.digests(docs))
    assert got[3]["n_tokens"] == got[4]["n_tokens"] == 0
    assert got[6]["decoded_sha256"] == hashlib.sha256(LONG_TEXT.encode()).hexdigest()
    assert bpe.digests(none).count() == 0


def test_token_files(spark, docs, none):
    found = token_files.round_trip(spark, docs, file_tokens=10).collect()
    assert sorted((r["doc_id"] for r in found), key=repr) == IDS
    ordered = sorted(found, key=lambda r: r["start"])
    assert [r["doc_id"] for r in ordered] == [None, None, 1, 2, 2, 3, 4, 5, 6, 7, 8, 9]
    start = 0
    for r in ordered:
        assert r["start"] == start
        start += r["n_tokens"]
    assert {r["n_tokens"] for r in found if r["doc_id"] in (3, 4)} == {1}
    assert token_files.round_trip(spark, none).count() == 0


def test_line_dedup(docs, none):
    cut = line_dedup.dedupe_lines(docs)
    assert cut.columns == docs.columns
    got = by_id(cut)
    assert got[9]["text"] == "\n".join([COPY, "b", "c"])
    assert (got[3]["text"], got[4]["text"], got[1]["text"]) == (None, "", COPY)
    assert got[6]["text"] == LONG_TEXT
    assert ids(cut) == IDS and line_dedup.report(none).count() == 0


def test_line_dedup_passages_and_overlaps(spark):
    long = " ".join(f"p{i}" for i in range(51))
    short = " ".join(f"q{i}" for i in range(30))
    rows = [
        (1, f"a\n{long}\nb"),
        (2, f"c\n{long}\nd"),
        (3, f"{short}\n{short}!\ne"),
        (4, f"f\n{short}\n{short}!"),
        (5, "k\nk\nk\nk\nk"),
        (6, "1\n2\n3\n4\n5"),
        (7, "2\n3\n4\n5\n6"),
        (8, "\n\n\n\n\n"),
    ]
    got = {k: r["text"] for k, r in by_id(line_dedup.dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string"))).items()}
    assert got == {1: rows[0][1], 2: "c\nd", 3: rows[2][1], 4: "f", 5: "k", 6: rows[5][1], 7: "6", 8: "\n\n\n\n\n"}


def test_line_dedup_two_lines_of_which_one_is_long(spark):
    long = " ".join(f"p{i}" for i in range(60))
    short = " ".join(f"q{i}" for i in range(30))
    rows = [(1, f"a\n{long}\n{short}\nb"), (2, f"c\n{long}\n{short}\nd"), (3, f"e\n{short}\n{long}\nf")]
    got = {k: r["text"] for k, r in by_id(line_dedup.dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string"))).items()}
    assert got == {1: rows[0][1], 2: "c\nd", 3: f"e\n{short}\nf"}


def test_texts_without_words_are_not_toxic(spark, docs, labels):
    net = toxicity.learn(docs, labels)
    net.threshold, net.thresholds = 0.3, {"en": 0.3}
    scored = toxicity.with_scores(docs, net, "s").collect()
    assert {r["s"] for r in scored if r["doc_id"] in (3, 4, 5)} == {0.0}
    kept = toxicity.drop_toxic(docs, net)
    assert {3, 4, 5} <= set(ids(kept)) and kept.where("text is null").count() == 2


def test_convolution_equals_loops():
    random = np.random.default_rng(4)
    net = toxicity.Net.start(random.normal(0, 1, (2, toxicity.BUCKETS)).astype(np.float32))
    net.biases = [random.normal(0, 0.2, len(b)).astype(np.float32) for b in net.biases]
    texts = [random.integers(1, toxicity.BUCKETS, (n, 2)) for n in (1, 2, 3, 9, 40)]
    got = net.scores(*toxicity.padded(np.concatenate(texts), np.array([len(t) for t in texts])))
    for rows, score in zip(texts, got):
        own = np.concatenate([rows, np.zeros((toxicity.PAD, 2), np.int64)])
        word = [np.concatenate([net.tables[0][a], net.tables[1][b]]).astype(float) for a, b in own]
        top = []
        for w, f, bias in zip(toxicity.WIDTHS, net.filters, net.biases):
            for k in range(toxicity.FILTERS):
                values = [bias[k] + sum(word[i + j] @ f[j * len(word[0]) : (j + 1) * len(word[0]), k] for j in range(w)) for i in range(len(rows))]
                top.append(max(0, max(values)))
        assert abs(score - 1 / (1 + np.exp(-(np.array(top) @ net.out + net.out_bias[0])))) < 1e-5


def test_language(docs, none):
    got = language.report(docs)
    assert ids(got) == IDS
    rows = by_id(got)
    assert {rows[k]["lang_pred"] for k in (3, 4, 5)} == {"und"} and rows[1]["lang_pred"] == "en"
    assert language.report(none).count() == 0
    nothing = language.report(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r["lang_pred"], r["score"]) for r in nothing.collect()} == {("und", 0.0)}


def test_cross_parsing_by_hand():
    """Phrases of the table walk against a plain search for longest matches."""
    samples = {"x": "abcabcab cab", "y": "bbba cc a"}
    model = language.build(samples)
    text = "abcabca ccbbb dab"
    costs, _ = model.costs([text])
    for k, sample in enumerate(model.names):
        known, i, phrases = samples[sample], 0, 0
        while i < len(text):
            size = 0
            while i + size < len(text) and text[i : i + size + 1] in known:
                size += 1
            phrases += 1
            i += max(size, 1)
        assert costs[0, k] == pytest.approx(phrases * model.phrase_cost[k])


def plain_parse(symbols, sample):
    """Phrases of a whole text by searching the sample for each longest match."""
    known = "".join(map(chr, sample))
    text, i, phrases = "".join(map(chr, symbols)), 0, 0
    while i < len(text):
        size = 0
        while i + size < len(text) and text[i : i + size + 1] in known:
            size += 1
        phrases += 1
        i += max(size, 1)
    return phrases


@pytest.mark.parametrize("lane", [1, 7, 512])
def test_cross_parsing_of_long_texts(monkeypatch, lane):
    """Texts of many lanes, of letters with and without a symbol of their own, against one plain parse."""
    import random

    draw = random.Random(lane)
    pick = lambda letters, n: "".join(draw.choice(letters) for _ in range(n))
    han = [chr(0x4E00 + 37 * k) for k in range(400)]
    samples = {"a": pick("ab ", 900), "b": "ab" * 400, "c": pick(["de", "abc ", "é"], 300), "h": pick(han, 700)}
    monkeypatch.setattr(language, "LANE", lane)
    model = language.build(samples)
    texts = [pick("ab ", 3000), "ab" * 1500, "b" + "ab" * 1500, "", "x", pick(["de", "abc ", "é", "ж"], 2000), pick(han, 900)]
    texts += [samples["h"][50:90] + "\u9fa5\U00020000" + samples["h"][5:600], samples["c"] * 3, None]
    costs, letters = model.costs(texts)
    symbols, borders = language.symbols_of(texts, model.symbols)
    for k, sample in enumerate(samples.values()):
        own = language.symbols_of([sample], model.symbols)[0].tolist()
        for n, (a, b) in enumerate(zip(borders, borders[1:])):
            assert costs[n, k] == pytest.approx(plain_parse(symbols[a:b].tolist(), own) * model.phrase_cost[k])
    # Letters without a symbol of their own are told apart.
    pairs = [tuple(language.symbols_of([c], model.symbols)[0]) for c in set(samples["h"])]
    assert len(set(pairs)) == len(pairs) and max(map(len, pairs)) == 2 and model.predict([pick(han, 200)])[0] == ["h"]


def test_warc(spark):
    big = "y" * 1000
    rows = [(1, "u 1\n", big), (3, None, big), (2, "u2", big), (3, "u3", big), (4, "u", big[1:]), (5, "u", big[1:])]
    rows += [(6, "u", None), (None, "u", big), (7, "u", "é\r\n\r\nWARC/1.1\r\n"), (8, "u", "z" * 700_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit("x"))
    folder = warc.scratch_path(spark, "warc-test")
    index = warc.write_bundles(pages, folder, frame_bytes=2000)
    found = warc.read_bundles(index, folder).collect()
    assert len(found) == len(rows)
    refs = sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in found), key=repr)
    assert [r for r in refs if r[1] == "revisit"] == [(1, "revisit", 3), (2, "revisit", 3)]
    payload = {r[0]: (r[2] or "").encode() for r in rows}
    for r in found:
        raw = big.encode() if r["page_id"] is None else payload[r["page_id"]]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), hashlib.sha1(raw).hexdigest())
        assert r["payload"] is None or bytes(r["payload"]) == raw
    for entry in index.collect():
        one = warc.read_record(folder, entry["file"], entry["frame"], entry["offset"])
        assert one["page_id"] == entry["page_id"]
    assert warc.round_trip(spark, pages.where("false")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_packed_numbers(n):
    import numpy as np

    numbers = np.random.default_rng(n).integers(0, 1 << np.array([8, 16, 24, 32])[np.arange(n) % 4], dtype=np.uint64)
    control, data = token_files.pack(numbers)
    assert token_files.unpack(control, data, n).tolist() == numbers.tolist()
    assert len(control) == -(-n // 4)


@pytest.mark.parametrize("at", range(len(corpus_pipeline.STAGES)))
def test_stages(spark, docs, none, at):
    name, stage = corpus_pipeline.STAGES[at]
    folder = "/root/testdata/sf0.001"
    for table in (docs, none):
        out = stage(spark, table, folder)
        if at < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == table.columns
            assert [f.dataType for f in out.schema] == [f.dataType for f in table.schema]
        assert (out.count() == 0) == (table is none)
