"""The pipeline against a brute-force version, stage by stage on what the stage before kept."""

import hashlib

import corpus_pipeline
from kelda.llm import toxicity
from kelda.llm.tables import fold, stored, table
from tests.llm.common import benchmark_hits, kept_lines, near_classes

FOLDER = "/root/testdata/sf0.01"


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_pipeline_equals_brute_force(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = table(spark, FOLDER, "documents")
    stages = dict(corpus_pipeline.STAGES)

    labels = table(spark, FOLDER, "labels")
    net = toxicity.learn(docs, labels.where(fold("doc_id", 5) != 0))
    scored = toxicity.with_scores(docs, net, "s").collect()
    wanted = {r["doc_id"]: r["text"] for r in scored if r["s"] < net.thresholds.get(r["lang"], net.threshold)}
    first = stored(stages["toxicity"](spark, docs, FOLDER), "t")
    assert texts(first) == wanted and 0 < len(wanted) < len(scored)

    lines = kept_lines(texts(first))
    second = stored(stages["line_dedup"](spark, first, FOLDER), "l")
    assert texts(second) == {k: "\n".join(v) for k, v in lines.items() if v}
    assert all(r["n_chars"] == len(r["text"]) for r in second.collect())

    classes = near_classes(texts(second))
    third = stored(stages["minhash"](spark, second, FOLDER), "m")
    assert texts(third) == {k: t for k, t in texts(second).items() if classes[k] == k}

    hits = benchmark_hits(texts(third), texts(table(spark, FOLDER, "benchmark").withColumnRenamed("item_id", "doc_id")))
    fourth = stored(stages["decontamination"](spark, third, FOLDER), "d")
    clean = {k for k, (hit, words) in hits.items() if not (hit and 20 * hit >= words)}
    assert texts(fourth) == {k: t for k, t in texts(third).items() if k in clean}

    last = {r["doc_id"]: r["ids_sha256"] for r in stages["bpe"](spark, fourth, FOLDER).collect()}
    for key, text in texts(fourth).items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert last.pop(key) == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert not last
    assert corpus_pipeline.run(spark, FOLDER).count() == fourth.count()
