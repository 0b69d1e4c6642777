"""Registered queries against their SQL, a brute-force version, a round trip or held-out rows."""

import hashlib
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from kelda.llm import plans
from tests.llm.common import connect, near_classes, same_rows

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def texts(spark, folder):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}


@pytest.mark.parametrize("name", list(plans.SQL))
def test_sql(spark, sf_dir, con, name):
    assert same_rows(plans.QUERIES[name](spark, sf_dir), plans.SQL[name], con) == []


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in plans.QUERIES) == list(range(1, 14))


def test_op3_equals_brute_force(spark, sf_dir):
    got = {r["doc_id"]: r for r in plans.QUERIES["op3_minhash"](spark, sf_dir).collect()}
    wanted = near_classes(texts(spark, sf_dir))
    assert {k: r["class_id"] for k, r in got.items()} == wanted
    assert {k for k, r in got.items() if r["kept"]} == set(wanted.values())


def test_op5_held_out(spark):
    folder = "/root/testdata/sf0.1"
    scored = plans.QUERIES["op5_toxicity"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    right = [r for r in rows if r["predicted"] == r["label"]]
    toxic = [r for r in rows if r["label"] == 1]
    assert len(right) > 0.96 * len(rows)
    assert sum(r["predicted"] for r in toxic) > 0.7 * len(toxic)
    folds = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows}
    assert all(folds.values())


def test_op6_equals_the_library(spark, sf_dir, tokenizer):
    got = {r["doc_id"]: r for r in plans.QUERIES["op6_bpe"](spark, sf_dir).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for key, text in texts(spark, sf_dir).items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        said = tokenizer.decode(ids, skip_special_tokens=False)
        row = got.pop(key)
        assert (row["n_tokens"], row["ids_sha256"]) == (len(ids), sha(",".join(map(str, ids))))
        assert row["decoded_sha256"] == sha(said)
    assert not got


def test_op7_equals_the_library(spark, sf_dir, tokenizer):
    got = {r["doc_id"]: tuple(r)[1:] for r in plans.QUERIES["op7_token_files"](spark, sf_dir).collect()}
    start, wanted = 0, {}
    for key, text in sorted(texts(spark, sf_dir).items()):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        wanted[key] = (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    assert got == wanted


def test_op9_held_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = plans.QUERIES["op9_language_id"](spark, sf_dir).join(docs, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {
        r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
    }
    assert sum(r["lang"] == r["lang_pred"] for r in held) > 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_native_queries_run_no_python(spark):
    for name in ("op1_license_scan", "op8_line_dedup"):
        plan = plans.QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()
        assert "MapInArrow" not in plan and "Python" not in plan and "CartesianProduct" not in plan
