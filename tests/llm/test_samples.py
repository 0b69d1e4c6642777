"""Samples for learning are bounded in rows, whatever ids are null or repeated."""

from pyspark.sql import functions as F

from kelda.llm import language, toxicity
from kelda.llm.tables import bounded_sample


def test_sample_with_null_and_repeated_ids(spark):
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.lit(77)).otherwise(F.col("id")).alias("id"),
        F.concat(F.lit("text "), (F.col("id") % 4500).cast("string")).alias("text"),
        F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("kind"),
    )
    got = bounded_sample(rows, "kind", "id", 64, "text").collect()
    for kind in ("x", "y"):
        own = [r for r in got if r["kind"] == kind]
        assert len(own) == 64 == len({(r["id"], r["text"]) for r in own})
        # Null, repeated and single ids are a third each.
        for part in (lambda k: k is None, lambda k: k == 77, lambda k: k not in (None, 77)):
            assert 8 <= sum(part(r["id"]) for r in own) <= 36
    again = bounded_sample(rows.repartition(7), "kind", "id", 64, "text").collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_sample_of_few_and_equal_rows(spark):
    rows = spark.range(500).select(F.lit(5).alias("id"), F.lit("same").alias("text"), F.lit("x").alias("kind"))
    assert bounded_sample(rows, "kind", "id", 64, "text").count() == 1
    assert bounded_sample(rows.limit(0), "kind", "id", 64, "text").count() == 0


def test_toxicity_learns_one_text_of_an_id(spark, monkeypatch):
    docs = spark.range(400).select(
        F.when(F.col("id") < 300, 1).otherwise(F.col("id")).alias("doc_id"),
        F.concat(F.lit("some words of text "), F.col("id").cast("string")).alias("text"),
    )
    labels = docs.select("doc_id").distinct().withColumn("toxic", (F.col("doc_id") % 2).cast("int"))
    seen = []
    monkeypatch.setattr(toxicity.np, "frombuffer", lambda raw, *a, _f=toxicity.np.frombuffer, **k: seen.append(1) or _f(raw, *a, **k))
    toxicity.learn(docs, labels)
    assert len(seen) == 101


def test_shares():
    texts = ["a" * 10, "b" * 1000, "c" * 100, "d" * 5000]
    assert [len(t) for t in language.shares(texts, 700)] == [10, 295, 100, 295]
    assert language.shares(texts, 10**6) == texts
    assert language.shares([], 5) == [] and [len(t) for t in language.shares(["xx"] * 3, 2)] == [1] * 3


def test_toxicity_learns_from_every_row(spark):
    """A word that few labelled rows hold, and one behind 7,000 others, count with the driver and with shards."""
    odd = F.when(F.col("id") % 3 == 0, F.concat(F.lit("vile"), (F.col("id") % 90).cast("string"), F.lit(" talk"))).otherwise("kind talk")
    long = F.when(F.col("id") % 300 == 1, F.concat(F.repeat(F.lit("kind "), 7000), F.lit("hideous")))
    docs = spark.range(9000).select(
        F.col("id").alias("doc_id"),
        F.coalesce(long, F.concat(odd, F.lit(" and words "), (F.col("id") % 11).cast("string"))).alias("text"),
        F.lit("x").alias("lang"),
    )
    labels = docs.select("doc_id", F.coalesce((F.col("doc_id") % 3 == 0) | (F.col("doc_id") % 300 == 1), F.lit(False)).cast("int").alias("toxic"))
    nets = [toxicity.learn(docs, labels, few_rows=few, shard_rows=4000) for few in (9000, 10)]
    asked = spark.createDataFrame([(f"vile{k} talk",) for k in range(0, 90, 3)] + [("kind talk hideous",), ("kind talk",)], "text string")
    for net in nets:
        scores = {r["text"]: r["s"] for r in toxicity.with_scores(asked, net, "s").collect()}
        assert scores.pop("kind talk") < 0.5 and min(scores.values()) > 0.5, scores
        assert "x" in net.thresholds
    again = toxicity.learn(docs.repartition(5), labels.repartition(3), few_rows=10, shard_rows=4000)
    assert (again.tables == nets[1].tables).all() and again.thresholds == nets[1].thresholds


def test_toxicity_takes_one_python_worker_a_task(spark, monkeypatch):
    """No two Python passes of learning stand in one task: each would hold memory in a worker of its own."""
    rows = spark.range(300).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"), (F.col("id") % 2).alias("toxic")
    )
    plans, added_up = [], toxicity._added_up

    def seen(pieces, add):
        plans.append(pieces._jdf.queryExecution().executedPlan().toString())
        return added_up(pieces, add)

    monkeypatch.setattr(toxicity, "_added_up", seen)
    assert toxicity.learn(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"), few_rows=10)
    assert len(plans) == 2
    for plan in plans:
        assert "MapInArrow" in plan and all(task.count("MapInArrow") <= 1 for task in plan.split("Exchange"))
