"""Connected components of links, as Spark jobs over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelda.llm.tables import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b): the smallest id that can be reached.

    First the links are contracted: an id keeps one link, to the smallest of its smaller neighbours,
    and the others of these are linked with that one instead. Ids that are nobody's smaller neighbour
    then only follow their own link, and what is left is small where many ids share few neighbours.

    Of the rest, each round takes the smallest label among a node's neighbours and then that label's
    own label, so labels travel twice as far each time. Rounds end when no label changes. A hub
    with very many links is only ever a join key and the subject of a minimum.
    """
    once = links.where("a != b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct()
    once = stored(once, "links-once")
    parents = stored(once.groupBy("hi").agg(F.min("lo").alias("parent")), "parents")
    smaller = stored(once.select(F.col("lo").alias("id")).distinct(), "smaller")
    others = once.join(parents, "hi").where("lo != parent").select(F.col("parent").alias("a"), F.col("lo").alias("b"))
    chains = parents.join(smaller, F.col("hi") == F.col("id"), "left_semi").select(F.col("parent").alias("a"), F.col("hi").alias("b"))
    found = stored(_labels(others.unionByName(chains).distinct()), "inner-labels")
    own = smaller.join(found, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
    leaves = parents.join(smaller, F.col("hi") == F.col("id"), "left_anti")
    follow = leaves.join(found.withColumnRenamed("id", "parent"), "parent", "left").select(
        F.col("hi").alias("id"), F.coalesce("component", "parent").alias("component")
    )
    return stored(own.unionByName(follow), "components")


def _labels(links: DataFrame) -> DataFrame:
    edges = stored(
        links.select("a", "b").union(links.select("b", "a")).where("a != b").distinct(), "edges"
    )
    labels = stored(
        edges.groupBy(F.col("a").alias("id")).agg(F.least(F.col("a"), F.min("b")).alias("component")),
        "labels",
    )
    while True:
        near = (
            edges.join(labels.select(F.col("id").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        joined = labels.join(near, "id").select(
            "id", "component", F.least("component", "near").alias("smaller")
        )
        beyond = labels.select(F.col("id").alias("smaller"), F.col("component").alias("beyond"))
        fresh = stored(
            joined.join(beyond, "smaller").select(
                "id",
                F.least("smaller", "beyond").alias("component"),
                (F.least("smaller", "beyond") < F.col("component")).alias("moved"),
            ),
            "labels",
        )
        labels = fresh.select("id", "component")
        if fresh.where("moved").isEmpty():
            return labels
