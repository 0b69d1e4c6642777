from datetime import date, datetime

import pytest

from kelda.operators.dims import (
    OPEN_END,
    count_unknown,
    date_dim,
    dim_as_of,
    flatten_dim,
    scd2_build,
    scd2_merge,
    surrogate_key,
    unknown_member,
)

T = [datetime(2024, 1, d) for d in range(1, 10)]
LOG = "k int, a string, ts timestamp_ntz, id int"


def history(spark, changes):
    return scd2_build(spark.createDataFrame(changes, LOG), "k", ["a"], "ts", "id")


def test_date_dim(spark):
    days = {r["day"]: r for r in date_dim(spark, date(2020, 12, 27), date(2021, 1, 4)).collect()}
    assert len(days) == 9
    monday, sunday = days[date(2021, 1, 4)], days[date(2021, 1, 3)]
    assert (monday["iso_weekday"], sunday["iso_weekday"]) == (1, 7)
    assert (monday["iso_week"], sunday["iso_week"]) == (1, 53)
    assert (sunday["is_weekend"], monday["is_weekend"]) == (True, False)
    assert (monday["year"], monday["quarter"], monday["month"]) == (2021, 1, 1)


def test_flatten_keeps_members_without_parent(spark, rows):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "c int, p int")
    parent = spark.createDataFrame([(10, "x")], "pk int, name string")
    assert rows(flatten_dim(child, (parent, "p", "pk")), "c", "name") == [(1, "x"), (2, None), (3, None)]


def test_surrogate_keys_are_injective_and_stable(spark):
    values = ["", "N", "V", "V1:a", "1", "1:a", "a", "aV1:a", ":", None, "ä"]
    pairs = [(a, b) for a in values for b in values]
    df = spark.createDataFrame(pairs, "a string, b string")
    keyed = surrogate_key(df, ["a", "b"])
    assert keyed.select("sk").distinct().count() == len(pairs)
    again = surrogate_key(df.repartition(7), ["a", "b"])
    assert keyed.exceptAll(again).isEmpty()


@pytest.mark.parametrize(
    "changes, expected",
    [
        ([], []),
        ([(1, "x", T[0], 1)], [(1, "x", T[0], OPEN_END)]),
        # a change that changes nothing
        ([(1, "x", T[0], 1), (1, "x", T[1], 2)], [(1, "x", T[0], OPEN_END)]),
        # back to an earlier value
        (
            [(1, "x", T[0], 1), (1, "y", T[1], 2), (1, "x", T[2], 3)],
            [(1, "x", T[0], T[1]), (1, "x", T[2], OPEN_END), (1, "y", T[1], T[2])],
        ),
        # same instant: the highest id counts
        ([(1, "x", T[0], 2), (1, "y", T[0], 1)], [(1, "x", T[0], OPEN_END)]),
        # null is a value
        (
            [(1, None, T[0], 1), (1, "x", T[1], 2), (1, None, T[2], 3), (1, None, T[3], 4)],
            [(1, "x", T[1], T[2]), (1, None, T[0], T[1]), (1, None, T[2], OPEN_END)],
        ),
    ],
)
def test_history(spark, rows, changes, expected):
    assert rows(history(spark, changes)) == expected


def test_late_change_revives_a_dropped_one(spark, rows):
    log = spark.createDataFrame([(1, "A", T[0], 1), (1, "A", T[2], 2), (2, "Z", T[0], 3)], LOG)
    late = spark.createDataFrame([(1, "B", T[1], 4)], LOG)
    dim = scd2_build(log, "k", ["a"], "ts", "id")
    merged = scd2_merge(dim, log, late, "k", ["a"], "ts", "id")
    assert rows(merged) == rows(scd2_build(log.union(late), "k", ["a"], "ts", "id"))
    assert rows(merged.where("k = 1"), "a") == [("A",), ("A",), ("B",)]
    # The same batch once more changes nothing.
    again = scd2_merge(merged, log.union(late), late, "k", ["a"], "ts", "id")
    assert rows(again) == rows(merged)


def test_as_of_at_the_borders(spark, rows):
    dim = spark.createDataFrame(
        [(1, "x", T[1], T[3]), (1, "y", T[4], OPEN_END)],
        "k int, a string, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )
    facts = spark.createDataFrame(
        [(i, 1, t) for i, t in enumerate(T[:6])] + [(9, 2, T[2])], "f int, k int, ts timestamp_ntz"
    )
    found = dim_as_of(facts, dim, "k", "ts")
    expected = [(0, None), (1, "x"), (2, "x"), (3, None), (4, "y"), (5, "y"), (9, None)]
    assert rows(found, "f", "a") == expected


def test_unknown_member(spark, rows):
    fact = spark.createDataFrame([(1, 10), (2, 77), (3, None)], "f int, k int")
    dim = spark.createDataFrame([(10,), (11,)], "k2 int")
    resolved = unknown_member(fact, dim, "k", "k2")
    assert rows(resolved, "f", "k", "k_source", "is_unknown") == [
        (1, 10, 10, False),
        (2, -1, 77, True),
        (3, -1, None, True),
    ]
    assert rows(count_unknown(resolved)) == [(3, 2)]
