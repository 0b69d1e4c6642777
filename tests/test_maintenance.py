import csv
import random
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelda.operators.maintenance import apply_cdc, dedupe_latest, json_fields, snapshot_diff, upsert
from kelda.sources.landing import land, write_partitions
from kelda.sources.scratch import scratch_path

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
    ]
)


def test_land_json(spark, tmp_path, rows):
    lines = [
        '{"id": 1, "name": "a", "ts": "2024-01-01T00:00:00.123456"}',
        '{"id": 2, "extra": true}',
        '{"id": "no number"}',
        "",
        '{"id": 3, "na',
    ]
    (tmp_path / "in.json").write_text("\n".join(lines))
    good, bad = land(spark, str(tmp_path), SCHEMA, "json")
    assert rows(good, "id", F.col("ts").cast("string")) == [(1, "2024-01-01 00:00:00.123456"), (2, None)]
    assert rows(bad) == [("",), ('{"id": "no number"}',), ('{"id": 3, "na',)]


def test_land_csv(spark, tmp_path, rows):
    lines = [
        "id,name,ts",
        '1,"a,b",2024-01-01T00:00:00.000001',
        "x,y,z",
        "2",
        "3,c,",
        "",
        '4,"say ""hi"", ok",',
        '5,"open',
        'end",',
        "   ",
    ]
    (tmp_path / "in.csv").write_text("\n".join(lines))
    (tmp_path / "more.csv").write_text("id,name,ts\n6,d,\nid,name,ts")
    good, bad = land(spark, str(tmp_path), SCHEMA, "csv", header=True)
    assert rows(good, "id", "name") == [(1, "a,b"), (3, "c"), (4, 'say "hi", ok'), (6, "d")]
    # Of a file's lines that equal the header one is the header.
    assert rows(bad) == sorted([("",), ("   ",), ("2",), ('5,"open',), ('end",',), ("id,name,ts",), ("x,y,z",)], key=repr)
    assert good.count() + bad.count() == len(lines) - 1 + 2


@pytest.mark.parametrize("size", [30, 64, 1 << 20])
def test_csv_records_across_ranges(spark, tmp_path, rows, size):
    """One file in many byte ranges, quoted breaks, commas and doubled quotes at any place of them."""
    draw = random.Random(size)
    pieces = ["a", "", '"', '""', "\n", "\n\n", ",", 'x"y', " ", "\r\n", "ü", "long " * 9, '"\n"']
    for ending in ("\n", "\r\n"):
        table = [(str(k), "".join(draw.choices(pieces, k=draw.randint(0, 6))), "") for k in range(40)]
        name = tmp_path / f"{len(ending)}"
        name.mkdir()
        with open(name / "in.csv", "w", newline="", encoding="utf-8") as file:
            out = csv.writer(file, lineterminator=ending, quoting=csv.QUOTE_ALL if size == 64 else csv.QUOTE_MINIMAL)
            out.writerow(("id", "name", "ts"))
            out.writerows(table)
        keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
        before = {k: spark.conf.get(k) for k in keys}
        for k in keys:
            spark.conf.set(k, str(size))
        try:
            ranges = spark.read.text(str(name)).select("_metadata.file_block_start").distinct().count()
            assert ranges >= 8 or size > 1000
            good, bad = land(spark, str(name), SCHEMA, "csv", header=True, multiline=True)
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
        got = {r["id"]: r["name"] or "" for r in good.collect()}
        tidy = lambda x: x.replace("\r\n", "\n")
        assert {k: tidy(v) for k, v in got.items()} == {int(k): tidy(v) for k, v, _ in table}
        assert bad.count() == 0


def test_csv_records_open_at_the_end_and_many_files(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('id,name,ts\n\n1,"a\nb",\n2,"open\n3,c,')
    (tmp_path / "b.csv").write_text('\nid,name,ts\n4,"d\n\n\n",\n')
    (tmp_path / "c.csv").write_text("")
    good, bad = land(spark, str(tmp_path), SCHEMA, "csv", header=True, multiline=True)
    assert rows(good, "id", "name") == [(1, "a\nb"), (4, "d\n\n\n")]
    assert rows(bad) == [('2,"open\n3,c,',)]


def test_csv_records_with_another_escape(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('1,"a \\" b\nc",\n2,"x",\n')
    good, bad = land(spark, str(tmp_path), SCHEMA, "csv", multiline=True, escape="\\")
    assert rows(good, "id", "name") == [(1, 'a " b\nc'), (2, "x")] and bad.count() == 0


def test_land_csv_with_line_breaks(spark, tmp_path, rows):
    (tmp_path / "in.csv").write_text('id,name,ts\n1,"a\n""b"", c",\n\n2,x\n3,y,\n')
    good, bad = land(spark, str(tmp_path), SCHEMA, "csv", header=True, multiline=True)
    assert rows(good, "id", "name") == [(1, 'a\n"b", c'), (3, "y")]
    assert [r[0].strip() for r in bad.collect()] == ["2,x"]


def test_null_keys_and_operations(spark, rows):
    current = spark.createDataFrame([(None, "old", 1), (1, "a", 1)], "k int, v string, o int")
    changes = spark.createDataFrame([(None, "new", 2)], "k int, v string, o int")
    assert rows(upsert(current, changes, ["k"], ["o"])) == [(1, "a", 1), (None, "new", 2)]
    feed = spark.createDataFrame([(1, "b", 3, None), (None, "x", 3, "D")], "k int, v string, o int, op string")
    assert rows(apply_cdc(current, feed, ["k"], "op", "o")) == [(1, "b", 3)]


def test_write_partitions_twice_is_once(spark, rows):
    path = scratch_path(spark, "parts")
    days = spark.sql("SELECT id, date_add(date'2024-01-01', cast(id % 3 as int)) AS day FROM range(9)")
    write_partitions(days, path, "day")
    change = days.where("day = '2024-01-02'").withColumn("id", F.col("id") + 100)
    write_partitions(change, path, "day")
    write_partitions(change, path, "day")
    table = spark.read.schema(days.schema).parquet(path)
    assert table.count() == 9
    assert rows(table.where("day = '2024-01-02'"), "id") == [(101,), (104,), (107,)]
    assert rows(table.where("day = '2024-01-01'"), "id", "day")[0] == (0, date(2024, 1, 1))


def test_upsert(spark, rows):
    current = spark.createDataFrame([(1, "a", 5), (2, "b", 5), (3, "c", 5)], "k int, v string, o int")
    changes = spark.createDataFrame(
        [(1, "old", 4), (2, "tie", 5), (3, "x", 6), (3, "y", 7), (4, "new", 1)], "k int, v string, o int"
    )
    merged = upsert(current, changes, ["k"], ["o"])
    assert rows(merged) == [(1, "a", 5), (2, "tie", 5), (3, "y", 7), (4, "new", 1)]
    assert rows(upsert(merged, changes, ["k"], ["o"])) == rows(merged)
    assert rows(upsert(current, changes.limit(0), ["k"], ["o"])) == rows(current)


def test_cdc(spark, rows):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    feed = spark.createDataFrame(
        [(2, "x", "U", 9), (2, "gone", "D", 8), (3, "late", "U", 1), (3, "c", "D", 2), (4, "n", "I", 3), (5, "-", "D", 4)],
        "k int, v string, op string, seq int",
    )
    assert rows(apply_cdc(base, feed, ["k"], "op", "seq")) == [(1, "a"), (2, "x"), (4, "n")]


def test_snapshot_diff_with_nulls(spark, rows):
    old = spark.createDataFrame([(1, None, 2), (2, "b", 2), (3, "c", 1), (None, "n", 1)], "k int, v string, w int")
    new = spark.createDataFrame([(1, None, 2), (2, None, 2), (4, None, None), (None, "n", 1)], "k int, v string, w int")
    expected = [(1, "same"), (2, "update"), (3, "delete"), (4, "insert"), (None, "same")]
    assert rows(snapshot_diff(old, new, ["k"])) == expected


def test_dedupe_is_total(spark, rows):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, None, "z"), (2, None, "q")], "k int, o int, v string")
    assert rows(dedupe_latest(df, ["k"], ["o", "v"])) == [(1, 5, "b"), (2, None, "q")]


def test_json_fields(spark, rows):
    df = spark.createDataFrame([(1, '{"k": 3, "other": 1}'), (2, "{"), (3, None), (4, "{}")], "id int, props string")
    parsed = json_fields(df, "props", T.StructType.fromDDL("k int"))
    assert rows(parsed, "id", "k", "props_corrupt") == [(1, 3, None), (2, None, "{"), (3, None, None), (4, None, None)]


def test_scratch_needs_a_shared_folder(spark):
    class Conf:
        def get(self, name):
            return None

    class Context:
        master = "spark://somewhere"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        scratch_path(Session(), "x")
