"""Reading the corpus tables, stored intermediate results, and small shared expressions."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import kelda
from kelda.session import prepare
from kelda.sources.landing import publish
from kelda.sources.scratch import scratch_path

# Rows and bytes of text handed to Python at once; a batch of very long texts is cut by bytes.
ARROW_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


#: Parts of a class that are cut to the sample's size on their own.
SAMPLE_PARTS = 256

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once for an application.

    Workers that cannot import the package from where they run need it (as ``--py-files`` does).
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(kelda.__file__).parent
    path = Path(tempfile.mkdtemp(prefix="kelda-code-")) / "kelda_code.zip"
    with zipfile.ZipFile(path, "w") as packed:
        for module in sorted([*root.rglob("*.py"), *root.rglob("license_texts/*.txt")]):
            packed.write(module, f"kelda/{module.relative_to(root)}")
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table; its schema is in its files."""
    prepare(spark)
    ship(spark)
    for key, value in ARROW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: For rows of some MB each: else Parquet looks at sizes after 100 rows for the first time, and a task's rows
#: make one page that is read, uncompressed and copied whole.
LONG_ROWS = {
    "parquet.page.size.row.check.min": "1",
    "parquet.block.size.row.check.min": "1",
    "parquet.block.size": str(8 << 20),
}


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows written once to the cluster's shared folder and read back."""
    return publish(df, scratch_path(df.sparkSession, name), **options)


def fold(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``: the row's fold for learning and holding out."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


def fresh_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that no column of the table has, in any case."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in wanted:
        name = f"_{name}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def quoted(columns: list[str]) -> list[Column]:
    """Columns by their literal names, whatever characters those hold."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in columns]


def bounded_sample(rows: DataFrame, by: str, key: str, size: int, *also: str) -> DataFrame:
    """At most ``size`` rows of each class of ``by``: those of the smallest hashes of ``key`` and the
    columns ``also``, one row for all that are equal in these. Nulls of ``by`` belong to no class.

    Hashes are ranked alone, cut to ``size`` in each of ``SAMPLE_PARTS`` parts of a class before these meet, so a
    class is one task's for ``SAMPLE_PARTS`` times ``size`` hashes at most; only rows with a chosen one are moved.
    """
    place, nth = fresh_names(rows, "place", "nth")
    placed = rows.where(F.col(by).isNotNull()).withColumn(place, F.xxhash64(key, *also))
    part = F.pmod(F.col(place), F.lit(SAMPLE_PARTS))
    ranked = placed.select(by, place).distinct()
    for window in (Window.partitionBy(by, part), Window.partitionBy(by)):
        ranked = ranked.withColumn(nth, F.row_number().over(window.orderBy(place))).where(F.col(nth) <= size)
    chosen = stored(ranked.select(by, place), "sampled-places")
    return placed.join(chosen, [by, place], "left_semi").dropDuplicates([by, place]).select(quoted(rows.columns))
