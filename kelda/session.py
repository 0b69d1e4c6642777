"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settable on a running session, so they also hold on a session somebody else built.
RUNTIME_SETTINGS = {
    # Tables carry zone-less times; streams need zoned ones. UTC makes the two agree.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even if the next step then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # State may outgrow executor memory.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # Merge a batch's sessions before the shuffle too, as partial aggregation does for groups.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for name, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once for an application.

    Workers that cannot import it from where they run need it (as ``--py-files`` does).
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).parent
    path = Path(tempfile.mkdtemp(prefix="kelda-code-")) / "kelda_code.zip"
    with zipfile.ZipFile(path, "w") as packed:
        for module in sorted([*root.rglob("*.py"), *root.rglob("*.txt")]):
            packed.write(module, f"{root.name}/{module.relative_to(root)}")
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)


def local_session(
    cpus: int | str = 8, app: str = "kelda", **extra: str
) -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cpus) if cpus != "*" else "8")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for name, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
