"""Session helpers: defaults for local runs, the shared scratch folder, input spreading."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(name: str = "quire", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own session."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        # Small data on one machine: pieces small enough for every core to get some.
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers, once per application.

    Not needed where it is installed on the workers or submitted with ``--py-files``.
    """
    context = spark.sparkContext
    if not any(name.startswith("quire-") and name.endswith(".zip") for name in context._python_includes):
        folder = Path(__file__).parent
        target = Path(tempfile.mkdtemp(prefix="quire-ship-")) / f"quire-{uuid.uuid4().hex[:8]}.zip"
        with zipfile.ZipFile(target, "w") as archive:
            for source in sorted(folder.rglob("*.py")):
                archive.write(source, source.relative_to(folder.parent))
        context.addPyFile(str(target))
    return spark


@cache
def _single_machine_dir(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="quire-")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only where that is
    unset, on a single machine as in tests, a temporary folder of the application is taken.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        base = _single_machine_dir(spark.sparkContext.applicationId)
    return f"{base.rstrip('/')}/quire/{purpose}-{uuid.uuid4().hex[:12]}"


SPREAD_BELOW_BYTES = 4 << 30


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy row-local work at least one input partition per core.

    A table in a few unsplittable row groups would leave most cores idle; it is small by
    the same token, so one round-robin exchange is cheap. Anything estimated at more than a
    few GiB, or with enough partitions already, is returned unchanged and is never shuffled.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > SPREAD_BELOW_BYTES:
        return df
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)
