"""Session defaults and the shared folder for intermediate tables."""

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Adaptive execution does the size checks: it broadcasts a join side only under the threshold,
# splits skewed join partitions, and sizes shuffle and write partitions from what was really
# shuffled. Nothing in the library hints a broadcast.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Documents are wide rows; ``bounded_batches`` bounds bytes as well, wherever payloads or texts cross to Python.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def local_session(app: str = "docquarry", cpus: int | str = "*", memory: str = "8g") -> SparkSession:
    """A session on this machine, for tests and the bench. A cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder, on storage all executors see, for one run's intermediate tables.

    The cluster names the root in ``spark.checkpoint.dir``. Only a local session may fall back
    to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="docquarry-")
    return os.path.join(root, f"{label}-{uuid.uuid4().hex}")


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by rows and bytes; 10,000 wide documents would be too much for a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_SPLIT = "spark.sql.files.maxPartitionBytes"
#: Compressed bytes of a shuffled partition, or of a split of files, of narrow rows.
NARROW_PARTITION = 16 << 20


def narrow_partitions(spark: SparkSession) -> None:
    """Let adaptive execution make partitions, and scans make splits, of at most ``NARROW_PARTITION`` compressed bytes.

    Rows of short strings, as quads, take ten to twenty times their compressed size in a sort: a partition of the usual
    64 MB, or sets made of the rows of a split of 128 MB, would not fit into a task's memory and be spilled. A smaller
    setting of the cluster stays.
    """
    for key in (_ADVISORY, _SPLIT):
        number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", spark.conf.get(key).strip().lower()).groups()
        if int(number) << 10 * " kmgtp".index(unit or " ") > NARROW_PARTITION:
            spark.conf.set(key, str(NARROW_PARTITION))


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a write go when it ends (Spark 4.1; older versions do not know the setting).

    Otherwise they stay until the driver happens to collect its garbage, and those of all steps of a job lie on the
    disks at once. A write has a plan of its own, so nothing else reads them; a frame's own plan keeps its files.
    """
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
