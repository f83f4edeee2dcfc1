"""Session defaults and the shared scratch folder.

Scratch output always goes under the cluster's ``spark.checkpoint.dir`` (a shared
folder every executor can reach). Only when the session has none, as in local tests,
do we pick one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # Spark 4.1: a union of hash-partitioned join outputs with different partition counts
    # that feeds another join on the same key fails to plan ("PartitioningCollection
    # requires all of its partitionings have the same numPartitions" / "Can't zip RDDs").
    # Chained upserts and snapshot merges build exactly that shape.
    "spark.sql.unionOutputPartitioning": "false",
}

# The most that one task takes of a job in a session of its own (see ``sized_session``).
# A row of two or three ids has 8 bytes in a shuffle and 100 to 200 in a sort or a hash map, so
# that Spark's 64 MB of a shuffle are over 7 million rows and 1.6 GB of a task's memory.
TASK_ROWS = 200_000
TASK_SHUFFLE_MB = 8
TASK_FILE_MB = 32


def get_session(master: str | None = None, app: str = "linkmart", **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder named by the session; set a local one only when unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="linkmart-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    return f"{checkpoint_base(spark)}/linkmart/{name}-{uuid.uuid4().hex[:12]}"


def guard_union_partitioning(spark: SparkSession) -> None:
    """Apply the union output-partitioning workaround (see DEFAULT_CONF) to a session the
    library did not create. The setting stays for the session: plans are made lazily,
    after this returns."""
    if spark.conf.get("spark.sql.unionOutputPartitioning", "true") != "false":
        spark.conf.set("spark.sql.unionOutputPartitioning", "false")


def sized_session(spark: SparkSession, rows: int, own: SparkSession | None = None) -> SparkSession:
    """A session beside ``spark`` (``own``, if there is one) whose tasks do not grow with the input: as
    many shuffle partitions as ``rows`` records need, which AQE merges up to ``TASK_SHUFFLE_MB`` only,
    and file splits of ``TASK_FILE_MB``. Every other setting is that of ``spark``, which keeps its own;
    where it asks for more partitions or smaller ones, that holds."""
    own, asked = own or spark.newSession(), spark.conf.getAll
    conf = {k: v for k, v in asked.items() if own.conf.isModifiable(k) or not k.startswith("spark.")}
    parts, first = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    for k in (parts, first) if first in asked else (parts,):
        conf[k] = str(max(int(spark.conf.get(k)), -(-rows // TASK_ROWS)))
    for k, mb in (("spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_SHUFFLE_MB), ("spark.sql.files.maxPartitionBytes", TASK_FILE_MB)):
        if k not in asked or _bytes(spark, asked[k]) > mb << 20:
            conf[k] = f"{mb}m"
    for k, v in conf.items():
        if own.conf.get(k, None) != v:
            own.conf.set(k, v)
    return own


#: Spark keeps what an execution shuffled until the driver collects its garbage; this deletes it at once.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
CODEC = "spark.sql.parquet.compression.codec"


@contextmanager
def spare_disk(spark: SparkSession) -> Iterator[None]:
    """For a job of many steps, each read back from what the one before wrote: the shuffles of a step
    go when it ends, and tables are written with zstd where ``spark`` names no codec. Its settings
    are as they were afterwards. A frame that is executed twice within would shuffle twice."""
    asked = spark.conf.getAll
    own = {DROP_SHUFFLES: "true"} | ({} if CODEC in asked else {CODEC: "zstd"})
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in own:
            spark.conf.set(k, asked[k]) if k in asked else spark.conf.unset(k)


def _bytes(spark: SparkSession, size: str) -> int:
    """A size as Spark's settings have it (``16m``), in bytes."""
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)
