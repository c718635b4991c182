"""Session settings and the shared folder that written tables live in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Timestamps are instants; rendering and text casts happen in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Bad casts, bad JSON and decimal overflow fail the job instead of becoming NULL.
    "spark.sql.ansi.enabled": "true",
    # A JSON object with a repeated key keeps the last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Runtime re-planning: size-checked broadcast, split of skewed join partitions,
    # coalescing of small ones and splitting of large rebalanced ones before a write.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a join partition once it is three times the median and larger than one task's
    # share (64 MB), rather than five times and 256 MB.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    # A join side whose every partition is within one task's share is hashed; the other, larger
    # side is then not sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Parquet files are several times smaller than their rows in memory; a table is judged
    # small enough to broadcast by the larger figure.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Streaming state lives on disk with changes written to the checkpoint, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# One shuffle partition per this much input.
INPUT_PER_PARTITION = 512 << 20


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library's semantics rest on, and return the session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def estimated_bytes(*frames: DataFrame) -> int:
    """Bytes of what the frames read, by the optimizer's statistics of their sources.

    Sources of unknown size (the optimizer takes them for the largest possible) add nothing.
    """
    sizes = []
    for frame in frames:
        leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes += [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())]
    return sum(size for size in sizes if size < 1 << 60)


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Set the number of shuffle partitions for an input of this size, and return it.

    Partitions are sized before the data is known to be skewed or filtered: adaptive
    execution merges small ones afterwards but cannot make more of them. The number only
    ever rises, in proportion to the input.
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(current, -(-input_bytes // INPUT_PER_PARTITION))
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names, else one in the warehouse.

    Both are shared by contract; a machine-local folder would lose data with the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root.rstrip("/") if root else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def materialized(frame: DataFrame) -> DataFrame:
    """The frame computed once and kept under the shared folder, its lineage cut."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(frame.sparkSession))
    return frame.checkpoint()
