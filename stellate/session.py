"""Session construction and shared-storage locations."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Settings every stellate job relies on. Adaptive execution does the runtime
# re-planning (coalescing small shuffle partitions, turning a join into a
# broadcast join only once the materialised side is measured below the
# threshold, splitting skewed join partitions).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove checkpoint files once the checkpointed frame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "stellate",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings the mart expects.

    ``master`` is only set when given, so on a cluster the launcher decides.
    ``shuffle_partitions`` should follow the data: roughly total shuffle bytes
    / 128 MB on a cluster, the core count on a laptop. AQE coalesces from
    there, so erring high is cheap.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder on the cluster's shared storage for written tables.

    The root is ``spark.checkpoint.dir`` as the cluster sets it. When that is
    unset the SQL warehouse folder serves, but a warehouse on a local disk
    only with a local master: executors on other hosts must see the files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001  (Spark Connect)
            root = None
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        master = spark.conf.get("spark.master", "")
        if (root.startswith("file:") or "://" not in root) and not master.startswith("local"):
            raise ValueError(
                "set spark.checkpoint.dir to a folder all executors share: it is unset, and the"
                f" warehouse folder {root} is on a local disk"
            )
    return "/".join([root.rstrip("/"), *parts])


def default_parallelism(spark: SparkSession) -> int:
    """The cluster's default parallelism (shuffle partitions where it is not exposed)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001  (Spark Connect sessions have no SparkContext)
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Point ``SparkContext.setCheckpointDir`` at the configured shared folder.

    Only sets a folder when the session has none, as in tests. On Spark
    Connect the server's ``spark.checkpoint.dir`` applies and nothing is set.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    target = shared_dir(spark, "checkpoints")
    if target.startswith("file:"):
        os.makedirs(target[len("file:"):], exist_ok=True)
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir()


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def plan_bytes(df: DataFrame) -> int:
    """Bytes of the sources ``df`` reads: the sum over its plan's leaf scans.

    A file scan's estimate is its size on disk. Estimates above the leaves
    are not used: without cost-based statistics a join's estimate is the
    product of its inputs'.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
    total = 0
    while leaves.hasNext():
        total += int(str(leaves.next().stats().sizeInBytes()))
    return total


def size_shuffle_partitions(
    spark: SparkSession,
    inputs: list[DataFrame],
    target_bytes: int = TARGET_PARTITION_BYTES,
) -> int:
    """Start adaptive execution's shuffles with enough partitions for the inputs.

    AQE only merges partitions, never splits a too-large one (skew joins
    aside), so the starting count must be high enough for the largest
    shuffle: the inputs' size on disk / ``target_bytes``, at least the
    cluster's parallelism. AQE then coalesces down to ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.

    Set only when the launcher has not set the starting count itself; returns
    the count in force.
    """
    current = spark.conf.get(INITIAL_PARTITIONS, None)
    if current:
        return int(current)
    try:
        total = sum(plan_bytes(df) for df in inputs)
    except Exception:  # noqa: BLE001  (Spark Connect: no plan statistics here)
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    wanted = -(-total // target_bytes)
    n = max(default_parallelism(spark), wanted)
    spark.conf.set(INITIAL_PARTITIONS, str(n))
    return n
