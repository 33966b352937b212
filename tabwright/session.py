"""Session construction and shared-folder helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every tabwright job relies on.  Timestamps in the inputs are written without a zone
# (they load as TIMESTAMP_NTZ), but the session zone is pinned anyway so no result depends on
# the machine.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tabwright",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (the cluster supplies its own session)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf.update({
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "16g",
        "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
    })
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting must name a shared file system; without it this raises, because a
    machine's own temp folder would be invisible to the other executors.  A single-machine session
    (master ``local`` or ``local[...]``, as in tests) gets a fresh folder under the temp dir."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 — a session without a local SparkContext (remote client)
        sc = None
    path = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not path:
        master = sc.master if sc else ""
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for written intermediates")
        path = tempfile.mkdtemp(prefix="tabwright-ckpt-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)  # ours alone, made just now
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return spark.conf.get("spark.checkpoint.dir", None) or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder for a written intermediate."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tabwright/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared checkpoint folder.  Later jobs read
    the written copy instead of re-running the plan behind it, and survive executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def laid_out(df: DataFrame, key: str, written: bool = False) -> DataFrame:
    """A copy in a number of partitions that follows from its rows, by key and sorted inside them.  Bagging in Spark ML
    draws by partition and row order, so a model fitted on this copy is the same on any cluster.  Partitions
    hold 10,000 rows (trees on small tables then use all cores) until there are 64, and up to a million beyond.  ``written``: the rows are
    a projection of a written table, so they are counted and dealt from there and not written once more before."""
    rows = df if written else materialize(df)
    n = rows.count()
    partitions = max(1, min(64, -(-n // 10_000)), -(-n // 1_000_000))
    return materialize(rows.repartition(partitions, key).sortWithinPartitions(key))
