"""Session construction and the few session-level helpers every job shares.

Nothing here schedules work: it only sets the Spark configuration the jobs
rely on (UTC, AQE with skew-join splitting, no UI) and answers two
questions the operators ask the session:

* where is the shared folder for reliable checkpoints and stage tables
  (``spark.checkpoint.dir``; a private temp dir is used only when it is
  unset on a local master, i.e. in tests), and
* is a side small enough to broadcast (a measured size, never a guess).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.ansi.enabled": "true",
}

# Settings for a large cluster (hundreds of executors, ~100 TB inputs).
# Rationale: 256 MB input splits and 256 MB post-shuffle partitions keep a
# task's working set well inside a few GB of executor memory (sequence rows
# are ~30 kB, so ~10^4 rows per task); the initial shuffle width is high
# and AQE coalesces it down per stage; skew handling splits any partition 5x
# the median and above 512 MB; broadcasts stay under the measured gate below.
CLUSTER_CONF = {
    **DEFAULT_CONF,
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.parquet.compression.codec": "zstd",
}

# Broadcast bound for sides whose size depends on the data (distinct geo
# tuples, id lists).  Measured in bytes of payload before a broadcast hint.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def build_session(master: str | None = None, app: str = "genoflux",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, cluster: bool = False) -> SparkSession:
    """Session with the configuration the library expects (``cluster=True``:
    the large-cluster profile ``CLUSTER_CONF``)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(CLUSTER_CONF if cluster else DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from ``spark.checkpoint.dir`` (or the context's current setting).
    When neither is set, a local master gets a private folder; on a cluster
    that is an error, since no machine-local folder is seen by all executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="genoflux-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_RUN_FOLDER: ContextVar[str | None] = ContextVar("genoflux_run_folder", default=None)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a stage table, under the shared checkpoint root or,
    within ``stage_run``, under that run's folder there."""
    folder = _RUN_FOLDER.get() or f"{ensure_checkpoint_dir(spark).rstrip('/')}/genoflux-stage"
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"


def remove_folder(spark: SparkSession, path: str) -> None:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


@contextmanager
def stage_run(spark: SparkSession) -> Iterator[str]:
    """A run that writes its result by itself: the stage tables made within
    lie in one folder, removed when the run ends well.  A run that fails
    leaves its own folder, and no other.  Frames that are still to be
    computed must not leave the block."""
    folder = shared_path(spark, "run")
    token = _RUN_FOLDER.set(folder)
    try:
        yield folder
    finally:
        _RUN_FOLDER.reset(token)
    remove_folder(spark, folder)


def payload_bytes(df: DataFrame, cols: list[str]) -> int:
    """Payload size of ``cols`` in bytes (strings and binaries by their
    bytes, nested columns by the bytes of their JSON text, 8 bytes for other
    types, 16 a row) -- one aggregate job, used to gate broadcasts."""
    parts = []
    types = dict(df.dtypes)
    for c in cols:
        t, col = types[c], F.col(f"`{c}`")
        if t.startswith(("struct", "map", "array")):
            col = F.to_json(F.struct(col))
        elif t not in ("string", "binary"):
            parts.append(F.lit(8).cast("long"))
            continue
        parts.append(F.coalesce(F.octet_length(col), F.lit(0)).cast("long"))
    size = parts[0] if parts else F.lit(0)
    for p in parts[1:]:
        size = size + p
    row = df.agg(F.coalesce(F.sum(size + F.lit(16)), F.lit(0)).alias("b")).first()
    return int(row["b"])


def maybe_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only if its measured payload is under ``max_bytes``.
    Otherwise ask for a sort-merge join: without a hint Spark would go by an
    estimate of its own and could broadcast all the same."""
    if payload_bytes(df, df.columns) <= max_bytes:
        return F.broadcast(df)
    return df.hint("merge")


def cut_lineage(df: DataFrame, name: str = "stage", path: str | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet stage table under the shared checkpoint
    folder and continue from the files: the plan is computed once (an RDD
    checkpoint recomputes it for the write), later reads prune columns, and
    a lost executor re-reads files instead of recomputing the lineage."""
    spark = df.sparkSession
    path = path or shared_path(spark, name)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # no job to infer what is known


def land(df: DataFrame, name: str = "landed") -> DataFrame:
    """Parse a text input once into a Parquet stage table and continue from
    it.  Later passes read only the columns they need, and the landed files
    split by row group: even a single unsplittable compressed input (parsed
    by one task, as it must be) is read back by many tasks downstream."""
    return cut_lineage(df, name)
