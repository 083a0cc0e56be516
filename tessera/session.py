"""Session defaults and shared scratch locations.

The library never picks a machine-local folder on a cluster: intermediate
tables and checkpoints go under ``spark.checkpoint.dir``, which the cluster
sets to a shared location.  Only when it is unset on a single-machine master
(``local[...]``) do we create one under the system temp folder; on any other
master a missing setting is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every analysis relies on (dialect rules D-series in the docs).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of a frame are removed once the frame is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_defaults(spark)
    return spark


def apply_runtime_defaults(spark: SparkSession) -> None:
    """Pin the SQL settings that change answers (safe on a shared session)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(k, SESSION_DEFAULTS[k])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        require_local(sc.master)
        current = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def require_local(master: str) -> None:
    """Raise unless driver and tasks share one machine."""
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"spark.checkpoint.dir is not set on {master}: name a folder that all machines share")


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Remove the scratch tables this application wrote, once their results are
    no longer read; returns how many there were."""
    jvm, n = spark._jvm, len(_SCRATCH)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _SCRATCH:
        p = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        p.getFileSystem(conf).delete(p, True)
    return n


def materialize(df):
    """Compute ``df`` once and cut its lineage (reliable checkpoint).

    Used where one derived frame feeds several branches of a plan; the data
    lands in the shared checkpoint folder, so a lost executor does not force
    the whole prefix to be recomputed.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 << 20, floor: int = 200) -> int:
    """A starting ``spark.sql.shuffle.partitions`` for a job reading ``input_bytes``.

    One partition per ``target_bytes`` of input keeps every reducer's share
    small enough to sort or hash in executor memory (100 TB -> ~400k); AQE
    then coalesces partitions that turn out small after aggregation, so
    starting high costs little while starting low causes spills.
    """
    return max(floor, -(-int(input_bytes) // target_bytes))


def cluster_settings(input_bytes: int) -> dict[str, str]:
    """Settings for a large run: partitions sized from the input, AQE targets."""
    return {
        "spark.sql.shuffle.partitions": str(shuffle_partitions_for(input_bytes)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
    }
