"""Session construction and cluster-safe scratch locations.

The library never creates its own SparkSession inside an operator; callers
pass one in.  ``local_session`` exists for tests and the benchmark only.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults that matter at scale.  AQE re-plans joins (broadcast when a side is
# small at runtime), coalesces small shuffle partitions and splits skewed ones.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    )
    for k, v in CLUSTER_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator of the cluster sets this to shared storage and we
    only read it.  Where it is unset a local session (tests, local runs) gets a
    scratch folder that goes when the driver ends; on a cluster it is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir is not set: executors need a folder that all of them share")
    path = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def import_in_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it
    (on a cluster: a path that all nodes have, or ship it with ``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def written(df, tag: str = "rows"):
    """Cut lineage with a Parquet table in the shared checkpoint folder: read
    back by column, so passes over some columns read only those.  The folder
    goes when the driver ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tessera/{tag}-{uuid.uuid4().hex}"
    atexit.register(_remove_quietly, spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove_quietly(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    if sc._jsc is None or sc._jsc.sc().isStopped():
        return
    try:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
    except Exception as exc:  # at interpreter exit only: the JVM may be gone
        print(f"left behind: {path}: {exc}")


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder (never local).

    AQE may have coalesced a small result into very few partitions; reading
    the checkpoint back is then spread over the cores again (a round-robin
    repartition of an already small table -- large tables keep their own
    partitioning)."""
    ensure_checkpoint_dir(df.sparkSession)
    ck = df.checkpoint(eager=True)
    cores = df.sparkSession.sparkContext.defaultParallelism
    if ck.rdd.getNumPartitions() < cores:
        ck = ck.repartition(cores)
    return ck
