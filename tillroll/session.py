"""Spark session defaults and the reliable checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on.  Shuffle partitions are sized for the local
# test box; on a cluster the caller's session keeps its own value and AQE
# coalesces / splits partitions at runtime.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "tillroll", shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults; used by tests and the benchmark."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for checkpoints and staged tables, taken from the session.

    ``spark.checkpoint.dir`` names a folder every executor can reach; it is
    read from the session and only set here when it is missing, which is
    allowed for local sessions (tests) only.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no local SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc is None:
            return configured
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    # one process on one machine (local, local[...]): everything else has executors of its own
    if sc is None or not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    folder = tempfile.mkdtemp(prefix="tillroll-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def stage(df, label: str = "stage"):
    """Write ``df`` as Parquet under the shared checkpoint folder and return it re-read.

    This cuts the lineage like ``checkpoint()`` but keeps the data columnar:
    later readers get column pruning and filter pushdown, and a lost executor
    re-reads files instead of recomputing the plan.  Each call writes a fresh
    folder, so concurrent runs never share one; ``unstage`` deletes it.
    """
    import uuid

    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/tillroll-{label}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(*frames) -> None:
    """Delete the folders of staged frames once nothing reads them any more."""
    for df in frames:
        spark = df.sparkSession
        root = ensure_checkpoint_dir(spark).rstrip("/").split(":", 1)[-1].lstrip("/")
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/tillroll-" in folder and folder.split(":", 1)[-1].lstrip("/").startswith(root):
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)
