"""Session helpers: a tuned local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "starhouse", extra: dict | None = None) -> SparkSession:
    """Session for tests and the benchmark. On a cluster the submitter owns the session."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when nothing is set (a bare local run) do we
    create one, so ``DataFrame.checkpoint()`` and scratch tables have a home.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="starhouse-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def set_conf(spark: SparkSession, conf: dict[str, str]):
    """Session settings that hold inside the block."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles_freed(spark: SparkSession):
    """Shuffle files of the statements run inside the block go as each ends, not when the driver happens to collect its
    garbage: a job of many steps would keep those of all. For blocks whose frames are written, each by a plan of its own."""
    return set_conf(spark, {SHUFFLE_CLEANUP: "true"})


_scopes = threading.local()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never a machine-local temp dir on a cluster).

    Inside ``scratch_scope`` the path is deleted when the scope ends.
    """
    path = f"{shared_dir(spark).rstrip('/')}/starhouse/{name}-{uuid.uuid4().hex[:12]}"
    stack = getattr(_scopes, "stack", None)
    if stack:
        stack[-1].append(path)
    return path


def staged(df, name: str):
    """The rows of ``df``, written once to the shared folder and read from there: lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete a path on whatever file system it names (HDFS, object store, local)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the scratch tables created inside the block once it has finished.

    Use it around work that fully consumes its scratch tables (a job that
    writes its result), never around code returning lazy DataFrames that still
    read them.
    """
    stack = getattr(_scopes, "stack", None)
    if stack is None:
        stack = _scopes.stack = []
    stack.append([])
    try:
        yield stack[-1]
    finally:
        for path in stack.pop():
            delete_path(spark, path)
