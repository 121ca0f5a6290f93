"""Session and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str | None = None, app: str = "tandem",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session tuned for the engine.

    AQE stays on: it coalesces small shuffle partitions, splits skewed join
    partitions and converts sort-merge joins to broadcast joins only when the
    runtime size of a side is below the broadcast threshold.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tandem`` importable in Python workers (pandas UDFs pickle it by
    reference): zip the package once and distribute it with ``addPyFile``."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, zpath = tempfile.mkstemp(prefix="tandem-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(zpath, "w") as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    A folder set on the context comes first, then the cluster's
    ``spark.checkpoint.dir``; only when both are unset (local tests) a fresh
    local folder is created and registered.
    """
    sc = spark.sparkContext
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    cp = sc.getCheckpointDir()
    if cp and not (conf and cp.rstrip("/").startswith(_plain(conf))):
        return cp
    if conf:
        if cp is None:
            sc.setCheckpointDir(conf)
        return conf
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    d = tempfile.mkdtemp(prefix="tandem-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def _plain(uri: str) -> str:
    """A folder as the context reports it (without a ``file:`` scheme's slashes)."""
    return uri.rstrip("/").replace("file:///", "file:/") if uri.startswith("file:") else uri.rstrip("/")


def join_measured(big: DataFrame, small: DataFrame, on, how: str = "inner", rows: int = 100_000) -> DataFrame:
    """Join whose small side is broadcast only when at most ``rows`` rows were
    counted; beyond that it is a shuffle join that AQE splits on skew."""
    few = small.limit(rows + 1).count() <= rows
    return big.join(F.broadcast(small) if few else small, on, how)


_SCOPES: list = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/tandem-{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Deletes at its end what was written to scratch paths inside it, whether it
    ends well or not.  Write a query's result to its place inside: a DataFrame
    that is read later may still need its scratch tables.  Scopes nest; the files of
    ``DataFrame.checkpoint`` go when Spark's cleaner finds them unused
    (``spark.cleaner.referenceTracking.cleanCheckpoints``, on in ``build_session``)."""
    _SCOPES.append([])
    try:
        yield
    finally:
        paths = _SCOPES.pop()
        drop_scratch(spark, *paths, *[f"{p}.times" for p in paths])


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete tables of ``scratch_path`` that no later step reads."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never a local one."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=eager)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a compressed Parquet table in the shared folder: cuts the lineage,
    and a later step reads only the columns it needs."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))
