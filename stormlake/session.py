"""Session set-up and the shared scratch location.

On a cluster the session is created by the platform; ``get_spark`` only adds
what this library relies on (UTC, ANSI, AQE) where the value is not set yet.
Scratch data always lives under the shared folder named by
``spark.checkpoint.dir`` (or ``SparkContext.setCheckpointDir``); a private temp
folder is used only in a single-JVM ``local`` session that names none, as in
tests.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}
#: What the results depend on; set on every session, whoever made it.
SEMANTICS = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true"}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "stormlake") -> SparkSession:
    """Build or fetch a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.driver.memory", os.environ.get("STORMLAKE_DRIVER_MEM", "4g"))
    active = SparkSession.getActiveSession()
    for k, v in _DEFAULTS.items():
        if active is None or active.conf.get(k, None) is None:
            builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    if active is None:
        spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Set what results depend on and make sure there is a scratch folder."""
    for k, v in SEMANTICS.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_CKPT: str | None = None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: ``spark.checkpoint.dir``, else the one set
    on the context.  A private one is made only for a ``local`` master; on a
    cluster without a shared folder this raises."""
    global _LOCAL_CKPT
    sc = spark.sparkContext
    cdir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not cdir and _LOCAL_CKPT is None and sc.getCheckpointDir():
        # SparkContext appends a unique folder to what it was given; its parent is the shared one
        cdir = sc.getCheckpointDir().rpartition("/")[0]
    if not cdir:
        if _LOCAL_CKPT is None:
            master = sc.master or ""
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            _LOCAL_CKPT = tempfile.mkdtemp(prefix="stormlake-ckpt-")
        cdir = _LOCAL_CKPT
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(cdir)
    return cdir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir, in its own file system."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/stormlake/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: write the rows once as a Parquet table in the shared
    checkpoint folder and read them back.

    Compared with ``checkpoint()``: one job (the checkpoint writes in a second
    job that reruns the last stage), columnar, and column-pruned when read
    back.  It survives executor loss because the files live in the shared
    folder.
    """
    return Stages(df.sparkSession, clean=False).save(df)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that holds it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Stages:
    """Stage tables of one operator run: written to the shared scratch folder,
    read back, and dropped when the operator no longer needs them.  ``clean``: free the
    shuffle files behind a table once it is written, for operators that shuffle much more than they keep."""

    def __init__(self, spark: SparkSession, name: str = "stage", clean: bool = True):
        self.spark, self.name, self.clean = spark, name, clean
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def path(self, what: str) -> str:
        return scratch_path(self.spark, f"{self.name}-{what}")

    def save(self, df: DataFrame, what: str = "stage") -> DataFrame:
        path = self.path(what)
        df.write.mode("overwrite").parquet(path)
        if self.clean:
            # the shuffle files behind the finished write go once the driver's
            # references to that query are collected
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = (out, path)
        return out

    def keep(self, *tables: DataFrame) -> None:
        """Delete all stage tables but these; what is left to run may read only these."""
        kept = {id(t) for t in tables}
        self.drop(*[t for i, (t, _) in list(self._paths.items()) if i not in kept])

    def drop(self, *tables: DataFrame) -> None:
        """Delete these stage tables' files; nothing may read them afterwards."""
        for t in tables:
            _, path = self._paths.pop(id(t))
            delete_path(self.spark, path)
