"""Spark session helpers.

The library never assumes it owns the session: operators take the session (or a
DataFrame) from the caller. ``build_session`` is for tests, the bench and the
examples; on a cluster the platform's session is used as is.
"""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for the plans this library emits. AQE re-plans joins at
# runtime (broadcast only when the measured side is small), coalesces small
# shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "staylens",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf["spark.driver.memory"] = os.environ.get("STAYLENS_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared folder (HDFS/S3/...) and is used as
    is; without it a cluster job is refused, as a folder of the driver's machine is none
    that executors can read. A local session without it gets a fresh scratch folder.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="staylens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of jobs that are done and that nothing refers to any more. It
    does so when the driver's memory is collected, which else may not happen before a long query ends."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``staylens`` importable in Python workers (pandas UDFs, mapInPandas).

    Zips the package once per SparkContext and registers it with
    ``addPyFile`` -- the same mechanism as ``--py-files``: Spark serves the
    archive from the driver to every executor.
    """
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    import zipfile

    import staylens
    pkg_dir = os.path.dirname(os.path.abspath(staylens.__file__))
    parent = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="staylens-pyfiles-"), "staylens.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, parent))
    sc.addPyFile(out)
    _SHIPPED.add(key)
