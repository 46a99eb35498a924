"""Spark session helpers.

On a cluster the session is created by the platform; these helpers only fill
in settings that are unset, so cluster-level configuration always wins.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def get_spark(
    master: str | None = None,
    app_name: str = "wattlane",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session, or build a local one with sane defaults."""

    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names the folder; only when it is unset (local tests) a
    private scratch folder is created.
    """

    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share.")
        configured = tempfile.mkdtemp(prefix="wattlane-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def ship_package(spark: SparkSession) -> None:
    """Make ``wattlane`` importable in Python workers (pandas UDFs), once per context.

    The package is zipped into the shared checkpoint folder and added with
    ``addPyFile``, the standard way to ship Python code to executors.
    """

    sc = spark.sparkContext
    if getattr(sc, "_wattlane_shipped", False):
        return
    import io
    import zipfile

    root = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _dirs, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(root)))
    target = os.path.join(ensure_checkpoint_dir(spark), f"wattlane-{os.getpid()}-{id(sc)}.zip")
    if "://" in target and not target.startswith("file:"):
        warnings.warn(f"wattlane is not shipped to executors by way of {target}: install it on the cluster.", stacklevel=2)
        return
    try:
        with open(target.removeprefix("file:"), "wb") as fh:
            fh.write(buf.getvalue())
        sc.addPyFile(target.removeprefix("file:"))
        sc._wattlane_shipped = True  # type: ignore[attr-defined]
    except OSError as exc:  # only the operators with Python workers need it
        warnings.warn(f"wattlane could not be shipped to executors: {exc}", stacklevel=2)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back.

    Survives executor loss: the data lives in the shared folder, not in
    executors. The plan runs once, nothing is cached, and later reads take the
    columns they need.
    """

    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/wattlane-cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    """(file system, path) of a folder on whatever storage its name says."""

    jvm = spark._jvm
    name = jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark._jsc.hadoopConfiguration()), name


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, name = _folder(spark, path)
    return fs.exists(name)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, name = _folder(spark, path)
    fs.delete(name, True)


def replace_folder(spark: SparkSession, staged: str, path: str) -> None:
    """``staged`` becomes ``path``; what was there goes."""

    fs, old = _folder(spark, path)
    fs.delete(old, True)
    if not fs.rename(_folder(spark, staged)[1], old):
        raise OSError(f"could not rename {staged} to {path}")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
