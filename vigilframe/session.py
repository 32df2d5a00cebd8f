"""Session defaults, shared folder and written stages."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written for.  Skew-join splitting is on even where it
# costs one more exchange, because single hosts, sources and tokens may be very hot.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "vigilframe", master: str | None = None, **settings: str) -> SparkSession:
    """Build a session with the settings above; `settings` override or extend them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SCALE_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    ship(session)
    return session


_shipped: set[str] = set()  # applications that have the package


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers of the application, once; they need no path or working folder of their own."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    if not os.path.isdir(home):  # imported from an archive that the application has already
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{__package__}.zip")  # Spark's file server hands it out
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(home):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.join(__package__, os.path.relpath(path, home)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


LOCAL_ROOT = "/tmp/vigilframe-stages"


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for written stages and stream state: `spark.checkpoint.dir`.

    Where it is unset: a folder of Hadoop's default file system, if that is shared, or of this machine, if there is no other
    (`local` masters, as in tests).  On a cluster whose default file system is each machine's own it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        files = spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark._jsc.hadoopConfiguration()).getUri()
        master = spark.sparkContext.master
        if files.getScheme() != "file":
            root = f"{files.toString().rstrip('/')}/tmp/vigilframe-stages"
        elif master == "local" or master.startswith("local["):
            root = LOCAL_ROOT
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return root.rstrip("/")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the checkpoint root (stream state, written stages)."""
    folder = f"{checkpoint_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    return folder


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Compute `df` once and read it back as Parquet from the shared folder.

    For stages that several later jobs scan again: lost executors then re-read files instead of
    replaying the whole lineage, and each reader takes only the columns it needs.
    """
    ship(df.sparkSession)
    folder = run_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def discard(spark: SparkSession, folder: str) -> None:
    """Remove one folder of `run_folder` that nothing reads any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_stages(spark: SparkSession) -> None:
    """Remove the folders that this application has written below the checkpoint root."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
