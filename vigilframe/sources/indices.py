"""Index patterns over daily tables: names such as `filebeat-2024.01.05`, resolved to partitions before any scan."""

from __future__ import annotations

import datetime as dt
import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def index_days(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(index name, folder) of every beat and day below a table partitioned by `beat` and `dt`; folders are listed, files not."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{root}/beat=*/dt=*")
    found = []
    for status in path.getFileSystem(conf).globStatus(path) or ():
        folder = status.getPath()
        beat, day = folder.getParent().getName().removeprefix("beat="), folder.getName().removeprefix("dt=")
        if status.isDirectory() and day != "__HIVE_DEFAULT_PARTITION__":
            found.append((f"{beat}-{dt.date.fromisoformat(day):%Y.%m.%d}", folder.toString()))
    return sorted(found)


def matching(name: str, pattern: str) -> bool:
    """Comma-separated patterns with `*`; a leading `-` takes away, the last part that matches decides."""
    held = False
    for part in (p.strip() for p in pattern.split(",")):
        if part.startswith("-"):
            held = held and not fnmatch.fnmatchcase(name, part[1:])
        else:
            held = held or fnmatch.fnmatchcase(name, part)
    return held


def read_indices(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """All rows of the daily indices that a pattern names, with `beat`, `dt` and `index_name`.

    Only the folders of matching days are listed and read.  Beats of different columns are merged, missing columns are NULL.
    No match is an empty table, with the columns of the whole table.
    """
    days = index_days(spark, root)
    chosen = [folder for name, folder in days if matching(name, pattern)]
    name = F.concat_ws("-", "beat", F.date_format("dt", "yyyy.MM.dd"))
    if not days:
        raise FileNotFoundError(f"no daily index below {root}")
    rows = spark.read.option("mergeSchema", True).option("basePath", root).parquet(*(chosen or [days[0][1]]))
    return (rows if chosen else rows.limit(0)).withColumn("index_name", name)
