"""Drop folders: JSON arrays taken up once, routed to their tables, archived, and bad rows set aside."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilframe.session import run_folder

BAD = "_bad"


@dataclass(frozen=True)
class Dataset:
    """Files of one kind in a drop folder: a path pattern below it, the columns, and those a row must have."""

    pattern: str
    schema: T.StructType
    required: tuple[str, ...] = ()


def array_stream(spark: SparkSession, folder: str, dataset: Dataset, archive: str | None = None) -> DataFrame:
    """Rows of the dataset's files, each file one JSON array; `_bad` holds what could not be read.

    A file is cut into the texts of its elements first, so an element that does not fit leaves the others alone; a file that is
    no array is one bad row, an empty one none.  Spark's checkpoint keeps the list of files taken up.  With `archive` a file
    moves there, under its whole path, as soon as a later batch is on its way, so the drop folder does not fill up and nothing
    is lost in between.
    """
    shape = T.StructType([*dataset.schema.fields, T.StructField(BAD, T.StringType())])
    reader = spark.readStream.option("recursiveFileLookup", True)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    files = reader.text(f"{folder}/{dataset.pattern}", wholetext=True).where("trim(BOTH ' \t\r\n' FROM value) <> ''")
    cut = files.select("value", F.from_json("value", "array<string>").alias("elements"))  # once a file, not once an element
    cut = cut.select("elements", F.when(F.col("elements").isNull(), F.col("value")).alias("file"))
    found = cut.select(F.explode_outer("elements").alias("element"), "file").where(
        "element IS NOT NULL OR file IS NOT NULL")
    parsed = found.select("file", F.from_json("element", shape, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}).alias("p"))
    return parsed.select(*[F.col("p")[f.name].alias(f.name) for f in dataset.schema.fields], F.coalesce("file", F.col("p")[BAD]).alias(BAD))


def route_batches(dataset: Dataset, out: str, quarantine: str):
    """`foreachBatch` function: whole rows below `out`, all others as JSON below `quarantine`; a replay overwrites its own folders."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        whole = F.col(BAD).isNull()
        for name in dataset.required:
            whole = whole & F.col(name).isNotNull()
        rows.where(whole).drop(BAD).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        held = F.coalesce(BAD, F.to_json(F.struct(*dataset.schema.fieldNames())))
        rows.where(~whole).select(held.alias("row")).write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
        rows.unpersist()

    return handle


def take_up(
    spark: SparkSession, folder: str, datasets: dict[str, Dataset], root: str, archive: str | None = None
) -> dict[str, DataFrame]:
    """Take up all files there are, each once however often this runs; returns the tables below `root` by dataset.

    `root` holds a table, a quarantine and the stream state of each dataset.
    """
    found = {}
    for name, dataset in datasets.items():
        stream = array_stream(spark, folder, dataset, f"{archive}/{name}" if archive else None)
        out, held = f"{root}/{name}", f"{root}/quarantine/{name}"
        stream.writeStream.foreachBatch(route_batches(dataset, out, held)).option("checkpointLocation", f"{root}/state/{name}").trigger(
            availableNow=True).start().awaitTermination()
        found[name] = spark.read.schema(dataset.schema).parquet(f"{out}/batch=*") if _batches(spark, out) else spark.createDataFrame([], dataset.schema)
    return found


def quarantined(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of a dataset that were set aside, as text."""
    held = f"{root}/quarantine/{name}"
    return spark.read.schema("row string").parquet(f"{held}/batch=*") if _batches(spark, held) else spark.createDataFrame([], "row string")


def _batches(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/batch=*")
    return len(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or ()) > 0


def write_arrays(rows: DataFrame, by: list[str], folder: str | None = None) -> str:
    """One file with a JSON array for each group of `by`, as an outside producer leaves them; returns the folder."""
    folder = folder or run_folder(rows.sparkSession, "drop")
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    files = rows.groupBy(*[F.col(c).alias(f"_file_{c}") for c in by]).agg(
        F.to_json(F.collect_list(F.struct(*rows.columns)), options).alias("value"))
    files.write.mode("append").partitionBy(*[f"_file_{c}" for c in by]).text(folder)
    return folder
