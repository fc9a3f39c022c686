"""Reading a table as a stream, and running a stream until its input is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumenloom.session import shared_dir


def read_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The files of a Parquet table (one file or a folder) as a stream."""
    table = spark.read.parquet(path)
    reader = spark.readStream.schema(table.schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    folder, _, name = path.rstrip("/").rpartition("/")
    if _is_file(table, name):
        # the file source takes a folder but no file: the one file of its folder that has this very name
        return reader.option("pathGlobFilter", _literal(name)).option("recursiveFileLookup", "false").parquet(folder)
    return reader.parquet(path)


def _is_file(table: DataFrame, name: str) -> bool:
    """Whether the table is the file of that name rather than a folder."""
    first = table.select("_metadata.file_name").first()
    return first[0] == name if first else any(f.endswith(f"/{name}") for f in table.inputFiles())


def _literal(name: str) -> str:
    """A glob that matches the name alone."""
    return "".join(f"\\{c}" if c in "*?[]{}\\^" else c for c in name)


def finish(writer, spark: SparkSession, name: str, timeout: float | None = None) -> None:
    """Run a prepared writer over all input there is, with its checkpoint in the shared folder.

    Without ``timeout`` it may take as long as it takes.
    """
    query = (
        writer.option("checkpointLocation", shared_dir(spark, f"{name}-state"))
        .trigger(availableNow=True)
        .start()
    )
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream {name} still ran after {timeout} s")


def stream_to_table(sdf: DataFrame, name: str) -> DataFrame:
    """What an append stream yields for the input there is, as a table."""
    spark = sdf.sparkSession
    path = shared_dir(spark, name)
    finish(sdf.writeStream.format("parquet").option("path", path), spark, name)
    return spark.read.schema(sdf.schema).parquet(path)
