"""Landing folders and table files."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from retailloom.schemas import CUSTOMER, LANDING
from retailloom.session import shuffles_released

LANDED_ROWS = 500_000


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def is_folder(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place) and system.getFileStatus(place).isDirectory()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, if it is there."""
    system, place = _place(spark, path)
    system.delete(place, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies directly in a folder; nothing if it is missing."""
    system, place = _place(spark, path)
    return [status.getPath().getName() for status in system.listStatus(place)] if system.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    system, place = _place(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its whole text at once, or return False if it is there already.

    The text goes to a file of its own first; a rename that never replaces makes it appear.
    """
    system, place = _place(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = system.create(beside, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    fs = spark._jvm.org.apache.hadoop.fs
    whole = [system.makeQualified(p) for p in (beside, place)]
    context = fs.FileContext.getFileContext(whole[1].toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(*whole, spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0))
        return True
    except Py4JJavaError:
        system.delete(beside, False)
        if system.exists(place):
            return False
        raise


def json_lines(spark: SparkSession, path: str, schema: StructType = LANDING) -> DataFrame:
    """JSON Lines under ``path``; no rows when the folder is missing or empty. Other failures raise."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def land(rows: DataFrame, path: str, kind: str = "json") -> None:
    """Add rows to a landing folder as JSON Lines, or as ``kind`` text. Files are compressed, a tenth to a fifth of the plain text, and as such a
    file is read by one task it holds at most ``LANDED_ROWS`` rows."""
    writer = rows.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", LANDED_ROWS)
    with shuffles_released(rows.sparkSession):
        writer.format(kind).save(path)


def json_lines_stream(spark: SparkSession, path: str, archive: str | None = None,
                      files_per_batch: int | None = None, schema: StructType = LANDING) -> DataFrame:
    """Landing files as a stream; consumed files are moved below ``archive`` when one is given."""
    reader = spark.readStream.schema(schema)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def customer_file(spark: SparkSession, path: str) -> DataFrame:
    """The CRM exports, each one JSON array over many lines, with the time each file ``arrived``."""
    rows = spark.read.schema(CUSTOMER).option("multiLine", True).json(path)
    return rows.select("*", F.col("_metadata.file_modification_time").alias("arrived"))
