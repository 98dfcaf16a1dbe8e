"""Ad-hoc exports read back: csv or json lines, plain or gzip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from adlumen.sinks.tables import EXPORT_TIME


def read_text_export(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv", compressed: bool | None = None) -> DataFrame:
    """Rows of an export with the types of ``schema``; a row that does not fit ends the read.

    Csv does not tell an empty text from none: both come back as null. Json lines do.
    Compression follows from the file names. ``compressed`` restricts the read to files of
    that kind, where a folder holds both. A compressed file is read by one task: exports of
    any size should have many files.
    """
    reader = spark.read.schema(schema).option("mode", "FAILFAST").option("timestampFormat", EXPORT_TIME)
    if compressed is not None:
        reader = reader.option("pathGlobFilter", f"*.{fmt}.gz" if compressed else f"*.{fmt}")
    if fmt == "csv":
        # line ends inside quoted values, and quotes as the writer escapes them
        reader = reader.option("header", "true").option("multiLine", "true").option("escape", "\\").option("quote", '"')
    return reader.format(fmt).load(path)
