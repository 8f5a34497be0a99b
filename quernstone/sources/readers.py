"""Readers: columns are chosen at the scan, so Parquet reads no others."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.sources import discovery


def read(spark: SparkSession, path: str, fields: list[str] | None = None, schema: str | None = None) -> DataFrame:
    """A table of Parquet or JSON lines by what its files are; blank lines are skipped, a bad line is an error."""
    files = discovery.discover(path)
    kind = discovery.folder_format(files) if files else discovery.format_of(path)
    reader = spark.read.schema(schema) if schema else spark.read
    out = reader.option("mode", "FAILFAST").json(files or path) if kind == "json" else reader.parquet(*(files or [path]))
    return out.select(*fields) if fields else out


def read_texts(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = (".txt", ".md"), least: int = 1, most_files: int | None = None) -> DataFrame:
    """(path, text) of the text files under a folder with at least so many characters."""
    glob = "{" + ",".join(f"*{s}" for s in suffixes) + "}"
    out = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(folder)
    out = out.select(F.input_file_name().alias("path"), F.col("value").alias("text")).where(F.length(F.trim("text")) >= least)
    return out.orderBy("path").limit(most_files) if most_files else out


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, or a JSON array or lines, by the suffix."""
    if path.endswith(".csv"):
        return spark.read.option("header", "true").option("mode", "FAILFAST").csv(path)
    return spark.read.option("multiLine", str(not path.endswith(".jsonl")).lower()).json(path)


def numbered(df: DataFrame) -> DataFrame:
    """df, fresh from a Parquet scan, with each row's file and place in it."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def modulus(df: DataFrame, modulus_: int, remainder: int) -> DataFrame:
    """The rows of each file whose place is `remainder` modulo `modulus_`; no window is needed, the scan knows the places."""
    return numbered(df).where(F.pmod("_row", F.lit(modulus_)) == remainder).drop("_file", "_row")
