"""Finding input files and telling their format, split and subset."""

from __future__ import annotations

import os
import re
from glob import glob

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SUFFIXES = (".parquet", ".jsonl", ".json")


def discover(path: str) -> list[str]:
    """Files of a glob, of a folder (not below it) or the one file, sorted by path; local paths, others are left to Spark's own listing."""
    if "*" in path:
        return sorted(p for p in glob(path) if p.endswith(SUFFIXES))
    if os.path.isdir(path):
        return sorted(os.path.join(path, p) for p in os.listdir(path) if p.endswith(SUFFIXES) and not p.startswith(("_", ".")))
    return [path]


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, size, modified) of the files under a path, listed by Spark without reading them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def matches_split(path: Column, split: str) -> Column:
    """Whether a path names the split as a whole word: after the start or a slash, before a dash, slash, dot or the end."""
    return path.rlike(rf"(^|/){re.escape(split)}(-|/|\.|$)")


def matches_subset(path: Column, subset: str) -> Column:
    """Whether a path belongs to a subset: as a folder, as a prefix before - or _, or as the file's name with or without suffix."""
    s = re.escape(subset)
    return path.rlike(rf"(^|/){s}(/|-|_|\.|$)")


def format_of(path: str) -> str:
    """json for .jsonl and .json, also compressed; parquet for everything else."""
    return "json" if re.search(r"\.jsonl?(\.\w+)?$", path) else "parquet"


def folder_format(files: list[str]) -> str:
    """The one format of some files; a mixture is an error."""
    kinds = {format_of(f) for f in files}
    if len(kinds) != 1:
        raise ValueError(f"one format is needed, not {sorted(kinds)}")
    return kinds.pop()


def fetch_limit(files: list[tuple[str, int]], bytes_per_row: float, most_rows: int, factor: float = 2.0) -> list[str]:
    """The leading files that hold factor times most_rows by their sizes, one at least."""
    out, rows = [], 0.0
    for path, size in files:
        if out and rows >= factor * most_rows:
            break
        out.append(path)
        rows += size / max(bytes_per_row, 1e-9)
    return out


def discover_with(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, size) of the input files of a glob, folder or file on any file system that the session knows, sorted by path; nothing is read."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for status in fs.globStatus(where) or []:
        for one in fs.listStatus(status.getPath()) if status.isDirectory() and "*" not in path else [status]:
            name = one.getPath().getName()
            if one.isFile() and name.endswith(SUFFIXES) and not name.startswith(("_", ".")):
                out.append((one.getPath().toString(), int(one.getLen())))
    return sorted(out)


def partitioned_by_size(files: list[tuple[str, int]], blocksize: int) -> list[list[str]]:
    """Files, in their order, in partitions of at most `blocksize` bytes; a larger file is a partition of its own."""
    out: list[list[str]] = []
    held = 0
    for path, size in files:
        if not out or held + size > blocksize:
            out.append([])
            held = 0
        out[-1].append(path)
        held += size
    return out


def partitioned_by_count(files: list[str], files_per_partition: int) -> list[list[str]]:
    return [files[i : i + files_per_partition] for i in range(0, len(files), files_per_partition)]
