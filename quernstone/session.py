"""Session helpers: builder, shared folder for intermediate tables, table access."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build(cpus: int | str = "*", app: str = "quernstone", **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster the session comes from spark-submit."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir; a temporary one only where that is unset."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = os.path.join(tempfile.gettempdir(), f"quernstone-{os.getpid()}")
        os.makedirs(d, exist_ok=True)
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back.

    Cuts the lineage and survives the loss of executors; a later read costs no recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
