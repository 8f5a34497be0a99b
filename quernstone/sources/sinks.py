"""Sinks: JSON lines (also zstd), token files with an index, packed Parquet, partitioned Parquet, receipts and versioned artifacts."""

from __future__ import annotations

import json
import os
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.session import materialize, shared_dir

#: Start of an index file, its version, and the codes of token types (fixed values of the format).
MAGIC, VERSION = b"MMIDIDX\x00\x00", 1
CODES = {"int32": 4, "int64": 5, "uint16": 8}


def partitioned(df: DataFrame, by: list[str], name: str) -> str:
    """Write df in folders by column values and give the path."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).option("compression", "zstd").parquet(path)
    return path


def _written(df: DataFrame, folder: str, write) -> list[tuple]:
    """Each task writes one file under a name of its own and renames it when it is whole; only the driver's list of finished tasks counts.

    The folder must be one that all executors and the driver mount; a task that doesn't find the driver's mark in it fails before it writes.
    """
    if "://" in folder:
        raise ValueError(f"{folder}: files of these formats are written to a mounted folder; use a Parquet sink for other file systems")
    os.makedirs(folder, exist_ok=True)
    mark = os.path.join(folder, f".mark-{uuid.uuid4().hex}")
    with open(mark, "w"):
        pass

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        if not os.path.exists(mark):
            raise RuntimeError(f"{folder} is not the driver's folder on this executor")
        part = TaskContext.get().partitionId()
        row = write(batches, folder, part)
        kinds = [("part", pa.int32()), ("path", pa.string()), ("rows", pa.int64()), ("items", pa.int64()), ("checksum", pa.string())]
        yield pa.RecordBatch.from_pylist([row], schema=pa.schema(kinds))

    try:
        out = df.mapInArrow(run, "part int, path string, rows long, items long, checksum string").collect()  # one row a task
    finally:
        os.remove(mark)
    return sorted(tuple(r) for r in out)


def write_jsonl(df: DataFrame, folder: str, compression: str = "none") -> list[tuple]:
    """(part, path, rows, bytes, checksum): one file a partition; nulls are kept, text isn't escaped to ASCII; the checksum is XXH64 of the lines."""
    lines = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("line"))

    def write(batches: Iterator[pa.RecordBatch], to: str, part: int) -> dict:
        import xxhash

        end = ".jsonl.zst" if compression == "zstd" else ".jsonl"
        path, tmp = f"{to}/part-{part:05d}{end}", f"{to}/.part-{part:05d}-{uuid.uuid4().hex}"
        h, rows, size = xxhash.xxh64(), 0, 0
        with open(tmp, "wb") as raw:
            if compression == "zstd":
                import zstandard

                out = zstandard.ZstdCompressor().stream_writer(raw, closefd=False)
            else:
                out = raw
            for b in batches:
                for line in b.column(0).to_pylist():
                    data = line.encode() + b"\n"
                    h.update(data)
                    out.write(data)
                    rows, size = rows + 1, size + len(data)
            if out is not raw:
                out.close()
        os.rename(tmp, path)
        return {"part": part, "path": path, "rows": rows, "items": size, "checksum": h.hexdigest()}

    return _written(lines, folder, write)


def write_token_files(df: DataFrame, ids_col: str, folder: str, dtype: str = "int32") -> list[tuple]:
    """(part, path, sequences, tokens, checksum): for each partition a .bin file of all tokens in a row and an .idx file of lengths, byte places and documents.

    Values that the type can't hold are an error; null and empty sequences are left out.
    """
    kind = np.dtype(dtype)

    def write(batches: Iterator[pa.RecordBatch], to: str, part: int) -> dict:
        import xxhash

        base, tmp = f"{to}/part-{part:05d}", f"{to}/.part-{part:05d}-{uuid.uuid4().hex}"
        h, lengths = xxhash.xxh64(), []
        with open(f"{tmp}.bin", "wb") as out:
            for b in batches:
                for ids in b.column(0).to_pylist():
                    if ids:
                        wide = np.array(ids, np.int64)
                        if wide.min() < np.iinfo(kind).min or wide.max() > np.iinfo(kind).max:
                            raise ValueError(f"a token does not fit into {dtype}")
                        data = wide.astype(kind).tobytes()
                        h.update(data)
                        out.write(data)
                        lengths.append(len(ids))
        places = np.concatenate([[0], np.cumsum(np.array(lengths, np.int64) * kind.itemsize)[:-1]]) if lengths else np.empty(0)
        with open(f"{tmp}.idx", "wb") as out:
            out.write(MAGIC + struct.pack("<QBQQ", VERSION, CODES[dtype], len(lengths), len(lengths) + 1))
            out.write(np.array(lengths, np.int32).tobytes() + places.astype(np.int64).tobytes() + np.arange(len(lengths) + 1, dtype=np.int64).tobytes())
        os.rename(f"{tmp}.bin", f"{base}.bin")
        os.rename(f"{tmp}.idx", f"{base}.idx")
        return {"part": part, "path": base, "rows": len(lengths), "items": int(sum(lengths)), "checksum": h.hexdigest()}

    return _written(df.select(ids_col), folder, write)


def read_token_file(base: str) -> list[list[int]]:
    """The sequences of one .bin and .idx pair."""
    with open(f"{base}.idx", "rb") as f:
        if f.read(9) != MAGIC:
            raise ValueError(f"{base}.idx is no index")
        _, code, n, _ = struct.unpack("<QBQQ", f.read(25))
        lengths = np.frombuffer(f.read(4 * n), np.int32)
        places = np.frombuffer(f.read(8 * n), np.int64)
    kind = np.dtype({v: k for k, v in CODES.items()}[code])
    data = np.fromfile(f"{base}.bin", kind)
    return [data[p // kind.itemsize : p // kind.itemsize + k].tolist() for p, k in zip(places, lengths)]


def read_token_files(spark: SparkSession, bases: list[str], column: str = "input_ids") -> DataFrame:
    """(base, place, column): the sequences of .bin and .idx pairs; a task reads whole pairs, which are as large as the partitions that wrote them."""
    rows = spark.createDataFrame([(b,) for b in bases], "base string").repartition(max(1, len(bases)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for base in b.column(0).to_pylist():
                own = read_token_file(base)
                for at in range(0, len(own), 1000):
                    part = own[at : at + 1000]
                    cols = [pa.array([base] * len(part)), pa.array(range(at, at + len(part)), pa.int64()), pa.array(part, pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(cols, ["base", "place", column])

    return rows.mapInArrow(run, f"base string, place long, `{column}` array<long>")


def write_tar_shards(df: DataFrame, key: str, text: str, folder: str) -> DataFrame:
    """Write a tar file of each partition, with a member `key`.txt a row, and give its index (shard, key, idx, offset, size) as a written table.

    Members can be read alone at their offset. Rows without key or text are left out.
    """
    rows = df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    if "://" in folder:
        raise ValueError(f"{folder}: tar files are written to a mounted folder")
    os.makedirs(folder, exist_ok=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tarfile
        from io import BytesIO

        from pyspark import TaskContext

        path = f"{folder}/shard-{TaskContext.get().partitionId():06d}.tar"
        tmp, idx = f"{path}.{uuid.uuid4().hex}", 0
        with tarfile.open(tmp, "w", format=tarfile.GNU_FORMAT) as tar:
            for b in batches:
                index = []
                for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    data = t.encode()
                    info = tarfile.TarInfo(f"{k}.txt")
                    info.size = len(data)
                    tar.addfile(info, BytesIO(data))
                    # contents are padded to blocks of 512 bytes
                    index.append({"shard": path, "key": k, "idx": idx, "offset": tar.offset - -(-len(data) // 512) * 512, "size": len(data)})
                    idx += 1
                if index:
                    yield pa.RecordBatch.from_pylist(index, schema=pa.schema([("shard", pa.string()), ("key", pa.string()), ("idx", pa.int64()), ("offset", pa.int64()), ("size", pa.int64())]))
        os.replace(tmp, path)

    return materialize(rows.mapInArrow(run, "shard string, key string, idx long, offset long, size long"), "tar-index")


def read_tar_members(index: DataFrame) -> DataFrame:
    """(key, text) of the rows of an index, each read at its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, files = [], {}
            for shard, offset, size in zip(*(b.column(i).to_pylist() for i in (1, 2, 3))):
                if shard not in files:
                    files[shard] = open(shard, "rb")
                files[shard].seek(offset)
                out.append(files[shard].read(size).decode())
            for f in files.values():
                f.close()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["key", "text"])

    return index.select("key", "shard", "offset", "size").mapInArrow(run, "key string, text string")


def write_packed(packs: DataFrame, path: str) -> None:
    """input_ids, loss_mask and seq_start_id as zstd Parquet."""
    packs.select("input_ids", F.transform("loss_mask", lambda x: x.cast("tinyint")).alias("loss_mask"), "seq_start_id").write.mode("overwrite").option("compression", "zstd").parquet(path)


def latest_receipts(receipts: DataFrame, key: str = "shard_index", status: str = "status", made: str = "created_at") -> DataFrame:
    """The newest completed receipt of each shard."""
    return receipts.where(F.col(status) == "completed").groupBy(key).agg(F.max_by(F.struct(*[c for c in receipts.columns if c != key]), made).alias("r")).select(key, "r.*")


def pending(shards: DataFrame, receipts: DataFrame, key: str = "shard_index") -> DataFrame:
    """Shards without a completed receipt."""
    return shards.join(latest_receipts(receipts, key), key, "left_anti")


def shard_states(shards: DataFrame, receipts: DataFrame, now: Column, *, key: str = "shard_index", status: str = "status", made: str = "created_at", plan: str = "plan_hash", stale_minutes: int = 30, outputs: DataFrame | None = None, output: str = "output_file") -> DataFrame:
    """(key, state) of every shard, by its newest receipt of the newest plan: done, claimed (started less than `stale_minutes` ago), failed, or pending
    (no receipt, a stale claim, or a completed one whose output is missing from `outputs`, a listing with a column of the same name)."""
    newest = receipts.agg(F.max_by(plan, F.struct(made, plan)).alias("_plan"))
    own = receipts.join(F.broadcast(newest), F.col(plan).eqNullSafe(F.col("_plan")))  # one row
    last = own.groupBy(key).agg(F.max_by(F.struct(F.col(status).alias("_s"), F.col(made).alias("_at"), F.col(output).alias("_o") if outputs is not None else F.lit(None).alias("_o")), F.struct(made, status)).alias("r")).select(key, "r.*")
    out = shards.join(last, key, "left")
    if outputs is not None:
        out = out.join(outputs.select(F.col(output).alias("_o")).distinct().withColumn("_there", F.lit(True)), "_o", "left")
    there = F.coalesce("_there", F.lit(False)) if outputs is not None else F.lit(True)
    fresh = F.col("_at") > now - F.expr(f"INTERVAL {stale_minutes} MINUTES")
    state = F.when((F.col("_s") == "completed") & there, "done").when((F.col("_s") == "started") & fresh, "claimed").when(F.col("_s") == "failed", "failed").otherwise("pending")
    return out.select(key, state.alias("state"))


class Artifacts:
    """Versioned artifacts {root}/{name}/v{n} with a manifest; `latest` names the newest one and is written last."""

    def __init__(self, root: str) -> None:
        self.root = root

    def publish(self, name: str, df: DataFrame, meta: dict | None = None) -> str:
        folder = f"{self.root}/{name}"
        os.makedirs(folder, exist_ok=True)
        n = 1 + max([int(d[1:]) for d in os.listdir(folder) if d[:1] == "v" and d[1:].isdigit()] or [0])
        path = f"{folder}/v{n}"
        df.write.option("compression", "zstd").parquet(f"{path}/data")
        with open(f"{path}/manifest.json", "w") as f:
            json.dump({"name": name, "version": n, "schema": json.loads(df.schema.json()), "meta": meta or {}}, f, sort_keys=True)
        with open(f"{folder}/.latest", "w") as f:
            f.write(str(n))
        os.replace(f"{folder}/.latest", f"{folder}/latest")
        return path

    def path(self, uri: str) -> str:
        """The data of art://name:version or art://name (the latest)."""
        name, _, version = uri.removeprefix("art://").partition(":")
        if not version or version == "latest":
            with open(f"{self.root}/{name}/latest") as f:
                version = f.read().strip()
        return f"{self.root}/{name}/v{version.removeprefix('v')}/data"

    def read(self, spark: SparkSession, uri: str) -> DataFrame:
        return spark.read.parquet(self.path(uri))
