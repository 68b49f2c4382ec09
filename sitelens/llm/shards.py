"""Training-order shards: every sequence at a permuted global slot, in files of fixed stride."""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.scale import shared_dir
from sitelens.llm.packing import END_ID, pieces
from sitelens.llm.text import U64, mix
from sitelens.sources.files import qualified

SEQUENCE, SHARD, KEY, FEISTEL_ROUNDS = 512, 16_384, 20_240_601, 4
#: exchanges that the shards are dealt through, one after the other
DEALS = 4
#: removes a write's shuffle files at its end; a Spark without it keeps them until the driver's garbage is collected
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def permuted(index: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """The slot of each index: a keyed Feistel network over the next even power of two, cycle-walked into [0, n)."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    low = U64((1 << half) - 1)
    out = index.astype(U64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> U64(half), out[todo] & low
        for turn in range(FEISTEL_ROUNDS):
            salt = U64((key * 0x9E3779B97F4A7C15 + turn * 0xD1342543DE82EF95) % (1 << 64))
            left, right = right, left ^ (mix(right + salt) & low)
        out[todo] = left << U64(half) | right
        todo = todo[out[todo] >= U64(n)]
    return out.astype(np.int64)


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))


ROWS = "doc_id long, start long, length long, ids_crc32 long, slot long, shard long, byte_offset long"


def write_shards(
    docs: DataFrame, path: str, folder: str, size: int = SEQUENCE, per_shard: int = SHARD, key: int = KEY
) -> DataFrame:
    """doc_id, start, length, ids_crc32, slot, shard, byte_offset of every sequence, once its shards are written.

    Documents are tokenised once, each cut into sequences of at most ``size`` ids (a null text
    is the end id alone), and staged.  Sequences are numbered 0 .. N-1 by file part and row; the
    permutation gives each a slot, and slots are cut into ranges of ``per_shard``, the shards.
    The shards are dealt in ``DEALS`` runs of neighbours, each through an exchange of its own, whose
    files Spark removes when the run's shards are written: beside staged ids and shards, about a
    ``DEALS``-th of the ids is on disk at a time.  Partition i of a run's exchange is its range i, whole,
    and its task writes the shard in slot order: records of ``size`` ids, 16 bits each, short
    ones padded with the end id.  A task writes under a name of its own and renames at the end, so a repeated
    task replaces a shard by the same bytes, and readers never see half a shard.  Every record
    is at ``(slot % per_shard) * size * 2`` of its shard: reading on from any slot is a seek.
    ``manifest.json`` states N, size, per_shard and key.  Repeated rows are sequences of their
    own; an empty table writes only the manifest.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder)
    end = np.array([END_ID], "<u2").tobytes()

    names = ["doc_id", "start", "length", "ids_crc32", "ids"]
    staged_at = f"{shared_dir(spark)}/sequences-{uuid.uuid4().hex}"
    cut = pieces(docs, path, size, with_ids="<u2").select(*names)  # 16 bits each
    numbered = cut.withColumn("_id", F.monotonically_increasing_id())
    numbered.select("*", F.expr("_id >> 33").alias("_part"), F.expr("_id & ((1L << 33) - 1)").alias("_row")).drop("_id").write.option(
        "compression", "zstd"
    ).parquet(staged_at)
    staged = spark.read.parquet(staged_at)
    # one row per written part
    parts = staged.groupBy("_part").agg(F.count("*").alias("_n")).orderBy("_part").collect()
    part_ids = np.array([r["_part"] for r in parts], np.int64)
    ends = np.cumsum([r["_n"] for r in parts], dtype=np.int64)
    total = int(ends[-1]) if parts else 0
    before = np.concatenate([[0], ends[:-1]]) if parts else ends
    filesystem, root = _open(folder)
    filesystem.create_dir(root)
    with filesystem.open_output_stream(f"{root}/manifest.json") as out:
        out.write(json.dumps({"sequences": total, "size": size, "per_shard": per_shard, "key": key}).encode())

    def place(part: pd.Series, row: pd.Series) -> pd.Series:
        return pd.Series(permuted(before[np.searchsorted(part_ids, part)] + row.to_numpy(), total, key))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = _open(folder)
        shard, out, temporary = None, None, None

        def close() -> None:
            if out is not None:
                out.close()
                filesystem.move(temporary, f"{root}/shard-{shard:08d}.bin")

        for batch in batches:
            slots = batch.column("slot").to_numpy(zero_copy_only=False)
            for s, ids in zip(slots.tolist(), batch.column("ids").to_pylist()):
                if s // per_shard != shard:
                    close()
                    shard = s // per_shard
                    temporary = f"{root}/_{uuid.uuid4().hex}"
                    out = filesystem.open_output_stream(temporary)
                out.write(ids + end * (size - len(ids) // 2))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "slot", "shard")), pa.array(slots % per_shard * size * 2)],
                [c.split()[0] for c in ROWS.split(", ")],
            )
        close()

    # nondeterministic to Spark: else the filter below would have it run twice
    slot_of = F.pandas_udf(place, "long").asNondeterministic()
    slotted = staged.withColumn("slot", slot_of("_part", "_row")).select(*names, "slot", F.expr(f"slot div {per_shard}").alias("shard"))
    done_at = f"{shared_dir(spark)}/slots-{uuid.uuid4().hex}"
    shards = max(1, -(-total // per_shard))
    deals = min(DEALS, shards)
    cleaned = spark.conf.get(CLEAN, None)
    spark.conf.set(CLEAN, "true")
    try:
        for deal in range(deals):
            first, stop = shards * deal // deals, shards * (deal + 1) // deals
            run = slotted.filter(f"shard >= {first} AND shard < {stop}")
            dealt = run.repartitionById(stop - first, F.expr(f"cast(shard - {first} AS int)"))
            dealt.sortWithinPartitions("slot").mapInArrow(write, ROWS).write.mode("append").parquet(done_at)
    finally:
        spark.conf.set(CLEAN, cleaned) if cleaned is not None else spark.conf.unset(CLEAN)
    return spark.read.schema(ROWS).parquet(done_at)


def read_slots(folder: str, first: int, count: int) -> Iterator[np.ndarray]:
    """Records from slot ``first`` on, each by its place alone."""
    filesystem, root = _open(folder)
    with filesystem.open_input_stream(f"{root}/manifest.json") as f:
        m = json.loads(f.read())
    slot, stop = first, min(first + count, m["sequences"])
    while slot < stop:
        shard = slot // m["per_shard"]
        upto = min(stop, (shard + 1) * m["per_shard"])
        with filesystem.open_input_file(f"{root}/shard-{shard:08d}.bin") as f:
            f.seek(slot % m["per_shard"] * m["size"] * 2)
            data = f.read((upto - slot) * m["size"] * 2)
        yield from np.frombuffer(data, "<u2").reshape(-1, m["size"])
        slot = upto


def checksum(record: np.ndarray, length: int) -> int:
    """``ids_crc32`` of a record read back."""
    return zlib.crc32(record[:length].astype("<u4").tobytes())
