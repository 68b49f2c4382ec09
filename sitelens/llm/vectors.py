"""Near-duplicate vectors by tiles, leading principal components first."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.scale import staged
from sitelens.llm.graph import components, forest

COSINE, TILE, LEADING = 0.95, 2048, 16
CLOSE = 1e-9


def _vectors(column: pa.Array) -> Iterator[np.ndarray | None]:
    """Each vector in double precision, or None if it cannot link."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.values
    nulls = values.is_null().to_numpy(zero_copy_only=False)
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64)
    for ok, a, b in zip(column.is_valid().to_pylist(), column.offsets.to_numpy()[:-1], column.offsets.to_numpy()[1:]):
        x = flat[a:b] if ok else None
        good = ok and b > a and not nulls[a:b].any() and np.isfinite(x).all() and x.any()
        yield x + 0.0 if good else None


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max()
    return x / math.sqrt(x @ x)


def digests(vectors: DataFrame) -> DataFrame:
    """(vec_id, node, dim, x): digest and values of each vector; null where it cannot link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, dim, x = [], [], []
            for v in _vectors(batch.column("embedding")):
                node.append(None if v is None else hashlib.blake2b(v.tobytes(), digest_size=16).digest())
                dim.append(None if v is None else len(v))
                x.append(None if v is None else v.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(node, pa.binary()), pa.array(dim, pa.int32()), pa.array(x, pa.binary())],
                ["vec_id", "node", "dim", "x"],
            )

    slim = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return slim.mapInArrow(run, "vec_id long, node binary, dim int, x binary")


def rotations(reps: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes by dimension, leading first, from sums of outer products over all vectors.

    Only one dim x dim matrix per dimension reaches the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, x in zip(batch.column("dim").to_pylist(), batch.column("x").to_pylist()):
                v = unit(np.frombuffer(x))
                if d not in sums:
                    sums[d] = np.zeros((d, d))
                sums[d] += np.outer(v, v)
        for d, s in sums.items():
            rows = [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array(list(s), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(rows, ["dim", "i", "s"])

    parts = reps.select("dim", "x").mapInArrow(run, "dim int, i int, s array<double>")
    cells = parts.select("dim", "i", F.posexplode("s").alias("j", "s")).groupBy("dim", "i", "j").agg(F.sum("s").alias("s"))
    sums: dict[int, np.ndarray] = {}
    for r in cells.toLocalIterator():
        sums.setdefault(r["dim"], np.zeros((r["dim"], r["dim"])))[r["i"], r["j"]] = r["s"]
    return {d: np.linalg.eigh((s + s.T) / 2)[1][:, ::-1] for d, s in sums.items()}


def tile_links(a: np.ndarray, b: np.ndarray, raw_a: np.ndarray, raw_b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows with cosine >= ``threshold``; ``a``, ``b`` are unit vectors on principal axes.

    Products of the leading axes come first.  What the other axes can add is at most the
    product of the suffix norms, so rows and columns with no pair left drop out after each
    step, and a tile with none stops.  Cosines next to the threshold are taken again from the
    vectors as given.
    """
    rows, cols = np.arange(len(a)), np.arange(len(b))
    dims = a.shape[1]
    done, dot = 0, np.zeros((len(a), len(b)))
    while done < dims and len(rows) and len(cols):
        step = min(dims, done + LEADING)
        dot += a[rows, done:step] @ b[cols, done:step].T
        done = step
        ra = np.sqrt((a[rows, done:] ** 2).sum(axis=1))
        rb = np.sqrt((b[cols, done:] ** 2).sum(axis=1))
        open_pair = dot + np.outer(ra, rb) >= threshold - CLOSE
        keep_r, keep_c = open_pair.any(axis=1), open_pair.any(axis=0)
        if not keep_r.all() or not keep_c.all():
            rows, cols, dot = rows[keep_r], cols[keep_c], dot[np.ix_(keep_r, keep_c)]
    i, j = np.nonzero(dot >= threshold - CLOSE)
    near = np.flatnonzero(np.abs(dot[i, j] - threshold) <= CLOSE)
    keep = np.ones(len(i), bool)
    for k in near:
        p, q = raw_a[rows[i[k]]], raw_b[cols[j[k]]]
        keep[k] = p @ q / (math.sqrt(p @ p) * math.sqrt(q @ q)) >= threshold
    return rows[i[keep]], cols[j[keep]]


def near_vectors(vectors: DataFrame, threshold: float = COSINE, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every vector, linked by cosine >= ``threshold``.

    Equal vectors are one node with a count.  Nodes are ordered by their leading principal
    component and dealt into tiles; two tiles meet only if their ranges of it are closer than
    linked unit vectors can be apart.  A pair of tiles gives link counts and a spanning forest,
    never its pairs, so a cluster of any size costs as many rows as it has members per tile.

    Vectors that are null, zero, or hold null or non-finite components, and vectors of other
    lengths, link with nothing.  Rows that repeat a vec_id are vectors of their own in counts;
    component_id is the smallest vec_id of the component; a null vec_id has the component of its
    copies.  An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    found = staged(digests(vectors))
    reps = staged(found.filter("node IS NOT NULL").groupBy("node").agg(F.first("dim").alias("dim"), F.first("x").alias("x"), F.count("*").alias("copies")))
    axes = rotations(reps)
    turned = {d: np.ascontiguousarray(q) for d, q in axes.items()}

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = [float(unit(np.frombuffer(x)) @ turned[d][:, 0]) for d, x in zip(batch.column("dim").to_pylist(), batch.column("x").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(y)], [*batch.schema.names, "y"])

    placed = staged(reps.mapInArrow(lead, "node binary, dim int, x binary, copies long, y double"))
    # tiles: equal steps of the leading component, each dealt by hash into as many as it needs
    width = math.sqrt(2 - 2 * threshold) / 4
    slotted = placed.withColumn("_slot", F.floor(F.col("y") / width))
    sizes = slotted.groupBy("dim", "_slot").agg(F.ceil(F.count("*") / tile).alias("_tiles"))
    dealt = slotted.join(sizes, ["dim", "_slot"]).withColumn("_part", F.expr("pmod(xxhash64(node), _tiles)"))
    reach = 5  # slots apart that a linked pair can be, with the slot's own width
    a = sizes.selectExpr("dim", "_slot AS s1", "_tiles AS n1", f"explode(sequence(_slot, _slot + {reach})) AS s2")
    pairs = a.join(sizes.selectExpr("dim", "_slot AS s2", "_tiles AS n2"), ["dim", "s2"])
    pairs = pairs.selectExpr("dim", "s1", "s2", "n2", "explode(sequence(0L, n1 - 1)) AS p1").selectExpr(
        "dim", "s1", "s2", "p1", "explode(sequence(if(s1 = s2, p1, 0L), n2 - 1)) AS p2"
    )
    pairs = staged(pairs.withColumn("job", F.monotonically_increasing_id()))
    one = pairs.selectExpr("dim", "s1 AS _slot", "p1 AS _part", "job", "0 AS side", "(s1 = s2 AND p1 = p2) AS own")
    two = pairs.filter("s1 != s2 OR p1 != p2").selectExpr("dim", "s2 AS _slot", "p2 AS _part", "job", "1 AS side", "false AS own")
    sent = dealt.join(one.unionAll(two), ["dim", "_slot", "_part"]).select("job", "side", "own", "node", "x", "copies", "dim")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        axis = turned[int(pdf["dim"].iloc[0])]
        raw = np.stack([np.frombuffer(x) for x in pdf["x"]])
        scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
        y = scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True)) @ axis
        side, node, copies = pdf["side"].to_numpy(), pdf["node"].to_numpy(), pdf["copies"].to_numpy()
        first = np.flatnonzero(side == 0)
        second = first if pdf["own"].any() else np.flatnonzero(side == 1)
        i, j = tile_links(y[first], y[second], raw[first], raw[second], threshold)
        u, v = first[i], second[j]
        if second is first:
            u, v = u[u != v], v[u != v]
        links = np.bincount(u, copies[v], len(pdf))
        if second is not first:
            links += np.bincount(v, copies[u], len(pdf))
        root = forest(u, v, len(pdf))
        some = np.flatnonzero(links > 0)
        return pd.DataFrame({"u": node[some], "v": node[root[some]], "n": links[some].astype(np.int64)})

    tiles = staged(sent.groupBy("job").applyInPandas(compare, "u binary, v binary, n long"))
    counts = tiles.groupBy("u").agg(F.sum("n").alias("n"))
    linked = components(tiles.select("u", "v")).select(F.col("node").alias("u"), "label")
    nodes = (
        reps.select(F.col("node").alias("u"), "copies")
        .join(counts, "u", "left")
        .join(linked, "u", "left")
        .select(F.col("u").alias("node"), F.expr("coalesce(n, 0L) + copies - 1").alias("n_links"), F.coalesce("label", "u").alias("label"))
    )
    rows = found.select("vec_id", "node").join(nodes, "node", "left")
    least = rows.filter("label IS NOT NULL").groupBy("label").agg(F.min("vec_id").alias("_least"))
    return rows.join(least, "label", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("_least", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
