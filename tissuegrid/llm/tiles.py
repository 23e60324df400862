"""Near-duplicate vectors: tile products of int8 vectors, with error bounds that leave few pairs to full precision.

A unit vector u is stored as s * q + e, where q holds whole numbers from -127 to 127. For two vectors
u.v = s t (q.r) + (s q).f + e.(t r) + e.f, so |u.v - s t (q.r)| <= |s q| |f| + |e| |t r| + |e| |f|, all norms known per
vector. A pair whose estimate plus that bound stays under the threshold cannot be linked; every other pair is computed
again in double precision.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissuegrid.llm import stars
from tissuegrid.runtime import cut_lineage

#: Vectors of one side of a tile product, tiles at least (so that small tables use all cores), and rows worked on at once.
TILE, LEAST_TILES, STRIP = 4096, 8, 256
#: What rounding in double precision may add to the bound.
SLACK = 1e-9


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, row, v): all rows with a number of their own; v is null unless it holds finite numbers only, not all zero."""
    v = F.col(vector_col).cast("array<double>")
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), v.alias("v"))
    return rows.withColumn("v", F.when(sound, F.col("v")))


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows over their largest entry, then over their norm: no square over- or underflows."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors, scales, norms of the stored part and of the error."""
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    stored = q * scale[:, None]
    return q, scale, np.sqrt((stored * stored).sum(axis=1)), np.sqrt(((unit - stored) ** 2).sum(axis=1))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id, kept.

    Two vectors are linked if their cosine in double precision is at least ``threshold``; n_links counts the other
    vectors linked directly, component_id is the smallest id reachable by links, kept marks the row that has it.

    A vector that is null, empty, zero or holds a null, NaN or infinite component is linked with nothing, and vectors of
    different lengths are not linked. Equal vectors and repeated rows are rows of their own, link with each other and
    have links of their own, whatever their ids. A null id takes part as any other but names no component; a component
    without any id has none. Other columns are not looked at; an empty table gives an empty result.
    """
    rows = cut_lineage(_packed(usable(vectors, id_col, vector_col)))  # written, so that row numbers stay
    packed = rows.where("q IS NOT NULL").drop("id")
    n = packed.count()
    tiles = max(LEAST_TILES, math.ceil(n / TILE))
    tile = F.pmod(F.xxhash64("row"), F.lit(tiles))
    other = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    dealt = packed.withColumn("tile", tile).withColumn("other", other)
    dealt = dealt.withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other")).drop("other")

    def product(table: pa.Table) -> pa.Table:
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        left = table.filter(pc.equal(table.column("tile"), low))
        right = left if low == high else table.filter(pc.equal(table.column("tile"), high))
        return _links(left, right, threshold, low == high)

    shape = "row long, n_links long, a long, b long"
    found = cut_lineage(dealt.groupBy("low", "high").applyInArrow(product, shape))
    counts = found.where("n_links is not null").groupBy("row").agg(F.sum("n_links").alias("n_links"))
    parts = cut_lineage(stars.components(found.where("n_links is null").select("a", "b"), "a", "b").withColumnRenamed("node", "row"))
    ids = rows.select("id", "row")
    names = parts.join(ids, "row").groupBy("component").agg(F.min("id").alias("name"))
    joined = ids.join(counts, "row", "left").join(parts.join(names, "component"), "row", "left")
    component = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("name"))
    return joined.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))


def _packed(sound: DataFrame) -> DataFrame:
    """(id, row, dim, q, scale, stored, error, unit): bytes of the int8 vector and of the unit vector in double precision.

    Rows whose v is null have none of them.
    """

    def pack(batches):
        for batch in batches:
            rows = [np.asarray(x.values, dtype=np.float64) if x.is_valid else () for x in batch.column(2)]
            out = {k: [None] * len(rows) for k in ("q", "scale", "stored", "error", "unit")}
            dims = np.array([len(r) for r in rows], dtype=np.int64)
            for dim in np.unique(dims[dims > 0]):
                at = np.flatnonzero(dims == dim)
                unit = _unit(np.stack([rows[i] for i in at]))
                q, scale, stored, error = _quantised(unit)
                for k, i in enumerate(at):
                    out["q"][i], out["unit"][i] = q[k].tobytes(), unit[k].tobytes()
                    out["scale"][i], out["stored"][i], out["error"][i] = scale[k], stored[k], error[k]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(dims), pa.array(out["q"], pa.binary()), *(pa.array(out[k], pa.float64()) for k in ("scale", "stored", "error")), pa.array(out["unit"], pa.binary())],
                names=["id", "row", "dim", "q", "scale", "stored", "error", "unit"],
            )

    return sound.select("id", "row", "v").mapInArrow(pack, "id long, row long, dim long, q binary, scale double, stored double, error double, unit binary")


def _links(left: pa.Table, right: pa.Table, threshold: float, same: bool) -> pa.Table:
    """Rows (row, n_links) of vectors with links in this pair of tiles, and edges (a, b) that span their components."""
    left, right = left.combine_chunks(), right.combine_chunks()
    sides = []
    for side in (left, right):
        dims = side.column("dim").to_numpy()
        sides.append({d: np.flatnonzero(dims == d) for d in np.unique(dims)})
    ids = [side.column("row").to_pylist() for side in (left, right)]
    n = len(ids[0]), len(ids[1])
    links = [np.zeros(n[0], dtype=np.int64), np.zeros(n[1], dtype=np.int64)]
    root = np.arange(n[0] if same else n[0] + n[1])
    shift = 0 if same else n[0]
    edges = []
    for dim in sides[0].keys() & sides[1].keys():
        at = [sides[k][dim] for k in (0, 1)]
        arrays = []
        for side, rows in zip((left, right), at):
            part = side.take(pa.array(rows)).combine_chunks()
            q = np.frombuffer(b"".join(part.column("q").to_pylist()), dtype=np.int8).reshape(len(rows), dim)
            unit = np.frombuffer(b"".join(part.column("unit").to_pylist()), dtype=np.float64).reshape(len(rows), dim)
            # Products of whole numbers up to 127 are exact in float32 as long as they stay under 2^24.
            exact = np.float32 if dim * 127 * 127 < 1 << 24 else np.float64
            arrays.append((q.astype(exact), unit, *(part.column(c).to_numpy() for c in ("scale", "stored", "error"))))
        (q, u, s, stored, error), (r, v, t, kept, rest) = arrays
        for first in range(0, len(q), STRIP):
            rows = slice(first, first + STRIP)
            estimate = (q[rows] @ r.T) * s[rows, None] * t[None, :]
            bound = stored[rows, None] * rest[None, :] + error[rows, None] * (kept + rest)[None, :]
            i, j = np.nonzero(estimate + bound >= threshold - SLACK)
            i += first
            if same:
                i, j = i[i < j], j[i < j]
            for part in range(0, len(i), 1 << 15):
                a, b = i[part: part + (1 << 15)], j[part: part + (1 << 15)]
                sure = (u[a] * v[b]).sum(axis=1) >= threshold
                a, b = at[0][a[sure]], at[1][b[sure]]
                np.add.at(links[0], a, 1)
                np.add.at(links[0] if same else links[1], b, 1)
                apart = root[a] != root[b + shift]
                for x, y in zip(a[apart].tolist(), b[apart].tolist()):
                    if root[x] != root[y + shift]:
                        root[root == root[y + shift]] = root[x]
                        edges.append((ids[0][x], ids[1][y]))
    rows = [(ids[0][k], int(links[0][k])) for k in np.flatnonzero(links[0])]
    if not same:
        rows += [(ids[1][k], int(links[1][k])) for k in np.flatnonzero(links[1])]
    none = [None] * len(edges)
    return pa.table({
        "row": pa.array([x[0] for x in rows] + none, pa.int64()),
        "n_links": pa.array([x[1] for x in rows] + none, pa.int64()),
        "a": pa.array([None] * len(rows) + [x[0] for x in edges], pa.int64()),
        "b": pa.array([None] * len(rows) + [x[1] for x in edges], pa.int64()),
    })
