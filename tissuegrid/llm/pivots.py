"""Exact search for the k largest inner products by pivot-table elimination.

With distances d to pivots p, the triangle inequality gives d(q, x) >= |d(q, p) - d(x, p)| for every pivot, and
q.x = (|q|^2 + |x|^2 - d(q, x)^2) / 2, so the largest of the lower bounds caps the inner product from above. Candidates
are evaluated in the order of their caps until the k-th best score is above all caps that are left.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tissuegrid.runtime import cut_lineage

#: Pivots, and the rows of the bounded sample they are chosen from; both fixed, whatever the table.
PIVOTS, SAMPLE = 24, 2000
#: Queries and candidates that meet in a task, tiles of candidates at least, candidates evaluated per look at the caps.
QUERIES, CANDIDATES, LEAST_TILES, STEP = 256, 8192, 6, 512


def scaled(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v) with v the whole numbers floor(scale * x), x as double; vectors with null or non-finite parts are left out."""
    v = F.col(vector_col).cast("array<double>")
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("v").isNotNull() & sound & F.col("id").isNotNull())
    return rows.select("id", whole.alias("v"))


def choose_pivots(rows: DataFrame, dim: int, pivots: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Vectors far from each other, picked greedily from ``sample`` rows with the smallest hash of their id."""
    picked = rows.where(F.size("v") == dim).orderBy(F.xxhash64("id", F.lit(3)), "id").limit(sample).select("v").toPandas()["v"]
    points = np.stack([np.asarray(x, dtype=np.float64) for x in picked])
    chosen, far = [0], ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(pivots, len(points)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def _pack(rows: DataFrame, pivots: np.ndarray, dim: int) -> DataFrame:
    """(id, v, far, square): the numbers as bytes, the pivot table's row, and the squared length.

    Numbers whose products could pass 64 bits are an error.
    """
    most = math.isqrt((1 << 62) // max(1, dim))

    def pack(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v = np.asarray(batch.column(1).flatten(), dtype=np.int64).reshape(batch.num_rows, dim)
            if ((v > most) | (v < -most)).any():
                raise ValueError(f"a component scaled to a whole number is over {most}: inner products would pass 64 bits")
            x = v.astype(np.float64)
            far = np.sqrt(((x[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2))
            square = (x * x).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in v], pa.binary()), pa.array([r.tobytes() for r in far], pa.binary()), pa.array(square)],
                names=["id", "v", "far", "square"],
            )

    return rows.where(F.size("v") == dim).mapInArrow(pack, "id long, v binary, far binary, square double")


def _best_here(queries: pa.Table, candidates: pa.Table, k: int, pivots: int) -> list[tuple[int, int, int]]:
    """(number of the query, id, score) of the k best candidates of this tile for each query."""
    def arrays(t):
        t = t.combine_chunks()
        v = np.frombuffer(b"".join(t.column("v").to_pylist()), dtype=np.int64).reshape(t.num_rows, -1)
        far = np.frombuffer(b"".join(t.column("far").to_pylist()), dtype=np.float64).reshape(t.num_rows, pivots)
        return t.column("id").to_numpy(), v, far, t.column("square").to_numpy(), t.column("query").to_numpy(zero_copy_only=False)

    qid, qv, qfar, qsquare, number = arrays(queries)
    cid, cv, cfar, csquare, _ = arrays(candidates)
    order = np.argsort(cid, kind="stable")
    cid, cv, cfar, csquare = cid[order], cv[order], cfar[order].T.copy(), csquare[order]
    out = []
    for i in range(len(qid)):
        apart = np.zeros(len(cid))
        for p in range(pivots):
            np.maximum(apart, np.abs(cfar[p] - qfar[i, p]), out=apart)
        # Half a unit covers the rounding of distances: scores are whole numbers.
        cap = (qsquare[i] + csquare - apart * apart * (1 - 1e-12)) / 2 * (1 + 1e-12) + 0.5
        cap[cid == qid[i]] = -np.inf
        look = np.argsort(-cap, kind="stable")
        look = look[cap[look] > -np.inf]
        ids, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for at in range(0, len(look), STEP):
            if len(scores) >= k and cap[look[at]] < scores[k - 1]:
                break
            part = look[at: at + STEP]
            ids, scores = np.append(ids, cid[part]), np.append(scores, cv[part] @ qv[i])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
        out += [(int(number[i]), int(qid[i]), int(a), int(b)) for a, b in zip(ids, scores)]
    return out


def top_products(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, every: int = 100, scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every`` its k best other rows.

    Scores are inner products of the vectors' whole numbers floor(scale * x), ties go to the smaller id, and a query with
    fewer than k candidates gets them all. Rows with a null id or vector, or a null, NaN or infinite component, take no
    part; rows of different vector lengths are not compared. A row with the query's own id is no candidate; repeated rows
    are candidates of their own. Rows that repeat a query's id and numbers are one query; an id with different vectors
    gives a query, with ranks of its own, for each. Numbers whose inner products could pass 64 bits are an error. Other
    columns are not looked at; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = cut_lineage(scaled(vectors, id_col, vector_col, scale))
    dims = [r[0] for r in rows.select(F.size("v").alias("d")).distinct().collect()]  # vector lengths, few
    parts = [_search(rows, dim, k, every) for dim in sorted(dims)]
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("dim", "query", "query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _search(rows: DataFrame, dim: int, k: int, every: int) -> DataFrame:
    pivots = choose_pivots(rows, dim)
    packed = cut_lineage(_pack(rows, pivots, dim).withColumn("row", F.monotonically_increasing_id()))
    asked = packed.where(F.col("id") % every == 0).dropDuplicates(["id", "v"])
    asked = cut_lineage(asked.withColumn("query", F.monotonically_increasing_id()))
    n, m = packed.count(), asked.count()
    tiles, blocks = max(LEAST_TILES, math.ceil(n / CANDIDATES)), max(1, math.ceil(m / QUERIES))
    block = F.pmod(F.xxhash64("query", F.lit(1)), F.lit(blocks))
    tile = F.pmod(F.xxhash64("row", F.lit(2)), F.lit(tiles))
    each_tile, each_block = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    queries = asked.select("id", "v", "far", "square", "query", F.lit(True).alias("asks"), block.cast("int").alias("block"), each_tile.alias("tile"))
    candidates = packed.select("id", "v", "far", "square", F.lit(None).cast("long").alias("query"), F.lit(False).alias("asks"), each_block.alias("block"), tile.cast("int").alias("tile"))
    width = len(pivots)

    def search(table: pa.Table) -> pa.Table:
        asks = table.column("asks")
        mine, others = table.filter(asks), table.filter(pc.invert(asks))
        out = _best_here(mine, others, k, width) if mine.num_rows and others.num_rows else []
        return pa.table({n: pa.array([r[c] for r in out], pa.int64()) for c, n in enumerate(("query", "query_id", "vec_id", "score"))})

    found = queries.unionByName(candidates).groupBy("block", "tile").applyInArrow(search, "query long, query_id long, vec_id long, score long")
    return found.withColumn("dim", F.lit(dim))
