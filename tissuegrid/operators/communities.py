"""Communities of a weighted graph by modularity, and labels for them.

A level has three steps: nodes move to the neighbouring community of largest gain until none gains; each community is
refined into connected parts; the parts become the nodes of the next level, which starts from the communities found. It
ends when no node of a level joins another, so every community is one part and none falls apart. Levels run as joins on Spark; a level whose edges
fit a stated bound is finished inside one task, together with those after it. In a larger level nodes are dealt to blocks of
about that many edges; a round moves the nodes of each block one after the other in a task that knows the communities
around it as they were before the round. Once the nodes that gain have few enough edges, one task moves them, and those
nearest to a move, one after the other. A level ends when a round over all nodes finds none that gains.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissuegrid.operators.components import connected_nodes
from tissuegrid.operators.neighbours import neighbour_graph
from tissuegrid.operators.orderstats import numbered, positions
from tissuegrid.runtime import cut_lineage

#: Rounds of a level and levels before the run is an error: a search that is cut off gives other communities.
MOST_ROUNDS, MOST_LEVELS = 400, 64
#: Directed edges of a level that is finished inside one task.
SMALL = 1 << 18
#: Gains below this are rounding.
LEAST_GAIN = 1e-10


# --- a small graph in one task ---------------------------------------------------------------------


class _Graph:
    """Edges by source, strengths and loops of a small graph with nodes 0..n-1."""

    def __init__(self, src: np.ndarray, dst: np.ndarray, w: np.ndarray, n: int):
        self.n, self.k = n, np.bincount(src, weights=w, minlength=n).tolist()
        plain = src != dst
        src, dst, w = src[plain], dst[plain], w[plain]
        order = np.lexsort((dst, src))
        ends = np.cumsum(np.bincount(src, minlength=n))
        self.near = [list(zip(d.tolist(), x.tolist())) for d, x in zip(np.split(dst[order], ends[:-1]), np.split(w[order], ends[:-1]))]


def _toward(graph: _Graph, v: int, group: list[int]) -> dict[int, float]:
    """Weight of the edges of v by the group they lead to."""
    out: dict[int, float] = {}
    for u, w in graph.near[v]:
        out[group[u]] = out.get(group[u], 0.0) + w
    return out


def _move(graph: _Graph, start: list[int], scale: float, order: list[int]) -> list[int]:
    """Nodes go to the community of largest gain, one after the other, until none gains; ties go to the smaller number.

    A node that loses by staying and has nothing better goes to a community of its own.
    """
    group, total, size = list(start), [0.0] * graph.n, [0] * graph.n
    for v, c in enumerate(group):
        total[c] += graph.k[v]
        size[c] += 1
    empty = [c for c in range(graph.n) if not size[c]]
    waiting, queued = deque(order), [True] * graph.n
    while waiting:
        v = waiting.popleft()
        queued[v] = False
        own, k = group[v], graph.k[v]
        options = _toward(graph, v, group)
        total[own] -= k
        best, most = own, options.get(own, 0.0) - scale * k * total[own]
        for c, w in options.items():
            gain = w - scale * k * total[c]
            if gain > most + LEAST_GAIN or (gain > most - LEAST_GAIN and c < best and best != own):
                best, most = c, max(gain, most)
        if most < -LEAST_GAIN and size[own] > 1:
            best = empty.pop()
        total[best] += k
        if best != own:
            group[v] = best
            size[own] -= 1
            size[best] += 1
            if not size[own]:
                empty.append(own)
            for u, _ in graph.near[v]:
                if group[u] != best and not queued[u]:
                    queued[u] = True
                    waiting.append(u)
    return group


def _refine(graph: _Graph, group: list[int], scale: float, order: list[int], whole: list[float] | None = None) -> list[int]:
    """Connected parts of the communities: lone nodes that are well tied to their community join a part beside them.

    ``whole``: strengths of the communities, where the graph does not hold all of their nodes.
    """
    part, size, total = list(range(graph.n)), [1] * graph.n, list(graph.k)
    if whole is None:
        whole = np.bincount(group, weights=graph.k, minlength=graph.n).tolist()
    for v in order:
        if size[part[v]] > 1:
            continue
        inside = {u: w for u, w in graph.near[v] if group[u] == group[v]}
        if sum(inside.values()) < scale * graph.k[v] * (whole[group[v]] - graph.k[v]) - LEAST_GAIN:
            continue
        options: dict[int, float] = {}
        for u, w in inside.items():
            options[part[u]] = options.get(part[u], 0.0) + w
        best, most = part[v], 0.0
        for c, w in options.items():
            gain = w - scale * graph.k[v] * total[c]
            if gain > most + LEAST_GAIN or (gain > most - LEAST_GAIN and c < best and best != part[v]):
                best, most = c, max(gain, most)
        if best != part[v]:
            size[part[v]], total[part[v]] = 0, 0.0
            part[v] = best
            size[best] += 1
            total[best] += graph.k[v]
    return part


def _components(graph: _Graph, group: list[int]) -> list[int]:
    """Connected parts of the communities, each named by its smallest node."""
    part = [-1] * graph.n
    for first in range(graph.n):
        front = [first] if part[first] < 0 else []
        while front:
            v = front.pop()
            if part[v] < 0:
                part[v] = first
                front += [u for u, _ in graph.near[v] if group[u] == group[v]]
    return part


def _finish(edges: pd.DataFrame, resolution: float, seed: int) -> pd.DataFrame:
    """(node, c) of a small graph: all levels from here on. ``edges``: src, dst, w, cs, cd with starting communities."""
    names, ends = np.unique(np.concatenate([edges["src"], edges["dst"]]), return_inverse=True)
    src, dst, w = ends[: len(edges)], ends[len(edges):], edges["w"].to_numpy(dtype=float)
    n, scale = len(names), resolution / w.sum()
    start = np.zeros(n, dtype=np.int64)
    start[src], start[dst] = edges["cs"], edges["cd"]
    group = np.unique(start, return_inverse=True)[1].tolist()
    home = np.arange(n)
    rng = np.random.default_rng(seed)
    while True:
        graph, order = _Graph(src, dst, w, n), rng.permutation(n).tolist()
        group = _move(graph, group, scale, order)
        if len(set(group)) == n:
            break
        part = np.array(_refine(graph, group, scale, order))
        kept, number = np.unique(part, return_inverse=True)
        if len(kept) == n:  # only ties hold the communities together
            group = _components(graph, group)
            break
        home = number[home]
        n = len(kept)
        label = np.empty(n, dtype=np.int64)
        label[number] = group
        pairs, which = np.unique(number[src] * n + number[dst], return_inverse=True)
        src, dst, w = pairs // n, pairs % n, np.bincount(which, weights=w)
        group = np.unique(label, return_inverse=True)[1].tolist()
    last = np.unique(np.array(group)[home], return_inverse=True)[1]
    first = np.full(last.max() + 1, len(names))
    np.minimum.at(first, last, np.arange(len(names)))
    return pd.DataFrame({"node": names, "c": names[first[last]]})


# --- large graphs as joins -------------------------------------------------------------------------


def _toward_groups(plain: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, c, w_in): weight of the edges of each node by the community they lead to."""
    ends = labels.select(F.col("node").alias("dst"), "c")
    return plain.join(ends, "dst").groupBy(F.col("src").alias("node"), "c").agg(F.sum("w").alias("w_in"))


class _Near:
    """Edges of the nodes that may move in a task, by place in the sorted ``nodes``; ``ids`` are all nodes they touch.

    ``src`` is a place in ``nodes``, ``dst`` one in ``ids``, sorted by both; loops are left out.
    """

    def __init__(self, nodes: np.ndarray, ids: np.ndarray, src: np.ndarray, dst: np.ndarray, w: np.ndarray, k: np.ndarray):
        self.nodes, self.ids, self.src, self.dst, self.w, self.k = nodes, ids, src, dst, w, k
        self.at = np.searchsorted(ids, nodes)

    def walk(self, group: list[int], total: dict[int, float], waiting: list[int], may: list[bool], scale: float, lone: bool = False) -> list[int]:
        """Groups of ``nodes`` after those of ``waiting`` have moved one after the other to the group of largest gain.

        Nodes beside one that moved come in again, if they ``may`` move, until none gains. ``group`` is by place in
        ``ids``, ``total`` the strength of each group. With ``lone`` nodes only join: one that is in company never moves
        again. Without, a node may leave for a group of its own, which has a number below zero.
        """
        first = np.searchsorted(self.src, np.arange(len(self.nodes) + 1)).tolist()
        back = np.full(len(self.ids), -1)
        back[self.at] = np.arange(len(self.nodes))
        name, at, back, dst, w, strength = (x.tolist() for x in (self.nodes, self.at, back, self.dst, self.w, self.k))
        crowd, queued, waiting = set(), set(waiting), deque(waiting)
        while waiting:
            v = waiting.popleft()
            queued.discard(v)
            own, k = group[at[v]], strength[v]
            if lone and own in crowd:
                continue
            near = dst[first[v]: first[v + 1]]
            options = {own: 0.0} if lone else {own: 0.0, -name[v] - 1: 0.0}
            for u, x in zip(near, w[first[v]: first[v + 1]]):
                c = group[u]
                options[c] = options.get(c, 0.0) + x
            gains = {c: round(x - scale * k * (total.get(c, 0.0) - (k if c == own else 0.0)), 10) for c, x in options.items()}
            best = max(gains, key=lambda c: (gains[c], -c))
            if best == own or (gains[best] <= 0 if lone else gains[best] - gains[own] <= LEAST_GAIN * max(1.0, k) / 2):
                continue
            total[own] -= k
            total[best] = total.get(best, 0.0) + k
            group[at[v]] = best
            crowd.add(best)
            for u in near:
                i = back[u]
                if i >= 0 and may[i] and i not in queued and group[u] != best:
                    queued.add(i)
                    waiting.append(i)
        return [group[i] for i in at]

    def margins(self, c: np.ndarray, t: np.ndarray, scale: float) -> np.ndarray:
        """By how much each node prefers its group over all others, below zero if it gains by a move."""
        names, group = np.unique(c, return_inverse=True)
        total = np.zeros(len(names))
        total[group] = t
        own, n = group[self.at], len(names)
        pairs, which = np.unique(self.src * n + group[self.dst], return_inverse=True)
        v, g, into = pairs // n, pairs % n, np.bincount(which, weights=self.w, minlength=len(pairs))
        inside = g == own[v]
        now = -scale * self.k * (total[own] - self.k)
        now[v[inside]] += into[inside]
        other = np.where(total[own] > self.k * (1 + 1e-9), 0.0, -np.inf)  # a node by itself can't leave for one of its own
        v, g, into = v[~inside], g[~inside], into[~inside]
        np.maximum.at(other, v, into - scale * self.k[v] * total[g])
        return now - other


def _settled(near: DataFrame, placed: DataFrame, movers: DataFrame, strength: DataFrame, scale: float, lone: bool = False) -> DataFrame:
    """(node, c) of all nodes after the ``movers``, whose edges fit one task, have been settled there.

    ``placed``: node, c and t, the strength of c. ``movers``: node and whether it gains; the others move only once a node
    beside them has moved.
    """
    rows = near.join(movers.join(strength, "node").select(F.col("node").alias("src"), "gains", "k"), "src")
    rows = rows.join(placed.select(F.col("node").alias("src"), F.col("c").alias("cs"), F.col("t").alias("ts")), "src")
    rows = rows.join(placed.select(F.col("node").alias("dst"), F.col("c").alias("cd"), F.col("t").alias("td")), "dst")

    def settle(table: pa.Table) -> pa.Table:
        src, dst, w, gains, k, cs, ts, cd, td = (table.column(c).to_numpy() for c in ("src", "dst", "w", "gains", "k", "cs", "ts", "cd", "td"))
        order = np.lexsort((dst, src))
        nodes, first, place = np.unique(src, return_index=True, return_inverse=True)
        ids, ends = np.unique(np.concatenate([src, dst]), return_inverse=True)
        group = np.zeros(len(ids), dtype=np.int64)
        group[ends] = np.concatenate([cs, cd])
        total = dict(zip(np.concatenate([cs, cd]).tolist(), np.concatenate([ts, td]).tolist()))
        around = _Near(nodes, ids, place[order], ends[len(src):][order], w[order], k[first])
        moved = around.walk(group.tolist(), total, np.flatnonzero(gains[first]).tolist(), [True] * len(nodes), scale, lone)
        return pa.table({"node": pa.array(nodes, pa.int64()), "c": pa.array(moved, pa.int64())})

    moved = rows.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(settle, "node long, c long")
    joined = placed.join(moved.select("node", F.col("c").alias("_c")), "node", "left")
    return cut_lineage(joined.select("node", F.coalesce("_c", "c").alias("c")))


BLOCK = "block long, nodes binary, ids binary, src binary, dst binary, w binary, k binary, n_edges binary"


def _dealt(edges: DataFrame, start: DataFrame, strength: DataFrame, small: int, seed: int) -> tuple[DataFrame, DataFrame] | None:
    """Blocks of nodes with their edges, one row each, and (node, blocks) that have to know the community of a node.

    Nodes that start in one community go to one block, unless they have too many edges. Nodes with more than ``small``
    edges are in no block; without any others there are no blocks.
    """
    few = strength.where(F.col("n_edges") <= small)
    n_edges = few.agg(F.sum("n_edges")).first()[0]
    if n_edges is None:
        return None
    blocks = -(-n_edges // small)
    dealt = start.join(few, "node")
    parts = dealt.groupBy("c").agg(F.ceil(8 * F.sum("n_edges") / F.lit(small)).alias("parts"))
    block = F.pmod(F.xxhash64("c", F.pmod(F.xxhash64("node", F.lit(seed)), F.col("parts"))), F.lit(blocks))
    dealt = dealt.join(parts, "c").select(F.col("node").alias("src"), block.alias("block"))

    def pack(table: pa.Table) -> pa.Table:
        src, dst, w = (table.column(c).to_numpy() for c in ("src", "dst", "w"))
        order = np.lexsort((dst, src))
        src, dst, w = src[order], dst[order], w[order]
        nodes, place = np.unique(src, return_inverse=True)
        plain = src != dst
        ids, ends = np.unique(np.concatenate([nodes, dst]), return_inverse=True)
        ends = ends[len(nodes):]
        arrays = nodes, ids, place[plain], ends[plain], w[plain], np.bincount(place, weights=w), np.bincount(place)
        names = [part.split()[0] for part in BLOCK.split(", ")]
        return pa.table([table.column("block").slice(0, 1).combine_chunks(), *(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in arrays)], names=names)

    def ends_of(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], dtype=np.int64)
                yield pa.record_batch([pa.array(ids), pa.array(np.full(len(ids), row["block"]), pa.int64())], ["node", "block"])

    packs = cut_lineage(edges.join(dealt, "src").groupBy("block").applyInArrow(pack, BLOCK))
    ends = packs.select("ids", "block").mapInArrow(ends_of, "node long, block long")
    return packs, cut_lineage(ends.groupBy("node").agg(F.collect_list("block").alias("blocks")))


STEP = "node long, c long, gains boolean, margin double, n_edges long"


def _mover(scale: float, seed: int, turn: int):
    """A round of one block: who gains, by how much nodes prefer to stay, and where those whose turn it is have moved."""

    def move(pack: pa.Table, ends: pa.Table) -> pa.Table:
        row = pack.to_pylist()[0]
        nodes, ids, src, dst, n_edges = (np.frombuffer(row[x], dtype=np.int64) for x in ("nodes", "ids", "src", "dst", "n_edges"))
        near = _Near(nodes, ids, src, dst, np.frombuffer(row["w"]), np.frombuffer(row["k"]))
        order = np.argsort(ends.column("node").to_numpy())
        c, t, mine = (ends.column(x).to_numpy()[order] for x in ("c", "t", "mine"))
        margin = near.margins(c, t, scale)
        gains, may = margin < -LEAST_GAIN * np.maximum(1.0, near.k), mine[near.at]
        waiting = np.random.default_rng([abs(seed), turn, row["block"]]).permutation(np.flatnonzero(gains & may))
        moved = near.walk(c.tolist(), dict(zip(c.tolist(), t.tolist())), waiting.tolist(), may.tolist(), scale)
        return pa.table({"node": nodes, "c": pa.array(moved, pa.int64()), "gains": gains, "margin": margin, "n_edges": n_edges})

    return move


def _scored(plain: DataFrame, placed: DataFrame, strength: DataFrame, scale: float) -> DataFrame:
    """A round of the nodes of ``strength`` as joins, in the form of ``_mover``: edges of a node need not fit a task."""
    few = placed.join(strength, "node")
    stay = few.select("node", "c", F.lit(0.0).alias("w_in"))
    alone = few.select("node", (-F.col("node") - 1).alias("c"), F.lit(0.0).alias("w_in"))
    near = plain.join(strength.select(F.col("node").alias("src")), "src")
    options = _toward_groups(near, placed).unionByName(stay).unionByName(alone).groupBy("node", "c").agg(F.sum("w_in").alias("w_in"))
    own = few.select("node", F.col("c").alias("own"), "mine", "k", "n_edges")
    scored = options.join(own, "node").join(placed.select("c", "t").distinct(), "c", "left")
    rest = F.coalesce("t", F.lit(0.0)) - F.when(F.col("c") == F.col("own"), F.col("k")).otherwise(F.lit(0.0))
    gain = F.round(F.col("w_in") - F.lit(scale) * F.col("k") * rest, 10)
    chosen = scored.select("node", "own", "mine", "c", "n_edges", gain.alias("gain")).groupBy("node").agg(
        F.max(F.struct("gain", (-F.col("c")).alias("neg"))).alias("b"),
        F.max(F.when(F.col("c") == F.col("own"), F.col("gain"))).alias("now"),
        *(F.first(x).alias(x) for x in ("own", "mine", "n_edges")),
    )
    gains = F.col("b.gain") > F.col("now")
    to = F.when(F.col("mine") & gains, -F.col("b.neg")).otherwise(F.col("own"))
    return chosen.select("node", to.alias("c"), gains.alias("gains"), F.when(gains, F.lit(-1.0)).alias("margin"), "n_edges")


def _nearest_moves(step: DataFrame, most: int) -> DataFrame:
    """(node, gains) of the nodes that gain and those nearest to a gain, up to ``most`` edges together."""
    bucket = F.when(F.col("gains"), F.lit(-20_000)).when(F.col("margin") > 1e-300, F.floor(8 * F.log2("margin"))).otherwise(F.lit(-10_000))
    placed = step.where("gains OR margin < double('infinity')").select("node", "gains", "n_edges", bucket.alias("bucket"))
    upto, total = -20_000, 0
    for row in placed.groupBy("bucket").agg(F.sum("n_edges").alias("n")).orderBy("bucket").collect():  # a few hundred rows
        total += row["n"]
        if total > most:
            break
        upto = row["bucket"]
    return placed.where(F.col("bucket") <= upto).select("node", "gains")


def _moved(edges: DataFrame, start: DataFrame, strength: DataFrame, two_m: float, resolution: float, seed: int, max_rounds: int, small: int = SMALL) -> DataFrame:
    """(node, c): nodes move from the communities of ``start`` to the neighbouring community of largest gain.

    Half of the nodes, drawn anew by a hash, may move in a round, and fewer in late rounds, so that neighbours in
    different blocks don't chase each other; it ends when no node would gain by a move. Nodes are numbers from 0 on;
    communities have the number of their first node, or one below zero after a node left for one of its own. Nodes that
    gain and have up to ``small`` edges together are moved in one task, with those nearest to a gain as far as they fit.
    """
    labels, scale, plain = start, resolution / two_m, edges.where("src <> dst")
    dealt = _dealt(edges, start, strength, small, seed)
    crowded = strength.where(F.col("n_edges") > small)
    by_joins = dealt is None or not crowded.isEmpty()
    for turn in range(max_rounds):
        totals = labels.join(strength, "node").groupBy("c").agg(F.sum("k").alias("t"), F.min("node").alias("first"))
        mine = F.pmod(F.xxhash64("node", F.lit(seed), F.lit(turn)), F.lit(2 << min(turn // 25, 4))) == 0
        placed = cut_lineage(labels.join(totals, "c").select("node", F.col("first").alias("c"), "t", mine.alias("mine")))
        steps = [_scored(plain, placed, crowded, scale)] if by_joins else []
        if dealt is not None:
            packs, goes = dealt
            ends = goes.join(placed, "node").select(F.explode("blocks").alias("to"), "node", "c", "t", "mine")
            steps.append(packs.groupBy("block").cogroup(ends.groupBy("to")).applyInArrow(_mover(scale, seed, turn), STEP))
        step = cut_lineage(steps[0] if len(steps) == 1 else steps[0].unionByName(steps[1]))
        left = step.where("gains").agg(F.sum("n_edges")).first()[0]
        if left is None:
            return placed.select("node", "c")
        if left <= small and turn % 8 < 7:  # a plain round now and then, should rounding ever hold a task back
            labels = _settled(plain, placed, _nearest_moves(step, small), strength, scale)
        else:
            labels = step.select("node", "c")
    raise RuntimeError(f"nodes still move after {max_rounds} rounds")


def _refined(edges: DataFrame, labels: DataFrame, strength: DataFrame, two_m: float, resolution: float, seed: int, max_rounds: int, small: int = SMALL) -> DataFrame:
    """(node, c): connected parts of the communities, each named by one of its nodes.

    A community with up to ``small`` edges inside is refined in one task, several together. Larger ones take rounds.
    """
    scale = resolution / two_m
    sized = labels.join(strength, "node").groupBy("c").agg(F.sum("k").alias("k_all"))
    starts = labels.join(strength, "node").join(sized, "c").select(F.col("node").alias("src"), "c", "k", "k_all")
    ends = labels.select(F.col("node").alias("dst"), F.col("c").alias("cd"))
    inside = cut_lineage(edges.where("src <> dst").join(starts, "src").join(ends, "dst").where("c = cd").drop("cd"))
    counts = cut_lineage(inside.groupBy("c").agg(F.count("*").alias("n")))
    fit = counts.where(F.col("n") <= small)
    n_fit = fit.agg(F.sum("n")).first()[0]
    own = strength.select("node")
    if n_fit is None:
        refined = own.select("node", F.col("node").alias("c"))
    else:
        bins = -(-4 * n_fit // small)

        def refine(table: pa.Table) -> pa.Table:
            src, dst, w, c, k, k_all = (table.column(x).to_numpy() for x in ("src", "dst", "w", "c", "k", "k_all"))
            names, place = np.unique(np.concatenate([src, dst]), return_inverse=True)
            _, group = np.unique(c, return_inverse=True)
            n, at = len(names), place[: len(src)]
            graph, mine, whole, strengths = _Graph(at, place[len(src):], w, n), np.zeros(n, dtype=np.int64), np.zeros(n), np.zeros(n)
            mine[at], strengths[at] = group, k
            whole[group] = k_all
            graph.k = strengths.tolist()
            order = np.random.default_rng([abs(seed), n]).permutation(n).tolist()
            part = np.array(_refine(graph, mine.tolist(), scale, order, whole.tolist()))
            return pa.table({"node": pa.array(names, pa.int64()), "c": pa.array(names[part], pa.int64())})

        binned = inside.join(fit, "c").withColumn("bin", F.pmod(F.xxhash64("c", F.lit(seed)), F.lit(bins)))
        found = binned.groupBy("bin").applyInArrow(refine, "node long, c long").select("node", F.col("c").alias("_c"))
        refined = own.join(found, "node", "left").select("node", F.coalesce("_c", "node").alias("c"))
    refined = cut_lineage(refined)
    crowded = counts.where(F.col("n") > small)
    return refined if crowded.isEmpty() else _refined_in_rounds(inside.join(crowded, "c"), refined, strength, scale, seed, max_rounds, small)


def _refined_in_rounds(inside: DataFrame, parts: DataFrame, strength: DataFrame, scale: float, seed: int, max_rounds: int, small: int) -> DataFrame:
    """(node, c): ``parts`` after those of communities with many edges ``inside`` have grown.

    In a round each part draws a side by a hash. Lone nodes of one side that are well tied to their community join the
    part of the other side beside them that gains most, so a part grows by edges only and never loses a node. It ends
    when no lone node has a part beside it that it would gain by joining. Lone nodes that would and have up to ``small``
    edges together join in one task.
    """
    share = F.lit(scale)
    tie = inside.groupBy(F.col("src").alias("node")).agg(F.sum("w").alias("w_c"), F.first("k").alias("k"), F.first("k_all").alias("k_all"))
    tied = cut_lineage(tie.where(F.col("w_c") >= share * F.col("k") * (F.col("k_all") - F.col("k")) - F.lit(LEAST_GAIN)).select("node", "k"))
    inside = cut_lineage(inside.select("src", "dst", "w"))
    for turn in range(max_rounds):
        sized = parts.join(strength, "node").groupBy("c").agg(F.sum("k").alias("k_all"), F.count("*").alias("n"))
        lone = parts.join(sized.where("n = 1"), "c").select("node").join(tied, "node")
        scored = _toward_groups(inside, parts).join(lone, "node").join(sized.select("c", "k_all"), "c")
        gain = F.round(F.col("w_in") - share * F.col("k") * F.col("k_all"), 10)
        options = cut_lineage(scored.select("node", "c", gain.alias("gain")).where("gain > 0"))
        movers = options.select("node", F.lit(True).alias("gains")).distinct()
        left = movers.join(strength, "node").agg(F.sum("n_edges")).first()[0]
        if left is None:
            return parts
        if left <= small and turn % 8 < 7:
            placed = parts.join(sized.select("c", F.col("k_all").alias("t")), "c")
            parts = _settled(inside, placed, movers, strength, scale, lone=True)
            continue
        side = F.pmod(F.xxhash64("c", F.lit(seed), F.lit(turn)), F.lit(2))
        own = F.pmod(F.xxhash64("node", F.lit(seed), F.lit(turn)), F.lit(2))  # a lone node names its own part
        best = options.where((own == 0) & (side == 1)).groupBy("node").agg(F.max(F.struct("gain", (-F.col("c")).alias("neg"))).alias("b"))
        joined = parts.join(best, "node", "left")
        parts = cut_lineage(joined.select("node", F.coalesce(-F.col("b.neg"), F.col("c")).alias("c")))
    raise RuntimeError(f"parts still grow after {max_rounds} rounds")


def find_communities(edges: DataFrame, resolution: float = 0.2, seed: int = 42, max_rounds: int = MOST_ROUNDS, max_levels: int = MOST_LEVELS, small: int = SMALL) -> DataFrame:
    """(node, community) from symmetric (src, dst, w) edges; deterministic for a seed.

    Repeated edges add up; edges with a NULL end or weight, and those of weight 0, are left out. Every community is
    connected. A level of up to ``small`` edges is finished inside one task with those after it. A search that is not at
    its end after ``max_rounds`` rounds of a level or ``max_levels`` levels is an error.
    """
    level = edges.where("src IS NOT NULL AND dst IS NOT NULL AND w <> 0").groupBy("src", "dst").agg(F.sum("w").cast("double").alias("w"))
    level = cut_lineage(level)
    kind = dict(level.dtypes)["src"]
    size = level.agg(F.sum("w").alias("w"), F.count("*").alias("n")).first()
    two_m, n_edges = size["w"] or 0.0, size["n"]
    if n_edges == 0:
        return edges.select(F.col("src").alias("node"), F.col("src").alias("community")).where("false")
    nodes = level.select(F.col("src").alias("node")).distinct()
    if n_edges <= small:
        mapping = start = cut_lineage(nodes.select("node", F.col("node").alias("c")))
    else:  # numbers from 0 on, in the order of the nodes
        mapping = cut_lineage(numbered(nodes, ["node"], "c").select("node", (F.col("c") - 1).alias("c")))
        start, kind = mapping.select(F.col("c").alias("node"), "c"), "bigint"
        ends = mapping.select(F.col("node").alias("dst"), F.col("c").alias("cd"))
        placed = level.join(mapping.select(F.col("node").alias("src"), F.col("c").alias("cs")), "src").join(ends, "dst")
        level = cut_lineage(placed.select(F.col("cs").alias("src"), F.col("cd").alias("dst"), "w"))
    for _ in range(max_levels):
        if n_edges <= small:

            def finish(group: pd.DataFrame) -> pd.DataFrame:
                return _finish(group, resolution, seed)

            known = level.join(start.select(F.col("node").alias("src"), F.col("c").alias("cs")), "src").join(start.select(F.col("node").alias("dst"), F.col("c").alias("cd")), "dst")
            last = known.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(finish, f"node {kind}, c {kind}")
            break
        strength = cut_lineage(level.groupBy(F.col("src").alias("node")).agg(F.sum("w").alias("k"), F.count("*").alias("n_edges")))
        labels = _moved(level, start, strength, two_m, resolution, seed, max_rounds, small)
        n_nodes = labels.count()
        if labels.select("c").distinct().count() == n_nodes:
            last = labels
            break
        parts = _refined(level, labels, strength, two_m, resolution, seed, max_rounds, small)
        if parts.select("c").distinct().count() == n_nodes:  # only ties hold the communities together
            last = _split(level, labels)
            break
        mapping = cut_lineage(_followed(mapping, parts))
        ends = parts.select(F.col("node").alias("dst"), F.col("c").alias("cd"))
        merged = level.join(parts.select(F.col("node").alias("src"), F.col("c").alias("cs")), "src").join(ends, "dst")
        level = cut_lineage(merged.groupBy(F.col("cs").alias("src"), F.col("cd").alias("dst")).agg(F.sum("w").alias("w")))
        n_edges = level.count()
        start = cut_lineage(labels.join(parts.select("node", F.col("c").alias("part")), "node").groupBy("part").agg(F.first("c").alias("c")).select(F.col("part").alias("node"), "c"))
    else:
        raise RuntimeError(f"communities still merge after {max_levels} levels")
    found = cut_lineage(_followed(mapping, last))
    return found.join(found.groupBy("c").agg(F.min("node").alias("community")), "c").select("node", "community")


def _split(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, c): the connected parts of the communities."""
    ends = labels.select(F.col("node").alias("b"), F.col("c").alias("cb"))
    inside = edges.select(F.col("src").alias("a"), F.col("dst").alias("b")).join(labels.withColumnRenamed("node", "a"), "a").join(ends, "b").where("c = cb AND a <> b")
    joined = connected_nodes(inside.select("a", "b"))
    return labels.select("node").join(joined, "node", "left").select("node", F.coalesce("component", "node").alias("c"))


def _followed(mapping: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, c) one step on: c is looked up as a node of ``labels``."""
    return mapping.join(labels.select(F.col("node").alias("c"), F.col("c").alias("_c")), "c").select("node", F.col("_c").alias("c"))


def name_by_size(members: DataFrame, one_indexed: bool = True) -> DataFrame:
    """(node, cluster): text labels, the largest community first."""
    sizes = members.groupBy("community").agg(F.count(F.lit(1)).alias("n"))
    placed = positions(sizes.withColumn("_o", -F.col("n")), [], "_o", ["community"], "place")
    label = (F.col("place") - (0 if one_indexed else 1)).cast("string")
    return members.join(placed.select("community", label.alias("cluster")), "community").select("node", "cluster")


def modularity(edges: DataFrame, members: DataFrame, resolution: float = 1.0) -> DataFrame:
    """One row: how much more weight lies inside communities than chance would put there."""
    total = edges.agg(F.sum("w")).scalar()
    side = members.select(F.col("node").alias("src"), F.col("community").alias("cs"))
    other = members.select(F.col("node").alias("dst"), F.col("community").alias("cd"))
    placed = edges.join(side, "src").join(other, "dst")
    per = placed.groupBy(F.col("cs").alias("community")).agg(
        F.sum(F.when(F.col("cs") == F.col("cd"), F.col("w")).otherwise(0.0)).alias("inside"), F.sum("w").alias("k")
    )
    return per.agg(F.sum(F.col("inside") / total - F.lit(resolution) * F.pow(F.col("k") / total, 2)).alias("modularity"))


def run_clustering(cells: DataFrame, columns: list[str] | None = None, key: str = "cell_mask_id", vector: str | None = None, n_neighbors: int = 10, resolution: float = 0.2, seed: int = 42, one_indexed: bool = True, block: int = 2048) -> DataFrame:
    """(key, cluster) from markers: neighbour graph, fuzzy weights, communities, labels by size."""
    graph, _ = neighbour_graph(cells, columns, key, vector, n_neighbors, block=block)
    members = find_communities(graph.select("src", "dst", "w"), resolution, seed)
    return name_by_size(members, one_indexed).withColumnRenamed("node", key)
