"""SentencePiece encoding and decoding: distinct sampled segmentations by perturbed A-star search over the lattice.

A text falls into segments that no piece crosses, so its lattice is a chain of small ones; equal segments share one.
Backward sums give every edge its conditional probability, hence exact sampling without rejection. Gumbel top-k without
replacement runs as a best-first search over sets of segmentations: a set is a prefix plus the edges already used
behind it, its bound is the largest Gumbel-perturbed log-probability inside it, drawn from the set's total mass and
truncated at its parent's. The best set is opened, its best segmentation emitted, the rest split into new sets.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissuegrid.llm import words

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = 0x2581
#: Stands for a blank sign that is in the text itself: it is spelt in bytes, so that decoding gives it back.
LITERAL = 0x110000
#: Bytes of text that share lattices: more saves time, less saves memory. A longer text is a piece of its own.
TEXT = 1 << 21
#: Shift that leaves the bits of a hash for the first look at the vocabulary.
SEEN = np.uint64(44)


class Vocabulary:
    """Pieces by length with their ids and log-probabilities, and the ids of the byte pieces."""

    def __init__(self, pieces: list[str], logp: np.ndarray, bytes_at: int):
        self.bytes_at = bytes_at
        self.longest = max(map(len, pieces[bytes_at + 256:]))
        self.by_length, self.floor = {}, float(logp.min()) - 1.0
        known = [(i, p) for i, p in enumerate(pieces) if i >= bytes_at + 256 and p]
        for n in range(1, self.longest + 1):
            mine = [(i, p) for i, p in known if len(p) == n]
            if not mine:
                continue
            codes = np.array([[ord(c) for c in p] for _, p in mine], dtype=np.int64)
            h = window_hashes(codes.ravel(), n)[::n]
            order = np.argsort(h)
            ids = np.array([i for i, _ in mine], dtype=np.int32)[order]
            self.by_length[n] = (h[order], ids, logp[ids])
        self.letters = np.unique([ord(c) for _, p in known for c in p])
        self.seen = np.zeros(1 << (64 - int(SEEN)), dtype=bool)  # a first look that most windows fail
        for h, _, _ in self.by_length.values():
            self.seen[h >> SEEN] = True


def load(path: str) -> tuple[list[str], np.ndarray, int]:
    """Pieces, log-probabilities and the id of byte 0.

    A vocabulary of merges has ranks in place of probabilities; its pieces then follow Zipf's law, p ~ 1 / (rank + 2).
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    score = np.array([model.get_score(i) for i in range(n)], dtype=np.float64)
    bytes_at = pieces.index("<0x00>")
    own = np.arange(n) >= bytes_at + 256
    if np.all(score[own] == np.rint(score[own])):
        score[own] = -np.log(2.0 - score[own])
    score[own] -= np.log(np.exp(score[own]).sum())
    score[~own] = score[own].min() - 1.0
    return pieces, score, bytes_at


def window_hashes(codes: np.ndarray, n: int, run: np.ndarray | None = None) -> np.ndarray:
    """Hash of codes[i:i+n] for every i with a full window."""
    if run is None:
        run = running(codes)
    with np.errstate(over="ignore"):
        m = len(codes) - n + 1
        h = run[n: n + m] - run[:m]
        h *= words.ladders(m)[1][:m]
        return h


def running(codes: np.ndarray) -> np.ndarray:
    powers, _ = words.ladders(len(codes) + 1)
    run = np.zeros(len(codes) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(words.mix(codes.astype(np.uint64) + np.uint64(77)) * powers[: len(codes)], out=run[1:])
    return run


def uniform(key: np.ndarray, a: int, b) -> np.ndarray:
    """Numbers in (0, 1) that hang on key, a and b alone."""
    with np.errstate(over="ignore"):
        return _fraction(np.asarray(key, dtype=np.uint64) + words.mix(np.uint64(a)), b)


def _fraction(key: np.ndarray, b) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = words.mix(key + np.asarray(b, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(12)
    return (h.astype(np.float64) + 0.5) * 2.0**-52


class Lattices:
    """Lattices of the distinct segments of a piece of the table, as one list of edges.

    Edges are ordered by their distance from the segment's end, then by node, then by length. ``begin`` and ``many`` give
    each node's edges; an edge has its length, piece, log-probability given its node (``logq``), the probability up to and
    with it (``upto``) and the log of the probability of its node's other edges (``rest``).
    """

    def __init__(self, codes: np.ndarray, start: np.ndarray, stop: np.ndarray, vocabulary: Vocabulary, alpha: float):
        size = stop - start
        self.first = np.concatenate([[0], np.cumsum(size + 1)[:-1]])  # a segment has a node before, between and after its characters
        self.last = self.first + size
        nodes = int(self.last[-1]) + 1
        self.code = np.full(nodes, -1, dtype=np.int64)
        inside = np.ones(nodes, dtype=bool)
        inside[self.last] = False
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        self.code[inside] = codes[np.repeat(start, size) + at]
        left = np.repeat(self.last, size + 1) - np.arange(nodes)  # characters up to the segment's end
        run, hits = running(self.code), []
        lone = left > 0
        alive = None  # the nodes far enough from their segment's end, once they are few
        for n, (known, ids, logp) in vocabulary.by_length.items():
            if n > size.max():
                break
            if alive is None and n > 3:
                alive = np.flatnonzero(left >= n)
            if alive is None:
                h = window_hashes(self.code, n, run)
                where = np.flatnonzero((left[: len(h)] >= n) & vocabulary.seen[h >> SEEN])
                h = h[where]
            else:
                alive = alive[left[alive] >= n]
                with np.errstate(over="ignore"):
                    h = (run[alive + n] - run[alive]) * words.ladders(nodes)[1][alive]
                maybe = vocabulary.seen[h >> SEEN]
                where, h = alive[maybe], h[maybe]
            found = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = known[found] == h
            where, found = where[hit], found[hit]
            hits.append((where.astype(np.int32), ids[found], alpha * logp[found], n))
            if n == 1:
                lone[where] = False
        where = np.flatnonzero(lone)
        hits.insert(0, (where, -1, alpha * vocabulary.floor, 1))
        self.many = np.zeros(nodes, dtype=np.int32)
        for where, _, _, _ in hits:
            self.many[where] += 1
        order = np.argsort(np.minimum(left, 1 << 15).astype(np.uint16) if size.max() < 1 << 15 else left, kind="stable")
        self.begin = np.zeros(nodes, dtype=np.int64)
        self.begin[order] = np.cumsum(self.many[order]) - self.many[order]
        n_edges = int(self.many.sum())
        self.src, self.length = np.zeros(n_edges, dtype=np.int32), np.zeros(n_edges, dtype=np.uint8)
        self.piece, weight = np.zeros(n_edges, dtype=np.int32), np.zeros(n_edges)
        free = self.begin.copy()
        for where, ids, logp, n in hits:
            at = free[where]
            self.src[at], self.length[at], self.piece[at], weight[at] = where, n, ids, logp
            free[where] += 1
        node = order[self.many[order] > 0]
        fresh, many = self.begin[node], self.many[node]
        beta = np.zeros(nodes)
        goal = self.src + self.length
        levels = np.searchsorted(left[self.src[fresh]], np.arange(1, int(size.max()) + 2))
        for a, b in zip(levels[:-1], levels[1:]):
            if a == b:
                continue
            edges = slice(fresh[a], fresh[b - 1] + many[b - 1])
            total = weight[edges] + beta[goal[edges]]
            cut = fresh[a:b] - fresh[a]
            top = np.maximum.reduceat(total, cut)
            beta[self.src[fresh[a:b]]] = top + np.log(np.add.reduceat(np.exp(total - np.repeat(top, many[a:b])), cut))
        self.logq = np.minimum(weight + beta[goal] - beta[self.src], 0.0)
        q = np.exp(self.logq)
        run = np.cumsum(q)
        self.upto = run - np.repeat(run[fresh] - q[fresh], many)
        self.upto[fresh + many - 1] = 2.0  # rounding leaves no gap behind the last edge
        with np.errstate(divide="ignore"):
            self.rest = np.log1p(-q)
        self.rest[np.repeat(many, many) == 1] = -np.inf

    def draw(self, node: np.ndarray, stop: np.ndarray, key: np.ndarray, place: np.ndarray, sample: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Paths from node to stop: the edges of all steps one path after the other, and where each path begins.

        ``place`` seeds the steps, with key and sample.
        """
        n, owner, steps = len(node), np.flatnonzero(node < stop), []
        node, stop, place = node[owner].copy(), stop[owner], place[owner].copy()
        with np.errstate(over="ignore"):
            key = key[owner] + words.mix(sample[owner])
        while len(owner):
            u = _fraction(key, place)
            edge = self.begin[node]
            short = np.flatnonzero(self.upto[edge] < u)
            while len(short):
                edge[short] += 1
                short = short[self.upto[edge[short]] < u[short]]
            steps.append((owner, edge))
            node, place = node + self.length[edge], place + self.length[edge]
            on = node < stop
            if not on.all():
                owner, node, stop, key, place = owner[on], node[on], stop[on], key[on], place[on]
        many = np.zeros(n, dtype=np.int64)
        for owner, _ in steps:
            many[owner] += 1
        begin = np.cumsum(many) - many
        out = np.zeros(int(many.sum()), dtype=np.int64)
        for k, (owner, edge) in enumerate(steps):
            out[begin[owner] + k] = edge
        return out, begin


class _Search:
    """Best-first search of one text: opened paths, and how late the sets that branch off them come.

    A set with log-mass m has the bound -log(exp(-parent's bound) + E exp(-m)) with E exponential; ``late`` is log(E) - m, so
    that the smallest of a path is its best set.
    """

    def __init__(self, lattices: Lattices, key: int):
        self.l, self.key, self.paths = lattices, np.uint64(key), []

    def first(self, edges: np.ndarray, logp: float, late: np.ndarray, bound: float) -> dict:
        """The text's first path, whose figures are worked out for all texts of a piece at once."""
        self.paths.append({"edges": edges, "logp": logp, "bound": bound, "late": late, "from": 0, "gone": []})
        return self.paths[0]

    def add(self, edges: np.ndarray, from_step: int, gone: list[int], bound: float) -> dict:
        """A path; sets branch off at its steps from ``from_step`` on, where the edges ``gone`` are used up at the first."""
        lattices = self.l
        before = np.cumsum(lattices.logq[edges])
        mass = lattices.rest[edges[from_step:]]
        if len(gone) and len(mass):
            node = int(lattices.src[edges[from_step]])
            used = {*gone, int(edges[from_step])}
            free = [e for e in range(lattices.begin[node], lattices.begin[node] + lattices.many[node]) if e not in used]
            mass[0] = np.log(np.exp(lattices.logq[free]).sum()) if len(free) else -np.inf
        mass[1:] += before[from_step:-1]
        mass[:1] += before[from_step - 1] if from_step else 0.0
        noise = np.log(-np.log(uniform(self.key, 1_000_003 + len(self.paths), np.arange(from_step, len(edges), dtype=np.uint64))))
        path = {"edges": edges, "logp": float(before[-1]), "bound": bound, "late": noise - mass, "from": from_step, "gone": gone}
        self.paths.append(path)
        return path

    def best(self) -> tuple[float, dict | None, int]:
        top, owner, step = -math.inf, None, -1
        for path in self.paths:
            at = int(path["late"].argmin())
            bound = -float(np.logaddexp(-path["bound"], path["late"][at])) if np.isfinite(path["late"][at]) else -math.inf
            if bound > top:
                top, owner, step = bound, path, path["from"] + at
        return top, owner, step


def _segments(codes: np.ndarray, text_start: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Where segments start: at a text, at the first of a run of blanks, before and after a character outside the pieces."""
    n = len(codes)
    blank = codes == BLANK
    at = np.minimum(np.searchsorted(letters, codes), len(letters) - 1)
    lone = letters[at] != codes
    start = lone | blank
    start[1:] = lone[1:] | lone[:-1] | (blank[1:] & ~blank[:-1])
    start[text_start[text_start < n]] = True
    return np.flatnonzero(start)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts with blanks for spaces and one in front of each, and where each text starts."""
    joined = "".join(f" {t}" if t else "" for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    literal = codes == BLANK
    codes = np.where(codes == 0x20, BLANK, codes)
    codes[literal] = LITERAL
    return codes, np.concatenate([[0], np.cumsum([len(t) + 1 if t else 0 for t in texts])])


def _ids(lattices: Lattices, paths: list[np.ndarray], bytes_at: int) -> list[np.ndarray]:
    """Ids of the pieces along each path; a character without a piece is spelt in bytes."""
    edges = np.concatenate(paths)
    ids = lattices.piece[edges]
    lone = np.flatnonzero(ids < 0)
    times = np.ones(len(ids), dtype=np.int64)
    spelt = [chr(BLANK if c == LITERAL else c).encode() for c in lattices.code[lattices.src[edges[lone]]].tolist()]
    times[lone] = [len(b) for b in spelt]
    out = np.repeat(ids, times)
    out[out < 0] = np.frombuffer(b"".join(spelt), dtype=np.uint8).astype(np.int32) + bytes_at
    ends = np.concatenate([[0], np.cumsum(times)])[np.cumsum([len(p) for p in paths])]
    return np.split(out, ends[:-1])


def _turn(search: _Search, r: int, i: int) -> tuple | None:
    """The best set of segmentations still unopened: (text, path, step, used edges, bound, the edge it turns to there)."""
    bound, path, step = search.best()
    if path is None:
        return None
    path["late"][step - path["from"]] = math.inf
    lattices, edge = search.l, int(path["edges"][step])
    gone = [*(path["gone"] if step == path["from"] else []), edge]
    node = int(lattices.src[edge])
    free = [e for e in range(lattices.begin[node], lattices.begin[node] + lattices.many[node]) if e not in gone]
    chances = np.exp(lattices.logq[free] - lattices.logq[free].max())
    pick = float(uniform(search.key, 500_009 + r, step)) * chances.sum()
    return i, path, step, gone, bound, int(free[min(int((np.cumsum(chances) < pick).sum()), len(free) - 1)])


def sample_texts(texts: list[str], keys: np.ndarray, vocabulary: Vocabulary, samples: int, alpha: float) -> list[list[tuple]]:
    """For each text up to ``samples`` distinct segmentations: (ids, log_prob, perturbed, log_inclusion), best first."""
    codes, text_start = _codes(texts)
    out: list[list[tuple]] = [[] for _ in texts]
    if len(codes):
        start = _segments(codes, text_start, vocabulary.letters)
        stop = np.append(start[1:], len(codes))
        run = running(codes)
        with np.errstate(over="ignore"):
            h = words.mix((run[stop] - run[start]) * words.ladders(len(codes) + 1)[1][start] + (stop - start).astype(np.uint64))
        kind, different = pd.factorize(h)
        which = np.zeros(len(different), dtype=np.int64)
        which[kind[::-1]] = np.arange(len(kind))[::-1]
        lattices = Lattices(codes, start[which], stop[which], vocabulary, alpha)
        first, last = lattices.first[kind], lattices.last[kind]
        owner = np.searchsorted(text_start, start, side="right") - 1
        place = start - text_start[owner]
        mine = np.searchsorted(start, text_start)
        key = keys[owner]
    none = np.zeros(0, dtype=np.int64)
    found: list[list[dict]] = [[] for _ in texts]
    searches: list[_Search | None] = [None] * len(texts)
    if len(codes) and samples:
        drawn = lattices.draw(first, last, key, place, np.zeros(len(key), dtype=np.uint64))
        bounds = np.append(drawn[1], len(drawn[0]))[mine]
        steps = np.diff(bounds)
        run = np.concatenate([[0.0], np.cumsum(lattices.logq[drawn[0]])])
        weight = run[bounds[1:]] - run[bounds[:-1]]
        index = np.arange(len(drawn[0])) - np.repeat(bounds[:-1], steps)
        noise = np.log(-np.log(uniform(np.repeat(keys, steps), 1_000_003, index)))
        late = noise - (lattices.rest[drawn[0]] + run[:-1] - np.repeat(run[bounds[:-1]], steps))
    open_texts = []
    for i in range(len(texts) if samples else 0):
        search = searches[i] = _Search(lattices if len(codes) else None, keys[i])
        bound = -math.log(-math.log(float(uniform(keys[i], 999_983, 0))))
        if not texts[i]:
            found[i].append({"edges": none, "logp": 0.0, "bound": bound})
            continue
        a, b = bounds[i], bounds[i + 1]
        found[i].append(search.first(drawn[0][a:b], float(weight[i]), late[a:b], bound))
        open_texts.append(i)
    for r in range(1, samples):
        turns = [t for i in open_texts if (t := _turn(searches[i], r, i)) is not None]
        open_texts = [i for i, *_ in turns]
        if not turns:
            break
        # The rest of each text's segment from its new edge on, then all its later segments, drawn for all texts at once.
        begun = [int(lattices.length[path["edges"][:step]].sum(dtype=np.int64)) for _, path, step, *_ in turns]
        segment = [mine[i] + int(np.searchsorted(place[mine[i]: mine[i + 1]], at, side="right")) - 1 for i, at in zip(open_texts, begun)]
        edge = np.array([turn for *_, turn in turns])
        later = [np.arange(at + 1, mine[i + 1]) for i, at in zip(open_texts, segment)]
        many = np.array([len(x) for x in later])
        heads = np.cumsum(many + 1) - many - 1
        tail = np.ones(int(many.sum()) + len(turns), dtype=bool)
        tail[heads] = False
        rest = np.concatenate(later)
        parts = []
        for head, others in (
            (lattices.src[edge] + lattices.length[edge], first[rest]), (last[segment], last[rest]), (keys[open_texts], key[rest]),
            (np.array(begun) + lattices.length[edge], place[rest]), (np.full(len(turns), r + 1_000), np.full(len(rest), r)),
        ):
            whole = np.empty(len(tail), dtype=others.dtype)
            whole[heads], whole[tail] = head, others
            parts.append(whole)
        edges, begin = lattices.draw(*parts[:4], parts[4].astype(np.uint64))
        cut = np.append(begin, len(edges))[np.append(heads, len(tail))].tolist()
        for (i, path, step, gone, bound, turn), a, b in zip(turns, cut, cut[1:]):
            found[i].append(searches[i].add(np.concatenate([path["edges"][:step], [turn], edges[a:b]]), step, gone, bound))
    every = [path["edges"] for paths in found for path in paths]
    spelt = iter(_ids(lattices, every, vocabulary.bytes_at) if len(codes) else [none.astype(np.int32)] * len(every))
    for i, paths in enumerate(found):
        search = searches[i]
        kappa = search.best()[0] if search is not None else -math.inf
        for path in paths:
            x = path["logp"] - kappa
            inclusion = 0.0 if x > 30 else x if x < -30 else math.log(-math.expm1(-math.exp(x)))
            out[i].append((next(spelt), path["logp"], path["bound"], inclusion))
    return out


def sampled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = 2, alpha: float = 1.0, model: str = MODEL, together: int = TEXT, check: bool = False) -> DataFrame:
    """(id, sample, ids, n_pieces, log_prob, perturbed, log_inclusion): up to ``samples`` segmentations of each row's text.

    The segmentations of a text are distinct and come in the order of their perturbed log-probability, as drawing
    without replacement would give them; ``alpha`` flattens (below 1) or sharpens the distribution. log_inclusion is the
    log of the chance to be among the samples, given the bound of the best segmentation left out; 0 if none is left.
    Draws hang on the row's id and the place in the text, so reruns and other partitions agree, and repeated rows get the
    same samples. A null text gives one row with null ids, an empty one a row with no pieces; a text with fewer
    segmentations gives them all. Texts count whole. A null id is a key as any other; other columns are not looked at;
    an empty table gives an empty result. With ``check`` the ids are decoded again: round_trip tells whether they give the
    text back, null for a null text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(model))  # bounded by the vocabulary
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(id_col).alias("key"))

    def encode(batches):
        vocabulary = Vocabulary(*shared.value)
        spelling = pa.array(_spelling(*shared.value), pa.binary()) if check else None
        for batch in words.tidy(batches):
            for piece in words.pieces(batch.column(1), together):
                part = batch.slice(piece.first, piece.last - piece.first)
                texts = part.column(1).to_pylist()
                keys = part.column(2).to_numpy().view(np.uint64)
                got = sample_texts([t or "" for t in texts], keys, vocabulary, samples, alpha)
                take, sample, arrays, scores = [], [], [], []
                for i, one in enumerate(got):
                    for r, (ids, *rest) in enumerate(one):
                        take.append(i)
                        sample.append(r)
                        arrays.append(None if texts[i] is None else ids)
                        scores.append(rest)
                sizes = [0 if a is None else len(a) for a in arrays]
                flat = np.concatenate([a for a in arrays if a is not None] or [np.zeros(0, dtype=np.int32)]).astype(np.int32)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                same = _same_texts(flat, offsets, [texts[i] for i in take], spelling) if check else []
                missing = pa.array([a is None for a in arrays], pa.bool_())
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()), mask=missing)
                scores = np.array(scores, dtype=np.float64).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(take, pa.int64())), pa.array(sample, pa.int32()), ids, pa.array(sizes, pa.int64()), *(pa.array(scores[:, c]) for c in range(3)), *([pa.array(same, pa.bool_())] if check else [])],
                    names=["id", "sample", "ids", "n_pieces", "log_prob", "perturbed", "log_inclusion", *(["round_trip"] if check else [])],
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"id {kind}, sample int, ids array<int>, n_pieces long, log_prob double, perturbed double, log_inclusion double" + (", round_trip boolean" if check else ""))


def _spelling(pieces: list[str], _, bytes_at: int) -> list[bytes]:
    """The bytes of each id."""
    return [b"" if i < bytes_at else bytes([i - bytes_at]) if i < bytes_at + 256 else p.replace(chr(BLANK), " ").encode() for i, p in enumerate(pieces)]


def _spelt(ids: np.ndarray, spelling: list[bytes]) -> str:
    """The text of ids."""
    whole = b"".join([spelling[i] for i in ids.tolist() if 0 <= i < len(spelling)]).decode("utf-8", "replace")
    return whole[1:] if whole.startswith(" ") else whole


def _same_texts(flat: np.ndarray, offsets: np.ndarray, texts: list[str | None], spelling: pa.BinaryArray) -> list[bool | None]:
    """Whether the ids of each row decode to its text; all ids of a piece are spelt at once, and rows compared as bytes."""
    spelt = spelling.take(pa.array(flat))
    _, ends, data = spelt.buffers()
    ends = np.frombuffer(ends, dtype=np.int32)[spelt.offset: spelt.offset + len(spelt) + 1][offsets].tolist()
    data = data.to_pybytes() if data is not None else b""
    return [None if t is None else data[a:b] == (f" {t}" if t else "").encode() for a, b, t in zip(ends, ends[1:], texts)]


def decoded(rows: DataFrame, ids_col: str = "ids", out_col: str = "decoded", model: str = MODEL) -> DataFrame:
    """``rows`` with the text of a column of ids: pieces joined, blanks turned to spaces, the one in front taken off.

    Null ids give null, no ids an empty text; ids outside the vocabulary and control pieces give nothing, and bytes that
    do not form a character become replacement characters. A column named ``out_col`` is replaced.
    """
    shared = rows.sparkSession.sparkContext.broadcast(_spelling(*load(model)))

    @F.pandas_udf("string")
    def text(column):
        spelling = shared.value

        return pd.Series([None if x is None else _spelt(x, spelling) for x in column], dtype=object)

    return rows.withColumn(out_col, text(F.col(ids_col)))
