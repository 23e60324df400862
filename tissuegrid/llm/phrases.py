"""Collocations: phrases whose words stand together more often than apart, counted by sorting suffix pointers.

Every word of a text is a pointer to the words that follow it in its piece. Tasks pack the pointers of a chunk of text with
their repeats into blocks and deal these out by the leading word; words, and pairs of words, that a sample shows to be
too frequent for one task are dealt out by one word more. Each group then runs a multikey three-way quicksort over its
pointers: a partition is split by a pivot into smaller, equal and larger ones, the equal one goes on with the next word,
and its size is the count of the phrase read so far. Partitions too small to hold a wanted phrase are dropped at once.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tissuegrid.llm.words import LOWER, Piece, find_words, mix, pieces, span_hashes, splitmix, tidy
from tissuegrid.runtime import cut_lineage

# Fixed values of the word rule: bytes that end a piece of text, bytes between words of a piece.
BREAKS, SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"

#: Bytes of text and pointers worked on at once inside a task; text bytes for which there is one group, and least groups.
TEXT, CHUNK, GROUP, LEAST_GROUPS = 1 << 23, 1 << 20, 1 << 24, 32
#: Groups that a chunk is dealt out to at once, and bytes of blocks that are gathered before they are dealt out further.
DEALS, GATHERED = 1 << 12, 1 << 25
#: Bytes of text per group that are looked at for frequent leading words, and what bounds the number of those that are
#: split: at most 2 * SPLIT per depth, 16 MB in all. The sample only decides who counts what, never what is counted.
LOOK, SPLIT = 1 << 13, 1 << 19

IS_BREAK = np.zeros(256, dtype=bool)
IS_BREAK[list(BREAKS)] = True
APART = IS_BREAK.copy()
APART[list(SPACES)] = True
_STEP = splitmix(64, 71) | np.uint64(1)


@dataclass
class Pointers:
    """Distinct suffixes with their numbers: row d of ``ids`` is the word at depth d, 0 where the piece has ended."""

    words: pa.BinaryArray
    ids: np.ndarray
    n: np.ndarray


def _bytes_of(words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of an array without nulls that starts at its buffers' start."""
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int32)[: len(words) + 1]
    return offsets, np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)


def _binary(offsets: np.ndarray, data: np.ndarray) -> pa.BinaryArray:
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _counted(ids: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of ``ids`` and how often each occurs."""
    bits = int(words).bit_length()
    if bits * len(ids) <= 63:
        key = ids[0].astype(np.int64)
        for row in ids[1:]:
            key = (key << bits) | row
        key, n = np.unique(key, return_counts=True)
        low = (1 << bits) - 1
        return np.stack([(key >> (bits * d)) & low for d in reversed(range(len(ids)))]).astype(np.int32), n
    ids = ids[:, np.lexsort(ids[::-1])]
    first = np.flatnonzero(np.concatenate([[True], (ids[:, 1:] != ids[:, :-1]).any(axis=0)]))
    return ids[:, first], np.diff(np.append(first, ids.shape[1]))


def suffixes(texts: pa.Array, longest: int) -> Iterator[Pointers]:
    """The suffixes of a column of texts, chunk by chunk, each up to ``longest`` words of its piece."""
    for piece in pieces(texts, TEXT):
        data = LOWER[piece.data]
        found = find_words(Piece(piece.first, piece.last, data, piece.bounds), APART)
        total = len(found.start)
        if not total:
            continue
        seen = np.zeros(len(data) + 1, dtype=np.int32)
        np.cumsum(IS_BREAK[data], dtype=np.int32, out=seen[1:])
        goes_on = np.zeros(total, dtype=bool)
        goes_on[:-1] = seen[found.end[:-1]] == seen[found.start[1:]]
        starts = found.rows[1:-1]
        goes_on[starts[starts > 0] - 1] = False  # the next word is another text's
        del seen
        for first in range(0, total, CHUNK):
            last = min(total, first + CHUNK)
            upto = min(total, last + longest - 1)
            region = data[found.start[first]: found.end[upto - 1]]
            offsets = np.concatenate([[0], np.cumsum(found.end[first:upto] - found.start[first:upto])])
            coded = _binary(offsets, region[~APART[region]]).dictionary_encode()
            word = coded.indices.to_numpy().astype(np.int32) + 1
            ids = np.zeros((longest, last - first), dtype=np.int32)
            on = np.ones(last - first, dtype=bool)
            for d in range(longest):
                reach = min(last - first, upto - first - d)
                if d:
                    on[:reach] &= goes_on[first + d - 1: first + d - 1 + reach]
                ids[d, :reach] = np.where(on[:reach], word[d: d + reach], 0)
            yield Pointers(coded.dictionary, *_counted(ids, len(coded.dictionary)))


# --- dealing out -----------------------------------------------------------------------------------


def _seed(lang: str) -> np.uint64:
    raw = np.frombuffer(lang.encode(), dtype=np.uint8)
    return span_hashes(raw, np.array([0]), np.array([len(raw)]))[0] if len(raw) else np.uint64(0)


def _hashes(at: Pointers) -> np.ndarray:
    """Numbers of the words by id; 0 for the end of a piece."""
    offsets, data = _bytes_of(at.words)
    return np.concatenate([np.zeros(1, dtype=np.uint64), span_hashes(data, offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64))])


class Routes:
    """Which pointers go where: by the leading word, by one word more after leading words in ``hot``."""

    def __init__(self, lang: str, at: Pointers, hot: np.ndarray):
        h, longest = _hashes(at), len(at.ids)
        with np.errstate(over="ignore"):
            self.key = mix(h[at.ids[0]] + _seed(lang))
            #: hot[d] marks pointers whose first d + 1 words are split over groups.
            self.hot = []
            #: prefix[d] is a number of the first d + 1 words.
            self.prefix = []
            deeper = np.ones(len(self.key), dtype=bool)
            for d in range(longest - 1):
                self.prefix.append(self.key.copy())
                deeper = deeper & np.isin(self.key, hot) & (at.ids[d] > 0)
                self.hot.append(deeper)
                self.key = np.where(deeper, mix(self.key + h[at.ids[d + 1]] * _STEP[d + 1] + _STEP[0]), self.key)


def _packed(at: Pointers, chosen: np.ndarray) -> bytes:
    """Some of the pointers with the words they need, as one block."""
    ids = at.ids[:, chosen]
    used = np.unique(ids)
    used = used[used > 0]
    names = at.words.take(pa.array(used - 1))
    offsets, data = _bytes_of(names)
    place = np.searchsorted(used, ids).astype(np.int32) + 1
    place[ids == 0] = 0
    body = b"".join([np.diff(offsets).astype(np.int32).tobytes(), data[: offsets[-1]].tobytes(), place.tobytes(), at.n[chosen].astype(np.int64).tobytes()])
    return struct.pack("<III", len(used), len(ids), ids.shape[1]) + zstandard.ZstdCompressor(level=1).compress(body)


def _unpacked(blocks: list[bytes]) -> Pointers:
    """All pointers of some blocks over one list of words."""
    lengths, texts, ids, numbers, before = [], [], [], [], 0
    for block in blocks:
        words, longest, rows = struct.unpack_from("<III", block)
        body = zstandard.ZstdDecompressor().decompress(block[12:])
        sizes = np.frombuffer(body, dtype=np.int32, count=words)
        end = 4 * words + int(sizes.sum())
        place = np.frombuffer(body, dtype=np.int32, count=longest * rows, offset=end) if not end % 4 else np.frombuffer(body[end: end + 4 * longest * rows], dtype=np.int32)
        lengths.append(sizes)
        texts.append(np.frombuffer(body, dtype=np.uint8)[4 * words: end])
        ids.append(np.where(place > 0, place + before, 0).reshape(longest, rows))
        numbers.append(np.frombuffer(body[end + 4 * longest * rows:], dtype=np.int64))
        before += words
    coded = _binary(np.concatenate([[0], np.cumsum(np.concatenate(lengths))]), np.concatenate(texts)).dictionary_encode()
    names = np.concatenate([[0], coded.indices.to_numpy() + 1]).astype(np.int32)
    return Pointers(coded.dictionary, names[np.concatenate(ids, axis=1)], np.concatenate(numbers))


# --- sorting ---------------------------------------------------------------------------------------


def multikey_counts(ids: np.ndarray, n: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(depth, pointers, counts): a pointer to each phrase of depth + 1 words and of ``least`` or more occurrences.

    Multikey three-way quicksort, all partitions of a pass side by side: each is split at its depth by the median of
    three of its words. Partitions with fewer than ``least`` occurrences are abandoned, as no phrase in them has more.
    """
    order = np.arange(len(n))
    starts = np.zeros(min(1, len(n)), dtype=np.int64)
    depth = np.zeros(len(starts), dtype=np.int64)
    longest = len(ids)
    while len(starts):
        sizes = np.diff(np.append(starts, len(order)))
        keep = np.add.reduceat(n[order], starts) >= least
        if not keep.all():
            order = order[np.repeat(keep, sizes)]
            sizes, depth = sizes[keep], depth[keep]
            starts = np.cumsum(sizes) - sizes
            if not len(starts):
                return
        key = ids[np.repeat(depth, sizes), order]
        a, b, c = key[starts], key[starts + sizes // 2], key[starts + sizes - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))
        beside = np.repeat(pivot, sizes)
        less, equal = key < beside, key == beside
        lows, same = np.add.reduceat(less, starts, dtype=np.int64), np.add.reduceat(equal, starts, dtype=np.int64)
        side = np.stack([lows, same, sizes - lows - same], axis=1)
        begin = (np.cumsum(side.ravel()) - side.ravel()).reshape(-1, 3)
        moved = np.empty_like(order)
        for which, mask in enumerate((less, equal, ~(less | equal))):
            at = np.flatnonzero(mask)
            rank = np.arange(len(at)) - np.repeat(np.cumsum(side[:, which]) - side[:, which], side[:, which])
            moved[np.repeat(begin[:, which], side[:, which]) + rank] = order[at]
        order = moved
        run = np.concatenate([[0], np.cumsum(n[order])])
        total = run[begin[:, 1] + side[:, 1]] - run[begin[:, 1]]
        for d in np.unique(depth):
            out = (depth == d) & (pivot > 0) & (total >= least)
            if out.any():
                yield int(d), order[begin[out, 1]], total[out]
        goes_on = np.stack([lows > 0, (pivot > 0) & (depth + 1 < longest), side[:, 2] > 0], axis=1).ravel()
        depth = np.stack([depth, depth + 1, depth], axis=1).ravel()[goes_on]
        order = order[np.repeat(goes_on, side.ravel())]
        sizes = side.ravel()[goes_on]
        starts = np.cumsum(sizes) - sizes


def _phrase(at: Pointers, pointers: np.ndarray, depth: int) -> pa.Array:
    parts = [at.words.take(pa.array(at.ids[d, pointers] - 1)).view(pa.string()) for d in range(depth + 1)]
    return parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, " ")


COUNTS = "lang string, phrase string, words int, n long"


def _count_group(lang: str, at: Pointers, hot: np.ndarray, least: int) -> Iterator[tuple[pa.Array, int, np.ndarray]]:
    """(phrases, words, counts) of one group: whole counts of at least ``least``, parts of counts of split prefixes."""
    routes = Routes(lang, at, hot)
    for depth, pointers, counts in multikey_counts(at.ids, at.n, least):
        if depth < len(routes.hot):
            whole = ~routes.hot[depth][pointers]
            pointers, counts = pointers[whole], counts[whole]
        yield _phrase(at, pointers, depth), depth + 1, counts
    for depth, split in enumerate(routes.hot):
        rows = np.flatnonzero(split)
        if len(rows):
            _, first, which = np.unique(routes.prefix[depth][rows], return_index=True, return_inverse=True)
            counts = np.zeros(len(first), dtype=np.int64)
            np.add.at(counts, which, at.n[rows])
            yield _phrase(at, rows[first], depth), depth + 1, counts


def phrase_counts(docs: DataFrame, text_col: str, lang_col: str, longest: int = 3, least: int = 10) -> DataFrame:
    """(lang, phrase, words, n): phrases of up to ``longest`` words with ``least`` occurrences or more in their language.

    A row with ``words`` 0 has the number of all word occurrences of the language. A null language is ``und``.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    groups = max(LEAST_GROUPS, math.ceil(size / GROUP))

    def by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Pointers]]:
        for batch in tidy(batches):
            langs = batch.column(0).dictionary_encode()
            order = np.argsort(langs.indices.to_numpy(), kind="stable")
            cuts = np.cumsum(np.bincount(langs.indices.to_numpy(), minlength=len(langs.dictionary)))
            column = batch.column(1).cast(pa.large_string())
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                rows = order[cuts[i - 1] if i else 0: cuts[i]]
                for at in suffixes(column.take(pa.array(rows)) if len(langs.dictionary) > 1 else column, longest):
                    yield lang, at

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, at in by_lang(batches):
            routes = Routes(lang, at, np.zeros(0, dtype=np.uint64))
            key = routes.key
            with np.errstate(over="ignore"):
                for d in range(longest - 1):
                    number, which = np.unique(key, return_inverse=True)
                    n = np.bincount(which, weights=at.n * (at.ids[d] > 0)).astype(np.int64)
                    yield pa.record_batch([pa.array(number.view(np.int64)), pa.array(n)], ["key", "n"])
                    if d + 2 < longest:
                        key = mix(key + _hashes(at)[at.ids[d + 1]] * _STEP[d + 1] + _STEP[0])

    share = min(1.0, LOOK * groups / max(1, size))
    seen = cut_lineage(texts.sample(share, seed=3).mapInArrow(look, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")))
    words = (seen.agg(F.sum("n")).first()[0] or 0) / max(1, longest - 1)
    often = seen.where(F.col("n") >= max(2.0, words / (2 * min(groups, SPLIT)))).select("key").collect()
    hot = np.sort(np.array([r["key"] for r in often], dtype=np.int64).view(np.uint64))

    together = math.ceil(groups / DEALS)

    def blocks(lang: str, at: Pointers, share: int) -> Iterator[pa.RecordBatch]:
        group = (Routes(lang, at, hot).key % np.uint64(groups)).astype(np.int64) // share
        order = np.argsort(group, kind="stable")
        cuts = np.flatnonzero(np.diff(group[order])) + 1
        for chosen in np.split(order, cuts):
            yield pa.record_batch([pa.array([lang]), pa.array([int(group[chosen[0]])]), pa.array([_packed(at, chosen)], pa.binary())], ["lang", "grp", "block"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, at in by_lang(batches):
            yield from blocks(lang, at, together)

    def deal_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of neighbouring groups, gathered until they are worth splitting; they come sorted by group."""
        held, mine, size = [], None, 0
        for batch in batches:
            for lang, group, block in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (mine != (lang, group) or size > GATHERED):
                    yield from blocks(mine[0], _unpacked(held), 1)
                    held, size = [], 0
                mine, size = (lang, group), size + len(block)
                held.append(block)
        if held:
            yield from blocks(mine[0], _unpacked(held), 1)

    def count(table: pa.Table) -> pa.Table:
        lang = table.column("lang")[0].as_py()
        at = _unpacked(table.column("block").to_pylist())
        out = [(pa.array([None], pa.string()), 0, np.array([at.n.sum()]))]
        out += _count_group(lang, at, hot, least)
        return pa.table({
            "lang": pa.array([lang] * sum(len(p) for p, _, _ in out), pa.string()),
            "phrase": pa.concat_arrays([p for p, _, _ in out]),
            "words": pa.array(np.concatenate([np.full(len(p), w) for p, w, _ in out]), pa.int32()),
            "n": pa.array(np.concatenate([n for _, _, n in out]), pa.int64()),
        })

    shape = "lang string, grp long, block binary"
    dealt = texts.mapInArrow(deal, shape)
    if together > 1:  # one step would leave blocks of a few pointers: first to neighbouring groups, then to each
        dealt = dealt.repartition("lang", "grp").sortWithinPartitions("lang", "grp").mapInArrow(deal_on, shape)
    parts = dealt.groupBy("lang", "grp").applyInArrow(count, COUNTS)
    return parts.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | (F.col("words") == 0))


def _exact(a: str) -> str:
    return f"CAST({a} AS DECIMAL(19, 0))"


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 3, least: int = 10, inside: int = 50, first: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to ``longest`` words of each language.

    A-Z count as a-z; pieces end at ``.,;:!?`` and line ends, words at spaces and tabs. a is the number of occurrences of
    the phrase inside pieces, l and r those of its parts at the cut of least score, n that of all words of the language;
    score is floor(1000000 a a / (l r)) in exact decimals. Phrases with fewer than ``least`` occurrences are no
    candidates; a candidate inside a longer one that has ``inside`` percent of its occurrences goes. The ``first``
    of each language by score, occurrences and phrase are returned.

    A null language is ``und``; null and empty texts have no words, a language without words has no rows; repeated rows
    count each; null ids do not matter and other columns are left behind, whatever their names. An empty table gives an
    empty result. Texts may be of any length: they are cut into chunks of pointers that reach over their ends.
    """
    counts = cut_lineage(phrase_counts(docs, text_col, lang_col, longest, least))
    known = counts.where("words > 0")
    wanted = known.where("words > 1").withColumnRenamed("n", "a")
    cut = wanted.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cut = cut.withColumn("head", F.expr("substring_index(phrase, ' ', k)")).withColumn("tail", F.expr("substring_index(phrase, ' ', k - words)"))
    cut = cut.join(known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"])
    cut = cut.join(known.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
    score = F.expr(f"CAST(1000000 AS DECIMAL(7, 0)) * {_exact('a')} * {_exact('a')} div ({_exact('l')} * {_exact('r')})")
    scored = cut.withColumn("score", score).groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("at"))
    longer = wanted.where("words > 2").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    longer = longer.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("words") - F.col("m"))))
    part = F.expr("substring_index(substring_index(phrase, ' ', i + m), ' ', -m)")
    within = longer.select("lang", part.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = scored.join(within, ["lang", "phrase"], "left").where(f"most IS NULL OR 100 * most < {int(inside)} * a")
    kept = kept.select("lang", "phrase", "a", "at.l", "at.r", "at.score")
    # The best of each part of a language hold the best of the language.
    parts = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    parts = parts.withColumn("rank", F.row_number().over(_best("lang", "part"))).where(F.col("rank") <= first)
    ranked = parts.withColumn("rank", F.row_number().over(_best("lang")).cast("long")).where(F.col("rank") <= first)
    all_words = counts.where("words = 0").select("lang", F.col("n").alias("n"))
    return ranked.join(all_words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _best(*keys: str):
    return W.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), "phrase")
