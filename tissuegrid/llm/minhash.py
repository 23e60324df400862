"""Near-duplicate documents by MinHash: banding, signature verification, full-set verification, star components.

The nodes of the graph are sets of word shingles, named by a 128-bit digest, so that copies with the same set are one
node however many there are. Candidates come from bands of universal hash minima. A star from each bucket's smallest
node links most of a group with one comparison per member; what a bucket still holds in several components is then
compared block by block, across components only. Every link is confirmed on the full sets, and a group's parts are joined
exactly as all its pairs would join them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissuegrid.llm import stars, words
from tissuegrid.runtime import cut_lineage

#: Universal hash functions per signature, and the chance to miss a pair that sits exactly on the threshold.
HASHES, MISS = 180, 1e-6
#: Rows of one side of a block of signature comparisons.
BLOCK = 256

_A = words.splitmix(HASHES, 101) | np.uint64(1)
_B = words.splitmix(HASHES, 202)


def band_rows(threshold: float) -> int:
    """Longest band that still misses a pair at the threshold with a chance of at most MISS."""
    fit = [r for r in range(1, 21) if HASHES % r == 0 and (1 - threshold**r) ** (HASHES // r) <= MISS]
    return max(fit, default=1)


def least_agreement(threshold: float) -> int:
    """Equal signature places below which a pair is dropped: 5.5 standard deviations under the threshold."""
    return math.floor(HASHES * threshold - 5.5 * math.sqrt(HASHES * threshold * (1 - threshold)))


def _minima(shingles: np.ndarray) -> np.ndarray:
    best = np.full(HASHES, words.MASK, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 1024):
            h = _A[:, None] * shingles[None, at: at + 1024]
            h += _B[:, None]
            np.minimum(best, h.min(axis=1), out=best)
    return words.mix(best)


def digest(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int, rows: int) -> DataFrame:
    """(id, print, n_shingles, node, bands, marks): digest of the set, one key per band, one byte per hash minimum.

    ``print`` is a hash of the text, by which a row is found again among others of its id.
    """
    bands = HASHES // rows

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = words.splitmix(rows, 303) | np.uint64(1)
        for batch in words.tidy(batches):
            n, node, keys, marks = [], [], [], []
            for shingles in words.shingle_sets(batch.column(2), width):
                n.append(len(shingles))
                node.append(digest(shingles))
                if not len(shingles):
                    keys.append(None)
                    marks.append(None)
                    continue
                least = _minima(shingles)
                marks.append((least & np.uint64(255)).astype(np.uint8).tobytes())
                with np.errstate(over="ignore"):
                    key = words.mix((least.reshape(bands, rows) * factors).sum(axis=1, dtype=np.uint64))
                keys.append(key.view(np.int64))
            keys = pa.array(keys, type=pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, type=pa.int64()), pa.array(node, type=pa.binary()), keys, pa.array(marks, type=pa.binary())],
                names=["id", "print", "n_shingles", "node", "bands", "marks"],
            )

    return _read(docs, id_col, text_col).mapInArrow(sketch, "id long, print long, n_shingles long, node binary, bands array<long>, marks binary")


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("print"), text.alias("text"))


def _texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(node, text) of the wanted (node, lead): rows meet by id and print, so that many rows of one id, or of none, meet
    only nodes of their own text. A text counts only if its set has the node's digest.
    """

    def check(batches):
        for batch in words.tidy(batches):
            found = pa.array([digest(s) for s in words.shingle_sets(batch.column(1), width)], type=pa.binary())
            yield batch.filter(pc.fill_null(pc.equal(found, batch.column(0)), False))

    at = F.col("id").eqNullSafe(F.col("lead.id")) & (F.col("print") == F.col("lead.print"))
    joined = _read(docs, id_col, text_col).join(wanted, at).select("node", "text")
    return joined.mapInArrow(check, "node binary, text string").dropDuplicates(["node"])


def _confirm(pairs: DataFrame, texts: DataFrame, width: int, over: int, under: int) -> DataFrame:
    """Pairs (a, b) with a column ``linked``: under * |common| >= over * |union| on the full sets."""

    def compare(batches):
        last, kept = None, None
        for batch in words.tidy(batches):
            left = words.shingle_sets(batch.column(2), width)
            keys, linked = batch.column(1).to_pylist(), []
            right_texts = batch.column(3)
            for i, one in enumerate(left):
                if keys[i] != last:
                    last, kept = keys[i], next(words.shingle_sets(right_texts.slice(i, 1), width))
                common = np.intersect1d(one, kept, assume_unique=True).size
                linked.append(under * common >= over * (len(one) + len(kept) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, type=pa.bool_())], names=["a", "b", "linked"])

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(compare, "a binary, b binary, linked boolean")


def _agreement(a: str, b: str, least: int) -> DataFrame:
    """Column: equal places of two mark strings, or null where fewer than ``least``."""

    @F.pandas_udf("int")
    def count(x, y):
        if not len(x):
            return pd.Series([], dtype="Int32")
        left = np.frombuffer(b"".join(x), dtype=np.uint8).reshape(len(x), HASHES)
        right = np.frombuffer(b"".join(y), dtype=np.uint8).reshape(len(x), HASHES)
        same = (left == right).sum(axis=1)
        return pd.Series(same).astype("Int32").where(same >= least)

    return count(F.col(a), F.col(b))


def _sizes_fit(over: int, under: int):
    """The smaller set cannot reach the threshold if it is too small beside the larger one."""
    return F.least("n_a", "n_b") * under >= F.greatest("n_a", "n_b") * over


def _common(sets: list[np.ndarray]):
    """Function that counts, for one more set, the shingles it has in common with each of ``sets``."""
    values = np.concatenate(sets)
    owners = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(values, kind="stable")
    owners = owners[order]
    values, first, times = np.unique(values[order], return_index=True, return_counts=True)

    def count(one: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(values, one), len(values) - 1)
        at = at[values[at] == one]
        n = times[at]
        places = np.arange(n.sum()) + np.repeat(first[at] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        return np.bincount(owners[places], minlength=len(sets))

    return count


def _linked_across(members: DataFrame, width: int, least: int, over: int, under: int) -> DataFrame:
    """Links (a, b) between different components of a bucket: enough to join all that its linked pairs join.

    Members (band, bucket, node, component, n, bands, marks, text) are laid out in blocks; a component with many members
    has blocks of its own, which are never held against each other. A task gets two blocks at a time, never a whole
    bucket. A pair is looked at in the first band that it shares, first by its signatures, then on the full sets; of the
    links found only those come out that join parts not yet joined.
    """
    sizes = members.groupBy("bucket", "component").agg(F.count("*").alias("in_component"))
    large = F.col("in_component") >= BLOCK
    rest = sizes.groupBy("bucket").agg(F.sum(F.when(large, 0).otherwise(F.col("in_component"))).alias("rest"))
    laid = members.select("bucket", "node", "component").join(sizes, ["bucket", "component"]).join(rest, "bucket")
    own = F.concat_ws(":", F.hex("component"), F.pmod(F.xxhash64("node"), F.ceil(F.col("in_component") / BLOCK)).cast("string"))
    mixed = F.concat(F.lit(":"), F.pmod(F.xxhash64("node"), F.greatest(F.ceil(F.col("rest") / BLOCK), F.lit(1))).cast("string"))
    laid = cut_lineage(laid.select("bucket", "node", F.when(large, own).otherwise(mixed).alias("block")))
    blocks = laid.select("bucket", "block").distinct()
    other = blocks.select("bucket", F.col("block").alias("other"))
    apart = (F.substring_index("block", ":", 1) != F.substring_index("other", ":", 1)) | F.col("block").startswith(":")
    tasks = blocks.join(other, "bucket").where((F.col("block") <= F.col("other")) & apart)
    tasks = tasks.select("bucket", F.concat_ws("|", "block", "other").alias("task"), F.explode(F.array_distinct(F.array("block", "other"))).alias("block"))
    rows = laid.join(tasks, ["bucket", "block"]).join(members, ["bucket", "node"])
    rows = rows.select("bucket", "task", "block", "node", "component", "n", "band", "bands", "marks", "text")

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        block, node, component = (table.column(c).to_pylist() for c in ("block", "node", "component"))
        first, band = min(block), pc.min(table.column("band")).as_py()
        codes = {c: i for i, c in enumerate(dict.fromkeys(component))}
        part = np.array([codes[c] for c in component])
        n = table.column("n").to_numpy()
        marks = np.frombuffer(b"".join(table.column("marks").to_pylist()), dtype=np.uint8).reshape(-1, HASHES)
        bands = np.array(table.column("bands").to_pylist(), dtype=np.int64)[:, :band]
        sets = list(words.shingle_sets(table.column("text"), width))
        left = [i for i, x in enumerate(block) if x == first]
        right = np.array([i for i, x in enumerate(block) if x != first] or left)
        count, out = None, []
        for i in left:
            near = np.flatnonzero(part[right] != part[i])
            j = right[near]
            fit = (np.minimum(n[j], n[i]) * under >= np.maximum(n[j], n[i]) * over) & ~(bands[j] == bands[i]).any(axis=1)
            near, j = near[fit], j[fit]
            near = near[(marks[j] == marks[i]).sum(axis=1) >= least]
            if not len(near):
                continue
            count = count or _common([sets[k] for k in right])
            common = count(sets[i])[near]
            for j in right[near[under * common >= over * (n[right[near]] + n[i] - common)]].tolist():
                if part[j] != part[i]:
                    out.append((node[i], node[j]))
                    part[part == part[j]] = part[i]
        a, b = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return rows.groupBy("bucket", "task").applyInArrow(compare, "a binary, b binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, over: int = 80, under: int = 100) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept.

    Words are runs outside white space with A-Z lower-cased; a document's set holds its distinct ``width``-word
    shingles, or its whole word sequence if it has fewer words. Documents are linked if under * |common| >= over *
    |union|; component_id is the smallest id reachable by links, kept marks the row that has it.

    Null or empty texts and texts without words have an empty set (0) and are linked with nothing: their component is
    their own id. Repeated rows have equal sets and share a component; a null id is passed over when the smallest id is
    taken, and its row is never kept unless asked by null-safe comparison. Other columns of ``docs`` are not looked at,
    so their names cannot clash. An empty table gives an empty result. A pair exactly on the threshold is missed with
    a chance of at most MISS by the bands, and 2e-8 by the signatures.
    """
    rows = band_rows(over / under)
    least = least_agreement(over / under)
    drawn = cut_lineage(sketches(docs, id_col, text_col, width, rows))
    nodes = cut_lineage(
        drawn.where("node is not null").groupBy("node")
        .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "print")).alias("lead"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("marks").alias("marks"))
    )
    signed = nodes.select("node", "lead", "n", "marks")
    banded = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = banded.groupBy("band", "key").agg(F.count("*").alias("size"), F.min("node").alias("centre")).where("size > 1")
    members = banded.join(buckets, ["band", "key"])
    members = cut_lineage(members.select("band", F.xxhash64("band", "key").alias("bucket"), "node", "centre"))

    def texts_of(wanted: DataFrame) -> DataFrame:
        return cut_lineage(_texts(docs, wanted.distinct().join(signed.select("node", "lead"), "node"), id_col, text_col, width))

    left = signed.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("marks").alias("marks_a"))
    right = signed.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("marks").alias("marks_b"))
    star = members.where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    star = star.join(left, "a").join(right, "b").where(_sizes_fit(over, under))
    star = star.select("a", "b", _agreement("marks_a", "marks_b", least).alias("same")).where("same is not null")
    star = cut_lineage(star.groupBy("a").agg(F.max_by("b", F.struct("same", "b")).alias("b")))
    links = cut_lineage(_confirm(star, texts_of(star.select(F.explode(F.array("a", "b")).alias("node"))), width, over, under).where("linked").select("a", "b"))
    parts = cut_lineage(stars.components(links, "a", "b"))
    placed = members.join(parts, "node", "left").select("band", "bucket", "node", F.coalesce("component", "node").alias("component"))
    spread = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("bucket")
    apart = cut_lineage(placed.join(spread, "bucket", "left_semi"))
    if not apart.isEmpty():
        apart = apart.join(nodes.select("node", "n", "bands", "marks"), "node").join(texts_of(apart.select("node")), "node")
        links = links.unionByName(_linked_across(apart, width, least, over, under))
        parts = cut_lineage(stars.components(links, "a", "b"))
    led = nodes.select("node", "lead").join(parts, "node", "left").select("node", "lead", F.coalesce("component", "node").alias("component"))
    heads = led.groupBy("component").agg(F.min("lead.id").alias("component_id"))
    placed = led.join(heads, "component").select("node", "component_id")
    out = drawn.select("id", "n_shingles", "node").join(placed, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", "n_shingles", own.alias("component_id")).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
