"""Short codes for vectors: every part of a vector is replaced by the number of its nearest codebook entry.

Codebooks are learnt by rounds of assignment and averaging in whole numbers. The nearest entry is found by Orchard's
search: every entry keeps the others sorted by distance; a part walks the list of the best entry so far, goes over to
the list of an entry that turns out nearer, marks what it has met, and ends at the first listed entry that lies beyond
twice its current distance, since by the triangle inequality none from there on can be nearer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissuegrid.llm.words import tidy
from tissuegrid.runtime import cut_lineage

#: Rows of vectors worked on at once inside a task.
BATCH = 1 << 14


@dataclass
class Book:
    """Codebook of one part: entries, and for each entry the other entries by distance with their squared distances."""

    entries: np.ndarray
    others: np.ndarray
    gaps: np.ndarray


def book_of(entries: np.ndarray) -> Book:
    """Entries with their neighbour lists; equal distances are listed by number."""
    k = len(entries)
    apart = ((entries[:, None] - entries[None]) ** 2).sum(2)
    others = np.array([[e for e in np.lexsort((np.arange(k), row)) if e != at] for at, row in enumerate(apart)], dtype=np.int64)
    others = others.reshape(k, k - 1)
    return Book(entries, others, np.take_along_axis(apart, others, 1))


def orchard(x: np.ndarray, book: Book) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest entry of each row of x; ties go to the smaller number.

    All rows walk side by side, each on its own list. An entry as near as the best one lies at most at twice the
    distance from it, so ties are met before a walk ends.
    """
    n, k = len(x), len(book.entries)
    best = np.zeros(n, dtype=np.int64)
    near = ((x - book.entries[0]) ** 2).sum(1)
    met = np.zeros((n, k), dtype=bool)
    met[:, 0] = True
    place = np.zeros(n, dtype=np.int64)
    walking = np.arange(n if k > 1 else 0)
    while len(walking):
        at, where = best[walking], place[walking]
        go = book.gaps[at, where] <= 4 * near[walking]
        walking, entry = walking[go], book.others[at[go], where[go]]
        place[walking] += 1
        new = ~met[walking, entry]
        row, entry = walking[new], entry[new]
        met[row, entry] = True
        d = ((x[row] - book.entries[entry]) ** 2).sum(1)
        better = (d < near[row]) | ((d == near[row]) & (entry < best[row]))
        row = row[better]
        best[row], near[row], place[row] = entry[better], d[better], 0
        walking = walking[place[walking] < k - 1]
    return best, near


def _whole(column: pa.Array, width: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Which rows take part, and their components as whole numbers."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    there = np.asarray(lists.is_valid())
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls come as NaN
    ends = np.cumsum(lengths)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    sound = there & (bad[ends] == bad[ends - lengths])
    if (lengths[sound] != width).any():
        raise ValueError(f"vectors differ in length: {width} and {int(lengths[sound][lengths[sound] != width][0])}")
    x = np.floor(scale * flat[np.repeat(sound, lengths)])
    most = np.sqrt(2.0**58 / max(1, width))
    if (np.abs(x) > most).any():
        raise ValueError(f"a component is over {most / scale:g}: squared distances would pass 64 bits")
    return sound, x.astype(np.int64).reshape(-1, width)


def _assigned(x: np.ndarray, books: list[Book]) -> tuple[np.ndarray, np.ndarray]:
    """Entry numbers and squared distances, one column per part."""
    found = [orchard(part, book) for part, book in zip(np.split(x, len(books), axis=1), books)]
    return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def _rounds_sums(vectors: DataFrame, books: list[Book], width: int, scale: float) -> dict[int, int]:
    """Sums of the assigned parts by (part, entry, position) and their numbers, added up in tasks and then by Spark.

    What comes back has one row per component of the codebooks and per entry, whatever the number of vectors.
    """
    parts, k = len(books), len(books[0].entries)
    size = width // parts

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, k, size), dtype=np.int64), np.zeros((parts, k), dtype=np.int64)
        for batch in tidy(batches):
            for first in range(0, len(batch), BATCH):
                _, x = _whole(batch.column(0).slice(first, BATCH), width, scale)
                number, _ = _assigned(x, books)
                for p, values in enumerate(np.split(x, parts, axis=1)):
                    np.add.at(sums[p], number[:, p], values)
                    counts[p] += np.bincount(number[:, p], minlength=k)
        flat = np.concatenate([sums.ravel(), counts.ravel()])
        slot = np.flatnonzero(flat)
        yield pa.record_batch({"slot": pa.array(slot, pa.int64()), "total": pa.array(flat[slot], pa.int64())})

    partial = vectors.select("v").mapInArrow(add_up, "slot long, total long")
    rows = partial.groupBy("slot").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    return {r["slot"]: int(r["total"]) for r in rows}


def fit(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: float = 4096.0) -> list[Book]:
    """Codebooks of ``vectors`` (id, v): entries start as the parts of the smallest ids and move ``rounds`` times.

    Only rows count whose vector has no null, NaN or infinite component. Fewer rows than entries give fewer entries, no
    rows an empty list. Null ids come last in the choice of starts, equal ids by their vectors. Each round reads the
    vectors once; write them first if they are costly to compute.
    """
    sound = vectors.where(F.expr("v IS NOT NULL AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"))
    first = sound.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    if not first:
        return []
    width = len(first[0]["v"])
    if width % parts:
        raise ValueError(f"vectors of length {width} can't be cut into {parts} equal parts")
    _, start = _whole(pa.array([r["v"] for r in first], pa.list_(pa.float64())), width, scale)
    books = [book_of(part) for part in np.split(start, parts, axis=1)]
    k, size = len(start), width // parts
    for _ in range(rounds):
        sums = _rounds_sums(vectors, books, width, scale)
        moved = []
        for p, book in enumerate(books):
            now = book.entries.copy()
            for e in range(k):
                n = sums.get(parts * k * size + p * k + e, 0)
                if n:
                    now[e] = [sums.get((p * k + e) * size + j, 0) // n for j in range(size)]
            moved.append(book_of(now))
        books = moved
    return books


def digest(books: list[Book]) -> str:
    """SHA-256 of all components in the order part, entry, position."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.entries.ravel().tolist()).encode()).hexdigest()


def encode(vectors: DataFrame, books: list[Book], scale: float = 4096.0) -> DataFrame:
    """(id, label, code, error) of every vector that takes part; code has two hex digits per part."""
    if not books:
        return vectors.where("false").select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    width = len(books) * books[0].entries.shape[1]

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tidy(batches):
            for first in range(0, len(batch), BATCH):
                piece = batch.slice(first, BATCH)
                sound, x = _whole(piece.column(2), width, scale)
                number, error = _assigned(x, books)
                digits = number.astype(np.uint8).tobytes().hex().encode()
                ends = np.arange(len(x) + 1, dtype=np.int32) * (2 * len(books))
                code = pa.StringArray.from_buffers(len(x), pa.py_buffer(ends), pa.py_buffer(digits))
                kept = piece.filter(pa.array(sound))
                yield pa.record_batch([kept.column(0), kept.column(1), code, pa.array(error.sum(1), pa.int64())], ["id", "label", "code", "error"])

    kinds = dict(vectors.dtypes)
    return vectors.select("id", "label", "v").mapInArrow(shorten, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def compressed(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6, scale: float = 4096.0) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) of every row that takes part.

    Components become floor(scale · x). Rows whose vector is null or holds a null, NaN or infinite component are left
    out. Null and repeated ids and labels are rows like others; null labels count as one label. An empty table gives an
    empty result. Other columns are left behind, whatever their names. Vectors of different lengths, lengths that don't
    divide into ``parts`` and components whose squared distances would pass 64 bits are errors. At most 256 entries.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits per part: 1 to 256 entries")
    plain = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    books = fit(plain, parts, entries, rounds, scale)
    coded = cut_lineage(encode(plain, books, scale))
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    joined = coded.join(by_label, coded["label"].eqNullSafe(by_label["of"]))
    return joined.select("id", "label", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
