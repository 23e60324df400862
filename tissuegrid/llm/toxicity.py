"""Toxicity by a factorization machine over hashed terms.

A text is the set of its hashed terms. The score is a logistic function of a bias, one weight per term, and for each
pair of terms the product of their factor vectors, so that an insult beside a mention of a group counts for more, or
less, than the two alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tissuegrid.llm import words
from tissuegrid.runtime import cut_lineage

#: Hashed terms, terms the model keeps, factors per term; the model's size, whatever the table.
BUCKETS, KEPT, FACTORS = 1 << 18, 4096, 8
#: Bytes of the beginning of a longer word that make a term of their own: inflected and compounded forms share it.
STEM = 5
#: Bytes of the n-grams inside words: sounds that only insults of a language have.
GRAM = 4
#: Standard errors by which a kept term must differ: hundreds of thousands of terms are looked at.
SIGNIFICANT = 4.0
EPOCHS, BATCH, RATE, DECAY, SEED = 12, 256, 0.1, 2e-5, 5

#: Words end at white space and at ASCII punctuation.
BREAK = words.SPACE.copy()
BREAK[[c for c in range(128) if not chr(c).isalnum()]] = True


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def term_sets(column: pa.Array):
    """For each piece of rows their number, and row and bucket of every term occurrence: words, their stems and inner n-grams."""
    for piece in words.pieces(column):
        found = words.find_words(piece, BREAK)
        data = words.LOWER[piece.data]
        whole = words.span_hashes(data, found.start, found.end)
        stem = words.span_hashes(data, found.start, np.minimum(found.start + STEM, found.end))
        shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
        within = np.repeat(np.arange(len(found.start)), np.maximum(found.end - found.start - GRAM + 1, 0))
        first = np.cumsum(np.maximum(found.end - found.start - GRAM + 1, 0))
        at = found.start[within] + np.arange(len(within)) - np.concatenate([[0], first])[within]
        inner = words.span_hashes(data, at, at + GRAM)
        terms = np.concatenate([whole, words.mix(stem + np.uint64(1)), words.mix(inner + np.uint64(2))]) >> shift
        word_row = np.repeat(np.arange(len(found.rows) - 1), np.diff(found.rows))
        yield len(found.rows) - 1, np.concatenate([word_row, word_row, word_row[within]]), terms.astype(np.int64)


def _distinct(row: np.ndarray, bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) by row."""
    both = np.unique(row * buckets + bucket)
    return both // buckets, both % buckets


def _sample(docs: DataFrame, labels: DataFrame, train_rows: int) -> DataFrame:
    """(id, label, terms) of about ``train_rows`` labelled rows that are not held out, picked by a hash of the id."""
    known = labels.where(~held_out("id") & F.col("label").isin(0, 1))
    n = known.count()
    if n > train_rows:
        known = known.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30)) < int(train_rows / n * (1 << 30)))

    def terms(batches):
        for batch in batches:
            out = []
            for n, row, bucket in term_sets(batch.column(1)):
                row, bucket = _distinct(row, bucket, BUCKETS)
                cut = np.searchsorted(row, np.arange(n + 1))
                out += [bucket[a:b].astype(np.int32) for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.list_(pa.int32()))], names=["id", "label", "terms"])

    rows = docs.select("id", "text").where("text is not null").join(known, "id").select("id", "text", "label")
    return cut_lineage(rows.mapInArrow(terms, "id long, label int, terms array<int>"))


def _counts(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows with each label, and for each term the rows of label 0 and 1 that have it: sums of what each task counts."""

    def count(batches):
        found = np.zeros((BUCKETS + 1, 2), dtype=np.int64)
        for batch in batches:
            label = batch.column(0).to_numpy()
            sizes = np.asarray(batch.column(1).value_lengths())
            np.add.at(found, (np.asarray(batch.column(1).flatten()), np.repeat(label, sizes)), 1)
            found[BUCKETS] += np.bincount(label, minlength=2)
        used = np.flatnonzero(found.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(found[used, 0]), pa.array(found[used, 1])], names=["term", "clean", "toxic"])

    sums = sample.select("label", "terms").mapInArrow(count, "term long, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    table = sums.toPandas()  # at most BUCKETS + 1 rows
    found = np.zeros((BUCKETS + 1, 2))
    found[table["term"].to_numpy()] = table[["clean", "toxic"]].to_numpy()
    return found[BUCKETS], found[:BUCKETS, 0], found[:BUCKETS, 1]


def _strongest(rows: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Terms whose share among the two labels differs most for its standard error."""
    n0, n1 = np.maximum(rows, 1)
    p = (clean + toxic) / (n0 + n1)
    error = np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n1 + 1 / n0))
    z = np.where(clean + toxic >= 3, np.abs(toxic / n1 - clean / n0) / error, 0.0)
    best = np.argsort(-z, kind="stable")[:KEPT]
    return np.sort(best[z[best] > SIGNIFICANT])


def fit(docs: DataFrame, labels: DataFrame, train_rows: int) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """Terms, bias, weights and factors, by stochastic gradient steps over the sampled rows."""
    sample = _sample(docs, labels, train_rows)
    kept = _strongest(*_counts(sample))
    place = np.full(BUCKETS, -1, dtype=np.int64)
    place[kept] = np.arange(len(kept))

    def thin(batches):
        for batch in batches:
            terms = batch.column(2)
            sizes = np.asarray(terms.value_lengths())
            feature = place[np.asarray(terms.flatten())]
            row = np.repeat(np.arange(len(sizes)), sizes)[feature >= 0]
            offsets = np.searchsorted(row, np.arange(len(sizes) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(offsets), pa.array(feature[feature >= 0].astype(np.int32)))], names=["id", "label", "terms"])

    table = sample.mapInArrow(thin, "id long, label int, terms array<int>").toArrow().sort_by([("id", "ascending"), ("label", "ascending")])
    label = table.column("label").to_numpy().astype(np.int64)
    terms = table.column("terms").combine_chunks()
    sizes = np.asarray(terms.value_lengths()).astype(np.int64) if len(label) else np.zeros(0, dtype=np.int64)
    owner, feature = np.repeat(np.arange(len(label)), sizes), np.asarray(terms.flatten()).astype(np.int64)
    rng = np.random.default_rng(SEED)
    share = min(max(label.mean(), 0.01), 0.99) if len(label) else 0.0
    bias = float(np.log(share / (1 - share))) if len(label) else -20.0
    w, v = np.zeros(len(kept)), rng.normal(0, 0.01, (len(kept), FACTORS))
    gw, gv, gb = np.full_like(w, 1e-6), np.full_like(v, 1e-6), 1e-6
    cut = np.searchsorted(owner, np.arange(len(label) + 1))
    for _ in range(EPOCHS):
        order = rng.permutation(len(label))
        for at in range(0, len(order), BATCH):
            rows = order[at: at + BATCH]
            n = cut[rows + 1] - cut[rows]
            own = np.repeat(np.arange(len(rows)), n)
            f = feature[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(cut[rows], n)]
            total = np.zeros((len(rows), FACTORS))
            np.add.at(total, own, v[f])
            squares = np.bincount(own, (v[f] ** 2).sum(axis=1), len(rows))
            z = bias + np.bincount(own, w[f], len(rows)) + 0.5 * ((total**2).sum(axis=1) - squares)
            slope = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[rows]) / len(rows)
            dw = np.bincount(f, slope[own], len(w)) + DECAY * w
            dv = np.zeros_like(v)
            np.add.at(dv, f, slope[own, None] * (total[own] - v[f]))
            dv += DECAY * v
            gw, gv, gb = gw + dw**2, gv + dv**2, gb + slope.sum() ** 2
            w, v, bias = w - RATE * dw / np.sqrt(gw), v - RATE * dv / np.sqrt(gv), bias - RATE * slope.sum() / np.sqrt(gb)
    return kept, float(bias), w, v


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "toxic", train_rows: int = 20_000) -> DataFrame:
    """(id, held_out, score, predicted) for every row of ``docs``.

    The model learns from labelled rows whose crc32(id as text) mod 5 is not 0; ``train_rows`` bounds how many, picked
    by a hash of the id. Labels other than 0 and 1, null labels and labels of unknown documents are passed over. A null
    or empty text has no terms and gets the bias's score; with no labels at all every score is near 0. A row with a null
    id is scored and not held out. Texts count whole; repeated rows get equal scores; other columns are not looked at; an
    empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    marks = labels.select(F.col(label_id).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    model = docs.sparkSession.sparkContext.broadcast(fit(rows, marks, train_rows))

    def predict(batches):
        kept, bias, w, v = model.value
        place = np.full(BUCKETS, -1, dtype=np.int64)
        place[kept] = np.arange(len(kept))
        for batch in batches:
            out = []
            for n, row, bucket in term_sets(batch.column(2)):
                feature = place[bucket]
                owner, feature = _distinct(row[feature >= 0], feature[feature >= 0], max(len(kept), 1))
                linear = np.bincount(owner, w[feature], n) if len(feature) else np.zeros(n)
                total = np.stack([np.bincount(owner, v[feature, k], n) for k in range(FACTORS)], axis=1) if len(feature) else np.zeros((n, FACTORS))
                squares = np.bincount(owner, (v[feature] ** 2).sum(axis=1), n) if len(feature) else np.zeros(n)
                z = bias + linear + 0.5 * ((total**2).sum(axis=1) - squares)
                out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
            p = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["id", "held_out", "score", "predicted"])

    return rows.select("id", held_out("id").alias("held_out"), "text").mapInArrow(predict, "id long, held_out boolean, score double, predicted int")
