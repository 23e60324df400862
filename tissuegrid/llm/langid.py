"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tissuegrid.llm import words

#: Hashed n-gram buckets, and the n-gram lengths in characters. The model is languages x BUCKETS doubles.
BUCKETS, LENGTHS = 1 << 15, (2, 3)
UNKNOWN = "und"
#: Characters below this get their letter and lower-case form from a table, others one by one.
TABLED = 0x3000


@dataclass(frozen=True)
class Model:
    langs: list[str]
    prior: np.ndarray
    logp: np.ndarray  # buckets x langs


def _tables() -> tuple[np.ndarray, np.ndarray]:
    letter = np.array([chr(c).isalpha() for c in range(TABLED)])
    small = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 else c for c in range(TABLED)], dtype=np.uint32)
    return letter, small


def _grams(texts: list[str], tables) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every n-gram of the texts one after the other, where each text's grams begin and end, and its letters.

    Letters are lower-cased, every run of other characters counts as one blank, and so do both ends of a text.
    """
    letter, small = tables
    gap = max(LENGTHS) - 1  # blanks between texts, so that no n-gram reaches into the next one
    joined = "\n" * gap + "".join(t + "\n" * gap for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    stop = np.cumsum([len(t) + gap for t in texts])  # first blank after each text
    start = np.concatenate([[0], stop[:-1]]) + gap - 1  # last blank before it
    low = np.minimum(codes, TABLED - 1)
    is_letter = letter[low]
    folded = np.where(codes < TABLED, small[low], codes)
    high = np.flatnonzero(codes >= TABLED)
    if len(high):
        known, back = np.unique(codes[high], return_inverse=True)
        is_letter[high] = np.array([chr(c).isalpha() for c in known])[back]
    folded = np.where(is_letter, folded, 32)
    total = np.concatenate([[0], np.cumsum(is_letter)])
    letters = total[stop] - total[start]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # the first blank of a run
    for k in range(gap):
        keep[stop + k] = keep[k] = True
    place = np.cumsum(keep) - 1
    folded, start, stop = folded[keep].astype(np.uint64), place[start], place[stop]
    out = []
    with np.errstate(over="ignore"):
        for n in LENGTHS:
            h = np.zeros(len(folded) - n + 1, dtype=np.uint64)
            for k in range(n):
                h = (h + folded[k: k + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            out.append((words.mix(h + np.uint64(n)) >> np.uint64(64 - (BUCKETS.bit_length() - 1))).astype(np.int64))
    return out, start, stop, letters


def _text_pieces(column: pa.Array) -> Iterator[list[str]]:
    for piece in words.pieces(column):
        yield [t or "" for t in column.slice(piece.first, piece.last - piece.first).to_pylist()]


def _held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, train_rows: int) -> Model:
    """Learn from about ``train_rows`` documents, picked by a hash of their id, that are not held out and have a language."""
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    known = known.where(~_held_out("id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    n = known.count()
    if n > train_rows:
        known = known.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30)) < int(train_rows / n * (1 << 30)))

    def count(batches):
        tables, sums, rows = _tables(), {}, {}
        for batch in words.tidy(batches):
            langs = batch.column(1).to_pylist()
            at = 0
            for texts in _text_pieces(batch.column(0)):
                grams, start, stop, letters = _grams(texts, tables)
                for i, lang in enumerate(langs[at: at + len(texts)]):
                    if letters[i]:
                        mine = sums.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                        rows[lang] = rows.get(lang, 0) + 1
                        for g in grams:
                            mine += np.bincount(g[start[i]: stop[i]], minlength=BUCKETS)
                at += len(texts)
        for lang, mine in sums.items():
            used = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(used) + 1), pa.string()), pa.array(np.append(used, -1), pa.int64()), pa.array(np.append(mine[used], rows[lang]), pa.int64())],
                names=["lang", "bucket", "n"],
            )

    counted = known.select("text", "lang").mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counted.toPandas()  # at most languages x (BUCKETS + 1) rows
    langs = sorted(table["lang"].unique())
    counts, prior = np.zeros((BUCKETS, len(langs))), np.zeros(len(langs))
    for j, lang in enumerate(langs):
        own = table[table["lang"] == lang]
        grams = own[own["bucket"] >= 0]
        counts[grams["bucket"].to_numpy(), j] = grams["n"].to_numpy()
        prior[j] = own.loc[own["bucket"] < 0, "n"].iloc[0]
    logp = np.log(counts + 0.5) - np.log(counts.sum(axis=0) + 0.5 * BUCKETS)
    return Model(langs, np.log(prior / max(prior.sum(), 1)), logp)


def predict(docs: DataFrame, model: Model, text_col: str) -> DataFrame:
    """``docs`` with lang_pred and score, the posterior of that language."""
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.prior, model.logp))  # plain values: executors need no copy of this library
    width = len(docs.columns)
    if docs.columns.count(text_col) == 1 and docs.schema[text_col].dataType == T.StringType():
        rows, at = docs, docs.columns.index(text_col)  # texts reach the task once
    else:
        rows, at = docs.withColumn("__text", F.col(text_col).cast("string")), width

    def score(batches):
        tables, m = _tables(), Model(*shared.value)
        names = np.array([*m.langs, UNKNOWN], dtype=object)
        for batch in words.tidy(batches):
            best, sure = [], []
            for texts in _text_pieces(batch.column(at)):
                grams, start, stop, letters = _grams(texts, tables)
                total = np.tile(m.prior, (len(texts), 1))
                for g in grams:
                    for j in range(len(m.langs)):
                        run = np.concatenate([[0.0], np.cumsum(m.logp[g, j])])
                        total[:, j] += run[stop] - run[start]
                if m.langs:
                    pick = total.argmax(axis=1)
                    odds = np.exp(total - total.max(axis=1, keepdims=True))
                    p = odds.max(axis=1) / odds.sum(axis=1)
                else:
                    pick, p = np.zeros(len(texts), dtype=int), np.zeros(len(texts))
                none = letters == 0
                pick[none] = len(m.langs)
                p[none] = 0.0
                best += names[pick].tolist()
                sure.append(p)
            columns = [batch.column(i) for i in range(width)] + [pa.array(best, pa.string()), pa.array(np.concatenate(sure) if sure else [], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names_in, "lang_pred", "score"])

    names_in = docs.columns
    schema = T.StructType([*docs.schema.fields]).add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(score, schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_rows: int = 20_000) -> DataFrame:
    """(id, held_out, lang_pred, score) for every row of ``docs``.

    The model learns from rows whose crc32(id as text) mod 5 is not 0 and whose language and text are not null;
    ``train_rows`` bounds how many, picked by a hash of the id. A text that is null, empty or without a letter is
    ``und`` with score 0; if nothing could be learnt, so are all texts. Equal posteriors go to the language that is
    first in code point order. A row with a null id is not held out. Texts of any length count whole. Repeated rows get
    equal results; other columns of ``docs`` are not looked at; an empty table gives an empty result.
    """
    model = fit(docs, id_col, text_col, lang_col, train_rows)
    rows = docs.select(F.col(id_col).alias("id"), _held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    scored = predict(rows, model, "text")
    unknown = F.lit(UNKNOWN) if not model.langs else F.col("lang_pred")
    return scored.select("id", "held_out", unknown.alias("lang_pred"), "score")
