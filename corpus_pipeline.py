"""Corpus pipeline over ``documents``: stages that follow one another, each on all rows that its predecessor kept.

Every stage but the last returns the columns of ``documents``. Null texts, null ids, repeated rows, empty tables and extra
columns are handled as each operator's docstring says; extra columns are dropped by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tissuegrid.llm import langid, lattice, minhash, mixing, secrets
from tissuegrid.runtime import cut_lineage

#: No SQL says what the language model, the token test, the rounding and the draws do; tests compare with plain Python.
ORACLE_SQL = None

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Documents whose language is less sure than this go, with those that have no letter at all.
SURE = 0.5


def _with_text(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or of no sure language go; ``lang`` becomes the language found."""
    model = langid.fit(docs, "doc_id", "text", "lang", train_rows=20_000)
    scored = langid.predict(docs.select(*COLUMNS), model, "text")
    sure = scored.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= SURE))
    return sure.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def _key():
    """Number of a row by its content: rows with one number are repeats of each other, whatever their ids."""
    return F.xxhash64(*[part for c in COLUMNS for part in (F.col(c), F.col(c).isNull())])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity of 0.8 or more.

    It is the one with the smallest id, nulls last, then the smallest number by content. Documents are told apart by
    their content, not by their ids: those with null or repeated ids stay unless another document of their group does.
    """
    keyed = docs.select(*COLUMNS, _key().alias("__key"))
    found = minhash.near_duplicates(keyed, "__key", "text", width=5, over=80, under=100).select(F.col("id").alias("__key"), "component_id").distinct()
    ids = keyed.groupBy("__key").agg(F.min("doc_id").alias("doc_id"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__key"))
    kept = found.join(ids, "__key").groupBy("component_id").agg(first.alias("first")).select(F.col("first.__key").alias("__key"))
    return keyed.join(kept, "__key", "left_semi").dropDuplicates(["__key"]).select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are taken out of the texts; every document stays."""
    return _with_text(secrets.scan(docs.select(*COLUMNS)).withColumn("text", F.col("found.clean")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it: not at all, once or twice. Null and repeated ids are rows like others."""
    keyed = cut_lineage(docs.select(*COLUMNS, _key().alias("__key"), F.monotonically_increasing_id().alias("__row")))
    taken = mixing.mix(keyed, "__key", "text", "source", row_col="__row").where("copies > 0").select(F.col("row").alias("__row"), "copies")
    both = keyed.join(taken, "__row")
    return both.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def sample_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of each text of the mix, each decoded and held against the text."""
    out = lattice.sampled(docs, "doc_id", "text", samples=2, alpha=1.0, together=1 << 18, check=True)
    return out.withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language_id),
    ("minhash_near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("sampled_pieces", sample_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
