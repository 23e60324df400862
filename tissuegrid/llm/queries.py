"""Queries of the training-data operators over the supplied tables, with their SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tissuegrid.llm import chat, codes, langid, lattice, minhash, mixing, pages, phrases, pivots, secrets, tiles, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            TWINS[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Components in SQL: the smallest id reachable, from a table links(a, b) that holds both directions.
_REACH = """
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
parts AS (SELECT a, least(a, min(b)) AS component_id FROM reach GROUP BY a)
"""

OP9_SQL = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
shingled AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM worded),
sizes AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingled x JOIN shingled y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
{_REACH}
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(p.component_id, d.doc_id) AS component_id,
  d.doc_id = coalesce(p.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN parts p ON p.a = d.doc_id
"""


@query("op9_minhash_near_duplicates", OP9_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    out = minhash.near_duplicates(table(spark, folder, "documents"), "doc_id", "text", width=5, over=85, under=100)
    return out.withColumnRenamed("id", "doc_id")


@query("op3_secret_scan")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = secrets.scan(docs).select("doc_id", "found.*")
    return out.drop("clean")


@query("op8_entropy_balanced_mix")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    out = mixing.mix(table(spark, folder, "documents"), "doc_id", "text", "source", weights=(5, 2, 1), share=1.5, most=2.0)
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies", "rate")


@query("op10_language_id")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    out = langid.identify(table(spark, folder, "documents"), "doc_id", "text", "lang", train_rows=20_000)
    return out.withColumnRenamed("id", "doc_id")


OP2_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id WHERE list_cosine_similarity(x.e, y.e) >= 0.95),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
{_REACH}
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, coalesce(p.component_id, v.vec_id) AS component_id,
  v.vec_id = coalesce(p.component_id, v.vec_id) AS kept
FROM v LEFT JOIN counts c ON c.a = v.vec_id LEFT JOIN parts p ON p.a = v.vec_id
"""


@query("op2_embedding_near_duplicates", OP2_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    out = tiles.near_vectors(table(spark, folder, "embeddings"), "vec_id", "embedding", threshold=0.95)
    return out.withColumnRenamed("id", "vec_id")


OP6_SQL = """
WITH v AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(1024 * x)) AS e FROM embeddings),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query("op6_exact_top_products", OP6_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return pivots.top_products(table(spark, folder, "embeddings"), "vec_id", "embedding", k=10, every=100, scale=1024)


@query("op4_sampled_pieces")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    out = lattice.sampled(table(spark, folder, "documents"), "doc_id", "text", samples=2, alpha=1.0, check=True)
    return out.withColumnRenamed("id", "doc_id")


@query("op7_toxicity")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    out = toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"), label_col="toxic", train_rows=20_000)
    return out.withColumnRenamed("id", "doc_id")


@query("op1_main_text")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    out = pages.extract(table(spark, folder, "pages").select("page_id", "url", "html"), "html", "text")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op5_chat_format")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    out = chat.repair(table(spark, folder, "conversations"), "conv_id", "turn", "role", "text")
    return out.withColumnRenamed("conv", "conv_id")


OP11_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang),
grams AS (
  SELECT lang, m AS words, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM worded, (VALUES (1), (2), (3)) AS v(m)),
f AS (SELECT lang, words, phrase, count(*) AS n FROM grams GROUP BY ALL HAVING count(*) >= 10),
wanted AS (SELECT lang, words, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1),
cuts AS (SELECT *, unnest(range(1, words)) AS k FROM wanted),
scored AS (
  SELECT c.lang, c.phrase, c.words, c.a, c.k, x.n AS l, y.n AS r,
    CAST((1000000::HUGEINT * c.a::HUGEINT * c.a::HUGEINT) // (x.n::HUGEINT * y.n::HUGEINT) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
within AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM wanted WHERE words = 3),
most AS (SELECT lang, phrase, max(a) AS most FROM within GROUP BY ALL),
kept AS (SELECT s.* FROM lowest s LEFT JOIN most m ON m.lang = s.lang AND m.phrase = s.phrase WHERE m.most IS NULL OR 100 * m.most < 50 * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT k.lang, k.rank, k.phrase, k.a, k.l, k.r, t.n, k.score FROM ranked k JOIN totals t ON t.lang = k.lang WHERE k.rank <= 2000
"""


@query("op11_phrases", OP11_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"), "text", "lang", longest=3, least=10, inside=50, first=2000)


OP12_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS payload_digest FROM p),
l AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS last FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN last <> page_id THEN last END AS refers_to
FROM l
"""


@query("op12_warc_bundles", OP12_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(table(spark, folder, "pages"), "page_id", "url", "html", least=1000).withColumnRenamed("id", "page_id")


def _rounds_sql(rounds: int, parts: int = 8, entries: int = 16) -> str:
    """Each round as three tables: nearest entries, sums by entry, moved entries."""
    steps = [
        "raw AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)",
        "kept AS (SELECT vec_id, label, list_transform(e, lambda x: CAST(floor(4096 * x) AS BIGINT)) AS e FROM raw"
        " WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"cut AS MATERIALIZED (SELECT vec_id, p AS part, e[p * (len(e) // {parts}) + 1:(p + 1) * (len(e) // {parts})] AS x FROM kept, range({parts}) AS t(p))",
        f"first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {entries})",
        "book0 AS MATERIALIZED (SELECT part, entry, x AS c FROM cut JOIN first USING (vec_id))",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"near{i} AS MATERIALIZED (SELECT vec_id, part, unnest(min({{'d': d, 'entry': entry}})) FROM (SELECT vec_id, part, entry,"
            f" list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM cut JOIN book{i} USING (part)) GROUP BY vec_id, part)"
        )
        if i < rounds:
            steps.append(
                f"sums{i} AS (SELECT part, entry, j, sum(x[j]) AS s, count(*) AS n FROM cut JOIN near{i} USING (vec_id, part), (SELECT unnest(range(1, len(e) // {parts} + 1)) AS j FROM (SELECT e FROM kept LIMIT 1)) AS js GROUP BY ALL)"
            )
            steps.append(
                f"book{i + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM book{i} b LEFT JOIN (SELECT part, entry,"
                f" list(CAST(CASE WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END AS BIGINT) ORDER BY j) AS c FROM sums{i} GROUP BY part, entry) m USING (part, entry))"
            )
    return ",\n".join(steps)


OP13_SQL = f"""
WITH {_rounds_sql(6)},
coded AS (SELECT vec_id, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near6 GROUP BY vec_id),
whole AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book6)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded JOIN kept USING (vec_id), whole
"""


@query("op13_vector_codes", OP13_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    out = codes.compressed(table(spark, folder, "embeddings"), "vec_id", "embedding", "label", parts=8, entries=16, rounds=6, scale=4096.0)
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")
