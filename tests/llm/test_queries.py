"""The registered queries beside their SQL twins, and the pipeline's stages beside plain Python."""

import re

import corpus_pipeline
import pytest
from compare import compare, connect

from __spark_entry__ import oracle_sql, queries
from tissuegrid.llm import secrets

NAMES = [n for n in queries() if re.match(r"op\d+_", n)]
CONTRACT = {
    "1": {"page_id", "url", "text", "n_chars"}, "2": {"vec_id", "n_links", "component_id", "kept"},
    "3": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"}, "4": {"doc_id", "sample", "ids"}, "5": {"conv_id", "rendered"},
    "6": {"query_id", "rank", "vec_id", "score"}, "7": {"doc_id", "held_out", "score", "predicted"},
    "8": {"doc_id", "size", "source_size", "target", "taken"}, "9": {"doc_id", "n_shingles", "component_id", "kept"},
    "10": {"doc_id", "held_out", "lang_pred", "score"}, "11": {"lang", "rank", "phrase", "a", "l", "r", "n", "score"},
    "12": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "13": {"vec_id", "code", "error", "label_error", "codebooks_sha256"},
}


def test_every_operator_has_its_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in NAMES) == list(range(1, 14)) and "pipeline" in queries()


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, small, name):
    status, _, _, note = compare(spark, connect(small), small, name, queries()[name], oracle_sql().get(name))
    assert status in ("ok", "rows"), note
    assert CONTRACT[re.match(r"op(\d+)_", name)[1]] <= set(queries()[name](spark, small).columns)


def test_pipeline_stages(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    first = kept["language_id"]
    assert {r["doc_id"] for r in first} == {i for i, r in before.items() if any(c.isalpha() for c in r["text"] or "")}
    sets = {}
    for r in first:
        w = r["text"].encode().lower().split()
        sets[r["doc_id"]] = {tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    alone = set(sets)
    for i in sorted(sets):  # documents linked to a smaller one that is not itself linked to a smaller one go
        alone -= {j for j in sets if j > i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert {r["doc_id"] for r in kept["minhash_near_duplicates"]} == alone
    for r in kept["secret_scan"]:
        assert not secrets.base_spans(r["text"]) and r["n_chars"] == len(r["text"])
    words = {}
    for r in kept["secret_scan"]:
        words[r["source"]] = words.get(r["source"], 0) + len(r["text"].split())
    mixed = {}
    for r in kept["mix_sources"]:
        mixed[r["source"]] = mixed.get(r["source"], 0) + len(r["text"].split())
    assert sum(mixed.values()) == pytest.approx(1.5 * sum(words.values()), rel=0.1)
    assert all(n <= 2 * words[s] for s, n in mixed.items())
    assert {r["doc_id"] for r in kept["sampled_pieces"]} == {r["doc_id"] for r in kept["mix_sources"]}
    whole = corpus_pipeline.run(spark, small).collect()
    assert sorted((r["doc_id"], r["sample"], r["ids"]) for r in whole) == sorted((r["doc_id"], r["sample"], r["ids"]) for r in kept["sampled_pieces"])


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_near_duplicates_stage_keeps_null_and_repeated_ids(spark):
    texts = [" ".join(f"{name}{i}" for i in range(30)) for name in "abcd"]
    rows = [(None, texts[0]), (5, texts[1]), (5, texts[2]), (3, texts[2]), (None, texts[3]), (9, texts[3]), (None, texts[3]), (5, texts[1]), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
    got = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()), key=str)
    assert got == sorted([(None, texts[0]), (5, texts[1]), (3, texts[2]), (9, texts[3]), (None, None)], key=str)


def test_mix_stage_takes_rows_of_null_and_repeated_ids_twice_at_most(spark):
    rows = [(None, f"n{i} b c d", "s") for i in range(20)] + [(1, "same words here", "s")] * 20 + [(2, f"x{i} y", "t") for i in range(20)]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], DOCS)
    got = [(r["doc_id"], r["text"], r["source"]) for r in corpus_pipeline.mix_sources(spark, docs, "").collect()]
    assert all(got.count(x) <= 2 * rows.count(x) for x in set(got))
    assert any(i is None for i, _, _ in got) and abs(sum(len(t.split()) for _, t, _ in got) - 1.5 * sum(len(t.split()) for _, t, _ in rows)) <= 12
