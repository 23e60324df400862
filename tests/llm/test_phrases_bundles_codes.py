"""Phrases, WARC bundles and vector codes against plain Python, exact round trips and edge cases."""

import glob
import hashlib
import io
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyarrow import fs
from pyspark.sql import functions as F

from tissuegrid.llm import codes, phrases, warc

# --- 11: phrases -----------------------------------------------------------------------------------


def plain_phrases(rows, longest=3, least=10, inside=50, first=2000):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", (text or "").encode()):
            words = [w.lower().decode() for w in re.findall(rb"[^\x20\x09]+", piece)]
            total[lang or "und"] += len(words)
            for m in range(1, longest + 1):
                f[lang or "und"].update(tuple(words[i: i + m]) for i in range(len(words) - m + 1))
    out = set()
    for lang, seen in f.items():
        wanted = {p: a for p, a in seen.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in wanted.items():
            if any(100 * b >= inside * a and any(q[i: i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in wanted.items() if len(q) > len(p)):
                continue
            score, _, l, r = min((1000000 * a * a // (seen[p[:k]] * seen[p[k:]]), k, seen[p[:k]], seen[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:first], 1):
            out.add((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return out


def some_texts(seed=5, n=160):
    rng = random.Random(seed)
    words = ["the", "The", "of", "New", "york", "été", "日本", "x1", "ab", "b", "c d", "of the", "a\x0bb", "hot dog", "hot dog stand"] + [f"w{i}" for i in range(30)]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "en", "de", None, "und"])
        rows.append((lang, "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "!? ", "\n"]) for _ in range(rng.randint(0, 60)))))
    return [*rows, ("en", None), ("en", ""), ("en", " \t.,"), ("fr", "..."), ("en", "hot dog stand " * 900), ("en", "hot dog stand " * 900), (None, "a b " * 40)]


def mined(spark, rows, **how):
    docs = spark.createDataFrame([(i % 7 if i % 5 else None, lang, t) for i, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string")
    docs = docs.withColumn("phrase", F.lit("x")).withColumn("n", F.lit("y")).withColumn("grp", F.lit(0))
    out = phrases.collocations(docs, **how)
    return {(r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in out.collect()}


def test_phrases_match_plain_counts(spark):
    rows = some_texts()
    assert mined(spark, rows) == plain_phrases(rows) != set()
    assert mined(spark, rows, first=3) == plain_phrases(rows, first=3)


def test_phrases_in_small_chunks_with_every_prefix_split(spark, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK", 7)
    monkeypatch.setattr(phrases, "TEXT", 50)
    monkeypatch.setattr(phrases, "GROUP", 100)
    monkeypatch.setattr(phrases, "LOOK", 1 << 20)
    rows = some_texts(8, 80)
    assert mined(spark, rows) == plain_phrases(rows)
    monkeypatch.setattr(phrases, "DEALS", 5)  # dealt out in two steps
    monkeypatch.setattr(phrases, "GATHERED", 300)
    assert mined(spark, rows) == plain_phrases(rows)


def test_longer_phrases_and_other_thresholds(spark):
    rows = some_texts(9, 60)
    for how in ({"longest": 2, "least": 4}, {"longest": 4, "least": 3, "inside": 70}):
        assert mined(spark, rows, **how) == plain_phrases(rows, **how)


def test_phrases_of_nothing(spark):
    assert mined(spark, [("en", "x")])  == set()
    docs = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert phrases.collocations(docs).count() == 0


def test_scores_beyond_64_bits(spark, monkeypatch):
    big = 10**13 + 7
    rows = [("en", None, 0, 10**15), ("en", "a", 1, big * 3 + 1), ("en", "b", 1, big + 11), ("en", "a b", 2, big - 5), ("en", "c", 1, big + 5), ("en", "a c", 2, 10)]
    monkeypatch.setattr(phrases, "phrase_counts", lambda docs, *_: spark.createDataFrame(rows, phrases.COUNTS.replace("n long", "n long")))
    got = {r["phrase"]: r["score"] for r in phrases.collocations(spark.createDataFrame([], "text string, lang string")).collect()}
    n = {p: x for _, p, _, x in rows}
    assert got == {p: 1000000 * n[p] ** 2 // (n["a"] * n[p[-1]]) for p in ("a b", "a c")}


def test_multikey_quicksort_counts():
    rng = np.random.default_rng(3)
    for least in (1, 4, 30):
        ids = rng.zipf(1.6, (3, 5000)).clip(1, 40).astype(np.int32) - 1
        ids[1][ids[0] == 0] = 0
        ids[2][ids[1] == 0] = 0
        n = rng.integers(1, 5, 5000)
        want = Counter()
        for column, k in zip(ids.T.tolist(), n.tolist()):
            for d in range(3):
                if 0 not in column[: d + 1]:
                    want[tuple(column[: d + 1])] += k
        got = {}
        for d, at, counts in phrases.multikey_counts(ids, n, least):
            got |= {tuple(ids[: d + 1, p].tolist()): int(c) for p, c in zip(at, counts)}
        assert got == {p: c for p, c in want.items() if c >= least}
    assert not list(phrases.multikey_counts(np.zeros((3, 0), dtype=np.int32), np.zeros(0, dtype=np.int64), 1))


# --- 12: WARC bundles ------------------------------------------------------------------------------

PAGE = "page_id long, url string, html string"


def pages_of():
    rng = random.Random(1)
    long, other = "é" * 500, "x" * 999
    rows = [(i, f"http://a/{i}", "<p>" + "".join(rng.choices("abc é\n", k=rng.choice([0, 10, 3000])))) for i in range(60)]
    rows += [(100 + i, "http://b/", long) for i in range(5)] + [(200 + i, None, other) for i in range(3)] + [(104, "http://b/", long), (None, "u", long)]
    rows += [(None, "u", "n" * 2000), (None, "u\r\nX: 1", "n" * 2000), (300, "", None), (301, "http://c/", ""), (302, "http://c/", "WARC/1.1\r\n\r\n" * 400), (303, "é", "z" * 3_000_000)]
    return rows


def plain_types(rows):
    out = []
    for i, _, text in rows:
        body = (text or "").encode()
        ids = [j for j, _, t in rows if len(body) >= 1000 and (t or "").encode() == body and j is not None]
        other = max(ids) if ids and i != max(ids) else None
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "response" if other is None else "revisit", other))
    return sorted(out, key=repr)


def test_archives_give_back_every_page(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME", 4000)
    monkeypatch.setattr(warc, "BUNDLE", 3000)
    monkeypatch.setattr(warc, "RUN", 2000)
    rows = pages_of()
    table = spark.createDataFrame(rows, PAGE).repartition(3).withColumn("payload", F.lit(1)).withColumn("id", F.lit("x")).withColumn("key", F.lit(2))
    got = warc.archived(table)
    assert got.dtypes[0] == ("id", "bigint") and got.dtypes[4] == ("refers_to", "bigint")
    assert sorted(map(tuple, got.collect()), key=repr) == plain_types(rows)

    index, folder = warc.write(table, str(tmp_path / "w"))
    read = warc.read(index, folder).collect()
    whole = {(r["id"], bytes(r["payload"])) for r in read if r["record_type"] == "response"}
    want = {(None if i is None else str(i), (t or "").encode()) for (i, _, t) in rows}
    types = {(i, d) for i, _, d, kind, _ in plain_types(rows) if kind == "response"}
    assert whole == {(i, t) for i, t in want if (None if i is None else int(i), hashlib.sha1(t).hexdigest()) in types}
    assert {r["url"] for r in read if r["id"] is None} == {"u", "u%0D%0AX: 1"}
    assert index.count() == len(rows)

    wanted = spark.createDataFrame([(3,), (104,), (303,), (999,), (None,)], "id long")
    found = warc.fetch(index, folder, wanted).collect()
    assert sorted(r["id"] for r in found) == ["104", "104", "3", "303"]
    assert {r["id"]: len(r["payload"]) for r in found} == {"3": len((rows[3][2]).encode()), "104": 1000, "303": 3_000_000}


def test_bundles_are_plain_zstandard_with_a_seek_table(spark, tmp_path):
    index, folder = warc.write(spark.createDataFrame(pages_of(), PAGE).coalesce(1), str(tmp_path / "w"))
    (path,) = glob.glob(f"{folder}/*.warc.zst")
    with open(path, "rb") as file:
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(file.read()), read_across_frames=True).read()
    assert len(list(warc.records_in(whole))) == len(pages_of())
    frames = warc.frames_of(fs.LocalFileSystem(), path)
    assert sum(plain for _, plain in frames) == len(whole) and len(frames) > 1
    starts = np.concatenate([[0], np.cumsum([plain for _, plain in frames])])
    for r in index.collect():
        (one,) = warc.records_in(whole, int(starts[r["frame"]]) + r["offset"], int(starts[r["frame"]]) + r["offset"] + r["length"])
        assert one["id"] == r["id"] and r["frame_size"] == frames[r["frame"]][1]
    broken = whole.replace(b"z" * 100, b"y" * 100, 1)
    with pytest.raises(ValueError, match="digest"):
        list(warc.records_in(broken))


def test_a_failed_attempt_leaves_no_trace_in_the_index(spark, tmp_path):
    index, folder = warc.write(spark.createDataFrame(pages_of(), PAGE), str(tmp_path / "w"))
    (tmp_path / "w" / "bundle-lost.warc.zst").write_bytes(b"half a frame")
    assert warc.read(index, folder).count() == len(pages_of())


def test_no_pages_no_bundle(spark, tmp_path):
    index, folder = warc.write(spark.createDataFrame([], PAGE), str(tmp_path / "w"))
    assert index.count() == warc.read(index, folder).count() == len(glob.glob(f"{folder}/*")) == 0


# --- 13: vector codes ------------------------------------------------------------------------------

VEC = "vec_id long, embedding array<float>, label int"


def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, label, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    w = len(kept[0][2]) // parts
    cut = [[v[p * w: (p + 1) * w] for p in range(parts)] for _, _, v in kept]
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][2]))[:entries]
    books = [[cut[r][p] for r in order] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            at = [nearest(c[p], books[p])[1] for c in cut]
            moved = []
            for e, c in enumerate(books[p]):
                mine = [cut[r][p] for r in range(len(kept)) if at[r] == e]
                moved.append([sum(x) // len(mine) for x in zip(*mine)] if mine else c)
            books[p] = moved
    sha = hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = Counter()
    for (_, label, _), f in zip(kept, found):
        errors[label] += sum(d for d, _ in f)
    return sorted(((i, "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f), errors[label], sha) for (i, label, _), f in zip(kept, found)), key=repr)


def coded(spark, rows, **how):
    table = spark.createDataFrame(rows, VEC).withColumn("id", F.lit("x")).withColumn("v", F.lit(1)).withColumn("code", F.lit(1))
    return sorted((tuple(r[c] for c in ("id", "code", "error", "label_error", "codebooks_sha256")) for r in codes.compressed(table, **how).collect()), key=repr)


def test_codes_match_plain_rounds(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in rng.normal(size=16) * rng.choice([0.1, 1, 30])], int(rng.integers(0, 4)) if i % 9 else None) for i in rng.permutation(150)]
    rows += [(500, None, 1), (501, [float("nan")] * 16, 1), (502, [float("-inf")] + [0.0] * 15, 1), (503, [None] + [0.0] * 15, 2), (None, [0.5] * 16, None)]
    rows += [(7, rows[0][1], 3), (7, rows[0][1], 3), (-1, [0.0] * 16, 0), (-2, [0.0] * 16, 0)]  # repeated ids, equal starts
    assert coded(spark, rows) == plain_codes(rows)
    assert coded(spark, rows, parts=4, entries=5, rounds=2) == plain_codes(rows, 4, 5, 2)


def test_codes_of_few_and_no_rows(spark):
    few = [(3, [1.0] * 8, None), (4, [2.0] * 8, None)]
    assert coded(spark, few) == plain_codes(few)
    assert coded(spark, few[:1]) == plain_codes(few[:1])
    assert coded(spark, [(1, None, 0)]) == [] and coded(spark, []) == []


def test_codes_refuse_what_they_cant_hold(spark):
    for rows, message in (([(1, [1.0] * 8, 0), (2, [1.0] * 16, 0)], "length"), ([(1, [1.0] * 9, 0)], "equal parts"), ([(1, [1e30] * 8, 0)], "64 bits")):
        with pytest.raises(Exception, match=message):
            coded(spark, rows)


def test_orchard_finds_the_nearest_entry():
    rng = np.random.default_rng(6)
    for k, spread in ((1, 5), (2, 3), (16, 4), (100, 1000)):
        book = codes.book_of(rng.integers(-spread, spread, (k, 3)))
        x = rng.integers(-2 * spread, 2 * spread, (4000, 3))
        d = ((x[:, None] - book.entries[None]) ** 2).sum(2)
        number, error = codes.orchard(x, book)
        assert (number == d.argmin(1)).all() and (error == d.min(1)).all()


def test_components_as_whole_numbers():
    sound, x = codes._whole(pa.array([[0.5, -0.5], None, [1.0, None]], pa.list_(pa.float64())), 2, 3.0)
    assert sound.tolist() == [True, False, False] and x.tolist() == [[1, -2]]
