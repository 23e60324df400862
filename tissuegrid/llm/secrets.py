"""Secret scans: fixed patterns, and strings that a subword vocabulary cannot compress."""

from __future__ import annotations

import base64
import bisect
import hashlib
import re

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tissuegrid.llm import words

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the usual split pattern of that vocabulary.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

KINDS = ("assign", "access", "hex", "random")
#: Shortest string the token test looks at, and the characters per token under which it counts as random.
SHORTEST, RATIO = 20, 2.0

# All patterns run over one byte per code point, so that places are code points; bytes above 127 match nothing.
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ASSIGN = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"(?<![0-9a-f])[0-9a-f]{32,}")
_HEX_BYTE = bytes(1 if chr(c) in "0123456789abcdef" else 0 for c in range(256))
_STRING = re.compile(rb"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
# Known digests and identifiers: hex of a digest's length, UUIDs, numbers; the first two also inside longer strings.
_DIGEST = rb"(?:0x)?(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})"
_UUID = rb"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
_KNOWN = re.compile(_DIGEST + rb"|" + _UUID + rb"|[0-9+/_=-]+", re.IGNORECASE)
_INSIDE = re.compile(rb"(?<![A-Za-z0-9])(?:" + _UUID + rb"|" + _DIGEST + rb")(?![A-Za-z0-9])", re.IGNORECASE)
_PART = re.compile(rb"[A-Za-z0-9]+|[^A-Za-z0-9]+")
#: Characters of a part that are put into tokens at once: a cut costs one token at most.
CHUNK = 4096


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns: leftmost matches that do not overlap within a kind."""
    flat = text.encode("latin-1", "replace")
    out = []
    small = flat.lower()
    if any(k in small for k in _KEYWORDS):
        out += [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(flat) if m.end(2) - m.start(2) >= 8]
    if b"AKIA" in flat:
        out += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(flat) if m.end() - m.start() >= 16]
    # A run of 32 holds four places in a row of every eighth: most texts are done after an eighth of their length.
    if b"\1\1\1\1" in flat[::8].translate(_HEX_BYTE):
        out += [(m.start(), "hex", m.end()) for m in _HEX.finditer(flat)]
    return out


def _free(start: int, end: int, covered: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What sorted intervals leave of start to end."""
    out = []
    for a, b in covered:
        if a >= end:
            break
        if b > start:
            if a > start:
                out.append((start, a))
            start = max(start, b)
    return [*out, (start, end)] if start < end else out


def _dense(run: bytes, encode) -> list[tuple[int, int]]:
    """Places in a string that the vocabulary cannot compress: all of it, or chains of parts with few characters per token.

    The vocabulary splits letters and digits from other signs, so the tokens of the parts add up to those of the whole.
    """
    if len(run) < SHORTEST or _KNOWN.fullmatch(run):
        return []
    parts = [(m.start(), m.end(), sum(len(encode(run[i: min(i + CHUNK, m.end())].decode("ascii"))) for i in range(m.start(), m.end(), CHUNK))) for m in _PART.finditer(run)]
    if len(run) < RATIO * sum(n for _, _, n in parts):
        return [(0, len(run))]
    out, chain = [], []
    for start, end, n in [*parts, (len(run), len(run), 0)]:
        if n and end - start < RATIO * n:
            chain.append((start, end, n))
            continue
        if n and not run[start:end].isalnum():
            chain.append((start, end, n))  # signs between parts
            continue
        while chain and not run[chain[0][0]: chain[0][1]].isalnum():
            chain.pop(0)
        while chain and not run[chain[-1][0]: chain[-1][1]].isalnum():
            chain.pop()
        if chain:
            a, b = chain[0][0], chain[-1][1]
            if b - a >= SHORTEST and b - a < RATIO * sum(c for _, _, c in chain) and not _KNOWN.fullmatch(run[a:b]):
                out.append((a, b))
        chain = []
    return out


def random_spans(text: str, encode, taken: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """Strings of at least SHORTEST characters with under RATIO characters per token, in what ``taken`` leaves.

    Known identifiers inside a longer string are left out of it; what is between them is looked at on its own.
    """
    out = []
    flat = text.encode("latin-1", "replace")
    covered = []
    for a, b in sorted((a, b) for a, _, b in taken):
        if covered and a <= covered[-1][1]:
            covered[-1] = (covered[-1][0], max(b, covered[-1][1]))
        else:
            covered.append((a, b))
    ends = [b for _, b in covered]
    for m in _STRING.finditer(flat):
        for start, end in _free(m.start(), m.end(), covered[bisect.bisect_right(ends, m.start()):]):
            known = [(start + k.start(), start + k.end()) for k in _INSIDE.finditer(flat[start:end])]
            for a, b in _free(start, end, known):
                out += [(a + i, "random", a + j) for i, j in _dense(flat[a:b], encode)]
    return out


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]))))


def redacted(text: str, spans: list[tuple[int, str, int]], mark: str) -> str:
    """The text with every stretch covered by spans replaced by ``mark``."""
    out, at, reach = [], 0, -1
    for start, _, end in sorted(spans):
        if start >= reach:
            out += [text[at:start], mark]
        reach = at = max(reach, end)
    return "".join([*out, text[at:]])


def _vocabulary(spark: SparkSession, path: str):
    """The vocabulary file's bytes for every task: its size is that of the file, whatever the table."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _encoder(raw: bytes):
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}
    return tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def scan(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with ``found``: n_assign, n_access, n_hex, n_random, base_sha256, spans and clean, the redacted text.

    Places are code points, ends exclusive; spans are kind:start:end by start, then kind in the order of KINDS. A null
    text is scanned as an empty one (no spans, the digest of an empty list) and its clean text stays null. Texts count
    whole, whatever their length; rows are handled one by one, so repeated rows agree, an empty table stays empty and
    other columns pass through untouched, whatever their names. A column named ``found`` is replaced.
    """
    raw = _vocabulary(docs.sparkSession, vocabulary)
    names = [c for c in docs.columns if c != "found"]
    rows = docs.select(*[F.col(f"`{c}`") for c in names])
    kept = rows.schema.fields
    if text_col in names and rows.schema[text_col].dataType == T.StringType():
        at = names.index(text_col)  # texts reach the task once
    else:
        rows, at = docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text_col}`").cast("string").alias("__text")), len(names)

    def find(batches):
        encode = None
        for batch in words.tidy(batches):
            for piece in words.pieces(batch.column(at)):
                part = batch.slice(piece.first, piece.last - piece.first)
                counts, digests, spans, clean = {k: [] for k in KINDS}, [], [], []
                for text in part.column(at).to_pylist():
                    base = base_spans(text) if text else []
                    more = []
                    if text:
                        if encode is None:
                            encode = _encoder(raw.value)
                        more = random_spans(text, encode, base)
                    for kind in KINDS:
                        counts[kind].append(sum(s[1] == kind for s in base) + sum(s[1] == kind for s in more))
                    digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                    spans.append(joined(base + more))
                    clean.append(redacted(text, base + more, mark) if base or more else text)
                found = pa.StructArray.from_arrays(
                    [*(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(clean, pa.string())],
                    names=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "clean"],
                )
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], found], names=[*names, "found"])

    shape = T.StructType([*(T.StructField(f"n_{k}", T.LongType()) for k in KINDS), *(T.StructField(c, T.StringType()) for c in ("base_sha256", "spans", "clean"))])
    schema = T.StructType([*kept, T.StructField("found", shape)])
    return rows.mapInArrow(find, schema)
