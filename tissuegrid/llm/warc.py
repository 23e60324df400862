"""WARC archives as seekable Zstandard bundles.

A bundle is a run of independent frames, each with some whole records, and a footer that any Zstandard reader skips: the
sizes of all frames. A record is found by its frame and its place in the unpacked frame, so one record costs one ranged
read, and any number of tasks can read one bundle side by side. Tasks write bundles under names of their own attempt; the
index, written by Spark, names only those of attempts that count, so a lost or repeated task leaves no trace in it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissuegrid.llm.words import tidy
from tissuegrid.runtime import cut_lineage, fanout, stage_folder

#: Unpacked bytes of a frame, unless one record has more, packed bytes after which a bundle is, packed bytes read at once.
FRAME, BUNDLE, RUN = 1 << 18, 1 << 26, 1 << 22
# Fixed values of the seekable format: magic numbers of a skippable frame and of the seek table.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"

INDEX = "id string, file string, frame int, frame_start long, frame_bytes long, frame_size long, offset long, length long"
RECORD = "id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as a path or as an address of a shared store."""
    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


# --- one record ------------------------------------------------------------------------------------


def _field(value: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _urn(name: str | None) -> str:
    return f"<urn:page:{'' if name is None else quote(name, safe='') or '%'}>"


def _of_urn(urn: str) -> str | None:
    name = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if not name else "" if name == "%" else unquote(name)


def record(name: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str = DATE) -> bytes:
    """A response with its payload, or a revisit of ``refers_to`` with only the response's own head."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(name)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_field(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}", "Content-Type: application/http; msgtype=response"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    return {name.lower(): value for name, _, value in (line.partition(": ") for line in lines[1:])}


def records_in(data: bytes, first: int = 0, last: int | None = None) -> Iterator[dict]:
    """The records of an unpacked frame from ``first`` to ``last``; a payload that belies its digest is an error."""
    last = len(data) if last is None else last
    while first < last:
        body = data.index(b"\r\n\r\n", first) + 4
        head = _fields(data[first: body - 4])
        first = body + int(head["content-length"]) + 4
        split = data.index(b"\r\n\r\n", body) + 4
        said = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
        size = int(_fields(data[body: split - 4])["content-length"])
        payload = None
        if head["warc-type"] == "response":
            payload = data[split: first - 4]
            if len(payload) != size or hashlib.sha1(payload).hexdigest() != said:
                raise ValueError(f"payload of {head['warc-record-id']} does not have its digest")
        yield {
            "id": _of_urn(head["warc-record-id"]), "url": head.get("warc-target-uri"), "record_type": head["warc-type"],
            "refers_to": _of_urn(head["warc-refers-to"]) if "warc-refers-to" in head else None,
            "payload_bytes": size, "payload_digest": said, "payload": payload,
        }


# --- bundles ---------------------------------------------------------------------------------------


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """Footer of a bundle from the packed and unpacked sizes of its frames."""
    entries = b"".join(struct.pack("<II", *sizes) for sizes in frames)
    return struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries + struct.pack("<IBI", len(frames), 0, SEEKABLE)


def frames_of(store: fs.FileSystem, path: str) -> list[tuple[int, int]]:
    """Packed and unpacked sizes of the frames of a bundle, from its last bytes alone."""
    with store.open_input_file(path) as file:
        end = file.size()
        number, _, magic = struct.unpack("<IBI", file.read_at(9, end - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        entries = file.read_at(8 * number, end - 9 - 8 * number)
    return list(struct.iter_unpack("<II", entries))


class _Writer:
    """Bundles of one task. Holds one open frame; finished frames go to the store at once."""

    def __init__(self, folder: str):
        self.store, self.folder = _store(folder)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.out = None
        self.open: list[tuple] = []
        self.buffer = bytearray()
        self.done: list[tuple] = []

    def add(self, name: str | None, data: bytes) -> None:
        """A record goes into the open frame if it fits, so that a long one shares its frame with none before it."""
        if self.open and len(self.buffer) + len(data) > FRAME:
            self.close_frame()
        if self.out is None:
            self.file = f"bundle-{uuid.uuid4().hex}.warc.zst"
            self.out = self.store.open_output_stream(f"{self.folder}/{self.file}", compression=None)
            self.frames, self.start = [], 0
        self.open.append((name, len(self.buffer), len(data)))
        self.buffer += data
        if len(self.buffer) >= FRAME:
            self.close_frame()
        if self.start >= BUNDLE:
            self.close()

    def close_frame(self) -> None:
        if not self.open:
            return
        packed = self.packer.compress(bytes(self.buffer))
        self.out.write(packed)
        place = (self.file, len(self.frames), self.start, len(packed), len(self.buffer))
        self.done += [(name, *place, offset, length) for name, offset, length in self.open]
        self.frames.append((len(packed), len(self.buffer)))
        self.start += len(packed)
        self.open, self.buffer = [], bytearray()

    def close(self) -> None:
        if self.out is not None:
            self.close_frame()
            self.out.write(seek_table(self.frames))
            self.out.close()
            self.out = None

    def take(self) -> pa.RecordBatch:
        rows, self.done = self.done, []
        columns = list(zip(*rows)) if rows else [[]] * 8
        types = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 5]
        names = [part.split()[0] for part in INDEX.split(", ")]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def typed(pages: DataFrame, id_col: str, url_col: str, body_col: str, least: int = 1000) -> DataFrame:
    """(id, url, payload, digest, refers_to): what each row is written as.

    Payloads are equal if their SHA-1, length and a second hash agree. Only keys of repeated payloads are joined back;
    they are written first, so that their size is known when the join is planned.
    """
    body = F.coalesce(F.col(body_col).cast("binary"), F.lit(b""))
    plain = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), body.alias("payload"))
    size = F.octet_length("payload")
    keyed = plain.withColumn("digest", F.sha1("payload")).withColumn("key", F.when(size >= least, F.struct("digest", size.alias("size"), F.xxhash64("payload").alias("more"))))
    twice = keyed.where("key IS NOT NULL").groupBy("key").agg(F.max("id").alias("last"), F.count("*").alias("n")).where("n > 1")
    found = keyed.join(cut_lineage(twice.select("key", "last")), "key", "left")
    other = F.when(F.col("last").isNotNull() & ~F.col("last").eqNullSafe(F.col("id")), F.col("last"))
    return found.select("id", "url", "payload", "digest", other.alias("refers_to"))


def write(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", least: int = 1000) -> tuple[DataFrame, str]:
    """Write one record per row into bundles under ``folder``; returns the index of the records and the folder.

    Of rows with equal payloads of at least ``least`` bytes those with the largest id are responses and the others
    revisits of it; all other rows are responses. A null payload is written as an empty one. Rows with one id, nulls
    included, each give a record; a null id is smaller than any other, and payloads that only rows with null ids have
    are all responses. Rows that repeat the largest id and its payload are all responses. A null url leaves the field
    out, control characters in urls are escaped. An empty table writes no bundle. ``folder`` must be one that all
    executors share, by default one beside the stage tables. Other columns are left behind, whatever their names.
    """
    spark = pages.sparkSession
    folder = folder or f"{stage_folder(spark)}/warc-{uuid.uuid4().hex}"
    store, path = _store(folder)
    store.create_dir(path, recursive=True)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(folder)
        for batch in tidy(batches):
            for at in range(len(batch)):  # one payload at a time, however long
                name, url, payload, digest, refers_to = (batch.column(i)[at].as_py() for i in range(5))
                writer.add(name, record(name, url, payload, digest, refers_to))
            yield writer.take()
        writer.close()
        yield writer.take()

    rows = typed(pages, id_col, url_col, body_col, least)
    texts = rows.select(F.col("id").cast("string").alias("id"), "url", "payload", "digest", F.col("refers_to").cast("string").alias("refers_to"))
    return cut_lineage(texts.mapInArrow(pack, INDEX)), folder


def _batch(rows: list[dict], payloads: bool) -> pa.RecordBatch:
    types = {"payload_bytes": pa.int64(), "payload": pa.binary()}
    names = [part.split()[0] for part in RECORD.split(", ")]
    return pa.record_batch([pa.array([r[n] if payloads or n != "payload" else None for r in rows], types.get(n, pa.string())) for n in names], names=names)


def read(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """All records of the bundles that ``index`` names, read from the bundles: their seek tables, then runs of frames.

    Without ``payloads`` that column is null, though payloads are read and held against their digests all the same. A
    revisit has no payload of its own; its size and digest are those that its head states.
    """

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(folder)
        for batch in batches:
            files, starts, sizes = [], [], []
            for name in batch.column(0).to_pylist():
                at = 0
                for packed, plain in frames_of(store, f"{path}/{name}"):
                    if not files or files[-1] != name or sum(sizes[-1]) + packed > RUN:
                        files.append(name)
                        starts.append(at)
                        sizes.append([])
                    sizes[-1].append(packed)
                    at += packed
            yield pa.record_batch([pa.array(files, pa.string()), pa.array(starts, pa.int64()), pa.array(sizes, pa.list_(pa.int64()))], names=["file", "start", "sizes"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(folder)
        unpacker = zstandard.ZstdDecompressor()
        for batch in tidy(batches):
            for run in batch.to_pylist():
                with store.open_input_file(f"{path}/{run['file']}") as file:
                    for size in run["sizes"]:
                        data = unpacker.decompress(file.read_at(size, run["start"]))
                        run["start"] += size
                        yield _batch(list(records_in(data)), payloads)

    spark = index.sparkSession
    runs = index.select("file").distinct().mapInArrow(plan, "file string, start long, sizes array<long>")
    return runs.repartition(fanout(spark)).mapInArrow(unpack, RECORD)


def fetch(index: DataFrame, folder: str, wanted: DataFrame, id_col: str = "id") -> DataFrame:
    """The records whose id is in ``wanted``: each frame that holds some is read once, by its own byte range."""
    names = wanted.select(F.col(id_col).cast("string").alias("id")).where("id IS NOT NULL").distinct()
    places = index.join(names, "id", "left_semi").repartition(fanout(index.sparkSession), "file", "frame")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(folder)
        unpacker = zstandard.ZstdDecompressor()
        held, data = None, b""
        for batch in tidy(batches):
            for row in batch.to_pylist():
                if held != (row["file"], row["frame"]):
                    held = (row["file"], row["frame"])
                    with store.open_input_file(f"{path}/{row['file']}") as file:
                        data = unpacker.decompress(file.read_at(row["frame_bytes"], row["frame_start"]))
                yield _batch(list(records_in(data, row["offset"], row["offset"] + row["length"])), True)

    return places.sortWithinPartitions("file", "frame", "offset").mapInArrow(pick, RECORD)


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", least: int = 1000, folder: str | None = None) -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to) of every row, from the archives after writing them.

    Ids come back in the type they had. What nulls, repeated rows and empty tables give is said at ``write``.
    """
    kind = dict(pages.dtypes)[id_col]
    found = read(*write(pages, folder, id_col, url_col, body_col, least), payloads=False)
    return found.select(F.col("id").cast(kind).alias("id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
