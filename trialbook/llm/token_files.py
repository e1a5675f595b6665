"""Token ids in files of independent zstandard frames with a trailing seek table.

A file is a run of frames, one per document (a document beyond ``FRAME_BYTES`` of ids takes several in a row), each
with a content checksum of its own; then a skippable frame with the documents' ids and numbers of tokens; then the
seek table of the public seekable format as a last skippable frame: compressed size, size and checksum of every
frame, the number of frames and a magic number. Any zstandard reader can decompress such a file as a whole, and a
reader that wants some documents reads the two tables from the end, seeks, and decompresses their frames only.

``write`` deals whole texts to ordered slices by document id; every task encodes its slice as it streams through and
writes files of about ``FILE_BYTES``, so memory holds one batch and the tables of one file. A task names its files
after itself and its attempt, and lists them in a manifest that Spark writes as Parquet: files of attempts that were
lost or run twice are in no manifest, so they are never read. ``index`` reads the tables of all files, ``fetch`` the
documents asked for. Files lie where every executor can open them: a path, ``file:`` or another scheme of
``pyarrow.fs``.

Nulls and edges: a null text is empty and has its end id only; a null doc_id comes first; rows of one doc_id follow
by the hash of their text, and equal rows are written each; texts of any length are encoded whole; an empty table
gives a manifest without rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import functools
import json
import os
import struct
import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trialbook.llm import query
from trialbook.llm.packing import encoder
from trialbook.llm.tasks import remote
from trialbook.llm.text import table, whole
from trialbook.session import new_path, shared_folder

# Fixed values of the seekable format: magic numbers of its table and of skippable frames, and the flag for checksums.
SEEKABLE, TABLE_FRAME, OWN_FRAME, CHECKSUMS = 0x8F92EAB1, 0x184D2A5E, 0x184D2A5D, 0x80
OWN_MAGIC = b"ids1"
FILE_BYTES, FRAME_BYTES, READ_BYTES = 128 << 20, 64 << 20, 8 << 20
MANIFEST = "part int, number int, file string, docs long, tokens long, first_id long, last_id long"
PLACES = "file string, position long, doc_id long, n_tokens long, at long, sizes array<long>, checksums array<long>, width int"


def vocabulary(name: str) -> str:
    """The place of a vocabulary file on this machine: a path as it is, else a name among the public tokenizers."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=4)
def id_width(path: str) -> int:
    """Bytes that hold every id of a vocabulary."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    most = max([*file["model"]["vocab"].values(), *[a["id"] for a in file.get("added_tokens") or []], 0])
    return 2 if most < 1 << 16 else 4


def _store(uri: str):
    """The file system of a path or URI, and the path within it."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def _checksum(content: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(content) & 0xFFFFFFFF


def _skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


class FrameFile:
    """Writes one file of documents."""

    def __init__(self, stream, width: int, level: int = 3, frame_bytes: int = FRAME_BYTES):
        import zstandard

        self.stream, self.width, self.frame_bytes = stream, width, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[int | None] = []
        self.tokens: list[int] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        content = ids.astype(f"<u{self.width}").tobytes()
        for start in range(0, len(content), self.frame_bytes) if content else [0]:
            part = content[start : start + self.frame_bytes]
            frame = self.compressor.compress(part)
            self.frames.append((len(frame), len(part), _checksum(part)))
            self.stream.write(frame)
            self.size += len(frame)
        self.docs.append(doc_id)
        self.tokens.append(len(ids))

    def close(self) -> None:
        known = np.array([d is not None for d in self.docs], dtype="u1")
        own = _skippable(OWN_FRAME, OWN_MAGIC + struct.pack("<IQQ", self.width, self.frame_bytes, len(self.docs))
                         + np.array([d or 0 for d in self.docs], dtype="<i8").tobytes() + known.tobytes() + np.array(self.tokens, dtype="<u8").tobytes())
        entries = [*self.frames, (len(own), 0, _checksum(b""))]
        footer = struct.pack("<IBI", len(entries), CHECKSUMS, SEEKABLE)
        self.stream.write(own)
        self.stream.write(_skippable(TABLE_FRAME, np.array(entries, dtype="<u4").tobytes() + footer))
        self.stream.close()


def encode(batches: Iterator[pa.RecordBatch], folder: str, name: str, end_id: int | None, file_bytes: int, frame_bytes: int) -> Iterator[pa.RecordBatch]:
    """Writes the batches of (doc_id, text) of one slice, in their order; a manifest row per file."""
    from pyspark import TaskContext

    path = vocabulary(name)
    tokens_of, width = encoder(path), id_width(path)
    end = np.array([] if end_id is None else [end_id], dtype="<u4")
    store, place = _store(folder)
    store.create_dir(place, recursive=True)
    part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
    rows: list[tuple] = []
    out: FrameFile | None = None

    def finished(f: FrameFile) -> tuple:
        f.close()
        return part, len(rows), f"part-{part:06d}-{len(rows):04d}-{attempt}.ids.zst", len(f.docs), sum(f.tokens), f.docs[0], f.docs[-1]

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if out is None:
                out = FrameFile(store.open_output_stream(f"{place}/part-{part:06d}-{len(rows):04d}-{attempt}.ids.zst", compression=None), width, frame_bytes=frame_bytes)
            out.add(doc_id, np.concatenate([tokens_of(text.as_py()), end]))
            if out.size >= file_bytes:
                rows.append(finished(out))
                out = None
    if out is not None:
        rows.append(finished(out))
    if rows:
        types = [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 4]
        names = ["part", "number", "file", "docs", "tokens", "first_id", "last_id"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def write(
    docs: DataFrame, folder: str, vocabulary_name: str, doc_id: str = "doc_id", text: str = "text", end_id: int | None = 0,
    file_bytes: int = FILE_BYTES, frame_bytes: int = FRAME_BYTES,
) -> None:
    """Write the ids of all ``docs`` in ascending order of ``doc_id`` to files below ``folder``, with their manifest.

    ``vocabulary_name`` is a file of the tokenizers library, by path or by its name among the public tokenizers.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    # The row number only parts rows that are equal, however many there are.
    order = ["doc_id", F.xxhash64("text"), F.monotonically_increasing_id()]
    dealt = rows.select("*", *[c.alias(f"o{i}") for i, c in enumerate(order[1:])])
    by = ["doc_id", "o0", "o1"]
    sliced = dealt.repartitionByRange(*by).sortWithinPartitions(*by).select("doc_id", "text")
    manifest = sliced.mapInArrow(remote(encode, f"{folder}/data", vocabulary_name, end_id, file_bytes, frame_bytes), MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """A row per file, with ``start``, the ids in all files before it. Its window runs over files, not over rows of data."""
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def tables_of(stream, size: int) -> tuple[np.ndarray, int, int, list[int | None], np.ndarray]:
    """Frames (compressed size, size, checksum), id width, frame limit, document ids and tokens of an open file."""
    stream.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", stream.read(9))
    if magic != SEEKABLE or flags != CHECKSUMS:
        raise ValueError("not a file of seekable frames")
    stream.seek(size - 9 - 12 * n)
    entries = np.frombuffer(stream.read(12 * n), dtype="<u4").reshape(n, 3).astype("int64")
    own = int(entries[-1, 0])
    stream.seek(size - 9 - 12 * n - 8 - own)
    content = stream.read(own)[8:]
    if content[:4] != OWN_MAGIC:
        raise ValueError("no table of documents")
    width, limit, docs = struct.unpack("<IQQ", content[4:24])
    ids = np.frombuffer(content, "<i8", docs, 24).tolist()
    known = np.frombuffer(content, "u1", docs, 24 + 8 * docs)
    tokens = np.frombuffer(content, "<u8", docs, 24 + 9 * docs).astype("int64")
    return entries[:-1], width, limit, [i if k else None for i, k in zip(ids, known, strict=True)], tokens


def places(batches: Iterator[pa.RecordBatch], folder: str, only: tuple[int, ...] | None) -> Iterator[pa.RecordBatch]:
    """For batches of (file, start): where each document of the files lies, in order."""
    store, place = _store(folder)
    wanted = None if only is None else set(only)
    schema = pa.schema([("file", pa.string()), ("position", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("at", pa.int64()),
                        ("sizes", pa.list_(pa.int64())), ("checksums", pa.list_(pa.int64())), ("width", pa.int32())])
    for batch in batches:
        for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            with store.open_input_file(f"{place}/{file}") as stream:
                frames, width, limit, docs, tokens = tables_of(stream, stream.size())
            count = np.maximum(1, -(-tokens * width // limit))
            first = np.cumsum(count) - count
            position, at = start + np.cumsum(tokens) - tokens, np.cumsum(frames[:, 0]) - frames[:, 0]
            chosen = range(len(docs)) if wanted is None else [k for k, d in enumerate(docs) if d in wanted]
            for low in range(0, len(chosen), 10_000):
                some = chosen[low : low + 10_000]
                runs = [frames[first[k] : first[k] + count[k]] for k in some]
                yield pa.RecordBatch.from_pylist([
                    {"file": file, "position": int(position[k]), "doc_id": docs[k], "n_tokens": int(tokens[k]), "at": int(at[first[k]]),
                     "sizes": run[:, 0].tolist(), "checksums": run[:, 2].tolist(), "width": width} for k, run in zip(some, runs, strict=True)], schema)


def index(spark: SparkSession, folder: str, only: Sequence[int] | None = None) -> DataFrame:
    """A row per document: where its frames lie (``PLACES``). ``position`` counts the ids of all documents before it.

    ``only``, a short list of document ids, leaves out files that cannot hold them and all other documents; a longer
    choice is a join with the index.
    """
    files = manifest(spark, folder)
    if only is not None:
        ids = F.array(*[F.lit(int(i)) for i in only]).cast("array<long>")
        files = files.filter(F.exists(ids, lambda i: (i >= F.coalesce("first_id", F.lit(-(2**63)))) & (i <= F.col("last_id"))))
    each = max(1, files.count())  # of files, so that every one can be read on its own
    return files.select("file", "start").repartition(each).mapInArrow(remote(places, f"{folder}/data", None if only is None else tuple(map(int, only))), PLACES)


def _content(frames: Iterable[bytes], checksums: Iterable[int], width: int) -> bytes:
    """The ids of a document's frames as unsigned 32-bit integers; an error if a checksum differs."""
    import zstandard

    reader, parts = zstandard.ZstdDecompressor(), []
    for frame, checksum in zip(frames, checksums, strict=True):
        part = reader.decompress(frame)  # compares the frame's own checksum
        if _checksum(part) != checksum:
            raise ValueError("a frame differs from its checksum in the seek table")
        parts.append(part)
    return np.frombuffer(b"".join(parts), dtype=f"<u{width}").astype("<u4").tobytes()


def read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """The documents at the given places, with neighbours of one file read together."""
    store, place = _store(folder)
    opened: tuple = (None, None)
    for batch in batches:
        rows, columns = batch.to_pylist(), ([], [], [], [])
        low = 0
        while low < len(rows):
            end, high = rows[low]["at"] + sum(rows[low]["sizes"]), low + 1
            while high < len(rows) and rows[high]["file"] == rows[low]["file"] and rows[high]["at"] == end and end - rows[low]["at"] < READ_BYTES:
                end += sum(rows[high]["sizes"])
                high += 1
            if opened[0] != rows[low]["file"]:
                if opened[1] is not None:
                    opened[1].close()
                opened = (rows[low]["file"], store.open_input_file(f"{place}/{rows[low]['file']}"))
            opened[1].seek(rows[low]["at"])
            block, at = memoryview(opened[1].read(end - rows[low]["at"])), 0
            for row in rows[low:high]:
                ends = at + np.cumsum(row["sizes"])
                frames = [block[e - s : e] for s, e in zip(row["sizes"], ends.tolist(), strict=True)]
                at = int(ends[-1])
                for column, value in zip(columns, (row["doc_id"], row["position"], row["n_tokens"], _content(frames, row["checksums"], row["width"])), strict=True):
                    column.append(value)
            low = high
            if sum(map(len, columns[3])) >= READ_BYTES:
                yield _batch(columns)
                columns = ([], [], [], [])
        yield _batch(columns)


def _batch(columns: tuple[list, ...]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "start", "n_tokens", "ids"])


def fetch(chosen: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the documents of an index, or of the rows of it that were chosen.

    ``ids`` holds unsigned little-endian 32-bit integers. Only the frames of the chosen documents are decompressed.
    """
    return chosen.select("file", "position", "doc_id", "n_tokens", "at", "sizes", "checksums", "width").mapInArrow(
        remote(read, f"{folder}/data"), "doc_id long, start long, n_tokens long, ids binary")


@query("op11_token_files")
def _(spark, folder):
    shared_folder(spark)
    out = new_path(spark, "token-files")
    write(table(spark, folder, "documents"), out, "byte_bpe_50k.json")
    return fetch(index(spark, out), out).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
