"""Token ids as binary files of compressed planes.

Texts are range-partitioned by document id, tokenised, and written one file a
partition.  A file cuts its id stream into blocks of a fixed number of ids,
transposes each block into byte or bit planes, compresses every plane with
zstandard on its own, and ends with a chunk index and a document table:

    magic | planes of chunk 0 | planes of chunk 1 | ... | footer | length | magic

The footer is two Arrow streams behind their lengths: the chunk index
(offset, n_ids, planes as compressed sizes, crc32) with width, block and kind
as metadata, and the document table (doc_id, n_tokens).  A manifest beside
the files lists those of finished tasks and the ids before each.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import released, written

MAGIC = b"IDPLANE1"
BLOCK = 1 << 16
LEVEL = 3
#: Bytes of text for one file, and for one tokenising step within a task.
FILE_BYTES, STEP_BYTES = 32 << 20, 4 << 20
#: Files whose ids are added up together.
FILE_GROUP = 1024
#: Pieces a process remembers; beyond that it starts anew.
KNOWN_PIECES = 1 << 17


# --- tokenising

class Encoder:
    """Ids of many texts with a tokenizer of the tokenizers library.

    This holds for tokenizers whose pieces never span white space (see
    ``splits_at_spaces``): the distinct white-space-free chunks of a batch
    are encoded once and their ids gathered.  Chunks of plain Latin letters,
    digits and signs are cut into pieces together, and each new piece goes
    through the tokenizer's own model; every other chunk goes through the
    whole tokenizer.  Other tokenizers encode each text as it is.
    """

    #: Composed characters that lower-case one to one, and no white space.
    PLAIN = "^[\x21-\x7E\u00A1-\u012F\u0131-\u02FF]+$"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.pieces = splits_at_spaces(spec)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = [b for b in range(256) if b not in printable]
        self.byte_chars = [chr(b) if b in printable else chr(256 + rest.index(b)) for b in range(256)]
        self._forget()

    def _forget(self) -> None:
        # Piece 0 is the line break between two chunks and has no ids.
        self.known, self.ids, self.sizes = {"\n": 0}, array("I"), array("i", [0])

    def _learn(self, pieces: set[str]) -> None:
        for piece in pieces:
            mapped = piece if piece.isascii() else "".join(self.byte_chars[b] for b in piece.encode())
            ids = [t.id for t in self.tokenizer.model.tokenize(mapped)]
            self.known[piece] = len(self.sizes)
            self.ids.extend(ids)
            self.sizes.append(len(ids))

    def _plain(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain chunks, one after the other, and their number per chunk."""
        if not chunks:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        pieces = self.pieces.findall("\n".join(chunks).lower())
        self._learn({p for p, k in zip(pieces, map(self.known.get, pieces)) if k is None})
        number = np.fromiter(map(self.known.__getitem__, pieces), np.int32, len(pieces))
        sizes = np.array(self.sizes)
        chunk = np.cumsum(number == 0)
        return gather(np.array(self.ids, np.uint32), sizes, number), np.bincount(chunk, sizes[number], len(chunks)).astype(np.int64)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts``, ``end_id`` behind each text, and their number per text."""
        texts = pc.fill_null(texts, "")
        if self.pieces is None:
            each = [e.ids + [end_id] for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.array([i for ids in each for i in ids], np.uint32), np.array([len(ids) for ids in each], np.int64)
        if len(self.known) > KNOWN_PIECES:
            self._forget()
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        chunks = coded.dictionary
        plain = pc.match_substring_regex(chunks, self.PLAIN)
        for s in self.special:
            plain = pc.and_(plain, pc.invert(pc.match_substring(chunks, s)))
        flat, sizes = self._plain(chunks.filter(plain).to_pylist())
        odd = [e.ids for e in self.tokenizer.encode_batch_fast(chunks.filter(pc.invert(plain)).to_pylist(), add_special_tokens=False)]
        flat = np.concatenate([flat, np.fromiter((i for ids in odd for i in ids), np.uint32)])
        sizes = np.concatenate([sizes, np.fromiter(map(len, odd), np.int64, len(odd))])
        # Plain chunks come first in ``flat``: renumber the words so.
        is_plain = plain.to_numpy(zero_copy_only=False)
        place = np.where(is_plain, np.cumsum(is_plain) - 1, is_plain.sum() + np.cumsum(~is_plain) - 1).astype(np.int32)
        word = place[coded.indices.to_numpy(zero_copy_only=False)]
        ids = gather(flat, sizes, word)
        offsets = words.offsets.to_numpy()
        ends = np.concatenate(([0], np.cumsum(sizes[word])))
        counts = np.diff(ends[offsets - offsets[0]])
        out = np.full(len(ids) + len(counts), end_id, np.uint32)
        is_end = np.zeros(len(out), bool)
        is_end[np.cumsum(counts + 1) - 1] = True
        out[~is_end] = ids
        return out, counts + 1


def gather(flat: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs numbered ``which`` of ``flat``, cut into runs of ``sizes``,
    joined.  Positions take 32 bits where the result is that short."""
    n = sizes[which]
    total = int(n.sum())
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    shift = (np.cumsum(sizes) - sizes)[which] - (np.cumsum(n) - n)
    at = np.repeat(shift.astype(kind), n)
    at += np.arange(total, dtype=kind)
    return flat[at]


def splits_at_spaces(spec: dict) -> regex.Pattern | None:
    """The piece pattern, line breaks being pieces too, of a tokenizer that composes (NFC), folds white space,
    lower-cases, matches pieces and maps their bytes, else None."""
    norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    steps = [n.get("type") for n in norm.get("normalizers", [])]
    cut = (pre.get("pretokenizers") or [{}])[0]
    pattern = cut.get("pattern", {}).get("Regex")
    same = (steps == ["NFC", "Replace", "Lowercase"] and [p.get("type") for p in pre.get("pretokenizers", [])] == ["Split", "ByteLevel"]
            and cut.get("invert") and cut.get("behavior") == "Removed" and norm["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
            and norm["normalizers"][1]["content"] == " " and not pre["pretokenizers"][1].get("add_prefix_space")
            and spec.get("model", {}).get("type") == "BPE" and not any(" " in t["content"] for t in spec.get("added_tokens", [])))
    return regex.compile(r"\n|" + pattern) if same and pattern and pattern.endswith(r"[^\s\p{L}\p{N}]+") else None


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per process and tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# --- planes

def to_planes(ids: np.ndarray, width: int, kind: str) -> list[bytes]:
    """Transposed block: plane p holds byte (or bit) p of every id."""
    raw = ids.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    if kind == "byte":
        return [np.ascontiguousarray(raw[:, p]).tobytes() for p in range(width)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, p]).tobytes() for p in range(8 * width)]


def from_planes(planes: list[bytes], n: int, width: int, kind: str) -> np.ndarray:
    if kind == "byte":
        raw = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p in planes], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view(f"<u{width}").reshape(-1).astype(np.uint32)


def _stream(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


class PlaneWriter:
    """Writes one file; holds one block of ids and the two footer tables."""

    def __init__(self, out, id_type: pa.DataType, width: int, kind: str, block: int = BLOCK):
        self.out, self.width, self.kind, self.block = out, width, kind, block
        self.chunks, self.docs, self.id_type = [], [], id_type
        self.rest = np.empty(0, np.uint32)
        self.at, self.n_ids, self.n_docs = len(MAGIC), 0, 0
        self.zstd = zstandard.ZstdCompressor(level=LEVEL)
        out.write(MAGIC)

    def add(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        self.docs.append(pa.table([doc_ids, pa.array(counts)], names=["doc_id", "n_tokens"]))
        self.n_docs, self.n_ids = self.n_docs + len(counts), self.n_ids + len(ids)
        ids = np.concatenate([self.rest, ids])
        full = len(ids) - len(ids) % self.block
        for k in range(0, full, self.block):
            self._chunk(ids[k:k + self.block])
        self.rest = ids[full:].copy()

    def _chunk(self, ids: np.ndarray) -> None:
        planes = [self.zstd.compress(p) for p in to_planes(ids, self.width, self.kind)]
        self.chunks.append((self.at, len(ids), [len(p) for p in planes], zlib.crc32(ids.astype("<u4").tobytes())))
        for p in planes:
            self.out.write(p)
            self.at += len(p)

    def close(self) -> None:
        if len(self.rest):
            self._chunk(self.rest)
        schema = pa.schema([("offset", pa.int64()), ("n_ids", pa.int64()), ("planes", pa.list_(pa.int32())), ("crc32", pa.int64())],
                           metadata={"width": str(self.width), "block": str(self.block), "kind": self.kind})
        index = pa.table([pa.array(c, f.type) for c, f in zip(zip(*self.chunks) if self.chunks else [[]] * 4, schema)], schema=schema)
        docs = pa.concat_tables(self.docs) if self.docs else pa.table([pa.array([], self.id_type), pa.array([], pa.int64())], names=["doc_id", "n_tokens"])
        footer = b"".join(struct.pack("<q", len(s)) + s for s in (_stream(index), _stream(docs)))
        self.out.write(footer + struct.pack("<q", len(footer)) + MAGIC)
        self.out.close()


class PlaneReader:
    """Random access to the ids of one file."""

    def __init__(self, source: bytes | pa.NativeFile):
        """``source``: the bytes of a file, or a file open for random access, of
        which the footer and then only the chunks asked for are read."""
        self.file = pa.BufferReader(source) if isinstance(source, (bytes, memoryview)) else source
        end = self.file.size()
        tail = self.file.read_at(16, end - 16) if end >= 24 else b""
        if tail[8:] != MAGIC or self.file.read_at(8, 0) != MAGIC:
            raise ValueError("not a token file, or a cut one")
        size, = struct.unpack("<q", tail[:8])
        footer, tables = memoryview(self.file.read_at(size, end - 16 - size)), []
        while len(footer):
            n, = struct.unpack("<q", footer[:8])
            tables.append(pa.ipc.open_stream(pa.py_buffer(footer[8:8 + n])).read_all())
            footer = footer[8 + n:]
        self.index, self.docs = tables
        meta = {k.decode(): v.decode() for k, v in self.index.schema.metadata.items()}
        self.width, self.block, self.kind = int(meta["width"]), int(meta["block"]), meta["kind"]
        self.chunks = self.index.to_pylist()
        self.zstd = zstandard.ZstdDecompressor()

    def chunk(self, k: int) -> np.ndarray:
        c, planes, at = self.chunks[k], [], 0
        raw = memoryview(self.file.read_at(sum(c["planes"]), c["offset"]))
        for n in c["planes"]:
            planes.append(self.zstd.decompress(raw[at:at + n]))
            at += n
        ids = from_planes(planes, c["n_ids"], self.width, self.kind)
        if zlib.crc32(ids.astype("<u4").tobytes()) != c["crc32"]:
            raise ValueError(f"chunk {k} is damaged")
        return ids

    def ids(self, start: int, n: int) -> np.ndarray:
        """n ids from number ``start`` on; only the chunks they lie in are read."""
        if not n:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (start + n - 1) // self.block
        joined = np.concatenate([self.chunk(k) for k in range(first, last + 1)])
        return joined[start - first * self.block:][:n]


# --- Spark

def _steps(batch: pa.RecordBatch, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        base = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, base + limit, "right")))
        yield batch.slice(start, end - start)
        start = end


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 kind: str = "byte", block: int = BLOCK, file_bytes: int = FILE_BYTES) -> None:
    """Write the ids of every row of ``docs``, ``end_id`` behind each, in
    ascending id order (NULL ids first, equal ids by a hash of the text).

    A task writes its file under a name of its own attempt and reports it
    when it is complete, so a lost or repeated attempt leaves nothing that
    the manifest lists.  The manifest has one row per file.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    total = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text").asc()]
    parts = d.repartitionByRange(max(1, -(-total // file_bytes)), *order).sortWithinPartitions(*order)
    id_type = d.schema["id"].dataType

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, task = None, TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.ids"
        for batch in batches:
            for step in _steps(batch):
                if writer is None:
                    enc = encoder(tokenizer_path)
                    width = 2 if max(enc.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
                    fs, folder = pafs.FileSystem.from_uri(path)
                    fs.create_dir(folder)
                    writer = PlaneWriter(fs.open_output_stream(f"{folder}/{name}"), batch.column(0).type, width, kind, block)
                writer.add(step.column(0), *enc.encode(step.column(1), end_id))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": [task.partitionId()], "file": [name], "docs": [writer.n_docs], "ids": [writer.n_ids]})

    # Committed tasks only: one short row per file, which the driver never holds.
    files = written(parts.mapInArrow(released(write), "part bigint, file string, docs bigint, ids bigint"), "token-files")
    files = files.withColumn("group", F.expr(f"part div {FILE_GROUP}"))
    groups = files.groupBy("group").agg(F.sum("ids").alias("n"))
    earlier = (Window.unboundedPreceding, -1)
    groups = groups.select(F.col("group").alias("g"), F.coalesce(F.sum("n").over(Window.orderBy("group").rowsBetween(*earlier)), F.lit(0)).alias("group_before"))
    own = F.coalesce(F.sum("ids").over(Window.partitionBy("group").orderBy("part").rowsBetween(*earlier)), F.lit(0))
    listed = files.withColumn("own", own).join(groups, F.col("group") == F.col("g"))
    listed = listed.select("part", "file", "docs", "ids", (F.col("group_before") + F.col("own")).alias("ids_before"))
    empty = spark.createDataFrame([(None, None, 0, 0, 0)], "part bigint, file string, docs bigint, ids bigint, ids_before bigint")
    listed.unionByName(empty).withColumn("id_type", F.lit(id_type.simpleString())).write.parquet(f"{path}/_manifest")


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Per written document: doc_id, ``start`` (ids of all documents before
    it), ``n_tokens``, ``ids_crc32`` of its ids as little-endian 32-bit
    integers, and the ``ids``.

    Tasks get rows of the manifest, one file each, and open the files
    themselves: footer first, then chunk by chunk.  An empty text has its end
    id alone; repeated rows are documents of their own, side by side; NULL ids
    come first; files of an empty table give no rows.
    """
    manifest = spark.read.parquet(f"{path}/_manifest")
    id_type = manifest.select("id_type").first()[0]
    listed = manifest.filter("file IS NOT NULL").select("part", "file", "ids_before")
    schema = f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for name, before in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                with fs.open_input_file(f"{folder}/{name}") as file:
                    yield from _documents(PlaneReader(file), before, with_ids)

    n = listed.count()
    # Only the manifest is dealt out, file by file.
    return listed.repartitionByRange(max(1, n), "part").mapInArrow(released(read), schema)


def _documents(r: PlaneReader, before: int, with_ids: bool, group: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The documents of a file, about ``group`` ids at a time."""
    n = r.docs["n_tokens"].to_numpy()
    start = np.cumsum(n) - n
    doc_ids = r.docs["doc_id"].combine_chunks()
    k = 0
    while k < len(n):
        to = max(k + 1, int(np.searchsorted(start + n, start[k] + group, "right")))
        ids = r.ids(int(start[k]), int(start[to - 1] + n[to - 1] - start[k])).astype("<u4")
        raw, cut = memoryview(ids.tobytes()), ((start[k:to] - start[k]) * 4).tolist() + [4 * len(ids)]
        columns = [doc_ids.slice(k, to - k), pa.array(start[k:to] + before), pa.array(n[k:to]),
                   pa.array([zlib.crc32(raw[a:b]) for a, b in zip(cut, cut[1:])], pa.int64())]
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        if with_ids:
            columns.append(pa.ListArray.from_arrays(pa.array(np.array(cut) // 4, pa.int32()), pa.array(ids.astype(np.int64))))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names=names)
        k = to
