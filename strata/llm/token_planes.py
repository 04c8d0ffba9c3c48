"""Token ids in binary files: bit-plane shuffled blocks with a chunk index.

A file holds the ids of consecutive documents, end id included, in ascending
``doc_id`` order (equal ids by text). Ids are cut into blocks of a fixed
number. A block is transposed into planes: plane k of a bit file holds bit k
of every id (eight ids a byte), plane k of a byte file holds byte k. Planes
above the block's largest id are left out, and each plane is compressed by
zstandard on its own. All integers are little-endian.

    magic "IDPL", version u8, planes per id byte u8 (8: bits, 1: bytes), ids per block u32
    compressed planes, block after block
    index, compressed: n_blocks u64, n_docs u64; per block: offset u64, ids u32, planes u32;
        per plane: bytes u32; per document: id i64 (null: smallest i64), ids u64
    index offset u64, index bytes u64, magic "IDPL"

So a reader seeks to any block without reading those before it.

Files are written by the tasks straight to the shared folder under names that
no other attempt uses; only files that a finished task reports count, so a
lost executor leaves at most an unlisted file.

Cases: a null text counts as empty and gives the end id alone; repeated rows
are written each; extra columns are ignored; an empty table gives no file and
an empty result.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.tables import doc_texts
from strata.llm.text import IN_WORD, UnitCache, column_bytes, slices

MAGIC, VERSION = b"IDPL", 1
#: Ids of one block. A multiple of 8.
BLOCK_IDS = 1 << 16
# Fixed value: the pattern by which byte-level BPE cuts a text into words.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NULL_ID = -(1 << 63)
#: Characters of a text that part the rows of one id into ranges.
RANGE_CHARS = 64
#: White space beyond the six ASCII separators; a text that holds any is encoded whole.
OTHER_SPACE = r"[\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
MANIFEST = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("first_doc", T.LongType()),
    T.StructField("n_docs", T.LongType()),
    T.StructField("n_ids", T.LongType()),
])
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("start", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
])


# ---------------------------------------------------------------- planes

def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The planes of one block of unsigned 32-bit ids, lowest first."""
    top = int(ids.max()).bit_length() if len(ids) else 0
    if not bits:
        octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
        return [octets[:, k].tobytes() for k in range((top + 7) // 8)]
    full = np.zeros(-(-len(ids) // 8) * 8, "<u4")
    full[: len(ids)] = ids
    octets = full.view(np.uint8).reshape(-1, 4)
    planes = []
    for k in range(top):
        planes.append(np.packbits(octets[:, k >> 3] & np.uint8(1 << (k & 7))).tobytes())
    return planes


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    """The ids of a block, given its planes."""
    ids = np.zeros(n, np.uint32)
    for k, plane in enumerate(planes):
        raw = np.frombuffer(plane, np.uint8)
        if bits:
            ids |= np.unpackbits(raw, count=n).astype(np.uint32) << np.uint32(k)
        else:
            ids |= raw.astype(np.uint32) << np.uint32(8 * k)
    return ids


# ---------------------------------------------------------------- files

def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a folder's URI (file, hdfs, s3, gs) and the path in it."""
    return pafs.FileSystem.from_uri(uri) if re.match(r"\w+:", uri) else (pafs.LocalFileSystem(), uri)


class PlaneWriter:
    """Writes one file; ``add`` takes whole documents in order."""

    def __init__(self, stream, bits: bool, level: int):
        self.stream, self.bits = stream, bits
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.stream.write(MAGIC + struct.pack("<BBI", VERSION, 8 if bits else 1, BLOCK_IDS))
        self.at, self.blocks, self.waiting, self.held, self.n_ids = 10, [], [], 0, 0
        self.docs: list[np.ndarray] = []

    def add(self, doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(np.stack([doc_ids.astype("<i8"), counts.astype("<i8")], axis=1))
        self.waiting.append(ids)
        self.held += len(ids)
        self.n_ids += len(ids)
        if self.held >= BLOCK_IDS:
            ids = np.concatenate(self.waiting)
            whole = len(ids) // BLOCK_IDS * BLOCK_IDS
            for k in range(0, whole, BLOCK_IDS):
                self._block(ids[k : k + BLOCK_IDS])
            self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def _block(self, ids: np.ndarray) -> None:
        planes = [self.zstd.compress(p) for p in to_planes(ids, self.bits)]
        self.blocks.append((self.at, len(ids), [len(p) for p in planes]))
        for p in planes:
            self.stream.write(p)
            self.at += len(p)

    def close(self) -> None:
        if self.held:
            self._block(np.concatenate(self.waiting))
        docs = np.concatenate(self.docs) if self.docs else np.zeros((0, 2), "<i8")
        index = struct.pack("<QQ", len(self.blocks), len(docs))
        index += b"".join(struct.pack(f"<QII{len(sizes)}I", at, n, len(sizes), *sizes) for at, n, sizes in self.blocks)
        index = self.zstd.compress(index + docs.astype("<i8").tobytes())
        self.stream.write(index + struct.pack("<QQ", self.at, len(index)) + MAGIC)


class PlaneReader:
    """Reads a file's index; then any block, or the documents in order."""

    def __init__(self, source):
        self.source = source
        self.zstd = zstandard.ZstdDecompressor()
        head = source.read_at(10, 0)
        size = source.size()
        at, length = struct.unpack("<QQ", source.read_at(20, size - 20)[:16])
        if head[:4] != MAGIC or source.read_at(4, size - 4) != MAGIC:
            raise ValueError("not a token plane file")
        self.bits = head[5] == 8
        index = self.zstd.decompress(source.read_at(length, at))
        n_blocks, n_docs = struct.unpack_from("<QQ", index)
        place, self.blocks = 16, []
        for _ in range(n_blocks):
            at, n, planes = struct.unpack_from("<QII", index, place)
            self.blocks.append((at, n, struct.unpack_from(f"<{planes}I", index, place + 16)))
            place += 16 + 4 * planes
        docs = np.frombuffer(index, "<i8", 2 * n_docs, place).reshape(-1, 2)
        self.doc_ids, self.counts = docs[:, 0], docs[:, 1]

    def block(self, k: int) -> np.ndarray:
        at, n, sizes = self.blocks[k]
        raw = self.source.read_at(sum(sizes), at)
        planes, place = [], 0
        for s in sizes:
            planes.append(self.zstd.decompress(raw[place : place + s]))
            place += s
        return from_planes(planes, n, self.bits)

    def documents(self) -> Iterator[np.ndarray]:
        """The ids of each document, in order."""
        k, ids, at = 0, np.zeros(0, np.uint32), 0
        for count in self.counts.tolist():
            parts = []
            while count > len(ids) - at:
                parts.append(ids[at:])
                count -= len(ids) - at
                ids, at, k = self.block(k), 0, k + 1
            parts.append(ids[at : at + count])
            at += count
            yield parts[0] if len(parts) == 1 else np.concatenate(parts)


# ---------------------------------------------------------------- encoding

def byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: printable Latin-1 as it is, the others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (chr(0x100 + k) for k in range(256))
    return {b: chr(b) if b in printable else next(others) for b in range(256)}


class Encoder:
    """Ids as the tokenizers library gives them, without special tokens added.

    A byte-level BPE that cuts texts by its usual pattern treats each run of
    white space with the word after it by itself, so such units are encoded
    once and kept for a while. Other tokenizers encode whole texts.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"] or {}, spec["model"]
        added = spec["added_tokens"]
        self.added = [a["content"] for a in added]
        self.by_unit = (
            not spec["normalizer"] and not spec["truncation"] and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
            and pre.get("use_regex", True) and model["type"] == "BPE" and not model.get("dropout")
            and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or re.search(r"\s", a["content"]) for a in added)
        )
        self.words, self.letters = regex.compile(WORD_PATTERN).findall, byte_letters()
        self.cache = UnitCache(self._units)

    def _units(self, units: list[bytes]) -> list[list[int]]:
        texts = [u.decode() for u in units]
        # Units that begin with white space and end in a word can be cut together:
        # the pattern never lets a match run on into the next unit's white space.
        joined = [t[0].isspace() and not t[-1].isspace() for t in texts]
        pieces = self.words("".join([t for t, j in zip(texts, joined) if j]))
        known = {w: self._bpe(w) for w in set(pieces)}
        left, out = iter(pieces), []
        for t, j in zip(texts, joined):
            if any(a in t for a in self.added):
                out.append(self.whole(t))
                while j and t:
                    t = t[len(next(left)) :]
            elif j:
                w = next(left)
                ids, rest = known[w], len(t) - len(w)
                while rest:
                    w = next(left)
                    ids, rest = ids + known[w], rest - len(w)
                out.append(ids)
            else:
                out.append([i for w in self.words(t) for i in self._bpe(w)])
        return out

    def _bpe(self, word: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(word.encode().decode("latin-1").translate(self.letters))]

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode_column(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Row ranges with the ids of their texts and the number of ids of each."""
        texts = pc.fill_null(texts, "")
        data, offsets = column_bytes(texts)
        odd = np.flatnonzero(pc.match_substring_regex(texts, OTHER_SPACE).to_numpy(zero_copy_only=False)) if self.by_unit else np.arange(len(texts))
        for lo, hi in slices(offsets):
            part, off = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            inside = IN_WORD[part]
            first = ~inside
            first[1:] &= inside[:-1]
            first[off[:-1][off[:-1] < len(part)]] = True
            start = np.flatnonzero(first)
            own = odd[(odd >= lo) & (odd < hi)] - lo
            if len(own):  # their units are left out
                start = start[~np.isin(np.searchsorted(off, start, "right") - 1, own)]
            end = np.append(start[1:], len(part))
            if len(own):
                end = np.minimum(end, off[np.searchsorted(off, start, "right")])
            ids, counts = self.cache.lookup(part, start, end)
            upto = np.append(0, np.cumsum(counts))[np.searchsorted(start, off)]
            if len(own):
                whole = {int(k): np.array(self.whole(texts[lo + int(k)].as_py()), np.int32) for k in own}
                lists = [whole.get(k, ids[upto[k] : upto[k + 1]]) for k in range(hi - lo)]
                yield lo, hi, np.concatenate(lists), np.array([len(x) for x in lists], np.int64)
            else:
                yield lo, hi, ids, np.diff(upto)


@lru_cache(maxsize=2)
def _encoder(tokenizer_file: str) -> Encoder:
    return Encoder(tokenizer_file)


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(ids, np.cumsum(counts), end_id).astype(np.uint32), counts + 1


# ---------------------------------------------------------------- jobs

def write_token_files(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int, bits: bool = True, level: int = 1) -> DataFrame:
    """Encode all texts and write them to ``folder`` in ascending ``doc_id`` order.

    Returns the manifest, one row per file in order: ``path``, ``first_doc``,
    ``n_docs``, ``n_ids`` and ``start``, the ids in all files before it. The
    texts are dealt by ranges of ``doc_id`` and the first ``RANGE_CHARS``
    characters, so each task writes one file of a contiguous range, and rows of
    one id, or without one, spread over tasks. Rows of an id are in the order of
    their texts.
    """

    def run(batches):
        writer = name = first = None
        n_docs = 0
        store, path = open_folder(folder)
        for batch in batches:
            keys = pc.fill_null(batch.column(0), NULL_ID).to_numpy()
            for lo, hi, ids, counts in _encoder(tokenizer_file).encode_column(batch.column(1)):
                if writer is None:
                    store.create_dir(path, recursive=True)
                    name, first = f"ids-{TaskContext.get().partitionId():08d}-{uuid.uuid4().hex}.idp", int(keys[lo])
                    stream = store.open_output_stream(f"{path}/{name}")
                    writer = PlaneWriter(stream, bits, level)
                ids, counts = with_end(ids, counts, end_id)
                writer.add(keys[lo:hi], counts, ids)
                n_docs += hi - lo
        if writer is not None:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{name}"]), pa.array([first], pa.int64()), pa.array([n_docs], pa.int64()), pa.array([writer.n_ids], pa.int64())],
                names=MANIFEST.names,
            )

    ranged = doc_texts(docs).repartitionByRange("doc_id", F.substring("text", 1, RANGE_CHARS)).sortWithinPartitions("doc_id", "text")
    # One row per file; their ranges are disjoint, so the first document gives the order, and among files that begin with one id the task's number.
    files = sorted(ranged.mapInArrow(run, MANIFEST).collect(), key=lambda r: (r.first_doc, r.path))
    rows, start = [], 0
    for r in files:
        rows.append((*r, start))
        start += r.n_ids
    return docs.sparkSession.createDataFrame(rows, T.StructType([*MANIFEST.fields, T.StructField("start", T.LongType())]))


def read_token_files(manifest: DataFrame, n_files: int) -> DataFrame:
    """Read the files back: per document ``doc_id``, ``start`` (ids of all documents
    before it), ``n_tokens`` and ``ids_crc32`` of its ids as little-endian unsigned 32-bit integers."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                store, path = open_folder(row["path"])
                with store.open_input_file(path) as source:
                    reader = PlaneReader(source)
                    crcs = np.fromiter((zlib.crc32(ids.astype("<u4").tobytes()) for ids in reader.documents()), np.int64, len(reader.counts))
                starts = row["start"] + np.cumsum(reader.counts) - reader.counts
                keys = pa.array(reader.doc_ids, pa.int64(), mask=reader.doc_ids == NULL_ID)
                yield pa.RecordBatch.from_arrays([keys, pa.array(starts), pa.array(reader.counts), pa.array(crcs)], names=DOCS.names)

    return manifest.select("path", "start").repartition(max(1, n_files)).mapInArrow(run, DOCS)


def token_file_digests(spark: SparkSession, docs: DataFrame, folder: str, tokenizer_file: str, end_id: int, bits: bool = True) -> DataFrame:
    """Write all documents' ids to files, then read the files back."""
    manifest = write_token_files(docs, folder, tokenizer_file, end_id, bits)
    return read_token_files(manifest, manifest.count())
