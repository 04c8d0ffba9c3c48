"""SentencePiece encoding with source offsets, and decoding.

Normalisation follows the model's compiled character map: at each place the
longest prefix that the map's trie knows is replaced by the map's text, and
every byte of the normalised text remembers the source byte it came from.
The pieces of the encoding partition the normalised text, so each piece is
projected to the byte range of the source text that it stands for.

Two paths give the same ids as the library:

* A model whose pieces never hold a space mark after another character, with
  an identity character map and a dummy prefix, cannot merge across the start
  of a run of spaces. Its texts are cut there, and each distinct unit is
  encoded by the library once per worker while it stays in a bounded cache.
* Any other model encodes whole texts.

Cases: a null text counts as empty; an empty text has no ids, no spans and
decodes to the empty text; repeated rows are encoded alike; columns beyond
``doc_id`` and ``text`` are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strata.llm.tables import doc_texts
from strata.llm.text import UnitCache, column_bytes, slices

SPACE_MARK = "▁"
#: What an encoded text can give.
COLUMNS = {
    "ids": T.ArrayType(T.IntegerType()),
    "begins": T.ArrayType(T.LongType()),
    "ends": T.ArrayType(T.LongType()),
    "decoded": T.StringType(),
    "n_tokens": T.LongType(),
    "ids_sha256": T.StringType(),
    "decoded_sha256": T.StringType(),
    "covered_bytes": T.LongType(),
}
OFFSETS = ("ids", "begins", "ends", "decoded")
DIGESTS = ("n_tokens", "ids_sha256", "decoded_sha256", "covered_bytes")
#: Ids that a worker holds before it sends them on.
SEND_IDS = 200_000
#: Distinct units that a worker keeps.
UNITS = 600_000


class CharacterMap:
    """A compiled character map: a double-array trie over UTF-8 prefixes and a pool of replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist() if blob else []
        self.pool = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest known prefix of ``text[at:]`` and its replacement."""
        units, found = self.units, None
        unit = units[0]
        node = (unit >> 10) << ((unit & 512) >> 6)
        for k in range(at, len(text)):
            node ^= text[k]
            unit = units[node]
            if unit & 0x800000FF != text[k]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                place = units[node] & 0x7FFFFFFF
                found = k + 1 - at, self.pool[place : self.pool.index(b"\0", place)]
        return found


def _character(lead: int) -> int:
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


def normalise(text: str, charmap: CharacterMap, add_dummy_prefix: bool, remove_extra_whitespaces: bool) -> tuple[bytes, np.ndarray]:
    """Normalised bytes and, for each and for the end, the source byte it came from.

    Spaces become the space mark. With ``remove_extra_whitespaces`` runs of
    spaces become one and none stay at either end. The dummy prefix belongs to
    the first source byte that is kept.
    """
    raw = text.encode()
    parts: list[tuple[bytes, int, int]] = []
    at = 0
    while at < len(raw):
        hit = charmap.longest(raw, at) if charmap.units else None
        size, new = hit if hit else (_character(raw[at]), raw[at : at + _character(raw[at])])
        parts.append((new, at, at + size))
        at += size
    out, align = bytearray(), []
    mark = SPACE_MARK.encode()
    lead = 0
    if remove_extra_whitespaces:
        while lead < len(parts) and not parts[lead][0].strip(b" "):
            lead += 1
    if lead == len(parts):
        return b"", np.zeros(1, np.int64)
    end = parts[lead][1]
    if add_dummy_prefix:
        out += mark
        align += [end] * len(mark)
    spaced = remove_extra_whitespaces
    for new, a, b in parts[lead:]:
        while spaced and new.startswith(b" "):
            new = new[1:]
        if new:
            kept = new.replace(b" ", mark)
            out += kept
            align += [a] * len(kept)
            spaced = remove_extra_whitespaces and new.endswith(b" ")
            end = b
        elif not remove_extra_whitespaces:
            end = b
    if remove_extra_whitespaces:
        while out.endswith(mark):
            del out[-len(mark) :]
            end = align[len(out)]
            del align[len(out) :]
    return bytes(out), np.asarray([*align, end], np.int64)


class Codec:
    """A loaded model: encodes texts to ids with source spans, and decodes ids."""

    def __init__(self, model_file: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        proto = pb.ModelProto()
        with open(model_file, "rb") as f:
            proto.ParseFromString(f.read())
        spec, kind = proto.normalizer_spec, proto.pieces[0].__class__
        self.charmap = CharacterMap(spec.precompiled_charsmap)
        self.add_dummy_prefix, self.remove_extra = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        pieces = [p.piece for p in proto.pieces]
        self.byte = np.array([p.type == kind.BYTE for p in proto.pieces])
        self.unknown = np.array([p.type == kind.UNKNOWN for p in proto.pieces])
        # Source bytes of each piece when a space mark stands for one space.
        self.width = np.array([1 if b else len(p.replace(SPACE_MARK, " ").encode()) for p, b in zip(pieces, self.byte)], np.int64)
        self.length = np.array([1 if b else len(p.encode()) for p, b in zip(pieces, self.byte)], np.int64)
        across = any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)
        self.by_unit = (
            not across and not self.charmap.units and self.add_dummy_prefix and not self.remove_extra
            and spec.escape_whitespaces and proto.trainer_spec.model_type == proto.trainer_spec.BPE
            and proto.trainer_spec.byte_fallback and not any(p.type == kind.USER_DEFINED for p in proto.pieces)
            and not proto.trainer_spec.treat_whitespace_as_suffix
        )
        self.cache = UnitCache(self._units, UNITS)
        self.names = [str(i) for i in range(len(pieces))]

    def _units(self, units: list[bytes]) -> list[list[int]]:
        """Ids of units that each begin with the space that stands for the dummy prefix."""
        texts = [u[1:].decode() for u in units]
        ids = self.model.encode(texts, num_threads=1)
        return [i if t else [self.model.piece_to_id(SPACE_MARK)] for i, t in zip(ids, texts)]

    def encode_column(self, texts: pa.Array):
        """For each text: ids, begins, ends (int arrays; byte offsets in the source text)."""
        texts = pc.fill_null(texts, "")
        if not self.by_unit:
            yield from map(self.encode_whole, texts.to_pylist())
            return
        led = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
        data, offsets = column_bytes(led)
        for lo, hi in slices(offsets):
            part, off = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            # A text that holds the space mark itself is encoded whole.
            marked = self._marked(part, off)
            space = part == 32
            first = space.copy()
            first[1:] &= ~space[:-1]
            first[off[:-1][off[:-1] < len(part)]] = True
            start = np.flatnonzero(first)
            end = np.append(start[1:], len(part))
            ids, counts = self.cache.lookup(part, start, end)
            upto = np.append(0, np.cumsum(counts))[np.searchsorted(start, off)]
            ends = np.append(0, np.cumsum(self.width[ids]))
            for k in range(hi - lo):
                if k in marked:
                    yield self.encode_whole(texts[lo + k].as_py())
                    continue
                a, b = upto[k], upto[k + 1]
                span = ends[a : b + 1] - ends[a] - 1
                yield ids[a:b], span[:-1].clip(0), span[1:]

    @staticmethod
    def _marked(part: np.ndarray, off: np.ndarray) -> set[int]:
        at = np.flatnonzero((part[:-2] == 0xE2) & (part[1:-1] == 0x96) & (part[2:] == 0x81)) if len(part) > 2 else []
        return set((np.searchsorted(off, at, "right") - 1).tolist()) if len(at) else set()

    def encode_whole(self, text: str):
        """Ids and spans of one text, encoded in one piece."""
        if not text:
            none = np.zeros(0, np.int64)
            return none.astype(np.int32), none, none
        found = self.model.encode(text, return_type="proto")
        ids = np.array([p.id for p in found.pieces], np.int32)
        _, align = normalise(text, self.charmap, self.add_dummy_prefix, self.remove_extra)
        size = self.length[ids] if len(ids) else np.zeros(0, np.int64)
        if len(ids) and self.unknown[ids].any():
            size = np.array([len(p.piece.encode()) if u else s for p, u, s in zip(found.pieces, self.unknown[ids], size)], np.int64)
        ends = np.cumsum(size)
        if len(ids) and ends[-1] != len(align) - 1:
            raise ValueError("the pieces do not cover the normalised text")
        return ids, align[ends - size], align[ends]


@lru_cache(maxsize=2)
def _codec(model_file: str) -> Codec:
    return Codec(model_file)


def encode_offsets(docs: DataFrame, model_file: str, columns: tuple[str, ...] = OFFSETS) -> DataFrame:
    """Encode every text; one row per row of ``docs``: ``doc_id`` and ``columns``.

    ``model_file`` is a path that every executor can open. ``ids``; ``begins``
    and ``ends`` (byte offsets in the UTF-8 source, end exclusive); ``decoded``, the text
    that the model decodes the ids to; ``n_tokens``; ``ids_sha256`` (decimal ids
    joined by commas) and ``decoded_sha256``; ``covered_bytes``, the source bytes
    that the spans of the pieces cover. What is not asked for never leaves the
    loop over a text, and rows go on as soon as about ``SEND_IDS`` ids are held.
    """
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(c, COLUMNS[c]) for c in columns]])
    arrow = {"ids": pa.list_(pa.int32()), "begins": pa.list_(pa.int64()), "ends": pa.list_(pa.int64()), "n_tokens": pa.int64(), "covered_bytes": pa.int64()}
    decode = "decoded" in columns or "decoded_sha256" in columns

    def run(batches):
        codec = _codec(model_file)
        make = {
            "ids": lambda ids, begins, ends, listed, text: ids,
            "begins": lambda ids, begins, ends, listed, text: begins,
            "ends": lambda ids, begins, ends, listed, text: ends,
            "decoded": lambda ids, begins, ends, listed, text: text,
            "n_tokens": lambda ids, begins, ends, listed, text: len(listed),
            "ids_sha256": lambda ids, begins, ends, listed, text: hashlib.sha256(",".join([codec.names[i] for i in listed]).encode()).hexdigest(),
            "decoded_sha256": lambda ids, begins, ends, listed, text: hashlib.sha256(text.encode()).hexdigest(),
            "covered_bytes": lambda ids, begins, ends, listed, text: int((ends - begins).sum()),
        }
        wanted = [make[c] for c in columns]
        for batch in batches:
            rows, held, first = [], 0, 0

            def send():
                cols = [pa.array(c, arrow.get(n, pa.string())) for n, c in zip(columns, zip(*rows))]
                return pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(rows)), *cols], names=schema.names)

            for ids, begins, ends in codec.encode_column(batch.column(1)):
                listed = ids.tolist()
                text = codec.model.decode(listed) if decode and listed else ""
                rows.append([f(ids, begins, ends, listed, text) for f in wanted])
                held += len(listed)
                if held >= SEND_IDS:
                    yield send()
                    rows, held, first = [], 0, first + len(rows)
            if rows:
                yield send()

    return doc_texts(docs).mapInArrow(run, schema)
