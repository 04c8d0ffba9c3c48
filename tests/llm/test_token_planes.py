import io
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from conftest import SF_SMALL
from llm_cases import documents, no_documents
from tokenizers import Tokenizer

from strata.llm.tables import new_folder
from strata.llm.token_planes import BLOCK_IDS, PlaneReader, PlaneWriter, from_planes, read_token_files, to_planes, token_file_digests, write_token_files

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("bits", [True, False])
def test_files_hold_the_librarys_ids(spark, bits):
    docs = documents(spark, SF_SMALL)
    tokenizer, start, expected = Tokenizer.from_file(FILE), 0, []
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = token_file_digests(spark, docs, new_folder(spark, "test-ids"), FILE, 2, bits).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected


def test_empty_table_gives_no_file(spark):
    manifest = write_token_files(no_documents(spark), new_folder(spark, "test-ids"), FILE, 2)
    assert manifest.count() == 0
    assert read_token_files(manifest, 0).count() == 0


def test_rows_of_one_id_spread_over_files_in_the_order_of_their_texts(spark):
    texts = [f"{k * 7919 % 1000} words of a text" for k in range(600)]
    rows = [(None, t) for t in texts] + [(5, t) for t in texts[:300]] + [(9, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tokenizer, start, expected = Tokenizer.from_file(FILE), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = write_token_files(docs, new_folder(spark, "test-ids"), FILE, 2).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(manifest) == 4 and max(r["n_docs"] for r in manifest) < 600
    got = read_token_files(spark.createDataFrame(manifest), len(manifest)).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected


@pytest.mark.parametrize("bits", [True, False])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1000])
def test_planes_round_trip(bits, n):
    for top in (1, 2, 255, 256, 50_257, 2**32):
        ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
        assert (from_planes(to_planes(ids, bits), n, bits) == ids).all()


@pytest.mark.parametrize("bits", [True, False])
def test_any_block_can_be_read_by_the_index(bits):
    rng = np.random.default_rng(1)
    counts = np.array([0, 5, BLOCK_IDS - 5, 1, 3 * BLOCK_IDS, 17])
    ids = rng.integers(0, 60_000, counts.sum()).astype(np.uint32)
    sink = io.BytesIO()
    writer = PlaneWriter(sink, bits, 1)
    writer.add(np.arange(3), counts[:3], ids[: counts[:3].sum()])
    writer.add(np.arange(3, 6), counts[3:], ids[counts[:3].sum() :])
    writer.close()
    source = pa.BufferReader(sink.getvalue())
    reader = PlaneReader(type("Source", (), {"read_at": staticmethod(source.read_at), "size": staticmethod(source.size)}))
    for k in reversed(range(len(reader.blocks))):
        assert (reader.block(k) == ids[k * BLOCK_IDS : (k + 1) * BLOCK_IDS]).all()
    cuts = np.cumsum(counts)[:-1]
    assert all((a == b).all() for a, b in zip(reader.documents(), np.split(ids, cuts)))
