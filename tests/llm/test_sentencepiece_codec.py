import hashlib

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from conftest import SF_SMALL
from llm_cases import documents, no_documents
from sentencepiece import sentencepiece_model_pb2 as pb

from strata.llm.sentencepiece_codec import DIGESTS, CharacterMap, encode_offsets, normalise

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_digests_equal_the_librarys(spark):
    docs = documents(spark, SF_SMALL)
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    expected = []
    for r in docs.collect():
        ids = lib.encode(r["text"] or "")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected.append((r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids) if ids else ""), len((r["text"] or "").encode())))
    got = [tuple(r) for r in encode_offsets(docs, MODEL, DIGESTS).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_spans_partition_the_source(spark):
    docs = documents(spark, SF_SMALL)
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in encode_offsets(docs, MODEL).collect():
        raw = texts[r["doc_id"]]
        assert list(r["begins"][1:]) == list(r["ends"][:-1])
        assert (r["begins"][0], r["ends"][-1]) == (0, len(raw)) if r["ids"] else not raw
        for i, a, b in list(zip(r["ids"], r["begins"], r["ends"]))[:200]:
            piece = lib.id_to_piece(i)
            if not lib.is_byte(i):
                assert piece.replace("▁", " ").encode().lstrip(b" ") == raw[a:b].replace(b"\xe2\x96\x81", b" ").lstrip(b" ")


def test_rows_are_sent_in_small_parts(spark, monkeypatch):
    from strata.llm import sentencepiece_codec as S

    docs = documents(spark, SF_SMALL)
    whole = encode_offsets(docs, MODEL, ("n_tokens", "ids", "decoded_sha256"))
    assert whole.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
    expected = sorted(map(str, whole.collect()))
    monkeypatch.setattr(S, "SEND_IDS", 100)
    monkeypatch.setattr(S, "UNITS", 50)
    assert sorted(map(str, encode_offsets(docs, MODEL, ("n_tokens", "ids", "decoded_sha256")).collect())) == expected


def test_empty_table(spark):
    assert encode_offsets(no_documents(spark), MODEL).count() == 0
    assert encode_offsets(no_documents(spark), MODEL, DIGESTS).count() == 0


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("dummy", [False, True])
@pytest.mark.parametrize("remove", [False, True])
def test_normalisation_follows_the_character_map(rule, dummy, remove):
    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=dummy, remove_extra_whitespaces=remove, escape_whitespaces=True)
    proto = pb.ModelProto()
    proto.ParseFromString(lib.serialized_model_proto())
    charmap = CharacterMap(proto.normalizer_spec.precompiled_charsmap)
    for text in ["ＡＢ ﬁ  x ", "  a　b\t\n c ", "ｶﾞ ①² é", "", "   ", "한글 ﷺ x​z", " \xad ", "plain"]:
        out, align = normalise(text, charmap, dummy, remove)
        assert out.decode() == lib.normalize(text)
        assert len(align) == len(out) + 1 and (np.diff(align) >= 0).all()
        # The library's offsets are in characters, one for each normalised character.
        _, offsets = lib.normalize(text, with_offsets=True)
        chars = [k for k, b in enumerate(out) if b & 0xC0 != 0x80]
        at = [len(text.encode()[: align[k]].decode()) for k in chars]
        if dummy and chars:
            at, offsets = at[1:], offsets[1:]
        assert at == offsets[: len(at)]
