import hashlib
import os
import sys

import public_tokenizers
import sentencepiece
from conftest import SF_SMALL
from test_decontaminate import brute_force as contaminated
from test_jaccard_join import brute_force as linked
from test_quality_rules import base as quality_base
from test_secret_scan import base as secrets

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402

from strata.llm import jaccard_join as J  # noqa: E402
from strata.llm.tables import written  # noqa: E402


def test_stages_one_by_one(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "jaccard_join", "decontaminate", "secret_scan", "sentencepiece"]
    rows = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in stages.items():
        out = written(stage(spark, docs, SF_SMALL), f"test-{name}")
        got = {r["doc_id"]: r for r in out.collect()}
        assert len(got) == out.count()
        if name != "sentencepiece":
            assert out.columns == docs.columns
        if name == "quality_rules":
            assert all(not quality_base(r["text"])[-1] for r in got.values())
            clean = {d for d, q in labels.items() if q == 1 and not quality_base(rows[d]["text"])[-1]}
            assert clean <= set(got) and all(got[d] == rows[d] for d in got)
        elif name == "jaccard_join":
            monkeypatch.setattr(J, "GRAM", corpus_pipeline.NEAR_WORDS)
            monkeypatch.setattr(J, "PERCENT", corpus_pipeline.NEAR_PERCENT)
            label = linked([(d, r["text"]) for d, r in rows.items()])
            monkeypatch.undo()
            assert set(got) == set(label.values()) and all(got[d] == rows[d] for d in got)
        elif name == "decontaminate":
            bad = {x[0] for x in contaminated([(d, r["text"]) for d, r in rows.items()], items)}
            assert set(got) == set(rows) - bad and all(got[d] == rows[d] for d in got)
        elif name == "secret_scan":
            assert set(got) == set(rows)
            assert not any(secrets(r["text"]) for r in got.values())
            assert all(got[d]["text"] == rows[d]["text"] for d in rows if "[SECRET]" not in got[d]["text"])
        else:
            for d, r in rows.items():
                ids = lib.encode(r["text"])
                assert (got[d]["ids"], got[d]["n_tokens"]) == (ids, len(ids))
                assert got[d]["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
        docs, rows = out, got
    ran = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted((r["doc_id"], r["decoded_sha256"]) for r in ran.collect()) == sorted((d, r["decoded_sha256"]) for d, r in rows.items())


def test_near_copies_of_five_words_and_80_percent_go(spark):
    w = [f"u{k}" for k in range(40)]
    rows = [(1, " ".join(w)), (2, " ".join([*w[:36], "a", "b", "c", "d"])), (3, "another text")]  # 32 of 40 shingles of five words
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.jaccard_join(spark, docs, SF_SMALL).collect()} == {1, 3}


def test_rows_of_one_id_keep_their_texts_and_columns_keep_their_names(spark):
    w = " ".join(f"u{k}" for k in range(40))
    rows = [(1, w, "a", 1), (1, w, "b", 2), (1, "another text of the same id", "c", 3), (2, w, "d", 4), (3, "on its own", "e", 5), (None, w, "f", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, place long")
    out = corpus_pipeline.jaccard_join(spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([rows[0], rows[2], rows[4], rows[5]], key=str)
    assert corpus_pipeline.quality_rules(spark, docs, SF_SMALL).columns == docs.columns
