"""The pipeline's stages against brute force on the tables and on odd rows."""

import re

import corpus_pipeline
import pytest
import public_tokenizers
import sentencepiece
from test_exact import brute_windows
from test_learned import brute_pii
from test_probminhash import brute_classes

from lodestone.llm.common import stash
from lodestone.llm.weak_toxicity import toxicity_scores
from lodestone.sources.tables import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs = table(spark, SF, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stash(stage(spark, out[-1], SF), name))
    return out


def test_stages_follow_their_operators(spark, outputs):
    docs, calm, single, clean, private, tokens = outputs
    texts = [{r.doc_id: r.text for r in d.select("doc_id", "text").collect()} for d in (docs, calm, single, clean, private)]
    scores = toxicity_scores(docs, table(spark, SF, "labels")).collect()
    assert set(texts[1]) == {r.doc_id for r in scores if not r.predicted}
    classes = brute_classes(sorted(texts[1].items()))
    assert set(texts[2]) == set(classes.values())
    found = brute_windows(texts[2].items(), [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()])
    assert set(texts[3]) == set(texts[2]) - {i for i, _ in found}
    for i, t in texts[3].items():
        new = texts[4][i]
        assert not brute_pii(new) and (new == t or re.search(r"\[[A-Z_]+\]", new))
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in tokens.collect():
        assert list(r.ids) == lib.encode(texts[4][r.doc_id], add_bos=True, add_eos=True) and r.n_tokens == len(r.ids)
    assert all(d.columns == docs.columns for d in outputs[:-1])
    assert {r.n_chars for r in private.selectExpr("n_chars = length(text) as n_chars").collect()} == {True}


def test_run_returns_the_last_stage(spark, outputs):
    assert corpus_pipeline.run(spark, SF).count() == outputs[-1].count()


def test_odd_documents(spark):
    rows = [(None, "no id", "en", None, 5), (1, None, None, "s", None), (2, "", "en", "s", 0), (2, "", "en", "s", 0),
            (3, "word " * 40000, "en", "s", 200000), (4, "word " * 40000, "en", "s", 200000)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, item_id int, root string")
    for _, stage in corpus_pipeline.STAGES:
        docs = stash(stage(spark, docs, SF), "odd")
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in docs.collect()) == [(False, 1), (False, 2), (False, 3), (True, 0)]
    empty = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stash(stage(spark, empty, SF), "empty")
    assert empty.count() == 0
