"""Which documents the language stage keeps."""

import random

import pytest

import corpus_pipeline
from corpweave.llm import langid
from tests.llm.cases import frame

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def noise(n):
    rng = random.Random(n)
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))


def test_texts_in_no_learned_language_go(docs):
    model = langid.fit(docs)
    other = ["Съешь же ещё этих мягких французских булок да выпей чаю", "日本語の文章はこのように書かれています", noise(300), noise(2000), "x" + " 123 .,;" * 50 + " zqxj"]
    assert not model.recognised(other).any()
    prose = max((r.text for r in docs.filter("lang = 'en'").select("text").limit(50).collect()), key=len)[:300]
    assert model.recognised([prose, f'{prose} token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" 4734663219866878', "the", None, "", "12 !"]).tolist() == [True, True, True, False, False, False]


def test_a_language_left_out_goes(docs):
    model = langid.fit(docs.filter("lang <> 'de'"))
    german = [r.text for r in docs.filter("lang = 'de' and length(text) > 200").collect()]
    rest = [r.text for r in docs.filter("lang <> 'de' and length(text) > 200").collect()]
    assert model.recognised(german).mean() < 0.1 and model.recognised(rest).mean() > 0.98


def test_without_labels_letters_are_enough(spark):
    rows = [(1, "some words", None, "s", 10), (2, "日本語", None, "s", 3), (3, "12 !", None, "s", 4), (4, None, None, "s", 0)]
    docs = frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    assert {r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()} == {1, 2}
