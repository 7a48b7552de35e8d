"""The mix is made, in shards, and not only planned."""

from collections import Counter

import corpus_pipeline
from corpweave.llm import mixing
from tests.llm.cases import frame, prose, stored


def test_stage_stands_by_shard_and_place(spark):
    rows = [(i, prose(i, 5 + i % 7), "en", "abc"[i % 3], 0) for i in range(300)]
    docs = frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    plan = {}
    for r in mixing.mixed(docs).collect():
        plan.setdefault(r.doc_id, set()).add((r.shard, r.place))
    parts = corpus_pipeline.mixing(spark, docs, "").rdd.glom().collect()
    assert Counter(r.doc_id for p in parts for r in p) == Counter({d: len(c) for d, c in plan.items()})
    for part in parts:
        at = (-1, 0)
        for r in part:  # each row has a place behind the one before it
            later = [c for c in plan[r.doc_id] if c > at]
            assert later
            at = min(later)


def test_op8_counts_the_mix(spark, tmp_path, monkeypatch):
    rows = [(i, prose(i, 5 + i % 7), "en", "abc"[i % 3], 0) for i in range(100)]
    sf = stored(frame(spark, rows), tmp_path)
    made = []
    old = mixing.written
    monkeypatch.setattr(mixing, "written", lambda df, label: made.append(label) or old(df, label))
    got = {r.doc_id: r.taken for r in mixing.op8_mixing(spark, sf).collect()}
    want = Counter({i: 0 for i in range(100)})
    for r in mixing.mixed(spark.read.parquet(f"{sf}/documents.parquet")).collect():
        want[r.doc_id] += r.size
    assert got == dict(want) and made[-1] != "mix-sizes" and "mix" in made
