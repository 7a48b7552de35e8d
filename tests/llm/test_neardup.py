"""Near copies against all pairs of shingle sets."""

import random

import corpus_pipeline
from corpweave.llm import neardup
from tests.llm.cases import WORDS, frame, prose


def near_rows():
    rng = random.Random(4)
    rows = []
    for g in range(12):
        base = prose(700 + g, 60 + 25 * g).split()
        for k in range(6):
            words = list(base)
            for _ in range(k):  # each changed word breaks five shingles
                words[rng.randrange(len(words))] = rng.choice(WORDS) + "x"
            rows.append((len(rows), " ".join(words), "en", "s", 0))
    return rows


def plain_groups(rows):
    sets = []
    for r in rows:
        w = r[1].lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    label = [r[0] for r in rows]
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            low = min(label[j] for j, b in enumerate(sets) if len(a & b) >= 0.8 * len(a | b))
            if low != label[i]:
                label[i], changed = low, True
    return label


def groups_of(found):
    """The least doc_id of each class, by doc_id."""
    least = {}
    for r in found:
        least[r["class"]] = min(least.get(r["class"], r.doc_id), r.doc_id)
    return {r.doc_id: least[r["class"]] for r in found}


def test_near_copies(spark):
    rows = near_rows()
    got = groups_of(neardup.near_copies(frame(spark, rows)).collect())
    want = plain_groups(rows)
    assert [got[i] for i in range(len(rows))] == want
    assert 12 < len(set(want)) < len(rows)


def test_stage_drops_edited_copies(spark):
    rows = near_rows()
    docs = frame(spark, rows)
    got = corpus_pipeline.near_dedup(spark, docs, "")
    assert {r.doc_id for r in got.collect()} == set(plain_groups(rows)) and got.columns == docs.columns


def test_crowded_cluster(spark):
    base = prose(9, 150).split()
    rows = [(i, " ".join([*base[: i % 150], f"w{i}", *base[i % 150 + 1 :]]), "en", "s", 0) for i in range(1500)]
    assert set(groups_of(neardup.near_copies(frame(spark, rows)).collect()).values()) == {0}


def test_few_partners_and_split_bands_lose_nothing(spark, monkeypatch):
    rows = near_rows()
    rng = random.Random(8)
    base = prose(800, 40).split()
    for i in range(80):  # all within the radius of each other, and not all similar
        words = list(base)
        for _ in range(1 + i % 3):
            words[rng.randrange(40)] = f"y{rng.randrange(30)}"
        rows.append((len(rows), " ".join(words), "en", "s", 0))
    docs = frame(spark, rows)
    monkeypatch.setattr(neardup, "FIRST", 1)
    prints = neardup.written(neardup.mapped(docs.select("doc_id", "text", neardup.row_key().alias("row_key")), neardup._signatures, "doc_id long, row_key long, fp long, simhash long, bands array<long>"), "t")
    linked = {r.node: r.component for r in neardup.classes_of(docs, prints, 0.8, block=16).collect()}
    class_ = {r.doc_id: linked.get(r.fp, r.fp) for r in prints.collect()}
    least = {}
    for d, c in sorted(class_.items()):
        least.setdefault(c, d)
    assert [least[class_[i]] for i in range(len(rows))] == plain_groups(rows)


def test_rows_of_one_id_and_of_none(spark):
    one, other = prose(1, 40), prose(2, 40)
    rows = [(8, one, "en", "s", 0), (8, other, "en", "s", 1), (None, other, "en", "s", 2), (None, prose(3, 40), "en", "s", 3), (None, None, "en", "s", 4), (9, "", "en", "s", 5), (8, one, "en", "s", 0)]
    got = sorted((repr(r.doc_id), r.text or "") for r in corpus_pipeline.near_dedup(spark, frame(spark, rows), "").collect())
    assert got == sorted([("8", one), ("8", other), ("None", prose(3, 40)), ("9", "")])
