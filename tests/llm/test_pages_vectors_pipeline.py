"""WARC, HTML, embeddings and the pipeline."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from corpweave.llm import lattice, mixing, suffix, warc
from corpweave.llm.queries import QUERIES
from corpweave.llm.render import render
from tests.llm.cases import documents, frame, prose, stored

PAGES = "page_id long, url string, html string"


def pages():
    big = "<p>" + prose(1, 300) + "</p>"
    rows = [(1, "http://www.a.example/x?q=1", big), (2, "http://b.example/", big), (3, None, None), (4, "no url", ""), (5, "http://a.example:8080/é", "short"), (6, "http://a.example/x", "short"), (None, "http://b.example/z", big), (None, "http://c.example/", prose(2, 300)), (7, "http://a.example/new\nline", prose(3, 900))]
    return rows + [rows[0], rows[1]] + [(100 + i, f"http://host{i % 3}.example/{i}", f"page {i}") for i in range(40)]


def page_frame(spark, rows):
    return spark.createDataFrame(rows, PAGES).selectExpr("*", "'z' as digest", "1 as size", "'k' as key")


def test_op1(spark, tmp_path):
    rows = pages()
    sf = stored(page_frame(spark, rows), tmp_path, "pages")
    got = Counter(tuple(r) for r in QUERIES["op1_warc"](spark, sf).collect())
    want = Counter()
    for p, _, html in rows:
        body = (html or "").encode()
        same = [q for q, _, h in rows if (h or "").encode() == body and q is not None]
        top = max(same, default=None)
        revisit = len(body) >= 1000 and top is not None and p != top
        want[(p, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", top if revisit else None)] += 1
    assert got == want


def test_lookup_reads_only_what_is_there(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    rows = [(i, f"http://h{i % 7}.example/{i % 11}", f"page {i}") for i in range(100)]
    index, captures = warc.write_pages(page_frame(spark, rows))
    for r in captures.collect():
        assert (r.archive, r.offset, r.length) in index.locate(r.key)
    assert index.locate(warc.line_key("example,h1)/none", 3)) == []
    wanted = spark.createDataFrame([(5, "http://h5.example/5"), (5, "http://h5.example/6"), (999, None)], "page_id long, url string")
    found = warc.read_captures(index, wanted).collect()
    assert [(r.page_id, r.payload) for r in found] == [(5, b"page 5")]


def test_url_keys():
    assert warc.url_key("http://www.A.example:80/P?q=1") == "example,a)/p?q=1"
    assert warc.url_key("https://b.a.example:8443") == "example,a,b:8443)/"
    assert warc.url_key(None) == "" and warc.url_key("http://[bad") == "http://[bad"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("<p>a<p>b", "a\n\nb"),
        ("<ul><li>a<li>b<ol start=3><li>c</ol></ul>", "- a\n- b\n  3. c"),
        ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a    bb\nccc  d"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
        ("<div hidden>x</div><script>y</script><b style='display:none'>z</b>w", "w"),
        ("<pre>a\n  b</pre>", "a\n  b"),
        ("a<br>b &amp; c <!-- x --> d", "a\nb & c d"),
        ("1 < 2 <a \"broken>x</a>", "1 < 2 x"),
        ("<div>" * 400 + "deep" + "</div>" * 400, "deep"),
    ],
)
def test_render(html, text):
    assert render(html) == text


def test_op5(spark, tmp_path):
    rows = pages()
    got = QUERIES["op5_html_text"](spark, stored(page_frame(spark, rows), tmp_path, "pages")).collect()
    assert Counter(map(tuple, got)) == Counter((p, render(h)) for p, _, h in rows)


@pytest.mark.parametrize("name", ["op1_warc", "op5_html_text"])
def test_no_pages(spark, tmp_path, name):
    assert QUERIES[name](spark, stored(page_frame(spark, []), tmp_path, "pages")).count() == 0


# --- vectors ----------------------------------------------------------------------
VECTORS = "vec_id long, embedding array<float>, label int"


def vectors():
    rng = np.random.default_rng(5)
    out, k = [], 0
    for label in (0, 1):
        for _ in range(12):
            centre = rng.normal(size=64)
            for noise in (0, 0, 0.05, 0.12, 0.16, 0.2):
                v = centre + noise * rng.normal(size=64)
                out.append((k, [float(x) for x in v.astype(np.float32)], label))
                k += 1
    out.append((k, out[0][1], 0))
    out += [(k + 1, None, 0), (k + 2, [], 0), (k + 3, [0.0] * 64, 0), (k + 4, [None] + [1.0] * 63, 0), (k + 5, [float("nan")] * 64, 0), (k + 6, [float("inf")] * 64, 0), (k + 7, out[0][1], None), (None, out[0][1], 0), (k + 8, [1.0, 2.0], 0), (k + 9, [2.0, 4.0], 0)]
    return out


def plain_links(rows):
    def usable(r):
        return r[0] is not None and r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])

    ok = [usable(r) for r in rows]
    n = len(rows)
    unit = [np.array(r[1], dtype=np.float64) / np.linalg.norm(np.array(r[1], dtype=np.float64)) if o else None for r, o in zip(rows, ok)]
    near = [[j for j in range(n) if j != i and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]) and unit[i] @ unit[j] >= 0.98] for i in range(n)]
    label = [r[0] for r in rows]
    changed = True
    while changed:
        changed = False
        for i in range(n):
            low = min([label[i], *(label[j] for j in near[i])]) if near[i] else label[i]
            if low != label[i]:
                label[i], changed = low, True
    return [(r[0], len(near[i]), label[i], r[0] == label[i]) for i, r in enumerate(rows)]


@pytest.mark.parametrize("block", [2048, 5])
def test_op3(spark, block):
    rows = vectors()
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 as code", "2 as n", "'t' as place")
    got = [tuple(r) for r in lattice.near_vectors(df, block=block).collect()]
    want = plain_links(rows)
    assert sorted(r[0] or -1 for r in got) == sorted(r[0] or -1 for r in want)
    found, true = sum(r[1] for r in got), sum(r[1] for r in want)
    assert true * 0.98 <= found <= true
    assert block == 5 or sorted(got, key=repr) == sorted(want, key=repr)


def test_no_vectors(spark, tmp_path):
    df = spark.createDataFrame([], VECTORS)
    assert QUERIES["op3_lattice"](spark, stored(df, tmp_path, "embeddings")).count() == 0


def test_lattice_points():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 8)) * 2
    points = lattice.decode(x)
    doubled = 2 * points
    assert ((doubled == np.rint(doubled)).all(axis=1) & (points.sum(axis=1) % 2 == 0)).all()
    best = np.linalg.norm(x - points, axis=1)
    for v in lattice.MINIMAL:
        assert (best <= np.linalg.norm(x - points - v, axis=1) + 1e-9).all()


# --- pipeline ---------------------------------------------------------------------
def test_stages(spark, tmp_path):
    docs = frame(spark).selectExpr("*", "'l' as language", "3 as copy", "4 as times", "true as no_text", "'k' as key", "5 as shard", "'c' as class")
    by_name = dict(corpus_pipeline.STAGES)
    kept = by_name["language_id"](spark, docs, "")
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in documents()} - {4, 5, 6, 7} and kept.columns == docs.columns
    near = by_name["near_dedup"](spark, kept.persist(), "").persist()
    rows = [(r.doc_id, r.text) for r in near.collect()]
    assert near.columns == docs.columns and len(set(rows)) == len(rows)
    ids = [d for d, _ in rows]
    assert 1 in ids and 2 not in ids and 3 not in ids and ids.count(8) == 2 and ids.count(None) == 1
    cut = by_name["passage_dedup"](spark, near, "").persist()
    lengths = Counter((d, n - gone) for d, n, gone, *_ in suffix_rows(rows))
    assert Counter((r.doc_id, len(r.text.encode())) for r in cut.collect() if r.doc_id != 12) == Counter({k: v for k, v in lengths.items() if k[0] != 12})
    assert all(r.n_chars == len(r.text) for r in cut.collect() if r.doc_id not in (8, None))
    assert cut.columns == docs.columns
    mix = by_name["mixing"](spark, cut, "").persist()
    assert mix.columns == docs.columns
    planned = Counter((r.doc_id, r.size) for r in mixing.mixed(cut).collect())
    assert Counter((r.doc_id, len((r.text or "").encode().split())) for r in mix.collect()) == planned
    packed = by_name["packing"](spark, mix, "").collect()
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    whole = Counter()
    for r in mix.collect():
        whole.update([(r.doc_id, len(encode(r.text, add_special_tokens=False).ids) + 1)])
    assert sum(r.length for r in packed) == sum(n * k for (_, n), k in whole.items())
    bins = {}
    for r in packed:
        assert len(r.ids) == 4 * r.length
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in bins.values():
        ends = [a + n for a, n in sorted(spans)]
        assert [a for a, _ in sorted(spans)] == [0, *ends[:-1]] and ends[-1] <= 1024


def suffix_rows(rows):
    from tests.llm.test_documents import plain_repeats

    return [k for k, n in plain_repeats(rows).items() for _ in range(n)]


def test_run_on_nothing(spark, tmp_path):
    empty = frame(spark, []).select("doc_id", "text", "lang", "source", "n_chars")
    assert corpus_pipeline.run(spark, stored(empty, tmp_path)).count() == 0


def test_suffix_is_used():
    assert corpus_pipeline.without_repeats is suffix.without_repeats
