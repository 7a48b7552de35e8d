"""Likeness of short texts to their edited versions."""

from corpweave.llm import winnow
from tests.llm.cases import frame, prose


def test_short_texts_keep_their_likeness(spark):
    rows = [(i, prose(900 + i, 12 + i % 18), "en", "s", 0) for i in range(60)]
    got = winnow.fingerprinted(frame(spark, rows)).select("near_edited", "near_next").collect()
    assert all(r.near_edited > 0 for r in got) and all(r.near_next < 0.2 for r in got)
