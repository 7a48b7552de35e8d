"""Small tables with the cases that every operator has to stand."""

from __future__ import annotations

import random

WORDS = [f"{a}{b}" for a in "the and ver ing ion ent ste qua lor mip".split() for b in "a e o ut is em ar on".split()]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def documents() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls, empty and blank texts, copies,
    near copies, a shared passage, a long text, repeated rows and a repeated doc_id."""
    passage = prose(1, 20)
    base = prose(2, 60)
    texts = {
        1: base,
        2: base,
        3: base + " end",
        4: None,
        5: "",
        6: " \n\t ",
        7: "12345 !!",
        8: f"{prose(3, 30)} {passage} {prose(4, 30)}",
        9: f"{prose(5, 40)} {passage} {prose(6, 10)}",
        10: f"{passage} {prose(7, 15)}",
        11: prose(8, 3000),
        12: "aaaa" * 60 + "é日本" + "aaaa" * 60,
        13: "x",
        14: "one two",
        15: "a " * 400,
        16: "déjà vu\u0085 x y",
        17: "a " * 200,
    }
    rows = [(i, t, "en" if i % 3 else None, None if i % 5 == 0 else f"s{i % 4}", len(t or "")) for i, t in texts.items()]
    return rows + [rows[0], (8, "other text of a repeated id", "fr", "s1", 27), (None, base, "en", "s2", 5), (None, "no id at all", None, None, 1)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows=None):
    rows = documents() if rows is None else rows
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", "'clash' as h", "1 as size", "'x' as block", "2 as did", "'y' as name")


def stored(df, tmp_path, name: str = "documents") -> str:
    df.write.parquet(f"file://{tmp_path}/{name}.parquet")
    return f"file://{tmp_path}"
