"""Dates as `Mon-yy` texts."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from dateutil import parser
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from corpweave.functions.text import clean_corrupted
from corpweave.shipping import shipped

#: what is tried in turn; the last is for months given as numbers
FORMATS = ["MMM-yy", "MMM-yyyy", "yyyy-M-d", "yyyy/M/d", "M/d/yyyy", "M-yyyy"]
_SHAPES = [r"^[A-Za-z]{3}-\d{2}$", r"^[A-Za-z]{3}-\d{4}$", r"^\d{4}-\d{1,2}-\d{1,2}$", r"^\d{4}/\d{1,2}/\d{1,2}$", r"^\d{1,2}/\d{1,2}/\d{4}$", r"^\d{1,2}-\d{4}$"]


#: what a date found in free text has if the text does not say
_UNSAID = (datetime(1904, 1, 1), datetime(1908, 2, 2))


def found_date(text: str | None) -> str | None:
    """`Mon-yy` of the date that the standard fuzzy parser finds in a text; null if it finds
    none, or no month or no year: nothing is made up for them."""
    if not text:
        return None
    try:
        seen = {parser.parse(text, fuzzy=True, default=d).strftime("%b-%y") for d in _UNSAID}
    except (ValueError, OverflowError, TypeError):
        return None
    return seen.pop() if len(seen) == 1 else None


def _found(c: Column) -> Column:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        shipped(spark)

    def find(texts: pd.Series) -> pd.Series:
        return pd.Series([found_date(t) for t in texts], dtype="object")

    return F.pandas_udf(find, "string")(c)


def month_year(c: Column) -> Column:
    """`Mon-yy` of a date text in one of `FORMATS`, else of the date found in it by
    `found_date`; null for others, a year alone among them."""
    given = clean_corrupted(c)
    text = given
    text = F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 100)))
    tried = [F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(form))) for form, shape in zip(FORMATS, _SHAPES)]
    known = F.date_format(F.coalesce(*tried), "MMM-yy")
    return F.coalesce(known, _found(F.when(known.isNull(), given)))
