"""Column expressions over names, seeds and free text; all stay in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpweave.functions import rules

#: white space in the Unicode sense, which Java's \\s alone does not cover
WHITE = r"[\s\x0b\x1c-\x1f\x85\xa0  -     　]"

#: runs of white space other than one space; the inner class tells most letters apart at once
UNEVEN = rf"(?:[[^ -~]&&{WHITE}]| (?={WHITE})){WHITE}*"


def any_of(patterns: list[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def literals(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def normalize_whitespace(c: Column) -> Column:
    """Null becomes empty; runs of white space become one space; ends are stripped."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), UNEVEN, " "))


def normalize_source_type(c: Column) -> Column:
    name = F.upper(normalize_whitespace(c))
    out = name
    for alias, target in rules.SOURCE_ALIASES.items():
        out = F.when(name == alias, target).otherwise(out)
    return out


def clean_corrupted(c: Column) -> Column:
    """White space normalised; what a spreadsheet spoiled is null."""
    text = normalize_whitespace(c)
    spoiled = F.upper(text).isin(rules.CORRUPT_TOKENS) | (F.upper(text) == "11-JUL") | text.startswith("#")
    return F.when(c.isNotNull() & ~spoiled, text)


def normalize_seed(c: Column) -> Column:
    return _blank_to_null(normalize_whitespace(clean_corrupted(c)))


def strip_prefix_junk(c: Column) -> Column:
    """Without opening brackets, dots and spaces in front."""
    return F.regexp_replace(c, r"^(?:[.{(\[]|" + WHITE + ")+", "")


def lookup_name(c: Column) -> Column:
    """Upper-case name without punctuation and company suffixes anywhere; null if nothing is left."""
    spaced = normalize_whitespace(F.regexp_replace(F.upper(c), r"[,.;:()/\-]+", " "))
    kept = F.filter(F.split(spaced, " "), lambda t: ~F.array_contains(literals(rules.LOOKUP_SUFFIXES), t))
    return _blank_to_null(F.array_join(kept, " "))


def company_name(c: Column) -> Column:
    """Upper-case A-Z, 0-9 and single spaces; & is AND, what stands in brackets goes."""
    upper = F.replace(F.upper(normalize_whitespace(c)), F.lit("&"), F.lit(" AND "))
    bare = F.regexp_replace(F.regexp_replace(upper, r"\([^)]*\)", " "), r"[^A-Z0-9\s]", " ")
    return normalize_whitespace(bare)


def _suffix_start(tokens: Column) -> Column:
    """Number of tokens before the company suffixes at the end."""
    at = F.sequence(F.lit(1), F.size(tokens))
    return F.aggregate(at, F.lit(0), lambda kept, i: F.when(F.array_contains(literals(rules.NAME_SUFFIXES), F.element_at(tokens, i)), kept).otherwise(i))


def base_name(name: Column) -> Column:
    tokens = F.split(name, " ")
    return F.array_join(F.slice(tokens, F.lit(1), _suffix_start(tokens)), " ")


def legal_suffixes(name: Column) -> Column:
    tokens = F.split(name, " ")
    start = _suffix_start(tokens)
    return F.when(name == "", "").otherwise(F.array_join(F.slice(tokens, start + 1, F.size(tokens)), ";"))


def acronym(base: Column) -> Column:
    """Initials of two words or more without stopwords; else empty."""
    words = F.filter(F.split(base, " "), lambda t: (t != "") & ~F.array_contains(literals(rules.ACRONYM_STOPWORDS), t))
    return F.when(F.size(words) < 2, "").otherwise(F.array_join(F.transform(words, lambda t: F.substring(t, 1, 1)), ""))


def bare_name(name: Column) -> Column:
    return F.regexp_replace(name, "[^A-Z0-9]", "")


def invalid_seed_line(c: Column) -> Column:
    text = F.trim(c)
    return (text == "") | F.upper(text).isin([t for t in rules.CORRUPT_TOKENS if t]) | text.rlike(r"^\d+$")


def is_excel_error(c: Column) -> Column:
    return F.upper(F.trim(c)).isin(rules.EXCEL_ERRORS)


def is_date_like(c: Column) -> Column:
    months = "|".join(rules.MONTHS)
    return F.upper(F.trim(c)).rlike(rf"^(?:\d{{1,2}}-(?:{months})|(?:{months})-\d{{1,2}})$")


def seed_reason(c: Column) -> Column:
    """Why a seed is invalid; empty if it is not."""
    seed = normalize_whitespace(c)
    return F.when(seed == "", "missing_company_seed").when(is_excel_error(seed), "excel_error_token").when(is_date_like(seed), "date_like_token").otherwise("")


def is_reasonable_seed(c: Column) -> Column:
    seed = normalize_whitespace(c)
    return ~F.lower(seed).isin(rules.BAD_SEEDS) & ~seed.rlike(r"^\d{1,2}-[A-Za-z]{3}$") & ~seed.rlike(r"^\d+$") & (F.length(seed) > 1)


def joined_text(*parts: Column, limit: int = 12000) -> Column:
    """Parts that are not empty, normalised, joined by a space and cut to `limit` characters."""
    pieces = F.filter(F.array(*[normalize_whitespace(p) for p in parts]), lambda p: p != "")
    return F.substring(F.array_join(pieces, " "), 1, limit)


def seed_variants(c: Column) -> Column:
    """Distinct spellings of a seed that a dictionary looks for; see `rules.VARIANT_SUFFIXES`."""
    seed = normalize_whitespace(c)
    plain = normalize_whitespace(F.regexp_replace(seed, r"\([^)]*\)", ""))
    dotless = F.replace(seed, F.lit("."), F.lit(""))
    bases = F.array(seed, plain, dotless)
    bases = F.filter(F.array_distinct(bases), lambda b: b != "")
    ended = F.flatten(F.transform(bases, lambda b: F.transform(literals(rules.VARIANT_SUFFIXES), lambda s: F.concat(b, F.lit(" "), s))))
    own = F.array(seed, F.upper(seed), plain, F.upper(plain), F.replace(seed, F.lit("&"), F.lit(" and ")), dotless)
    every = F.transform(F.concat(own, ended), lambda v: normalize_whitespace(v))
    return F.filter(F.array_distinct(every), is_reasonable_seed)


SENTENCE_END = r"(?<=[.!?])\s+"


def sentences(text: Column) -> Column:
    """Sentences of a normalised text as array of struct(start, end, text), in characters."""

    def add(state: Column, part: Column) -> Column:
        end = state["at"] + F.length(part)
        return F.struct((end + 1).alias("at"), F.concat(state["spans"], F.array(F.struct(state["at"].alias("start"), end.alias("end"), part.alias("text")))).alias("spans"))

    none = F.array().cast("array<struct<start: int, end: int, text: string>>")
    spans = F.aggregate(F.split(text, SENTENCE_END), F.struct(F.lit(0).alias("at"), none.alias("spans")), add, lambda state: state["spans"])
    return F.filter(spans, lambda s: s["text"] != "")


def sentence_at(text: Column, place: Column) -> Column:
    """The sentence of a normalised text that holds the character at `place`; null if none does."""

    def go(state: Column, part: Column) -> Column:
        end = state["at"] + F.length(part)
        return F.struct((end + 1).alias("at"), F.when((state["at"] <= place) & (place < end), part).otherwise(state["text"]).alias("text"))

    return F.aggregate(F.split(text, SENTENCE_END), F.struct(F.lit(0).alias("at"), F.lit(None).cast("string").alias("text")), go, lambda state: state["text"])


def is_plausible_company(name: Column, source_type: Column) -> Column:
    """Whether a canonical name may stand for a company, given the source of its record."""
    blocked_parts, patterns, allowed = "|".join(re.escape(p) for p in rules.BLOCKED_PARTS), any_of(rules.PRODUCT_PATTERNS + rules.METADATA_PATTERNS), [n.upper() for n in rules.ALLOWED_NAMES]

    def judged(x: Column) -> Column:
        entity, upper = x["entity"], x["upper"]
        blocked = upper.isin(rules.BLOCKED_NAMES) | upper.rlike(blocked_parts) | upper.rlike(patterns)
        short = F.length(F.regexp_replace(entity, "[^A-Za-z0-9&]", "")) <= 2
        code = (x["source"] == "USPTO") & upper.rlike(r"^[A-Z0-9\-]{2,8}$") & ~upper.isin(rules.SHORT_CODES)
        return (entity != "") & (upper.isin(allowed) | ~(blocked | ~entity.rlike("[A-Za-z]") | short | code))

    # what is read often is worked out once
    entity = F.transform(F.array(normalize_whitespace(name)), lambda e: F.struct(e.alias("entity"), F.upper(e).alias("upper"), F.upper(F.coalesce(source_type, F.lit(""))).alias("source")))
    return F.get(F.transform(entity, judged), F.lit(0))


def has_negative_trigger(text: Column) -> Column:
    return F.lower(text).rlike(any_of(rules.NEGATIVE_TRIGGERS))


def is_boilerplate(text: Column) -> Column:
    return F.lower(text).rlike(any_of(rules.SEC_BOILERPLATE))


def is_patent_like(text: Column) -> Column:
    return F.lower(text).rlike(any_of(rules.PATENT_WORDS))


def has_joint_patent_signal(text: Column) -> Column:
    return F.lower(text).rlike(any_of(rules.JOINT_PATENT))


def has_soft_word(text: Column) -> Column:
    return F.lower(text).rlike("|".join(rules.SOFT_WORDS))


def detected_relation(text: Column, source_type: Column) -> Column:
    """struct(relation, trigger) of the first trigger that the source's list finds in
    the text; both empty if there is none or a negative trigger vetoes."""
    low = F.lower(text)

    def first_of(triggers: list[tuple[str, str]]) -> Column:
        out = F.struct(F.lit("").alias("relation"), F.lit("").alias("trigger"))
        for relation, pattern in reversed(triggers):
            out = F.when(low.rlike(pattern), F.struct(F.lit(relation).alias("relation"), F.regexp_extract(low, pattern, 0).alias("trigger"))).otherwise(out)
        return out

    source = F.upper(F.coalesce(source_type, F.lit("")))
    chosen = first_of(rules.ALL_TRIGGERS)
    for name, triggers in rules.TRIGGERS.items():
        chosen = F.when(source == name, first_of(triggers)).otherwise(chosen)
    return F.when(has_negative_trigger(low), F.struct(F.lit("").alias("relation"), F.lit("").alias("trigger"))).otherwise(chosen)
