"""A query per operator over the test tables, and the same in SQL.

The tables hold invented words, so company-like rows are derived from them by
expressions that both engines read alike; `BASES` are views for either.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpweave.functions import rules, text
from corpweave.functions.dates import month_year
from corpweave.operators import mentions, preprocess, relations, resolve
from corpweave.operators.components import connected_components
from corpweave.plans import pipeline
from corpweave.plans.ingest import numbered_records
from corpweave.sources import articles, filings, seeds
from corpweave.storage import written

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

# Views over the tables, in SQL that both engines take.  {x} is table or view x.
BASES = {
    # seeds of all shapes, one for each part
    "seed_lines": """SELECT p_partkey AS ord, CASE p_partkey % 16
        WHEN 0 THEN '  ' || p_name || ' Inc. ' WHEN 1 THEN '(' || p_name WHEN 2 THEN '.[ ' || p_name || ' Co., Ltd.' WHEN 3 THEN 'N/A'
        WHEN 4 THEN '#NAME?' WHEN 5 THEN CAST(p_size AS STRING) WHEN 6 THEN '' WHEN 7 THEN '11-JUL' WHEN 8 THEN upper(p_name) || '  ' || p_brand
        WHEN 9 THEN p_name || ' & ' || p_type WHEN 10 THEN p_name || ' (' || p_type || ')' WHEN 11 THEN 'tbd' WHEN 12 THEN 'X'
        WHEN 13 THEN CAST(p_size % 28 + 1 AS STRING) || '-May' WHEN 14 THEN NULL ELSE p_name END AS line FROM {part}""",
    # names with suffixes, brackets, signs and initials
    "raw_names": """SELECT p_partkey AS id, CASE p_partkey % 12
        WHEN 0 THEN p_name || ' Inc.' WHEN 1 THEN p_name || ' Corporation' WHEN 2 THEN upper(p_name) WHEN 3 THEN p_name || ' Co., Ltd.'
        WHEN 4 THEN p_name || ' & ' || p_type || ' LLC' WHEN 5 THEN p_name || ' (a ' || p_type || ' division) GmbH' WHEN 6 THEN upper(substr(p_name, 1, 1)) || upper(substr(p_type, 1, 1))
        WHEN 7 THEN p_name || ' of the ' || p_type WHEN 8 THEN 'Co' WHEN 9 THEN '--' WHEN 10 THEN p_name || ' ' || p_type ELSE p_name END AS name FROM {part}""",
    "records": """SELECT doc_id AS source_id, CASE doc_id % 10 WHEN 0 THEN 'SEC' WHEN 1 THEN ' edgar ' WHEN 2 THEN 'USPTO' WHEN 3 THEN 'PatentsView' WHEN 4 THEN 'PubMed'
        WHEN 5 THEN 'NCBI' WHEN 6 THEN ' sec ' WHEN 7 THEN 'blog' WHEN 8 THEN '' ELSE 'OpenCorporates' END AS source_type,
        CASE WHEN doc_id % 13 = 0 THEN '  ' WHEN doc_id % 17 = 0 THEN NULL ELSE text END AS raw_text,
        'http://example.org/' || CAST(doc_id AS STRING) AS source_url, CASE WHEN doc_id % 3 = 0 THEN 'Jan-24' ELSE '' END AS date,
        CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '#NAME?' WHEN 2 THEN '11-JUL' WHEN 3 THEN 'MAY-7' WHEN 4 THEN 'Acme   Corp' WHEN 5 THEN 'Beta' ELSE 'N/A' END AS company_seed FROM {documents}""",
    # mentions of names in records, some at one place twice
    "mention_rows": """SELECT p_partkey % 500 AS source_id, name AS raw_mention, p_size AS start_char, p_size + length(name) AS end_char
        FROM (SELECT p.p_partkey, p.p_size, r.name FROM {part} p JOIN {raw_names} r ON p.p_partkey = r.id) x""",
    # a sentence or two about two firms in each order
    "deals": """SELECT o.o_orderkey AS source_id, CASE o.o_orderkey % 6 WHEN 0 THEN 'SEC' WHEN 1 THEN 'PubMed' WHEN 2 THEN 'USPTO' WHEN 3 THEN 'EDGAR' WHEN 4 THEN 'sec' ELSE 'PUBMED' END AS source_type,
        'http://example.org/' || CAST(o.o_orderkey AS STRING) AS source_url, 'Mar-24' AS date, c.firm_a AS firm_a, c.firm_b AS firm_b,
        CASE o.o_orderkey % 16 WHEN 0 THEN ' acquired ' WHEN 1 THEN ' entered into an agreement with ' WHEN 2 THEN ' filed patent with assignees and ' WHEN 3 THEN ' worked with '
        WHEN 4 THEN ' is near ' WHEN 5 THEN ' licensed from ' WHEN 6 THEN ' reports community-acquired cases with ' WHEN 7 THEN ' was funded by one and two and '
        WHEN 8 THEN ' stands between ' WHEN 9 THEN ' files under forward-looking statements and acquired ' WHEN 10 THEN ' is joint assignee of a patent with ' WHEN 11 THEN ' merged with '
        WHEN 12 THEN ' developed with ' WHEN 13 THEN ' names common stock together ' WHEN 14 THEN ' and the inventor ' ELSE ' partnership ' END AS verb
        FROM {orders} o JOIN (SELECT c_custkey, 'Firm' || CAST(c_custkey % 90 AS STRING) || CASE WHEN c_custkey % 3 = 0 THEN ' Holdings' WHEN c_custkey % 3 = 1 THEN '' ELSE ' Labs Inc' END AS firm_a,
        CASE WHEN c_custkey % 11 = 0 THEN 'FDA' WHEN c_custkey % 13 = 0 THEN 'GSK' ELSE 'House' || CAST(c_nationkey AS STRING) || ' Company' END AS firm_b FROM {customer}) c ON o.o_custkey = c.c_custkey""",
    "deal_texts": """SELECT source_id, source_type, source_url, date, firm_a, firm_b, firm_a || verb || firm_b || '. The rest of it is plain.' AS raw_text, firm_a || verb || firm_b || '.' AS sentence, verb FROM {deals}""",
    "deal_mentions": """SELECT source_id, source_type, source_url, date, raw_text, firm_a AS canonical_name, 0 AS start_char, length(firm_a) AS end_char FROM {deal_texts}
        UNION ALL SELECT source_id, source_type, source_url, date, raw_text, firm_b AS canonical_name, length(firm_a || verb) AS start_char, length(firm_a || verb || firm_b) AS end_char FROM {deal_texts}""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base as a DataFrame."""
    needs = {n: view(spark, sf_dir, n) for n in BASES if "{" + n + "}" in BASES[name]} if name in BASES else {}
    if name not in BASES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    needs |= {t: view(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in BASES[name]}
    return spark.sql(BASES[name], **needs)


def sql_with(query: str) -> str:
    """A query over bases as SQL that names its own views."""
    wanted: list[str] = []

    def need(text_: str) -> None:
        for name in BASES:
            if "{" + name + "}" in text_ and name not in wanted:
                need(BASES[name])
                wanted.append(name)

    need(query)

    def plain(text_: str) -> str:
        for name in [*BASES, *TABLES]:
            text_ = text_.replace("{" + name + "}", name)
        return text_

    views = ", ".join(f"{name} AS ({plain(BASES[name])})" for name in wanted)
    body = plain(query)
    if body.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {views}, {body.removeprefix('WITH RECURSIVE ')}"
    if body.startswith("WITH "):
        return f"WITH {views}, {body.removeprefix('WITH ')}"
    return f"WITH {views} {body}" if views else body


# --- SQL for the expressions ---------------------------------------------------
_WHITE = r"[\s\x0b\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _list(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _alt(patterns: list[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def q_ws(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{_WHITE}+', ' ', 'g'))"


def q_source(x: str) -> str:
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in rules.SOURCE_ALIASES.items())
    return f"CASE upper({q_ws(x)}) {cases} ELSE upper({q_ws(x)}) END"


def q_clean(x: str) -> str:
    w = q_ws(x)
    return f"CASE WHEN {x} IS NULL OR upper({w}) IN ({_list(rules.CORRUPT_TOKENS)}) OR upper({w}) = '11-JUL' OR {w} LIKE '#%' THEN NULL ELSE {w} END"


def q_name(x: str) -> str:
    amp = f"replace(upper({q_ws(x)}), '&', ' AND ')"
    bare = rf"regexp_replace(regexp_replace({amp}, '\([^)]*\)', ' ', 'g'), '[^A-Z0-9\s]', ' ', 'g')"
    return q_ws(bare)


_SUFFIXES = "|".join(rules.NAME_SUFFIXES)


def q_base(n: str) -> str:
    return rf"trim(regexp_replace({n}, '(?:(?:^| )(?:{_SUFFIXES}))+$', ''))"


def q_suffixes(n: str) -> str:
    return rf"replace(trim(regexp_extract({n}, '(?:(?:^| )(?:{_SUFFIXES}))+$')), ' ', ';')"


def q_acronym(b: str) -> str:
    words = f"list_filter(string_split({b}, ' '), lambda t: t <> '' AND t NOT IN ({_list(rules.ACRONYM_STOPWORDS)}))"
    return f"CASE WHEN len({words}) < 2 THEN '' ELSE array_to_string(list_transform({words}, lambda t: substr(t, 1, 1)), '') END"


def q_excel(x: str) -> str:
    return f"upper(trim({x})) IN ({_list(rules.EXCEL_ERRORS)})"


def q_date_like(x: str) -> str:
    months = "|".join(rules.MONTHS)
    return rf"regexp_matches(upper(trim({x})), '^(?:\d{{1,2}}-(?:{months})|(?:{months})-\d{{1,2}})$')"


def q_seed_reason(x: str) -> str:
    w = q_ws(x)
    return f"CASE WHEN {w} = '' THEN 'missing_company_seed' WHEN {q_excel(w)} THEN 'excel_error_token' WHEN {q_date_like(w)} THEN 'date_like_token' ELSE '' END"


def q_reasonable(x: str) -> str:
    w = q_ws(x)
    return rf"(lower({w}) NOT IN ({_list(rules.BAD_SEEDS)}) AND NOT regexp_matches({w}, '^\d{{1,2}}-[A-Za-z]{{3}}$') AND NOT regexp_matches({w}, '^\d+$') AND length({w}) > 1)"


def q_reasons() -> str:
    s = q_source("source_type")
    return f"""concat_ws(';', CASE WHEN {q_ws("raw_text")} = '' THEN 'missing_raw_text' END,
        CASE WHEN {s} = '' THEN 'missing_source_type' WHEN {s} NOT IN ({_list(rules.VALID_SOURCES)}) THEN 'unknown_source_type' END, nullif({q_seed_reason("company_seed")}, ''))"""


def q_plausible(n: str, s: str) -> str:
    e = q_ws(n)
    u = f"upper({e})"
    parts = " OR ".join(f"contains({u}, '{p}')" for p in rules.BLOCKED_PARTS)
    return rf"""({e} <> '' AND ({u} IN ({_list([a.upper() for a in rules.ALLOWED_NAMES])}) OR NOT ({u} IN ({_list(rules.BLOCKED_NAMES)}) OR {parts}
        OR regexp_matches({u}, '{_alt(rules.PRODUCT_PATTERNS + rules.METADATA_PATTERNS)}') OR NOT regexp_matches({e}, '[A-Za-z]')
        OR length(regexp_replace({e}, '[^A-Za-z0-9&]', '', 'g')) <= 2
        OR (upper({s}) = 'USPTO' AND regexp_matches({u}, '^[A-Z0-9\-]{{2,8}}$') AND {u} NOT IN ({_list(rules.SHORT_CODES)})))))"""


def q_detect(t: str, s: str, what: str) -> str:
    low = f"lower({t})"

    def chain(triggers: list[tuple[str, str]]) -> str:
        cases = " ".join(f"WHEN regexp_matches({low}, '{p}') THEN " + (f"'{r}'" if what == "relation" else f"regexp_extract({low}, '{p}', 0)") for r, p in triggers)
        return f"CASE {cases} ELSE '' END"

    by_source = " ".join(f"WHEN upper(coalesce({s}, '')) = '{name}' THEN {chain(t_)}" for name, t_ in rules.TRIGGERS.items())
    return f"CASE WHEN regexp_matches({low}, '{_alt(rules.NEGATIVE_TRIGGERS)}') THEN '' {by_source} ELSE {chain(rules.ALL_TRIGGERS)} END"


# --- queries --------------------------------------------------------------------
Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql is not None:
            SQL[name] = sql_with(sql)
        return f

    return add


_ODD = "replace(text, ' ', CASE doc_id % 4 WHEN 0 THEN '   ' WHEN 1 THEN ' ' WHEN 2 THEN '\u001c' ELSE '  ' END)"
BASES["odd_texts"] = "SELECT doc_id, " + _ODD + " AS text FROM {documents}"


@query("whitespace_normalize", f"SELECT doc_id, {q_ws('text')} AS normalized FROM {{odd_texts}}")
def whitespace_normalize(spark, sf):
    return view(spark, sf, "odd_texts").select("doc_id", text.normalize_whitespace(F.col("text")).alias("normalized"))


@query("source_type_normalize", f"SELECT source_id, {q_source('source_type')} AS source_type_cleaned FROM {{records}}")
def source_type_normalize(spark, sf):
    return view(spark, sf, "records").select("source_id", text.normalize_source_type(F.col("source_type")).alias("source_type_cleaned"))


@query("corrupt_value", f"SELECT ord, {q_clean('line')} AS cleaned FROM {{seed_lines}}")
def corrupt_value(spark, sf):
    return view(spark, sf, "seed_lines").select("ord", text.clean_corrupted(F.col("line")).alias("cleaned"))


_INGEST = f"trim(regexp_replace({q_clean('trim(line)')}, '^(?:[.{{(\\[]|{_WHITE})+', ''))"
_INGEST_OK = f"s IS NOT NULL AND s <> '' AND upper(s) NOT IN ({_list(rules.CORRUPT_TOKENS)}) AND NOT regexp_matches(s, '^\\d+$')"


@query("seed_scan_clean", f"SELECT s AS seed, min(ord) AS ord FROM (SELECT ord, {_INGEST} AS s FROM {{seed_lines}}) x WHERE {_INGEST_OK} GROUP BY s")
def seed_scan_clean(spark, sf):
    return seeds.ingest_seeds(view(spark, sf, "seed_lines"))


@query("seed_reasonable", f"SELECT {q_ws('line')} AS seed, ord FROM {{seed_lines}} WHERE {q_reasonable('line')}")
def seed_reasonable(spark, sf):
    return seeds.dictionary_seeds(view(spark, sf, "seed_lines"))


_UNMARKED = "regexp_replace(upper(name), '[,.;:()/-]+', ' ', 'g')"
_LOOKUP = f"array_to_string(list_filter(string_split({q_ws(_UNMARKED)}, ' '), lambda t: t NOT IN ({_list(rules.LOOKUP_SUFFIXES)})), ' ')"


@query("lookup_canonical", f"SELECT id, nullif({_LOOKUP}, '') AS lookup_name FROM {{raw_names}}")
def lookup_canonical(spark, sf):
    return view(spark, sf, "raw_names").select("id", text.lookup_name(F.col("name")).alias("lookup_name"))


@query("company_normalize", f"SELECT id, {q_name('name')} AS normalized_name FROM {{raw_names}}")
def company_normalize(spark, sf):
    return view(spark, sf, "raw_names").select("id", text.company_name(F.col("name")).alias("normalized_name"))


@query("suffix_split", f"SELECT id, {q_base('n')} AS base_name, {q_suffixes('n')} AS legal_suffixes FROM (SELECT id, {q_name('name')} AS n FROM {{raw_names}}) x")
def suffix_split(spark, sf):
    n = text.company_name(F.col("name"))
    return view(spark, sf, "raw_names").select("id", n.alias("n")).select("id", text.base_name(F.col("n")).alias("base_name"), text.legal_suffixes(F.col("n")).alias("legal_suffixes"))


@query("acronym", f"SELECT id, {q_acronym('b')} AS acronym, regexp_replace(n, '[^A-Z0-9]', '', 'g') AS bare FROM (SELECT id, n, {q_base('n')} AS b FROM (SELECT id, {q_name('name')} AS n FROM {{raw_names}}) x) y")
def acronym(spark, sf):
    df = view(spark, sf, "raw_names").select("id", text.company_name(F.col("name")).alias("n"))
    return df.select("id", text.acronym(text.base_name(F.col("n"))).alias("acronym"), text.bare_name(F.col("n")).alias("bare"))


BASES["date_texts"] = """SELECT o_orderkey, y, m, d, o_orderkey % 8 AS kind, CASE o_orderkey % 8 WHEN 0 THEN mon || '-' || substr(y, 3, 2) WHEN 1 THEN upper(mon) || '-' || y WHEN 2 THEN y || '-' || m || '-' || d
    WHEN 3 THEN y || '/' || m || '/' || d WHEN 4 THEN m || '/' || d || '/' || y WHEN 5 THEN y WHEN 6 THEN '11-JUL' ELSE m || '-' || y END AS t, mon FROM (SELECT o_orderkey, CAST(year(o_orderdate) AS STRING) AS y,
    CAST(month(o_orderdate) AS STRING) AS m, CAST(day(o_orderdate) AS STRING) AS d, substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(month(o_orderdate) AS INT) * 3 - 2, 3) AS mon FROM {orders}) x"""


@query("date_mon_yy", "SELECT o_orderkey, CASE WHEN kind IN (5, 6) THEN NULL ELSE mon || '-' || substr(y, 3, 2) END AS month_year FROM {date_texts}")
def date_mon_yy(spark, sf):
    return view(spark, sf, "date_texts").select("o_orderkey", month_year(F.col("t")).alias("month_year"))


_PIECES = ", ".join(f"nullif({q_ws(c)}, '')" for c in ("source", "text", "lang"))
_JOINED = f"concat_ws(' ', {_PIECES})"


@query("build_raw_text", f"SELECT doc_id, substr({q_ws(_JOINED)}, 1, 12000) AS raw_text, substr(text, 1, 500) AS evidence FROM {{documents}}")
def build_raw_text(spark, sf):
    return view(spark, sf, "documents").select("doc_id", text.joined_text(F.col("source"), F.col("text"), F.col("lang")).alias("raw_text"), F.substring("text", 1, 500).alias("evidence"))


@query("seed_class", f"SELECT ord, {q_seed_reason('line')} AS reason FROM {{seed_lines}}")
def seed_class(spark, sf):
    return view(spark, sf, "seed_lines").select("ord", text.seed_reason(F.col("line")).alias("reason"))


@query("row_invalid_reasons", f"SELECT source_id, {q_reasons()} AS row_invalid_reasons FROM {{records}}")
def row_invalid_reasons(spark, sf):
    return preprocess.validated(view(spark, sf, "records")).select("source_id", "row_invalid_reasons")


_CLEAN_COLS = f"source_id, {q_source('source_type')} AS source_type_cleaned, {q_ws('raw_text')} AS raw_text_cleaned, {q_ws('company_seed')} AS company_seed_cleaned, {q_reasons()} AS row_invalid_reasons"


@query("valid_rows", f"SELECT * FROM (SELECT {_CLEAN_COLS} FROM {{records}}) x WHERE row_invalid_reasons = ''")
def valid_rows(spark, sf):
    return preprocess.split(view(spark, sf, "records"))[0].select("source_id", "source_type_cleaned", "raw_text_cleaned", "company_seed_cleaned", "row_invalid_reasons")


@query("invalid_rows", f"SELECT * FROM (SELECT {_CLEAN_COLS} FROM {{records}}) x WHERE row_invalid_reasons <> ''")
def invalid_rows(spark, sf):
    return preprocess.split(view(spark, sf, "records"))[1].select("source_id", "source_type_cleaned", "raw_text_cleaned", "company_seed_cleaned", "row_invalid_reasons")


@query("preprocess_summary", f"SELECT row_invalid_reasons, count(*) AS n_rows FROM (SELECT {q_reasons()} AS row_invalid_reasons FROM {{records}}) x GROUP BY row_invalid_reasons")
def preprocess_summary(spark, sf):
    return preprocess.summary(view(spark, sf, "records"))


# --- sources --------------------------------------------------------------------
BASES["form_rows"] = "SELECT l_orderkey, l_linenumber, CASE l_linenumber % 5 WHEN 0 THEN '10-K' WHEN 1 THEN '8-K' WHEN 2 THEN 'S-1' WHEN 3 THEN '10-Q' ELSE '4' END AS form, CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS acc FROM {lineitem} WHERE l_linenumber >= 0"


@query("form_item_code", "SELECT l_orderkey, l_linenumber, form, CASE WHEN form IN ('10-K', 'S-1') THEN '1A' WHEN form = '10-Q' THEN 'part2item1a' END AS item FROM {form_rows}")
def form_item_code(spark, sf):
    return view(spark, sf, "form_rows").select("l_orderkey", "l_linenumber", "form", filings.item_code(F.col("form")).alias("item"))


def submissions_landed(spark, sf):
    """A submissions response for each order: parallel lists, one of them shorter for some."""
    rows = view(spark, sf, "form_rows").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "form", "acc"))).alias("f"))
    short = F.when(F.col("l_orderkey") % 3 == 0, F.size("f") - 1).otherwise(F.size("f"))
    recent = F.struct(
        F.transform("f", lambda f: f["form"]).alias("form"), F.transform("f", lambda f: f["acc"]).alias("accessionNumber"),
        F.slice(F.transform("f", lambda f: F.lit("d.htm")), F.lit(1), short).alias("primaryDocument"), F.transform("f", lambda f: F.lit("2024-01-01")).alias("filingDate"),
    )
    body = F.to_json(F.struct(F.col("l_orderkey").cast("string").alias("cik"), F.struct(recent.alias("recent")).alias("filings")))
    return rows.select(F.col("l_orderkey").alias("seed"), body.alias("body"))


@query("filings_zip_limit", """SELECT lpad(CAST(l_orderkey AS STRING), 10, '0') AS cik, form, acc AS accession, 'https://www.sec.gov/Archives/edgar/data/' || CAST(l_orderkey AS STRING) || '/' || replace(acc, '-', '') || '/d.htm' AS url, CAST(place AS BIGINT) AS place FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY i) - 1 AS place FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, form, acc) AS i, count(*) OVER (PARTITION BY l_orderkey) AS n FROM {form_rows}) x
    WHERE i <= n - CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE 0 END AND form IN ('10-K', '8-K', 'S-1')) y WHERE place < 2""")  # fmt: skip
def filings_zip_limit(spark, sf):
    found = filings.recent_filings(submissions_landed(spark, sf), ["10-K", "8-K", "S-1"], 2)
    return found.select("cik", "form", "accession", "url", F.col("place").cast("long").alias("place"))


BASES["title_rows"] = "SELECT s_suppkey AS ord, upper(CASE WHEN s_suppkey % 2 = 0 THEN s_name || ' Corp' ELSE s_name END) AS title, CAST(s_suppkey + 100 AS STRING) AS cik FROM {supplier}"
BASES["cik_seeds"] = "SELECT DISTINCT CASE WHEN c_custkey % 2 = 0 THEN 'supplier#' || lpad(CAST(c_custkey AS STRING), 9, '0') ELSE 'The Supplier#' || lpad(CAST(c_custkey AS STRING), 9, '0') || ' Corp Group' END AS seed FROM {customer}"


@query("cik_first_match", "SELECT seed, min_by(lpad(cik, 10, '0'), ord) AS cik FROM {cik_seeds} JOIN {title_rows} ON contains(title, upper(seed)) OR contains(upper(seed), title) GROUP BY seed")
def cik_first_match(spark, sf):
    rows = view(spark, sf, "title_rows").select("ord", F.lpad("cik", 10, "0").alias("cik"), "title")
    return filings.matched_cik(view(spark, sf, "cik_seeds"), rows)


@query("tickers_parse", "SELECT CAST(s_suppkey AS STRING) AS seed, lpad(CAST(s_suppkey + 7 AS STRING), 10, '0') AS cik, upper(s_name) AS title FROM {supplier}")
def tickers_parse(spark, sf):
    rows = view(spark, sf, "supplier")
    body = F.to_json(F.create_map(F.lit("0"), F.struct((F.col("s_suppkey") + 7).alias("cik_str"), F.lit("T").alias("ticker"), F.col("s_name").alias("title"))))
    landed = rows.select(F.col("s_suppkey").cast("string").alias("seed"), body.alias("body"))
    one = landed.select("seed", F.posexplode(F.from_json("body", filings.TICKERS)).alias("ord", "key", "row"))
    return one.select("seed", F.lpad(F.col("row.cik_str").cast("string"), 10, "0").alias("cik"), F.upper("row.title").alias("title"))


@query("id_search_parse", "SELECT CAST(c_custkey AS STRING) AS seed, CAST(i AS BIGINT) AS place, CAST(c_custkey * 10 + i AS STRING) AS pmid FROM {customer} CROSS JOIN (SELECT unnest([0, 1, 2]) AS i) n WHERE i < c_custkey % 4 AND i < 2")
def id_search_parse(spark, sf):
    ids = F.filter(F.array(*[F.lit(i) for i in range(3)]), lambda i: i < F.col("c_custkey") % 4)
    body = F.to_json(F.struct(F.struct(F.transform(ids, lambda i: (F.col("c_custkey") * 10 + i).cast("string")).alias("idlist")).alias("esearchresult")))
    landed = view(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("seed"), body.alias("body"))
    return articles.article_ids(landed, 2).select("seed", F.col("place").cast("long").alias("place"), "pmid")


@query("registry_lookup", "SELECT 'c' || CAST(c_custkey AS STRING) AS seed, CASE WHEN c_custkey % 3 = 0 THEN 'c' || CAST(c_custkey AS STRING) ELSE c_name END AS lookup_name FROM {customer}")
def registry_lookup(spark, sf):
    rows = view(spark, sf, "customer").withColumn("seed", F.concat(F.lit("c"), F.col("c_custkey").cast("string")))
    hit = F.concat(F.lit('{"results":{"companies":[{"company":{"name":"'), F.col("c_name"), F.lit('","jurisdiction_code":"us"}},{"company":{"name":"other"}}]}}'))
    landed = rows.select("seed", F.when(F.col("c_custkey") % 3 == 0, '{"results":{"companies":[]}}').otherwise(hit).alias("body"))
    return articles.lookup_seeds(rows.select("seed"), articles.registered(landed))


@query("json_extract", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM {events}")
def json_extract(spark, sf):
    return view(spark, sf, "events").select("event_id", F.from_json("props", "struct<k: long>")["k"].alias("k"))


@query("xml_patent_parse", """SELECT CAST(o_orderkey AS STRING) AS seed, 'Assignor: ' || c_name || ' Assignee: A&B ' || o_orderpriority || ' Patent/Application: ' || CAST(o_orderkey AS STRING) || ' Execution date: 2020-01-02 Recorded date:' || CASE WHEN o_orderkey % 2 = 0 THEN ' 2021-03-04' ELSE '' END AS raw_text,
    'https://assignmentcenter.uspto.gov/' || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '#!/patent/search/resultAbstract?reelFrame=' || CAST(o_orderkey AS STRING) || ':7' END AS url, CASE WHEN o_orderkey % 2 = 0 THEN '2021-03-04' ELSE '2020-01-02' END AS date FROM {orders} JOIN {customer} ON o_custkey = c_custkey""")  # fmt: skip
def xml_patent_parse(spark, sf):
    rows = view(spark, sf, "orders").join(view(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    key = F.col("o_orderkey").cast("string")
    body = F.concat(
        F.lit("<response><result><doc><Assignor> "), F.col("c_name"), F.lit("</Assignor><assignee>A&amp;B "), F.col("o_orderpriority"), F.lit("</assignee>"),
        F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("<patentNumber></patentNumber><applicationNumber>"), key, F.lit("</applicationNumber>"))).otherwise(F.concat(F.lit("<patentNumber>"), key, F.lit("</patentNumber>"))),
        F.lit("<executionDate>2020-01-02</executionDate>"), F.when(F.col("o_orderkey") % 2 == 0, "<recordedDate>2021-03-04</recordedDate>").otherwise("<recordedDate/>"),
        F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.concat(F.lit("<reelNo>"), key, F.lit("</reelNo>"))), F.lit("<frameNo>7</frameNo></doc></result></response>"),
    )
    return articles.assignments(rows.select(key.alias("seed"), body.alias("body"))).select("seed", "raw_text", "url", "date")


@query("xml_article_parse", """SELECT CAST(doc_id AS STRING) AS seed, CAST(doc_id AS STRING) AS pmid, 'On ' || source AS title, 'first part of ' || lang || ' second <end>' AS abstract, CASE WHEN doc_id % 3 = 0 THEN '2023' ELSE 'Jul-2023' END AS date,
    'https://pubmed.ncbi.nlm.nih.gov/' || CAST(doc_id AS STRING) || '/' AS url, 'On ' || source || ' first part of ' || lang || ' second <end>' AS raw_text FROM {documents}""")  # fmt: skip
def xml_article_parse(spark, sf):
    key = F.col("doc_id").cast("string")
    body = F.concat(
        F.lit("<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>"), key, F.lit("</PMID><Article><Journal><JournalIssue><PubDate><Year>2023</Year>"), F.when(F.col("doc_id") % 3 == 0, "").otherwise("<Month>Jul</Month>"),
        F.lit("</PubDate></JournalIssue></Journal><ArticleTitle>On "), F.col("source"), F.lit(" <i>x</i> more</ArticleTitle><Abstract><AbstractText Label='A'>first <b>part</b> of "), F.col("lang"),
        F.lit("</AbstractText><AbstractText> second &lt;end&gt; </AbstractText></Abstract></Article></MedlineCitation></PubmedArticle></PubmedArticleSet>"),
    )
    return articles.articles(view(spark, sf, "documents").select(key.alias("seed"), body.alias("body")))


@query("filing_html_text", "SELECT item_id, substr('Head ' || trim(replace(text, chr(10), ' ')) || ' tail & end', 1, 20000) AS text FROM {benchmark}")
def filing_html_text(spark, sf):
    body = F.concat(F.lit("<html><head></head><body><h1> Head </h1><p>"), F.replace("text", F.lit("\n"), F.lit(" ")), F.lit("</p><p> tail &amp; end</p></body></html>"))
    landed = view(spark, sf, "benchmark").select("item_id", body.alias("body"), F.lit("text/plain").alias("content_type"))
    return filings.filing_text(landed).select("item_id", "text")


@query("page_html_text")
def page_html_text(spark, sf):
    landed = view(spark, sf, "pages").select("page_id", F.col("html").alias("body"), F.lit("text/html").alias("content_type"))
    return filings.filing_text(landed).select("page_id", "text")


BASES["source_rows"] = "SELECT o_orderkey, 'c' || CAST(o_custkey AS STRING) AS seed, CAST(o_custkey AS BIGINT) AS ord, o_orderkey % 3 AS source_rank, o_orderkey AS place, '  ' || o_orderpriority || '  text ' AS raw_text, 'u' || CAST(o_orderkey AS STRING) AS url, '2024-05-0' || CAST(o_orderkey % 9 + 1 AS STRING) AS date FROM {orders}"


@query("ingest_union_ids", "SELECT row_number() OVER (ORDER BY ord, source_rank, place) AS source_id, CASE source_rank WHEN 0 THEN 'USPTO' WHEN 1 THEN 'PUBMED' ELSE 'SEC' END AS source_type, trim(replace(raw_text, '  ', ' ')) AS raw_text, url AS source_url, 'May-24' AS date, seed AS company_seed FROM {source_rows}")
def ingest_union_ids(spark, sf):
    rows = view(spark, sf, "source_rows")
    by = {s: rows.filter(F.col("source_rank") == i) for i, s in enumerate(["USPTO", "PUBMED", "SEC"])}
    return numbered_records(rows.select("seed", "ord").distinct(), by)


# --- dictionary and mentions ------------------------------------------------------
def _q_variants(s: str) -> str:
    plain, dotless = q_ws(rf"regexp_replace({s}, '\([^)]*\)', '', 'g')"), q_ws(f"replace({s}, '.', '')")
    ended = f"flatten(list_transform(list_filter([{s}, {plain}, {dotless}], lambda b: b <> ''), lambda b: list_transform([{_list(rules.VARIANT_SUFFIXES)}], lambda x: b || ' ' || x)))"
    spelled = q_ws(f"replace({s}, '&', ' and ')")
    own = f"[{s}, upper({s}), {plain}, upper({plain}), {spelled}, {dotless}]"
    return f"list_concat({own}, {ended})"


_GOOD = f"SELECT DISTINCT {q_ws('line')} AS s FROM {{seed_lines}} WHERE {q_reasonable('line')}"
_VARIANTS = f"SELECT DISTINCT s AS seed, v AS variant FROM (SELECT s, unnest({_q_variants('s')}) AS v FROM ({_GOOD}) x) y WHERE {q_reasonable('v')}"


@query("seed_variants", _VARIANTS)
def seed_variants(spark, sf):
    good = seeds.dictionary_seeds(view(spark, sf, "seed_lines")).select("seed").distinct()
    return good.select("seed", F.explode(text.seed_variants(F.col("seed"))).alias("variant"))


@query("ruler_patterns", f"SELECT 'ORG' AS label, min(variant) AS pattern, lower(variant) AS pattern_lower FROM ({_VARIANTS}) z GROUP BY lower(variant)")
def ruler_patterns(spark, sf):
    return mentions.patterns(seeds.dictionary_seeds(view(spark, sf, "seed_lines"))).select("label", "pattern", "pattern_lower")


@query("dictionary_mentions", """SELECT source_id, firm_a AS raw_mention, 0 AS start_char, CAST(length(firm_a) AS INT) AS end_char FROM {deal_texts}
    UNION ALL SELECT source_id, firm_b, CAST(length(firm_a || verb) AS INT), CAST(length(firm_a || verb || firm_b) AS INT) FROM {deal_texts} WHERE firm_b <> 'FDA'""")  # fmt: skip
def dictionary_mentions(spark, sf):
    deals = view(spark, sf, "deal_texts")
    names = deals.select(F.explode(F.array("firm_a", "firm_b")).alias("seed")).filter("seed <> 'FDA'").distinct()
    return mentions.found_mentions(deals, mentions.patterns(names), "source_id", "raw_text")


@query("mention_dedupe", "SELECT source_id, start_char, end_char, min(raw_mention) AS raw_mention FROM {mention_rows} GROUP BY source_id, start_char, end_char, lower(trim(raw_mention))")
def mention_dedupe(spark, sf):
    rows = view(spark, sf, "mention_rows").withColumn("source_type", F.lit(""))
    return mentions.deduplicated(rows).select("source_id", "start_char", "end_char", "raw_mention")


# --- alias resolution -------------------------------------------------------------
_NAMED = f"SELECT source_id, {q_ws('raw_mention')} AS raw_mention, start_char, end_char, {q_name('raw_mention')} AS name FROM {{mention_rows}}"
_NAMES = f"SELECT name, base, regexp_replace(name, '[^A-Z0-9]', '', 'g') AS bare, {q_acronym("CASE WHEN base <> '' THEN base ELSE name END")} AS short FROM (SELECT DISTINCT name, {q_base('name')} AS base FROM ({_NAMED}) n WHERE name <> '') d"
_BASE_EDGES = f"SELECT a.name AS src, h.head AS dst FROM ({_NAMES}) a JOIN (SELECT base, min(name) AS head FROM ({_NAMES}) b WHERE base <> '' GROUP BY base) h ON a.base = h.base WHERE a.name <> h.head"
_ACRONYM_EDGES = f"SELECT DISTINCT a.name AS src, b.name AS dst FROM ({_NAMES}) a JOIN ({_NAMES}) b ON length(a.bare) >= 2 AND a.bare = b.short AND a.name <> b.name"
_COMPONENTS = f"""WITH RECURSIVE names AS ({_NAMES}), edges AS ({_BASE_EDGES} UNION ALL {_ACRONYM_EDGES}), both_ways AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges),
    reach(name, other) AS (SELECT name, name FROM names UNION SELECT r.name, e.dst FROM reach r JOIN both_ways e ON r.other = e.src), leaders AS (SELECT name, min(other) AS leader FROM reach GROUP BY name)"""


def _mentions(spark, sf):
    return view(spark, sf, "mention_rows")


@query("distinct_mentions", f"SELECT name AS normalized_name, count(DISTINCT raw_mention) AS n_spellings FROM ({_NAMED}) x WHERE name <> '' GROUP BY name")
def distinct_mentions(spark, sf):
    return resolve.spellings(_mentions(spark, sf)).groupBy("normalized_name").agg(F.count("*").alias("n_spellings"))


@query("base_edges", _BASE_EDGES)
def base_edges(spark, sf):
    return resolve.base_edges(resolve.distinct_names(_mentions(spark, sf)))


@query("acronym_edges", _ACRONYM_EDGES)
def acronym_edges(spark, sf):
    return resolve.acronym_edges(resolve.distinct_names(_mentions(spark, sf)))


@query("components", f"{_COMPONENTS} SELECT leader, count(*) AS n_names FROM leaders GROUP BY leader")
def components(spark, sf):
    names = written(resolve.distinct_names(_mentions(spark, sf)), "names")
    return resolve.groups(names, resolve.merge_edges(names, None)).select("leader", F.col("n_names")).distinct()


_CANON = f"""{_COMPONENTS}, counted AS (SELECT l.leader, m.raw_mention, count(*) AS n FROM ({_NAMED}) m JOIN leaders l ON m.name = l.name GROUP BY l.leader, m.raw_mention),
    canon AS (SELECT leader, raw_mention AS canonical_name FROM (SELECT *, row_number() OVER (PARTITION BY leader ORDER BY n DESC, length(raw_mention) DESC, raw_mention DESC) AS i FROM counted) c WHERE i = 1)"""


@query("canonical_names", f"{_CANON} SELECT leader, canonical_name FROM canon")
def canonical_names(spark, sf):
    rows = written(resolve.named(_mentions(spark, sf)), "named")
    names = written(resolve.distinct_names(rows), "names")
    placed = resolve.groups(names, resolve.merge_edges(names, None))
    return resolve.canonical_names(rows.join(placed.select(F.col("name").alias("normalized_name"), "leader"), "normalized_name"))


@query("resolved_entities", f"""{_CANON}, sizes AS (SELECT leader, count(*) AS n_names FROM leaders GROUP BY leader) SELECT m.source_id, m.raw_mention, m.start_char, m.name AS normalized_name, {q_base('m.name')} AS base_name, {q_suffixes('m.name')} AS legal_suffixes,
    coalesce(c.canonical_name, m.raw_mention) AS canonical_name, CASE WHEN s.n_names > 1 THEN 0.9::DOUBLE ELSE 1.0::DOUBLE END AS merge_confidence, CASE WHEN s.n_names > 1 THEN 'auto_merge' ELSE 'singleton' END AS merge_decision
    FROM ({_NAMED}) m LEFT JOIN leaders l ON m.name = l.name LEFT JOIN canon c ON l.leader = c.leader LEFT JOIN sizes s ON l.leader = s.leader""")  # fmt: skip
def resolved_entities(spark, sf):
    rows, _ = resolve.resolved(_mentions(spark, sf), with_similarity=False)
    return rows.select("source_id", "raw_mention", "start_char", "normalized_name", "base_name", "legal_suffixes", "canonical_name", "merge_confidence", "merge_decision")


BASES["near_names"] = "SELECT c_custkey AS source_id, CASE c_custkey % 4 WHEN 0 THEN 'House of ' WHEN 1 THEN 'Houses of ' WHEN 2 THEN 'US House of ' ELSE 'The House of ' END || substr(md5(CAST(c_custkey - c_custkey % 4 AS STRING)), 1, 9) || CASE c_custkey % 5 WHEN 0 THEN ' Inc' ELSE '' END AS raw_mention, 0 AS start_char, 5 AS end_char FROM {customer} WHERE c_custkey >= 0"


@query("similarity_pairs")
def similarity_pairs(spark, sf):
    return resolve.similarity_pairs(written(resolve.distinct_names(view(spark, sf, "near_names")), "names"), 0.86)


@query("pair_rule_counts")
def pair_rule_counts(spark, sf):
    judged = resolve.judged_pairs(written(resolve.distinct_names(view(spark, sf, "near_names")), "names"))
    return judged.groupBy("decision", "reason").agg(F.count("*").alias("n_pairs"))


@query("review_queue")
def review_queue(spark, sf):
    return resolve.resolved(view(spark, sf, "near_names"))[1]


# --- relations ----------------------------------------------------------------------
BASES["mail"] = "SELECT item_id, text || ' U.S. rules! Ok? Yes.' AS text FROM {benchmark}"
_MARKED = "string_split(regexp_replace({x}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))"


@query("sentence_spans", f"""SELECT item_id, CAST(i - 1 AS INT) AS place, parts[i] AS sentence, CAST(length(array_to_string(parts[1:i - 1], ' ')) + CASE WHEN i > 1 THEN 1 ELSE 0 END AS INT) AS start_char
    FROM (SELECT item_id, parts, unnest(generate_series(1, len(parts))) AS i FROM (SELECT item_id, {_MARKED.replace('{x}', q_ws('text'))} AS parts FROM {{mail}}) x) y WHERE parts[i] <> ''""")  # fmt: skip
def sentence_spans(spark, sf):
    rows = view(spark, sf, "mail").select("item_id", F.posexplode(text.sentences(text.normalize_whitespace(F.col("text")))).alias("place", "s"))
    return rows.select("item_id", "place", F.col("s.text").alias("sentence"), F.col("s.start").alias("start_char"))


@query("sentence_assign", "SELECT source_id, start_char, CASE WHEN start_char >= 0 THEN sentence ELSE raw_text END AS sentence_text FROM (SELECT t.source_id, t.sentence, t.raw_text, m.start_char FROM {deal_texts} t JOIN {deal_mentions} m ON t.source_id = m.source_id) x")
def sentence_assign(spark, sf):
    return relations.with_sentence(view(spark, sf, "deal_mentions")).select("source_id", "start_char", "sentence_text")


@query("detect_relation", f"SELECT source_id, {q_detect('sentence', 'source_type', 'relation')} AS relation, {q_detect('sentence', 'source_type', 'trigger')} AS trigger_phrase FROM {{deal_texts}}")
def detect_relation(spark, sf):
    found = text.detected_relation(F.col("sentence"), F.col("source_type"))
    return view(spark, sf, "deal_texts").select("source_id", found.alias("f")).select("source_id", "f.relation", F.col("f.trigger").alias("trigger_phrase"))


BASES["entity_rows"] = "SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN 'Company' WHEN 1 THEN 'GSK' WHEN 2 THEN 'A&B' WHEN 3 THEN 'AB' WHEN 4 THEN p_name WHEN 5 THEN CAST(p_size AS STRING) WHEN 6 THEN 'national institutes of health' WHEN 7 THEN p_name || ' Inventors' ELSE 'PCV' || CAST(p_size AS STRING) || ' mist' END AS name, CASE WHEN p_partkey % 2 = 0 THEN 'SEC' ELSE 'uspto' END AS source_type FROM {part}"


@query("company_filter", f"SELECT p_partkey, {q_plausible('name', 'source_type')} AS plausible FROM {{entity_rows}}")
def company_filter(spark, sf):
    return view(spark, sf, "entity_rows").select("p_partkey", text.is_plausible_company(F.col("name"), F.col("source_type")).alias("plausible"))


_FLAGS = {"boilerplate": rules.SEC_BOILERPLATE, "vetoed": rules.NEGATIVE_TRIGGERS, "patent_like": rules.PATENT_WORDS, "joint_patent": rules.JOINT_PATENT, "soft": rules.SOFT_WORDS}


@query("text_flags", "SELECT source_id, " + ", ".join(f"regexp_matches(lower(raw_text), '{_alt(p)}') AS {k}" for k, p in _FLAGS.items()) + " FROM {deal_texts}")
def text_flags(spark, sf):
    t = F.col("raw_text")
    made = {"boilerplate": text.is_boilerplate(t), "vetoed": text.has_negative_trigger(t), "patent_like": text.is_patent_like(t), "joint_patent": text.has_joint_patent_signal(t), "soft": text.has_soft_word(t)}
    return view(spark, sf, "deal_texts").select("source_id", *[c.alias(k) for k, c in made.items()])


_OK_PAIR = f"firm_a <> firm_b AND {q_plausible('firm_a', 'source_type')} AND {q_plausible('firm_b', 'source_type')}"
_REL = q_detect("sentence", "source_type", "relation")
_TRG = q_detect("sentence", "source_type", "trigger")
_REL_ALL = q_detect("raw_text", "source_type", "relation")
_TRG_ALL = q_detect("raw_text", "source_type", "trigger")
_HEAD = "source_id, upper(source_type) AS source_type, least(firm_a, firm_b) AS entity_a, greatest(firm_a, firm_b) AS entity_b"
_BOILER = f"(upper(source_type) = 'SEC' AND regexp_matches(lower(sentence), '{_alt(rules.SEC_BOILERPLATE)}'))"
_SOFT = f"regexp_matches(lower(sentence), '{_alt(rules.SOFT_WORDS)}')"
_TOLD_SQL = f"SELECT {_HEAD}, {_REL} AS candidate_relation, sentence AS evidence_text, {_TRG} AS trigger_phrase, 'source_aware_sentence_trigger_relaxed' AS extraction_method, 2 AS num_entities_in_sentence FROM {{deal_texts}} WHERE {_OK_PAIR} AND NOT {_BOILER} AND {_REL} <> ''"
_COOCCUR_SQL = f"SELECT {_HEAD}, 'CO_OCCURS_WITH' AS candidate_relation, sentence AS evidence_text, 'soft_relation_context' AS trigger_phrase, 'sentence_cooccurrence_fallback_relaxed' AS extraction_method, 2 AS num_entities_in_sentence FROM {{deal_texts}} WHERE {_OK_PAIR} AND NOT {_BOILER} AND {_REL} = '' AND upper(source_type) IN ('SEC', 'PUBMED') AND {_SOFT}"
_USPTO_SQL = f"SELECT {_HEAD}, 'FILED_PATENT_WITH' AS candidate_relation, substr(raw_text, 1, 500) AS evidence_text, 'explicit_joint_patent_signal' AS trigger_phrase, 'source_aware_record_trigger_relaxed' AS extraction_method, 2 AS num_entities_in_sentence FROM {{deal_texts}} WHERE {_OK_PAIR} AND upper(source_type) = 'USPTO' AND regexp_matches(lower(raw_text), '{_alt(rules.PATENT_WORDS)}') AND regexp_matches(lower(raw_text), '{_alt(rules.JOINT_PATENT)}')"
_RECORD_SQL = f"SELECT {_HEAD}, {_REL_ALL} AS candidate_relation, substr(raw_text, 1, 500) AS evidence_text, {_TRG_ALL} AS trigger_phrase, 'record_trigger_fallback_relaxed' AS extraction_method, 2 AS num_entities_in_sentence FROM {{deal_texts}} WHERE {_OK_PAIR} AND upper(source_type) <> 'USPTO' AND {_REL_ALL} <> ''"
_RELATION_COLUMNS = ["source_id", "source_type", "entity_a", "entity_b", "candidate_relation", "evidence_text", "trigger_phrase", "extraction_method", "num_entities_in_sentence"]


def _relations(spark, sf, which):
    return relations.deduplicated(relations.paired(which(view(spark, sf, "deal_mentions")))).select(*_RELATION_COLUMNS)


@query("sentence_relations", _TOLD_SQL)
def sentence_relations(spark, sf):
    return _relations(spark, sf, lambda rows: relations.sentence_level(rows, cooccurrence=False))


@query("cooccur_fallback", _COOCCUR_SQL)
def cooccur_fallback(spark, sf):
    return _relations(spark, sf, relations.sentence_level).filter("candidate_relation = 'CO_OCCURS_WITH'")


@query("uspto_record_relations", _USPTO_SQL)
def uspto_record_relations(spark, sf):
    return _relations(spark, sf, relations.record_level).filter("trigger_phrase = 'explicit_joint_patent_signal'")


@query("record_relations", _RECORD_SQL)
def record_relations(spark, sf):
    return _relations(spark, sf, relations.record_level).filter("extraction_method = 'record_trigger_fallback_relaxed'")


@query("candidate_relations", f"{_TOLD_SQL} UNION ALL {_COOCCUR_SQL} UNION ALL {_USPTO_SQL} UNION ALL {_RECORD_SQL}")
def candidate_relations(spark, sf):
    return relations.candidate_relations(view(spark, sf, "deal_mentions")).select(*_RELATION_COLUMNS)


@query("relation_counts", f"SELECT candidate_relation, extraction_method, count(*) AS n_rows FROM ({_TOLD_SQL} UNION ALL {_COOCCUR_SQL} UNION ALL {_USPTO_SQL} UNION ALL {_RECORD_SQL}) u GROUP BY candidate_relation, extraction_method")
def relation_counts(spark, sf):
    return relations.candidate_relations(view(spark, sf, "deal_mentions")).groupBy("candidate_relation", "extraction_method").agg(F.count("*").alias("n_rows"))


@query("top_mentions", "SELECT raw_mention, count(*) AS n FROM {mention_rows} GROUP BY raw_mention ORDER BY n DESC, raw_mention LIMIT 20")
def top_mentions(spark, sf):
    return view(spark, sf, "mention_rows").groupBy("raw_mention").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "raw_mention").limit(20)


BASES["customer_links"] = "SELECT o_custkey AS a, o_orderkey % 400 + 1000000 AS b FROM {orders}"


@query("graph_components", """WITH RECURSIVE two AS (SELECT a, b FROM {customer_links} UNION SELECT b, a FROM {customer_links}), reach(x, y) AS (SELECT a, a FROM two UNION SELECT r.x, t.b FROM reach r JOIN two t ON r.y = t.a)
    SELECT x AS node, min(y) AS component FROM reach GROUP BY x""")  # fmt: skip
def graph_components(spark, sf):
    return connected_components(view(spark, sf, "customer_links"), "a", "b")


def flagship_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deals as records, with the first firm as seed."""
    deals = view(spark, sf_dir, "deal_texts")
    return deals.select("source_id", "source_type", "raw_text", "source_url", "date", F.col("firm_a").alias("company_seed"))


@query("pipeline_relations")
def pipeline_relations(spark, sf):
    """Records to candidate relations through every step."""
    firms = view(spark, sf, "deal_texts").select(F.col("firm_b").alias("seed")).distinct()
    return pipeline.relations_of(flagship_records(spark, sf), firms)["relations"]
