"""Word lists, tokens and patterns that results depend on."""

from __future__ import annotations

# --- Fixed values -------------------------------------------------------------
# Cells that a spreadsheet writes for errors, and month names in date-like cells.
EXCEL_ERRORS = ["#NAME?", "#VALUE!", "#REF!", "#DIV/0!", "#NUM!", "#N/A", "#NULL!"]
MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "SEPT", "OCT", "NOV", "DEC"]
# Values that count as missing.
CORRUPT_TOKENS = ["#NAME?", "N/A", "NA", "NULL", "NONE", ""]
BAD_SEEDS = ["", "n/a", "na", "null", "none", "tbd", "#name?", "--", "unknown", "nocompany"]
# Texts that a CSV reader with default NA handling turns into missing values.
CSV_NA = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
# Source types and their other names.
SOURCE_ALIASES = {"NCBI E-UTILITIES": "PUBMED", "NCBI": "PUBMED", "PATENTSVIEW": "USPTO", "EDGAR": "SEC"}
VALID_SOURCES = ["SEC", "USPTO", "PUBMED", "NCBI", "OPENCORPORATES"]
# Name parts: dropped anywhere for lookups; taken off the end for alias resolution.
LOOKUP_SUFFIXES = ["INC", "INC.", "CORP", "CORP.", "CORPORATION", "LLC", "L.L.C.", "LTD", "LTD.", "LIMITED", "PLC", "CO", "CO.", "COMPANY", "BV", "B.V.", "AB", "AG", "GMBH", "S.A.", "SA", "NV", "N.V."]
GENERIC_SUFFIXES = ["INC", "INCORPORATED", "CORP", "CORPORATION", "CO", "COMPANY"]
REGION_SUFFIXES = ["LLC", "LTD", "LIMITED", "PLC", "LP", "LLP", "BV", "AB", "GMBH", "AG", "SA", "SAS", "NV", "SPA", "SARL", "KK"]
ACRONYM_STOPWORDS = ["AND", "OF", "THE", "FOR", "TO", "IN", "ON", "AT", "BY"]
# Endings that a dictionary name may carry in a text.
VARIANT_SUFFIXES = [
    "Inc.", "Inc", "Corporation", "Corp.", "Corp", "Co.", "Co", "Company", "Ltd.", "Ltd", "LLC", "PLC", "GmbH", "BV", "AB", "SE", "SA", "AG",
    "Therapeutics", "Therapeutics, Inc.", "Pharmaceuticals", "Pharmaceuticals, Inc.", "Biotech", "Biotechnology", "Biosciences", "Sciences", "Research", "Holdings",
]
# Relation triggers per source, in the order in which they are tried.
SEC_TRIGGERS = [
    ("ACQUIRED", r"\b(acquired|acquire|acquires|buy|bought|purchased|acquisition of|merged with|merger with|acquisition agreement)\b"),
    ("LICENSED_FROM", r"\b(licensed from|licensed to|licensed|licensing agreement|license agreement|entered into a license|license deal|exclusive license|non-exclusive license)\b"),
    ("PARTNERED_WITH", r"\b(partnership|partnered with|strategic partnership|collaboration agreement|entered into an agreement with|agreement with)\b"),
    ("COLLABORATED_WITH", r"\b(collaborated with|collaboration with|co-develop(?:ed)? with|jointly developed|working with|worked with)\b"),
    ("FUNDED_WITH", r"\b(funded by .* and .*|co-funded by|supported by .* and .*|sponsored by .* and .*)\b"),
]
PUBMED_TRIGGERS = [
    ("PARTNERED_WITH", r"\b(partnership|partnered with|in partnership with|agreement with)\b"),
    ("COLLABORATED_WITH", r"\b(collaborated with|collaboration with|in collaboration with|co-develop(?:ed)? with|jointly developed|worked with|developed with)\b"),
    ("FUNDED_WITH", r"\b(funded by .* and .*|co-funded by|supported by .* and .*|sponsored by .* and .*)\b"),
]
USPTO_TRIGGERS = [("FILED_PATENT_WITH", r"\b(co-assignee|co-assigned|co assigned|co-filed|joint patent|filed patent with|patent with|joint assignee|assignees)\b")]
NEGATIVE_TRIGGERS = [r"\bcommunity-acquired\b", r"\bhospital-acquired\b", r"\bventilator-associated\b"]
SEC_BOILERPLATE = [r"\bcurrent report on form 8-k\b", r"\bforward-looking statements\b", r"\bprivate securities litigation reform act\b", r"\bcommission file\b", r"\bcommon stock\b", r"\bsecurities exchange act\b"]
JOINT_PATENT = [r"\bco-assignee\b", r"\bco-assigned\b", r"\bco assigned\b", r"\bjoint patent\b", r"\bpatent with\b", r"\bfiled patent with\b", r"\bco-filed\b", r"\bjoint assignee\b", r"\band\b.*\bassignee\b", r"\bassignees?\b.*\band\b"]
PATENT_WORDS = ["patent", "assignee", "inventor"]
SOFT_WORDS = ["agreement", "collaboration", "partner", "license", "licensed", "acquired", "merger", "joint", "together", "with", "between"]
# Names that are no companies.
ALLOWED_NAMES = ["National Institutes of Health", "University of Pennsylvania"]
BLOCKED_NAMES = [
    "COMPANY", "REGISTRANT", "COMMON STOCK", "COMMISSION FILE", "DISTRICT COURT", "THE SECURITIES AND EXCHANGE COMMISSION", "SEC", "FDA", "NIH",
    "THE LICENSE AGREEMENT", "LICENSE AGREEMENT", "THE MERGER AGREEMENT", "MERGER AGREEMENT", "AGREEMENT", "TERRITORY", "THE LICENSED PRODUCT", "LICENSED PRODUCT",
    "PURCHASER", "SHARES", "CVR", "CI", "CAPITA", "DSO", "NJ", "CPC", "IPC", "USPC", "INVENTOR", "INVENTORS", "ASSIGNEE", "PATENT", "GRANT", "APPLICATION",
]
BLOCKED_PARTS = [
    "&#", "FORM 8-K", "FORM 10-K", "FORM 10-Q", "COMMON STOCK", "COMMISSION FILE", "DISTRICT COURT", "SECURITIES EXCHANGE ACT", "LICENSE AGREEMENT", "MERGER AGREEMENT", "LICENSED PRODUCT", "TERRITORY",
    "CURRENT REPORT", "GRANT YEAR", "PUBLICATION", "APPLICATION NO", "PATENT NO", "INVENTOR", "INVENTORS", "CPC", "IPC", "USPC", "ASSIGNEE:",
]
PRODUCT_PATTERNS = [r"\bBAQSIMI\b", r"\bPRIMATENE\b", r"\bMIST\b", r"\bGLUCAGON\b", r"\bPCV\d+\b"]
METADATA_PATTERNS = [r"^\s*CPC\s*$", r"^\s*IPC\s*$", r"^\s*USPC\s*$", r"^\s*PATENT\s*$", r"^\s*ASSIGNEE\s*$", r"^\s*INVENTOR[S]?\s*$", r"^\s*PUBLICATION\s*$", r"^\s*APPLICATION\s*$"]
SHORT_CODES = ["BMS", "GSK", "JNJ", "CSL"]
# ------------------------------------------------------------------------------

NAME_SUFFIXES = GENERIC_SUFFIXES + REGION_SUFFIXES
TRIGGERS = {"SEC": SEC_TRIGGERS, "PUBMED": PUBMED_TRIGGERS, "USPTO": USPTO_TRIGGERS}
ALL_TRIGGERS = SEC_TRIGGERS + PUBMED_TRIGGERS + USPTO_TRIGGERS
