"""Queries of this subpackage, one for each operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from corpweave.llm.idstore import op6_token_ids
from corpweave.llm.langid import op7_language_id
from corpweave.llm.lattice import op3_lattice
from corpweave.llm.mixing import op8_mixing
from corpweave.llm.packing import op2_packing
from corpweave.llm.render import op5_html_text
from corpweave.llm.simhash import op9_simhash
from corpweave.llm.suffix import op10_suffix_array
from corpweave.llm.warc import op1_warc
from corpweave.llm.winnow import op4_winnowing

QUERIES = {f.__name__: f for f in (op1_warc, op2_packing, op3_lattice, op4_winnowing, op5_html_text, op6_token_ids, op7_language_id, op8_mixing, op9_simhash, op10_suffix_array)}

ORACLE_SQL: dict[str, str] = {}
