"""Registered queries of this subpackage, and SQL for those that SQL can express.

None of the ten can be written in the oracle's SQL: they hash with XXH64, train models, tokenize,
or work on bytes by position. tests/llm holds each against a brute-force version.
"""

from __future__ import annotations

from tickloom.llm.decontaminate import op6_decontaminate
from tickloom.llm.language import op4_language
from tickloom.llm.lm import op3_lm
from tickloom.llm.media import op8_media
from tickloom.llm.mixing import op1_mixing
from tickloom.llm.repeats import op5_repeats
from tickloom.llm.secrets import op10_secrets
from tickloom.llm.simhash import op2_simhash
from tickloom.llm.tokens import op7_token_ids
from tickloom.llm.toxicity import op9_toxicity

QUERIES = {f.__name__: f for f in (op1_mixing, op2_simhash, op3_lm, op4_language, op5_repeats, op6_decontaminate, op7_token_ids, op8_media, op9_toxicity, op10_secrets)}
ORACLE_SQL: dict[str, str] = {}
