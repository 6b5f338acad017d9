"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from . import oracles
from .chroma import op3_chroma
from .decontaminate import op7_decontaminate
from .html_text import op2_html
from .licenses import op10_licenses
from .line_dedup import op6_line_dedup
from .minhash import op4_minhash
from .mixing import op8_mixing
from .suffix_dedup import op9_suffix_dedup
from .tokens import op1_token_ids
from .toxicity import op5_toxicity

QUERIES = {f.__name__: f for f in (op1_token_ids, op2_html, op3_chroma, op4_minhash, op5_toxicity, op6_line_dedup, op7_decontaminate, op8_mixing, op9_suffix_dedup, op10_licenses)}
ORACLE_SQL: dict[str, str] = {"op4_minhash": oracles.NEAR_DUPLICATES, "op7_decontaminate": oracles.DECONTAMINATION}
