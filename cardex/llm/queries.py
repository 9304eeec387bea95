"""The registered queries of this package and their SQL for DuckDB."""

from __future__ import annotations

from cardex.llm.decontaminate import OP9_SQL, op9_decontaminate
from cardex.llm.exact_dedup import OP13_SQL, op13_exact_dedup
from cardex.llm.fill_middle import OP11_SQL, op11_fill_middle
from cardex.llm.line_dedup import OP3_SQL, op3_line_dedup
from cardex.llm.mixing import op7_mix
from cardex.llm.ngram_join import OP10_SQL, op10_ngram_join
from cardex.llm.pii import op6_pii
from cardex.llm.quality import op4_quality
from cardex.llm.secrets import op1_secrets
from cardex.llm.tokens import op8_tokens
from cardex.llm.toxicity import op5_toxicity
from cardex.llm.urls import op2_urls
from cardex.llm.vector_codes import OP12_SQL, op12_vector_codes

QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_urls": op2_urls,
    "op3_line_dedup": op3_line_dedup,
    "op4_quality": op4_quality,
    "op5_toxicity": op5_toxicity,
    "op6_pii": op6_pii,
    "op7_mix": op7_mix,
    "op8_tokens": op8_tokens,
    "op9_decontaminate": op9_decontaminate,
    "op10_ngram_join": op10_ngram_join,
    "op11_fill_middle": op11_fill_middle,
    "op12_vector_codes": op12_vector_codes,
    "op13_exact_dedup": op13_exact_dedup,
}
ORACLES = {
    "op3_line_dedup": OP3_SQL,
    "op9_decontaminate": OP9_SQL,
    "op10_ngram_join": OP10_SQL,
    "op11_fill_middle": OP11_SQL,
    "op12_vector_codes": OP12_SQL,
    "op13_exact_dedup": OP13_SQL,
}
