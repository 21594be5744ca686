"""The operators' queries, and the oracle's SQL for those that SQL can express on whole tables."""

from __future__ import annotations

import corpus_pipeline

from .ann_forest import op7_ann_forest
from .chat_trees import op2_chat_trees
from .html_text import op6_html_text
from .language_id import op5_language_id
from .lexical_search import SQL as LEXICAL_SQL, op13_lexical_search
from .lm_scoring import op1_lm_scoring
from .mixing import op8_mixing
from .near_dedup import op4_near_dedup
from .packing import op3_best_fit_packing
from .periodic_runs import op11_periodic_runs
from .quality import op9_quality
from .substring_dedup import op10_substring_dedup
from .vector_links import SQL as VECTOR_SQL, op12_vector_links

QUERIES = {f.__name__: f for f in (op1_lm_scoring, op2_chat_trees, op3_best_fit_packing, op4_near_dedup, op5_language_id, op6_html_text,
                                   op7_ann_forest, op8_mixing, op9_quality, op10_substring_dedup, op11_periodic_runs, op12_vector_links, op13_lexical_search)}
QUERIES["pipeline"] = corpus_pipeline.run

ORACLE_SQL: dict[str, str] = {"op12_vector_links": VECTOR_SQL, "op13_lexical_search": LEXICAL_SQL}
