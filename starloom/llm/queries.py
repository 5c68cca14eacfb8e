"""All queries of the subpackage."""

from starloom.llm import (  # noqa: F401
    q_blocked_search,
    q_exact,
    q_lattice,
    q_line_runs,
    q_main_text,
    q_near_text,
    q_packing,
    q_pieces,
    q_quality,
    q_rollup,
    q_token_align,
    q_toxicity,
    q_vectors,
)
from starloom.llm.registry import QUERIES, SQL  # noqa: F401
