"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from . import merkle, url_filter
from .hmm import op5_hmm
from .language_id import op7_language_id
from .merkle import op4_merkle
from .mixing import op8_mixing
from .packing import op9_packing
from .secrets import op13_secrets
from .separator_scan import op6_token_counts
from .simhash_dedup import op3_simhash_dedup
from .token_alignment import op12_token_alignment
from .toxicity import op10_toxicity
from .url_filter import op1_url_filter
from .vector_dedup import op2_vector_dedup
from .whitening import op11_whitening

QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_vector_dedup, op3_simhash_dedup, op4_merkle, op5_hmm, op6_token_counts, op7_language_id, op8_mixing,
    op9_packing, op10_toxicity, op11_whitening, op12_token_alignment, op13_secrets)}
ORACLE: dict[str, str] = {"op1_url_filter": url_filter.ORACLE_SQL, "op4_merkle": merkle.ORACLE_SQL}
