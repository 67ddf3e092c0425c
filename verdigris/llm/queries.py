"""The queries of this subpackage and their SQL, for the driver's contract."""

from __future__ import annotations

from .exact_dedup import OP1_SQL, op1_exact_dedup
from .fingerprint import op3_fingerprints
from .mixing import OP6_SQL, op6_mixing
from .near_dedup import op7_near_dedup
from .pii import op5_pii
from .quality import op2_quality
from .secrets import op10_secrets
from .sentencepiece_codec import op9_sentencepiece
from .toxicity import op4_toxicity
from .url_filter import OP8_SQL, op8_url_filter


def queries() -> dict:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_quality": op2_quality,
        "op3_fingerprints": op3_fingerprints,
        "op4_toxicity": op4_toxicity,
        "op5_pii": op5_pii,
        "op6_mixing": op6_mixing,
        "op7_near_dedup": op7_near_dedup,
        "op8_url_filter": op8_url_filter,
        "op9_sentencepiece": op9_sentencepiece,
        "op10_secrets": op10_secrets,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": OP1_SQL,
        "op6_mixing": OP6_SQL,
        "op8_url_filter": OP8_SQL,
    }
