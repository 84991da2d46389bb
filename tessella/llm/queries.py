"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from .decontaminate import OP4_SQL, op4
from .jaccard_join import OP8_SQL, op8
from .langid import op9
from .mixing import op1
from .pq_neardup import OP10_SQL, op10
from .quality import op7
from .resample import OP12_SQL, op12
from .secrets import op3
from .sharding import op6
from .suffix_dedup import OP5_SQL, op5
from .toxicity import op2
from .warc import OP13_SQL, op13
from .yinyang import OP11_SQL, op11


def queries() -> dict:
    return {
        "op1_mixing": op1,
        "op2_toxicity": op2,
        "op3_secret_scan": op3,
        "op4_benchmark_decontamination": op4,
        "op5_suffix_dedup": op5,
        "op6_sharding": op6,
        "op7_quality_classifier": op7,
        "op8_ngram_jaccard_join": op8,
        "op9_language_id": op9,
        "op10_embedding_near_dedup": op10,
        "op11_yinyang_clustering": op11,
        "op12_importance_resampling": op12,
        "op13_warc": op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_benchmark_decontamination": OP4_SQL,
        "op5_suffix_dedup": OP5_SQL,
        "op8_ngram_jaccard_join": OP8_SQL,
        "op10_embedding_near_dedup": OP10_SQL,
        "op11_yinyang_clustering": OP11_SQL,
        "op12_importance_resampling": OP12_SQL,
        "op13_warc": OP13_SQL,
    }
