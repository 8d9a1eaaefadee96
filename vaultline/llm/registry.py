"""Query keys of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vaultline.llm.chunk_bpe import op12_chunk_bpe
from vaultline.llm.decontaminate import op4_decontaminate
from vaultline.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from vaultline.llm.kneser_ney import op3_kneser_ney
from vaultline.llm.line_dedup import OP1_SQL, op1_line_dedup
from vaultline.llm.mixing import OP9_SQL, op9_mixing
from vaultline.llm.ngram_jaccard import op10_ngram_jaccard
from vaultline.llm.quality import op7_quality
from vaultline.llm.secrets import op5_secret_scan
from vaultline.llm.simhash import op8_simhash
from vaultline.llm.site_style import op2_site_style
from vaultline.llm.toxicity import op6_toxicity
from vaultline.llm.whitening import op11_whitening

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_site_style": op2_site_style,
        "op3_kneser_ney": op3_kneser_ney,
        "op4_decontaminate": op4_decontaminate,
        "op5_secret_scan": op5_secret_scan,
        "op6_toxicity": op6_toxicity,
        "op7_quality": op7_quality,
        "op8_simhash": op8_simhash,
        "op9_mixing": op9_mixing,
        "op10_ngram_jaccard": op10_ngram_jaccard,
        "op11_whitening": op11_whitening,
        "op12_chunk_bpe": op12_chunk_bpe,
        "op13_hard_negatives": op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": OP1_SQL, "op9_mixing": OP9_SQL, "op13_hard_negatives": OP13_SQL}
