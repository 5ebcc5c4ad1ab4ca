"""Queries and SQL of the training-data operators, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from driftspark.llm.centroids import OP12_SQL, op12_centroids
from driftspark.llm.decontamination import OP1_SQL, op1_decontamination
from driftspark.llm.exact_dedup import OP5_SQL, op5_exact_dedup
from driftspark.llm.jaccard import OP4_SQL, op4_jaccard_join
from driftspark.llm.language_model import op10_language_model
from driftspark.llm.licenses import op9_license_scan
from driftspark.llm.packing import op6_packing
from driftspark.llm.periodic_runs import op13_periodic_runs
from driftspark.llm.pii import op7_pii
from driftspark.llm.quality import op3_quality
from driftspark.llm.secrets import op8_secret_scan
from driftspark.llm.token_files import op2_token_files
from driftspark.llm.tree_bpe import op11_tree_bpe

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_token_files": op2_token_files,
    "op3_quality": op3_quality,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_packing": op6_packing,
    "op7_pii": op7_pii,
    "op8_secret_scan": op8_secret_scan,
    "op9_license_scan": op9_license_scan,
    "op10_language_model": op10_language_model,
    "op11_tree_bpe": op11_tree_bpe,
    "op12_centroids": op12_centroids,
    "op13_periodic_runs": op13_periodic_runs,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op1_decontamination": OP1_SQL,
    "op4_jaccard_join": OP4_SQL,
    "op5_exact_dedup": OP5_SQL,
    "op12_centroids": OP12_SQL,
}
