"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline

from . import bpe, divergence, fingerprints, licences, media, mixing, packing, periods, quality, repeats, similarity, toxicity, urls
from .common import shipped


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_quality_classifier": quality.op1_quality_classifier,
    "op2_media_columns": media.op2_media_columns,
    "op3_jaccard_join": similarity.op3_jaccard_join,
    "op4_mixing": mixing.op4_mixing,
    "op5_license_scan": licences.op5_license_scan,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op7_substring_dedup": repeats.op7_substring_dedup,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_url_filters": urls.op9_url_filters,
    "op10_fingerprints": fingerprints.op10_fingerprints,
    "op11_source_divergence": divergence.op11_source_divergence,
    "op12_periodic_runs": periods.op12_periodic_runs,
    "op13_bpe_chunks": bpe.op13_bpe_chunks,
}


def queries():
    return {name: shipped(query) for name, query in QUERIES.items()}


def oracle_sql():
    pipeline = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
    return pipeline | {"op3_jaccard_join": similarity.OP3_SQL, "op4_mixing": mixing.OP4_SQL, "op7_substring_dedup": repeats.OP7_SQL, "op9_url_filters": urls.op9_sql(), "op11_source_divergence": divergence.OP11_SQL}
