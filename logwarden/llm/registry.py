"""Queries of the training-data operators: ``opN_<name>`` -> ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import corpus_pipeline

from . import (ann, chat_perspectives, decontaminate, lm_scoring, merkle_manifest, secrets, sentencepiece_sampling,
               simhash, spelling, token_files, toxicity, url_filter, warc_audit)

QUERIES = {
    "op1_toxicity": toxicity.query,
    "op2_warc_audit": warc_audit.query,
    "op3_chat_perspectives": chat_perspectives.query,
    "op4_secret_scan": secrets.query,
    "op5_sentencepiece_sampling": sentencepiece_sampling.query,
    "op6_nn_descent": ann.query,
    "op7_simhash_dedup": simhash.query,
    "op8_token_files": token_files.query,
    "op9_url_filter": url_filter.query,
    "op10_decontaminate": decontaminate.query,
    "op11_lm_scoring": lm_scoring.query,
    "op12_spelling_variants": spelling.query,
    "op13_merkle_manifest": merkle_manifest.query,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op2_warc_audit": warc_audit.ORACLE,
    "op3_chat_perspectives": chat_perspectives.ORACLE,
    "op9_url_filter": url_filter.ORACLE,
    "op10_decontaminate": decontaminate.ORACLE,
    "op13_merkle_manifest": merkle_manifest.ORACLE,
}
