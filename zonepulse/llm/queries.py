"""Registered queries of this folder and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from zonepulse.llm import alignment, ann, langid, licences, neardup, packing, pieces, prefixes, sharding, tokenfile, topk, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        neardup.op1_order_minhash,
        licences.op2_diagonal_voting,
        warc.op3_warc_index_merge,
        sharding.op4_hilbert_sharding,
        packing.op5_pattern_packing,
        topk.op6_segment_top_k,
        toxicity.op7_noisy_channel,
        langid.op8_output_codes,
        pieces.op9_batched_viterbi,
        ann.op10_multi_index,
        alignment.op11_interval_alignment,
        prefixes.op12_radix_trie,
        tokenfile.op13_wavelet_shards,
    )
}
QUERIES["pipeline"] = corpus_pipeline.run
SQL: dict[str, str] = {**licences.SQL, **warc.SQL, **topk.SQL, **prefixes.SQL}
