"""Queries of the operators in this subpackage, and their SQL where it exists."""

from __future__ import annotations

from . import ann, decontaminate, lm_score, minhash, pack, shard, suffix_dedup, toxicity, url_filter, warc


def queries() -> dict:
    return {
        "op1_warc": warc.op1_warc,
        "op2_lm_score": lm_score.op2_lm_score,
        "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
        "op4_decontaminate": decontaminate.op4_decontaminate,
        "op5_shard": shard.op5_shard,
        "op6_pack": pack.op6_pack,
        "op7_toxicity": toxicity.op7_toxicity,
        "op8_minhash": minhash.op8_minhash,
        "op9_url_filter": url_filter.op9_url_filter,
        "op10_ann": ann.op10_ann,
    }


def oracle_sql() -> dict:
    return {
        "op2_lm_score": lm_score.OP2_SQL,
        "op9_url_filter": url_filter.OP9_SQL,
        "op10_ann": ann.OP10_SQL,
    }
