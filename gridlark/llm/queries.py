"""Registered queries of the operators, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridlark.llm import (
    codes, conversations, decontamination, packing, pii, quality, repeats, secrets, sharding, simhash, topk, toxicity, urls
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": decontamination.op1_decontamination,
    "op2_simhash": simhash.op2_simhash,
    "op3_quality": quality.op3_quality,
    "op4_topk": topk.op4_topk,
    "op5_repeats": repeats.op5_repeats,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_sharding": sharding.op7_sharding,
    "op8_packing": packing.op8_packing,
    "op9_pii": pii.op9_pii,
    "op10_secrets": secrets.op10_secrets,
    "op11_conversations": conversations.op11_conversations,
    "op12_codes": codes.op12_codes,
    "op13_urls": urls.op13_urls,
}

ORACLES: dict[str, str] = {"op1_decontamination": decontamination.SQL, "op4_topk": topk.SQL, "op11_conversations": conversations.SQL, "op12_codes": codes.SQL}
