"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from textloom.llm import decontamination, licenses, minhash, mixing, quality, sharding, simhash, toxicity, urls, warc


def queries() -> dict:
    return {
        "op1_licenses": licenses.op1_licenses,
        "op2_toxicity": toxicity.op2_toxicity,
        "op3_warc": warc.op3_warc,
        "op4_sharding": sharding.op4_sharding,
        "op5_simhash": simhash.op5_simhash,
        "op6_minhash": minhash.op6_minhash,
        "op7_urls": urls.op7_urls,
        "op8_quality": quality.op8_quality,
        "op9_mixing": mixing.op9_mixing,
        "op10_decontamination": decontamination.op10_decontamination,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_warc": warc.OP3_SQL, "op10_decontamination": decontamination.OP10_SQL}
