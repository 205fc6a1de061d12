"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import centroids, decontamination, exact_dedup, fill_in_middle, language_id, license_scan, main_text, mixing, sharding, simhash, substring_dedup, toxicity, warc


def queries() -> dict:
    return {
        "op1_language_id": language_id.op1_language_id,
        "op2_sharding": sharding.op2_sharding,
        "op3_toxicity": toxicity.op3_toxicity,
        "op4_warc": warc.op4_warc,
        "op5_mixing": mixing.op5_mixing,
        "op6_substring_dedup": substring_dedup.op6_substring_dedup,
        "op7_simhash": simhash.op7_simhash,
        "op8_decontamination": decontamination.op8_decontamination,
        "op9_license_scan": license_scan.op9_license_scan,
        "op10_exact_dedup": exact_dedup.op10_exact_dedup,
        "op11_centroids": centroids.op11_centroids,
        "op12_main_text": main_text.op12_main_text,
        "op13_fill_in_middle": fill_in_middle.op13_fill_in_middle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_warc": warc.SQL,
        "op5_mixing": mixing.SQL,
        "op6_substring_dedup": substring_dedup.SQL,
        "op8_decontamination": decontamination.SQL,
        "op9_license_scan": license_scan.SQL,
        "op10_exact_dedup": exact_dedup.SQL,
        "op11_centroids": centroids.SQL,
        "op12_main_text": main_text.SQL,
        "op13_fill_in_middle": fill_in_middle.SQL,
    }
