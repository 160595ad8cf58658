"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vehiscope.llm import alignment, centroids, decontamination, languages, licenses, lines, passages, quality, sentencepieces, sharding, simhash, urls, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": lines.op1_line_dedup,
        "op2_sentencepiece": sentencepieces.op2_sentencepiece,
        "op3_warc_fixity": warc.op3_query,
        "op4_passages": passages.op4_passages,
        "op5_sharding": sharding.op5_sharding,
        "op6_quality": quality.op6_quality,
        "op7_url_filter": urls.op7_url_filter,
        "op8_decontamination": decontamination.op8_decontamination,
        "op9_licenses": licenses.op9_licenses,
        "op10_simhash": simhash.op10_simhash,
        "op11_alignment": alignment.op11_alignment,
        "op12_languages": languages.op12_languages,
        "op13_centroids": centroids.op13_centroids,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": lines.OP1_SQL,
        "op3_warc_fixity": warc.OP3_SQL,
        "op8_decontamination": decontamination.OP8_SQL,
        "op9_licenses": licenses.OP9_SQL,
        "op13_centroids": centroids.OP13_SQL,
    }
