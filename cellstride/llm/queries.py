"""The queries over the given tables, and the SQL that must agree where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (bloomlm, bpe, exactdedup, htmltext, langid, lexical, mixing, quality, secrets, sharding,
               simhash, vptree, whitening)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": mixing.query,
    "op2_simhash": simhash.query,
    "op3_vptree": vptree.query,
    "op4_language": langid.query,
    "op5_sharding": sharding.query,
    "op6_html": htmltext.query,
    "op7_bloom_lm": bloomlm.query,
    "op8_secrets": secrets.query,
    "op9_bpe": bpe.query,
    "op10_exact_dedup": exactdedup.query,
    "op11_quality": quality.query,
    "op12_whitening": whitening.query,
    "op13_lexical": lexical.query,
}

ORACLES: dict[str, str] = {
    "op1_mixing": mixing.SQL,
    "op10_exact_dedup": exactdedup.SQL,
    "op11_quality": quality.SQL,
    "op13_lexical": lexical.SQL,
}
