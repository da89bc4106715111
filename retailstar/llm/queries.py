"""The operators of this subpackage as registered queries, and the oracle SQL of
those that SQL can express; the tests hold the others against other versions."""

from __future__ import annotations

from . import (bpe, centroid_clustering, fingerprints, hard_negatives, license_scan, mixing, ngram_join, ppm,
               quality_rules, secret_scan, sharding, substring_dedup, warc)
from .sql_oracle import ORACLE_SQL

QUERIES = {
    "op1_bpe": bpe.query,
    "op2_sharding": sharding.query,
    "op3_substring_dedup": substring_dedup.query,
    "op4_secret_scan": secret_scan.query,
    "op5_license_scan": license_scan.query,
    "op6_source_mix": mixing.query,
    "op7_fingerprints": fingerprints.query,
    "op8_quality_rules": quality_rules.query,
    "op9_ppm": ppm.query,
    "op10_ngram_join": ngram_join.query,
    "op11_warc": warc.query,
    "op12_hard_negatives": hard_negatives.query,
    "op13_centroid_clustering": centroid_clustering.query,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
