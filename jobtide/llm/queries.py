"""Registered queries: each operator over its whole table, and the pipeline."""

from __future__ import annotations

from jobtide.llm import (
    bloom_lm,
    bpe,
    check_sql,
    collocations,
    licenses,
    merkle,
    near_dedup,
    order_minhash,
    packing,
    quality_classifier,
    quality_rules,
    secret_scan,
    sharding,
    url_filter,
)
from jobtide.llm.tables import read


def op1_secrets(spark, sf_dir):
    return secret_scan.report(read(spark, sf_dir, "documents"))


def op2_shards(spark, sf_dir):
    return sharding.place(read(spark, sf_dir, "documents"))


def op3_quality(spark, sf_dir):
    return quality_classifier.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_licences(spark, sf_dir):
    return licenses.report(read(spark, sf_dir, "documents"))


def op5_bpe(spark, sf_dir):
    return bpe.report(read(spark, sf_dir, "documents"))


def op6_packing(spark, sf_dir):
    return packing.report(read(spark, sf_dir, "documents"))


def op7_near_duplicates(spark, sf_dir):
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op8_fingerprints(spark, sf_dir):
    return order_minhash.report(read(spark, sf_dir, "documents"))


def op9_urls(spark, sf_dir):
    return url_filter.judge(read(spark, sf_dir, "pages"))


def op10_rules(spark, sf_dir):
    return quality_rules.judge_documents(read(spark, sf_dir, "documents"))


def op11_manifest(spark, sf_dir):
    return merkle.report(read(spark, sf_dir, "documents"))


def op12_collocations(spark, sf_dir):
    return collocations.report(read(spark, sf_dir, "documents"))


def op13_lm(spark, sf_dir):
    return bloom_lm.report(read(spark, sf_dir, "documents"))


# trained scores, tokenizers, sketches and spans of patterns are held to brute force in tests/llm
CHECKS = {
    "op2_shards": check_sql.shards(),
    "op7_near_duplicates": check_sql.NEAR_DUPLICATES,
    "op9_urls": check_sql.URLS,
    "op10_rules": check_sql.QUALITY_RULES,
    "op11_manifest": check_sql.MANIFEST,
    "op12_collocations": check_sql.COLLOCATIONS,
}
QUERIES = {
    f.__name__: (f, CHECKS.get(f.__name__))
    for f in (
        op1_secrets,
        op2_shards,
        op3_quality,
        op4_licences,
        op5_bpe,
        op6_packing,
        op7_near_duplicates,
        op8_fingerprints,
        op9_urls,
        op10_rules,
        op11_manifest,
        op12_collocations,
        op13_lm,
    )
}
