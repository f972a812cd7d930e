"""The registered queries of the training-data operators."""

from __future__ import annotations

from . import clustering, exact_dedup, jaccard_join, length_histogram, mixing, near_dedup, packing, periodic_runs, quality, secret_scan, spotsigs, toxicity, url_filter
from .common import table


def op1_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op4_near_dedup(spark, sf_dir):
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op5_toxicity(spark, sf_dir):
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_mixing(spark, sf_dir):
    return mixing.sample(table(spark, sf_dir, "documents"))


def op7_spotsigs(spark, sf_dir):
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


def op8_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_token_counts(spark, sf_dir):
    return length_histogram.token_counts(table(spark, sf_dir, "documents"))


def op10_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op11_periodic_runs(spark, sf_dir):
    return periodic_runs.digests(table(spark, sf_dir, "documents"))


def op12_shallot(spark, sf_dir):
    return clustering.cluster(table(spark, sf_dir, "embeddings"))


def op13_jaccard_join(spark, sf_dir):
    return jaccard_join.join(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_packing, op2_exact_dedup, op3_secret_scan, op4_near_dedup, op5_toxicity, op6_mixing, op7_spotsigs, op8_quality, op9_token_counts, op10_url_filter, op11_periodic_runs, op12_shallot, op13_jaccard_join)}
ORACLES = {"op2_exact_dedup": exact_dedup.ORACLE, "op6_mixing": mixing.ORACLE, "op10_url_filter": url_filter.ORACLE, "op12_shallot": clustering.ORACLE, "op13_jaccard_join": jaccard_join.ORACLE}
