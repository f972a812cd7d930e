"""Cutting lineage between the rounds of an iteration."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """df written once to the cluster's checkpoint folder; a folder of our own only where none is set, as in tests."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="packloom-"))
    return df.checkpoint()
