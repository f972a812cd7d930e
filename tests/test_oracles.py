"""Every registered query of the asset pipeline against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from packloom.plans import correction_queries, delivery_queries, diagnosis_queries, inference_queries, orchestration_queries, pipeline_queries, planning_queries, preview_queries, raster_queries, registry, repair_queries, runner_queries, table_queries, validation_queries  # noqa: F401

from .conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        path = f"{SF}/{name}.parquet"
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in registry.ORACLES:
        assert ours
        return
    relation = duck.sql(registry.ORACLES[name])
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    theirs = sorted((tuple(plain(r[i]) for i in at) for r in relation.fetchall()), key=repr)
    assert ours == theirs


def test_entry_module_imports():
    import __spark_entry__ as entry

    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
