"""The registry: SQL for registered queries only, and equal columns and rows for some of each family."""

import os

import pytest

from tesserae.queries import ORACLES, QUERIES
from tesserae.sources.analogue import TABLES, VIEWS, with_views

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the supplied tables are not here")
SOME = ("merge_chains", "merge_chains_applied", "review_replay", "review_applied", "search_many", "cleanup_trace", "snapshot_versions", "snapshot_delta", "age_phrases", "origin_phrases", "median_trend", "roster_counts", "profile_relationships", "graph_nodes", "alias_cleanup", "origin_refine", "collisions_suppressed", "fuller_names", "resolve_tokens", "merge_plan_relationships", "carry_forward", "toc_classify", "broken_pointers")


@pytest.fixture(scope="module")
def other():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_views_and_names(other):
    assert set(ORACLES) <= set(QUERIES)
    for v in VIEWS:
        assert other.cursor().execute(with_views(f"SELECT count(*) FROM {{{v}}}")).fetchall()[0][0] > 0
    assert with_views("WITH RECURSIVE a AS (SELECT 1) SELECT * FROM {books}").startswith("WITH RECURSIVE books AS")


@pytest.mark.parametrize("name", SOME)
def test_rows(spark, other, name):
    df, cursor = QUERIES[name](spark, FOLDER), other.cursor()
    found = cursor.execute(ORACLES[name]).fetchall()
    columns, order = [c[0] for c in cursor.description], sorted(df.columns)
    assert sorted(columns) == order
    mine = sorted((tuple(r[c] for c in order) for r in df.collect()), key=repr)
    theirs = sorted((tuple(r[columns.index(c)] for c in order) for r in found), key=repr)
    assert mine == theirs and mine
