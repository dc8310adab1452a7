"""Every registered query against its SQL, over whole tables."""

import os

import oracle
import pytest
import suite.base

import __spark_entry__ as entry_points
from freshet.session import configure

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = suite.base.QUERIES, suite.base.ORACLE


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, connection, name):
    assert oracle.difference(connection, QUERIES[name](spark, FOLDER), SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    out = entry_points.entry(configure(spark))
    assert out.columns == ["window_start", "window_end", "event_type", "count", "multiplier"]
    assert out.count() > 0


def test_clusters_are_nearest_centres(spark):
    out = QUERIES["kmeans_clusters"](spark, FOLDER).toPandas()
    centres = out.groupby("prediction")[["amount", "distance_km"]].mean().to_numpy()
    points = out[["amount", "distance_km"]].to_numpy()
    distance = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (distance.argmin(axis=1) == out["prediction"].to_numpy()).mean() > 0.99
    assert sorted(out["prediction"].unique()) == [0, 1]
