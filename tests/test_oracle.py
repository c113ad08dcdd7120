"""Every query against its SQL twin at the smallest scale."""

import duckdb
import pytest
from conftest import TESTDATA

from __spark_entry__ import entry, oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"create view {name} as select * from read_parquet('{TESTDATA}/{name}.parquet')")
    return connection


def ordered(columns, rows):
    places = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(r[p] for p in places) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    frame = queries()[name](spark, TESTDATA)
    found = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(frame.columns) == sorted(columns)
    assert ordered(frame.columns, [tuple(r) for r in frame.collect()]) == ordered(columns, found.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - {"train_eval", "batch_score", "score_error"}))
def test_query_without_sql_gives_rows(spark, name):
    assert queries()[name](spark, TESTDATA).count() > 0


def test_entry(spark):
    assert entry(spark).count() == 30


def test_split_is_whole(spark):
    split = {r.split: r.rows for r in queries()["train_test_split"](spark, TESTDATA).collect()}
    assert sum(split.values()) == 4979 and 0.75 < split["train"] / 4979 < 0.85


def test_the_cluster_must_name_the_shared_folder(spark, monkeypatch):
    from adlake import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master, applicationId = "yarn", "app"
        _jvm, _jsc = spark.sparkContext._jvm, spark.sparkContext._jsc

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        session.shared_folder(Session())
    Context.master = "local[2]"
    assert "adlake" in session.shared_folder(Session())
