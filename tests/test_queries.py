"""Every registered query against its DuckDB oracle on sf0.001 (the driver's check runs
the same at sf0.01), plus the entry smoke check."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from issuewatch.plans.catalog import QUERIES as CATALOG
from issuewatch.sources.tables import DRIVER_TABLES

# the training-data queries, where they are installed, have tests of their own
SQL = {k: v for k, v in E.oracle_sql().items() if k in CATALOG}
QUERIES = {k: v for k, v in E.queries().items() if k in CATALOG}


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{round(v, 6):.6f}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_rows_only():
    rows_only = set(QUERIES) - set(SQL)
    assert rows_only <= {"series_similarity", "top_alert"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(df.columns, srows) == _digest(dcols, drows)


@pytest.mark.parametrize("name", ["series_similarity", "top_alert"])
def test_rows_only_queries_run(spark, name):
    rows = QUERIES[name](spark, SF_SMALL).collect()
    assert len(rows) >= 1
    for r in rows:
        v = r["similarity_degree"] if "similarity_degree" in r else r["alert_value"]
        assert v is None or (0.0 <= v and not math.isnan(v))


def test_exact_similarity_not_below_fast(spark):
    fast = {(r[0], r[1]): r[2] for r in QUERIES["series_similarity"](spark, SF_SMALL).collect()}
    exact = {(r[0], r[1]): r[2] for r in QUERIES["series_similarity_exact"](spark, SF_SMALL).collect()}
    assert fast.keys() == exact.keys()
    for k in fast:  # exact distance <= FastDTW distance, so exact similarity >= fast
        assert exact[k] >= fast[k] - 1e-6  # the exact ones are rounded


def test_top_alert_equals_the_one_of_all_pairs(spark):
    from issuewatch.operators import alerts, issues
    from issuewatch.plans import catalog

    every = QUERIES["series_similarity"](spark, SF_SMALL)
    freq = issues.total_frequency(catalog._current_issue(spark, SF_SMALL))
    want = alerts.top_alerts(alerts.alert_table(freq, every), 1).first()
    got = QUERIES["top_alert"](spark, SF_SMALL).first()
    assert (got.current_keyword, got.past_issue_name) == (want.current_keyword, want.past_issue_name)
    assert math.isclose(got.alert_value, want.alert_value, rel_tol=1e-9)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["current_keyword", "past_issue_name", "alert_value", "AlarmName", "NewStateValue", "NewStateReason", "sentence"]
    assert df.count() >= 0


def test_stream_alert_spreads_a_crawl_over_files_and_takes_it_in_one_trigger(spark, tmp_path, monkeypatch):
    from issuewatch.plans import catalog

    paths = {}

    def scratch(_, name):
        return paths.setdefault(name, f"{tmp_path}/{name}")

    monkeypatch.setattr(catalog, "scratch_path", scratch)
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(4).write.parquet(f"{tmp_path}/sf/events.parquet")
    assert catalog.QUERIES["stream_alert"](spark, f"{tmp_path}/sf").count() == 1
    assert len(spark.read.parquet(f"{paths['crawls']}/crawl=0").inputFiles()) == 4
    triggers = spark.read.parquet(paths["raw"]).select("batch").distinct().count()
    assert triggers == 3
