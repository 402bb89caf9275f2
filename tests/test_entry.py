"""The registered queries of the small folder against their SQL."""

import duckdb
import pytest

import __spark_entry__ as entry

ROOT = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SAMPLE = [
    "cases_located", "neighbour_case_totals", "flows_by_community", "tile_end_points", "touching_areas", "nearest_centre", "movement_statistics",
    "attributes_by_rule", "smoothed_cases", "two_pass_range", "daily_graph_nodes", "change_maps", "peru_cases", "batch_daily_flows",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{ROOT}/{t}.parquet'")
    return c


def rows(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return sorted([tuple(None if v is None or v != v else v for v in r) for r in pdf.itertuples(index=False)], key=repr)


def test_names_and_sql_belong_together():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q) and len(q) > 150


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, con, name):
    got = entry.queries()[name](spark, ROOT).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert len(got) and rows(got) == rows(want)
