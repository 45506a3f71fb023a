"""Every query with SQL gives the rows that DuckDB gives."""

import pytest

import __spark_entry__ as entry
from varaq.plans import queries as documents

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


def normal(rows):
    def one(v):
        if v is None or v != v:
            return (0, "")
        if isinstance(v, bool):
            return (1, str(v))
        if isinstance(v, (int, float)):
            return (2, repr(round(float(v), 9) + 0.0))
        return (3, str(v))

    return sorted(tuple(map(one, r)) for r in rows)


@pytest.fixture(scope="module")
def duck(sf):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(documents.SQL))
def test_query_equals_its_sql(spark, sf, duck, name):
    df = documents.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = normal(df.select(*(f"`{c}`" for c in columns)).toPandas().astype(object).where(lambda x: x.notna(), None).itertuples(index=False, name=None))
    r = duck.execute(documents.SQL[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == columns
    assert got == normal(tuple(x[names.index(c)] for c in columns) for x in r.fetchall())
    assert got


def test_entry_and_registry(spark):
    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["q_clean_text", "q_classify", "q_blocks", "q_page_status", "q_outline", "q_relationships", "q_md_page"])
def test_core_plans_have_no_python_and_no_cartesian_product(spark, sf, name):
    plan = documents.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
