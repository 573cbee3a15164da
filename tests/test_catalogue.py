import pytest

from skyphrase.plans import catalogue, oracle

from .compare import duck, same

SQL = oracle.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, sf_dir, name):
    same(catalogue.queries()[name](spark, sf_dir), duck(sf_dir), SQL[name])


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(SQL)


def test_entry(spark):
    import __spark_entry__

    row = __spark_entry__.entry(spark).first()
    assert row["ok"] + row["failed"] > 0


def test_tier_weights_of_all_airports_and_customers(spark, sf_dir):
    from skyphrase.sources import dims

    rows = catalogue.queries()["tier_weights"](spark, sf_dir).collect()
    customers = sorted(r[0] for r in spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey").collect())
    assert {r["icao"] for r in rows} >= {r["icao"] for r in dims.airports(spark).collect()} | {"YYYY", "ZZZZ"}
    assert sorted(r["c_custkey"] for r in rows if r["c_custkey"] is not None) == customers
