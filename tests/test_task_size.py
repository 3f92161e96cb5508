"""What one task of the order join holds does not grow with the tables."""

import pytest
from pyspark.sql import functions as F

from starkpi.plans import kpis, lines, rollups
from starkpi.plans.dirty import dirty_star
from starkpi.sources import star as source
from starkpi.sources.star import Star
from tests.conftest import SF_SMALL

QUERIES = {"category": kpis.category_performance, "duplicates": lines.star_duplicate_keys, "star_join": lines.star_join,
           "rfm": lambda s: rollups.customer_rfm(rollups.rolled(s))}


@pytest.fixture()
def parted(spark, monkeypatch):
    monkeypatch.setattr(source, "TASK_LINES", 500)
    monkeypatch.setattr(source, "FEW_LINES", 1000)
    return Star.from_testdata(spark, SF_SMALL)


def test_parts_follow_the_number_of_lines(spark, parted):
    n = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert parted.parts[2] == -(-n // 500)
    held = parted.lines.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert held < 1000 < n


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_parts_change_no_row(star, parted, name):
    def rows(s):
        return sorted(map(str, QUERIES[name](s).collect()))
    assert star.parts[2] == 0 and QUERIES[name](star).columns == QUERIES[name](parted).columns
    assert rows(star) == rows(parted)


def test_star_join_moves_no_line_by_customer(spark, parted, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lines.star_join(parted)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_customer = [row for row in plan.splitlines() if "Exchange hashpartitioning" in row and "cust" in row.split("hashpartitioning")[1]]
    assert by_customer and "customer_id#" in plan
    assert lines.star_join(parted).count() == parted.fact_products().join(parted.customer, "customer_id").count()


@pytest.mark.parametrize("kind", ["customer", "product"])
def test_rollup_sums_are_dealt_by_the_number_of_lines(parted, kind):
    for star in (parted, dirty_star(parted)):
        assert star.tasks == parted.parts[2] > 8  # more than the session's
        sums = rollups.rolled(star).kind(kind)
        held = sums.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
        assert held[0] < 2 * held[1] / star.tasks


def test_rfm_meets_customers_in_parts_of_bounded_size(star, parted):
    for a, b in ((star, parted), (dirty_star(star), dirty_star(parted))):
        few, many = (rollups.customer_rfm(rollups.rolled(s)) for s in (a, b))
        assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
        many.collect()
        assert f"{parted.tasks}), REPARTITION_BY_NUM" in many._jdf.queryExecution().executedPlan().toString().split("Union")[0]
