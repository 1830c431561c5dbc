"""Table functions in SQL."""

import pytest
from pyspark.errors import AnalysisException

from marketlake import registry

from .conftest import rows


def test_filters_reach_the_scan_and_arguments_are_typed(spark, place):
    spark.range(100).selectExpr("id", "cast(id * 2 as double) as price").write.parquet(f"{place}/t")
    spark.read.parquet(f"{place}/t").createOrReplaceTempView("registry_prices")
    query = "select id, price from registry_prices where price >= `at least`.least"
    registry.sql_function(spark, "at least", {"least": "double default 190"}, {"id": "bigint", "price": "double"}, query)
    found = spark.sql("select id from `at least`(195) where id < 99")
    assert rows(found) == [(98,)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(price,195.0)" in plan and "LessThan(id,99)" in plan
    assert spark.sql("select * from `at least`()").count() == 5
    assert spark.sql("select * from `at least`(least => 198)").count() == 1
    with pytest.raises(AnalysisException):
        spark.sql("select * from `at least`(1, 2)").count()
    registry.sql_function(spark, "at least", {}, {"id": "bigint"}, "select id from registry_prices")
    assert spark.sql("select * from `at least`()").count() == 100
