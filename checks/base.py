"""Registration and the stand-ins several queries share."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import with_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RUN_TS = "2026-01-15 08:00:00"


class Tables:
    """``t.orders`` reads the orders table."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def check(name: str, sql: str | None = None) -> Callable:
    """Register ``fn(tables) -> DataFrame`` as a query."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable:
        @wraps(fn)
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(with_folder(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# Part names stand in for indicator names: "red ring" and "blue ring" both become
# "painted ring", so the mapping covers half the names and maps two to one.
MAPPING_SQL = """
    select distinct p_name as raw_ind_name,
           case when split_part(p_name, ' ', 1) in ('red', 'blue') then 'painted '
                else 'tempered ' end || split_part(p_name, ' ', 2) as std_ind_name
    from part where split_part(p_name, ' ', 1) in ('red', 'blue', 'hot', 'cold')
"""


def part_mapping(t: Tables) -> DataFrame:
    word = F.split("p_name", " ")
    kind = F.when(word[0].isin("red", "blue"), "painted ").otherwise("tempered ")
    return (
        t.part.where(word[0].isin("red", "blue", "hot", "cold"))
        .select(F.col("p_name").alias("raw_ind_name"), F.concat(kind, word[1]).alias("std_ind_name"))
        .distinct()
    )


NAMES_SQL = """
    select p_name as ind_name, count(*) as record_count
    from lineitem join part on l_partkey = p_partkey group by p_name
"""


def part_name_counts(t: Tables) -> DataFrame:
    """Line items per part name. Counting per part first keeps a hot part out of the join."""
    per_part = t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    named = per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return named.groupBy(F.col("p_name").alias("ind_name")).agg(
        F.sum("n").cast("bigint").alias("record_count")
    )


def named_rows(t: Tables) -> DataFrame:
    """Line items with their part name."""
    return t.lineitem.join(
        t.part.select("p_partkey", F.col("p_name").alias("ind_name")),
        F.col("l_partkey") == F.col("p_partkey"),
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "ind_name")


def bars(t: Tables) -> DataFrame:
    """Events as price bars: user is the ticker, the value is the close."""
    return t.events.select(
        F.concat(F.lit(" u"), F.col("user_id").cast("string")).alias("symbol"),
        F.date_format("ts", "yyyy-MM-dd").alias("Time"),
        F.col("value").cast("string").alias("close"),
        F.col("event_id").alias("_event"),
    )


def wide_statement(t: Tables) -> DataFrame:
    """Line items as a wide statement: part, year and quarter, then four measures."""
    return t.lineitem.select(
        F.col("l_partkey").cast("string").alias("CP"),
        F.year("l_shipdate").alias("Nam"),
        F.quarter("l_shipdate").alias("Ky"),
        F.col("l_quantity").alias("Net Inventories"),
        F.col("l_extendedprice").alias("Sales"),
        F.col("l_discount").alias("Sales deductions"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("Tax For the Year"),
    )


WIDE_SQL = """
    select l_partkey::varchar as ticker, year(l_shipdate)::int as year,
           quarter(l_shipdate)::int as quarter, l_quantity as "Net Inventories",
           l_extendedprice as "Sales", l_discount as "Sales deductions",
           nullif(l_tax, 0) as "Tax For the Year" from lineitem
"""
LONG_SQL = f"""
    select * from ({WIDE_SQL}) unpivot include nulls
    (value for ind_name in ("Net Inventories", "Sales", "Sales deductions", "Tax For the Year"))
"""


def values_sql(rows: list[tuple[str, ...]], names: str) -> str:
    """Rows as an inline SQL table."""
    quoted = ", ".join(
        "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows
    )
    return f"(values {quoted}) as {names}"
