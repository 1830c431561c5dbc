"""Lookups and enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators.joins import lookup_with_default, with_match, without_match
from marketlake.plans.company import company_overview, listing
from marketlake.plans.standardize import standardize_names
from marketlake.plans.statements import loader_mapping
from marketlake.vocabulary import LOADER_INDICATORS, rows

from .base import MAPPING_SQL, Tables, check, named_rows, part_mapping, values_sql

LISTING_SQL = """
    ind as (select symbol, icb_name2, icb_name3, '' as icb_name4
            from (select upper(c_name) as symbol, c_mktsegment as icb_name2, c_nationkey::varchar as icb_name3
                  from customer)),
    exch as (select * from (select 'CUSTOMER#' || lpad(o_custkey::varchar, 9, '0') as symbol,
                                   o_orderpriority as exchange, o_orderstatus as type_info,
                                   o_totalprice::varchar as organ_short_name, '' as organ_name from orders)
             qualify row_number() over (partition by symbol
                 order by exchange, type_info, organ_short_name) = 1),
    listed as (select ind.*, exchange, type_info, organ_short_name, organ_name
               from ind left join exch using (symbol))
"""


def listings(t: Tables) -> DataFrame:
    industries = t.customer.select(
        F.lower("c_name").alias("code"),
        F.col("c_mktsegment").alias("icb_name2"),
        F.col("c_nationkey").cast("string").alias("icb_name3"),
    )
    exchanges = t.orders.select(
        F.concat(F.lit(" Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("ticker"),
        F.col("o_orderpriority").alias("exchange"),
        F.col("o_orderstatus").alias("type_info"),
        F.format_string("%.2f", "o_totalprice").alias("organ_short_name"),
    )
    return listing(industries, exchanges)


@check(
    "listing_meta",
    "with "
    + LISTING_SQL.replace("o_totalprice::varchar", "format('{:.2f}', o_totalprice)")
    + "select * from listed",
)
def listing_meta(t: Tables) -> DataFrame:
    return listings(t)


@check(
    "overview_enrich",
    "with "
    + LISTING_SQL.replace("o_totalprice::varchar", "format('{:.2f}', o_totalprice)")
    + """, base as (
        select upper(c_name) as symbol, 'profile of ' || c_custkey as company_profile,
               case when c_acctbal < 0 then null when c_nationkey < 9 then '' else 'own ' || c_nationkey end as icb_name2,
               case when c_nationkey >= 9 then 'own' end as icb_name3
        from customer)
    select symbol, company_profile, coalesce(nullif(base.icb_name2, ''), listed.icb_name2) as icb_name2,
           coalesce(nullif(base.icb_name3, ''), listed.icb_name3) as icb_name3, icb_name4, exchange, type_info,
           organ_short_name, organ_name
    from base left join listed using (symbol)""",
)
def overview_enrich(t: Tables) -> DataFrame:
    overview = t.customer.select(
        F.concat(F.lit(" "), F.col("c_name")).alias("symbol"),
        F.concat(F.lit("profile of "), F.col("c_custkey").cast("string")).alias("company_profile"),
        F.when(F.col("c_acctbal") < 0, None)
        .when(F.col("c_nationkey") < 9, "")
        .otherwise(F.concat(F.lit("own "), F.col("c_nationkey").cast("string")))
        .alias("icb_name2"),
        F.when(F.col("c_nationkey") >= 9, "own").alias("icb_name3"),
    )
    return company_overview(overview, listings(t))


@check(
    "standardize_indicators",
    f"""select l_orderkey, l_linenumber, l_partkey, l_quantity, coalesce(std_ind_name, p_name) as ind_name
        from lineitem join part on l_partkey = p_partkey left join ({MAPPING_SQL}) on p_name = raw_ind_name""",
)
def standardize_indicators(t: Tables) -> DataFrame:
    return standardize_names(named_rows(t), part_mapping(t))


@check(
    "map_indicators",
    f"""select l_orderkey, l_linenumber, l_partkey, coalesce(vi_name, name) as ind_name,
               coalesce(code, upper(replace(name, ' ', '_'))[1:50]) as ind_code
        from (select *, case l_returnflag when 'A' then 'Net Sales' when 'N' then 'Interest Expense'
                        else 'Indicator of part ' || l_partkey || ' with a name beyond fifty characters' end as name
              from lineitem)
        left join {values_sql(rows(LOADER_INDICATORS), 'm(en_name, vi_name, code)')} on name = en_name""",
)
def map_indicators(t: Tables) -> DataFrame:
    name = (
        F.when(F.col("l_returnflag") == "A", " Net Sales")
        .when(F.col("l_returnflag") == "N", "Interest Expense")
        .otherwise(F.format_string("Indicator of part %d with a name beyond fifty characters", "l_partkey"))
    )
    named = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", name.alias("raw"))
    return lookup_with_default(named, loader_mapping(t.spark), "raw", "ind_name", "ind_code").drop("raw")


@check(
    "anti_join_known",
    """select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_quantity > 40)""",
)
def anti_join_known(t: Tables) -> DataFrame:
    known = t.lineitem.where("l_quantity > 40").withColumnRenamed("l_orderkey", "o_orderkey")
    return without_match(t.orders.select("o_orderkey"), known, ["o_orderkey"])


@check(
    "semi_join_known",
    """select o_orderkey from orders where o_orderkey in (select l_orderkey from lineitem where l_quantity > 40)""",
)
def semi_join_known(t: Tables) -> DataFrame:
    known = t.lineitem.where("l_quantity > 40").withColumnRenamed("l_orderkey", "o_orderkey")
    return with_match(t.orders.select("o_orderkey"), known, ["o_orderkey"])
