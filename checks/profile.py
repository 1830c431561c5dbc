"""Profiles, quality measures and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators import profile, quality
from marketlake.operators.partials import partition_counts
from marketlake.operators.tables import replace_partitions
from marketlake.session import materialize, new_folder

from marketlake.vocabulary import SPECIAL_CHARACTERS

from .base import MAPPING_SQL, NAMES_SQL, Tables, check, part_mapping, part_name_counts

WITH = f"with m as ({MAPPING_SQL}), names as ({NAMES_SQL})"
AFTER = (
    ", after as (select coalesce(std_ind_name, ind_name) as ind_name, sum(record_count)::bigint as record_count"
    " from names left join m on ind_name = raw_ind_name group by 1)"
)


@check(
    "profile_before",
    f"""{WITH} select sum(record_count)::bigint as total_records, count(*) as unique_indicators,
              count(raw_ind_name) as mappable_indicators,
              count(*) - count(raw_ind_name) as unmapped_indicators
        from names left join m on ind_name = raw_ind_name""",
)
def profile_before(t: Tables) -> DataFrame:
    return profile.profile_before(part_name_counts(t), part_mapping(t))


@check(
    "unmapped_names",
    f"""{WITH} select ind_name from names where ind_name not in (select raw_ind_name from m)
        order by ind_name limit 20""",
)
def unmapped_names(t: Tables) -> DataFrame:
    return profile.unmapped_names(part_name_counts(t), part_mapping(t))


@check("standard_name_counts", f"{WITH}{AFTER} select * from after")
def standard_name_counts(t: Tables) -> DataFrame:
    return profile.counts_after(part_name_counts(t), part_mapping(t))


@check(
    "top_indicators",
    f"{WITH}{AFTER} select * from after order by record_count desc, ind_name limit 10",
)
def top_indicators(t: Tables) -> DataFrame:
    return profile.top_names(profile.counts_after(part_name_counts(t), part_mapping(t)))


@check(
    "still_unmapped",
    f"""{WITH}{AFTER} select * from after where ind_name not in (select std_ind_name from m)
        order by record_count desc, ind_name limit 10""",
)
def still_unmapped(t: Tables) -> DataFrame:
    mapping = part_mapping(t)
    return profile.still_unmapped(profile.counts_after(part_name_counts(t), mapping), mapping)


@check(
    "profile_after",
    f"""{WITH}{AFTER} select count(*) as unique_after, sum(record_count)::bigint as total_records from after""",
)
def profile_after(t: Tables) -> DataFrame:
    after = profile.counts_after(part_name_counts(t), part_mapping(t))
    return after.agg(
        F.count("ind_name").alias("unique_after"),
        F.sum("record_count").cast("bigint").alias("total_records"),
    )


@check(
    "reduction_report",
    f"""{WITH}{AFTER} select b as unique_before, a as unique_after, b - a as reduced,
               round((b - a) * 100.0::double / b, 1) as reduced_percent
        from (select (select count(*) from names) as b, (select count(*) from after) as a)""",
)
def reduction_report(t: Tables) -> DataFrame:
    before = materialize(part_name_counts(t))
    return profile.reduction_report(before, profile.counts_after(before, part_mapping(t)))


@check(
    "updated_rows",
    f"{WITH} select sum(record_count)::bigint as updated_rows from names join m on ind_name = raw_ind_name",
)
def updated_rows(t: Tables) -> DataFrame:
    return profile.updated_rows(part_name_counts(t), part_mapping(t))


@check(
    "null_empty_stats",
    """select count(*) as total_rows, sum((event_type = 'error')::int)::bigint as null_names,
              sum((event_type = 'view')::int)::bigint as empty_names from events""",
)
def null_empty_stats(t: Tables) -> DataFrame:
    name = F.when(F.col("event_type") == "view", "").otherwise(F.nullif("event_type", F.lit("error")))
    return quality.null_empty_stats(t.events.select(name.alias("ind_name")), "ind_name")


ISSUE_SQL = f"""
    case when text like '%  %' then 'double_space'
         when text like ' %' or text like '% ' then 'leading_trailing_space'
         when regexp_matches(text, '{SPECIAL_CHARACTERS}') then 'special_characters' else 'clean' end
"""


@check(
    "quality_buckets",
    f"""select {ISSUE_SQL} as issue_type, count(*) as record_count
        from (select unnest(string_split(text, chr(10))) as text from documents) group by 1""",
)
def quality_buckets(t: Tables) -> DataFrame:
    lines = t.documents.select(F.explode(F.split("text", "\n")).alias("line"))
    return quality.quality_buckets(lines, "line")


@check(
    "quality_bucket_names",
    f"select {ISSUE_SQL.replace('text', 'p_name')} as issue_type, count(*) as record_count from (select case when p_size < 10 then p_name || ' ' when p_size < 20 then replace(p_name, ' ', '  ') when p_size < 30 then p_name || ' & co.' else p_name || '.' end as p_name from part) group by 1",
)
def quality_bucket_names(t: Tables) -> DataFrame:
    size = F.col("p_size")
    name = F.col("p_name")
    spoilt = (
        F.when(size < 10, F.concat(name, F.lit(" ")))
        .when(size < 20, F.replace(name, F.lit(" "), F.lit("  ")))
        .when(size < 30, F.concat(name, F.lit(" & co.")))
        .otherwise(F.concat(name, F.lit(".")))
    )
    return quality.quality_buckets(t.part.select(spoilt.alias("p_name")), "p_name")


@check(
    "duplicate_keys",
    """select l_orderkey, l_linenumber, count(*) as cnt from lineitem
       group by l_orderkey, l_linenumber having count(*) > 1""",
)
def duplicate_keys(t: Tables) -> DataFrame:
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@check(
    "min_rows",
    "select count(*) as total_rows, 158::bigint as least, count(*) >= 158 as passed from orders",
)
def min_rows(t: Tables) -> DataFrame:
    return quality.min_rows(t.orders, 158)


@check(
    "rows_per_batch",
    """select o_orderstatus, o_orderpriority, count(*) as row_count from orders
       group by o_orderstatus, o_orderpriority""",
)
def rows_per_batch(t: Tables) -> DataFrame:
    return profile.rows_per_batch(t.orders, ["o_orderstatus", "o_orderpriority"])


@check("distinct_list", "select distinct l_partkey from lineitem")
def distinct_list(t: Tables) -> DataFrame:
    return profile.distinct_values(t.lineitem, "l_partkey")


@check(
    "profile_by_change",
    f"""{WITH} select sum(record_count)::bigint as total_records, count(*) as unique_indicators,
              count(raw_ind_name) as mappable_indicators,
              count(*) - count(raw_ind_name) as unmapped_indicators, 1 as partitions_scanned
        from names left join m on ind_name = raw_ind_name""",
)
def profile_by_change(t: Tables) -> DataFrame:
    """The profile of a table by status, of which one partition came since the last profile."""
    target, store = new_folder(t.spark, "items"), new_folder(t.spark, "profile")
    names = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("ind_name"))
    items = t.lineitem.join(names, "l_partkey").select("ind_name", "l_quantity", F.col("l_returnflag").alias("flag"))
    replace_partitions(items.where("flag <> 'R'"), target, ["flag"])
    partition_counts(t.spark, target, store)
    replace_partitions(items.where("flag = 'R'"), target, ["flag"])
    counts, scanned = partition_counts(t.spark, target, store)
    found = profile.profile_before(profile.sum_counts(counts), part_mapping(t))
    return found.withColumn("partitions_scanned", F.lit(scanned))
