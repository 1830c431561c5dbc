import pytest
from pyspark.sql import functions as F

from marketlake import registry
from marketlake.operators import columns, dedup, filters, joins, profile, quality, reshape
from marketlake.plans import company, prices

from .conftest import rows


def test_rename_refuses_two_sources(spark):
    df = spark.createDataFrame([(1, 2)], "time int, date int")
    with pytest.raises(ValueError, match="trading_date"):
        columns.rename_synonyms(df, columns.PRICE_SYNONYMS)


def test_require_columns_names_them(spark):
    with pytest.raises(ValueError, match=r"\['b', 'c'\]"):
        columns.require_columns(spark.range(1).toDF("a"), ["a", "b", "c"])


def test_normalize_symbol_without_source_is_empty(spark):
    out = columns.normalize_symbol(spark.range(5).toDF("x"))
    assert out.count() == 0 and "symbol" in out.columns


def test_exact_date_mode(spark):
    df = spark.createDataFrame([("ngày 11/2/2026",), ("1/2/2026",), ("1/20",), (None,)], "t string")
    loose = [r[0] for r in df.select(filters.matches_day(F.col("t"), "2026-02-01")).collect()]
    exact = [r[0] for r in df.select(filters.matches_day(F.col("t"), "2026-02-01", "exact_date")).collect()]
    assert loose == [True, True, True, False]
    assert exact == [False, True, False, False]
    assert df.where(filters.matches_day(F.col("t"), None)).count() == 4


def test_fallback_keeps_groups_without_match(spark):
    data = [("a", 1), ("a", 2), ("b", 3), ("b", None), (None, 5), (None, 1)]
    df = spark.createDataFrame(data, "g string, v int")
    out = filters.keep_matches_or_all(df, "g", F.col("v") == 1)
    assert rows(out) == sorted([("a", 1), ("b", 3), ("b", None), (None, 1)], key=repr)


def test_year_filter_ignores_text(spark):
    df = spark.createDataFrame([("2024",), ("2025.0",), ("x",)], "year string")
    assert filters.for_year(df, "year", "any").count() == 3
    assert rows(filters.for_year(df, "year", 2025)) == [("2025.0",)]


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", 3, "z"), ("b", 1, "w")], "k string, o int, v string")
    assert rows(dedup.keep_first(df, ["k"], ["o"]), "k", "v") == [("a", "y"), ("b", "w")]
    assert rows(dedup.keep_last(df, ["k"], ["o"]), "k", "v") == [("a", "z"), ("b", "w")]


def test_dedup_news_key(spark):
    data = [("1", "t", "b"), ("1", "u", "a"), (None, "t", "c"), (None, "t", "d"), (None, " ", "e"), ("", None, "f")]
    df = spark.createDataFrame(data, "id string, title string, ticker string")
    out = dedup.dedup_news(df, "id", "title", ["ticker"])
    assert rows(out, "id", "ticker") == sorted([("1", "a"), (None, "c")], key=repr)


@pytest.mark.parametrize("n", [0, 1, 19, 20, 61])
def test_batches_give_back_the_input(spark, n):
    df = spark.range(n).select(F.format_string("s%03d", "id").alias("symbol")).repartition(5)
    out = dedup.batch_lists(dedup.assign_batches(df, 20, ["symbol"]), "symbol").orderBy("batch").collect()
    assert [s for r in out for s in r["symbols"]] == [f"s{i:03d}" for i in range(n)]
    assert all(len(r["symbols"]) == 20 for r in out[:-1])


def test_listing_and_overview(spark):
    industries = spark.createDataFrame([(" hpg ", "Steel"), ("VIC", "Land"), ("VIC", "Air")], "ticker string, icb_name2 string")
    exchanges = spark.createDataFrame([("HPG", "HOSE", "Hoa Phat")], "code string, exchange string, organ_name string")
    listed = company.listing(industries, exchanges)
    overview = spark.createDataFrame(
        [("hpg", "p1", "", None), ("vic", "p2", "Own", "X"), ("zzz", "p3", None, None)],
        "symbol string, company_profile string, icb_name2 string, organ_name string",
    )
    out = company.company_overview(overview, listed)
    assert rows(out, "symbol", "icb_name2", "exchange", "organ_name") == [
        ("HPG", "Steel", "HOSE", "Hoa Phat"),
        ("VIC", "Own", None, "X"),
        ("ZZZ", None, None, None),
    ]


def test_people_and_officers(spark):
    holders = spark.createDataFrame([("HPG", " Trần\xa0", 1e-05)], "symbol string, share_holder string, share_own_percent double")
    officers = spark.createDataFrame([("HPG", "Lê", "CEO")], "symbol string, officer_name string, officer_position string")
    out = company.load_people(company.people(holders, officers), "2026-01-01 00:00:00")
    assert rows(out, "name", "position", "percent", "type") == [
        ("Lê", "CEO", "0", "officer"),
        ("Trần", "Cổ đông", "0.00001", "shareholder"),
    ]


def test_melt_keeps_nulls_and_row_count(spark):
    df = spark.createDataFrame(
        [("A", 2024, 1, 1.0, None), ("B", 2024, 2, None, 4.0)], "CP string, Nam long, Ky long, `Net Sales` double, `x.y` double"
    )
    long = reshape.melt_wide(df)
    assert long.count() == 4
    assert rows(long.where("value is null"), "ticker", "ind_name") == [("A", "x.y"), ("B", "Net Sales")]


def test_duplicate_gate(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    with pytest.raises(quality.QualityError, match="'a', 2"):
        quality.assert_unique(df, ["k"])
    assert quality.assert_unique(df.distinct(), ["k"]).count() == 2


def test_row_and_blank_gates(spark):
    df = spark.createDataFrame([("a",), (None,), ("",)], "n string")
    with pytest.raises(quality.QualityError, match="3 rows, at least 4"):
        quality.assert_min_rows(df, 4)
    with pytest.raises(quality.QualityError, match="1 null, 1 empty"):
        quality.assert_no_blank(df, "n")
    assert quality.on_empty(df.where("false")) is None
    with pytest.raises(quality.QualityError):
        quality.on_empty(df.where("false"), "error")


def test_name_issues(spark):
    names = ["a  b ", " a", "a ", "a&b", "a.b", "Lợi nhuận (A), b-c/d", None, ""]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    out = [r[0] for r in df.orderBy("i").select(quality.name_issue(F.col("n"))).collect()]
    assert out == [
        "double_space", "leading_trailing_space", "leading_trailing_space", "special_characters",
        "clean", "clean", "clean", "clean",
    ]


def test_profile_counts_nulls_as_unmapped(spark):
    names = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("c",)], "ind_name string")
    mapping = spark.createDataFrame([("a", "A"), ("b", "A"), ("A", "A")], "raw_ind_name string, std_ind_name string")
    counts = profile.name_counts(names)
    assert tuple(profile.profile_before(counts, mapping).first()) == (5, 3, 2, 1)
    assert [r[0] for r in profile.unmapped_names(counts, mapping).collect()] == ["c", None]
    after = profile.counts_after(counts, mapping)
    assert dict(rows(after)) == {"A": 3, "c": 1, None: 1}
    assert tuple(profile.reduction_report(counts, after).first()) == (3, 2, 1, 33.3)
    assert profile.updated_rows(counts, mapping).first()[0] == 3


def test_lookup_default(spark):
    mapping = spark.createDataFrame([("Net Sales", "Doanh thu thuần", "NET_SALES")], "en_name string, vi_name string, code string")
    df = spark.createDataFrame([(" Net Sales ",), ("Odd name",), (None,)], "n string")
    out = joins.lookup_with_default(df, mapping, "n", "name", "code")
    assert rows(out, "name", "code") == sorted(
        [("Doanh thu thuần", "NET_SALES"), ("Odd name", "ODD_NAME"), (None, None)], key=repr
    )


def test_prices_edge_rows(spark):
    data = [
        (" hpg ", "2024-01-05", "10", "1"),
        ("HPG", "2024-01-05", "11", "2"),
        (None, "2024-01-05", "12", "3"),
        ("VIC", "bad", "13", "4"),
        ("VIC", None, "14", "5"),
        ("VIC", "2024-01-06", "x", "6"),
    ]
    df = spark.createDataFrame(data, "index_code string, `TradingDate ` string, Close string, _o string")
    out = prices.normalize_prices(df, ["_o"])
    assert rows(out.select("ticker", F.col("trading_date").cast("string"), "close", "volume")) == [
        ("HPG", "2024-01-05", 10.0, None),
        ("VIC", "2024-01-06", None, None),
    ]
    with pytest.raises(ValueError, match="volume"):
        prices.normalize_prices(df, ["_o"], require=True)
    with pytest.raises(quality.QualityError):
        prices.daily_prices(out, "2030-01-01", ["close"])
    with pytest.raises(quality.QualityError):
        prices.index_series(out, ["close"], "2030-01-01")


def test_registry(spark):
    @registry.table_function("tests.numbers")
    def numbers(spark, n):
        return spark.range(n) if n else None

    @registry.table_function("tests.wrong")
    def wrong(spark):
        return [1]

    assert registry.call(spark, "tests.numbers", n=3).count() == 3
    assert registry.call(spark, "tests.numbers", n=0).isEmpty()
    with pytest.raises(TypeError):
        registry.call(spark, "tests.wrong")
    with pytest.raises(KeyError):
        registry.call(spark, "tests.none")
    assert "checks.big_orders" in registry.load("checks.workflows")
    with pytest.raises(ValueError):
        registry.table_function("tests.wrong")(wrong)
