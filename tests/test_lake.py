import json
import os
import time

import pyarrow as pa
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marketlake.operators.quality import QualityError
from marketlake.plans import news, prices, ratios, site_news
from marketlake.schemas import NEWS_CSV, NEWS_JSON, PRICE_RAW, struct
from marketlake.sources import lake, readers
from marketlake.streaming.ingest import ingest_files, ingest_stream, upsert_load

from .conftest import rows


def put(folder, name, text, encoding="utf-8"):
    os.makedirs(folder, exist_ok=True)
    (folder / name).write_text(text, encoding=encoding)


def test_bom_quotes_and_newlines(spark, tmp_path, place):
    put(tmp_path / "in", "a.csv", 'doc_id,text\n1,"line one\nline ""two"""\n2,plain\n', "utf-8-sig")
    out = readers.read_csv_lake(spark, f"{place}/in", struct("doc_id bigint, text string"), multiline=True)
    assert rows(out) == [(1, 'line one\nline "two"'), (2, "plain")]


def test_changed_header_is_not_read_by_position(spark, tmp_path, place):
    put(tmp_path / "in", "a.csv", "b,a\n1,2\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.read_csv_lake(spark, f"{place}/in", struct("a int, b int")).collect()


def test_by_name(spark, tmp_path, place):
    put(tmp_path / "in", "a.csv", "ticker,close\nA,1\n")
    put(tmp_path / "in", "b.csv", "Volume,Ticker ,close\n7,B,x\n", "utf-8-sig")
    put(tmp_path / "in", "c d.csv", "close,ticker\n3,C\n")
    out = readers.read_csv_by_name(spark, f"{place}/in", struct("ticker string, close double, volume double"))
    assert rows(out) == [("A", 1.0, None), ("B", None, 7.0), ("C", 3.0, None)]


def test_write_lake_skips_empty_and_replaces(spark, place, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "t string, batch int")
    assert lake.write_lake(df, place, "d", "2026-01-01", "csv", batch="batch", bom=True) == 2
    assert lake.write_lake(df.where("false"), place, "d", "2026-01-01", "csv", batch="batch") == 0
    folder = tmp_path / "d" / "ds=2026-01-01" / "batch=1"
    files = [f for f in os.listdir(folder) if f.endswith(".csv")]
    assert (folder / files[0]).read_bytes() == b"\xef\xbb\xbft\na\n"
    assert lake.write_lake(df.where("batch = 1"), place, "d", "2026-01-01", "csv", batch="batch") == 1
    assert len([f for f in os.listdir(folder) if f.endswith(".csv")]) == 1


def test_written_batches(spark, place):
    df = spark.createDataFrame([("a", "x y"), ("b", "p/q+%")], "t string, batch string")
    assert rows(lake.written_batches(spark, place, "d", "2026-01-01")) == []
    lake.write_lake(df, place, "d", "2026-01-01", batch="batch")
    lake.write_lake(df.limit(1).withColumn("batch", F.lit("z")), place, "d", "2026-01-02", batch="batch")
    assert rows(lake.written_batches(spark, place, "d", "2026-01-01")) == [("p/q+%",), ("x y",)]


def dated(spark, place, days):
    for d in range(1, days + 1):
        df = spark.createDataFrame([(f"T{d}", float(d))], "ticker string, close double")
        if d % 2:
            df = df.select("close", "ticker", F.lit("x").alias("extra"))
        lake.write_lake(df, place, "p", f"2026-01-{d:02d}", "csv")


@pytest.mark.parametrize("days, status", [(0, "no_keys"), (1, "only_latest_kept"), (10, "older<10,skip")])
def test_compaction_waits(spark, place, days, status):
    dated(spark, place, days)
    assert lake.compact_partitions(spark, f"{place}/p") == {"status": status}


def test_compaction_keeps_all_rows(spark, place, tmp_path):
    dated(spark, place, 11)
    done = lake.compact_partitions(spark, f"{place}/p")
    assert (done["status"], done["files"], done["rows"]) == ("archived", 10, 10)
    assert done["archive"].endswith("_archive/2026-01-01_2026-01-10")
    archive = spark.read.parquet(done["archive"])
    assert rows(archive, "ticker", "close", "extra") == sorted(
        [(f"T{d}", f"{d}.0", "x" if d % 2 else None) for d in range(1, 11)], key=repr
    )
    # The archive is no date of its own in the next run.
    assert lake.compact_partitions(spark, f"{place}/p") == {"status": "only_latest_kept"}


def test_object_keys(spark):
    assert lake.object_key("global_index", series="usd_vnd", ds="2026-01-01") == "global_index/usd_vnd/2026-01-01/data.csv"
    df = spark.createDataFrame([(0,), (1,)], "b int")
    keys = df.select(lake.object_keys("bctc", "2026-01-01", F.col("b")).alias("key"))
    present = spark.createDataFrame([("bctc/2026-01-01/batch_1.csv",)], "key string")
    assert rows(lake.missing_outputs(keys, present, "key")) == [("bctc/2026-01-01/batch_0.csv",)]


def test_first_non_empty_fails_on_nothing(spark):
    with pytest.raises(QualityError):
        readers.first_non_empty(spark.range(0), spark.range(0))


SITEMAP = """<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:news="http://www.google.com/schemas/sitemap-news/0.9">
<url><loc>u1</loc><news:news><news:publication_date>2026-02-01T08:00:00+07:00</news:publication_date></news:news></url>
<url><loc>u2</loc><news:news><news:publication_date>2026-01-31</news:publication_date></news:news></url>
<url><loc>u3</loc></url><url><loc></loc></url></urlset>"""
RSS = "<rss><channel><item><title>t</title><link>r1</link></item><item><title>no link</title></item></channel></rss>"


def test_site_news(spark, tmp_path, place):
    put(tmp_path / "sm", "a.xml", SITEMAP)
    put(tmp_path / "sm2", "a.xml", SITEMAP.replace("2026-02-01", "2020-09-09").replace("<url><loc>u3</loc></url>", ""))
    put(tmp_path / "rss", "a.rss", RSS)
    sitemaps = {"cafef": readers.read_sitemap(spark, f"{place}/sm"), "vneconomy": readers.read_sitemap(spark, f"{place}/sm2")}
    wanted = site_news.candidates(sitemaps, {"vnexpress": readers.read_rss(spark, f"{place}/rss")}, "2026-02-01")
    assert rows(wanted) == [
        ("cafef", "u1"), ("cafef", "u3"), ("vneconomy", "u1"), ("vneconomy", "u2"), ("vnexpress", "r1")
    ]
    page = '<h1 class="title">T</h1><h1 class="title-detail">R</h1><b class="pdate">{0}</b><b class="date">{0}</b>'
    pages = spark.createDataFrame(
        [("u1", page.format("01/02/2026")), ("u3", page.format("15/03/2026")), ("r1", None)], "url string, html string"
    )
    day = site_news.day_articles(wanted, pages, "2026-02-01", "now")
    assert rows(day, "source", "url", "title") == [("cafef", "u1", "T")]
    other = site_news.day_articles(wanted, pages, "2026-05-09", "now")
    assert rows(other, "source", "url") == [("cafef", "u1"), ("cafef", "u3"), ("vneconomy", "u1")]


def test_news_shapes_share_one_table(spark, tmp_path, place):
    items = [
        {"news_id": "1", "news_title": "a", "public_date": 0},
        {"news_id": "1", "news_title": "b", "lang_code": "en", "public_date": 1704067200000},
        {"news_id": "2", "related_ticker": "HPG", "public_date": None},
    ]
    put(tmp_path / "json", "a.json", json.dumps(items))
    put(tmp_path / "csv", "a.csv", 'title,ticker,description,link,image,source,date\nt,,"x\ny",l,,s,2026-01-02\n" ",,,,,,\n,,,,,,\nt,,z,,,,\n')
    from_json = news.news_from_json(readers.read_json_array(spark, f"{place}/json", NEWS_JSON, {"lang_code": "vi"}), "2026-01-01 00:00:00")
    from_csv = news.news_from_csv(readers.read_csv_lake(spark, f"{place}/csv", NEWS_CSV, multiline=True), "2026-01-01 00:00:00")
    assert news.load_news(from_json, f"{place}/t", ["title"]) == 2
    assert news.load_news(from_csv, f"{place}/t", ["short_content"]) == 1
    assert news.load_news(from_csv.unionByName(from_json), f"{place}/t", ["title"]) == 0
    table = spark.read.parquet(f"{place}/t")
    assert rows(table, "news_id", "title", "short_content", "lang_code", "source_name") == sorted(
        [
            ("1", "a", None, "vi", "FiinGroup"),
            ("2", None, None, "vi", "FiinGroup"),
            ("e358efa489f58062f10dd7316b65649e", "t", "x\ny", None, "s"),
        ],
        key=repr,
    )


def test_daily_news(spark):
    data = [
        ("1", "n1", "t1", " hpg", "2026-01-01 09:00:00", "0.5"),
        ("1", "n1", "t1", "vic", "2026-01-01", "x"),
        ("2", None, "t2", "VIC", "2026-01-01", None),
        ("3", None, "t3", "VIC", "2026-01-02", None),
        ("4", None, "t4", " ", "2026-01-01", None),
        (None, None, "t5", "VIC", "2026-01-01", None),
    ]
    raw = spark.createDataFrame(
        data, "id string, news_id string, news_title string, related_ticker string, published_date string, price_change_pct string"
    )
    out = news.daily_news(raw, "2026-01-01", "2026-01-01 18:00:00")
    assert rows(out, "news_id", "related_ticker", "price_change_pct") == [("2", "VIC", None), ("n1", "HPG", 0.5)]


def price_file(folder, name, *lines):
    put(folder, name, "ticker,trading_date,open,high,low,close,volume\n" + "".join(f"{x}\n" for x in lines))


def closes(spark, table):
    return rows(spark.read.parquet(table).select("ticker", F.col("trading_date").cast("string"), "close"))


def test_files_are_loaded_once(spark, tmp_path, place):
    lake_dir = tmp_path / "lake" / "2026-01-01"
    load = upsert_load(f"{place}/t", list(prices.KEY), prices.month_partition())

    def run():
        args = (spark, f"{place}/lake", f"{place}/log", prices.clean_prices, load, "2026-01-01 00:00:00")
        return ingest_files(*args, check=prices.check_header)

    price_file(lake_dir, "batch_0.csv", "a,2026-01-01,,,,1,", "A,2026-01-01,,,,2,", ",2026-01-01,,,,3,", "B,bad,,,,4,")
    assert run() == {"status": "loaded", "files": 1}
    assert closes(spark, f"{place}/t") == [("A", "2026-01-01", 1.0)]  # the first row of a key in its file
    assert run() == {"status": "skip", "files": 0}
    put(lake_dir, "batch_1.csv", "\n\nindex_code,time,close,Volume,low,high,open\nA,2026-01-01,9,,,,\nC,2026-01-02,5,,,,\n")
    assert run() == {"status": "loaded", "files": 1}
    assert closes(spark, f"{place}/t") == [("A", "2026-01-01", 9.0), ("C", "2026-01-02", 5.0)]
    assert spark.read.parquet(f"{place}/log").count() == 2
    table = spark.read.parquet(f"{place}/t")
    assert table.where("loaded_at is null or source_file not like '%batch_%'").count() == 0
    put(lake_dir, "batch_2.csv", "ticker,time,open\nA,2026-01-01,9\n")  # would replace closes by nulls
    with pytest.raises(QualityError, match="batch_2.csv.*close"):
        run()


@pytest.mark.parametrize("files_per_batch", [1, 2, 100])
def test_batches_do_not_change_the_result(spark, tmp_path, place, files_per_batch):
    for i, close in enumerate((4, 3, 9, 1)):
        price_file(tmp_path / "lake", f"batch_{i}.csv", f"A,2026-01-01,,,,{close},", "A,2026-01-01,,,,77,", f"B{i},2026-01-01,,,,{i},")
    load = upsert_load(f"{place}/t", list(prices.KEY), prices.month_partition())
    args = (spark, f"{place}/lake", f"{place}/log", prices.clean_prices, load, "2026-01-01 00:00:00")
    assert ingest_files(*args, files_per_batch=files_per_batch) == {"status": "loaded", "files": 4}
    assert closes(spark, f"{place}/t")[0] == ("A", "2026-01-01", 1.0)
    stream = upsert_load(f"{place}/s", list(prices.KEY), prices.month_partition())
    for i in range(4):
        os.utime(tmp_path / "lake" / f"batch_{i}.csv", (1.7e9 + i, 1.7e9 + i))
    ingest_stream(spark, f"{place}/lake", PRICE_RAW, f"{place}/ckpt", prices.clean_prices, stream, files_per_batch=files_per_batch)
    assert closes(spark, f"{place}/s") == closes(spark, f"{place}/t")


def test_late_files_are_not_too_old(spark, tmp_path, place):
    load = upsert_load(f"{place}/t", list(prices.KEY), prices.month_partition())
    run = lambda: ingest_stream(spark, f"{place}/lake", PRICE_RAW, f"{place}/ckpt", prices.clean_prices, load)
    price_file(tmp_path / "lake", "a.csv", "A,2026-01-01,,,,1,")
    assert run() == 1
    price_file(tmp_path / "lake", "b.csv", "B,2026-01-01,,,,2,")
    ten_days_ago = time.time() - 10 * 86_400
    os.utime(tmp_path / "lake" / "b.csv", (ten_days_ago, ten_days_ago))
    price_file(tmp_path / "lake", "c.csv", "C,2026-01-01,,,,3,")
    assert run() == 1
    assert [r[0] for r in closes(spark, f"{place}/t")] == ["A", "B", "C"]


def test_compaction_loses_nothing(spark, tmp_path, place):
    for d in range(1, 12):
        blank = "\n  \n" if d == 3 else ""
        put(tmp_path / "p" / f"ds=2026-01-{d:02d}", "x.csv", f"{blank}ticker,close\nT{d},{d}\nU{d},{d}\n")
    put(tmp_path / "p" / "ds=2026-01-04", "y.csv", "\n\n")
    first = lake.compact_partitions(spark, f"{place}/p")
    assert (first["rows"], first["files"]) == (20, 11)
    for d in range(1, 11):  # late files of the same dates
        put(tmp_path / "p" / f"ds=2026-01-{d:02d}", "late.csv", f"close,ticker\n{d},L{d}\n")
    second = lake.compact_partitions(spark, f"{place}/p")
    assert second["archive"] == first["archive"] and second["rows"] == 10
    archive = spark.read.parquet(second["archive"])
    assert archive.count() == 30 and archive.where("ticker like 'L%'").count() == 10


def test_many_headers(spark, tmp_path, place):
    for i in range(130):
        put(tmp_path / "r", f"C{i}.csv", f"x{i},roe\n{i},0.5\n")
    found = ratios.ratios_folder(spark, f"{place}/r", "year", "2026-01-01 00:00:00")
    assert found.count() == 130 and len(found.columns) == 130 + 4
    assert rows(found.where("x7 is not null"), "ticker", "x7", "roe", "period_type") == [("C7", "7", "0.5", "year")]


def test_headers_cost_the_first_lines(spark, tmp_path, place):
    put(tmp_path / "big", "a.csv", "k,v\n" + "1,some words that fill the line\n" * 300_000)
    headers = readers.csv_headers(spark, f"{place}/big", f"{place}/headers")
    assert rows(headers, "header") == [("k,v",)]
    taken = [r for r in readers._first_lines(iter([_batch(["", " \t"]), _batch(["k,v", "1,2"]), None]))]
    assert taken[0].column("header").to_pylist() == ["k,v"]  # the third batch is never touched


def _batch(lines):
    return pa.RecordBatch.from_pydict({"file": ["f"] * len(lines), "value": lines})


def test_numbers_stay_text(spark, tmp_path, place):
    put(tmp_path / "n", "a.csv", "symbol,ratio\n007,1e-05\n")
    assert rows(readers.read_csv_by_name(spark, f"{place}/n")) == [("007", "1e-05")]


def test_files_with_a_declared_header(spark, tmp_path, place):
    lake_dir = tmp_path / "lake" / "2026-01-01"
    load = upsert_load(f"{place}/t", list(prices.KEY), prices.month_partition())
    price_file(lake_dir, "batch_0.csv", "A,2026-01-01,,,,1,")
    price_file(lake_dir, "batch_1.csv", "A,2026-01-01,,,,2,")
    args = (spark, f"{place}/lake", f"{place}/log", prices.clean_prices, load, "2026-01-01 00:00:00")
    assert ingest_files(*args, schema=PRICE_RAW) == {"status": "loaded", "files": 2}
    assert closes(spark, f"{place}/t") == [("A", "2026-01-01", 2.0)]


def test_compaction_with_a_declared_header(spark, place):
    for d in range(1, 12):
        df = spark.createDataFrame([(f"T{d}", float(d))], "ticker string, close double")
        lake.write_lake(df, place, "p", f"2026-01-{d:02d}", "csv")
    done = lake.compact_partitions(spark, f"{place}/p", schema=struct("ticker string, close double"))
    assert spark.read.parquet(done["archive"]).agg(F.sum("close")).first()[0] == 55.0


def test_stream_takes_only_new_files(spark, tmp_path, place):
    lake_dir = tmp_path / "lake" / "2026-01-01"
    load = upsert_load(f"{place}/t", list(prices.KEY), prices.month_partition())

    def run():
        return ingest_stream(spark, f"{place}/lake", PRICE_RAW, f"{place}/ckpt", prices.clean_prices, load)

    price_file(lake_dir, "batch_0.csv", "A,2026-01-01,,,,1,", "A,2026-01-01,,,,2,")
    assert run() == 1
    assert run() == 0
    price_file(lake_dir, "batch_1.csv", "A,2026-01-01,,,,7,", "B,2026-02-01,,,,3,")
    assert run() == 1
    assert closes(spark, f"{place}/t") == [("A", "2026-01-01", 7.0), ("B", "2026-02-01", 3.0)]
