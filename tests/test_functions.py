import random
import struct
from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlake import functions as fn
from marketlake.functions.html import read_fields


def values(spark, expression, texts, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, c {kind}")
    return [r[0] for r in df.select("i", expression(F.col("c")).alias("out")).orderBy("i").select("out").collect()]


def python_text(x, digits):
    return f"{x:.{digits}f}".rstrip("0").rstrip(".")


def test_strip_takes_all_unicode_space(spark):
    texts = ["\xa0 a b　", "\x1f\x85x ", " 　", "", None, "plain"]
    assert values(spark, fn.strip_text, texts) == ["a b", "x", "", "", None, "plain"]


def test_clean_symbol(spark):
    assert values(spark, fn.clean_symbol, [" hpg\t", "\xa0vic", None]) == ["HPG", "VIC", None]


def test_slugify(spark):
    texts = ["Net Sales (Bn. VND)", "Lợi nhuận", "đđđ", "", "a__b--c"]
    assert values(spark, fn.slugify, texts) == ["NET_SALES_BN_VND", "L_I_NHU_N", "UNKNOWN", "UNKNOWN", "A_B_C"]


def test_fallback_code(spark):
    assert values(spark, fn.fallback_code, ["a b", "x" * 60]) == ["A_B", "X" * 50]


def test_lenient_number(spark):
    texts = ["1.5", " 2 ", "-3e2", ".5", "5.", "1d", "2f", "0x10", "abc", "", None, "inf", "NaN"]
    wanted = [1.5, 2.0, -300.0, 0.5, 5.0, None, None, None, None, None, None, float("inf"), None]
    assert values(spark, fn.lenient_number, texts) == wanted


def test_lenient_int(spark):
    texts = ["3.0", "3.9", "-3.9", "", "x", None, "nan", "inf", "1e3"]
    assert values(spark, fn.lenient_int, texts) == [3, 3, -3, None, None, None, None, None, 1000]


def test_number_text_edges(spark):
    numbers = [2.00005, 0.03125, 1e15, 0.0, -0.0, -0.00001, 1e-05, 123456.789, 0.99995, 0.99999, 9.9e20, float("inf")]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(numbers)], "i int, x double")
    for digits in (4, 10):
        out = fn.with_number_text(df, {"s": F.col("x")}, digits).orderBy("i").select("s").collect()
        assert [r[0] for r in out] == [python_text(x, digits) for x in numbers]


def test_number_text_missing(spark):
    df = spark.createDataFrame([("abc",), ("",), (None,), ("nan",), ("1.50",)], "x string")
    out = [r[0] for r in fn.with_number_text(df, {"s": F.col("x")}, 4).select("s").collect()]
    assert out == ["0", "0", "0", "0", "1.5"]


@pytest.mark.parametrize("digits", [4, 10])
def test_number_text_agrees_with_exact_rounding(spark, digits):
    rng = random.Random(7)
    numbers = [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 14) for _ in range(3000)]
    numbers += [rng.randint(0, 10**9) / 2 / 10**digits for _ in range(3000)]
    numbers += [rng.randint(0, 2**20) / 2**rng.randint(1, 20) for _ in range(2000)]
    bits = (struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(4000))
    numbers += [x for x in bits if abs(x) < 2.0**93]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(numbers)], "i int, x double")
    out = fn.with_number_text(df, {"s": F.col("x")}, digits).select("i", "s").collect()
    wrong = [(numbers[i], s) for i, s in out if s != python_text(numbers[i], digits)]
    assert not wrong, wrong[:5]


def test_lenient_date(spark):
    texts = ["2024-01-05", "2024-01-05 10:00:00", "2024-1-5", "bad", "2024-01-05 x", "", None, "2024-02-30"]
    day = date(2024, 1, 5)
    assert values(spark, fn.lenient_date, texts) == [day, day, day, None, None, None, None, None]


def test_epoch_millis(spark):
    out = values(spark, fn.epoch_millis, [0, None, 1704067200123], "bigint")
    assert out[:2] == [None, None]
    assert out[2].replace(tzinfo=None) == datetime(2024, 1, 1, 0, 0, 0, 123000)


def test_day_tokens_agree(spark):
    df = spark.createDataFrame([(date(2026, 2, 1),)], "d date")
    assert df.select(fn.date_tokens(F.col("d"))).first()[0] == fn.day_tokens("2026-02-01")


def test_path_date_and_segment(spark):
    keys = ["overview/date=2026-01-02/batch_0.csv", "global_index/usd_vnd/2026-01-03/data.csv", "no/date.csv"]
    assert values(spark, fn.path_date, keys) == ["2026-01-02", "2026-01-03", None]
    assert values(spark, lambda c: fn.path_segment(c, 1), keys) == ["date=2026-01-02", "usd_vnd", "date.csv"]


def test_coalesce_blank(spark):
    df = spark.createDataFrame([("a", "x"), ("", "x"), (None, "x"), ("", None)], "a string, b string")
    assert [r[0] for r in df.select(fn.coalesce_blank(F.col("a"), F.col("b"))).collect()] == ["a", "x", "x", None]


PAGE = """<html><script>var t="<h1 class='title'>no</h1>";</script><body>
<h1 class="big title"> A &amp; B <b> c</b></h1><h1 class="title">second</h1>
<h2 class="sapo">one<p>two</h2>outside<div class="detail-content"> x <!-- note --> y
<style>p{}</style><p>z<br>w &copy; &#233; &#x41;</div> after <span class="pdate">01/02/2026</span></body></html>"""


def test_html_fields():
    rules = {"title": "h1.title", "sapo": "h2.sapo", "content": ".detail-content", "publish_time": ".pdate"}
    assert read_fields(PAGE, rules) == {
        "title": "A & Bc",
        "sapo": "onetwo",
        "content": "xyzw © é A",
        "publish_time": "01/02/2026",
    }
    assert read_fields("<p>nothing", rules) == dict.fromkeys(rules, "")
    assert read_fields(None, rules) is None


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>/&;#!-='\" abhp1xé\n", max_size=200))
def test_html_reader_never_fails(text):
    fields = read_fields(text, {"title": "h1.a", "content": ".b", "sapo": "p", "publish_time": "a"})
    assert fields is None or set(fields) == {"title", "sapo", "content", "publish_time"}


def test_html_cut_off_reference():
    assert read_fields("<h1>a&amp</h1>", {"title": "h1"})["title"] == "a&"
    assert read_fields("<h1>a&am</h1>", {"title": "h1"})["title"] == "a&am"


def test_parse_articles_drops_null_pages(spark):
    df = spark.createDataFrame(
        [(1, "cafef", PAGE), (2, "cafef", None), (3, "other", PAGE)], "i int, source string, html string"
    )
    out = {r["i"]: r["title"] for r in fn.parse_articles(df).collect()}
    assert out == {1: "A & Bc", 3: ""}


def test_retry_after(spark):
    texts = ["429: Thử lại sau 41 giây", "THỬ LẠI SAU  5 GIÂY", "sau 5 giây", None]
    assert values(spark, fn.retry_after_seconds, texts) == [41.0, 5.0, None, None]
