"""Document fingerprints from closed syncmers over short units of text. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import query, table

# Units end at white space, after a vowel or digit of ASCII, and after every code point from U+00C0 on.
UNIT_END = "[\\x20\\x09-\\x0D]+|(?<=[aeiouyAEIOUY0-9\u00c0-\U0010ffff])"
K = 6  # units of an anchor
S = 3  # units of the inner substrings: four in an anchor
PAD = 6  # marks set before a text, so that short texts have anchors too
LEAST = 64  # anchors that a fingerprint has at least, if the text has them
SHARE = 16  # of the other anchors one in 16 is kept, by its hash
BAND = 8  # matching anchors lie on one diagonal, give or take an eighth of the text
HASHES = 1 << 31
POSITION = (1 << 31) - 1  # bits of an anchor
SPACE = " \t\n\x0b\x0c\r"
BOUNDS_PER_PARTITION = 4


def with_units(df: DataFrame, text: str, out: str) -> DataFrame:
    """``out``: hashes of the text's units, with six marks of 0 before them. A null text counts as empty."""
    units = F.split(F.coalesce(text, F.lit("")), UNIT_END)
    return df.withColumn(out, F.concat(_marks(), F.transform(units, lambda u: F.xxhash64(u))))


def _marks() -> Column:
    return F.array_repeat(F.lit(0).cast("long"), PAD)


def _packed(h: Column, position: Column) -> Column:
    return F.shiftleft(F.shiftrightunsigned(h, 33), 32) + position


def _closed(units: Column, start: Column | int = 0) -> Column:
    """The closed syncmers of an array of unit hashes, the first of which has position ``start``."""
    last = K - S

    def runs(units: Column) -> Column:
        return F.transform(
            F.slice(units, F.lit(1), F.size(units) - S + 1), lambda x, i: F.xxhash64(x, *(F.get(units, i + j) for j in range(1, S)))
        )

    def closed(inner: Column) -> Column:
        at = lambda i: F.get(inner, i)
        ends = lambda x, i: F.least(x, at(i + last)) <= F.least(*(at(i + j) for j in range(1, last)))
        anchor = lambda x, i: F.when(ends(x, i), _packed(F.xxhash64(x, at(i + last)), i + start))
        return F.transform(F.slice(inner, F.lit(1), F.size(inner) - last), anchor)

    return F.array_compact(_with(_with(units, runs), closed))


def _whole(text: str) -> Column:
    return F.array(_packed(F.xxhash64(text), F.lit(0).cast("long")))


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """``out``: array of the text's closed syncmers, each a long of a 31-bit hash and a position in 32 bits.

    A unit is a syllable or so of Latin text and one code point of most other scripts; its end depends on the
    code point before it alone. The six units from a position on are an anchor if, of the four runs of three in
    them, the one with the least hash stands first or last. So equal passages have equal anchors wherever they
    stand, and one of any three places in a row is an anchor. Six marks stand before the text, and positions
    count units from the first of them; texts that agree in their first two units have an anchor in common. A text
    that is one unit has one anchor, of the whole text at position 0; an empty or null one has none.
    """
    return with_units(df, text, "_units").withColumn(out, _or_whole(text, F.size("_units"), _closed(F.col("_units")))).drop("_units")


def _or_whole(text: str, units: Column, anchors: Column) -> Column:
    """``anchors``, but none of an empty text, and one of a text that is one unit. ``units`` counts the marks too."""
    empty = F.coalesce(F.length(text) == 0, F.lit(True))
    return F.when(empty, F.array().cast("array<bigint>")).when(units <= PAD + 1, _whole(text)).otherwise(anchors)


def _with(value: Column, f) -> Column:
    """``f(value)``, with the value held by a variable: a column of a row would be copied at each use."""
    return F.get(F.transform(F.array(value), f), 0)


def _hash(anchor: Column) -> Column:
    return F.shiftright(anchor, 32)


def with_firsts(df: DataFrame, anchors: Column, out: str) -> DataFrame:
    """``out``: the anchors ascending by hash, each hash with its first position."""
    first = lambda x, i: (i == 0) | (_hash(x) != _hash(F.get("_sorted", i - 1)))
    return df.withColumn("_sorted", F.sort_array(anchors)).withColumn(out, F.filter("_sorted", first)).drop("_sorted")


def kept(firsts: Column) -> Column:
    """The anchors that a fingerprint keeps, of all of a text as by ``with_firsts``: a bottom-k sketch.

    The 64 of least hash, and all whose hash is in the lowest sixteenth: long texts keep one in 16. A function of
    the whole set, so of two sets together the sketch follows from their sketches.
    """
    return F.filter(firsts, lambda x, i: (i < LEAST) | (x < (HASHES // SHARE) << 32))


def with_sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """``out``: the anchors kept of the whole text, ascending by hash, each hash with its first position."""
    return with_firsts(with_anchors(df, text, out), F.col(out), "_all").withColumn(out, kept(F.col("_all"))).drop("_all")


def _rest(last: str, tail: str) -> Column:
    """Hashes of the units from a text's unfinished unit on, if ``tail`` follows. White space after an end is part of it."""
    follows = F.when(F.col(last) == "", F.ltrim(F.col(tail), F.lit(SPACE))).otherwise(F.col(tail))
    return F.transform(F.split(F.concat(last, follows), UNIT_END), lambda u: F.xxhash64(u))


def with_head_sketch(df: DataFrame, text: str, head: Column, out: str) -> DataFrame:
    """``out``: as by ``with_sketch``; ``_head_sketch`` and what ``with_new_tail`` needs of the first ``head`` code points.

    The units that end there, ``_ended`` with the marks, and so their anchors, are those of every text that begins so. The
    last five of them are ``_edge``, and ``_last`` is the unit that goes on.
    """
    return with_firsts(
        df.withColumn("_cut", F.split(F.substring(F.col(text), F.lit(1), head), UNIT_END))
        .withColumn("_tail", F.substring(F.col(text), head + 1, F.length(text)))
        .withColumn("_last", F.element_at("_cut", -1))
        .withColumn("_begun", F.concat(_marks(), F.transform(F.slice("_cut", F.lit(1), F.size("_cut") - 1), lambda u: F.xxhash64(u))))
        .withColumn("_ended", F.size("_begun"))
        .withColumn("_edge", F.slice("_begun", 1 - K, K - 1))
        .withColumn("_units", F.concat("_begun", _rest("_last", "_tail"))),
        _closed(F.col("_units")), "_all",
    ).withColumn(out, _or_whole(text, F.size("_units"), kept(F.col("_all")))).withColumn(
        "_head_sketch", kept(F.filter("_all", lambda x: x.bitwiseAND(POSITION) <= F.col("_ended") - K))
    ).drop("_cut", "_tail", "_begun", "_units", "_all")


def with_new_tail(df: DataFrame, text: str, tail: str, out: str) -> DataFrame:
    """``out``: what ``with_sketch`` gives for ``text``, which is the head of ``with_head_sketch`` followed by ``tail``.

    Only the units from the head's end on are looked at; the columns of ``with_head_sketch`` are dropped.
    """
    joined = df.withColumn("_new", _rest("_last", tail)).withColumn(
        "_anchors", F.concat("_head_sketch", _closed(F.concat("_edge", "_new"), F.col("_ended") - (K - 1)))
    )
    made = with_firsts(joined, F.col("_anchors"), "_all")
    made = made.withColumn(out, _or_whole(text, F.col("_ended") + F.size("_new"), kept(F.col("_all"))))
    return made.drop("_new", "_anchors", "_all", "_head_sketch", "_ended", "_edge", "_last")


def fingerprint(sketch: Column) -> Column:
    """Sixteen hexadecimal digits per anchor: hash and position."""
    return F.array_join(F.transform(sketch, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def with_likeness(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """``out``: estimate of the share of anchors common to ``a`` and ``b`` at matching positions, 0 to 1.

    Anchors count up to the hash to which both sketches are complete. Common ones match if the shift between
    their two positions is the median shift of all, give or take an eighth of the longer text: passages that
    were moved don't. Two empty sketches are alike.
    """
    side = 1 << 31  # set in anchors of b, so that of two with one hash that of a comes first
    upto = F.least(*(  # the greatest anchor that counts
        F.when(F.size(s) < LEAST, F.lit((1 << 63) - 1)).otherwise(F.greatest(F.lit((HASHES // SHARE << 32) - 1), F.element_at(s, -1).bitwiseOR((1 << 32) - 1)))
        for s in (a, b)
    ))
    end = lambda s: F.coalesce(F.array_max(F.transform(s, lambda x: x.bitwiseAND(POSITION))), F.lit(0))
    after = lambda i: F.get("_both", i + 1)
    shift = lambda x, i: F.when(_hash(after(i)) == _hash(x), after(i) - x - side)
    pooled = F.concat(F.col(a), F.transform(b, lambda x: x + side))
    middle = F.get("_shifts", F.floor(F.size("_shifts") / 2).cast("int"))
    band = F.greatest(end(F.col(a)), end(F.col(b))) / BAND
    near = lambda m: F.filter("_shifts", lambda d: F.abs(d - m.middle) <= m.band)
    matching = F.size(_with(F.struct(middle.alias("middle"), band.alias("band")), near))
    union = F.size("_both") - F.size("_shifts")
    return (
        df.withColumn("_both", F.sort_array(_with(upto, lambda u: F.filter(pooled, lambda x: x <= u))))
        .withColumn("_shifts", F.sort_array(F.array_compact(F.transform("_both", shift))))
        .withColumn(out, F.when(union == 0, F.lit(1.0)).otherwise(matching / union))
        .drop("_both", "_shifts")
    )


def with_bucket(df: DataFrame, column: str) -> DataFrame:
    """``_bucket``: 0 for nulls, else number of the range of ``column``; ``_first``: is it the range's least value?

    Ranges begin at values that occur, so the rows that follow a range are known without a look at the next.
    """
    n = BOUNDS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*(F.lit(i / n) for i in range(1, n)))
    low, cuts = df.agg(F.min(column), F.percentile_approx(column, shares, max(10_000, 4 * n))).first()
    bounds = sorted({*([] if low is None else [low]), *(cuts or [])})
    step = max(1, math.isqrt(len(bounds)))
    every = F.lit(bounds).cast("array<bigint>") if bounds else F.array().cast("array<bigint>")
    coarse = F.lit(bounds[step::step]).cast("array<bigint>") if bounds[step::step] else F.array().cast("array<bigint>")
    below = lambda a: F.size(F.filter(a, lambda b: b <= F.col(column)))
    return (
        df.withColumn("_coarse", F.when(F.col(column).isNotNull(), below(coarse)))
        .withColumn("_bucket", F.coalesce(F.col("_coarse") * step + below(F.slice(every, F.col("_coarse") * step + 1, F.lit(step))), F.lit(0)))
        .withColumn("_first", F.coalesce(F.get(every, F.col("_bucket") - 1) == F.col(column), F.lit(False)))
        .drop("_coarse")
        .withColumn("_last_bucket", F.lit(len(bounds)))
    )


def with_next(df: DataFrame, order: str, ties: list[str], columns: list[str]) -> DataFrame:
    """``next_<column>`` of the row that follows by ``order``; the first row follows the last.

    No window spans the table: ranges are windows of their own, and a range's first rows also go to the range
    before it. Nulls come first; equal values stand in the order of ``ties``.
    """
    placed = with_bucket(df, order)
    smallest = placed.agg(F.min("_bucket")).first()[0]
    here = lambda bucket, wrap, halo: F.struct(bucket.alias("b"), F.lit(wrap).alias("w"), F.lit(halo).alias("h"))
    starts = F.col("_first") & (F.col("_bucket") > (smallest or 0))
    wraps = F.col("_bucket") == (smallest or 0)
    wraps = wraps & (F.col("_first") | F.col(order).isNull())
    places = F.concat(
        F.array(here(F.col("_bucket"), 0, False)),
        F.when(starts, F.array(here(F.col("_bucket") - 1, 0, True))).otherwise(F.array().cast("array<struct<b:int,w:int,h:boolean>>")),
        F.when(wraps, F.array(here(F.col("_last_bucket"), 1, True))).otherwise(F.array().cast("array<struct<b:int,w:int,h:boolean>>")),
    )
    window = Window.partitionBy("_p.b").orderBy("_p.w", order, *ties)
    return (
        placed.withColumn("_p", F.explode(places))
        .select("*", *(F.lead(c).over(window).alias(f"next_{c}") for c in columns))
        .where("not _p.h")
        .drop("_p", "_bucket", "_first", "_last_bucket")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text of ``docs`` (doc_id, text) and of its edited text.

    ``doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next``. The edited text has
    its last quarter replaced by the start of the next document's text by doc_id; the first follows the last.
    Likeness is that of ``with_likeness``; the hash of a text of one unit is like none but itself. A null text
    counts as empty; the empty text has the empty fingerprint, which is like itself (1) and unlike any other (0). Null doc_ids come first; rows of one doc_id stand in the order of their texts. Other
    columns are ignored; an empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    pairs = with_next(with_head_sketch(texts, "text", n - quarter, "sketch"), "doc_id", ["text"], ["text", "sketch"])
    made = (
        pairs.withColumn("_tail", F.substring(F.col("next_text"), F.lit(1), quarter))
        .withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - quarter), "_tail"))
        .withColumn("n_chars", n.cast("long"))
        .drop("next_text", "text")
    )
    made = with_new_tail(made, "edited", "_tail", "edited_sketch")
    made = with_likeness(with_likeness(made, "sketch", "edited_sketch", "near_edited"), "sketch", "next_sketch", "near_next")
    return made.select(
        "doc_id", "n_chars", "edited",
        fingerprint(F.col("sketch")).alias("fingerprint"), fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited", "near_next",
    )


@query("op5_closed_syncmers")
def op5(spark, sf_dir):
    found = fingerprints(table(spark, sf_dir, "documents"))
    return found.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)).drop("edited")
