"""Lenient number parsing and fixed-point number text."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Java's parser also takes a type letter ("1d") and hexadecimal floats, which are no
# numbers here; nor is "nan", which stands for a missing one.
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*$"

TWO_40 = 2.0**40
TWO_53 = 2.0**53
TWO_93 = 2.0**93
SPLIT = 2.0**27 + 1


def lenient_number(c: Column) -> Column:
    """Double, or null where the text is not a number."""
    text = c.cast("string")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def lenient_int(c: Column) -> Column:
    """Integer read through a double, so ``'3.0'`` is 3; null where that fails."""
    return lenient_number(c).try_cast("int")


def is_numeric(df: DataFrame, c: Column) -> bool:
    return isinstance(df.select(c).schema.fields[0].dataType, T.NumericType)


def as_double(df: DataFrame, c: Column) -> Column:
    """``c`` as double; only text needs the lenient reading."""
    return c.cast("double") if is_numeric(df, c) else lenient_number(c)


def as_int(df: DataFrame, c: Column) -> Column:
    """``c`` as integer; only text needs the lenient reading."""
    return c.try_cast("int") if is_numeric(df, c) else lenient_int(c)


def _halves(value: float) -> tuple[float, float]:
    spread = value * SPLIT
    high = spread - (spread - value)
    return high, value - high


def with_number_text(
    df: DataFrame, columns: Mapping[str, Column], digits: int = 4, missing: str = "0"
) -> DataFrame:
    """Add columns of decimal text: at most ``digits`` decimals, no exponent, no end zeros.

    The inputs are numbers or number text; where there is none, or a NaN, the result is
    ``missing``. Rounds the exact binary value, half to even, as C's ``printf`` does;
    ``format_string`` rounds the shortest decimal half-up and so turns 2.00005 into 2.0001.
    The product of fraction and power of ten is kept as an unevaluated sum ``p + e``
    (Dekker), which settles every tie. Exact below 2^93; larger values print their
    significant digits and zeros.

    The steps are separate projections: each intermediate is computed once per row, all
    within one codegen stage, where a single nested expression would repeat it a hundredfold.
    """
    scale = 10.0**digits
    scale_high, scale_low = _halves(scale)
    keep = df.columns

    def step(frame: DataFrame, **made: Callable[[Callable[[str], Column]], Column]) -> DataFrame:
        return frame.withColumns(
            {
                f"_{i}_{name}": make(lambda v, i=i: F.col(f"_{i}_{v}"))
                for i in range(len(columns))
                for name, make in made.items()
            }
        )

    work = df.withColumns({f"_{i}_x": as_double(df, c) for i, c in enumerate(columns.values())})
    work = step(work, size=lambda v: F.abs(v("x")))
    work = step(work, bounded=lambda v: F.least(v("size"), F.lit(TWO_53)))
    work = step(work, whole=lambda v: F.floor(v("bounded")))
    work = step(work, part=lambda v: v("bounded") - v("whole").cast("double"))
    work = step(work, spread=lambda v: v("part") * F.lit(SPLIT), p=lambda v: v("part") * F.lit(scale))
    work = step(work, high=lambda v: v("spread") - (v("spread") - v("part")), floor=lambda v: F.floor(v("p")))
    work = step(work, low=lambda v: v("part") - v("high"))
    work = step(
        work,
        above_half=lambda v: (v("p") - v("floor").cast("double") - F.lit(0.5))
        + (
            ((v("high") * F.lit(scale_high) - v("p")) + v("high") * F.lit(scale_low))
            + v("low") * F.lit(scale_high)
            + v("low") * F.lit(scale_low)
        ),
    )
    work = step(
        work,
        rounded=lambda v: v("floor")
        + ((v("above_half") > 0) | ((v("above_half") == 0) & (v("floor") % 2 == 1))).cast("bigint"),
    )
    work = step(
        work,
        decimals=lambda v: F.rtrim(
            F.lpad((v("rounded") % F.lit(int(scale))).cast("string"), digits, "0"), F.lit("0")
        ),
        units=lambda v: (v("whole") + F.floor(v("rounded") / F.lit(scale))).cast("string"),
    )

    def text(v: Callable[[str], Column]) -> Column:
        x, size = v("x"), v("size")
        small = F.concat(
            v("units"), F.when(v("decimals") == "", "").otherwise(F.concat(F.lit("."), v("decimals")))
        )
        upper = F.floor(size / F.lit(TWO_40))
        large = (
            upper.cast("decimal(20,0)") * F.lit(int(TWO_40)).cast("decimal(14,0)")
            + (size - upper.cast("double") * F.lit(TWO_40)).cast("bigint").cast("decimal(20,0)")
        ).cast("string")
        digits_text = (
            F.when(size < TWO_53, small)
            .when(size < TWO_93, large)
            .when(size == float("inf"), F.lit("inf"))
            .otherwise(F.format_string("%.0f", size))
        )
        negative = (x < 0) | ((x == 0) & F.startswith(x.cast("string"), F.lit("-")))
        signed = F.concat(F.when(negative, "-").otherwise(""), digits_text)
        return F.when(x.isNull() | F.isnan(x), F.lit(missing)).otherwise(signed)

    made = [text(lambda v, i=i: F.col(f"_{i}_{v}")).alias(name) for i, name in enumerate(columns)]
    return work.select(*[c for c in keep if c not in columns], *made)
