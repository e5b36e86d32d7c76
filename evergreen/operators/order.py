"""Sort orders as whole numbers of fixed width.

Hash aggregates need buffers of fixed width, and cumulative counts need values that can be
cut into digits.  Both get them from an image of the order: numbers that compare
as the values do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANTISSA = 52
BIAS = 1023
LONG_BITS, DECIMAL_BITS = 62, 126
#: Bytes of a text that take part in an image.
TEXT_BYTES = 7

WIDTHS = {
    T.BooleanType: 1, T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.DateType: 32, T.LongType: 64,
    T.TimestampType: 64, T.FloatType: 64, T.DoubleType: 64,
}


def ordered_double(c: Column) -> Column:
    """A double as the whole number of its exponent and mantissa bits, negative for negative values.

    Compares as Spark compares doubles: -0.0 equals 0.0, and NaN equals itself and stands
    above infinity.  Null stays null.
    """
    x = F.abs(c.cast("double"))
    power = lambda e: F.pow(F.lit(2.0), e)
    guess = F.floor(F.log2(x))
    low = F.when(x < power(guess), guess - 1).when(x >= power(guess + 1), guess + 1).otherwise(guess)
    exponent = F.greatest(F.least(low, F.lit(BIAS)), F.lit(1 - BIAS))
    # Scaling by powers of two is exact; half of it at a time, as the whole may be out of range.
    half = F.floor((MANTISSA - exponent) / 2)
    scaled = (x * power(half) * power(MANTISSA - exponent - half)).cast("bigint")
    # A normal value has its leading bit in ``scaled``; a subnormal one has exponent field 0.
    finite = (exponent + (BIAS - 1)) * (1 << MANTISSA) + scaled
    bits = (
        F.when(F.isnan(c), F.lit(((2 * BIAS + 1) << MANTISSA) + 1))
        .when(x == float("inf"), F.lit((2 * BIAS + 1) << MANTISSA))
        .when(x == 0, F.lit(0))
        .when(x < 2.0 ** (1 - BIAS), (x * 2.0**537 * 2.0**537).cast("bigint"))
        .otherwise(finite)
    )
    return F.when(c.isNotNull(), F.when(c < 0, -bits).otherwise(bits)).cast("bigint")


def _leaves(c: Column, kind: T.DataType) -> list[tuple[Column, T.DataType]]:
    """The parts of a possibly nested order, in their order; a null struct comes before all others."""
    if not isinstance(kind, T.StructType):
        return [(c, kind)]
    found: list[tuple[Column, T.DataType]] = [(c.isNotNull(), T.BooleanType())]
    for f in kind.fields:
        found += _leaves(c.getField(f.name), f.dataType)
    return found


def _whole(c: Column, kind: T.DataType) -> Column:
    """A value of fixed width as a whole number."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return ordered_double(c)
    if isinstance(kind, T.DateType):
        return F.unix_date(c)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.StringType):
        first = F.substring(F.encode(c, "utf-8"), 1, TEXT_BYTES)
        return F.conv(F.rpad(F.hex(first), 2 * TEXT_BYTES, "0"), 16, 10).cast("bigint")
    return c.cast("int") if isinstance(kind, T.BooleanType) else c


def order_image(df: DataFrame, order: list[str | Column]) -> Column | None:
    """The beginning of an ascending ``order`` (nulls first) as one number; None if nothing of fixed width begins it.

    Rows whose images differ are in that order; equal images leave it open, as only the
    first bytes of a text are in, and only as many parts as the number has room for.
    """
    columns = [F.col(o) if isinstance(o, str) else o for o in order]
    kinds = [f.dataType for f in df.select(*columns).schema.fields]
    parts: list[tuple[Column, int, bool]] = []  # whole number, its bits, whether it has a sign
    for c, kind in [leaf for col, k in zip(columns, kinds) for leaf in _leaves(col, k)]:
        text = isinstance(kind, T.StringType)
        width = 8 * TEXT_BYTES if text and parts else WIDTHS.get(type(kind))
        if width is None or sum(w + 1 for _, w, _ in parts) + width + 1 > DECIMAL_BITS:
            break
        parts.append((_whole(c, kind), width, not text and not isinstance(kind, T.BooleanType)))
        if text:
            break
    if not parts:
        return None
    if len(parts) == 1:
        return F.coalesce(parts[0][0].cast("bigint"), F.lit(-(1 << 63)))
    wide = "bigint" if sum(w + 1 for _, w, _ in parts) <= LONG_BITS else "decimal(38,0)"
    number = lambda n: F.lit(str(n)).cast(wide)
    image = None
    for value, width, signed in parts:
        # Null is 0, other values follow from 1.
        part = F.coalesce((value.cast(wide) + number(1 + (1 << (width - 1) if signed else 0))).cast(wide), number(0))
        image = part if image is None else ((image * number(1 << (width + 1))).cast(wide) + part).cast(wide)
    return image
