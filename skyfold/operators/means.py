"""Grouped means whose sums are exact, whatever the magnitudes and the order of rows.

A finite double is an integer times a power of two. Within a band of BAND
binary exponents all doubles are whole multiples of one power, so their sum is a
sum of integers in decimals, which no order of rows and no partitioning can
change. Rows are grouped by key and band first, then the few bands of a key are
put together, from the largest down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: binary exponents of a band (with 38 digits, 1e12 rows a key and band fit a sum), the
#: exponent at which band 0 begins, and the bits kept below a number's exponent: one more
#: than a double has, as a computed exponent may be one too high
BAND, FIRST, BITS = 32, -16, 53
_WHOLE = "decimal(38,0)"


def _scaled(x: Column, power: Column) -> Column:
    """``x * 2**power`` in two steps, neither of which leaves the range of doubles on its own."""
    half = F.floor(power / 2)
    return x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)


def _parts(x: Column) -> tuple[Column, Column, Column]:
    """Band of a number, its integer there, and the number itself where it is not finite."""
    finite = ~F.isnan(x) & (F.abs(x) < float("inf"))
    some = finite & (x != 0)
    exponent = F.floor(F.log2(F.when(some, F.abs(x)))).cast("int")
    band = F.floor((exponent - FIRST) / BAND).cast("int")
    digits = _scaled(x, BITS - exponent).cast("bigint").cast("decimal(20,0)")
    shift = F.pow(F.lit(2.0), exponent - FIRST - band * BAND).cast("bigint").cast("decimal(10,0)")
    zero = finite & (x == 0)
    return (F.when(some, band).when(zero, 0),
            F.when(some, digits * shift).when(zero, F.lit(0).cast("decimal(31,0)")),
            F.when(~finite, x))


def _mean(parts: Column, n: Column, odd: Column) -> Column:
    """From the sums of the bands, the number of values, and the sum of those that are not finite."""
    bands = F.reverse(F.array_sort(F.array_distinct(F.transform(parts, lambda p: p["band"]))))
    zero = F.lit(0.0)

    def total(use) -> Column:
        def add(a: Column, band: Column) -> Column:
            own = F.aggregate(F.filter(parts, lambda p: p["band"] == band), F.lit(0).cast(_WHOLE),
                              lambda t, p: (t + p["part"]).cast(_WHOLE))
            return a + _scaled(use(own.cast("double")), band * BAND + (FIRST - BITS))
        return F.aggregate(bands, zero, add)

    whole = total(lambda x: x)
    # the sum may be beyond the doubles where the mean is not
    mean = F.when(F.abs(whole) < float("inf"), whole / n).otherwise(total(lambda x: x / n))
    return F.when(n > 0, F.when(odd.isNotNull(), odd).otherwise(mean))


def grouped_means(df: DataFrame, keys: list[str], means: dict[str, Column], first: list[Column] = (),
                  second: list[Column] = ()) -> DataFrame:
    """``keys``, the mean of every column in ``means`` by name, and other aggregates.

    These go in two steps as the means do: ``first`` over the rows of a key and band, each
    with a name, then ``second`` over their results. Nulls don't count; a key
    without values has a null mean; NaN and infinities give what a plain average gives.

    Both steps aggregate partially before their shuffle; the second one moves a row for
    each key and band that occurs.
    """
    made = {}
    for name, c in means.items():
        band, part, odd = _parts(c.cast("double"))
        made |= {f"_{name}_band": band, f"_{name}_part": part, f"_{name}_odd": odd, f"_{name}_n": c}
    bands = [f"_{name}_band" for name in means]
    one = df.withColumns(made).groupBy(*keys, *bands).agg(
        *[F.sum(f"_{n}_part").cast(_WHOLE).alias(f"_{n}_part") for n in means], *[F.sum(f"_{n}_odd").alias(f"_{n}_odd") for n in means],
        *[F.count(f"_{n}_n").alias(f"_{n}_n") for n in means], *first)
    two = one.groupBy(*keys).agg(
        *[F.collect_list(F.when(F.col(f"_{n}_band").isNotNull(), F.struct(F.col(f"_{n}_band").alias("band"), F.col(f"_{n}_part").alias("part"))))
          .alias(f"_{n}_parts") for n in means],
        *[F.sum(f"_{n}_odd").alias(f"_{n}_odd") for n in means], *[F.sum(f"_{n}_n").alias(f"_{n}_n") for n in means], *second)
    hidden = {f"_{n}_{p}" for n in means for p in ("parts", "odd", "n")}
    return two.select(*keys, *[_mean(F.col(f"_{n}_parts"), F.col(f"_{n}_n"), F.col(f"_{n}_odd")).alias(n) for n in means],
                      *[c for c in two.columns if c not in keys and c not in hidden])
