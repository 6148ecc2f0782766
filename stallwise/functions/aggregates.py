"""Aggregate expressions. Every one has a map-side partial, so a hot key is reduced before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Exact sums: the bits of an addend between 2^LOWEST and 2^HIGHEST fall into bands of BAND bits, each summed as a whole number.
# A band's sum fits 64 bits for 2^39 addends and more of one group.
BAND, BANDS, LOWEST = 24, 8, -84
HIGHEST = LOWEST + BAND * BANDS
SIGNIFICANT = 53
MASK = 2**BAND - 1


def sum_amount(amount: str) -> Column:
    """Sum of doubles, exact and rounded once: independent of row order and of the number of partitions.

    ``amount`` is an SQL expression. The bits of every addend are dealt to bands of a fixed grid, whose sums are whole
    numbers, so partial sums add up to the same in any order; only bands that an addend reaches are worked out for it.
    Addends of 2^108 or more, infinities and NaN are summed as doubles beside them, as are bits below 2^-84: there the
    sum is what a plain sum gives. Null without addends.
    """
    x = f"cast({amount} as double)"
    # every addend counts in band 2, with 0 if it doesn't reach it: its sum tells whether there were any
    parts = [f"case {band_part(x, j)} {f'when {x} is not null then 0L ' if j == 2 else ''}end" for j in range(BANDS)]
    sums = [f"sum({part})" for part in parts]
    bands = [f"coalesce({total}, 0L)" for total in sums]
    odd = f"case when not abs({x}) < {power(HIGHEST)} then {x} when abs({x}) < {power(LOWEST + SIGNIFICANT)} then {x} % {power(LOWEST)} end"
    usual, rare = usual_total(bands), any_total(f"array({', '.join(bands)})")
    fits = " and ".join([f"{bands[j]} = 0L" for j in (0, 5, 6, 7)] + [f"abs({bands[4]}) < {2**28}L", f"abs({bands[3]}) < {2**51}L"])
    return F.expr(f"case when {sums[2]} is not null then (case when {fits} then {usual} else {rare} end) + coalesce(sum({odd}), 0.0D) end")


def power(exponent: int) -> str:
    """A power of two as an exact SQL literal."""
    return f"{2.0**exponent!r}D"


def band_part(x: str, j: int) -> str:
    """A branch with the bits of ``x`` in band ``j`` as a whole number with its sign.

    A remainder by a power of two is exact, and a double has no bits 53 places below its first one.
    """
    low, high = LOWEST + BAND * j, LOWEST + BAND * (j + 1)
    reached = f"abs({x}) >= {power(low)} and abs({x}) < {power(min(high + SIGNIFICANT, HIGHEST))}"
    return f"when {reached} then cast(({x} % {power(high)}) / {power(low)} as bigint)"


def usual_total(bands: list[str]) -> str:
    """The sum of bands 1 to 4, for totals below 2^40: two whole doubles that add up with one rounding."""
    second = f"({bands[2]} + shiftright({bands[1]}, {BAND}))"
    upper = f"{bands[4]} * {2**BAND}L + {bands[3]} + shiftright({second}, {BAND})"
    lower = f"({second} & {MASK}L) * {2**BAND}L + ({bands[1]} & {MASK}L)"
    return f"(cast({upper} as double) * {power(LOWEST + 3 * BAND)} + cast({lower} as double) * {power(LOWEST + BAND)})"


def any_total(sums: str) -> str:
    """The double nearest to the sum of ``sums[j]`` * 2^(LOWEST + BAND * j), ties to even.

    Carries turn the sums into digits of 24 bits, lowest first; what is left above them is 0, or -1 for a negative sum. Of the
    four leading digits two make a whole double each, all that follows sets the last bit of the second one, and their
    sum rounds once.
    """
    digits = f"""aggregate(concat(array(0L, 0L, 0L), {{}}, array(0L, 0L)), named_struct('carry', 0L, 'found', cast(array() as array<bigint>)),
        (d, v) -> named_struct('carry', shiftright(d.carry + v, {BAND}), 'found', array_append(d.found, (d.carry + v) & {MASK}L)))"""
    rounded = f"""aggregate(reverse({{}}), named_struct('n', 0, 'lead', 0L, 'rest', 0L),
        (t, g) -> named_struct('n', if(t.n > 0 or g > 0, t.n + 1, 0), 'lead', if(t.n < 2, t.lead * {2**BAND}L + g, t.lead),
            'rest', case when t.n < 2 then t.rest when t.n < 4 then t.rest * {2**BAND}L + g when g > 0 then t.rest | 1L else t.rest end),
        t -> if(t.n = 0, 0.0D, (cast(t.lead as double) * {power(2 * BAND)} + cast(t.rest as double)) * pow(2.0D, (t.n - 4) * {BAND} + {LOWEST - 3 * BAND})))"""
    below = digits.format("transform(s, v -> -v)")
    # array and transform stand for a let
    return f"""transform(array({sums}), s -> transform(array({digits.format("s")}), u -> if(u.carry < 0,
        -{rounded.format(f"({below}).found")}, {rounded.format("u.found")}))[0])[0]"""


def count_where(predicate: Column) -> Column:
    return F.count_if(predicate)


def precision(tp: Column, fp: Column) -> Column:
    return ratio_or_zero(tp, tp + fp)


def recall(tp: Column, fn: Column) -> Column:
    return ratio_or_zero(tp, tp + fn)


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    return ratio_or_zero(tp * F.lit(2), tp * F.lit(2) + fp + fn)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))
