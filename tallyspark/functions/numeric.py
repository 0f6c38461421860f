"""Numeric column functions.

Sums of doubles depend on the order in which tasks finish. The ``exact_*``
aggregates add whole numbers instead, so a re-run after a lost executor, a
stream and a batch all give the same number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# A sum is kept in limbs: limb k counts steps of 2^(LIMB_BITS * k). A value adds less
# than 2^23 steps to a limb, so 2^40 rows (10^12) fit into a 64-bit sum.
LIMB_BITS = 24
# The usual limbs: values below 2^95 (10^28), steps of 2^-120 (10^-36).
USUAL_LIMBS = range(-5, 4)
# Every bit that a double can have.
ALL_LIMBS = range(-45, 43)


def exact_sum(value: str | Column, limbs: range = USUAL_LIMBS) -> Column:
    """Sum of doubles that does not depend on their order, correctly rounded once; NULL values are skipped.

    ``value`` is a column name or other SQL text, or a column. Every value is cut into limbs, pieces
    of 24 bits at fixed places of the binary number, by exact operations on doubles.
    Each limb is added as a 64-bit integer; what a limb holds too much is carried over
    once, after the last row, and only the total becomes a double. Cost grows with the
    number of limbs:

    - the usual ones hold all bits of values from 10^-20 to 10^28. Of smaller values
      steps below 2^-120 are rounded (to even, so in no direction, and the same
      in any order); larger ones are added apart, as doubles;
    - ``ALL_LIMBS`` hold every bit of every finite double.

    Infinite values and NaN are added apart and decide the result.
    """
    bound = LIMB_BITS * (limbs[-1] + 1) - 1
    if isinstance(value, Column):
        x = value.cast("double")
        fits = F.abs(x) < F.expr(_limit(bound))
        sums = F.array(*[F.coalesce(F.sum(_limb(F.when(fits, x), k, limbs)), F.lit(0).cast("bigint")) for k in limbs])
        total = F.call_function("transform", F.array(sums), F.expr(f"limbs -> {_rounded_total('limbs', limbs[0])}"))
        return F.when(F.count(x) > 0, F.get(total, F.lit(0)) + F.coalesce(F.sum(F.when(~fits, x)), F.lit(0.0)))
    # As text the aggregate is built at once: as column objects that takes longer than to run it.
    x = f"CAST(({value}) AS DOUBLE)"
    parts = []
    for place in limbs:
        limit = _limit(bound if _no_overflow(place, limbs) else LIMB_BITS * place + 77)
        steps = f"rint({_scaled(x, -LIMB_BITS * place)})"
        if place < limbs[-1]:
            steps += f" - rint({_scaled(x, -LIMB_BITS * (place + 1))}) * {_double(1 << LIMB_BITS)}"
        parts.append(f"coalesce(sum(CASE WHEN abs({x}) < {limit} THEN CAST({steps} AS BIGINT) END), 0L)")
    total = _rounded_total(f"array({', '.join(parts)})", limbs[0])
    apart = f"coalesce(sum(CASE WHEN NOT abs({x}) < {_limit(bound)} THEN {x} END), 0D)"
    return F.expr(f"CASE WHEN count({x}) > 0 THEN {total} + {apart} END")


def _limb(x: Column, place: int, limbs: range) -> Column:
    """What a value has in a limb: rounding to the steps of this limb and of the next
    one leaves what lies between, at most 2^23 steps. All are doubles without fraction."""
    steps = F.rint(x * F.lit(2.0 ** (-LIMB_BITS * place)))
    if place < limbs[-1]:
        steps = steps - F.rint(x * F.lit(2.0 ** (-LIMB_BITS * (place + 1)))) * F.lit(float(1 << LIMB_BITS))
    return steps.cast("bigint")


def _no_overflow(place: int, limbs: range) -> bool:
    """Whether all values may be scaled to the steps of a limb. Where not, values of 2^77
    steps and more are left out: they have no bit there."""
    bound = LIMB_BITS * (limbs[-1] + 1) - 1
    return bound <= LIMB_BITS * place + 77 or bound - LIMB_BITS * limbs[0] < 1000


def _limit(power: int) -> str:
    return _double(2.0**power) if power < 1024 else "CAST('Infinity' AS DOUBLE)"


def _double(value: float) -> str:
    return f"{float(value)!r}D"


def _scaled(x: str, power: int) -> str:
    """``x * 2^power``, in two exact steps where one factor would be no double."""
    if abs(power) <= 1000:
        return f"{x} * {_double(2.0**power)}"
    half = power // 2
    return f"{x} * {_double(2.0**half)} * {_double(2.0 ** (power - half))}"


def _rounded_total(sums: str, low: int) -> str:
    """The double nearest to the number whose limbs, lowest first, have the sums of an array."""
    bits, size, half = LIMB_BITS, f"{1 << LIMB_BITS}L", f"{1 << (LIMB_BITS - 1)}L"
    # What a limb holds too much goes to the one above. A sum of 63 bits in the highest gives two more digits.
    digits = f"""aggregate(concat({sums}, array(0L, 0L)), named_struct('up', 0L, 'digits', CAST(array() AS array<bigint>)),
        (s, v) -> named_struct('up', shiftright(v + s.up + {half}, {bits}),
            'digits', concat(s.digits, array(v + s.up - shiftright(v + s.up + {half}, {bits}) * {size}))),
        s -> s.digits)"""
    # From the highest digit that is not zero on, two numbers of two digits each and the sign of what is below
    # them: the sum of both numbers as doubles is the only rounding, and twice the lower number leaves a bit for
    # the sign. Three zeros complete short totals.
    power = f"((s.taken - 4) * {bits} + {bits * (low - 3) - 1})"
    return f"""aggregate(concat(reverse({digits}), array(0L, 0L, 0L)),
        named_struct('upper', 0L, 'lower', 0L, 'rest', 0L, 'taken', 0),
        (s, d) -> named_struct('upper', if(s.taken < 2, s.upper * {size} + d, s.upper),
            'lower', if(s.taken in (2, 3), s.lower * {size} + d, s.lower),
            'rest', if(s.taken > 3 AND s.rest = 0, CAST(signum(d) AS BIGINT), s.rest),
            'taken', if(s.taken > 0 OR d <> 0, s.taken + 1, 0)),
        s -> (s.upper * {_double(2.0 ** (2 * bits + 1))} + CAST(s.lower * 2 + s.rest AS DOUBLE))
            * pow(2D, shiftright({power}, 1)) * pow(2D, {power} - shiftright({power}, 1)))"""


def exact_mean(value: str | Column) -> Column:
    """Mean of the non-NULL values; NULL when there is none."""
    count = F.count(value) if isinstance(value, Column) else F.expr(f"count({value})")
    return F.try_divide(exact_sum(value), count)


def rounded(c, digits: int = 2) -> Column:
    """HALF_UP on the decimal text of the double, so 1.005 becomes 1.01 at two digits."""
    return F.round(_col(c).cast("double"), digits)


def signed_text(c) -> Column:
    """Number as text, ``+`` in front of positive ones only."""
    c = _col(c)
    return F.when(c > 0, F.concat(F.lit("+"), c.cast("string"))).otherwise(c.cast("string"))


def fahrenheit_to_celsius(c) -> Column:
    return (_col(c) - F.lit(32)) * F.lit(5) / F.lit(9)


def floored(c, floor: float = 0.0) -> Column:
    """The value, or ``floor`` if it is lower. NULL stays NULL."""
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(float(floor))))


def fifth_root(c, settle_steps: int = 12) -> Column:
    """Fifth root by Newton's method, starting from 1.

    The distance to the root shrinks by at least a fifth per step while the
    guess is far off, so the step count follows from the size of the input;
    ``settle_steps`` more make the quadratic phase converge. The root is odd,
    so only magnitudes are iterated and no step can divide by zero.
    """
    x = _col(c).cast("double")
    size = F.abs(x)
    shrink = math.log(1.25)
    far = F.when((size > 0) & (size < F.lit(float("inf"))), F.abs(F.ln(size))).otherwise(0.0)
    steps = (F.lit(settle_steps) + F.ceil(far * F.lit(0.8 / shrink))).cast("int")
    root = F.aggregate(
        F.sequence(F.lit(1), steps),
        F.lit(1.0),
        lambda y, _: (y * 4.0 + size / (y * y * y * y)) / 5.0,
    )
    return F.when((x == 0) | F.isnan(x) | (size == F.lit(float("inf"))), x).otherwise(F.signum(x) * root)


def cyclic_distance(a, b, period: int) -> Column:
    """Distance on a circle: month 12 is one away from month 1."""
    direct = F.abs(_col(a) - _col(b))
    return F.least(direct, F.lit(period) - direct)
