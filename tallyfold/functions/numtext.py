"""Number <-> text rules of the update and lookup endpoints.

Parsing is strict like the reference's: no surrounding spaces or line ends, no
type suffixes, hex only as a float with a binary exponent; a number that
overflows to infinity is refused.  Printing
gives the shortest round-trip digits without an exponent (``5``, ``42.5``).
All of it is Catalyst expressions; nothing runs in Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text shapes.
INT_TEXT = r"^[+-]?[0-9]+\z"
FLOAT_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
HEX_FLOAT_TEXT = r"^[+-]?0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+\z"
SPECIAL_FLOAT_TEXT = r"^(?i)([+-]?(inf|infinity)|nan)\z"



def _pos_inf() -> Column:
    return F.lit(float("inf"))


def _neg_inf() -> Column:
    return F.lit(float("-inf"))


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_counter(col: Column | str) -> Column:
    """Text -> BIGINT, NULL when the text is not a base-10 int64."""
    s = _c(col)
    return F.when(s.rlike(INT_TEXT), s.try_cast("bigint"))


def parse_gauge(col: Column | str) -> Column:
    """Text -> DOUBLE, NULL when the text is not a float literal.

    NaN and infinities are accepted when spelled out; a digit string that
    overflows to infinity is refused."""
    s = _c(col)
    low = F.lower(s)
    special = (
        F.when(low == "nan", F.lit(float("nan")))
        .when(low.isin("inf", "+inf", "infinity", "+infinity"), _pos_inf())
        .when(low.isin("-inf", "-infinity"), _neg_inf())
    )
    num = s.try_cast("double")
    finite = F.when((s.rlike(FLOAT_TEXT) | s.rlike(HEX_FLOAT_TEXT)) & (F.abs(num) != _pos_inf()), num)
    return F.when(s.rlike(SPECIAL_FLOAT_TEXT), special).otherwise(finite)


def format_int(col: Column | str) -> Column:
    """``%d`` text of a BIGINT."""
    return _c(col).cast("string")


def _shl(x: Column, n: Column) -> Column:
    # SQL shiftleft takes a column shift count (the Python helper an int).
    return F.call_function("shiftleft", x, n)


def _pow2_decimal(n: Column) -> Column:
    """2^n as an exact DECIMAL(38,0) for 0 <= n <= 124."""
    lo = F.least(n, F.lit(62))
    one = F.lit(1).cast("bigint")
    return _shl(one, lo).cast("decimal(38,0)") * _shl(one, n - lo).cast("decimal(38,0)")


def _let(value: Column, body) -> Column:
    """Bind ``value`` once and use it in ``body`` (a one-element
    ``transform``): keeps a value that is used several times from being
    copied into the expression tree each time."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _fixed6_digits(mant: Column, n: Column) -> Column:
    """round_half_even(mant * 10^6 / 2^n) as plain digits, exactly."""
    million = F.lit(1_000_000).cast("decimal(38,0)")

    def with_frac(t):
        q, p = t["q"], t["p"]
        return _let(q % p, lambda rem: _let(((q - rem) / p).cast("decimal(38,0)"), lambda quo: F.when(
            (rem * F.lit(2) > p) | ((rem * F.lit(2) == p) & ((quo % F.lit(2)) == 1)), quo + F.lit(1)
        ).otherwise(quo).cast("decimal(38,0)")))

    frac = _let(
        F.struct((mant * million).alias("q"), _pow2_decimal(F.greatest(F.least(n, F.lit(124)), F.lit(0))).alias("p")),
        with_frac,
    )
    whole = (mant * _pow2_decimal(F.greatest(-n, F.lit(0))) * million).cast("decimal(38,0)")
    return F.when(n > 0, frac).otherwise(whole).cast("string")


def _whole_digits(a: Column) -> Column:
    """All digits of a double of at least 2^53: m * 2^n with m < 2^53, in
    limbs of nine decimal digits (lowest first), 29 powers of two at a time."""
    base = F.lit(1_000_000_000).cast("bigint")

    def times(limbs: Column, factor: Column) -> Column:
        empty = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("bigint").alias("carry"))
        return F.aggregate(
            limbs, empty,
            lambda acc, x: F.struct(
                F.concat(acc["out"], F.array((x * factor + acc["carry"]) % base)).alias("out"),
                F.call_function("div", x * factor + acc["carry"], base).alias("carry")),
            lambda acc: F.concat(acc["out"], F.array(acc["carry"])),
        )

    def expanded(e: Column) -> Column:  # e may be off by one near powers of two: m then has 53 to 55 bits, still whole
        mant = (a * F.pow(F.lit(2.0), F.lit(53) - e)).cast("bigint")
        n = e - F.lit(53)
        start = F.array(mant % base, F.call_function("div", mant, base))
        rounds = F.sequence(F.lit(0), F.call_function("div", n, F.lit(29)).cast("int"))
        step = lambda limbs, i: times(limbs, _shl(F.lit(1).cast("bigint"), F.least(F.lit(29), n - i * F.lit(29))))
        limbs = F.aggregate(rounds, start, step)
        text = F.array_join(F.transform(F.reverse(limbs), lambda x: F.lpad(x.cast("string"), 9, "0")), "")
        return F.regexp_replace(text, "^0+(?=.)", "")

    return _let(F.floor(F.log2(a)).cast("int"), expanded)


def format_fixed6(col: Column | str) -> Column:
    """``%f`` text: six decimals, correctly rounded from the double's exact
    binary value (round half to even), as Go and C print it; NaN and
    infinities as ``NaN``, ``+Inf``, ``-Inf``.

    The double is split exactly into an integer mantissa m < 2^53 and a
    power of two (``pow(2, n)`` and scaling by it are exact), then
    ``m * 10^6 / 2^n`` is rounded with exact decimal arithmetic: the
    remainder decides, so no division rounds.  Magnitudes of 1e30 and more
    are whole numbers whose digits exceed DECIMAL(38): their mantissa is
    multiplied out in base 10^9."""
    v = _c(col)
    a = F.abs(v)
    sign = F.when(v.cast("string").startswith("-"), F.lit("-")).otherwise(F.lit(""))

    def from_exponent(e0):  # e0 may be off by one at powers of two
        return _let(a * F.pow(F.lit(2.0), F.lit(52) - e0), lambda m0: _let(
            F.when(m0 >= F.lit(float(2**53)), F.lit(-1)).when(m0 < F.lit(float(2**52)), F.lit(1)).otherwise(F.lit(0)),
            lambda adj: _fixed6_digits((m0 * F.pow(F.lit(2.0), adj)).cast("decimal(38,0)"), F.lit(52) - e0 + adj),
        ))

    def place_point(r):
        return _let(F.when(F.length(r) < 7, F.lpad(r, 7, "0")).otherwise(r), lambda d: F.concat(
            sign, F.substr(d, F.lit(1), F.length(d) - F.lit(6)), F.lit("."), F.substr(d, F.length(d) - F.lit(5), F.lit(6))
        ))

    text = place_point(_let(F.floor(F.log2(a)).cast("int"), from_exponent))
    return (
        F.when(F.isnan(v), F.lit("NaN"))
        .when(v == _pos_inf(), F.lit("+Inf"))
        .when(v == _neg_inf(), F.lit("-Inf"))
        .when(a < F.lit(1e-8), F.concat(sign, F.lit("0.000000")))  # far below half of the last digit
        .when(a >= F.lit(1e30), F.concat(sign, _whole_digits(a), F.lit(".000000")))
        .otherwise(text)
    )


def _expand_sci(mant_digits: Column, sign: Column, e: Column) -> Column:
    """Plain decimal text of ``sign d.ddd x 10^e`` given the digit string."""
    digits = F.regexp_replace(mant_digits, r"0+$", "")
    digits = F.when(digits == "", F.lit("0")).otherwise(digits)
    n = F.length(digits)
    pos = e + F.lit(1)  # digits before the point
    big = F.when(n <= pos, F.concat(digits, F.repeat(F.lit("0"), pos - n))).otherwise(
        F.concat(F.substr(digits, F.lit(1), pos), F.lit("."), F.substr(digits, pos + F.lit(1), n - pos))
    )
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -pos), digits)
    return F.concat(sign, F.when(e >= 0, big).otherwise(small))


def _shortest_search(v: Column) -> Column:
    """Fewest significant digits (1..17) whose scientific text reads back as
    ``v``, expanded without exponent."""
    cands = F.transform(
        F.sequence(F.lit(0), F.lit(16)),
        lambda k: F.printf(F.concat(F.lit("%."), k.cast("string"), F.lit("e")), v),
    )
    best = F.element_at(F.filter(cands, lambda t: t.cast("double") == v), 1)

    def expand(t):
        mant = F.substring_index(t, "e", 1)
        sign = F.when(mant.startswith("-"), F.lit("-")).otherwise(F.lit(""))
        return _expand_sci(F.translate(mant, "-.", ""), sign, F.substring_index(t, "e", -1).cast("int"))

    return _let(best, expand)


def format_shortest(col: Column | str) -> Column:
    """Shortest round-trip decimal text of a DOUBLE, never with an exponent.

    Spark prints ``ddd.d`` inside [1e-3, 1e7), where the only excess is a
    trailing ``.0``, and ``d.dddE±n`` outside it; that form is expanded by
    moving the point with string operations, exact at every magnitude.
    Java 17's printer sometimes emits one digit too many (e.g.
    ``1.9999999999999998E23`` for 2e23, ``4.9E-324`` for 5e-324); when its
    text carries 16 or more significant digits, or the value is subnormal,
    the fewest digits that read back as the same double are searched
    instead (at most 17 format-and-parse steps, JVM-side)."""
    v = _c(col)
    s = v.cast("string")
    mant = F.substring_index(s, "E", 1)
    sig = F.length(F.regexp_replace(F.regexp_replace(F.translate(mant, "-.", ""), r"^0+", ""), r"0+$", ""))
    e = F.when(s.contains("E"), F.substring_index(s, "E", -1).cast("int"))
    sign = F.when(mant.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    expanded = _expand_sci(F.translate(mant, "-.", ""), sign, e)
    return (
        F.when(F.isnan(v), F.lit("NaN"))
        .when(v == _pos_inf(), F.lit("+Inf"))
        .when(v == _neg_inf(), F.lit("-Inf"))
        .when((sig >= 16) | ((v != 0) & (F.abs(v) < F.lit(2.2250738585072014e-308))), _shortest_search(v))
        .when(s.contains("E"), expanded)
        .when(s.endswith(".0"), F.substr(s, F.lit(1), F.length(s) - F.lit(2)))
        .otherwise(s)
    )


def indexed_name(prefix: str, pos0: Column | str) -> Column:
    """``prefix{N}`` with a 1-based N from a 0-based position."""
    return F.concat(F.lit(prefix), (_c(pos0) + F.lit(1)).cast("string"))
