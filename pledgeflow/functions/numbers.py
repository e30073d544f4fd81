"""Parsing and printing of numbers as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Compute ``value`` once and use it several times in one expression."""
    return F.transform(F.array(value), lambda v: use(v))[0]


# --- parsing -----------------------------------------------------------------


def digits_only(text: Column) -> Column:
    """Digits before the first dot as a whole number: ``$1,234.50`` -> 1234."""
    whole = F.split_part(text, F.lit("."), F.lit(1))
    return F.regexp_replace(whole, "[^0-9]", "").try_cast("long")


def money(text: Column) -> Column:
    """``$1,234.50`` or a bare ``0``; anything else is NULL (quarantine it)."""
    clean = F.replace(F.trim(text), F.lit(","), F.lit(""))
    amount = F.regexp_extract(clean, r"^\$(.*)$", 1).try_cast("double")
    return F.when(clean.startswith("$"), amount).when(clean == "0", F.lit(0.0))


def plain_number(text: Column) -> Column:
    """Number with thousands commas."""
    return F.replace(F.trim(text), F.lit(","), F.lit("")).try_cast("double")


def counted(text: Column, unit: str) -> Column:
    """``1,234 backers`` or ``1 backer`` -> the count."""
    clean = F.replace(F.trim(text), F.lit(","), F.lit(""))
    return F.regexp_replace(clean, f" {unit}s?", "").try_cast("long")


def strip_chars(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def keep_ein(text: Column) -> Column:
    """Registration number: digits and dashes only."""
    return F.regexp_replace(F.trim(text), "[^0-9-]", "")


# --- rounding ----------------------------------------------------------------


def _exponent(magnitude: Column) -> Column:
    return F.floor(F.log10(magnitude)).cast("int")


def _ten(exponent: Column) -> Column:
    return F.pow(F.lit(10.0), exponent.cast("double"))


def sig_figs(x: Column, figures: int = 1) -> Column:
    """Round half-even to significant figures; zero stays zero."""

    def rounded(shift: Column) -> Column:
        return F.when(shift >= 0, F.bround(x * _ten(shift)) / _ten(shift)).otherwise(
            F.bround(x / _ten(-shift)) * _ten(-shift)
        )

    return F.when(x == 0, F.lit(0.0)).otherwise(bind(F.lit(figures - 1) - _exponent(F.abs(x)), rounded))


def ceil_first_figure(x: Column) -> Column:
    """Next multiple of the leading power of ten: 4321 -> 5000."""
    first = F.substring(x.cast("string"), 1, 1).try_cast("int")
    return (first + 1) * _ten(_exponent(F.abs(x)))


# --- printing ----------------------------------------------------------------


def to_precision(x: Column, p: int) -> Column:
    """Text with p significant digits; exponent form below 0.01 and from 10**p on."""
    if p < 2:
        raise ValueError("at least two digits")
    size = F.abs(x.cast("double"))

    def laid_out(number: Column) -> Column:
        """``d.ddde+xx`` as a plain number: zeros before it, the point moved into it."""
        power = F.split_part(number, F.lit("e"), F.lit(2)).cast("int")
        digits = F.concat(F.repeat(F.lit("0"), -power), F.replace(F.split_part(number, F.lit("e"), F.lit(1)), F.lit("."), F.lit("")))
        whole = F.greatest(power, F.lit(0)) + 1
        plain = F.rtrim(F.concat(F.substr(digits, F.lit(1), whole), F.lit("."), F.substr(digits, whole + 1)), F.lit("."))
        far = F.concat(F.split_part(number, F.lit("e"), F.lit(1)), F.format_string("e%s%d", F.when(power > 0, "+").otherwise(""), power))
        return F.when(power.between(-2, p - 1), plain).otherwise(far)

    text = F.when(size == 0, F.lit("0." + "0" * (p - 1))).otherwise(bind(F.format_string(f"%.{p - 1}e", size), laid_out))
    return F.when(x.isNotNull(), F.concat(F.when(x < 0, "-").otherwise(""), text))


def four_digits(x: Column) -> Column:
    """A number kept to four significant digits, without trailing zeros.

    Rounded half-even in double arithmetic: a value written with a fifth and last digit of
    five counts as a tie, whichever side of it its binary form lies.

    Struct of ``sign``, ``digits``, ``left`` (how many digits stand left of the point,
    possibly negative) and the rounded ``value``.
    """

    def rounded(e: Column) -> Column:
        size = F.abs(x)
        n = F.bround(F.when(e >= 3, size / _ten(e - 3)).otherwise(size * _ten(F.lit(3) - e))).cast("long")

        def settle(n: Column) -> Column:
            over = n == 10_000
            return F.struct(
                F.when(over, F.lit(1_000).cast("long")).otherwise(n).alias("n"),
                F.when(over, e + 1).otherwise(e).alias("e"),
            )

        return bind(n, settle)

    def parts(number: Column) -> Column:
        n, e = number["n"], number["e"]
        value = F.when(e >= 3, n * _ten(e - 3)).otherwise(n / _ten(F.lit(3) - e))
        return F.struct(
            F.when(x < 0, "-").otherwise("").alias("sign"),
            F.rtrim(n.cast("string"), F.lit("0")).alias("digits"),
            (e + 1).alias("left"),
            F.when(x < 0, -value).otherwise(value).alias("value"),
        )

    x = x.cast("double")
    zero = F.struct(
        F.lit("").alias("sign"), F.lit("0").alias("digits"), F.lit(1).alias("left"), F.lit(0.0).alias("value")
    )
    return F.when(x == 0, zero).otherwise(bind(bind(_exponent(F.abs(x)), rounded), parts))


def _placed(digits: Column, point: Column) -> Column:
    """Digits with the decimal point after ``point`` of them, zero padded."""
    size = F.length(digits)
    return (
        F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        .when(point >= size, F.concat(digits, F.repeat(F.lit("0"), point - size)))
        .otherwise(F.concat(F.substr(digits, F.lit(1), point), F.lit("."), F.substr(digits, point + 1)))
    )


def engineering(four: Column) -> Column:
    """Engineering notation of :func:`four_digits`: struct of ``mantissa`` and ``exponent``.

    Plain notation (exponent 0) applies while no padding zeros are needed on the right and
    at most five leading zeros on the left; a whole number that ends in zeros counts as padded.
    """

    def at(point: Column) -> Column:
        return F.struct(
            F.concat(four["sign"], _placed(four["digits"], point)).alias("mantissa"),
            (four["left"] - point).alias("exponent"),
        )

    plain = (four["left"] <= F.length(four["digits"])) & (four["left"] > -6)
    return bind(F.when(plain, four["left"]).otherwise(F.pmod(four["left"] - 1, F.lit(3)) + 1), at)


# fixed values: names of the powers of a thousand, long and short
PREFIXES = {
    -12: ("Trillionths", "Trillionths"),
    -9: ("Billionths", "Billionths"),
    -6: ("Millionths", "Millionths"),
    -3: ("Thousandths", "Thousandths"),
    3: ("Thousand", "Th"),
    6: ("Million", "Mi"),
    9: ("Billion", "Bi"),
    12: ("Trillion", "Tr"),
}


def pretty_number(x: Column, short: bool = False) -> Column:
    """``12.35 Million``; powers without a name are NULL."""

    def worded(eng: Column) -> Column:
        word = F.lit(None).cast("string")
        for power, names in PREFIXES.items():
            word = F.when(eng["exponent"] == power, names[1 if short else 0]).otherwise(word)
        return F.when(eng["exponent"] == 0, eng["mantissa"]).otherwise(
            F.concat(eng["mantissa"], F.lit(" "), word)
        )

    return F.when(x == 0, F.lit("0.0")).otherwise(bind(bind(four_digits(x), engineering), worded))


def grouped_text(x: Column) -> Column:
    """Four significant digits: thousands commas from 1 to a million, else engineering form."""

    def grouped(fixed: Column) -> Column:
        whole = F.split_part(fixed, F.lit("."), F.lit(1))
        fraction = F.split_part(fixed, F.lit("."), F.lit(2))
        tail = F.when(fraction != "", F.concat(F.lit("."), fraction)).otherwise("")
        return F.concat(F.format_number(whole.try_cast("long"), 0), tail)

    def powered(eng: Column) -> Column:
        power = F.concat(
            F.lit("E"), F.when(eng["exponent"] > 0, "+").otherwise(""), eng["exponent"].cast("string")
        )
        return F.when(eng["exponent"] == 0, eng["mantissa"]).otherwise(F.concat(eng["mantissa"], power))

    def printed(four: Column) -> Column:
        between = (four["value"] >= 1) & (four["value"] < 1_000_000)
        return F.when(between, bind(_placed(four["digits"], four["left"]), grouped)).otherwise(
            bind(engineering(four), powered)
        )

    return bind(four_digits(x), printed)


def axis_ticks(low: float, high: float, count: int) -> Column:
    """Evenly spaced ticks from ``low`` by ``high / count`` while below ``high + 1``."""
    step = high / count
    last = F.ceil((F.lit(float(high)) + 1 - low) / step) - 1
    return F.transform(F.sequence(F.lit(0), last.cast("int")), lambda i: F.lit(float(low)) + i * step)


def log_edges(decades: int, per_decade: int) -> Column:
    """Log-spaced bin edges from 1."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(decades * per_decade)), lambda i: F.pow(F.lit(10.0), i / per_decade)
    )
