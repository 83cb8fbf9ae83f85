"""Column expressions that turn market-site text into numbers and dates.

No Python runs per row: every parser is one expression inside the cleaning job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters the sources use.
MISSING_SIGN = "\u2205"
MINUS_SIGN = "\u2212"
NARROW_SPACE = "\u202f"
EM_DASH = "\u2014"
EN_DASH = "\u2013"
BIDI_MARKS = "\u202a\u202b\u202c\u202e\u202f"

# The power of ten each magnitude letter stands for.
MAGNITUDES = {"T": 12, "B": 9, "M": 6, "K": 3}

# Letters in rising order, so that a letter's place gives its power of a thousand.
_LETTERS = " KMBT"
_NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_key(c: Column | str) -> Column:
    """Join key for text dimensions: trimmed and upper-cased."""
    return F.upper(F.trim(_col(c)))


def not_blank(c: Column | str) -> Column:
    """True for text that holds more than spaces; false for null."""
    return F.coalesce(F.trim(_col(c)) != "", F.lit(False))


def location_key(c: Column | str) -> Column:
    """Location name with commas, hyphens and periods read as spaces."""
    return normalize_key(F.translate(_col(c), ",-.", "   "))


def strip_signs(c: Column | str) -> Column:
    """Drop the missing sign and all spacing, and write minus as ASCII ``-``."""
    spaceless = F.regexp_replace(_col(c), f"[\\s\u00a0{NARROW_SPACE}{MISSING_SIGN}]", "")
    return F.translate(spaceless, MINUS_SIGN, "-")


def try_decimal(c: Column | str, precision: int = 38, scale: int = 10) -> Column:
    """Decimal text to DECIMAL, null when it is anything else."""
    return _col(c).try_cast(f"decimal({precision},{scale})")


def try_double(c: Column | str) -> Column:
    """Number text to DOUBLE, null when it is anything else, such as ``1d`` or ``NaN``."""
    return F.regexp_extract(F.trim(_col(c)), _NUMBER, 0).try_cast("double")


def parse_magnitude(c: Column | str, letters: str = "TBMK", ignore_case: bool = False) -> Column:
    """``'1.25 B'`` to 1250000000 as DECIMAL(38,10); unknown text gives null."""
    return magnitude_of(strip_signs(c), letters, ignore_case)


def magnitude_of(text: Column | str, letters: str = "TBMK", ignore_case: bool = False) -> Column:
    """``parse_magnitude`` for text that ``strip_signs`` has cleaned."""
    value = F.upper(_col(text)) if ignore_case else _col(text)
    shape = rf"^([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+))([{letters}]?)$"
    number = try_decimal(F.regexp_extract(value, shape, 1))
    thousands = F.array(*[F.lit(10 ** (3 * i)).cast("decimal(13,0)") for i in range(len(_LETTERS))])
    # An empty letter is found at place 1, whose factor is one.
    place = F.position(F.regexp_extract(value, shape, 2), F.lit(_LETTERS))
    return F.try_multiply(number, F.get(thousands, place - F.lit(1))).try_cast("decimal(38,10)")


def convert_units(c: Column | str) -> Column:
    """B/M/K units in either case; without a unit every non-number sign is dropped."""
    text = strip_signs(c)
    with_unit = F.upper(F.right(text, F.lit(1))).isin("B", "M", "K")
    bare = try_decimal(F.regexp_replace(text, r"[^0-9.\-]", ""))
    return F.when(with_unit, parse_magnitude(text, "BMK", ignore_case=True)).otherwise(bare)


def _dash_to_null(c: Column) -> Column:
    return F.when(~c.isin("", "-", EM_DASH), c)


def parse_volume(c: Column | str) -> Column:
    """``'4.39 M'`` to 4390000 as BIGINT, cut towards zero; dashes give null.

    The unit letter may stand anywhere; M is looked for first, then K, then B.
    """
    text = F.upper(F.replace(F.trim(_dash_to_null(_col(c))), F.lit(","), F.lit("")))
    letter, factor = F.lit(""), F.lit(1.0)
    for unit in "BKM":
        letter = F.when(text.contains(unit), unit).otherwise(letter)
    for unit in "BKM":
        factor = F.when(letter == unit, float(10 ** MAGNITUDES[unit])).otherwise(factor)
    # The number is read in one place: a method this long per letter is never compiled.
    return (try_double(F.replace(text, letter, F.lit(""))) * factor).try_cast("bigint")


def clean_numeric(c: Column | str) -> Column:
    """Strip the currency, ``%``, commas and a plus sign; keep the minus sign."""
    text = _dash_to_null(_col(c))
    text = F.replace(text, F.lit("EGP"), F.lit(""))
    return try_double(F.translate(text, MINUS_SIGN + "%," + NARROW_SPACE, "-"))


def change_percent(c: Column | str) -> Column:
    """``'-1.25 (-2.5%)'`` to -2.5 as DOUBLE."""
    text = strip_signs(c)
    captured = F.regexp_extract(text, r"([+-]?[0-9]*\.?[0-9]+)%", 1)
    return try_decimal(captured).cast("double")


def trade_day(c: Column | str) -> Column:
    """``"Sun 07 Dec '25"`` to a date; the weekday name is not checked.

    Years 70 to 99 belong to the last century.
    """
    text = F.trim(F.replace(_col(c), F.lit(MISSING_SIGN), F.lit("")))
    day = F.regexp_extract(text, r"^\S+\s+([0-9]{1,2}\s+[A-Za-z]{3}\s+'[0-9]{2})$", 1)
    century = F.when(F.right(day, F.lit(2)) >= "70", -1200).otherwise(0)
    return F.add_months(F.try_to_timestamp(day, F.lit("d MMM ''yy")), century)


def quarter_start(c: Column | str) -> Column:
    """``"Q4 '24"`` to the first day of that quarter; other text gives null."""
    text = F.trim(_col(c))
    shape = r"^Q([1-4]) '?([0-9]{2})$"
    quarter = F.regexp_extract(text, shape, 1)
    year = F.regexp_extract(text, shape, 2)
    return F.when(
        quarter != "",
        F.make_date(
            F.lit(2000) + year.try_cast("int"),
            F.lit(1) + F.lit(3) * (quarter.try_cast("int") - F.lit(1)),
            F.lit(1),
        ),
    )


def fiscal_quarter_label(c: Column | str) -> Column:
    """The ``Q1``..``Q4`` part of a quarter text, null when absent."""
    return F.regexp_substr(_col(c), F.lit("Q[1-4]"))


def fiscal_year_number(c: Column | str) -> Column:
    """2000 plus the two digits behind the apostrophe."""
    digits = F.regexp_extract(_col(c), "'([0-9]{2})", 1)
    return F.lit(2000) + F.nullif(digits, F.lit("")).try_cast("int")


def scraped_value(c: Column | str) -> Column:
    """Scraped cell without direction marks; a lone dash means missing."""
    text = F.trim(F.translate(_col(c), BIDI_MARKS, ""))
    return F.when(~text.isin(EM_DASH, EN_DASH, "-"), text)
