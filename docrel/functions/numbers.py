"""Numbers, amounts and dates as they are written in price documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .text import let

VAT = 1.19


def parse_number(c: Column) -> Column:
    """A written amount as a double: dots or commas as thousands, a comma as decimal sign, $ and a trailing dash; signs are dropped.

    1.409 is 1409 and 1.5 is 1.5. Text with two dots that are not thousands is null.
    """
    def plain(s: Column) -> Column:
        dots = F.rlike(s, F.lit("^\\d{1,3}(?:\\.\\d{3})+(?:,\\d+)?$"))
        commas = F.rlike(s, F.lit("^\\d{1,3}(?:,\\d{3})+$"))
        return (
            F.when(dots, F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
            .when(commas, F.replace(s, F.lit(","), F.lit("")))
            .when(F.contains(s, F.lit(",")) & ~F.contains(s, F.lit(".")), F.replace(s, F.lit(","), F.lit(".")))
            .otherwise(s)
        )

    bare = F.regexp_replace(F.regexp_replace(F.trim(c), "[$ ]", ""), "[.\\-\\u2013\\u2014]+$", "")
    # each step once, however often the next one looks at it
    return let(bare, lambda s: let(F.regexp_replace(plain(s), "[^0-9.]", ""), lambda digits: F.when(F.rlike(digits, F.lit("[0-9]")), digits.try_cast("double"))))


def parse_budget(c: Column) -> Column:
    """Digits of a value that is a number but for dots and commas (123,50 is 12350); null for ranges in words."""
    s = F.trim(F.coalesce(c, F.lit("")))
    return F.when(F.rlike(s, F.lit("^[0-9.,]*[0-9][0-9.,]*$")), F.regexp_replace(s, "[.,]", "").try_cast("bigint"))


def near(a: Column, b: Column, tolerance: float = 0.01) -> Column:
    """Equal to a share of b, at least 1. A null on either side agrees with anything."""
    return a.isNull() | b.isNull() | (F.abs(a - b) <= F.greatest(F.lit(1.0), F.abs(b) * tolerance))


def near_strict(a: Column, b: Column, within: float) -> Column:
    return F.coalesce(F.abs(a - b) <= within, F.lit(False))


def coherent(quantity: Column, unit: Column, total: Column, least: float = 2.0, share: float = 0.001) -> Column:
    """quantity times unit is total, to the larger of two tolerances; nulls are not coherent."""
    return F.coalesce(F.abs(quantity * unit - total) <= F.greatest(F.lit(least), F.abs(total) * share), F.lit(False))


def line_coherent(quantity: Column, unit: Column, total: Column) -> Column:
    """A line whose three figures are positive and agree to max(2, 0.1 %)."""
    return F.coalesce((quantity > 0) & (unit > 0) & (total > 0), F.lit(False)) & coherent(quantity, unit, total)


def net_of_vat(quantity: Column, unit: Column, total: Column) -> Column:
    """total, or quantity times unit (rounded half to even) where total is that with VAT and not what it is without."""
    net = quantity * unit
    gross = F.abs(total - net * VAT) <= F.greatest(F.lit(3.0), net * 0.004)
    apart = F.abs(total - net) > F.greatest(F.lit(2.0), net * 0.01)
    return F.when((quantity > 0) & (unit > 0) & (total > 0) & gross & apart, F.bround(net)).otherwise(total)


def item_number(c: Column) -> Column:
    """The only group of digits in a text, if there is just one and it has under seven."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("[0-9]+"), F.lit(0))
    return F.when((F.size(found) == 1) & (F.length(F.get(found, F.lit(0))) < 7), F.get(found, F.lit(0)).cast("int"))


def numbers_in(c: Column) -> Column:
    """Distinct amounts written in a text, as whole numbers (half to even): each run of digits, dots and commas is read as parse_number()
    reads it, without the signs at its end."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(P.NUMBER_IN_TEXT), F.lit(0))
    read = F.transform(found, lambda x: F.bround(parse_number(F.regexp_replace(x, "[.,]+$", ""))))
    return F.array_distinct(F.transform(F.filter(read, lambda x: x.isNotNull() & (x < 9e18)), lambda x: x.cast("bigint")))


def plausible_amounts(c: Column) -> Column:
    """Amounts written with thousands signs, from 1,000 to 2,000,000,000, in order."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"(?U){P.THOUSANDS_AMOUNT}"), F.lit(1))
    read = F.transform(found, lambda x: F.regexp_replace(x, "[.,]", "").try_cast("bigint"))
    return F.filter(read, lambda x: x.between(1_000, 2_000_000_000))


def digits_of(c: Column) -> Column:
    """The digits of a number's whole part, as text; null for null and below zero."""
    return F.when(c >= 0, F.format_string("%d", F.bround(c).cast("bigint")))


def word_is_amount(word: Column, value: Column) -> Column:
    """Whether a word writes an amount: its digits are the amount's, with up to two zeros after them."""
    said, want = F.regexp_replace(word, "[^0-9]", ""), digits_of(value)
    return F.coalesce((said == want) | (said == F.concat(want, F.lit("0"))) | (said == F.concat(want, F.lit("00"))), F.lit(False))


def word_is_whole(word: Column, value: Column) -> Column:
    """Whether a word writes a whole number, with up to two decimal zeros."""
    bare = F.regexp_replace(F.regexp_replace(word, r"^[ .,;:()$-]+|[ .,;:()$-]+$", ""), r"[.,]0{1,2}$", "")
    return F.coalesce((value == F.bround(value)) & (bare == F.format_string("%d", value.cast("bigint"))), F.lit(False))


def cell_text(c: Column) -> Column:
    """A number as a cell shows it: whole ones of 1,000 and more with thousands dots, others plain."""
    whole = c == F.bround(c)
    return F.when(whole & (F.abs(c) >= 1000), thousands(c)).when(whole, F.format_string("%d", c.cast("bigint"))).otherwise(c.cast("string"))


def offered_total(c: Column) -> Column:
    """An offer's total as it is written in a grid; null if that is no credible offer."""
    value = parse_number(c)
    return F.when(value >= P.OFFER_LEAST, value)


def thousands(c: Column) -> Column:
    """1234567 as 1.234.567."""
    return F.translate(F.format_number(c, 0), ",", ".")


def spellings(c: Column) -> Column:
    """How an amount may be written."""
    plain = F.format_string("%d", c.cast("bigint"))
    return F.array_distinct(F.array(plain, thousands(c), F.format_number(c, 0), F.concat(F.lit("$"), thousands(c)), F.concat(F.lit("$ "), thousands(c))))


def month(c: Column) -> Column:
    """yyyy-MM of a written date: four formats, else year and month found anywhere, else sin_fecha."""
    s = F.trim(F.coalesce(c, F.lit("")))
    tries = [F.date_format(F.try_to_timestamp(s, F.lit(f)), "yyyy-MM") for f in ("d/M/yyyy H:m:s", "d/M/yyyy", "yyyy-M-d H:m:s", "yyyy-M-d")]

    def found(pattern: str, year: int, mon: int) -> Column:
        return F.when(F.rlike(s, F.lit(pattern)), F.concat_ws("-", F.regexp_extract(s, pattern, year), F.lpad(F.regexp_extract(s, pattern, mon), 2, "0")))

    return F.coalesce(*tries, found("\\b(20\\d{2})[-/](\\d{1,2})", 1, 2), found("\\b\\d{1,2}/(\\d{1,2})/(20\\d{2})", 2, 1), F.lit("sin_fecha"))


def in_months(m: Column, first: str | None, last: str | None) -> Column:
    """Undated rows pass only if there is no bound."""
    if not first and not last:
        return F.lit(True)
    dated = m != "sin_fecha"
    return dated & (m >= first if first else F.lit(True)) & (m <= last if last else F.lit(True))
