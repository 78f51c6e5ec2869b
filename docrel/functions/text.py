"""Text functions. All are Column expressions, so they stay inside code generation."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

def _decompositions() -> tuple[dict[str, str], dict[str, str]]:
    """What compatibility decomposition leaves in ASCII of each character: to one character or none, and to several."""
    one, many = {}, {}
    for i in range(0x80, 0x10000):
        c = chr(i)
        plain = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode("ascii")
        if len(plain) == 1:
            one[c] = plain
        elif plain and i < 0x2200 or 0xFB00 <= i <= 0xFB06:
            many[c] = plain
    return one, many


_ONE, _MANY = _decompositions()


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with value as one term however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def fold(c: Column) -> Column:
    """Lower case, with each character as what compatibility decomposition leaves of it in ASCII: accents go, ligatures and full-width
    letters become plain ones, other characters vanish. Pure ASCII takes no table."""
    table = F.split(F.lit("\n".join(x + plain for x, plain in _MANY.items())), "\n")
    several = F.aggregate(table, c, lambda text, x: F.replace(text, F.substring(x, 1, 1), F.substring(x, F.lit(2), F.length(x))))
    several = F.when(F.rlike(c, F.lit(f"[{''.join(_MANY)}]")), several).otherwise(c)
    plain = F.regexp_replace(F.translate(several, "".join(_ONE), "".join(_ONE.values())), "[^\\x00-\\x7F]", "")
    return F.lower(F.when(F.octet_length(c) == F.char_length(c), c).otherwise(plain))


def _capitals() -> tuple[dict[str, str], str]:
    """The one capital of each character that has one, and the characters that full case mapping would make several or that got theirs after Unicode 15.1."""
    one, several = {"ß": "ẞ"}, []
    for i in range(0x80, 0x110000):
        c = chr(i)
        up = c.upper()
        if len(up) > 1:
            several.append(c)
            up = c.title() if len(c.title()) == 1 else c
        if up != c:
            one.setdefault(c, up)
    return one, "".join(several)


_CAPITALS, _SEVERAL = _capitals()
_LATER = "\u019b\u0264\u1c8a\ua7cd\ua7db" + "".join(map(chr, range(0x10D70, 0x10D86)))


def capitals(c: Column) -> Column:
    """Upper case character by character, as DuckDB's upper(): ß becomes ẞ, and what has no single capital stays. Only texts in which Spark's upper() would do
    otherwise take the table."""
    plain = "abcdefghijklmnopqrstuvwxyz"
    table = F.translate(c, plain + "".join(_CAPITALS), plain.upper() + "".join(_CAPITALS.values()))
    return F.when(F.rlike(c, F.lit(f"[{_SEVERAL}{_LATER}]")), table).otherwise(F.upper(c))


def tokens_text(c: Column) -> Column:
    """Lower case, with each run of anything but a-z and 0-9 as one blank. Accents separate; they are not folded."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def tokens(c: Column, least: int = 1) -> Column:
    """Distinct tokens of at least so many characters."""
    return F.array_distinct(F.filter(F.split(tokens_text(c), " "), lambda x: F.length(x) >= max(least, 1)))


def alnum_key(c: Column) -> Column:
    return F.regexp_replace(fold(c), "[^a-z0-9]", "")


def strip_control(c: Column) -> Column:
    """Without control characters other than tab, line feed and carriage return."""
    return F.regexp_replace(c, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]", "")


def compact(c: Column) -> Column:
    """Lines without blanks at the end; runs of four blanks or more become three, of three line ends or more two."""
    lines = F.regexp_replace(c, "(?m)[ \\t]+$", "")
    return F.trim(F.regexp_replace(F.regexp_replace(lines, " {4,}", "   "), "\n{3,}", "\n\n"))


def lines(c: Column) -> Column:
    return F.split(F.coalesce(c, F.lit("")), "\\R", -1)


def matches(c: Column, pattern: str) -> Column:
    """Case-insensitive Unicode search; null text matches nothing."""
    return F.coalesce(F.rlike(c, F.lit(f"(?iU){pattern}")), F.lit(False))


def model_codes(c: Column) -> Column:
    """Distinct alphanumeric codes of four characters or more with a letter and a digit, in lower case."""
    words = F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]{4,}"), F.lit(0))
    return F.array_distinct(F.filter(words, lambda w: F.rlike(w, F.lit("[a-z]")) & F.rlike(w, F.lit("[0-9]"))))


def distinctive_codes(c: Column) -> Column:
    """model_codes() of five characters or more, also with - and / inside, without those that name a component or a measure."""
    words = F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("[A-Za-z0-9][A-Za-z0-9\\-/]{3,}"), F.lit(0)), F.lower)
    good = lambda w: (F.length(w) >= 5) & F.rlike(w, F.lit("[a-z]")) & F.rlike(w, F.lit("[0-9]")) & ~F.rlike(w, F.lit(P.COMPONENT_CODE))
    return F.array_distinct(F.filter(words, good))


def content_tokens(c: Column) -> Column:
    """Distinct tokens of three characters or more that are no empty words."""
    return F.filter(tokens(c, 3), lambda w: ~w.isin(*P.EMPTY_WORDS))


def page_link(path: Column, page: Column) -> Column:
    """A path with / between its parts, and an anchor to a page if there is one."""
    clean = F.regexp_replace(path, r"\\\\", "/")
    return F.when(page.isNotNull(), F.concat(clean, F.lit("#page="), page.cast("string"))).otherwise(clean)


def overlap(a: Column, b: Column) -> Column:
    """Shared tokens by the smaller token set; 0 if one is empty."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.least(F.size(a), F.size(b))), F.lit(0.0))


def safe_name(c: Column, most: int = 120) -> Column:
    """A file name: reserved characters become _, blanks at the ends go, cut to a length."""
    return F.substring(F.trim(F.regexp_replace(c, '[<>:"/\\\\|?*\\x00-\\x1F]', "_")), 1, most)


def column_letter(n: Column) -> Column:
    """Spreadsheet column of a number from 1 to 18,278 (ZZZ)."""
    digit = lambda x: F.char(65 + F.pmod(x, F.lit(26)))
    second = F.floor((n - 1) / 26).cast("int")
    two = F.concat(digit(second - 1), digit(n - 1))
    return F.when(n <= 26, digit(n - 1)).when(n <= 702, two).otherwise(F.concat(digit(F.floor((n - 703) / 676).cast("int")), digit(F.floor((n - 703) / 26).cast("int")), digit(n - 703)))


def content_id(tender: Column, supplier: Column, *fields: Column) -> Column:
    """tender__supplier__ and eight digits of a hash of the fields, so it does not depend on the order of rows."""
    joined = F.concat_ws("|", *[F.coalesce(f.cast("string"), F.lit("")) for f in fields])
    return F.concat_ws("__", tender, supplier, F.substring(F.sha1(joined), 1, 8))
