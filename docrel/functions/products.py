"""Classifiers of products, brands, types, documents and pages, as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .numbers import plausible_amounts
from .text import fold, let, lines, matches, tokens_text


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def brand(c: Column) -> Column:
    """A brand in its usual spelling; null for words that name none, and for several brands in one field."""

    def usual(text: Column, key: Column) -> Column:
        none = (text == "") | key.isin(*P.NOT_BRANDS) | F.rlike(key, F.lit(P.GENERIC_BRAND)) | (F.size(F.filter(F.split(key, "\\s*[/+,]\\s*|\\s+y\\s+"), lambda x: x != "")) > 1)
        return F.when(~none, F.coalesce(_lookup(P.BRAND_ALIASES, key), _lookup({b.lower(): b for b in P.BRANDS}, key), text))

    return let(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "(?U)\\s+", " ")), lambda text: let(fold(text), lambda key: usual(text, key)))


def same_brand(a: Column, b: Column) -> Column:
    """One contains the other, once aliases are resolved."""
    x, y = (F.regexp_replace(fold(F.coalesce(brand(c), F.lit(""))), "[^a-z0-9]", "") for c in (a, b))
    return (x != "") & (y != "") & (F.contains(x, y) | F.contains(y, x))


def type_name(c: Column) -> Column:
    def usual(key: Column) -> Column:
        dashed = F.replace(key, F.lit(" "), F.lit("-"))
        return F.when(key.isin(*P.TYPES), key).when(dashed.isin(*P.TYPES), dashed).otherwise(_lookup(P.TYPE_ALIASES, key))

    return let(F.trim(F.regexp_replace(fold(F.coalesce(c, F.lit(""))), "[\\s_-]+", " ")), usual)


def scope(description: Column, model: Column | None = None, category: Column | None = None) -> Column:
    """equipo, monitor, impresora or null. The order of the steps is the meaning."""
    none = F.lit(None).cast("string")
    d = F.coalesce(description, F.lit(""))
    text = F.concat_ws(" ", d, F.coalesce(model if model is not None else none, F.lit("")), F.coalesce(category if category is not None else none, F.lit("")))
    head = F.regexp_replace(d, "^[ \\t\\-*0-9.)(]+", "")
    named = lambda p: F.coalesce(F.rlike(head, F.lit(f"(?iU)^(?:{p})\\b")), F.lit(False))
    declared = F.lower(F.trim(category)) if category is not None else none
    return (
        F.when(matches(text, P.TELEVISION), none)
        .when(matches(d, P.ACCESSORY_FIRST) | matches(d, P.SOFTWARE) | matches(d, P.PERIPHERAL_FIRST), none)
        .when(matches(F.substring(d, 1, 40), "esc[aá]ner|scanner") & ~matches(d, "impresora|multifuncional"), none)
        .when(matches(d, P.LABOUR_FIRST), none)
        .when(matches(F.substring(d, 1, 45), P.ACCESSORY_HEAD) & ~matches(F.ltrim(d), f"^(?:{P.EQUIPMENT})") & ~matches(d, r"^\W*(?:monitor|impresora|multifuncional|all.?in.?one)"), none)
        .when(named("impresoras?|multifuncional(?:es)?"), "impresora")
        .when(named("monitor(?:es)?"), "monitor")
        .when(matches(text, P.EQUIPMENT), "equipo")
        .when(matches(text, P.OUT_OF_SCOPE), none)
        .when(matches(text, P.SPECIFICATION) & ~matches(text, P.MONITOR) & ~matches(text, P.PRINTER), none)
        .when(matches(text, P.MONITOR), "monitor")
        .when(matches(text, P.PRINTER), "impresora")
        .when(declared.isin("equipo", "monitor", "impresora"), declared)
    )


def equipment_type(declared: Column, category: Column, description: Column, model: Column, brand_: Column) -> Column:
    """The declared type, else by category, else by the first pattern that matches; a printer's text or brand overrides vague types."""
    text = F.concat_ws(" ", F.coalesce(description, F.lit("")), F.coalesce(model, F.lit("")))
    found = F.coalesce(type_name(declared), F.when(category.isin("monitor", "impresora"), category))
    for name, p in P.TYPE_PATTERNS:
        found = F.coalesce(found, F.when(matches(text, p), F.lit(name)))
    found = F.coalesce(found, F.when(category == "equipo", F.lit("equipo (sin especificar)")))
    vague = found.isNull() | found.isin("all-in-one", "desktop", "equipo (sin especificar)")
    prints = matches(text, P.STRONG_PRINTER) | F.coalesce(F.lower(F.trim(brand_)).isin(*P.PRINTER_BRANDS), F.lit(False))
    return F.when(vague & prints, F.lit("impresora")).otherwise(found)


def type_group(t: Column) -> Column:
    """Desktops and workstations count as one."""
    return F.when(t == "workstation", F.lit("desktop")).otherwise(t)


def document_kind(name: Column) -> Column:
    """economico before tecnico, by words in the file name; otherwise otro."""
    kind = lambda key: F.when(F.rlike(key, F.lit(P.ECONOMIC_NAME)), "economico").when(F.rlike(key, F.lit(P.TECHNICAL_NAME)), "tecnico").otherwise("otro")
    return let(fold(F.coalesce(name, F.lit(""))), kind)


def tender_state(state: Column) -> tuple[Column, Column]:
    """Whether a tender is kept, and whether its offers are public."""
    dropped = matches(state, P.STATE_DROP)
    return ~dropped & matches(state, P.STATE_KEEP), ~dropped & matches(state, P.STATE_OPENED)


def tender_in_scope(name: Column, description: Column) -> Column:
    text = F.concat_ws(" ", F.coalesce(name, F.lit("")), F.coalesce(description, F.lit("")))
    return ~matches(text, P.TENDER_OUT) & matches(text, P.TENDER_IN)


def page_relevant(text: Column) -> Column:
    """Any amount, word of a product or tag of identity, or two technical details."""
    details = F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?iU){P.TECHNICAL_DETAIL}"), F.lit(0)), F.lower))
    return matches(text, P.AMOUNT) | names_product(text) | matches(text, P.TECHNICAL_IDENTITY) | (F.size(details) >= 2)


def names_product(text: Column) -> Column:
    return matches(text, P.EQUIPMENT + "|monitor|impresora|multifuncional|all.?in.?one")


def page_in_scope(text: Column) -> Column:
    """Names equipment, or equipment in general and no television."""
    named = matches(text, P.EQUIPMENT) | matches(text, P.MONITOR) | matches(text, P.PRINTER)
    return named | (matches(text, P.GENERIC_EQUIPMENT) & ~matches(text, P.TELEVISION))


def price_row_like(line: Column) -> Column:
    """A line with an amount and at least two numbers."""
    return matches(line, P.AMOUNT) & (F.regexp_count(line, F.lit(P.NUMBER)) >= 2)


def vision_reason(text: Column, tables: Column, collapsed: Column, min_rows: int = 2) -> Column:
    """Why a page should be read as an image: sin_texto, tabla_colapsada, tabla_sin_bordes; null if as text."""
    speaks = matches(text, P.PRICE_WORD)
    rows = F.size(F.filter(lines(text), price_row_like))
    return (
        F.when((F.length(F.coalesce(text, F.lit(""))) <= 40) & (tables == 0), "sin_texto")
        .when(~page_in_scope(text), F.lit(None))
        .when(collapsed > 0, F.when(speaks | matches(text, P.AMOUNT), "tabla_colapsada"))
        .when((tables == 0) & speaks & (rows >= min_rows), "tabla_sin_bordes")
    )


def table_structured(rows: Column) -> Column:
    """Whether half of the rows (arrays of cells) that have a cell at all have two."""
    filled = F.transform(rows, lambda r: F.size(F.filter(r, lambda c: F.trim(F.coalesce(c, F.lit(""))) != "")))
    some = F.filter(filled, lambda n: n > 0)
    return (F.size(some) > 0) & (F.size(F.filter(some, lambda n: n >= 2)) * 2 >= F.size(some))


def outside(box: Column, boxes: Column) -> Column:
    """Whether a rectangle (x0, top, x1, bottom) overlaps none of an array of rectangles; shared edges do not count."""
    return ~F.exists(boxes, lambda b: (box["x0"] < b["x1"]) & (box["x1"] > b["x0"]) & (box["top"] < b["bottom"]) & (box["bottom"] > b["top"]))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(path, r"\\\\", "/"), "/"), -1)


def history_document(path: Column, text: Column) -> Column:
    """Whether a document shows past sales of a bidder, by its path or its first 4,000 characters."""
    return matches(path, P.HISTORY_NAME) | matches(F.substring(text, 1, 4000), P.HISTORY_TEXT)


def document_role(path: Column, text: Column) -> Column:
    """economico, tecnico, administrativo or otro: by the prefix of the name, else by words in the name, else by the content."""
    prefix = F.lower(F.split(base_name(path), "__", 2)[0])
    kind = document_kind(path)
    technical = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"(?iU){P.TECHNICAL_TEXT}")) >= 3
    return (
        F.when(prefix.isin(*P.ROLE_PREFIXES), prefix).when(kind != "otro", kind).when(matches(text, P.ADMIN_TEXT), "administrativo")
        .when((F.size(plausible_amounts(text)) > 0) & matches(text, P.PRICE_KEY), "economico").when(technical, "tecnico").otherwise("otro")
    )


def administrative_noise(path: Column) -> Column:
    """Whether a file of the administrative attachment is by its name clearly no offer."""
    there = F.contains(F.regexp_replace(path, r"\\\\", "/"), F.lit("administrativo__"))
    name = base_name(path)
    return there & matches(name, P.ADMIN_NOISE) & ~matches(name, P.ADMIN_USEFUL)


def attachment_noise(name: Column) -> Column:
    """Whether an attachment of the portal is by its name paperwork and no offer."""
    return matches(name, P.ATTACHMENT_NOISE) & ~matches(name, P.ATTACHMENT_USEFUL)


def no_equipment(text: Column, name: Column) -> Column:
    """Whether a technical attachment can bear no equipment: empty, no word of a product, brand or family in its first 80,000 characters, past
    sales, or a certificate without identity or rows of equipment."""
    head = F.substring(F.coalesce(text, F.lit("")), 1, 80_000)
    rows = F.exists(lines(head), lambda x: F.startswith(x, F.lit("FILA")) & matches(x, P.STRICT_EQUIPMENT))
    nothing = (F.trim(head) == "") | (~names_product(head) & ~matches(head, P.BRAND_OR_FAMILY))
    return nothing | matches(name, P.HISTORY_NAME) | (matches(name, P.NOISE_NAME) & ~matches(head, P.TECHNICAL_IDENTITY) & ~rows)


def transient_error(text: Column) -> Column:
    return matches(text, P.TRANSIENT_ERROR)


def family_brands(text: Column) -> Column:
    """Distinct brands of the product families that a text names."""
    named = lambda words: "(?i)(?<![A-Za-z0-9])(?:" + "|".join(map(re.escape, words)) + ")(?![A-Za-z0-9])"
    by: dict[str, list[str]] = {}
    for family, b in P.FAMILY_BRANDS.items():
        by.setdefault(b, []).append(family)
    return F.array_compact(F.array(*[F.when(F.rlike(F.coalesce(text, F.lit("")), F.lit(named(f))), F.lit(b)) for b, f in by.items()]))


def brand_spoken(text: Column) -> Column:
    """Whether a text has the first word of a brand or family, without which brand_in() finds none."""
    words = sorted({name.split()[0].lower() for name in (*P.BRANDS_IN_TEXT, *P.FAMILY_BRANDS)})
    return F.rlike(F.coalesce(text, F.lit("")), F.lit(f"(?i)(?<![A-Za-z0-9])(?:{'|'.join(map(re.escape, words))})"))


def brand_in(text: Column) -> Column:
    """The only brand that a text names by itself or by a family; null if it names several or states a requirement. Only texts with a first word of one are
    searched for each."""
    said = F.coalesce(text, F.lit(""))
    by_name = F.array_compact(F.array(*[F.when(F.rlike(said, F.lit(f"(?i)(?<![A-Za-z0-9]){re.escape(b)}(?![A-Za-z0-9])")), F.lit(b)) for b in P.BRANDS_IN_TEXT]))
    found = F.array_distinct(F.concat(by_name, family_brands(said)))
    return F.when(brand_spoken(said), F.when(~matches(said, P.REQUIREMENT) & (F.size(found) == 1), F.get(found, F.lit(0))))


def brand_by_family(brand_: Column, text: Column) -> Column:
    """brand_, or the brand of the only family that a text names where that is another one; requirements change nothing."""
    families = family_brands(text)
    wrong = brand_.isNotNull() & (F.size(families) == 1) & ~F.array_contains(families, brand_) & ~matches(text, P.REQUIREMENT)
    return F.when(F.coalesce(wrong, F.lit(False)), F.get(families, F.lit(0))).otherwise(brand_)


def garbage(text: Column, least: int = 40, share: float = 0.6) -> Column:
    """At least so many words, of which more than a share has one or two letters and is no usual short word."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("[A-Za-zÁÉÍÓÚáéíóúñÑ]+"), F.lit(0))
    short = F.filter(words, lambda w: (F.length(w) <= 2) & ~F.lower(w).isin(*P.SHORT_WORDS))
    return (F.size(words) >= least) & (F.size(short) / F.size(words) > share)


def specific(description: Column) -> Column:
    """Has a digit or six words, once normalised."""
    d = tokens_text(F.coalesce(description, F.lit("")))
    return F.rlike(d, F.lit("[0-9]")) | (F.size(F.filter(F.split(d, " "), lambda w: w != "")) >= 6)


def generic(description: Column) -> Column:
    """Names a kind of equipment, or a type or line by its number, and nothing else."""
    return matches(tokens_text(F.coalesce(description, F.lit(""))), P.GENERIC_DESCRIPTION)
