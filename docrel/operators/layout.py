"""Evidence in the words of a page with their places: words has key columns, file, page, x0, top, x1, bottom, text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import digits_of, word_is_amount, word_is_whole
from .evidence import identity
from .link import first_by

_FIGURES = ("unit", "total", "quantity")


def _seen(words: Column, value: Column, whole: bool) -> Column:
    test = word_is_whole if whole else word_is_amount
    return F.exists(words, lambda w: test(w["text"], value))


def _judged(lines: DataFrame, columns: list[str]) -> DataFrame:
    """lines (columns, product, model, unit, total, quantity, words: array of x0, text) with the text, the figures that it lacks and how far it names the product."""
    text = F.array_join(F.transform(F.array_sort("words"), lambda w: w["text"]), " ")
    lacks = F.array_compact(F.array(*[F.when(F.col(f).isNotNull() & ~_seen(F.col("words"), F.col(f), f == "quantity"), F.lit(f)) for f in _FIGURES]))
    out = lines.withColumns({"line": text, "missing": lacks})
    named = identity(F.col("product"), F.col("model"), F.col("line"))
    return out.withColumn("located", F.when((named == "exacto") & (F.size("missing") > 0), "parcial").otherwise(named)).select(*columns, "line", "missing", "located")


def box_evidence(products: DataFrame, words: DataFrame, key: list[str]) -> DataFrame:
    """What lies in the box (struct x0, top, x1, bottom) that a product (key, seq, file, page, product, model, unit, total, quantity) names: words whose middle is inside. Boxes
    without words give nothing."""
    middle_x, middle_y = (F.col("x0") + F.col("x1")) / 2, (F.col("top") + F.col("bottom")) / 2
    w = words.select(*key, "file", "page", middle_x.alias("_x"), middle_y.alias("_y"), F.col("x0").alias("_x0"), F.col("text").alias("_w"))
    inside = F.col("_x").between(F.col("box.x0"), F.col("box.x1")) & F.col("_y").between(F.col("box.top"), F.col("box.bottom"))
    both = products.join(w, [*key, "file", "page"]).where(inside)
    own = [*key, "seq", "file", "page", "product", "model", *_FIGURES]
    lines = both.groupBy(*own).agg(F.collect_list(F.struct(F.col("_x0").alias("x0"), F.col("_w").alias("text"))).alias("words"))
    return _judged(lines, [*key, "seq", "file", "page"])


def line_evidence(products: DataFrame, words: DataFrame, key: list[str]) -> DataFrame:
    """The line of a product's documents that bears it out best: found by a word that writes its unit price or total, with the words whose middle lies in that
    word's band. Most figures win, then the nearest name, then the first place.

    Words and amounts meet by their digits, bands and words by cells of height, so neither join pairs all of a page. Both are merge joins: of exploded rows Spark
    guesses too small a size, and would bring all words to the driver to broadcast them.
    """
    digits = F.regexp_replace("text", "[^0-9]", "")
    seeds = words.select(*key, "file", "page", "top", "bottom", F.col("x0").alias("_at"), digits.alias("_d")).where("_d <> ''")
    amount = lambda c: F.filter(F.array(digits_of(F.col(c)), F.concat(digits_of(F.col(c)), F.lit("0")), F.concat(digits_of(F.col(c)), F.lit("00"))), lambda x: x.isNotNull())
    own = [*key, "seq", "product", "model", *_FIGURES]
    wanted = products.select(*own, F.explode(F.array_distinct(F.concat(amount("unit"), amount("total")))).alias("_d"))
    bands = wanted.join(seeds.hint("merge"), [*key, "_d"]).select(*own, "file", "page", "top", "bottom").distinct()
    cell = 10.0
    cells = F.sequence(F.floor(F.col("top") / cell).cast("int"), F.floor(F.col("bottom") / cell).cast("int"))
    middle = (F.col("top") + F.col("bottom")) / 2
    w = words.select(*key, "file", "page", middle.alias("_y"), F.floor(middle / cell).cast("int").alias("_c"), F.col("x0").alias("_x0"), F.col("text").alias("_w"))
    both = bands.withColumn("_c", F.explode(cells)).join(w.hint("merge"), [*key, "file", "page", "_c"]).where(F.col("_y").between(F.col("top"), F.col("bottom")))
    lines = both.groupBy(*own, "file", "page", "top", "bottom").agg(F.collect_list(F.struct(F.col("_x0").alias("x0"), F.col("_w").alias("text"))).alias("words"))
    found = _judged(lines, [*key, "seq", "file", "page", "top"])
    rank = F.when(F.col("located") == "exacto", 0).when(F.col("located") == "parcial", 1).otherwise(2)
    return first_by(found, [*key, "seq"], F.size("missing"), rank, "file", "page", "top")
