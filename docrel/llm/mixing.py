"""Mixing sources to target weights, as hierarchical budgets over a domain-language-source tree.

A budget of tokens flows from the root down. At each node it is split by the children's weights; what a child cannot use
goes to its siblings first, and only what a whole family cannot use goes to its parent's siblings. Each leaf then
takes a token-prefix of seeded epochs. All sums are of whole numbers, so results do not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import stage

LEVELS = ("domain", "lang", "source")
SEED = "mix-1"
MAX_EPOCHS = 2
#: Share of all tokens that is asked for, in thousandths.
BUDGET_PERMILLE = 500
#: Weights by level and value; anything else weighs DEFAULT_WEIGHT.
WEIGHTS = {"domain": {"web": 4, "books": 3, "news": 2, "forum": 1}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 3}, "source": {"src0": 1, "src1": 3}}
DEFAULT_WEIGHT = 2
#: The domain of a source, by its number modulo 4; without a number: other.
DOMAINS = ("web", "books", "news", "forum")
#: Buckets of the seeded order in each leaf; a prefix is found from their sums, and only one bucket a leaf is sorted.
BUCKET_HEX = 3


def domain_of(source: Column) -> Column:
    number = F.regexp_extract(source, "([0-9]+)$", 1)
    names = F.array(*map(F.lit, DOMAINS))
    return F.when(number == "", F.lit("other")).otherwise(F.get(names, F.pmod(F.right(number, F.lit(9)).cast("int"), F.lit(len(DOMAINS)))))


def tokens_of(text: Column) -> Column:
    """Runs of characters other than ASCII blanks."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def _weight(level: str, weights: dict) -> Column:
    out = F.lit(DEFAULT_WEIGHT)
    for value, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == value, F.lit(int(w))).otherwise(out)
    return out.cast("long")


def budgets(leaves: DataFrame, total: Column | int, weights: dict = WEIGHTS, levels: tuple = LEVELS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """leaves (levels..., tokens) with budget: whole tokens granted to each leaf.

    A leaf holds at most tokens * max_epochs. Among siblings in ascending order of capacity by weight, one is filled up
    if the rest of the budget would give it that much; the others share what is left by weight, rounded down.
    """
    full = leaves.withColumn("_cap", F.col("tokens") * max_epochs)
    out = full.withColumn("_budget", total if isinstance(total, Column) else F.lit(total).cast("long"))
    for i, level in enumerate(levels):
        above, own = list(levels[:i]), list(levels[: i + 1])
        nodes = out.groupBy(*own).agg(F.sum("_cap").alias("_c"), F.first("_budget").alias("_b")).withColumn("_w", _weight(level, weights))
        order = W.partitionBy(*above).orderBy((F.col("_c") / F.col("_w")), level)
        before = order.rowsBetween(W.unboundedPreceding, -1)
        nodes = nodes.withColumn("_used", F.coalesce(F.sum("_c").over(before), F.lit(0))).withColumn("_rest", F.sum("_w").over(order.rowsBetween(0, W.unboundedFollowing)))
        fits = F.col("_c") * F.col("_rest") <= (F.col("_b") - F.col("_used")) * F.col("_w")
        nodes = nodes.withColumn("_fits", fits).withColumn("_open", F.sum(F.when(~F.col("_fits"), F.col("_w"))).over(W.partitionBy(*above))).withColumn("_full", F.coalesce(F.sum(F.when(F.col("_fits"), F.col("_c"))).over(W.partitionBy(*above)), F.lit(0)))
        share = F.when(F.col("_fits"), F.col("_c")).otherwise(F.expr("(_b - _full) * _w div _open"))
        nodes = nodes.select(*own, share.cast("long").alias("_budget"))
        out = out.drop("_budget").join(nodes, own)
    return out.select(*leaves.columns, F.col("_budget").alias("budget"))


def mix(docs: DataFrame, weights: dict = WEIGHTS, budget_permille: int = BUDGET_PERMILLE, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row for each chosen document: doc_id, domain, lang, source, tokens, copies, budget.

    copies is how often the mixture takes the document: once for each whole epoch its leaf affords and once more if it is in
    the token-prefix of the next, whose order is that of md5(seed|epoch|doc_id). The prefix holds documents while the
    running sum of tokens stays within the rest of the budget; rows that tie in that order stand or fall together.
    Null lang or source is the value 'unknown'; a null doc_id counts as the text ''. Empty texts have no tokens: they cost nothing and come with any prefix they
    lie in. A leaf with no tokens at all gets nothing. Other columns are not kept.
    """
    lang, source = (F.coalesce(F.col(c), F.lit("unknown")) for c in ("lang", "source"))
    slim = stage(docs.select("doc_id", domain_of(source).alias("domain"), lang.alias("lang"), source.alias("source"), tokens_of(F.col("text")).alias("tokens")))
    levels = list(LEVELS)
    leaves = slim.groupBy(*levels).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    total = leaves.agg(F.expr(f"sum(tokens) * {int(budget_permille)} div 1000").cast("long").alias("total"))
    asked = total.first()[0] or 0
    plan = stage(budgets(leaves, int(asked), weights, LEVELS, max_epochs).select(*levels, F.expr("budget div tokens").alias("whole"), F.expr("budget % tokens").alias("rest"), "budget"))
    rank = F.md5(F.concat_ws("|", F.lit(seed), (F.col("whole") + 1).cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    # the number of leaves is not bounded by anything here, so how the plan is joined is left to measured sizes
    ranked = slim.join(plan, levels).withColumn("rank", rank).withColumn("bucket", F.substring("rank", 1, BUCKET_HEX))
    key = [*levels, "bucket"]
    sums = ranked.groupBy(*key).agg(F.sum("tokens").alias("t"))
    sums = sums.withColumn("before", F.sum("t").over(W.partitionBy(*levels).orderBy("bucket")) - F.col("t")).select(*key, "before", "t")
    placed = ranked.join(stage(sums), key)
    edge = (F.col("before") <= F.col("rest")) & (F.col("before") + F.col("t") > F.col("rest"))
    inside = placed.where(~edge).withColumn("taken", (F.col("before") + F.col("t") <= F.col("rest")))
    run = F.sum("tokens").over(W.partitionBy(*key).orderBy("rank"))
    cut = placed.where(edge).withColumn("taken", F.col("before") + run <= F.col("rest"))
    out = inside.unionByName(cut).withColumn("copies", (F.col("whole") + F.col("taken").cast("long")).cast("long"))
    return out.where("copies > 0").select("doc_id", *levels, "tokens", "copies", "budget")


def oracle(docs: str = "documents", weights: dict = WEIGHTS, budget_permille: int = BUDGET_PERMILLE, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> str:
    """The same in DuckDB SQL, with one ordered sum for each whole leaf."""
    q = []
    names = " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(DOMAINS))
    q.append(
        "slim AS (SELECT doc_id, CASE WHEN regexp_extract(source, '([0-9]+)$', 1) = '' THEN 'other' ELSE CASE"
        f" CAST(right(regexp_extract(source, '([0-9]+)$', 1), 9) AS BIGINT) % {len(DOMAINS)} {names} END END AS domain, lang, source, tokens FROM"
        " (SELECT doc_id, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,"
        rf" CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS tokens FROM {docs}))"
    )
    q.append("leaves AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens FROM slim GROUP BY ALL HAVING sum(tokens) > 0)")
    q.append(f"l0 AS (SELECT *, tokens * {max_epochs} AS cap, CAST((SELECT sum(tokens) FROM leaves) * {budget_permille} // 1000 AS BIGINT) AS b FROM leaves)")
    for i, level in enumerate(LEVELS):
        own = ", ".join(LEVELS[: i + 1])
        part = f"PARTITION BY {', '.join(LEVELS[:i])}" if i else ""
        w = "CASE " + " ".join(f"WHEN {level} = '{v}' THEN {x}" for v, x in weights.get(level, {}).items()) + f" ELSE {DEFAULT_WEIGHT} END"
        q.append(f"n{i} AS (SELECT {own}, CAST(sum(cap) AS BIGINT) AS c, CAST(any_value(b) AS BIGINT) AS b, {w} AS w FROM l{i} GROUP BY {own})")
        order = f"({part} ORDER BY c / w, {level}"
        q.append(f"o{i} AS (SELECT *, coalesce(sum(c) OVER {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used, sum(w) OVER {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM n{i})")
        q.append(f"f{i} AS (SELECT *, c * rest <= (b - used) * w AS fits FROM o{i})")
        q.append(f"s{i} AS (SELECT {own}, CASE WHEN fits THEN c ELSE (b - coalesce(sum(CASE WHEN fits THEN c END) OVER ({part}), 0)) * w // sum(CASE WHEN NOT fits THEN w END) OVER ({part}) END AS b FROM f{i})")
        q.append(f"l{i + 1} AS (SELECT l.* EXCLUDE (b), CAST(s.b AS BIGINT) AS b FROM l{i} l JOIN s{i} s USING ({own}))")
    q.append("plan AS (SELECT domain, lang, source, b AS budget, b // tokens AS whole, b % tokens AS rest FROM l3)")
    q.append(f"ranked AS (SELECT s.*, budget, whole, rest, md5(concat_ws('|', '{seed}', CAST(whole + 1 AS VARCHAR), coalesce(CAST(doc_id AS VARCHAR), ''))) AS rank FROM slim s JOIN plan USING (domain, lang, source))")
    q.append("summed AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY rank RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM ranked)")
    q.append("counted AS (SELECT doc_id, domain, lang, source, tokens, CAST(whole + CAST(run <= rest AS BIGINT) AS BIGINT) AS copies, budget FROM summed)")
    return "WITH " + ",\n".join(q) + "\nSELECT * FROM counted WHERE copies > 0"
