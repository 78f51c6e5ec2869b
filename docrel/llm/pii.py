"""PII by information-theoretic sanitisation, in DataFrame functions only.

Base patterns find protected entities. Co-occurrence over the corpus then says how much a term tells about an entity e:
PMI(t, e) / IC(e), where IC(e) = -log p(e) is what seeing e itself would tell. Terms at or above the disclosure
threshold, in documents that hold the entity, become spans of kind term unless chance explains that they meet; sanitise() generalises or removes all spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spread_join, stage

KINDS = ("email", "ip", "card", "phone")
# fixed values: the base patterns. Possessive loops and the look-behinds only spare the engine restarts inside a run
# from which no match can begin, so what is found is the same; \G is the end of the match before.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_MARK = {"email": "@", "ip": ".", "phone": "+"}
TERM = r"\p{L}{4,}+"
#: A term discloses an entity if it carries this share of the entity's information.
DISCLOSURE = 0.8
#: A term whose meetings with an entity are likelier than this by chance does not disclose it.
CHANCE = 0.01
SPAN = "struct<kind:string,start:int,end:int>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(d: Column) -> Column:
    def add(acc: Column, i: Column) -> Column:
        x = F.ascii(F.substring(d, F.length(d) - i + 1, F.lit(1))) - 48
        return acc + F.when(i % 2 == 1, x).when(x > 4, 2 * x - 9).otherwise(2 * x)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        def part(p: Column) -> Column:
            p = F.regexp_replace(p, "^0+", "")
            return (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255"))

        return F.forall(F.split(m, r"\."), part)
    if kind == "card":
        n = F.length(_digits(m))
        return F.when(n.between(16, 19), _luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    return F.lit(True)


def _spans(text: Column, pattern: str, kind: str, keep) -> Column:
    """Spans of the matches that keep() accepts, in code points.

    split() gives the gaps between just those matches that regexp_extract_all() gives, so their lengths add up to places.
    """
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    both = F.arrays_zip(found.alias("m"), F.slice(gaps, 1, F.size(found)).alias("g"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["at"] + F.length(x["g"])
        b = a + F.length(x["m"])
        span = F.struct(F.lit(kind).alias("kind"), a.alias("start"), b.alias("end"))
        return F.struct(b.alias("at"), F.when(keep(x["m"]), F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(both, start, step, lambda acc: acc["out"])


def base_spans(text: Column, kind: str) -> Column:
    """Valid matches of a kind as array of (kind, start, end)."""
    none = F.array().cast(f"array<{SPAN}>")
    there = F.rlike(text, F.lit(PATTERNS[kind]))
    if kind in _MARK:
        there = F.contains(text, F.lit(_MARK[kind])) & there
    return F.when(there, _spans(text, PATTERNS[kind], kind, lambda m: _valid(kind, m))).otherwise(none)


def _entities(text: Column) -> Column:
    """Hashes of the protected values in a text."""

    def of(kind: str) -> Column:
        found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
        return F.transform(F.filter(found, lambda m: _valid(kind, m)), lambda m: F.xxhash64(F.lit(kind), F.lower(m)))

    return F.array_distinct(F.concat(*map(of, KINDS)))


def _terms(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), lambda t: F.xxhash64(F.lower(t))))


def _chance(texts: Column, met: Column, share: Column) -> Column:
    """Upper bound (Chernoff) of the probability that of so many texts at least met hold a term of that share by chance.

    It is share ** texts if all of them hold the term, so just share for an entity in one text.
    """
    a = met / texts
    rest = F.when(met < texts, (texts - met) * F.log((1 - share) / (1 - a))).otherwise(0.0)
    return F.when(share >= a, 1.0).otherwise(F.exp(met * F.log(share / a) + rest))


def disclosed_terms(docs: DataFrame, threshold: float = DISCLOSURE, level: float = CHANCE) -> DataFrame:
    """(h, terms): for texts by hash, the terms (hashes) that disclose an entity the text holds.

    Every entity is judged. Probabilities are shares of rows; chance counts distinct texts, so copies are no evidence. Counts of terms cover
    all documents. Entities of just one text share its terms and counts, so they are judged once a text; pairs are formed of the others, and combine before the shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(text.alias("text"))
    total = rows.count()
    held = rows.withColumn("e", _entities(F.col("text"))).where(F.size("e") > 0)
    held = held.select(F.unhex(F.md5("text")).alias("h"), "e", _terms(F.col("text")).alias("t"))
    held = stage(held.groupBy("h").agg(F.first("e").alias("e"), F.first("t").alias("t"), F.count("*").alias("m")))
    df = rows.select(F.explode(_terms(F.col("text"))).alias("t")).groupBy("t").agg(F.count("*").alias("n_t"))
    n = F.lit(float(max(total, 1)))

    def telling(pairs: DataFrame) -> DataFrame:
        pmi = F.log(F.col("n_et") * n / (F.col("n_t") * F.col("n_e")))
        far = _chance(F.col("texts_e"), F.col("texts"), F.col("n_t") / n) <= level
        return pairs.where(F.col("n_e") < n).join(df, "t").where(far & (pmi >= threshold * F.log(n / F.col("n_e"))))

    placed = held.select("h", F.explode("e").alias("e"), "m")
    entities = stage(placed.groupBy("e").agg(F.sum("m").alias("n_e"), F.count("*").alias("texts_e"), F.min("h").alias("h")))
    lone = held.join(entities.where("texts_e = 1").select("h").distinct(), "h", "left_semi")
    lone = lone.select("h", F.explode("t").alias("t"), F.col("m").alias("n_e"), F.col("m").alias("n_et"), F.lit(1).alias("texts_e"), F.lit(1).alias("texts"))
    # an entity of a third of all texts is one key: the joins on entities spread such keys
    shared = entities.where("texts_e > 1").select("e", "n_e", "texts_e", F.col("texts_e").alias("n"))
    some = spread_join(held.select("h", F.explode("e").alias("e"), "t", "m"), shared, "e", "n").select("h", "e", "n_e", "texts_e", "m", F.explode("t").alias("t"))
    pairs = some.groupBy("e", "n_e", "texts_e", "t").agg(F.sum("m").alias("n_et"), F.count("*").alias("texts"))
    told = stage(telling(pairs).select("e", "t", "texts"))
    hit = spread_join(some.select("h", "e", "t"), told, ["e", "t"], "texts")
    return telling(lone).select("h", "t").union(hit.select("h", "t")).groupBy("h").agg(F.collect_set("t").alias("terms"))


def find(docs: DataFrame, threshold: float = DISCLOSURE, level: float = CHANCE) -> DataFrame:
    """docs with email, ip, card, phone and term: arrays of (kind, start, end) in code points, end exclusive.

    Whole texts; null is the empty text. Kinds are found independently and may overlap. Equal texts have equal spans; repeated rows and null doc_ids
    stay as they are; an empty table gives an empty result. Columns with the new names are replaced.
    """
    disclosed = stage(disclosed_terms(docs, threshold, level))
    docs = docs.drop(*KINDS, "term")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.withColumns({k: base_spans(text, k) for k in KINDS}).withColumn("_docrel_h", F.unhex(F.md5(text)))
    rows = rows.join(disclosed.select(F.col("h").alias("_docrel_h"), F.col("terms").alias("_docrel_terms")), "_docrel_h", "left")
    keep = lambda m: F.array_contains(F.col("_docrel_terms"), F.xxhash64(F.lower(m)))
    term = F.when(F.col("_docrel_terms").isNull(), F.array().cast(f"array<{SPAN}>")).otherwise(_spans(text, TERM, "term", keep))
    return rows.withColumn("term", term).select(*docs.columns, *KINDS, "term")


def joined(*columns: str) -> Column:
    """kind:start:end of the spans in columns, joined by commas."""
    return F.array_join(F.transform(F.concat(*columns), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitise(found: DataFrame, remove_terms: bool = False) -> DataFrame:
    """found, as find() returns it, with text in which each span is generalised to its kind in angle brackets.

    Where spans overlap, the first by start (then the longest) stands for what it covers, and a later one for what is left. Terms are removed
    if remove_terms is set. Null texts become empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    every = F.array_sort(F.concat(*KINDS, "term"), lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        mark = F.when((s["kind"] == "term") & F.lit(remove_terms), F.lit("")).otherwise(F.concat(F.lit("<"), s["kind"], F.lit(">")))
        return F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, mark).alias("out")))

    clean = F.aggregate(every, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return found.withColumn("text", clean)
