"""Every operator as a query over the shared tables, beside equivalent DuckDB SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import patterns as P
from ..functions import products as PR
from ..functions import text as TX
from ..operators import evaluation, evidence, extract, layout, link, merge, reports, validate, window
from ..sources import catalog, readers
from ..sources import html as H
from ..store import stage
from ..streaming import incremental
from . import engine

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _t(spark: SparkSession, sf_dir: str, *names: str):
    out = [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]
    return out[0] if len(out) == 1 else out


# fixed values: letters of Western European languages in the accent-folding oracle are DuckDB's own strip_accents
_FOLD = "lower(regexp_replace(strip_accents({}), '[^\\x00-\\x7F]', '', 'g'))"
_TOKENS = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"

# ------------------------------------------------------------------ catalog and queue


@query("""
WITH o AS (SELECT o_orderkey, o_orderpriority, CASE o_orderstatus WHEN 'F' THEN 'Adjudicada' WHEN 'O' THEN 'Publicada' ELSE 'Desierta' END AS estado, o_totalprice FROM orders),
f AS (SELECT o_orderkey, estado, regexp_matches(estado, 'Desierta') AS dropped, regexp_matches(o_orderpriority, '(URGENT|HIGH|MEDIUM)') AS in_scope FROM o)
SELECT CASE WHEN dropped THEN 'estado' WHEN NOT in_scope THEN 'rubro' ELSE 'conservada' END AS reason, estado = 'Adjudicada' AND NOT dropped AS scrapeable, count(*) AS n FROM f GROUP BY ALL
""")
def catalog_filter(spark, d):
    """Funnel of a catalog: why rows go, and which of the kept have public offers."""
    state = F.when(F.col("o_orderstatus") == "F", "Adjudicada").when(F.col("o_orderstatus") == "O", "Publicada").otherwise("Desierta")
    kept, opened = PR.tender_state(F.col("estado"))
    o = _t(spark, d, "orders").withColumn("estado", state)
    reason = F.when(~kept, "estado").when(~TX.matches(F.col("o_orderpriority"), "URGENT|HIGH|MEDIUM"), "rubro").otherwise("conservada")
    return o.select(reason.alias("reason"), opened.alias("scrapeable")).groupBy("reason", "scrapeable").agg(F.count("*").alias("n"))


@query("SELECT o_custkey, min(o_orderkey) FILTER (o_totalprice > 100000) AS first_order, count(*) AS n_all, count(*) FILTER (o_totalprice > 100000) AS n_qualified FROM orders GROUP BY 1 HAVING count(*) FILTER (o_totalprice > 100000) > 0")
def first_qualifying_dedup(spark, d):
    """The first row of a key that passes the filter; counts before it and after."""
    good = F.col("o_totalprice") > 100000
    out = _t(spark, d, "orders").groupBy("o_custkey").agg(F.min(F.when(good, F.col("o_orderkey"))).alias("first_order"), F.count("*").alias("n_all"), F.count_if(good).alias("n_qualified"))
    return out.where("n_qualified > 0")


@query("SELECT CASE WHEN o_orderkey % 7 = 0 OR (o_orderkey % 7 = 4 AND year(o_orderdate) < 2000) THEN 'sin_fecha' ELSE strftime(o_orderdate, '%Y-%m') END AS mes, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS closed FROM orders GROUP BY 1")
def month_partition(spark, d):
    """Publication months of dates written in four ways; unreadable ones are sin_fecha."""
    date = F.col("o_orderdate")
    written = F.when(F.col("o_orderkey") % 7 == 0, "junk").when(F.col("o_orderkey") % 7 == 1, F.date_format(date, "dd/MM/yyyy HH:mm:ss")).when(F.col("o_orderkey") % 7 == 2, F.date_format(date, "dd/MM/yyyy")).when(F.col("o_orderkey") % 7 == 3, F.date_format(date, "yyyy-MM-dd HH:mm:ss")).when(F.col("o_orderkey") % 7 == 4, F.date_format(date, "yyyy/M")).otherwise(F.date_format(date, "yyyy-MM-dd"))
    return _t(spark, d, "orders").groupBy(N.month(written).alias("mes")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("closed"))


@query("SELECT coalesce(strftime(o_orderdate, '%Y-%m'), 'TOTAL') AS mes, count(*) AS n, CAST(round_even(sum(o_totalprice), 2) AS DOUBLE) AS total FROM orders GROUP BY ROLLUP (strftime(o_orderdate, '%Y-%m'))")
def month_rollup(spark, d):
    """Sums by month with a TOTAL row."""
    o = _t(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("m"), "o_totalprice")
    out = o.rollup("m").agg(F.count("*").alias("n"), F.bround(F.sum("o_totalprice"), 2).alias("total"), F.grouping("m").alias("g"))
    return out.select(F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("m")).alias("mes"), "n", "total")


@query("SELECT coalesce(nullif(CASE WHEN event_id % 5 = 0 THEN '' ELSE event_type END, ''), 'pendiente') AS state, count(*) AS n FROM events GROUP BY 1")
def state_histogram(spark, d):
    """Counts by state, blank as pendiente."""
    blank = F.when(F.col("event_id") % 5 == 0, "").otherwise(F.col("event_type"))
    return _t(spark, d, "events").groupBy(F.coalesce(F.nullif(blank, F.lit("")), F.lit("pendiente")).alias("state")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, coalesce(c_name, '') AS customer, coalesce(n_name, '') AS nation, coalesce(r_name, '') AS region FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def metadata_broadcast_join(spark, d):
    """Rows with their metadata, empty where there is none. Nation and region are fixed lists of 25 and 5 rows and are
    broadcast; how the customers are joined is left to their measured size."""
    o, c, n, r = _t(spark, d, "orders", "customer", "nation", "region")
    places = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")
    out = o.join(c, o.o_custkey == c.c_custkey, "left").join(F.broadcast(places), c.c_nationkey == places.n_nationkey, "left")
    return out.select("o_orderkey", *[F.coalesce(x, F.lit("")).alias(y) for x, y in (("c_name", "customer"), ("n_name", "nation"), ("r_name", "region"))])


@query("SELECT k AS nation, CASE WHEN k % 4 = 0 THEN 'user' WHEN k % 2 = 0 THEN 'month' ELSE 'global' END AS origin FROM (SELECT n_nationkey AS k FROM nation)")
def layered_metadata(spark, d):
    """Three layers of metadata of which the last that has a key wins."""
    n = _t(spark, d, "nation").select(F.col("n_nationkey").alias("nation"))
    layers = [n.where(c).withColumn("origin", F.lit(o)) for c, o in (("true", "global"), ("nation % 2 = 0", "month"), ("nation % 4 = 0", "user"))]
    return link.layered(*layers, key="nation")


@query("""
WITH old AS (SELECT o_orderkey AS k, 'hecho' AS state, o_totalprice AS amount FROM orders WHERE o_orderdate < TIMESTAMP '1995-06-01'),
new AS (SELECT o_orderkey AS k, 'pendiente' AS state, o_totalprice * 2 AS amount FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01')
SELECT coalesce(n.k, o.k) AS k, coalesce(o.state, n.state) AS state, CASE WHEN n.k IS NOT NULL THEN n.amount ELSE o.amount END AS amount FROM new n FULL JOIN old o ON n.k = o.k
""")
def queue_upsert(spark, d):
    """A new queue over an old one: states survive, other columns are new, rows that only the old one has stay."""
    o = _t(spark, d, "orders").select(F.col("o_orderkey").alias("k"), "o_totalprice", "o_orderdate")
    old = o.where("o_orderdate < '1995-06-01'").select("k", F.lit("hecho").alias("state"), F.col("o_totalprice").alias("amount"))
    new = o.where("o_orderdate >= '1995-01-01'").select("k", F.lit("pendiente").alias("state"), (F.col("o_totalprice") * 2).alias("amount"))
    return link.upsert(new, old, "k", ["state"])


@query("SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN -1.0 ELSE o_totalprice END AS amount FROM orders WHERE o_orderkey % 3 = 0 OR o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0)")
def replace_by_key(spark, d):
    """All rows of the keys that changed are replaced."""
    o = _t(spark, d, "orders").select("o_custkey", "o_orderkey", F.col("o_totalprice").alias("amount"))
    return link.replace_keys(o, o.where("o_orderkey % 3 = 0").withColumn("amount", F.lit(-1.0)), ["o_custkey"])


@query("SELECT source, count(*) AS n_missing, min(doc_id) AS first_missing FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY source")
def missing_attachments(spark, d):
    """What is expected and not there, by source."""
    docs, labels = _t(spark, d, "documents", "labels")
    return link.missing(docs.select("source", "doc_id"), labels, ["doc_id"]).groupBy("source").agg(F.count("*").alias("n_missing"), F.min("doc_id").alias("first_missing"))


@query("SELECT conv_id, max(turn) AS last, count(DISTINCT turn) AS n, max(turn) + 1 <> count(DISTINCT turn) AS gap, count(*) % 6 = 0 AS cut FROM conversations GROUP BY 1")
def contiguity_gaps(spark, d):
    """Groups whose numbers are not 0 to the largest, and ones whose count suggests that a page was cut."""
    c = _t(spark, d, "conversations")
    return c.groupBy("conv_id").agg(F.max("turn").alias("last"), F.countDistinct("turn").alias("n"), (F.max("turn") + 1 != F.countDistinct("turn")).alias("gap"), (F.count("*") % 6 == 0).alias("cut"))


@query("SELECT event_id, event_type, CASE WHEN day(ts) <= 15 THEN value END AS value, CASE WHEN day(ts) <= 15 THEN 'a' ELSE 'b' END AS part FROM events WHERE event_type <> 'error'")
def union_first_schema(spark, d):
    """A union with the first schema, by name, with a tag and without total rows."""
    e = _t(spark, d, "events")
    a = e.where("day(ts) <= 15").select("event_id", "event_type", "value", F.lit("a").alias("part"))
    b = e.where("day(ts) > 15").select(F.lit("b").alias("part"), "event_type", "event_id", "user_id")
    return a.unionByName(b, allowMissingColumns=True).select(*a.columns).where("event_type <> 'error'")


@query("SELECT o_custkey, o_orderkey, o_totalprice, r FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 3")
def top_k_per_group(spark, d):
    """The first three of each group. Spark keeps three a group before the shuffle too."""
    w = W.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return _t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", F.row_number().over(w).cast("long").alias("r")).where("r <= 3")


# ------------------------------------------------------------------ text


@query("""
WITH f AS (SELECT source, md5(text) AS h, CASE doc_id % 3 WHEN 0 THEN 'Precio' WHEN 1 THEN 'ficha' ELSE 'acta' END || CAST(doc_id AS VARCHAR) AS file, doc_id % 3 AS p FROM documents),
r AS (SELECT source, h, list(file ORDER BY p, lower(file), file) AS names FROM f GROUP BY 1, 2)
SELECT source, names[1] AS file, array_to_string(names[2:], ' ') AS duplicates FROM r
""")
def content_hash_dedup(spark, d):
    """One file a content of each supplier, the price document first; the others are named."""
    name = F.concat(F.element_at(F.array(F.lit("Precio"), F.lit("ficha"), F.lit("acta")), (F.col("doc_id") % 3 + 1).cast("int")), F.col("doc_id").cast("string"))
    files = _t(spark, d, "documents").select("source", name.alias("file"), "text")
    return engine.unique_contents(files, ["source"]).select("source", "file", F.array_join("duplicates", " ").alias("duplicates"))


@query("SELECT p_partkey, p_brand || '__' || p_type || '__' || left(sha1(concat_ws('|', p_name, CAST(p_size AS VARCHAR), '')), 8) AS id FROM part")
def content_id(spark, d):
    """Stable ids from contents."""
    return _t(spark, d, "part").select("p_partkey", TX.content_id(F.col("p_brand"), F.col("p_type"), F.col("p_name"), F.col("p_size"), F.lit(None).cast("string")).alias("id"))


@query(f"SELECT doc_id, md5({_FOLD.format('text')}) AS folded FROM documents")
def accent_fold(spark, d):
    """Lower case without accents."""
    return _t(spark, d, "documents").select("doc_id", F.md5(TX.fold(F.col("text"))).alias("folded"))


@query(f"SELECT doc_id, len(list_distinct(string_split({_TOKENS.format('text')}, ' '))) AS n_tokens, md5({_TOKENS.format('text')}) AS h, CASE WHEN len(regexp_extract_all(text, '[0-9]+')) = 1 AND len(regexp_extract(text, '[0-9]+')) < 7 THEN CAST(regexp_extract(text, '[0-9]+') AS INTEGER) END AS item FROM documents")
def token_normalise(spark, d):
    """Normalised tokens and item numbers of whole texts."""
    t = F.col("text")
    return _t(spark, d, "documents").select("doc_id", F.size(F.array_distinct(F.split(TX.tokens_text(t), " "))).cast("long").alias("n_tokens"), F.md5(TX.tokens_text(t)).alias("h"), N.item_number(t).alias("item"))


@query(r"SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '(?m)[ \t]+$', '', 'g'), ' {4,}', '   ', 'g'), '\n{3,}', E'\n\n', 'g'), '^$', ''))) AS h, len(t) AS n FROM (SELECT doc_id, regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g') AS t FROM documents)")
def control_strip_compact(spark, d):
    """Without control characters and padding."""
    t = TX.strip_control(F.col("text"))
    return _t(spark, d, "documents").select("doc_id", F.md5(TX.compact(t)).alias("h"), F.length(t).cast("long").alias("n"))


@query(r"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9][0-9.,]*')) AS raw FROM documents),
b AS (SELECT doc_id, rtrim(raw, '.,') AS x FROM w),
n AS (SELECT doc_id, CASE
  WHEN regexp_full_match(x, '[0-9]{1,3}(\.[0-9]{3})+') THEN replace(x, '.', '')
  WHEN regexp_full_match(x, '[0-9]{1,3}(\.[0-9]{3})+,[0-9]+') THEN replace(replace(x, '.', ''), ',', '.')
  WHEN regexp_full_match(x, '[0-9]{1,3}(,[0-9]{3})+') THEN replace(x, ',', '')
  WHEN contains(x, ',') AND contains(x, '.') THEN replace(x, ',', '')
  ELSE replace(x, ',', '.') END AS s FROM b),
v AS (SELECT doc_id, round_even(TRY_CAST(s AS DOUBLE), 0) AS v FROM n WHERE len(s) - len(replace(s, '.', '')) <= 1),
k AS (SELECT doc_id, count(DISTINCT v) AS n, CAST(max(v) AS BIGINT) AS largest FROM v WHERE v < 9e18 GROUP BY 1)
SELECT d.doc_id, coalesce(k.n, 0) AS n, k.largest FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id
""")
def numbers_in_text(spark, d):
    """Amounts written in each text. The SQL is written from the rule, case by case."""
    x = N.numbers_in(F.col("text"))
    return _t(spark, d, "documents").select("doc_id", F.size(x).cast("long").alias("n"), F.array_max(x).alias("largest"))


@query("SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(lower(text), '[a-z0-9]{4,}'), lambda w: regexp_matches(w, '[a-z]') AND regexp_matches(w, '[0-9]')))), ' ') AS codes FROM documents")
def model_codes(spark, d):
    """Alphanumeric codes."""
    return _t(spark, d, "documents").select("doc_id", F.array_join(F.array_sort(TX.model_codes(F.col("text"))), " ").alias("codes"))


def _re(pattern: str) -> str:
    """A fixed pattern as a literal of the oracle."""
    return "'(?i)" + pattern.replace("'", "''") + "'"


@query(f"""
WITH p AS (SELECT doc_id, source, coalesce(regexp_matches(text, {_re(P.AMOUNT)}) OR regexp_matches(text, {_re(P.EQUIPMENT + "|monitor|impresora|multifuncional|all.?in.?one")}) OR regexp_matches(text, {_re(P.TECHNICAL_IDENTITY)})
  OR len(list_distinct(list_transform(regexp_extract_all(text, {_re(P.TECHNICAL_DETAIL)}), lambda x: lower(x)))) >= 2, false) AS r FROM documents)
SELECT doc_id, source FROM (SELECT *, bool_or(r) OVER (PARTITION BY source) AS any_r FROM p) WHERE r OR NOT any_r
""")
def page_relevance_fallback(spark, d):
    """Relevant pages, or all of a source that has none."""
    return engine.relevant_or_all(_t(spark, d, "documents"), ["source"]).select("doc_id", "source")


@query("WITH w AS (SELECT doc_id, regexp_extract_all(text, '[A-Za-zÁÉÍÓÚáéíóúñÑ]+') AS w FROM documents) SELECT doc_id, len(w) >= 40 AND len(list_filter(w, lambda x: len(x) <= 2 AND lower(x) NOT IN (" + ", ".join(f"'{w}'" for w in P.SHORT_WORDS) + "))) / len(w) > 0.05 AS garbage FROM w")
def garbage_text(spark, d):
    """Pages of stray letters; the share is lower here than in production, so that both answers occur."""
    return _t(spark, d, "documents").select("doc_id", F.coalesce(PR.garbage(F.col("text"), share=0.05), F.lit(False)).alias("garbage"))


@query(r"SELECT doc_id, len(h) AS n_hints, md5(array_to_string(h, E'\n')) AS h FROM (SELECT doc_id, list_slice(list_filter(list_transform(string_split(text, E'\n'), lambda x: trim(x)), lambda x: x <> '' AND len(x) < 350 AND regexp_matches(x, '(?i)[0-9]|the')), 1, 40) AS h FROM documents)")
def line_explode_hints(spark, d):
    """The first 40 lines that look like something."""
    h = extract.hints(F.col("text"), "[0-9]|the")
    return _t(spark, d, "documents").select("doc_id", F.size(h).cast("long").alias("n_hints"), F.md5(F.array_join(h, "\n")).alias("h"))


@query(r"""
WITH RECURSIVE l AS (SELECT doc_id, text, list_filter(string_split(regexp_replace(text, '\r\n|[\n\x0B\x0C\r\x85\x{2028}\x{2029}]', chr(10), 'g'), chr(10)), lambda x: trim(x) <> '') AS whole FROM documents WHERE len(text) > 1000),
pieces AS (SELECT doc_id, flatten(list_transform(whole, lambda x: list_transform(range(0, (len(x) - 1) // 1000 + 1), lambda i: substr(x, i * 1000 + 1, 1000)))) AS p FROM l),
walk AS (
  SELECT doc_id, p, 1 AS i, 0 AS chunk, [p[1]] AS cur, len(p[1]) + 1 AS n, NULL::VARCHAR AS done FROM pieces
  UNION ALL
  SELECT doc_id, p, i + 1, CASE WHEN over_limit THEN chunk + 1 ELSE chunk END, list_append(kept, p[i + 1]), CASE WHEN over_limit THEN list_sum(list_transform(kept, lambda x: len(x) + 1)) ELSE n END + len(p[i + 1]) + 1, CASE WHEN over_limit THEN array_to_string(cur, chr(10)) END
  FROM (SELECT *, CASE WHEN over_limit THEN cur[-3:] ELSE cur END AS kept FROM (SELECT *, n + len(p[i + 1]) + 1 > 1000 AS over_limit FROM walk WHERE i < len(p)))),
parts AS (SELECT doc_id, chunk - 1 AS chunk, done AS part FROM walk WHERE done IS NOT NULL UNION ALL SELECT doc_id, chunk, array_to_string(cur, chr(10)) FROM walk WHERE i = len(p) UNION ALL SELECT doc_id, 0, text FROM documents WHERE len(text) <= 1000)
SELECT doc_id, CAST(chunk AS INTEGER) AS chunk, CAST(len(part) AS INTEGER) AS n, md5(part) AS h FROM parts
""")
def chunk_overlap(spark, d):
    """Chunks of whole lines that share three."""
    return _t(spark, d, "documents").select("doc_id", F.posexplode(extract.chunk_text(F.col("text"), 1000)).alias("chunk", "part")).select("doc_id", "chunk", F.length("part").alias("n"), F.md5("part").alias("h"))


@query("""
WITH RECURSIVE x AS (SELECT source, doc_id, len(text) + 80 AS n, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
walk AS (
  SELECT source, doc_id, i, n, 0 AS call FROM x WHERE i = 1
  UNION ALL
  SELECT x.source, x.doc_id, x.i, CASE WHEN w.n + x.n > 12000 THEN x.n ELSE w.n + x.n END, CASE WHEN w.n + x.n > 12000 THEN w.call + 1 ELSE w.call END FROM walk w JOIN x ON x.source = w.source AND x.i = w.i + 1)
SELECT source, doc_id, call FROM walk
""")
def pack_blocks(spark, d):
    """Documents of a source packed in order into calls of bounded size. A stream over sorted rows: texts do not travel."""
    docs = _t(spark, d, "documents").select("source", "doc_id", (F.coalesce(F.length("text"), F.lit(0)) + 80).alias("size"))
    return extract.pack_rows(docs, ["source"], ["doc_id"], "size", 12000)


@query("""
WITH RECURSIVE x AS (SELECT conv_id, turn, len(to_json(struct_pack(turn := turn, role := role, text := text))) + 1 AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations),
walk AS (
  SELECT conv_id, turn, i, n, 0 AS batch FROM x WHERE i = 1
  UNION ALL
  SELECT x.conv_id, x.turn, x.i, CASE WHEN w.n + x.n > 2000 THEN x.n ELSE w.n + x.n END, CASE WHEN w.n + x.n > 2000 THEN w.batch + 1 ELSE w.batch END FROM walk w JOIN x ON x.conv_id = w.conv_id AND x.i = w.i + 1)
SELECT conv_id, turn, batch FROM walk
""")
def json_batches(spark, d):
    """Records of a conversation in batches of bounded JSON size."""
    c = _t(spark, d, "conversations").select("conv_id", "turn", (F.length(F.to_json(F.struct("turn", "role", "text"))) + 1).alias("size"))
    return extract.pack_rows(c, ["conv_id"], ["turn"], "size", 2000).withColumnRenamed("call", "batch")


@query(r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, E'\n')) AS line, generate_subscripts(string_split(text, E'\n'), 1) AS i FROM documents),
b AS (SELECT item_id, unnest(string_split(text, E'\n')) AS line FROM benchmark),
k AS (SELECT DISTINCT item_id, trim(line) AS line FROM b WHERE len(trim(line)) >= 40),
x AS (SELECT *, concat_ws(' ', lag(line) OVER w, line, lead(line) OVER w) AS near FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY i))
SELECT doc_id, i, item_id, md5(near) AS near FROM x JOIN k ON trim(x.line) = k.line
""")
def passage_occurrence(spark, d):
    """Lines of benchmark items in documents, with the lines around. An equality join on whole lines."""
    docs, bench = _t(spark, d, "documents", "benchmark")
    rows = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "line"))
    w = W.partitionBy("doc_id").orderBy("p")
    rows = rows.withColumn("near", F.md5(F.concat_ws(" ", F.lag("line").over(w), "line", F.lead("line").over(w))))
    keys = bench.select("item_id", F.explode(F.split("text", "\n")).alias("line")).select("item_id", F.trim("line").alias("k")).where(F.length("k") >= 40).distinct()
    return rows.join(keys, F.trim("line") == F.col("k")).select("doc_id", (F.col("p") + 1).cast("long").alias("i"), "item_id", "near")


@query(f"""
WITH b AS (SELECT item_id, list_distinct(list_filter(string_split({_TOKENS.format('text')}, ' '), lambda x: len(x) >= 6)) AS t FROM benchmark),
p AS (SELECT p_partkey, list_distinct(list_filter(string_split({_TOKENS.format("text")}, ' '), lambda x: len(x) >= 6)) AS t, doc_id FROM (SELECT doc_id AS p_partkey, * FROM documents)),
c AS (SELECT DISTINCT b.item_id, p.doc_id FROM (SELECT item_id, unnest(t) AS k FROM b) b JOIN (SELECT doc_id, unnest(t) AS k FROM p) p USING (k)),
s AS (SELECT item_id, doc_id, len(list_intersect(b.t, p.t)) AS common, len(list_intersect(b.t, p.t)) / least(len(b.t), len(p.t)) AS likeness FROM c JOIN b USING (item_id) JOIN p USING (doc_id))
SELECT item_id, doc_id, common, round_even(likeness, 4) AS likeness FROM s WHERE likeness >= 0.5 AND common >= 3
""")
def fuzzy_overlap_join(spark, d):
    """Pairs of items and documents that share half of the smaller token set, and three tokens."""
    docs, bench = _t(spark, d, "documents", "benchmark")
    sets = lambda t, k: t.select(F.col(k).alias("id"), TX.tokens(F.col("text"), 6).alias("t"))
    out = link.overlapping(sets(bench, "item_id"), sets(docs, "doc_id"), 0.5, 3)
    return out.select(F.col("a_id").alias("item_id"), F.col("b_id").alias("doc_id"), "common", F.bround("likeness", 4).alias("likeness"))


@query("SELECT conv_id, turn, md5(concat_ws(' ', lag(text) OVER w, text, lead(text) OVER w)) AS near FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def neighbour_lines(spark, d):
    """Each turn with the ones around it."""
    w = W.partitionBy("conv_id").orderBy("turn")
    return _t(spark, d, "conversations").select("conv_id", "turn", F.md5(F.concat_ws(" ", F.lag("text").over(w), "text", F.lead("text").over(w))).alias("near"))


# ------------------------------------------------------------------ rows and figures


# documents of offers, written from the shared tables: a price list an order, with an aggregate row in a second file
_LINES = """lines AS (SELECT CAST(l_orderkey AS VARCHAR) AS tender, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS n, CAST(l_quantity AS INTEGER) AS q, 20000 + (l_partkey % 400) * 1250 AS u,
  'Notebook ' || p_name || ' X' || CAST(l_partkey AS VARCHAR) AS description FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """tender, n, q, u, description: the lines of _LINES."""
    li, p = _t(spark, d, "lineitem", "part")
    x = li.join(p.select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey")
    n = F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"))
    return x.select(F.col("l_orderkey").cast("string").alias("tender"), n.alias("n"), F.col("l_quantity").cast("int").alias("q"), (20000 + F.col("l_partkey") % 400 * 1250).cast("double").alias("u"), F.concat(F.lit("Notebook "), "p_name", F.lit(" X"), F.col("l_partkey").cast("string")).alias("description"))


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    """Price documents of the orders' lines, and a second file with one aggregate row."""
    return _documents(_lines(spark, d))


def _documents(x: DataFrame) -> DataFrame:
    row = F.concat(F.lit("FILA "), F.col("n").cast("string"), F.lit(": "), F.col("q").cast("string"), F.lit(" || "), "description", F.lit(" || "), N.thousands(F.col("u")), F.lit(" || "), N.thousands(F.col("u") * F.col("q")))
    each = x.groupBy("tender").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", row.alias("r")))), lambda v: v["r"]), "\n").alias("text"), F.sum("q").alias("q"), F.sum(F.col("u") * F.col("q")).alias("t"))
    vat = F.when(F.col("tender").cast("long") % 2 == 0, "valores con IVA\n").otherwise("")
    whole = F.concat(vat, F.lit("FILA 1: "), F.col("q").cast("string"), F.lit(" MONITORES || $ "), N.thousands(F.col("t")))
    files = F.array(F.struct(F.lit("economico__01.xlsx").alias("file"), F.col("text")), F.struct(F.lit("economico__02.csv").alias("file"), whole.alias("text")))
    return each.select("tender", F.lit("s1").alias("supplier"), F.explode(files).alias("f")).select("tender", "supplier", "f.file", F.lit(1).alias("page"), "f.text")


def _flow(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The blocks and the products of the whole flow."""
    lines = stage(_lines(spark, d))
    offers = stage(lines.groupBy("tender").agg(F.sum(F.col("u") * F.col("q")).alias("offer_total")).select("tender", F.lit("s1").alias("supplier"), "offer_total"))
    blocks = stage(_documents(lines))
    return blocks, engine.run(blocks, offers, ["tender", "supplier"])


@query(f"WITH {_LINES} SELECT tender, n - 1 AS line_no, description, CAST(q AS DOUBLE) AS quantity, CAST(u AS DOUBLE) AS unit, CAST(q * u AS DOUBLE) AS total, 'table' AS method FROM lines")
def verified_triples(spark, d):
    """Price rows whose figures can be checked, from price documents."""
    return extract.price_rows(_blocks(spark, d)).select("tender", F.col("line_no").cast("long").alias("line_no"), "description", "quantity", "unit", "total", "method")


@query(f"WITH {_LINES} SELECT tender, CASE WHEN CAST(tender AS BIGINT) % 2 = 0 THEN 1 ELSE 0 END AS line_no, 'MONITORES' AS kind, CAST(sum(q) AS INTEGER) AS quantity, CAST(sum(q * u) AS DOUBLE) AS total, CAST(tender AS BIGINT) % 2 = 0 AS vat FROM lines GROUP BY tender HAVING sum(q * u) >= 50000 UNION ALL SELECT tender, n - 1, description, q, CAST(q * u AS DOUBLE), false FROM lines WHERE u < 50000 AND q * u >= 50000")
def aggregate_rows(spark, d):
    """Rows of a count, a kind and one amount."""
    return extract.aggregate_rows(_blocks(spark, d)).select("tender", F.col("line_no").cast("long").alias("line_no"), "kind", "quantity", "total", "vat")


@query()
def extraction_flow(spark, d):
    """The whole flow over the price documents of all orders, with the rules as provider."""
    _, out = _flow(spark, d)
    return out.select("tender", "seq", "product", "brand", "type", "quantity", "unit", "total", F.array_join("sources", " ").alias("sources"), F.array_join("flags", " ").alias("flags"), F.array_join("alerts", " ").alias("alerts"), "state")


@query("""
WITH s AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || CAST(l_partkey * CAST(l_quantity AS INTEGER) AS VARCHAR) AS s FROM lineitem),
c AS (SELECT s, i, j, left(s, i) AS a, substr(s, i + 1, j - i) AS b, substr(s, j + 1) AS t FROM s, unnest(range(1, len(s) - 1)) AS u(i), unnest(range(i + 1, len(s))) AS v(j)),
n AS (SELECT s, CAST(a AS HUGEINT) AS a, CAST(b AS HUGEINT) AS b, CAST(t AS HUGEINT) AS t FROM c WHERE NOT (starts_with(a, '0') OR starts_with(b, '0') OR starts_with(t, '0'))),
w AS (SELECT s, b AS q, a AS u, t FROM n UNION SELECT s, a, b, t FROM n),
g AS (SELECT DISTINCT s, q, u, t FROM w WHERE q BETWEEN 1 AND 20000 AND u >= 1000 AND t >= u AND abs(q * u - t) < q)
SELECT s AS digits, count(q) AS ways, CASE WHEN count(q) = 1 THEN CAST(min(q) AS BIGINT) END AS quantity FROM s LEFT JOIN g USING (s) GROUP BY s
""")
def digit_partition(spark, d):
    """Strings of digits cut into unit, quantity and total."""
    s = _t(spark, d, "lineitem").select(F.concat(F.col("l_partkey").cast("string"), F.col("l_quantity").cast("int").cast("string"), (F.col("l_partkey") * F.col("l_quantity").cast("int")).cast("string")).alias("digits")).distinct()
    s = s.withColumn("r", extract.digit_partitions(F.col("digits")))
    return s.select("digits", F.size("r").cast("long").alias("ways"), F.when(F.size("r") == 1, F.col("r")[0]["quantity"]).alias("quantity"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, abs(l_quantity * p_retailprice - l_extendedprice) <= greatest(2.0, abs(l_extendedprice) * 0.001) AS coherent, abs(l_quantity * p_retailprice - l_extendedprice) > greatest(2.0, abs(l_extendedprice) * 0.01) AS mismatch FROM lineitem JOIN part ON l_partkey = p_partkey")
def line_coherence(spark, d):
    """Whether quantity times unit price is the total."""
    li, p = _t(spark, d, "lineitem", "part")
    q, u, t = F.col("l_quantity"), F.col("p_retailprice"), F.col("l_extendedprice")
    return li.join(p, li.l_partkey == p.p_partkey).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", N.coherent(q, u, t).alias("coherent"), (F.abs(q * u - t) > F.greatest(F.lit(2.0), F.abs(t) * 0.01)).alias("mismatch"))


@query("""
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS q, 1000.0 + l_partkey AS u, l_quantity * (1000.0 + l_partkey) * CASE WHEN l_linenumber % 2 = 0 THEN 1.19 ELSE 1 END AS t FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, q, CASE WHEN abs(t - q * u * 1.19) <= greatest(3.0, q * u * 0.004) AND abs(t - q * u) > greatest(2.0, q * u * 0.01) THEN round_even(q * u, 0) ELSE t END AS net FROM x
""")
def vat_net(spark, d):
    """Totals with VAT become net."""
    x = _t(spark, d, "lineitem").withColumn("u", 1000.0 + F.col("l_partkey"))
    x = x.withColumn("t", F.col("l_quantity") * F.col("u") * F.when(F.col("l_linenumber") % 2 == 0, 1.19).otherwise(1.0))
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").alias("q"), N.net_of_vat(F.col("l_quantity"), F.col("u"), F.col("t")).alias("net"))


@query("""
WITH x AS (SELECT l_orderkey AS tender, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS seq, l_suppkey % 2 AS c, (l_orderkey % 50 + 1) * 1000 AS base, l_linenumber % 2 = 0 AS gross FROM lineitem),
s AS (SELECT *, bool_or(NOT gross) OVER (PARTITION BY tender, c) AS net_too FROM x)
SELECT tender, seq, CASE WHEN gross THEN base * 1.19::DOUBLE ELSE base END AS unit, len(CASE WHEN gross THEN [] ELSE coalesce((SELECT list(DISTINCT o.seq) FROM s o WHERE o.tender = s.tender AND o.c = s.c AND o.gross AND s.seq = (SELECT min(z.seq) FROM s z WHERE z.tender = s.tender AND z.c = s.c AND NOT z.gross)), []) END) AS copies FROM s WHERE NOT (gross AND net_too)
""")
def vat_duplicates(spark, d):
    """Of lines of an order that differ by VAT the dearer go; the files of the copies back the first of the others."""
    n = F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"))
    base = ((F.col("l_orderkey") % 50 + 1) * 1000).cast("double")
    x = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("tender"), n.alias("seq"), (F.col("l_suppkey") % 2).cast("string").alias("category"), F.lit(None).cast("double").alias("quantity"), F.when(F.col("l_linenumber") % 2 == 0, base * 1.19).otherwise(base).alias("unit"), F.lit(None).cast("string").alias("brand"), F.array().cast("array<string>").alias("flags"))
    x = x.withColumns({"file": F.col("seq").cast("string"), "sources": F.array().cast("array<string>")})
    out = merge.by_group(x, ["tender"], ["seq"], merge.drop_vat_copies)
    return out.select("tender", F.col("seq").cast("long").alias("seq"), "unit", F.size("sources").cast("long").alias("copies"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_size = CAST(l.l_quantity AS INTEGER) AND abs(p.p_retailprice - l.l_extendedprice / l.l_quantity) <= 1.0)")
def theta_anti_unrepresented(spark, d):
    """Lines that no part represents by quantity and by unit price within 1."""
    li, p = _t(spark, d, "lineitem", "part")
    rows = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit"), F.col("l_quantity").cast("int").alias("size"), F.lit(0.0).alias("quantity"))
    parts = p.select(F.col("p_size").alias("size"), F.col("p_retailprice").alias("unit"), F.lit(None).cast("double").alias("quantity"))
    return link.unrepresented(rows, parts, ["size"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("SELECT n_nationkey, s_suppkey, c_custkey FROM nation JOIN (SELECT s_nationkey, min(s_suppkey) AS s_suppkey FROM supplier WHERE s_acctbal > 5000 GROUP BY 1 HAVING count(*) = 1) ON n_nationkey = s_nationkey JOIN (SELECT c_nationkey, min(c_custkey) AS c_custkey FROM customer WHERE c_acctbal > 9800 GROUP BY 1 HAVING count(*) = 1) ON n_nationkey = c_nationkey")
def one_to_one_guarded(spark, d):
    """Joined only where both sides have exactly one candidate."""
    s, c = _t(spark, d, "supplier", "customer")
    a = s.where("s_acctbal > 5000").select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey")
    return link.one_to_one(a, c.where("c_acctbal > 9800").select(F.col("c_nationkey").alias("n_nationkey"), "c_custkey"), ["n_nationkey"])


@query("SELECT p_type, p_size, min(p_brand) AS p_brand FROM part GROUP BY 1, 2 HAVING count(DISTINCT p_brand) = 1")
def unique_value_by_type(spark, d):
    """The brand of a type, if it is the only one."""
    return link.unique_value(_t(spark, d, "part"), ["p_type", "p_size"], "p_brand")


@query("SELECT p_partkey, p_type FROM (SELECT *, round_even(p_retailprice, 0) AS u FROM part) a WHERE EXISTS (SELECT 1 FROM part b WHERE b.p_brand = a.p_brand AND round_even(b.p_retailprice, 0) = a.u AND b.p_type <> a.p_type)")
def same_price_other_category(spark, d):
    """Products of a brand whose price another type has too."""
    p = _t(spark, d, "part").select("p_partkey", "p_brand", F.col("p_type").alias("category"), F.bround("p_retailprice", 0).alias("unit"))
    return link.same_price_elsewhere(p, ["p_brand"], 0).select("p_partkey", F.col("category").alias("p_type"))


@query("""
WITH l AS (SELECT l_orderkey AS k, l_suppkey % 3 AS g, l_partkey AS p, l_linenumber AS i, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS s, l_quantity AS quantity, l_extendedprice AS total FROM lineitem)
SELECT a.k, a.s AS a_s, b.s AS b_s, abs(a.quantity - b.quantity) > greatest(1.0, abs(b.quantity) * 0.01) AS c_quantity, abs(a.total - b.total) > greatest(1.0, abs(b.total) * 0.01) AS c_total
FROM l a JOIN l b ON a.k = b.k AND a.g = b.g WHERE a.s < b.s AND (abs(a.quantity - b.quantity) > greatest(1.0, abs(b.quantity) * 0.01) OR abs(a.total - b.total) > greatest(1.0, abs(b.total) * 0.01))
""")
def field_conflicts(spark, d):
    """Fields on which two lines of one identity disagree."""
    order = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    x = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_suppkey") % 3).alias("g"), F.row_number().over(order).alias("s"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("total"))
    a, b = (x.select("k", "g", *[F.col(c).alias(s + c) for c in ("s", "quantity", "total")]) for s in ("a_", "b_"))
    out = link.conflicts(a.join(b, ["k", "g"]).where("a_s < b_s"), ["quantity", "total"]).where(F.size("conflicts") > 0)
    return out.select("k", F.col("a_s").cast("long").alias("a_s"), F.col("b_s").cast("long").alias("b_s"), *[F.array_contains("conflicts", c).alias("c_" + c) for c in ("quantity", "total")])


# ------------------------------------------------------------------ validation and reports


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_extendedprice * (1 - l_discount) AS net, o_totalprice, sum(l_extendedprice * (1 - l_discount)) OVER (PARTITION BY l_orderkey) AS s, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
a AS (SELECT *, o_totalprice >= 50000 AND s > o_totalprice * 1.02 AS over_total, net < 2000 AS low, net > o_totalprice * 1.02 AS line_over FROM l)
SELECT l_orderkey, CASE WHEN bool_or(over_total) OR bool_or(low) OR bool_or(line_over) THEN 'inconsistente' ELSE 'ok' END AS state, count(*) AS lines, count(*) FILTER (over_total) AS over_lines, count(*) FILTER (low) AS low_lines, round_even(sum(net), 4) AS net FROM a GROUP BY 1
""")
def sum_exceeds_total(spark, d):
    """Which orders' lines are plausible and sum to no more than the order's total: alerts by line, a state by order. Lines join
    orders on the order's key, and the window and the aggregation reuse that partitioning: one shuffle a side."""
    li, o = _t(spark, d, "lineitem", "orders")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    x = li.select("l_orderkey", net.alias("net")).join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice"), "l_orderkey")
    x = x.withColumn("s", F.sum("net").over(W.partitionBy("l_orderkey")))
    offer = validate.credible_total(F.col("o_totalprice"))
    rules = [(F.col("s") > offer * 1.02, "suma_productos_supera_total_oferta"), (F.col("net") < 2000, "precio_unitario_fuera_de_rango"), (F.col("net") > F.col("o_totalprice") * 1.02, "precio_unitario_supera_total_oferta")]
    x = x.withColumn("alerts", F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in rules]))).withColumn("state", validate.state(F.col("alerts")))
    return x.groupBy("l_orderkey").agg(
        F.when(F.max(F.col("state") == "inconsistente"), "inconsistente").otherwise("ok").alias("state"), F.count("*").alias("lines"),
        F.count_if(F.array_contains("alerts", rules[0][1])).alias("over_lines"), F.count_if(F.array_contains("alerts", rules[1][1])).alias("low_lines"), F.bround(F.sum("net"), 4).alias("net"),
    )


@query("""
WITH p AS (SELECT p_partkey, p_retailprice * p_retailprice * (p_size - 2) / 4 AS u, CASE p_partkey % 6 WHEN 0 THEN 'all-in-one' WHEN 1 THEN 'notebook' WHEN 2 THEN 'desktop' WHEN 3 THEN 'monitor' WHEN 4 THEN 'impresora' ELSE 'workstation' END AS t FROM part)
SELECT p_partkey, u > 0 AND (u < 20000 OR u > CASE t WHEN 'all-in-one' THEN 6000000 WHEN 'notebook' THEN 8000000 WHEN 'desktop' THEN 9000000 WHEN 'monitor' THEN 3500000 WHEN 'impresora' THEN 9000000 ELSE 20000000 END) AS out_of_range FROM p
""")
def price_range_by_type(spark, d):
    """Unit prices that no product of their type has."""
    kind = F.element_at(F.array(*map(F.lit, ["all-in-one", "notebook", "desktop", "monitor", "impresora", "workstation"])), (F.col("p_partkey") % 6 + 1).cast("int"))
    unit = F.col("p_retailprice") * F.col("p_retailprice") * (F.col("p_size") - 2) / 4
    return _t(spark, d, "part").select("p_partkey", validate.out_of_range(unit, kind).alias("out_of_range"))


def _products(spark: SparkSession, d: str) -> DataFrame:
    """Lines as products of an offer."""
    li, p = _t(spark, d, "lineitem", "part")
    x = li.join(p.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_type", "p_size"), "l_partkey")
    seq = F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    none = F.lit(None).cast("string")
    return x.select(
        F.col("l_orderkey").cast("string").alias("tender"), F.lit("s").alias("supplier"), seq.alias("seq"), none.alias("item"), F.concat_ws(" ", "p_type", F.col("p_size") % 5).alias("product"), F.when(F.col("l_linenumber") % 2 == 0, F.col("p_brand")).alias("brand"),
        none.alias("model"), F.lit("equipo").alias("category"), F.lit("notebook").alias("type"), F.when(F.col("l_linenumber") % 3 > 0, F.bround(F.col("l_quantity") / 10) * 10).alias("quantity"), (F.bround(F.col("l_extendedprice") / 20000) * 20000).alias("unit"), F.lit(None).cast("double").alias("total"),
        F.lit("linea").alias("total_kind"), F.lit("CLP").alias("currency"), F.lit("alta").alias("confidence"), F.concat(F.lit("f"), F.col("l_suppkey") % 3).alias("file"), F.concat(F.lit("f"), F.col("l_suppkey") % 3).alias("price_file"), F.lit(1).alias("page"), F.array().cast("array<string>").alias("sources"),
    )


@query()
def greedy_dedup_merge(spark, d):
    """Ordered merges of the products of an order."""
    return merge.by_group(_products(spark, d), ["tender"], ["seq"], merge.merge_equivalent)


@query()
def greedy_vat_and_generic(spark, d):
    """VAT copies and generic lines of an order."""
    x = merge.by_group(_products(spark, d), ["tender"], ["seq"], merge.drop_vat_copies)
    return merge.by_group(x, ["tender"], ["seq"], merge.merge_generic)


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_linenumber WHEN 1 THEN 'Notebooks' WHEN 2 THEN 'Linea 2 de monitores' WHEN 3 THEN 'All-in-One' ELSE 'Notebook X' || CAST(l_partkey AS VARCHAR) END AS product, l_extendedprice AS total,
  CASE WHEN l_linenumber = 1 THEN l_extendedprice WHEN l_linenumber = 2 THEN l_extendedprice / 1.19 ELSE o_totalprice END AS wanted, count(*) OVER (PARTITION BY l_orderkey) AS n, max(CASE WHEN l_linenumber <= 2 THEN l_extendedprice * CASE l_linenumber WHEN 1 THEN 1 ELSE 1.19 END END) OVER (PARTITION BY l_orderkey) AS offer
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM l
WHERE NOT coalesce(n >= 3 AND total > 0 AND product NOT LIKE 'Notebook X%' AND offer >= 50000 AND (abs(total - offer) <= offer * 0.005 OR abs(total - offer / 1.19) <= offer / 1.19 * 0.005), false)
""")
def generic_line_drop(spark, d):
    """Summary lines go where an offer has three lines or more."""
    li, o = _t(spark, d, "lineitem", "orders")
    x = li.join(o.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
    near = F.when(F.col("l_linenumber") == 1, F.col("l_extendedprice")).when(F.col("l_linenumber") == 2, F.col("l_extendedprice") * 1.19)
    name = F.when(F.col("l_linenumber") == 1, "Notebooks").when(F.col("l_linenumber") == 2, "Linea 2 de monitores").when(F.col("l_linenumber") == 3, "All-in-One").otherwise(F.concat(F.lit("Notebook X"), F.col("l_partkey").cast("string")))
    x = x.withColumns({"product": name, "total": F.col("l_extendedprice"), "offer_total": F.max(near).over(W.partitionBy("l_orderkey"))})
    return validate.drop_summary_lines(x, ["l_orderkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(f"""
WITH {_LINES},
p AS (SELECT tender, n, q, u, q * u AS t, n % 2 = 1 AS written, CASE n % 3 WHEN 0 THEN 'HP' WHEN 1 THEN 'Dell' END AS brand FROM lines),
seen AS (SELECT tender, list(DISTINCT v) AS v, bool_or(brand = 'HP') AS hp, bool_or(brand = 'Dell') AS dell FROM (SELECT tender, brand, unnest([u, t]) AS v FROM p WHERE written) GROUP BY 1),
m AS (SELECT p.*, s.v IS NOT NULL AS legible, coalesce(list_contains(s.v, u), false) AS su, coalesce(list_contains(s.v, t), false) AS st, CASE brand WHEN 'HP' THEN hp WHEN 'Dell' THEN dell ELSE true END AS sb FROM p LEFT JOIN seen s USING (tender)),
l AS (SELECT CAST(CAST(tender AS BIGINT) % 7 AS VARCHAR) AS tender, CASE WHEN NOT legible THEN 'no_verificable' WHEN (su OR st) AND coalesce(sb, false) THEN 'verificado' ELSE 'revisar' END AS level FROM m)
SELECT coalesce(tender, 'TOTAL') AS tender, count(*) AS products, count(*) FILTER (level = 'verificado') AS verificado, count(*) FILTER (level = 'revisar') AS revisar, count(*) FILTER (level = 'no_verificable') AS no_verificable, round_even(count(*) FILTER (level = 'verificado') / count(*), 3) AS ratio FROM l GROUP BY ROLLUP (tender)
""")
def audit_rollup(spark, d):
    """Audit of the lines of all orders, every second of which documents show: levels by group, with a TOTAL row."""
    x = _lines(spark, d).withColumn("supplier", F.col("tender")).withColumn("tender", (F.col("supplier").cast("long") % 7).cast("string"))
    brand = F.when(F.col("n") % 3 == 0, "HP").when(F.col("n") % 3 == 1, "Dell")
    x = x.withColumns({"total": F.col("u") * F.col("q"), "brand": brand})
    key = ["tender", "supplier"]
    row = F.concat_ws(" ", F.lit("equipo"), "brand", F.concat(F.lit("$"), N.thousands(F.col("u"))), N.thousands(F.col("total")))
    blocks = x.where("n % 2 = 1").groupBy(*key).agg(F.array_join(F.collect_list(row), "\n").alias("text")).withColumns({"file": F.lit("economico.pdf"), "page": F.lit(1)})
    products = x.select(*key, F.col("n").alias("seq"), F.lit("equipo").alias("product"), "brand", F.col("q").cast("double").alias("quantity"), F.col("u").alias("unit"), "total", F.lit("ok").alias("state"))
    return evidence.audit_summary(evidence.audit(products, blocks, key))


@query("""
WITH p AS (SELECT p_partkey AS k, p_partkey % 2 = 0 AS no_brand, p_partkey % 3 = 0 AS no_price, p_partkey % 5 = 0 AS no_quantity, p_partkey % 4 AS shown, CASE p_partkey % 7 WHEN 0 THEN 'inconsistente' WHEN 1 THEN 'revisar' ELSE 'ok' END AS state FROM part),
m AS (SELECT *, CASE WHEN no_price THEN CASE WHEN shown = 1 THEN 'f' ELSE 'x' END END AS a, CASE WHEN no_brand THEN CASE WHEN shown = 2 THEN 'f' ELSE 'x' END END AS b, CASE WHEN no_price AND no_quantity THEN CASE WHEN shown = 3 THEN 'f' ELSE 'x' END END AS c FROM p)
SELECT k, CASE WHEN a = 'f' OR b = 'f' OR c = 'f' THEN 'NO_ENCONTRADO' WHEN (a = 'x' OR b = 'x' OR c = 'x') AND k % 11 = 0 THEN 'PENDIENTE_OCR' WHEN a = 'x' OR b = 'x' OR c = 'x' THEN 'DATO_NO_EXISTE' WHEN state = 'inconsistente' THEN 'DATOS_CONTRADICTORIOS' WHEN state = 'ok' THEN 'COMPLETO' ELSE 'REVISAR' END AS verdict FROM m
""")
def coverage_verdict(spark, d):
    """What products lack and whether a document of theirs has it: the worst decides; without anything missing, the state does."""
    p = _t(spark, d, "part").select(F.col("p_partkey").alias("k"))
    x = p.select(F.lit("t").alias("tender"), F.col("k").cast("string").alias("supplier"), F.lit(1).alias("seq"), "k")
    shown = F.when(F.col("k") % 4 == 1, " $ 1.250.000").when(F.col("k") % 4 == 2, " Lenovo").when(F.col("k") % 4 == 3, " cantidad dos").otherwise("")
    code = F.concat(F.lit("MX"), F.col("k").cast("string"), F.lit("Z9"))
    blocks = x.select("tender", "supplier", F.lit("economico.pdf").alias("file"), F.lit(1).alias("page"), F.concat(F.lit("equipo "), code, shown).alias("text"))
    priced = F.when(F.col("k") % 3 != 0, 100000.0)
    state = F.when(F.col("k") % 7 == 0, "inconsistente").when(F.col("k") % 7 == 1, "revisar").otherwise("ok")
    products = x.withColumns({"product": F.lit("equipo"), "model": code, "brand": F.when(F.col("k") % 2 != 0, "HP"), "unit": priced, "total": priced, "quantity": F.when(F.col("k") % 5 != 0, 1.0), "state": state})
    pending = x.where("k % 11 = 0").select("tender", "supplier")
    return evidence.coverage(products, blocks, pending, ["tender", "supplier"]).select("k", "verdict")


@query("""
WITH x AS (SELECT quality = 1 AS gold, len(text) > 400 AS pred FROM labels JOIN documents USING (doc_id)),
s AS (SELECT count(*) AS n, count(*) FILTER (gold) AS g, count(*) FILTER (pred) AS p, count(*) FILTER (gold AND pred) AS tp FROM x),
r AS (SELECT *, tp / g AS recall, tp / p AS precision FROM s)
SELECT n, round_even(recall, 3) AS recall, round_even(precision, 3) AS precision, round_even((recall + 1.96 * 1.96 / (2 * g) - 1.96 * sqrt(recall * (1 - recall) / g + 1.96 * 1.96 / (4.0 * g * g))) / (1 + 1.96 * 1.96 / g), 4) AS low, round_even((recall + 1.96 * 1.96 / (2 * g) + 1.96 * sqrt(recall * (1 - recall) / g + 1.96 * 1.96 / (4.0 * g * g))) / (1 + 1.96 * 1.96 / g), 4) AS high FROM r
""")
def evaluation_metrics(spark, d):
    """Recall, precision and a Wilson interval of a prediction against marks."""
    docs, labels = _t(spark, d, "documents", "labels")
    x = labels.join(docs, "doc_id").select((F.col("quality") == 1).alias("gold"), (F.length("text") > 400).alias("pred"))
    s = x.agg(F.count("*").alias("n"), F.count_if("gold").alias("g"), F.count_if("pred").alias("p"), F.count_if(F.col("gold") & F.col("pred")).alias("tp"))
    r, g, z = F.col("tp") / F.col("g"), F.col("g"), 1.96
    mid, half = r + z * z / (2 * g), z * F.sqrt(r * (1 - r) / g + z * z / (4.0 * g * g))
    return s.select("n", F.bround(r, 3).alias("recall"), F.bround(F.col("tp") / F.col("p"), 3).alias("precision"), F.bround((mid - half) / (1 + z * z / g), 4).alias("low"), F.bround((mid + half) / (1 + z * z / g), 4).alias("high"))


@query()
def greedy_gold_match(spark, d):
    """Marked lines and found lines of an order matched one to one, in order."""
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.bround(F.col("l_extendedprice") / 5000).alias("unit"), (F.bround(F.col("l_quantity") / 10)).alias("quantity"), "l_partkey")

    def match(rows: list[dict]) -> list[dict]:
        gold, found = [r for r in rows if r["l_linenumber"] % 2], [r for r in rows if not r["l_linenumber"] % 2]
        pairs = merge.match_gold(gold, found)
        return [{"l_orderkey": rows[0]["l_orderkey"], "gold": len(gold), "found": len(found), "matched": sum(p is not None for _, p in pairs)}]

    return merge.by_group(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "unit", "quantity"], match, "l_orderkey long, gold long, found long, matched long")


@query(f"""
WITH p AS (SELECT p_partkey AS id, p_brand, CASE WHEN p_partkey % 3 > 0 THEN 'mk' || CAST(p_size AS VARCHAR) END AS m, list_filter(list_distinct(string_split({_TOKENS.format('p_name')}, ' ')), lambda x: len(x) >= 3) AS t FROM part)
SELECT a.id AS a_id, b.id AS b_id, CASE WHEN a.m IS NOT NULL AND b.m IS NOT NULL AND a.m <> b.m THEN 'descripcion_no_coincide' WHEN a.m IS NOT NULL AND b.m IS NULL THEN 'parcial' WHEN a.m = b.m THEN 'exacto' WHEN len(a.t) > 0 AND len(list_intersect(a.t, b.t)) = 0 THEN 'parcial' ELSE 'exacto' END AS verdict
FROM p a JOIN p b ON a.p_brand = b.p_brand AND a.id < b.id AND a.id % 5 = b.id % 5
""")
def identity_verdict(spark, d):
    """How far one part's text names another of its brand and of its row of five."""
    p = _t(spark, d, "part").select("p_partkey", "p_brand", "p_name", F.when(F.col("p_partkey") % 3 > 0, F.concat(F.lit("mk"), F.col("p_size").cast("string"))).alias("m"), (F.col("p_partkey") % 5).alias("g"))
    # facts of each side before the join; a fixed number of parts, as pairs are many more than the rows by which Spark would merge parts
    a = p.select("p_brand", "g", F.col("p_partkey").alias("a_id"), evidence.product_facts(F.col("p_name"), F.col("m")).alias("a"))
    b = p.select("p_brand", "g", F.col("p_partkey").alias("b_id"), evidence.text_facts(F.concat_ws(" ", "p_name", "m")).alias("b"))
    both = a.repartition(96, "p_brand", "g").join(b.repartition(96, "p_brand", "g").hint("merge"), ["p_brand", "g"]).where("a_id < b_id")
    return both.select("a_id", "b_id", evidence.identity_of(F.col("a"), F.col("b")).alias("verdict"))


@query("""
WITH p AS (SELECT l_orderkey AS tender, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS seq, CAST(l_partkey AS VARCHAR) AS product, CASE WHEN l_linenumber % 2 = 0 THEN 'HP' END AS brand, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity, CASE WHEN l_linenumber % 3 > 0 THEN CAST(l_suppkey AS VARCHAR) END AS unit, 'a' AS f, CASE WHEN l_linenumber % 5 = 0 THEN 'a' ELSE 'b' END AS pf FROM lineitem),
x AS (SELECT tender, seq, f <> pf AS mixed, unnest([{'field': 'product', 'value': product, 'file': f}, {'field': 'brand', 'value': brand, 'file': f}, {'field': 'quantity', 'value': quantity, 'file': pf}, {'field': 'unit', 'value': unit, 'file': pf}]) AS v FROM p)
SELECT tender, seq, mixed, v.field AS field, v.value AS value, v.file AS file FROM x WHERE v.value IS NOT NULL
""")
def lineage_explode(spark, d):
    """One row a field of a product with the file it comes from."""
    n = F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"))
    x = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("tender"), n.cast("long").alias("seq"), F.col("l_partkey").cast("string").alias("product"), F.when(F.col("l_linenumber") % 2 == 0, "HP").alias("brand"), F.col("l_quantity").cast("long").alias("quantity"), F.when(F.col("l_linenumber") % 3 > 0, F.col("l_suppkey")).alias("unit"), F.lit(None).cast("double").alias("total"), F.lit("a").alias("file"), F.when(F.col("l_linenumber") % 5 == 0, "a").otherwise("b").alias("price_file"))
    return evidence.lineage(x, ["tender"])


# ------------------------------------------------------------------ documents, JSON, state


@query(r"""SELECT page_id, len(l) AS n_links, md5(array_to_string(list_sort(l), ' ')) AS links FROM (SELECT page_id, list_distinct(regexp_extract_all(html, '(?i)<a\b[^>]*\bhref=["'']([^"'']+)["'']', 1)) AS l FROM pages)""")
def html_grid_rows(spark, d):
    """Links of pages."""
    found = H.links(F.col("html"))
    return _t(spark, d, "pages").select("page_id", F.size(found).cast("long").alias("n_links"), F.md5(F.array_join(F.array_sort(found), " ")).alias("links"))


@query("""
SELECT n_nationkey AS page_id, 'grdSupplies_ctl' || lpad(CAST(s_suppkey AS VARCHAR), 2, '0') AS control, CAST(s_suppkey AS VARCHAR) || '-k' AS rut, s_name AS supplier, '$ ' || CAST(s_suppkey * 1000 AS VARCHAR) AS total, 'Aceptada' AS state,
  CASE WHEN s_suppkey % 2 = 0 THEN '/a?enc=' || CAST(s_suppkey AS VARCHAR) END AS economic, CAST((count(*) OVER (PARTITION BY n_nationkey) + 9) // 10 AS INTEGER) AS pages FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def html_offers(spark, d):
    """Offers of the grids of pages, one page a nation with its suppliers as bidders."""
    s = _t(spark, d, "supplier")
    c = F.concat(F.lit("grdSupplies_ctl"), F.lpad(F.col("s_suppkey").cast("string"), 2, "0"))
    k = F.col("s_suppkey").cast("string")
    row = F.concat(
        F.lit("<tr><td><a id='"), c, F.lit("__GvLblProvider'>"), "s_name", F.lit("</a><a id='"), c, F.lit("__GvLblRutProvider' onclick=\"verFicha('"), k, F.lit("-k')\">"), k, F.lit("</a></td><td><span id='"), c, F.lit("_TotalOferta'>$ "),
        (F.col("s_suppkey") * 1000).cast("string"), F.lit("</span><span id='"), c, F.lit("_EstadoOferta'> Aceptada </span>"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("<input id='"), c, F.lit("_Economico' onclick=\"openPopUp('/a?enc="), k, F.lit("')\">"))).otherwise(""), F.lit("</td></tr>"),
    )
    pages = s.groupBy(F.col("s_nationkey").alias("page_id")).agg(F.array_join(F.collect_list(row), "").alias("rows"), F.count("*").alias("n"))
    pages = pages.select("page_id", F.concat("rows", F.lit("<input id='WucPagerGrid_hidCountRows' value='"), F.col("n").cast("string"), F.lit("'><input id='WucPagerGrid_hidMaxRowCount' value='10'>")).alias("html"))
    out = H.offer_rows(pages).join(pages.select("page_id", H.page_count(F.col("html")).alias("pages")), "page_id")
    return out.select("page_id", "control", "rut", "supplier", "total", "state", F.element_at("links", F.lit("Economico")).alias("economic"), "pages")


@query("SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events")
def json_props(spark, d):
    """A field of JSON text."""
    return _t(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("""
SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'ok' WHEN 1 THEN 'ok_extraido' WHEN 2 THEN 'ok_extraido' WHEN 3 THEN CASE WHEN event_id % 3 = 0 THEN 'ok_reparado' ELSE 'ok_extraido' END WHEN 4 THEN 'json_invalido' WHEN 5 THEN 'sin_json' ELSE 'ok' END AS status, CASE WHEN event_id % 7 IN (0, 1, 2, 6) OR (event_id % 7 = 3 AND event_id % 3 = 0) THEN event_id % 3 END AS products FROM events
""")
def json_repair(spark, d):
    """Model answers, clean and not, written from events."""
    item = '{"producto": "Notebook"}'
    body = F.concat(F.lit('{"productos": ['), F.array_join(F.array_repeat(F.lit(item), (F.col("event_id") % 3).cast("int")), ", "), F.lit("]"))
    forms = [F.concat(body, F.lit("}")), F.concat(F.lit('note {"x": 1} then '), body, F.lit("} bye")), F.concat(F.lit("Here: "), body, F.lit(', "observaciones": "a } b"} done }')), F.concat(F.lit("```json\n"), body, F.lit(",}\n```")), F.lit("{ broken [1, }"), F.lit("none at all"), F.concat(F.lit("```json\n"), body, F.lit("}\n```"))]
    answers = _t(spark, d, "events").select("event_id", F.element_at(F.array(*forms), (F.col("event_id") % 7 + 1).cast("int")).alias("answer"))
    return readers.parse_answer(answers).select("event_id", "status", F.when(F.col("value.productos").isNotNull(), F.size("value.productos").cast("long")).alias("products"))


@query("SELECT role, count(*) AS calls, CAST(sum(len(text)) AS BIGINT) AS tokens, min(conv_id) AS first_conv FROM conversations GROUP BY ROLLUP (role)")
def token_usage_sum(spark, d):
    """Usage by kind, and in all."""
    return _t(spark, d, "conversations").rollup("role").agg(F.count("*").alias("calls"), F.sum(F.length("text")).alias("tokens"), F.min("conv_id").alias("first_conv"))


@query("SELECT doc_id FROM documents ORDER BY md5('20251101|' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 50")
def seeded_sample(spark, d):
    """A sample that a seed decides; the limit is what is asked for."""
    return _t(spark, d, "documents").orderBy(F.md5(F.concat(F.lit("20251101|"), F.col("doc_id").cast("string"))), "doc_id").limit(50).select("doc_id")


@query("""
WITH f AS (SELECT source AS supplier, CAST(doc_id AS VARCHAR) AS file FROM documents),
s AS (SELECT source AS supplier, CAST(doc_id AS VARCHAR) AS file, CASE WHEN source IN ('src1', 'src2') THEN 'old' ELSE 'm1' END AS model, CASE WHEN doc_id % 11 = 0 THEN 'json_invalido' ELSE 'ok' END AS st, doc_id % 13 = 0 AS ocr FROM documents WHERE doc_id % 4 <> 0 OR source = 'src5'),
j AS (SELECT f.supplier, f.file, CASE WHEN s.st IS NULL THEN 'archivo_nuevo' WHEN s.st = 'json_invalido' THEN 'fallo_modelo' WHEN s.ocr THEN 'pendiente_ocr' END AS reason FROM f LEFT JOIN s USING (supplier, file)),
w AS (SELECT supplier, bool_or(model <> 'm1') AS changed FROM s GROUP BY 1)
SELECT supplier, CASE WHEN w.changed IS NULL OR w.changed THEN 'completo' WHEN count(reason) > 0 THEN 'parcial' ELSE 'nada' END AS mode, CASE WHEN w.changed IS NULL OR w.changed THEN 0 ELSE count(reason) END AS n_redo FROM j LEFT JOIN w USING (supplier) GROUP BY supplier, w.changed
""")
def reprocess_plan(spark, d):
    """What to do again by supplier and why."""
    docs = _t(spark, d, "documents").select(F.col("source").alias("supplier"), F.col("doc_id").cast("string").alias("file"), "doc_id")
    state = docs.where("doc_id % 4 <> 0 OR supplier = 'src5'").select("supplier", "file", F.when(F.col("supplier").isin("src1", "src2"), "old").otherwise("m1").alias("model"), F.when(F.col("doc_id") % 11 == 0, "json_invalido").otherwise("ok").alias("file_state"), (F.col("doc_id") % 13 == 0).alias("needs_ocr"), F.lit(False).alias("ocr_tried"), F.lit("ok").alias("merge_state"))
    out = incremental.plan_rerun(docs.select("supplier", "file"), state, {"model": "m1"})
    return out.select("supplier", "mode", F.coalesce(F.size("redo"), F.lit(0)).cast("long").alias("n_redo")).withColumn("n_redo", F.greatest("n_redo", F.lit(0)))


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type, max(ts) AS ts FROM events GROUP BY 1")
def latest_checkpoint(spark, d):
    """The latest row a key."""
    return incremental.latest(_t(spark, d, "events").select("user_id", "event_id", "event_type", "ts"), ["user_id"], "ts", "event_id").select("user_id", "event_id", "event_type", "ts")


@query("""
WITH e AS (SELECT user_id, event_id, ts, CASE event_id % 3 WHEN 0 THEN 'start' WHEN 1 THEN 'end' ELSE 'error' END AS event FROM events),
n AS (SELECT *, lead(event) OVER w AS nx, lead(ts) OVER w AS nt FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, ts AS started, CASE WHEN nx IN ('end', 'error') THEN nt END AS ended, CASE WHEN nx IN ('end', 'error') THEN nx END AS outcome FROM n WHERE event = 'start'
""")
def log_start_end(spark, d):
    """Starts of a log with their ends."""
    kind = F.element_at(F.array(F.lit("start"), F.lit("end"), F.lit("error")), (F.col("event_id") % 3 + 1).cast("int"))
    return incremental.pair_log(_t(spark, d, "events").select("user_id", "event_id", "ts", kind.alias("event")), ["user_id"])


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1) // 40 AS page FROM orders")
def result_pages(spark, d):
    """Pages of 40 rows in the order of a column, without a sort of all rows in one task."""
    o = _t(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return window.placed(o, "o_totalprice", "o_orderkey").select("o_orderkey", F.floor(F.col("place") / 40).cast("long").alias("page"))


@query("""
WITH p AS (SELECT p_partkey, p_name, CASE p_partkey % 7 WHEN 0 THEN 'Hewlett-Packard' WHEN 1 THEN 'lenovo' WHEN 2 THEN 'intel' WHEN 3 THEN 'Asus/MSI' WHEN 4 THEN ' Genérico ' WHEN 5 THEN 'Acme  Corp' ELSE '' END AS b, CASE p_partkey % 5 WHEN 0 THEN 'Laptop' WHEN 1 THEN 'All_in-One' WHEN 2 THEN 'Estación de Trabajo' WHEN 3 THEN 'MONITOR' ELSE 'otro' END AS t FROM part)
SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'HP' WHEN 1 THEN 'Lenovo' WHEN 5 THEN 'Acme Corp' END AS brand, CASE p_partkey % 5 WHEN 0 THEN 'notebook' WHEN 1 THEN 'all-in-one' WHEN 2 THEN 'workstation' WHEN 3 THEN 'monitor' END AS type FROM p
""")
def brand_and_type(spark, d):
    """Brands and types in their usual spelling."""
    pick = lambda n, xs: F.element_at(F.array(*map(F.lit, xs)), (F.col("p_partkey") % n + 1).cast("int"))
    return _t(spark, d, "part").select("p_partkey", PR.brand(pick(7, ["Hewlett-Packard", "lenovo", "intel", "Asus/MSI", " Genérico ", "Acme  Corp", ""])).alias("brand"), PR.type_name(pick(5, ["Laptop", "All_in-One", "Estación de Trabajo", "MONITOR", "otro"])).alias("type"))


@query("""
WITH v AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN '214.555.-' WHEN 1 THEN '$ 1.409' WHEN 2 THEN '1.5' WHEN 3 THEN '3,250,000' WHEN 4 THEN '12,5' ELSE '1.2.3' END AS s FROM orders)
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 214555.0 WHEN 1 THEN 1409.0 WHEN 2 THEN 1.5 WHEN 3 THEN 3250000.0 WHEN 4 THEN 12.5 END::DOUBLE AS n FROM v
""")
def amounts(spark, d):
    """Written amounts as numbers."""
    xs = F.array(*map(F.lit, ["214.555.-", "$ 1.409", "1.5", "3,250,000", "12,5", "1.2.3"]))
    return _t(spark, d, "orders").select("o_orderkey", N.parse_number(F.element_at(xs, (F.col("o_orderkey") % 6 + 1).cast("int"))).alias("n"))


_CHECKED = """l AS (SELECT l_orderkey AS tender, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS seq, * FROM lineitem JOIN part ON l_partkey = p_partkey),
b AS (SELECT tender, seq, l_linenumber AS ln, CASE WHEN l_partkey % 5 = 0 THEN 'monitor' ELSE 'equipo' END AS cat, CASE WHEN l_partkey % 5 = 0 THEN 'monitor' ELSE 'notebook' END AS typ, lower(p_type) || ' ' || CAST(p_size % 5 AS VARCHAR) AS product, CASE WHEN l_linenumber % 2 = 0 THEN p_brand END AS brand,
  CASE WHEN l_linenumber % 3 > 0 THEN round_even(l_quantity / 10, 0) * 10 END AS q, round_even(l_extendedprice / 20000, 0) * 20000 AS u, 'f' || CAST(l_suppkey % 3 AS VARCHAR) AS file FROM l),
t AS (SELECT *, q * u AS t FROM b),
o AS (SELECT o_orderkey, o_totalprice * 2 AS raw FROM orders),
x AS (SELECT t.*, CASE WHEN tender % 10 = 1 AND sum(t) OVER w > 0 THEN sum(t) OVER w / 1.19 ELSE raw END AS offer_total FROM t JOIN o ON tender = o_orderkey WINDOW w AS (PARTITION BY tender)),
p AS (SELECT * REPLACE (CASE WHEN s THEN 'notebooks' ELSE product END AS product, CASE WHEN s THEN NULL ELSE q END AS q, CASE WHEN s THEN NULL ELSE u END AS u, CASE WHEN s THEN offer_total ELSE t END AS t) FROM (SELECT *, tender % 10 = 0 AND seq = 1 AS s FROM x))"""


def _checked(spark: SparkSession, d: str) -> DataFrame:
    """The products of _CHECKED: summary lines in every tenth order, gross offers in another."""
    li, p, o = _t(spark, d, "lineitem", "part", "orders")
    x = li.join(p.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type", "p_size"), "l_partkey")
    seq = F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"))
    monitor = F.col("l_partkey") % 5 == 0
    x = x.select(
        F.col("l_orderkey").alias("tender"), seq.alias("seq"), F.when(monitor, "monitor").otherwise("equipo").alias("category"), F.when(monitor, "monitor").otherwise("notebook").alias("type"), F.concat_ws(" ", F.lower("p_type"), F.col("p_size") % 5).alias("product"),
        F.when(F.col("l_linenumber") % 2 == 0, F.col("p_brand")).alias("brand"), F.when(F.col("l_linenumber") % 3 > 0, F.bround(F.col("l_quantity") / 10) * 10).alias("quantity"), (F.bround(F.col("l_extendedprice") / 20000) * 20000).alias("unit"),
        F.concat(F.lit("f"), F.col("l_suppkey") % 3).alias("file"), F.when(F.col("l_linenumber") % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("f"))).alias("sources"), F.when(F.col("l_linenumber") % 5 == 0, "Baja").otherwise("alta").alias("confidence"), F.lit("linea").alias("total_kind"),
    )
    x = x.withColumn("total", F.col("quantity") * F.col("unit")).join(o.select(F.col("o_orderkey").alias("tender"), (F.col("o_totalprice") * 2).alias("raw")), "tender")
    whole = F.sum("total").over(W.partitionBy("tender"))
    x = x.withColumn("offer_total", F.when((F.col("tender") % 10 == 1) & (whole > 0), whole / 1.19).otherwise(F.col("raw")))
    summary = (F.col("tender") % 10 == 0) & (F.col("seq") == 1)
    return x.withColumns({"product": F.when(summary, "notebooks").otherwise(F.col("product")), "quantity": F.when(~summary, F.col("quantity")), "unit": F.when(~summary, F.col("unit")), "total": F.when(summary, F.col("offer_total")).otherwise(F.col("total"))}).drop("raw")


@query(f"""
WITH {_CHECKED},
c AS (SELECT *, CASE WHEN offer_total >= 50000 THEN offer_total END AS offer, count(*) OVER (PARTITION BY tender) AS n, regexp_matches(product, '^(notebooks?)$') AS generic, product <> 'notebooks' AS specific, coalesce(q > 0 AND u > 0 AND t > 0 AND abs(q * u - t) <= greatest(2.0, abs(t) * 0.001), false) AS fine FROM p),
own AS (SELECT *, list_filter([CASE WHEN brand IS NULL THEN 'marca_no_identificada' END, CASE WHEN q IS NULL THEN 'cantidad_no_identificada' END, CASE WHEN q <= 0 THEN 'cantidad_invalida' END, CASE WHEN u IS NULL THEN 'precio_unitario_no_identificado' END, CASE WHEN u <= 0 THEN 'precio_unitario_invalido' END,
  CASE WHEN u > 0 AND (u < 20000 OR u > CASE typ WHEN 'monitor' THEN 3500000 ELSE 8000000 END) THEN 'precio_unitario_fuera_de_rango' END, CASE WHEN u > 0 AND u > offer * 1.02 THEN 'precio_unitario_supera_total_oferta' WHEN u > 0 AND n >= 2 AND abs(u - offer) <= offer * 0.005 THEN 'total_general_asignado_a_producto' END,
  CASE WHEN q <> 0 AND u <> 0 AND t <> 0 AND abs(q * u - t) > greatest(2.0, abs(t) * 0.01) THEN 'cantidad_por_unitario_no_coincide_con_total' END, CASE WHEN ln % 4 = 0 THEN 'sin_respaldo_en_hallazgos_parciales' END, CASE WHEN ln % 5 = 0 THEN 'confianza_modelo_baja' END], lambda v: v IS NOT NULL)
  || CASE WHEN u >= 100000 THEN list_transform(range(count(*) OVER (PARTITION BY tender, u) - count(*) OVER (PARTITION BY tender, u, cat)), lambda v: 'precio_repetido_en_otra_categoria') ELSE [] END AS al FROM c),
pairs AS (SELECT a.tender, a.seq AS s1, b.seq AS s2, [CASE WHEN abs(a.q - b.q) > greatest(1.0, abs(b.q) * 0.01) THEN 'conflicto_entre_fuentes_quantity' END, CASE WHEN abs(a.u - b.u) > greatest(1.0, abs(b.u) * 0.01) THEN 'conflicto_entre_fuentes_unit' END, CASE WHEN abs(a.t - b.t) > greatest(1.0, abs(b.t) * 0.01) THEN 'conflicto_entre_fuentes_total' END] AS f
  FROM c a JOIN c b ON a.tender = b.tender AND a.cat = b.cat AND a.product = b.product AND a.seq < b.seq WHERE a.specific AND NOT (a.file = b.file AND a.fine AND b.fine)),
more AS (SELECT tender, seq, list(v ORDER BY v) AS m FROM (SELECT tender, unnest([s1, s2]) AS seq, f FROM pairs) z, unnest(f) AS y(v) WHERE v IS NOT NULL GROUP BY ALL),
k AS (SELECT own.*, al || coalesce(m, []) AS a1 FROM own LEFT JOIN more USING (tender, seq) WHERE NOT coalesce(n >= 3 AND generic AND t > 0 AND (abs(t - offer) <= offer * 0.005 OR abs(t - offer / 1.19) <= offer / 1.19 * 0.005), false)),
g AS (SELECT *, coalesce(bool_and(fine) OVER w AND abs(sum(t) OVER w - offer * 1.19) <= offer * 1.19 * 0.01, false) AS gross FROM k WINDOW w AS (PARTITION BY tender)),
h AS (SELECT * REPLACE (CASE WHEN gross THEN round_even(u / 1.19, 0) ELSE u END AS u, CASE WHEN gross THEN round_even(t / 1.19, 0) ELSE t END AS t), len(list_filter(a1, lambda v: regexp_matches(v, 'invalida|fuera_de_rango|no_aparece|repetido_en_otra|no_coincide|conflicto_entre_fuentes|total_general'))) > 0 AS suspect FROM g),
s AS (SELECT *, a1 || CASE WHEN count(t) OVER w = count(*) OVER w AND sum(t) OVER w > offer * 1.02 AND (suspect OR NOT bool_or(suspect) OVER w) THEN ['suma_productos_supera_total_oferta'] ELSE [] END AS a2, count(*) OVER w AS n2 FROM h WINDOW w AS (PARTITION BY tender)),
e AS (SELECT *, a2 || CASE WHEN n2 >= 3 AND t > 0 AND (abs(t - offer) <= offer * 0.005 OR abs(t - offer / 1.19) <= offer / 1.19 * 0.005) AND NOT list_contains(a2, 'total_general_asignado_a_producto') THEN ['total_general_asignado_a_producto'] ELSE [] END AS a3 FROM s)
SELECT tender, seq, q AS quantity, u AS unit, round_even(t, 4) AS total, array_to_string(a3, ' ') AS alerts, CASE WHEN regexp_matches(array_to_string(a3, ' '), 'invalida|fuera_de_rango|no_aparece|repetido_en_otra|no_coincide|supera_total|conflicto_entre_fuentes|total_general') THEN 'inconsistente' WHEN regexp_matches(array_to_string(a3, ' '), 'no_identificad') THEN 'incompleto' WHEN len(a3) > 0 THEN 'revisar' ELSE 'ok' END AS state FROM e
""")
def offer_validation(spark, d):
    """All validation steps over the products of orders."""
    out = validate.validate(_checked(spark, d), ["tender"])
    return out.select("tender", F.col("seq").cast("long").alias("seq"), "quantity", "unit", F.bround("total", 4).alias("total"), F.array_join("alerts", " ").alias("alerts"), "state")


@query(f"""
WITH p AS (SELECT p_brand AS doc, p_partkey AS k, p_size AS q, p_partkey % 2 = 0 AS ok, list_distinct(string_split({_TOKENS.format("p_name || ' ' || p_type")}, ' ')) AS own, list_distinct(string_split({_TOKENS.format("p_name || ' ' || p_type || ' mod' || CAST(p_partkey AS VARCHAR)")}, ' ')) AS said, lower(p_name || ' ' || p_type || ' mod' || CAST(p_partkey AS VARCHAR)) AS d, 'mod' || CAST(p_partkey AS VARCHAR) AS model FROM part WHERE p_size IS NOT NULL),
m AS (SELECT r.doc, r.k AS row_id, p.k AS product_id, list_intersect(list_filter(p.own, lambda x: len(x) >= CASE WHEN p.ok THEN 4 ELSE 3 END), r.said) AS shared, len(p.model) >= 5 AND contains(r.d, p.model) AS by_model, p.ok FROM p r JOIN p ON p.doc = r.doc AND (p.q = r.q OR NOT p.ok)),
s AS (SELECT *, len(shared) AS common, by_model OR (NOT ok AND len(list_filter(shared, lambda t: len(t) >= 5 AND regexp_matches(t, '[a-z]') AND regexp_matches(t, '[0-9]'))) > 0) AS named FROM m),
z AS (SELECT *, common + CASE WHEN named THEN 3 ELSE 0 END AS score FROM s WHERE common >= 4 OR named),
o AS (SELECT *, row_number() OVER w AS i, lead(score) OVER w AS second FROM z WINDOW w AS (PARTITION BY doc, row_id ORDER BY score DESC, common DESC, product_id DESC))
SELECT doc, row_id, product_id, CAST(score AS INTEGER) AS score, CAST(common AS INTEGER) AS common FROM o WHERE i = 1 AND score >= 3 AND common >= 2 AND (second IS NULL OR score > second * 1.2)
""")
def scored_row_match(spark, d):
    """Price rows of a document and the products that clearly describe the same thing."""
    p = _t(spark, d, "part").where("p_size IS NOT NULL")
    products = p.select(F.col("p_brand").alias("doc"), F.col("p_partkey").alias("product_id"), F.concat_ws(" ", "p_name", "p_type").alias("product"), F.concat(F.lit("mod"), "p_partkey").alias("model"), F.col("p_size").cast("double").alias("quantity"), (F.col("p_partkey") % 2 == 0).alias("supported"))
    rows = p.select(F.col("p_brand").alias("doc"), F.col("p_partkey").alias("row_id"), F.concat_ws(" ", "p_name", "p_type", F.concat(F.lit("mod"), "p_partkey")).alias("description"), F.col("p_size").cast("double").alias("quantity"))
    return link.score_rows(rows, products, ["doc"])


@query("SELECT conv_id, turn, CASE WHEN role = 'user' THEN text END IS NULL AS carried, md5(last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)) AS header FROM conversations")
def header_carry_forward(spark, d):
    """The last user turn up to each turn."""
    c = _t(spark, d, "conversations").withColumn("own", F.when(F.col("role") == "user", F.col("text")))
    return window.carry_forward(c, ["conv_id"], ["turn"], "own").select("conv_id", "turn", F.col("own").isNull().alias("carried"), F.md5("header").alias("header"))


@query("SELECT t.conv_id, t.turn AS target, c.turn, md5(c.text) AS h FROM conversations t JOIN conversations c ON t.conv_id = c.conv_id AND c.turn BETWEEN t.turn - 2 AND t.turn + 2 WHERE t.role = 'assistant'")
def context_rows(spark, d):
    """Two turns on either side of each answer."""
    c = _t(spark, d, "conversations")
    return window.context(c.select("conv_id", "turn", F.md5("text").alias("h")), c.where("role = 'assistant'"), ["conv_id"], "turn").select("conv_id", "target", "turn", "h")


@query("SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY CASE p_partkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END, lower(f), f) AS rank FROM (SELECT *, CASE p_partkey % 3 WHEN 0 THEN 'Precio' WHEN 1 THEN 'ficha' ELSE 'acta' END || CAST(p_partkey AS VARCHAR) AS f FROM part)")
def file_priority(spark, d):
    """Files of a supplier by kind, then by name."""
    f = F.concat(F.element_at(F.array(F.lit("Precio"), F.lit("ficha"), F.lit("acta")), (F.col("p_partkey") % 3 + 1).cast("int")), F.col("p_partkey").cast("string"))
    return window.by_priority(_t(spark, d, "part").withColumn("file", f), ["p_brand"]).select("p_brand", "p_partkey", F.col("rank").cast("long").alias("rank"))


@query("SELECT doc_id, md5(upper(text)) AS h, len(text) AS n FROM documents WHERE source IN ('src1', 'src2') AND lang <> 'de' AND contains(lower(text), 'the')")
def multi_filter(spark, d):
    """Several optional predicates, all of which must hold."""
    wanted = {"source": F.col("source").isin("src1", "src2"), "lang": F.col("lang") != "de", "state": None, "search": F.contains(F.lower("text"), F.lit("the"))}
    out = _t(spark, d, "documents")
    for p in wanted.values():
        out = out if p is None else out.where(p)
    return out.select("doc_id", F.md5(TX.capitals(F.col("text"))).alias("h"), F.length("text").cast("long").alias("n"))


@query("SELECT r_name, n_name, c_mktsegment, count(*) AS n, bool_or(c_acctbal > 9000) AS any_rich, bool_and(c_acctbal > -500) AS all_fine FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def group_guards(spark, d):
    """Any-of and all-of guards by group. Nation and region are fixed lists."""
    c, n, r = _t(spark, d, "customer", "nation", "region")
    places = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    x = c.join(F.broadcast(places), c.c_nationkey == places.n_nationkey)
    return x.groupBy("r_name", "n_name", "c_mktsegment").agg(F.count("*").alias("n"), F.max(F.col("c_acctbal") > 9000).alias("any_rich"), F.min(F.col("c_acctbal") > -500).alias("all_fine"))


@query()
def evidence_flow(spark, d):
    """Audit, coverage and evidence rows of the products of the extraction flow, against its documents."""
    key = ["tender", "supplier"]
    blocks, found = _flow(spark, d)
    found = stage(found)
    none = spark.createDataFrame([], "tender string, supplier string")
    out = evidence.coverage(evidence.audit(found, blocks, key), blocks, none, key)
    best = evidence.evidence_row(found, blocks, key).select(*key, "seq", F.col("line_no").alias("seen_line"), "score")
    return out.join(best, [*key, "seq"], "left").select("tender", "seq", "product", "level", F.array_join("reasons", " ").alias("reasons"), F.array_join("missing", " ").alias("missing"), "verdict", "seen_line", "score")


# ------------------------------------------------------------------ catalog, reports, evaluation


_CATALOG = """c AS (SELECT o_orderkey AS i, 'T' || CAST(o_custkey % 400 AS VARCHAR) AS code, o_orderkey % 4 IN (0, 3) AS good, o_orderstatus IN ('F', 'O') AS kept, o_orderstatus = 'F' AS opened FROM orders),
w AS (SELECT *, min(CASE WHEN good AND kept THEN i END) OVER (PARTITION BY code) AS first FROM c),
j AS (SELECT *, CASE WHEN i > first THEN 'duplicada' WHEN NOT kept THEN 'estado' WHEN NOT good THEN 'rubro' ELSE 'conservada' END AS reason FROM w)"""


def _catalog(spark: SparkSession, d: str) -> DataFrame:
    state = F.when(F.col("o_orderstatus") == "F", "Adjudicada").when(F.col("o_orderstatus") == "O", "Publicada").otherwise("Desierta (o sin ofertas), cerrada")
    name = F.element_at(F.array(*map(F.lit, ["Compra de notebook", "Arriendo de notebook", "Mobiliario", "Equipos  computacionales"])), (F.col("o_orderkey") % 4 + 1).cast("int"))
    amount = F.element_at(F.array(F.floor("o_totalprice").cast("string"), F.lit("Entre 100 y 1000 UTM"), F.lit(" 21.000.000 ")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return _t(spark, d, "orders").select("o_orderkey", F.concat(F.lit("T"), (F.col("o_custkey") % 400).cast("string")).alias("IDLicitacion"), name.alias("NombreLicitacion"), F.lit("LE").alias("Tipo"), state.alias("Estado"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("FechaPublicacion"), amount.alias("MontoLicitacion"))


@query(f"WITH {_CATALOG} SELECT count(*) AS total, count(*) FILTER (reason = 'duplicada') AS duplicada, count(*) FILTER (reason = 'estado') AS estado, count(*) FILTER (reason = 'rubro') AS rubro, count(*) FILTER (reason = 'conservada') AS conservada, count(*) FILTER (reason = 'conservada' AND opened) AS scrapeable FROM j")
def catalog_funnel(spark, d):
    """Counters of the catalog's filter."""
    return catalog.funnel(_catalog(spark, d), "o_orderkey")


@query(f"""
WITH {_CATALOG}
SELECT code AS codigo, CASE i % 4 WHEN 0 THEN 'Compra de notebook' ELSE 'Equipos  computacionales' END AS nombre, 'LE' AS tipo, CASE WHEN opened THEN 'Adjudicada' ELSE 'Publicada' END AS estado, CASE WHEN opened THEN 'si' ELSE 'no' END AS scrapeable, strftime(o_orderdate, '%d/%m/%Y') AS fecha_publicacion,
  CASE i % 3 WHEN 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) WHEN 1 THEN '' ELSE '21000000' END AS monto_num, CASE i % 3 WHEN 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) WHEN 1 THEN 'Entre 100 y 1000 UTM' ELSE '21.000.000' END AS monto_texto, '' AS organismo, 'https://portal.example/' || code || '/x' AS url_ficha,
  CASE WHEN opened THEN 'pendiente' ELSE 'no_aplica' END AS scraping_estado, CASE WHEN opened THEN 'pendiente' ELSE 'no_aplica' END AS ia_estado, strftime(o_orderdate, '%Y-%m') AS mes
FROM j JOIN orders ON i = o_orderkey WHERE reason = 'conservada' AND o_orderdate >= TIMESTAMP '1993-01-01'
""")
def catalog_queue(spark, d):
    """The work queue of a catalog from a month on."""
    return catalog.by_month(catalog.queue(_catalog(spark, d), "o_orderkey", url="https://portal.example/{}/x"), "1993-01")


@query("""
WITH b AS (SELECT p_partkey, p_partkey % 8 AS k FROM part)
SELECT p_partkey, CASE k WHEN 0 THEN 'HP' WHEN 1 THEN 'Lenovo' WHEN 5 THEN 'Epson' WHEN 6 THEN 'ASUS' END AS named, CASE k WHEN 0 THEN 'HP' WHEN 5 THEN 'Epson' ELSE CASE WHEN k = 1 THEN 'Lenovo' ELSE 'Dell' END END AS by_family FROM b
""")
def brands_in_text(spark, d):
    """Brands that descriptions name by themselves or by a family, and brands that families correct."""
    text = F.element_at(F.array(*map(F.lit, ["ProBook 450 G9 con 8 GB", "Notebook LENOVO ThinkPad", "HP o similar", "Dell segun bases", "HP y Canon", "EcoTank L3250", "equipo ASUS gamer", "XPROBOOKX shp"])), (F.col("p_partkey") % 8 + 1).cast("int"))
    return _t(spark, d, "part").select("p_partkey", PR.brand_in(text).alias("named"), PR.brand_by_family(F.lit("Dell"), text).alias("by_family"))


@query("""
SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'economico' WHEN 1 THEN 'tecnico' WHEN 2 THEN 'administrativo' WHEN 3 THEN 'economico' WHEN 4 THEN 'tecnico' ELSE 'otro' END AS role, page_id % 6 = 2 AS noise, page_id % 6 IN (1, 2, 3, 5) AS bare FROM pages
""")
def document_roles(spark, d):
    """Roles of documents by name or content, paperwork, and attachments without equipment."""
    pick = lambda xs: F.element_at(F.array(*map(F.lit, xs)), (F.col("page_id") % 6 + 1).cast("int"))
    path = pick(["a/economico__01__x.pdf", "b/Ficha Técnica.pdf", "c/administrativo__01__carnet.pdf", "d/x.pdf", "e/x.pdf", "f/x.pdf"])
    text = pick(["Notebook HP", "hoja en blanco", "certificado de antecedentes", "valor neto $ 1.250.000", "procesador Lenovo, memoria RAM y pantalla", "nada"])
    return _t(spark, d, "pages").select("page_id", PR.document_role(path, text).alias("role"), PR.administrative_noise(path).alias("noise"), PR.no_equipment(text, PR.base_name(path)).alias("bare"))


_USAGE = """f AS (SELECT CAST(user_id % 50 AS VARCHAR) AS tender, user_id AS supplier, event_id AS file, CASE event_id % 9 WHEN 0 THEN 'http_500' WHEN 1 THEN 'solo_texto' WHEN 2 THEN '' WHEN 3 THEN 'json_invalido' ELSE 'ok' END AS state, CASE WHEN event_id % 4 > 0 THEN event_id % 4 END AS calls, event_id % 1000 AS tokens, CASE WHEN event_id % 3 > 0 THEN 'm' || CAST(event_id % 3 AS VARCHAR) END AS model FROM events),
u AS (SELECT tender, supplier, file, state, coalesce(calls, 1) AS calls, tokens, model FROM f WHERE state NOT IN ('', 'solo_texto'))"""


def _usage(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("event_id") % 9 == 0, "http_500").when(F.col("event_id") % 9 == 1, "solo_texto").when(F.col("event_id") % 9 == 2, "").when(F.col("event_id") % 9 == 3, "json_invalido").otherwise("ok")
    files = _t(spark, d, "events").select((F.col("user_id") % 50).cast("string").alias("tender"), F.col("user_id").alias("supplier"), F.col("event_id").cast("string").alias("file"), kind.alias("state"), F.when(F.col("event_id") % 4 > 0, F.col("event_id") % 4).alias("calls"), (F.col("event_id") % 1000).alias("tokens"), F.when(F.col("event_id") % 3 > 0, F.concat(F.lit("m"), (F.col("event_id") % 3).cast("string"))).alias("model"))
    none = files.limit(0).select("tender", "supplier", F.lit("").alias("merge_state"), F.lit(0).alias("merge_calls"), F.lit(0).alias("merge_tokens"), F.lit("").alias("merge_model"))
    return reports.usage_rows(files, none, ["tender", "supplier"])


@query(f"WITH {_USAGE} SELECT tender, CAST(sum(calls) AS BIGINT) AS calls, CAST(sum(tokens) AS BIGINT) AS tokens, count(*) FILTER (state <> 'ok') AS errors, arg_min(model, CAST(file AS VARCHAR)) FILTER (model IS NOT NULL) AS model FROM u GROUP BY 1")
def usage_totals(spark, d):
    """Calls, tokens, errors and the first known model of each tender."""
    return reports.usage_totals(_usage(spark, d), ["tender"])


@query(f"""
WITH {_USAGE}, s AS (SELECT DISTINCT CAST(user_id % 50 AS VARCHAR) AS tender, user_id AS supplier, user_id % 50 < 20 OR user_id % 3 > 0 AS done FROM events),
x AS (SELECT tender, count(*) FILTER (done) AS suppliers, count(*) AS expected FROM s GROUP BY 1), e AS (SELECT tender, sum(tokens) AS tokens, count(*) FILTER (state LIKE 'error%' OR state LIKE 'http\\_%' ESCAPE '\\') AS errors FROM u WHERE file % 9 > 0 OR file % 50 > 40 GROUP BY 1)
SELECT tender, suppliers, coalesce(CAST(tokens AS BIGINT), 0) AS tokens, coalesce(errors, 0) AS errors, CASE WHEN errors > 0 THEN 'error' WHEN suppliers >= expected THEN 'ok' ELSE 'parcial' END AS ia_state FROM x LEFT JOIN e USING (tender) WHERE suppliers > 0
""")
def tender_model_state(spark, d):
    """The state of each tender's extraction: error, ok or parcial."""
    s = _t(spark, d, "events").select((F.col("user_id") % 50).cast("string").alias("tender"), F.col("user_id").alias("supplier")).distinct()
    s = s.withColumn("done", (F.col("supplier") % 50 < 20) | (F.col("supplier") % 3 > 0))
    return reports.model_state(_usage(spark, d).where("try_cast(file AS BIGINT) % 9 > 0 OR try_cast(file AS BIGINT) % 50 > 40"), s)


@query("""
WITH l AS (SELECT l_orderkey % 300 AS g, row_number() OVER (PARTITION BY l_orderkey % 300 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS s, round_even(l_extendedprice, 0) + 0.25 AS u, l_quantity AS q FROM lineitem),
t AS (SELECT g, CASE WHEN s % 13 = 0 THEN 'ambiguo' WHEN s % 11 = 0 THEN 'falta' ELSE 'par' END AS kind, s % 11 > 0 AS made, CASE WHEN s % 3 = 0 THEN '*' WHEN s % 3 = 1 THEN 'HP' END AS gb, CASE WHEN s % 5 = 0 THEN 'Hewlett Packard' WHEN s % 7 = 0 THEN 'Dell' ELSE 'HP' END AS pb, s % 4 > 0 AS t_ok, s % 9 > 0 AS n_ok, s % 6 > 0 AS st_ok FROM l),
r AS (SELECT count(*) FILTER (kind <> 'ambiguo') AS gold, count(*) FILTER (kind = 'par') AS found, count(*) FILTER (kind = 'par' AND (gb = '*' OR (gb = 'HP' AND pb <> 'Dell'))) AS b, count(*) FILTER (kind = 'par' AND t_ok) AS t, count(*) FILTER (kind = 'par' AND n_ok) AS n,
  count(*) FILTER (kind = 'par' AND (gb = '*' OR (gb = 'HP' AND pb <> 'Dell')) AND t_ok AND n_ok) AS w, count(*) FILTER (made AND st_ok) AS ok, count(*) FILTER (kind = 'par' AND st_ok AND n_ok) AS og FROM t)
SELECT gold, round_even(found / gold, 3) AS recall, 1.0::DOUBLE AS precision, round_even(b / found, 3) AS brand_ok, round_even(t / found, 3) AS type_ok, 1.0::DOUBLE AS quantity_ok, round_even(n / found, 3) AS total_ok, round_even(w / gold, 3) AS reliability, 0::BIGINT AS false_positives, ok AS ok_products, round_even(og / ok, 3) AS ok_precision, round_even(og / gold, 3) AS ok_recall FROM r
""")
def gold_evaluation(spark, d):
    """Recall, precision and accuracies of products against a gold set, with wildcards and ambiguous items; each item's prices are its own."""
    g = F.col("l_orderkey") % 300
    s = F.row_number().over(W.partitionBy(g).orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"))
    x = _t(spark, d, "lineitem").select(g.cast("string").alias("tender"), F.lit("s").alias("supplier"), s.cast("long").alias("seq"), F.col("l_quantity").alias("quantity"))
    x = x.withColumn("unit", F.col("seq") * 10.0)
    gold = x.select("tender", "supplier", "seq", F.when(F.col("seq") % 4 == 0, "monitor").otherwise("*").alias("type"), F.when(F.col("seq") % 3 == 0, "*").when(F.col("seq") % 3 == 1, "HP").alias("brand"), "quantity", "unit", (F.col("unit") * 1000).alias("total"), (F.col("seq") % 13 == 0).alias("ambiguous"))
    brand = F.when(F.col("seq") % 5 == 0, "Hewlett Packard").when(F.col("seq") % 7 == 0, "Dell").otherwise("HP")
    found = x.where("seq % 11 > 0").select("tender", "supplier", "seq", F.lit("notebook").alias("type"), brand.alias("brand"), "quantity", "unit", F.when(F.col("seq") % 9 > 0, F.col("unit") * 1000).otherwise(1.0).alias("total"), F.when(F.col("seq") % 6 > 0, "ok").otherwise("revisar").alias("state"))
    return evaluation.score(evaluation.matched(gold, found))


@query("SELECT source AS supplier, CAST(doc_id % 40 AS VARCHAR) AS file, array_to_string(list_sort(list(DISTINCT CAST(n_chars % 12 AS INTEGER))), ' ') AS pages, array_to_string(list_sort(list(DISTINCT CASE n_chars % 3 WHEN 0 THEN 'sin_texto' ELSE 'tabla_colapsada' END)), ' ') AS reasons, (count(DISTINCT n_chars % 12) + 3) // 4 AS calls FROM documents WHERE n_chars % 3 < 2 GROUP BY 1, 2")
def vision_calls(spark, d):
    """Pages that are read as images, by file, with reasons and the calls they take."""
    reason = F.when(F.col("n_chars") % 3 == 0, "sin_texto").when(F.col("n_chars") % 3 == 1, "tabla_colapsada")
    pages = _t(spark, d, "documents").select(F.col("source").alias("supplier"), (F.col("doc_id") % 40).cast("string").alias("file"), (F.col("n_chars") % 12).cast("int").alias("page"), reason.alias("reason"))
    out = reports.vision_diagnosis(pages, ["supplier"])
    return out.select("supplier", "file", F.array_join("pages", " ").alias("pages"), F.array_join("reasons", " ").alias("reasons"), "calls")


@query("""
WITH c AS (SELECT event_type AS level, epoch(ts) AS started, CAST(event_id % 37 AS DOUBLE) + 1 AS seconds, event_id % 500 AS tokens, event_id % 8 > 0 AS ok FROM events)
SELECT level, count(*) AS calls, round_even(count(*) / (max(started + seconds) - min(started)) * 60, 6) AS calls_a_minute, round_even(sum(tokens) / (max(started + seconds) - min(started)), 6) AS tokens_a_second, list_sort(list(seconds))[1 + len(list(seconds)) // 2] AS p50, count(*) FILTER (NOT ok) AS errors FROM c GROUP BY 1
""")
def call_rates(spark, d):
    """Calls a minute, tokens a second and the median of a level."""
    c = _t(spark, d, "events").select(F.col("event_type").alias("level"), F.col("ts").cast("timestamp").cast("double").alias("started"), ((F.col("event_id") % 37) + 1).cast("double").alias("seconds"), (F.col("event_id") % 500).alias("tokens"), F.when(F.col("event_id") % 8 > 0, "ok").otherwise("error").alias("state"))
    return reports.call_rates(c, "level").withColumns({x: F.bround(x, 6) for x in ("calls_a_minute", "tokens_a_second")})


@query("""
SELECT source AS supplier, CASE doc_id % 4 WHEN 0 THEN 'a/x' || CAST(doc_id AS VARCHAR) || '.pdf' WHEN 1 THEN 'y' || CAST(doc_id AS VARCHAR) || '.zip' WHEN 2 THEN '_extraidos/y' || CAST(doc_id - 1 AS VARCHAR) || '/z.pdf' ELSE 'w' || CAST(doc_id AS VARCHAR) || '.docx' END AS file, r.reason FROM documents d,
LATERAL (SELECT unnest(list_filter([CASE WHEN doc_id % 4 IN (0, 2) AND doc_id % 3 = 0 THEN 'sin_texto' END, CASE WHEN doc_id % 10 = 0 THEN 'fallo_modelo' END, CASE WHEN doc_id % 14 = 0 THEN 'necesita_ocr' END, CASE WHEN doc_id % 4 = 1 AND NOT EXISTS (SELECT 1 FROM documents o WHERE o.doc_id = d.doc_id + 1 AND o.source = d.source) THEN 'no_soportado' END], lambda v: v IS NOT NULL)) AS reason) r
""")
def files_nobody_read(spark, d):
    """Files that nobody read, and why; an archive that was unpacked beside it was read."""
    i = F.col("doc_id")
    name = F.when(i % 4 == 0, F.concat(F.lit("a/x"), i.cast("string"), F.lit(".pdf"))).when(i % 4 == 1, F.concat(F.lit("y"), i.cast("string"), F.lit(".zip"))).when(i % 4 == 2, F.concat(F.lit("_extraidos/y"), (i - 1).cast("string"), F.lit("/z.pdf"))).otherwise(F.concat(F.lit("w"), i.cast("string"), F.lit(".docx")))
    files = _t(spark, d, "documents").select(F.col("source").alias("supplier"), name.alias("file"), F.when(i % 3 == 0, 0).otherwise(5).alias("n_chars"), F.when(i % 10 == 0, "http_500").otherwise("ok").alias("model_state"), (i % 14 == 0).alias("needs_ocr"), (i % 4 == 1).alias("unsupported"))
    return evidence.unread_files(files, ["supplier"], incremental.OK_STATES, incremental.NEUTRAL_STATES)


@query("""
WITH m AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS mes FROM orders), x AS (SELECT mes, CAST(right(mes, 2) AS INTEGER) AS k FROM m),
s AS (SELECT mes, CASE WHEN k % 3 = 0 THEN 'bajar' WHEN k % 2 = 0 THEN 'extraer' ELSE 'nada' END AS step FROM x)
SELECT mes, step, CASE WHEN step <> 'nada' THEN (SELECT min(o.mes) FROM s o WHERE o.mes > s.mes AND o.step = 'bajar') END AS overlap FROM s
""")
def month_plan(spark, d):
    """What each month still needs, and the month that can be fetched meanwhile."""
    m = _t(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("mes")).distinct()
    k = F.right("mes", F.lit(2)).cast("int")
    done = m.where(k % 3 > 0).withColumn("step", F.lit("bajado")).union(m.where((k % 3 > 0) & (k % 2 > 0)).withColumn("step", F.lit("extraido")))
    return incremental.month_plan(m, done)


@query("""
WITH o AS (SELECT s_suppkey AS supplier, s_nationkey AS tender, CASE s_suppkey % 3 WHEN 0 THEN ['economico', 'tecnico'] WHEN 1 THEN ['administrativo'] ELSE ['economico'] END AS kinds FROM supplier),
k AS (SELECT tender, supplier, unnest(kinds) AS kind FROM o)
SELECT tender, supplier, array_to_string(list_sort(list(kind)), ' ') AS missing FROM k WHERE NOT (kind = 'economico' AND supplier % 2 = 0) GROUP BY 1, 2
""")
def repair_plan(spark, d):
    """Attachments that offers name and of which there is no file."""
    s = _t(spark, d, "supplier").select(F.col("s_nationkey").alias("tender"), F.col("s_suppkey").alias("supplier"))
    both = F.create_map(F.lit("economico"), F.lit("u"), F.lit("tecnico"), F.lit("v"))
    links = F.when(F.col("supplier") % 3 == 0, both).when(F.col("supplier") % 3 == 1, F.create_map(F.lit("administrativo"), F.lit("u"))).otherwise(F.create_map(F.lit("economico"), F.lit("u")))
    files = s.where("supplier % 2 = 0").withColumn("kind", F.lit("economico"))
    return incremental.repair_plan(s.withColumn("links", links), files, ["tender"]).select("tender", "supplier", F.array_join("missing", " ").alias("missing"))


@query("""
SELECT p_partkey, concat_ws('; ', CASE p_partkey % 3 WHEN 0 THEN 'Producto: ficha.pdf (p. 2)' WHEN 1 THEN 'Fuente: base.pdf (p. 1)' ELSE 'Producto: base.pdf (p. 1)' END, CASE WHEN p_partkey % 3 = 2 AND p_partkey % 2 = 0 THEN 'Precio: precio.pdf (p. 1)' WHEN p_partkey % 3 = 0 AND p_partkey % 2 = 0 THEN 'Precio: base.pdf (p. 1)' END, CASE WHEN p_partkey % 5 = 0 THEN 'Marca: marca.pdf' END, CASE WHEN p_partkey % 7 = 0 THEN 'Respaldo: otro.pdf' END) AS source FROM part
""")
def source_texts(spark, d):
    """Where products come from, as a sheet shows it."""
    k = F.col("p_partkey")
    x = _t(spark, d, "part").select("p_partkey", F.lit("base.pdf").alias("file"), F.when(k % 3 == 0, "ficha.pdf").alias("product_file"), F.when(k % 3 == 2, "precio.pdf").alias("price_file"), F.when(k % 5 == 0, "marca.pdf").alias("brand_file"), F.lit(1).alias("page"), F.when(k % 3 == 0, 2).alias("product_page"), F.lit(None).cast("int").alias("price_page"), F.lit(None).cast("int").alias("brand_page"), F.when(k % 2 == 0, 5.0).alias("unit"), F.lit(None).cast("double").alias("total"), F.when(k % 7 == 0, F.array(F.lit("otro.pdf"), F.lit("base.pdf"))).alias("sources"))
    return x.select("p_partkey", reports.source_text().alias("source"))


@query("""
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber % 4 AS k, l_quantity AS q, CASE WHEN l_linenumber % 4 = 0 THEN floor(l_extendedprice / l_quantity) * l_quantity ELSE round_even(l_extendedprice, 0) END AS t, floor(round_even(l_extendedprice, 0) / l_quantity * 100) / 100 AS u FROM lineitem WHERE l_linenumber % 6 > 0),
i AS (SELECT *, k = 3 AND round_even(t / u, 0) > 0 AND abs(t / u - round_even(t / u, 0)) < 0.01 AS inferred FROM r)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN k < 3 THEN q WHEN inferred THEN round_even(t / u, 0) END AS quantity, CASE k WHEN 0 THEN round_even(t / q, 2) WHEN 1 THEN NULL WHEN 2 THEN 1500.0 ELSE u END AS unit, t AS total, CASE WHEN k = 1 THEN 'oferta' ELSE 'linea' END AS total_kind, inferred FROM i
""")
def raw_products(spark, d):
    """A model's rows as products: written numbers, inferred unit prices and quantities; rows without a description go."""
    k, q = F.col("l_linenumber") % 4, F.col("l_quantity")
    t = F.when(k == 0, F.floor(F.col("l_extendedprice") / q) * q).otherwise(F.bround("l_extendedprice"))
    whole = F.format_string("%d", t.cast("long"))
    x = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(F.col("l_linenumber") % 6 > 0, " Notebook ").otherwise("  ").alias("product"), F.when(k < 3, q.cast("string")).alias("quantity"), F.when(k == 2, "$ 1.500").when(k == 3, F.format_string("%.2f", F.floor(t / q * 100) / 100)).alias("unit"), whole.alias("total"), F.when(k == 1, "Oferta").otherwise(" LINEA ").alias("total_kind"))
    out = reports.normalise_raw(x)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "quantity", "unit", "total", "total_kind", F.col("quantity_source").isNotNull().alias("inferred"))


@query("SELECT event_id, CASE event_id % 5 WHEN 0 THEN true WHEN 1 THEN true ELSE false END AS again, event_id % 7 IN (0, 3) AS failed, event_id % 7 = 0 AS counted FROM events")
def retryable_errors(spark, d):
    """Errors that go away, failures of files, and what the monthly run counts as an error."""
    text = F.element_at(F.array(*map(F.lit, ["Channel  error", "HTTP 400: No models loaded", "bad request", "model not found", ""])), (F.col("event_id") % 5 + 1).cast("int"))
    state = F.element_at(F.array(*map(F.lit, ["http_500", "ok", "solo_texto", "json_invalido", "no_ejecutada", "ok_reparado", "omitido_duplicado"])), (F.col("event_id") % 7 + 1).cast("int"))
    return _t(spark, d, "events").select("event_id", PR.transient_error(text).alias("again"), incremental.file_failed(state).alias("failed"), incremental.is_error(state).alias("counted"))


@query("""
WITH p AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'HP_ProOne_245.pdf' WHEN 1 THEN 'x' ELSE 'ThinkPad L14.pdf' END AS f FROM supplier)
SELECT s_suppkey, 'all-in-one' AS type, CASE WHEN s_suppkey % 4 = 0 THEN 'HP' END AS brand FROM p UNION ALL SELECT s_suppkey, 'notebook', CASE s_suppkey % 4 WHEN 2 THEN 'Lenovo' END FROM p
""")
def brands_of_file_names(spark, d):
    """Missing brands from the names of technical files, where they agree."""
    k = F.col("s_suppkey")
    s = _t(spark, d, "supplier").select(k)
    products = s.withColumn("type", F.explode(F.array(F.lit("all-in-one"), F.lit("notebook")))).withColumn("brand", F.lit(None).cast("string"))
    names = F.when(k % 4 == 0, F.array(F.lit("tecnico/Ficha_HP_ProOne_245_G10_AIO.pdf"), F.lit("economico_Dell_AIO.pdf"))).when(k % 4 == 1, F.array(F.lit("x.pdf"))).when(k % 4 == 2, F.array(F.lit("ficha-ThinkPad-L14.pdf"))).otherwise(F.array(F.lit("ficha-ThinkPad-L14.pdf"), F.lit("ficha notebook dell.pdf")))
    files = s.select("s_suppkey", F.explode(names).alias("file"))
    return evidence.brands_by_file_name(products, files, ["s_suppkey"])


@query("SELECT o_orderpriority AS \"Mes\", o_orderkey AS k, o_orderstatus AS s FROM orders WHERE o_orderkey % 9 > 0")
def sheet_union(spark, d):
    """Sheets under one another in the first one's columns, without empty rows."""
    full = F.col("o_orderkey") % 9 > 0
    part = _t(spark, d, "orders").select("o_orderpriority", F.when(full, F.col("o_orderkey")).alias("k"), F.when(full, F.col("o_orderstatus")).otherwise("").alias("s"))
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    sheets = {n: part.where(F.col("o_orderpriority") == n).drop("o_orderpriority") for n in names}
    sheets["2-HIGH"] = sheets["2-HIGH"].withColumn("more", F.lit("")).select("more", "s", "k")
    return reports.yearly_union(sheets)


@query("SELECT p_brand, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS total FROM part WHERE p_brand NOT IN ('Brand#11', 'Brand#12') GROUP BY 1 UNION ALL SELECT 'TOTAL', count(*), CAST(sum(p_size) AS BIGINT) FROM part WHERE p_brand NOT IN ('Brand#11', 'Brand#12')")
def total_row(spark, d):
    """A summary without some groups, and a row of its totals."""
    kept = reports.allowed(_t(spark, d, "part"), "p_brand", never=["Brand#11", "Brand#12"])
    rows = kept.groupBy("p_brand").agg(F.count("*").alias("n"), F.sum("p_size").alias("total"))
    return reports.with_total(rows, "p_brand", ["n", "total"])


@query("SELECT conv_id, turn FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations) WHERE role = 'user' OR i <= 3")
def fragment_limits(spark, d):
    """All fragments of one kind and the first three of the others."""
    c = _t(spark, d, "conversations").select("conv_id", "turn", F.col("turn").alias("n"), (F.col("role") == "user").alias("economic"))
    return reports.first_fragments(c, ["conv_id"]).select("conv_id", "turn")


@query("SELECT doc_id, i AS line_no, array_to_string(list_slice(string_split(line, ' '), 1, 4), ' ') AS cells FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents) WHERE i < 3")
def capped_sheets(spark, d):
    """The first rows of each sheet and the first cells of each row."""
    rows = _t(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")).withColumn("cells", F.split("line", " ", -1))
    return reports.within_caps(rows, ["doc_id"], "line_no", 3, 4).select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.array_join("cells", " ").alias("cells"))


@query("SELECT s_nationkey, bool_and(s_suppkey % 10 > 0) AS covered, array_to_string(list_sort(list(DISTINCT CAST(p AS INTEGER))), ' ') AS pages FROM supplier, LATERAL (SELECT unnest([s_suppkey % 7, s_suppkey % 5]) AS p) GROUP BY 1")
def sets_by_key(spark, d):
    """Whether all of a key are done, and the union of two sets of pages."""
    s = _t(spark, d, "supplier")
    done = reports.covers(s.select("s_nationkey", "s_suppkey"), s.where("s_suppkey % 10 > 0"), ["s_nationkey"], "s_suppkey")
    page = lambda n: s.select("s_nationkey", (F.col("s_suppkey") % n).cast("int").alias("page"))
    pages = reports.page_union(page(7), page(5), ["s_nationkey"])
    return done.join(pages.select("s_nationkey", F.array_join("pages", " ").alias("pages")), "s_nationkey")


@query("SELECT source, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, source) AS place FROM documents GROUP BY 1")
def histogram_order(spark, d):
    """A histogram, most common first."""
    h = reports.histogram(_t(spark, d, "documents"), "source")
    return h.withColumn("place", F.row_number().over(W.orderBy(F.desc("n"), "source")).cast("long"))  # as many rows as sources


@query("""
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'exacto' WHEN 1 THEN 'parcial' WHEN 2 THEN 'exacto' ELSE 'descripcion_no_coincide' END AS located, CASE p_partkey % 4 WHEN 1 THEN 'unit' ELSE '' END AS missing FROM part
""")
def layout_evidence(spark, d):
    """The line of words with places that bears a product out."""
    k = F.col("p_partkey")
    p = _t(spark, d, "part").select(k, F.lit("t").alias("tender"), (k % 50).alias("supplier"))
    products = p.select("tender", "supplier", k.alias("seq"), F.lit("Notebook").alias("product"), F.concat(F.lit("MX"), k.cast("string"), F.lit("Z")).alias("model"), (k * 1000).cast("double").alias("unit"), (k * 2000).cast("double").alias("total"), F.lit(2.0).alias("quantity"))
    word = lambda x, dy, text: F.struct(F.lit(float(x)).alias("x0"), (k * 20.0 + dy).alias("top"), F.lit(float(x + 40)).alias("x1"), (k * 20.0 + dy + 8).alias("bottom"), text.alias("text"))
    code = F.when(k % 4 == 3, F.concat(F.lit("QQ"), k.cast("string"), F.lit("R"))).otherwise(F.concat(F.lit("mx"), k.cast("string"), F.lit("z")))
    unit = F.when(k % 4 == 1, F.lit("x")).otherwise(N.thousands(k * 1000))
    line = F.array(word(10, 0.0, F.lit("notebook")), word(60, 1.0, code), word(110, 0.5, F.lit("2")), word(160, 0.0, F.concat(F.lit("$"), unit)), word(210, 0.0, F.concat(N.thousands(k * 2000), F.lit(",00"))))
    words = p.select("tender", "supplier", F.lit("a.pdf").alias("file"), F.lit(1).alias("page"), F.explode(line).alias("w")).select("tender", "supplier", "file", "page", "w.*")
    return layout.line_evidence(products, words, ["tender", "supplier"]).select(F.col("seq").alias("p_partkey"), "located", F.array_join("missing", " ").alias("missing"))
