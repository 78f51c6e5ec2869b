"""Evaluation of products against a gold set."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.products import brand
from ..functions.text import alnum_key
from .merge import match_figures

ITEM = "struct<tipo:string,marca:string,cantidad:double,precio_unitario:double,precio_total:double,ambiguo:boolean>"
_MATCH = "tender string, supplier string, kind string, gold_type string, gold_brand string, gold_quantity double, gold_unit double, gold_total double, type string, brand string, quantity double, unit double, total double, state string"


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """(tender, supplier, seq, type, brand, quantity, unit, total, ambiguous) of gold files: tender to supplier to a list of items. A supplier that
    offers nothing has one row with seq null. Later files add to a tender's suppliers and replace equal ones."""
    raw = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("_file"), F.from_json("value", f"map<string,map<string,array<{ITEM}>>>").alias("g"))
    tenders = raw.select("_file", F.explode("g").alias("tender", "s")).select("_file", "tender", F.explode("s").alias("supplier", "items"))
    last = tenders.groupBy("tender", "supplier").agg(F.max_by("items", "_file").alias("items"))
    items = last.select("tender", "supplier", F.posexplode_outer("items").alias("seq", "x"))
    return items.select("tender", "supplier", "seq", F.col("x.tipo").alias("type"), F.col("x.marca").alias("brand"), F.col("x.cantidad").alias("quantity"), F.col("x.precio_unitario").alias("unit"), F.col("x.precio_total").alias("total"), F.coalesce("x.ambiguo", F.lit(False)).alias("ambiguous"))


def matched(gold: DataFrame, products: DataFrame) -> DataFrame:
    """Gold items and products matched one to one in order, within a supplier: kind is par, falta (no product), sobra (no gold item) or ambiguo, and sin_resultado
    for all items of a supplier without any row in products and of no offer."""
    g = gold.where("seq IS NOT NULL").select("tender", "supplier", F.lit(0).alias("side"), F.col("seq").cast("long").alias("seq"), "type", "brand", "quantity", "unit", "total", F.lit(None).cast("string").alias("state"), "ambiguous")
    p = products.join(gold.select("tender", "supplier").distinct(), ["tender", "supplier"], "left_semi").select("tender", "supplier", F.lit(1).alias("side"), F.col("seq").cast("long").alias("seq"), "type", "brand", "quantity", "unit", "total", "state", F.lit(False).alias("ambiguous"))

    key, figures, columns = ["tender", "supplier"], ("type", "brand", "quantity", "unit", "total"), [c.split()[0] for c in _MATCH.split(", ")]
    dealt = g.unionByName(p).repartition(*key).sortWithinPartitions(*key, "side", "seq")
    schema = gold.sparkSession.createDataFrame([], _MATCH).schema
    arrow = to_arrow_schema(schema)

    def settle(rows: pa.Table) -> list[pa.RecordBatch]:
        """One supplier's gold items and products, as columns: only prices and quantities become Python values."""
        n = pc.sum(pc.equal(rows["side"], 0)).as_py()
        want, found = rows.slice(0, n), rows.slice(n)
        hits = match_figures(*[t[f].to_pylist() for t in (want, found) for f in ("unit", "quantity")])
        at = pa.array(hits, pa.int64())
        hit = found.take(at)
        kind = pc.if_else(want["ambiguous"], "ambiguo", pc.if_else(pc.is_valid(at), "par", "falta"))
        whole = {c: want[c] for c in key} | {"kind": kind} | {"gold_" + f: want[f] for f in figures} | {c: hit[c] for c in (*figures, "state")}
        free = np.ones(found.num_rows, bool)
        free[at.drop_null().to_numpy(zero_copy_only=False)] = False
        more = found.filter(pa.array(free))
        spare = {c: more[c] for c in (*key, *figures, "state")} | {"kind": pa.repeat(pa.scalar("sobra"), more.num_rows)} | {"gold_" + f: pa.nulls(more.num_rows, want.schema.field(f).type) for f in figures}
        return [b for t in (whole, spare) for b in pa.table({c: t[c] for c in columns}).cast(arrow).to_batches(max_chunksize=65_536)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            names = list(zip(*[batch.column(k).to_pylist() for k in key], strict=True))
            cuts = [i for i in range(1, len(names)) if names[i] != names[i - 1]]
            for i, j in itertools.pairwise([0, *cuts, len(names)]):
                if j > i and held and names[i] != last:
                    yield from settle(pa.Table.from_batches(held))
                    held = []
                if j > i:
                    held.append(batch.slice(i, j - i))
                    last = names[i]
        if held:
            yield from settle(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, schema)


def _same_brand(a: Column, b: Column) -> Column:
    x, y = (alnum_key(F.coalesce(brand(c), c, F.lit(""))) for c in (a, b))
    return (x != "") & (y != "") & (F.contains(x, y) | F.contains(y, x))


def score(pairs: DataFrame) -> DataFrame:
    """One row: recall, precision, accuracies of brand, type, quantity and total among found items, complete reliability, and precision and recall of products
    in state ok, to three places. * in gold stands for anything; a gold item without brand wants none. Ambiguous items neither add nor take.

    Pairs are counted by kind, names and whether their figures agree, before names are compared: that costs far more than all else.
    """
    par = F.col("kind") == "par"
    near_total = F.coalesce(F.abs(F.col("total") - F.col("gold_total")) <= F.greatest(F.lit(2.0), F.col("gold_total") * 0.001), F.lit(False))
    brand_ok = F.when(F.col("gold_brand") == "*", True).when(F.coalesce("gold_brand", F.lit("")) == "", F.coalesce("brand", F.lit("")) == "").otherwise(_same_brand(F.col("brand"), F.col("gold_brand")))
    type_ok = (F.col("gold_type") == "*") | (alnum_key(F.coalesce("type", F.lit(""))) == alnum_key(F.coalesce("gold_type", F.lit(""))))
    figures = {"q": F.coalesce(F.col("quantity") == F.col("gold_quantity"), F.lit(False)), "n": near_total, "ok": F.coalesce(F.col("state") == "ok", F.lit(False))}
    names = ["kind", "gold_brand", "brand", "gold_type", "type"]
    x = pairs.select(*names, *[v.alias(k) for k, v in figures.items()]).groupBy(*names, *figures).agg(F.count("*").alias("pairs"))
    x = x.withColumns({"b": F.coalesce(brand_ok, F.lit(False)), "t": F.coalesce(type_ok, F.lit(False))})
    many = lambda c: F.coalesce(F.sum(F.when(c, F.col("pairs"))), F.lit(0).cast("long"))
    s = x.agg(
        many(F.col("kind").isin("par", "falta")).alias("gold"), many(par).alias("found"), many(F.col("kind") == "sobra").alias("fp"), *[many(par & F.col(k)).alias("n_" + k) for k in "btqn"],
        many(par & F.col("b") & F.col("t") & F.col("q") & F.col("n")).alias("whole"), many(F.col("ok")).alias("ok"), many(par & F.col("ok") & F.col("n")).alias("ok_good"),
    )
    share = lambda a, b: F.bround(F.coalesce(F.try_divide(F.col(a), b), F.lit(0.0)), 3)
    found, gold = F.col("found"), F.col("gold")
    return s.select(
        "gold", share("found", gold).alias("recall"), share("found", found + F.col("fp")).alias("precision"), share("n_b", found).alias("brand_ok"), share("n_t", found).alias("type_ok"), share("n_q", found).alias("quantity_ok"),
        share("n_n", found).alias("total_ok"), share("whole", gold).alias("reliability"), F.col("fp").alias("false_positives"), F.col("ok").alias("ok_products"), share("ok_good", F.col("ok")).alias("ok_precision"), share("ok_good", gold).alias("ok_recall"),
    )


def wilson(hits: Column, n: Column, z: float = 1.96) -> Column:
    """Ends of the Wilson interval of a share, to four places."""
    r = hits / n
    mid, half = r + z * z / (2 * n), z * F.sqrt(r * (1 - r) / n + z * z / (4.0 * n * n))
    return F.struct(F.bround((mid - half) / (1 + z * z / n), 4).alias("low"), F.bround((mid + half) / (1 + z * z / n), 4).alias("high"))
