"""The tender catalog: scan, filter, work queue by month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import in_months, month, parse_budget
from ..functions.products import tender_in_scope, tender_state
from .readers import CATALOG_COLUMNS, read_csv

QUEUE = ("codigo", "nombre", "tipo", "estado", "scrapeable", "fecha_publicacion", "monto_num", "monto_texto", "organismo", "url_ficha", "scraping_estado", "ia_estado")
KEEP = ("scraping_estado", "ia_estado", "n_ofertas", "n_archivos", "ia_proveedores", "ia_tokens", "ia_errores")


def read_catalogs(spark: SparkSession, paths: list[str]) -> tuple[DataFrame | None, list[str]]:
    """All catalogs that can be read, with file and row (their order), and the paths that cannot (no such file, no required column)."""
    out, bad = None, []
    for n, path in enumerate(paths):
        try:
            df = read_csv(spark, path, CATALOG_COLUMNS[:1]).withColumns({"_file": F.lit(n), "_row": F.monotonically_increasing_id()})
        except Exception:  # an unreadable catalog is reported, and the others are used
            bad.append(path)
            continue
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out, bad


def judged(catalog: DataFrame, *order: str) -> DataFrame:
    """catalog with reason (sin_codigo, duplicada, estado, rubro, conservada) and scrapeable. The first row of a code that passes both filters is kept; rows
    of the code after it are duplicates, whatever else they are."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")) if c in catalog.columns else F.lit("")
    kept, opened = tender_state(text("Estado"))
    good = kept & tender_in_scope(text("NombreLicitacion"), text("Descripcion"))
    at = F.struct(*order)
    x = catalog.withColumns({"_good": good, "_kept": kept, "scrapeable": opened})
    x = x.withColumn("_first", F.min(F.when(F.col("_good"), at)).over(W.partitionBy("IDLicitacion")))
    reason = (
        F.when(F.coalesce("IDLicitacion", F.lit("")) == "", "sin_codigo").when(at > F.col("_first"), "duplicada").when(~F.col("_kept"), "estado")
        .when(~F.col("_good"), "rubro").otherwise("conservada")
    )
    return x.withColumn("reason", reason).drop("_good", "_kept", "_first")


def queue(catalog: DataFrame, *order: str, url: str = "{}") -> DataFrame:
    """The twelve columns of the work queue for the rows of catalog that are kept. url: the address of a tender's page, with {} for its code."""
    x = judged(catalog, *order).where("reason = 'conservada'")
    text = lambda c: F.coalesce(F.col(c), F.lit("")) if c in catalog.columns else F.lit("")
    amount = text("MontoLicitacion")
    state = F.when(F.col("scrapeable"), "pendiente").otherwise("no_aplica")
    before, _, after = url.partition("{}")
    made: dict[str, Column] = {
        "codigo": F.col("IDLicitacion"), "nombre": text("NombreLicitacion"), "tipo": text("Tipo"), "estado": text("Estado"), "scrapeable": F.when(F.col("scrapeable"), "si").otherwise("no"), "fecha_publicacion": text("FechaPublicacion"),
        "monto_num": F.coalesce(parse_budget(amount).cast("string"), F.lit("")), "monto_texto": F.trim(amount), "organismo": text("Organismo"), "url_ficha": F.concat(F.lit(before), F.col("IDLicitacion"), F.lit(after)), "scraping_estado": state, "ia_estado": state,
    }
    return x.select(*[made[c].alias(c) for c in QUEUE])


def funnel(catalog: DataFrame, *order: str) -> DataFrame:
    """One row of counters: total, duplicada, estado, rubro, conservada, scrapeable."""
    x = judged(catalog, *order)
    return x.agg(F.count("*").alias("total"), *[F.count_if(F.col("reason") == r).alias(r) for r in ("duplicada", "estado", "rubro", "conservada")], F.count_if((F.col("reason") == "conservada") & F.col("scrapeable")).alias("scrapeable"))


def by_month(rows: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Queue rows with mes, the month of publication, in a range of months."""
    return rows.withColumn("mes", month(F.col("fecha_publicacion"))).where(in_months(F.col("mes"), first, last))


def merge_queue(new: DataFrame, old: DataFrame) -> DataFrame:
    """A new queue over an old one, by codigo: state columns that the old one has filled survive, its other rows stay; in the order of date and code as text."""
    columns = [*new.columns, *[c for c in old.columns if c not in new.columns], *[c for c in KEEP if c not in new.columns and c not in old.columns]]
    full = lambda d: d.select(*[F.col(c).cast("string").alias(c) if c in d.columns else F.lit(None).cast("string").alias(c) for c in columns])
    n, o = full(new).alias("n"), full(old).alias("o")
    both = n.join(o, F.col("n.codigo") == F.col("o.codigo"), "full_outer")
    fresh = F.col("n.codigo").isNotNull()
    pick = lambda c: F.coalesce(F.nullif(F.col(f"o.{c}"), F.lit("")), F.col(f"n.{c}")) if c in KEEP else F.when(fresh, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
    return both.select(*[pick(c).alias(c) for c in columns]).orderBy("fecha_publicacion", "codigo")


def needs_scraping(state: Column, retry: bool = False) -> Column:
    """Whether a row's offers are still to be fetched."""
    s = F.lower(F.trim(F.coalesce(F.nullif(state, F.lit("")), F.lit("pendiente"))))
    open_ = s.isin("", "pendiente", "sin_cuadro")
    return open_ | (s != "ok") if retry else open_


def pending(rows: DataFrame, most: int | None = None, retry: bool = False) -> DataFrame:
    """The rows still to be fetched, the first ones by date and code if there is a limit."""
    out = rows.where(needs_scraping(F.col("scraping_estado"), retry)).orderBy("fecha_publicacion", "codigo")
    return out if most is None else out.limit(most)
