"""Rows of reports: usage, summaries, counters, sheets. A sheet is a DataFrame in the order of its columns; sinks write it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import parse_number
from ..functions.text import content_id

OK = ("ok", "ok_reparado", "ok_extraido")
NEUTRAL = ("no_ejecutada", "solo_texto", "omitido_sin_equipos", "omitido_duplicado")


# ------------------------------------------------------------------ raw rows


def normalise_raw(raw: DataFrame) -> DataFrame:
    """A model's rows as products: written numbers are read, a unit price is inferred from total and quantity (two places) and a whole quantity
    from total and unit price (to 0.01), for line totals only; rows without a description go.

    raw: product, quantity, unit, total, total_kind as strings, and any other columns. quantity_source says when the quantity was inferred.
    """
    kind = F.lower(F.trim(F.coalesce("total_kind", F.lit(""))))
    x = raw.withColumn("product", F.trim(F.coalesce("product", F.lit("")))).where("product <> ''")
    x = x.withColumns({c: parse_number(F.col(c).cast("string")) for c in ("quantity", "unit", "total")}).withColumn("total_kind", F.when(kind.isin("linea", "oferta"), kind))
    line = F.coalesce(F.col("total_kind") == "linea", F.lit(False))
    ratio = F.try_divide("total", "unit")
    whole = F.bround(ratio)
    infer = line & F.col("quantity").isNull() & (F.col("unit") != 0) & (F.col("total") != 0) & (whole > 0) & (F.abs(ratio - whole) < 0.01)
    unit = F.when(line & F.col("unit").isNull() & (F.col("quantity") != 0), F.bround(F.try_divide("total", "quantity"), 2)).otherwise(F.col("unit"))
    source = F.when(F.coalesce(infer, F.lit(False)), "inferida_total_dividido_unitario")
    return x.withColumns({"quantity_source": source, "quantity": F.when(F.coalesce(infer, F.lit(False)), whole).otherwise(F.col("quantity")), "unit": unit})


def folder_parts(folder: Column) -> Column:
    """Supplier id and name of a folder named id__name."""
    parts = F.split(folder, "__", 2)
    return F.struct(parts[0].alias("supplier"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("name"))


def without_empty(rows: DataFrame) -> DataFrame:
    """rows in which some column holds a value other than the empty text."""
    some = F.lit(False)
    for c in rows.columns:
        some = some | F.coalesce(F.col(f"`{c}`").cast("string") != "", F.lit(False))
    return rows.where(some)


def allowed(rows: DataFrame, column: str, only: list[str] | None = None, never: list[str] | None = None) -> DataFrame:
    """Rows on a list, if there is one, and not on another."""
    out = rows if only is None else rows.where(F.col(column).isin(*only) if only else F.lit(False))
    return out if not never else out.where(~F.coalesce(F.col(column).isin(*never), F.lit(False)))


def covers(keys: DataFrame, done: DataFrame, key: list[str], value: str) -> DataFrame:
    """For each key whether all its values are among those done."""
    left = keys.join(done.select(*key, value).distinct().withColumn("_d", F.lit(True)), [*key, value], "left")
    return left.groupBy(*key).agg((F.count_if(F.col("_d").isNull()) == 0).alias("covered"))


def page_union(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Sorted distinct pages of a key in either table (key, page)."""
    both = a.select(*key, "page").union(b.select(*key, "page"))
    return both.groupBy(*key).agg(F.array_sort(F.collect_set("page")).alias("pages"))


def first_fragments(fragments: DataFrame, key: list[str], most: int = 3) -> DataFrame:
    """Fragments (key, n, economic): all of price documents, the first ones of others."""
    return fragments.withColumn("_n", F.row_number().over(W.partitionBy(*key).orderBy("n"))).where(F.col("economic") | (F.col("_n") <= most)).drop("_n")


def within_caps(rows: DataFrame, key: list[str], line: str = "line_no", max_rows: int = 500, max_cells: int = 40) -> DataFrame:
    """The first rows of each sheet, and the first cells (array column cells) of each row: what a reader with caps sees."""
    kept = rows.withColumn("_n", F.row_number().over(W.partitionBy(*key).orderBy(line))).where(F.col("_n") <= max_rows).drop("_n")
    return kept.withColumn("cells", F.slice("cells", 1, max_cells))


# ------------------------------------------------------------------ usage and summaries


def usage_rows(files: DataFrame, suppliers: DataFrame, key: list[str]) -> DataFrame:
    """One row a call that was made: of files (key, file, state, calls, tokens, model) and of consolidations (suppliers: key, merge_state, merge_calls,
    merge_tokens, merge_model)."""
    state = F.coalesce(F.when(F.col("state") != "", F.col("state")), F.lit("no_ejecutada"))
    a = files.withColumn("state", state).where(~F.col("state").isin(*NEUTRAL))
    a = a.select(*key, F.lit("archivo").alias("call"), "file", "state", F.coalesce("calls", F.lit(1)).cast("long").alias("calls"), F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"), "model")
    merge = F.coalesce(F.when(F.col("merge_state") != "", F.col("merge_state")), F.lit("no_ejecutada"))
    b = suppliers.withColumn("state", merge).where(~F.col("state").isin("no_ejecutada", "omitida"))
    calls = F.when(F.coalesce("merge_calls", F.lit(0)) == 0, 1).otherwise(F.col("merge_calls"))
    b = b.select(*key, F.lit("consolidacion").alias("call"), F.lit("").alias("file"), "state", calls.cast("long").alias("calls"), F.coalesce("merge_tokens", F.lit(0)).cast("long").alias("tokens"), F.col("merge_model").alias("model"))
    return a.union(b)


def usage_totals(usage: DataFrame, key: list[str], order: str = "file") -> DataFrame:
    """Calls, tokens, errors and the first model that is known, by key."""
    return usage.groupBy(*key).agg(
        F.sum("calls").alias("calls"), F.sum("tokens").alias("tokens"), F.count_if(~F.col("state").isin(*OK)).alias("errors"),
        F.min_by("model", F.when(F.col("model").isNotNull(), F.struct(order, "call"))).alias("model"),
    )


def supplier_summary(products: DataFrame, usage: DataFrame, pending: DataFrame, unsupported: DataFrame, key: list[str]) -> DataFrame:
    """products, valid, to_review, calls, errors, ocr and unsupported of every supplier that any table has; pending and unsupported: (key, file)."""
    one = [
        products.groupBy(*key).agg(F.count("*").alias("products"), F.count_if(F.col("state") == "ok").alias("valid")),
        usage.groupBy(*key).agg(F.sum("calls").alias("calls"), F.count_if(~F.col("state").isin(*OK)).alias("errors")),
        pending.groupBy(*key).agg(F.count("*").alias("ocr")), unsupported.groupBy(*key).agg(F.count("*").alias("unsupported")),
    ]
    out = one[0]
    for other in one[1:]:
        out = out.join(other, key, "full_outer")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("products", "valid", "calls", "errors", "ocr", "unsupported")]
    return out.select(*key, *zero).withColumn("to_review", F.col("products") - F.col("valid"))


def model_state(usage: DataFrame, suppliers: DataFrame, tender: str = "tender") -> DataFrame:
    """For each tender the suppliers with a result, tokens, errors (states that begin with error or http_) and a verdict: error, ok if all expected suppliers have a
    result, else parcial. suppliers: tender, supplier, done."""
    bad = F.startswith("state", F.lit("error")) | F.startswith("state", F.lit("http_"))
    used = usage.groupBy(tender).agg(F.sum("tokens").alias("tokens"), F.count_if(bad).alias("errors"))
    found = suppliers.groupBy(tender).agg(F.count_if("done").alias("suppliers"), F.count("*").alias("expected"))
    out = found.join(used, tender, "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("tokens", "errors")})
    verdict = F.when(F.col("errors") > 0, "error").when((F.col("expected") > 0) & (F.col("suppliers") >= F.col("expected")), "ok").otherwise("parcial")
    return out.where("suppliers > 0").select(tender, "suppliers", "tokens", "errors", verdict.alias("ia_state"))


def histogram(rows: DataFrame, *by: str) -> DataFrame:
    """Counts by values, most common first, then by value."""
    return rows.groupBy(*by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *by)


def download_counts(files: DataFrame, offers: DataFrame, key: list[str]) -> DataFrame:
    """Files and offers of each tender as they are now: files (key, supplier), offers (key, supplier, links map)."""
    a = files.groupBy(*key).agg(F.count("*").alias("files"), F.countDistinct("supplier").alias("with_files"))
    b = offers.groupBy(*key).agg(F.count("*").alias("offers"), F.count_if(F.coalesce(F.size("links"), F.lit(0)) <= 0).alias("without_links"))
    return b.join(a, key, "full_outer").select(*key, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("offers", "without_links", "files", "with_files")])


def decisions(reviewed: DataFrame) -> DataFrame:
    """How many rows were decided and how; blank is pendiente."""
    return histogram(reviewed.select(F.coalesce(F.nullif("decision", F.lit("")), F.lit("pendiente")).alias("decision")), "decision")


def vision_diagnosis(pages: DataFrame, key: list[str], a_call: int = 4) -> DataFrame:
    """For each file of pages (key, file, page, reason; null reason: read as text) its pages as images, their reasons and the calls they take."""
    shown = pages.where("reason IS NOT NULL").groupBy(*key, "file").agg(F.array_sort(F.collect_set("page")).alias("pages"), F.array_sort(F.collect_set("reason")).alias("reasons"))
    return shown.withColumn("calls", F.ceil(F.size("pages") / max(a_call, 1)).cast("long"))


def call_rates(calls: DataFrame, by: str) -> DataFrame:
    """calls (by, started, seconds, tokens, state): calls a minute and tokens a second over the wall time of a level, the upper median of seconds, errors."""
    wall = F.max(F.col("started") + F.col("seconds")) - F.min("started")
    sorted_ = F.array_sort(F.collect_list("seconds"))
    return calls.groupBy(by).agg(
        F.count("*").alias("calls"), (F.count("*") / wall * 60).alias("calls_a_minute"), (F.sum("tokens") / wall).alias("tokens_a_second"),
        F.get(sorted_, F.floor(F.size(sorted_) / 2).cast("int")).alias("p50"), F.count_if(~F.col("state").isin(*OK)).alias("errors"),
    )


# ------------------------------------------------------------------ sheets


def source_text() -> Column:
    """Files that a product comes from, as a sheet shows them: product, price, brand and supporting files with their pages, each once, in order.
    Needs file, product_file, price_file, brand_file, their pages (page, product_page, price_page, brand_page), unit, total, sources."""
    at = lambda kind, file, page: F.when(file.isNotNull() & ~file.isin("", "consolidacion"), F.concat(F.lit(kind + ": "), file, F.when(page.isNotNull(), F.concat(F.lit(" (p. "), page.cast("string"), F.lit(")"))).otherwise("")))
    known = F.col("product_file").isNotNull() | F.col("price_file").isNotNull()
    priced = F.col("unit").isNotNull() | F.col("total").isNotNull()
    main = F.array(
        F.when(known, at("Producto", F.coalesce("product_file", "file"), F.coalesce("product_page", "page"))).otherwise(at("Fuente", F.col("file"), F.col("page"))),
        F.when(known & priced, at("Precio", F.coalesce("price_file", "file"), F.coalesce("price_page", "page"))), at("Marca", F.col("brand_file"), F.col("brand_page")),
    )
    primary = F.array_compact(F.array("file", "product_file", "price_file", "brand_file"))
    none = F.lit(None).cast("int")
    backing = F.transform(F.filter(F.coalesce("sources", F.array().cast("array<string>")), lambda s: ~F.array_contains(primary, s)), lambda s: at("Respaldo", s, none))
    return F.array_join(F.array_distinct(F.array_compact(F.concat(main, backing))), "; ")


def product_sheet(products: DataFrame) -> DataFrame:
    """The fifteen columns of the product report, from validated products in their context (tender, tender_name, published, supplier_name, verdict, verdict_reason)."""
    want = {"tender_name": "string", "published": "string", "supplier_name": "string", "verdict": "string", "verdict_reason": "string", "product_page": "int", "price_page": "int", "brand_file": "string", "brand_page": "int", "product_file": "string"}
    x = products.withColumns({c: F.lit(None).cast(t) for c, t in want.items() if c not in products.columns})
    return x.select(
        F.col("tender").alias("ID licitación"), F.col("tender_name").alias("Nombre licitación"), F.col("published").alias("Fecha licitación"), F.col("supplier_name").alias("Proveedor"), F.col("product").alias("Producto ofertado"),
        F.col("type").alias("Tipo de producto"), F.col("brand").alias("Marca producto"), F.col("quantity").alias("Cantidad"), F.col("unit").alias("Precio unitario"), F.col("total").alias("Precio total"),
        source_text().alias("Fuente de información"), F.col("state").alias("Estado validación"), F.array_join("alerts", "; ").alias("Alertas"), F.col("verdict").alias("Cobertura documental"), F.col("verdict_reason").alias("Motivo cobertura"),
    )


def audit_sheets(audited: DataFrame, suppliers: DataFrame, unread: DataFrame) -> dict[str, DataFrame]:
    """The audit's sheets: Productos, Resumen (by tender and TOTAL), Sin_leer, Sin_productos. suppliers: tender, supplier; unread: tender, supplier, file, reason."""
    key = ["tender", "supplier"]
    some = audited.groupBy(*key).agg(F.count("*").alias("products"), *[F.count_if(F.col("level") == x).alias(x) for x in ("verificado", "revisar", "no_verificable")], F.count_if(F.array_contains("reasons", "rescatado_de_fila_economica")).alias("rescued"))
    files = unread.groupBy(*key).agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(" ", "file", F.concat(F.lit("("), F.col("reason"), F.lit(")"))))), "; ").alias("unread"))
    each = suppliers.select(*key).distinct().join(some, key, "left").join(files, key, "left")
    total = each.rollup("tender").agg(
        F.count("*").alias("suppliers"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("products", "verificado", "revisar", "no_verificable", "rescued")],
        F.count_if(F.col("products").isNull()).alias("without_products"), F.count_if(F.col("unread").isNotNull()).alias("with_unread"), F.grouping("tender").alias("_g"),
    )
    resumen = total.select(F.when(F.col("_g") == 1, "TOTAL").otherwise(F.col("tender")).alias("tender"), "suppliers", "products", "verificado", F.bround(F.try_divide("verificado", "products"), 3).alias("ratio"), "revisar", "no_verificable", "rescued", "without_products", "with_unread")
    return {
        "Productos": audited.withColumns({"reasons": F.array_join("reasons", "; ")}), "Resumen": resumen,
        "Sin_leer": unread.select(*key, F.concat_ws(" ", "file", F.concat(F.lit("("), F.col("reason"), F.lit(")"))).alias("file")), "Sin_productos": each.where("products IS NULL").select(*key, F.coalesce("unread", F.lit("")).alias("unread")),
    }


def yearly_union(months: dict[str, DataFrame], column: str = "Mes") -> DataFrame:
    """Monthly sheets under one another, with the columns of the first by month, the month in front, without empty rows."""
    order = sorted(months)
    first = months[order[0]].columns
    out = None
    for m in order:
        rows = without_empty(months[m])
        part = rows.select(F.lit(m).alias(column), *[F.col(f"`{c}`") if c in rows.columns else F.lit(None).alias(c) for c in first])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def with_total(rows: DataFrame, label: str, sums: list[str]) -> DataFrame:
    """rows, and a row TOTAL with the sums of some columns and blanks elsewhere."""
    blank = [F.coalesce(F.sum(c), F.lit(0)).cast(rows.schema[c].dataType).alias(c) if c in sums else F.lit("TOTAL" if c == label else None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns]
    return rows.unionByName(rows.agg(*[b for c, b in zip(rows.columns, blank, strict=True) if c in sums]).select(*[F.col(c) if c in sums else b for c, b in zip(rows.columns, blank, strict=True)]))


def steps(flags: Column, method: Column, brand_method: Column) -> Column:
    """What was done to a product, step by step, for its reviewer."""
    has = lambda f: F.coalesce(F.array_contains(flags, f), F.lit(False))
    return F.array_compact(F.array(
        F.when(method == "vision", "se leyó la página como imagen").otherwise("se leyó el texto del documento"), F.when(has("rescatado_fila_economica"), "se agregó desde una fila verificable que el modelo no asoció"),
        F.when(has("precio_reconciliado_fuente"), "el precio se corrigió con la fila verificable del documento de precios"), F.when(has("precio_fuente_no_coincide"), "se anuló el precio porque ninguna fila verificable lo respalda"),
        F.when(has("precio_desde_linea_agregada"), "el unitario se dedujo de una línea con cantidad y total"), F.when(has("total_con_iva_convertido"), "el total con IVA se pasó a neto"),
        F.when(brand_method.isNotNull(), F.concat(F.lit("la marca se obtuvo por "), brand_method)), F.lit("se validaron cantidad por unitario, plausibilidad y conflictos"),
    ))


def review_rows(products: DataFrame, key: list[str]) -> DataFrame:
    """Review records as JSON, one a product, under an id that depends on its content alone."""
    ident = content_id(F.col(key[0]), F.col(key[-1]), F.col("product"), F.col("unit"), F.col("quantity"), F.col("file"))
    return products.select(ident.alias("id"), F.to_json(F.struct(*[F.col(c) for c in products.columns])).alias("record"))
