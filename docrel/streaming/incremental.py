"""State by key, kept in tables, and what to do again when inputs or settings change."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

OK_STATES = ("ok", "ok_reparado", "ok_extraido")
#: States of files that were not sent to a model, and of consolidations that were not needed.
NEUTRAL_STATES = ("no_ejecutada", "solo_texto", "omitido_sin_equipos", "omitido_duplicado")
NEUTRAL_MERGES = ("", "omitida", "no_ejecutada")


def latest(rows: DataFrame, key: list[str], *order: Column | str) -> DataFrame:
    """The last row of each key by the given order, which must break all ties. A max over a struct, so it combines before the shuffle."""
    rest = [c for c in rows.columns if c not in key]
    by = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), by).alias("_r")).select(*key, "_r.*")


def file_failed(state: Column) -> Column:
    """Whether a model failed on a file: any state that is neither good nor neutral."""
    return ~F.coalesce(state, F.lit("")).isin(*OK_STATES, *NEUTRAL_STATES)


def is_error(state: Column) -> Column:
    """What the monthly run counts as an error: fewer states than file_failed()."""
    return F.coalesce(F.startswith(state, F.lit("error")) | F.startswith(state, F.lit("http_")), F.lit(False))


def plan_rerun(files: DataFrame, state: DataFrame, settings: dict[str, str], key: str = "supplier") -> DataFrame:
    """What to do with each supplier: completo, parcial, consolidar or nada, and for each file the reason.

    files: key, file. state: one row a (key, file) of the last run with model, backend, mode, file_state, needs_ocr, ocr_tried, merge_state.
    A change of settings redoes all; else the first reason of a file wins: new, failed, pending OCR.
    """
    changed = F.lit(False)
    for c, v in settings.items():
        changed = changed | F.coalesce((F.col(c) != "") & (F.col(c) != v), F.lit(False))
    s = state.withColumn("_changed", changed)
    whole = s.groupBy(key).agg(F.max("_changed").alias("_all"), F.max("merge_state").alias("_merge"))
    both = files.join(s.select(key, "file", F.col("file_state").alias("_state"), "needs_ocr", "ocr_tried"), [key, "file"], "left")
    failed = file_failed(F.col("_state"))
    reason = F.when(F.col("_state").isNull(), "archivo_nuevo").when(failed, "fallo_modelo").when(F.col("needs_ocr") & ~F.col("ocr_tried"), "pendiente_ocr")
    each = both.withColumn("reason", reason).groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("reason").isNotNull(), F.struct("file", "reason"))))).alias("redo"), F.count("reason").alias("_n"))
    out = each.join(whole, key, "left")
    mode = F.when(F.col("_all").isNull() | F.col("_all"), "completo").when(F.col("_n") > 0, "parcial").when(~F.coalesce("_merge", F.lit("")).isin(*OK_STATES, *NEUTRAL_MERGES), "consolidar").otherwise("nada")
    return out.select(key, mode.alias("mode"), F.when(mode == "parcial", F.col("redo")).alias("redo"))


def survive(previous: DataFrame, rerun: DataFrame, key: list[str], failed: Column) -> DataFrame:
    """Results of a rerun, and previous ones where it failed or did not come to a key."""
    good = rerun.where(~failed)
    return good.unionByName(previous.join(good.select(*key).distinct(), key, "left_anti"), allowMissingColumns=True)


def _fs(spark, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _manifest(spark, path: str) -> dict[str, str]:
    """Bucket to folder, of the table at path as it is now."""
    p, fs = _fs(spark, f"{path}/current.json")
    if not fs.exists(p):
        return {}
    return json.loads("\n".join(r.value for r in spark.read.text(f"{path}/current.json").collect()))


def read_upserted(spark, path: str, schema) -> DataFrame:
    """The table that upsert_stream() keeps at path."""
    now = _manifest(spark, path)
    return spark.read.schema(schema).parquet(*[f"{path}/{d}/bucket={b}" for b, d in now.items()]) if now else spark.createDataFrame([], schema)


def upsert(batch: DataFrame, path: str, key: list[str], order: str, buckets: int = 64) -> None:
    """Merge a batch into the table at path, of which the latest row of each key stays.

    The table lies in buckets of a hash of the key; a batch rewrites those it has rows of, in a folder of its own, and then a small file that names the
    folder of each bucket is replaced. So a batch that fails half-way, or comes twice, or comes with a new checkpoint, changes nothing that it should not.
    """
    spark = batch.sparkSession
    rows = batch.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)))
    touched = sorted(str(r.bucket) for r in rows.select("bucket").distinct().collect())  # at most buckets
    if not touched:
        return
    now = _manifest(spark, path)
    old = [f"{path}/{now[b]}/bucket={b}" for b in touched if b in now]
    if old:
        before = spark.read.schema(batch.schema).parquet(*old)
        rows = rows.unionByName(before.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets))))
    version = f"v-{uuid.uuid4().hex}"
    latest(rows, [*key, "bucket"], order).select(*batch.columns, "bucket").repartition(min(len(touched), buckets), "bucket").write.partitionBy("bucket").parquet(f"{path}/{version}")
    new = now | dict.fromkeys(touched, version)
    p, fs = _fs(spark, f"{path}/next-{version}.json")
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(new).encode()))
    out.close()
    current, _ = _fs(spark, f"{path}/current.json")
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(current.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(p, current, options)
    for gone in {f"{now[b]}/bucket={b}" for b in touched if b in now}:
        _fs(spark, f"{path}/{gone}")[1].delete(_fs(spark, f"{path}/{gone}")[0], True)


def upsert_stream(stream: DataFrame, path: str, key: list[str], order: str, checkpoint: str, buckets: int = 64):
    """Keep the latest row of each key in the table at path, batch by batch; read_upserted() reads it."""
    merge = lambda batch, _: upsert(batch, path, key, order, buckets)
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def pair_log(log: DataFrame, key: list[str]) -> DataFrame:
    """Each start of a log (key, event, ts) with the end or error that follows before the next start; open ones have none."""
    w = W.partitionBy(*key).orderBy("ts", "event_id")
    marked = log.withColumns({"_next": F.lead("event").over(w), "ended": F.lead("ts").over(w)})
    done = F.col("_next").isin("end", "error")
    return marked.where("event = 'start'").select(*key, F.col("ts").alias("started"), F.when(done, F.col("ended")).alias("ended"), F.when(done, F.col("_next")).alias("outcome"))


def count_stream(stream: DataFrame, by: str, window: str = "1 day", late: str = "1 day") -> DataFrame:
    """Events by window and kind with a watermark."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", window), by).agg(F.count("*").alias("n"))


def retry(run: Callable[[], int], passes: int = 3) -> int:
    """Run until nothing is left or passes are used; returns what is left."""
    left = 1
    while left and passes:
        left, passes = run(), passes - 1
    return left


# ------------------------------------------------------------------ months


def repair_plan(offers: DataFrame, files: DataFrame, key: list[str]) -> DataFrame:
    """(key, supplier, missing): the kinds of attachments that an offer (key, supplier, links map) names and of which there is no file (key, supplier, kind)."""
    named = offers.select(*key, "supplier", F.explode(F.map_keys("links")).alias("kind"))
    lost = named.join(files.select(*key, "supplier", "kind").distinct(), [*key, "supplier", "kind"], "left_anti")
    return lost.groupBy(*key, "supplier").agg(F.array_sort(F.collect_set("kind")).alias("missing"))


def reuse_files(previous: DataFrame, rerun: DataFrame, redo: DataFrame, key: list[str]) -> DataFrame:
    """Rows of files (key, file, ...) after a partial run: new ones of the files that were redone, previous ones of all others that are not to be redone."""
    kept = previous.join(redo.select(*key, "file").distinct(), [*key, "file"], "left_anti")
    return kept.join(rerun.select(*key, "file").distinct(), [*key, "file"], "left_anti").unionByName(rerun, allowMissingColumns=True)


def resume(queue: DataFrame, results: DataFrame, key: str = "codigo", state: str = "scraping_estado") -> DataFrame:
    """A work queue after a pass: results (key, state) replace the states of their rows."""
    new = results.groupBy(key).agg(F.max(state).alias("_new"))
    return queue.join(new, key, "left").withColumn(state, F.coalesce("_new", state)).select(*queue.columns)


def month_plan(months: DataFrame, done: DataFrame, first_run: bool = False) -> DataFrame:
    """What each month (mes) still needs: bajar, extraer or nada, by its marks (mes, step: bajado, extraido). A first run redoes all. While a month is extracted the next
    one that is to be fetched can be: overlap names it."""
    marks = done.groupBy("mes").agg(F.max(F.col("step") == "bajado").alias("_b"), F.max(F.col("step") == "extraido").alias("_e"))
    x = months.select("mes").distinct().join(marks, "mes", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("_b", "_e")})
    step = F.lit("bajar") if first_run else F.when(~F.col("_b"), "bajar").when(~F.col("_e"), "extraer").otherwise("nada")
    x = x.withColumn("step", step)
    later = W.orderBy("mes").rowsBetween(1, W.unboundedFollowing)  # a month is one row
    return x.withColumn("overlap", F.when(F.col("step") != "nada", F.first(F.when(F.col("step") == "bajar", F.col("mes")), ignorenulls=True).over(later))).select("mes", "step", "overlap")


def budgeted(rows: DataFrame, most: int, *order: str) -> DataFrame:
    """The first rows of a queue that is worked off in bounded batches."""
    return rows.orderBy(*order).limit(most)
