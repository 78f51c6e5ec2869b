"""Line dedup: explode normalised lines, hash, count documents per hash, drop, reassemble by position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, ascii_lower, spread_join, stage

MIN_CHARS = 20
MIN_DOCS = 3


def _key(line):
    """128-bit hash of the stripped line with A-Z lowered."""
    return F.unhex(F.md5(ascii_lower(F.trim(line, F.lit(BLANKS)))))


def _keys(min_chars: int):
    """Per line of the column text: its hash, or null if its key is short."""
    long = lambda x: F.char_length(F.trim(x, F.lit(BLANKS))) >= min_chars
    return F.transform(F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1), lambda x: F.when(long(x), _key(x)))


def _lines_of(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, h, line): the distinct keys of each row of docs; doc_id and h, a hash of the text, tell rows apart."""
    keys = F.array_distinct(F.array_compact(_keys(min_chars)))
    return docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.explode(keys).alias("line"))


def repeated_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(line, keeper, n): lines in at least min_docs rows, the largest doc_id with the line, and the number of rows.

    Counts combine before the shuffle, so a line in a third of all documents is one row per map task.
    """
    counts = lines.groupBy("line").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
    return counts.where(F.col("n") >= min_docs).select("line", "keeper", "n")


def _parted(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """docs with _docrel_lines and _docrel_kept: all lines of the text, and those that stay."""
    lines = stage(_lines_of(docs, min_chars))
    repeated = stage(repeated_lines(lines, min_docs))
    found = spread_join(lines, repeated, "line", "n")
    lost = (
        found.where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc_id").alias("_docrel_id"), F.col("h").alias("_docrel_h")).agg(F.collect_set("line").alias("_docrel_lost"))
    )
    same = docs["doc_id"].eqNullSafe(lost["_docrel_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == lost["_docrel_h"])
    both = docs.join(lost, same, "left")
    both = both.withColumn("_docrel_lines", F.split(F.coalesce("text", F.lit("")), "\n", -1)).withColumn("_docrel_keys", F.when(F.col("_docrel_lost").isNotNull(), _keys(min_chars)))
    stays = lambda x, i: ~F.coalesce(F.array_contains(F.col("_docrel_lost"), F.get(F.col("_docrel_keys"), i)), F.lit(False))
    kept = F.when(F.col("_docrel_lost").isNull(), F.col("_docrel_lines")).otherwise(F.filter("_docrel_lines", stays))
    return both.withColumn("_docrel_kept", kept)


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """docs (doc_id, text, any other columns) with repeated lines taken out of text.

    Adds n_lines (before), n_dropped and replaces text by the kept lines; all other columns stay as they are. A row
    is a document. Null text is one empty line and becomes the empty text. A null doc_id is less than any other, so its lines lose
    against those of any numbered document; rows that share the largest doc_id all keep the line. Empty input gives
    empty output. Columns named n_lines or n_dropped are replaced.
    """
    both, total, kept = _parted(docs.drop("n_lines", "n_dropped"), min_chars, min_docs), F.size("_docrel_lines"), F.size("_docrel_kept")
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    out = [F.array_join("_docrel_kept", "\n").alias(c) if c == "text" else F.col(f"`{c}`") for c in columns]
    return both.select(*out, total.cast("long").alias("n_lines"), (total - kept).cast("long").alias("n_dropped"))


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """docs with the text that line_dedup() leaves, and all other columns as they are."""
    out = [F.array_join("_docrel_kept", "\n").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return _parted(docs, min_chars, min_docs).select(*out)
