"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..store import scratch, stage, unstage

__all__ = ["ascii_lower", "chosen_rows", "components", "crc_mod", "partitions", "pieces", "read", "scratch", "spread_join", "stage", "unstage", "with_columns"]

#: Characters of text, about, that an operator holds in derived form at once. Spark itself ends an Arrow batch at 64 MB.
PIECE_CHARS = 4 << 20
#: A key with over one part in so many of all rows is joined by broadcast; there can be no more such keys than this.
HOT_KEYS = 1024
#: Edges of a graph up to which one task can take all of a node.
MANY_EDGES = 1 << 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def pieces(texts: list, chars: int = PIECE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts in order, of about so many characters at most; a longer text comes alone."""
    begin = total = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > begin and total + n > chars:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(texts):
        yield begin, len(texts)


def with_columns(docs: DataFrame, new: dict[str, str], f: Callable[[list[str | None]], dict[str, list]]) -> DataFrame:
    """docs with the columns new (name: DDL type), which f computes from a list of texts. Columns of these names are replaced.

    Batches stay in Arrow, so all other columns pass as they are, and f sees about PIECE_CHARS characters at a time.
    """
    docs = docs.drop(*new)
    schema = StructType([*docs.schema, *StructType.fromDDL(", ".join(f"`{k}` {v}" for k, v in new.items()))])
    types = to_arrow_schema(StructType.fromDDL(", ".join(f"`{k}` {v}" for k, v in new.items())))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for a, b in pieces(texts):
                found = f(texts[a:b])
                made = [pa.array(found[k.name], type=k.type) for k in types]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*docs_columns, *types.names])

    docs_columns = docs.columns
    return docs.mapInArrow(run, schema)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(c):
    """Lower-case A-Z only. lower() does just that to pure ASCII and is far faster than translate()."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def crc_mod(column: str, n: int):
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def spread_join(rows: DataFrame, table: DataFrame, key: str | list[str], n: str) -> DataFrame:
    """rows joined (inner) to table, which has one row a key and in column n how many rows have it.

    Keys with over 1 / HOT_KEYS of the sum of n, of which there are fewer than HOT_KEYS, are broadcast, so none of them gathers in one
    task; the others shuffle. table is read several times. Rows keep their order of columns, then come table's other columns without n.
    """
    keys = [key] if isinstance(key, str) else key
    most = max(int(table.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]) // HOT_KEYS, 1)
    hot, rest = table.where(F.col(n) > most).drop(n), table.where(F.col(n) <= most).drop(n)
    cold = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    more = [c for c in table.columns if c not in (*keys, n)]
    out = rows.join(F.broadcast(hot), keys).unionByName(cold.join(rest, keys))
    return out.select(*rows.columns, *more)


def chosen_rows(rows: DataFrame, max_rows: int, total: int | None = None) -> DataFrame:
    """At most max_rows distinct rows of rows, chosen by a hash of their columns, which comes as column o. Equal rows count once.

    Rows whose hash is over a share that lets about max_rows pass are left out before anything is shuffled or sorted, so the bound
    holds for all tasks together, whatever ids repeat. total: the number of rows, if known.
    """
    o = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    total = rows.count() if total is None else total
    share = min(1.0, 1.2 * max_rows / max(total, 1))
    few = rows.withColumn("o", o).where(F.pmod(F.col("o"), F.lit(1 << 31)) < int(share * (1 << 31)))
    one = few.groupBy("o").agg(*[F.first(F.col(f"`{c}`")).alias(c) for c in rows.columns])
    return one.orderBy("o").limit(max_rows)


def components(edges: DataFrame, a: str = "a", b: str = "b", many: int = MANY_EDGES) -> DataFrame:
    """Connected components by alternating large and small stars.

    edges: two long columns. Returns (node, root): each node of an edge and the smallest node it reaches. Each round
    is two joins with aggregates on the edges that are left; links stay in tables in the shared folder and the
    driver sees two sums a round. With over many edges, the hubs of large components are joined by broadcast (spread_join()). Null ends
    and loops are dropped.
    """
    whole = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    e = stage(whole.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct())
    sign = None

    def with_least(rows: DataFrame, own: bool) -> DataFrame:
        """rows (u, v) with m, the least v of each u, or u itself where own says so and that is less."""
        m = F.least("u", F.min("v")) if own else F.min("v")
        least = rows.groupBy("u").agg(m.alias("m"), F.count("*").alias("n"))
        return spread_join(rows, stage(least), "u", "n") if now[0] > many else rows.join(least.drop("n"), "u")

    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == sign or not now[0]:
            break
        sign = tuple(now)
        both = e.select("u", "v").union(e.select(F.col("v"), F.col("u")))
        large = with_least(both, True).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        moved = with_least(large, False)
        small = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(moved.select("u", F.col("m"))).where("u != v").distinct()
        old, e = e, stage(small)
        unstage(old)
    roots = e.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
