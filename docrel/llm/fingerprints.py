"""Document fingerprints by locally consistent parsing.

Deterministic coin tossing cuts a text into phrases whose ends depend on a few neighbouring symbols only; each phrase gets
a name, names are parsed again, and so on. Equal substrings thus share the names in their interior wherever they lie. A
fingerprint holds min-hashes of the names of the second and third level (and of the first, for short texts).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import partitions, pieces

#: Min-hashes a level, of one byte each.
HASHES = 64
#: A level is compared if both texts have so many phrases there; a lower level is kept where a higher has few.
LEAST, MANY = 8, 64
#: Symbols that are parsed at once.
BLOCK = 1 << 20

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = (np.arange(1, HASHES + 1, dtype=np.uint64) * _B) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _cuts(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where phrases begin: at runs of one symbol, after them, and at local maxima of the labels between runs. starts: where texts
    begin; nothing depends on a symbol of another text."""
    n, one = len(x), np.uint64(1)
    begins = np.zeros(n, dtype=bool)
    begins[starts] = True
    left_same = np.empty(n, dtype=bool)
    left_same[0] = False
    np.equal(x[1:], x[:-1], out=left_same[1:])
    left_same &= ~begins
    run = left_same.copy()
    run[:-1] |= left_same[1:]
    first = begins.copy()
    first[1:] |= run[:-1]
    first &= ~run
    label = x
    for _ in range(4):  # 64 bits -> 7 -> 4 -> 3 -> six labels
        left = np.empty_like(label)
        left[0] = label[0] ^ one
        left[1:] = label[:-1]
        left[first] = label[first] ^ one
        d = label ^ left
        low = np.bitwise_count((d & (~d + one)) - one).astype(np.uint64)
        low[run] = 0
        label = (low << one) | ((label >> low) & one)
    cut = first | (run & ~left_same)
    if n > 2:
        free = ~(run | begins)
        peak = free[1:-1] & ~first[1:-1] & ~run[:-2] & ~run[2:] & ~begins[2:]
        cut[1:-1] |= peak & (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    return cut


def parse_many(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The names of the phrases of texts laid end to end, in order, and where each text's begin."""
    at = np.flatnonzero(_cuts(x, starts))
    lens = np.diff(np.append(at, len(x)))
    off = np.arange(1, len(x) + 1, dtype=np.uint64) - np.repeat(at, lens).astype(np.uint64)
    return _mix(np.add.reduceat(_mix(x + _A * off), at) + lens.astype(np.uint64)), np.searchsorted(at, starts)


def parse(x: np.ndarray) -> np.ndarray:
    """The names of the phrases of one text, in blocks: memory beyond x and the result is bounded."""
    n, zero = len(x), np.zeros(1, np.int64)
    if n <= BLOCK:
        return parse_many(x, zero)[0]
    found = []
    for a in range(0, n, BLOCK):
        lo = max(0, a - 8)
        c = np.flatnonzero(_cuts(x[lo : a + BLOCK + 2], zero)) + lo
        found.append(c[(c >= a) & (c < a + BLOCK)])
    at, out = np.concatenate(found), []
    lens, edges = np.diff(np.append(at, n)), np.searchsorted(at, np.arange(0, n, BLOCK))
    for i, j in zip(edges, [*edges[1:], len(at)], strict=True):
        if i < j:
            a, b = at[i], at[j] if j < len(at) else n
            off = np.arange(a + 1, b + 1, dtype=np.uint64) - np.repeat(at[i:j], lens[i:j]).astype(np.uint64)
            out.append(_mix(np.add.reduceat(_mix(x[a:b] + _A * off), at[i:j] - a) + lens[i:j].astype(np.uint64)))
    return np.concatenate(out)


def _minhash(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A row of HASHES bytes for each text."""
    least = np.empty((HASHES, len(starts)), dtype=np.uint64)
    for j, odd in enumerate(_ODD):
        least[j] = np.minimum.reduceat(names * odd, starts)
    return (_mix(least) >> np.uint64(56)).astype(np.uint8).T


def _symbols(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)


def _together(texts: list[str]) -> list[str]:
    """Fingerprints of non-empty texts; all in one array unless a text is longer than a block."""
    if len(texts) == 1 and len(texts[0]) > BLOCK:
        x, starts = _symbols(texts[0]), np.zeros(1, np.int64)
        levels = []
        for _ in range(3):
            x = parse(x)
            levels.append((x, starts))
    else:
        x, starts = _symbols("".join(texts)), np.cumsum([0] + [len(t) for t in texts[:-1]])
        levels = []
        for _ in range(3):
            x, starts = parse_many(x, starts)
            levels.append((x, starts))
    kept: list[list[str]] = [[] for _ in texts]
    need = np.arange(len(texts))
    for level in (3, 2, 1):
        names, starts = levels[level - 1]
        counts = np.diff(np.append(starts, len(names)))
        if len(need) == len(texts):
            rows = _minhash(names, starts)
        else:  # only the texts with few phrases above
            rows = _minhash(names[np.repeat(np.isin(np.arange(len(texts)), need), counts)], np.cumsum(np.concatenate(([0], counts[need][:-1]))))
        for i, row in zip(need.tolist(), rows, strict=True):
            kept[i].append(f"{level}:{counts[i]}:{row.tobytes().hex()}")
        need = need[counts[need] < MANY]
        if not len(need):
            break
    return [" ".join(k) for k in kept]


def fingerprints(texts: list[str | None]) -> list[str]:
    """level:phrases:hex by level, joined by blanks; '' for null and empty texts. Depends on each text alone."""
    out, group, size = [""] * len(texts), [], 0

    def flush() -> None:
        if group:
            for i, f in zip(group, _together([texts[i] for i in group]), strict=True):
                out[i] = f

    for i, t in enumerate(texts):
        if not t:
            continue
        if group and size + len(t) > BLOCK // 8:
            flush()
            group, size = [], 0
        group.append(i)
        size += len(t)
    flush()
    return out


def fingerprint(text: str | None) -> str:
    return fingerprints([text])[0]


def likeness(a: str, b: str) -> float:
    """Estimated share of phrase names in common, at the highest level at which both have enough; 0 to 1."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    x, y = ({int(p[0]): p.split(":")[1:] for p in f.split(" ")} for f in (a, b))
    shared = sorted(x.keys() & y.keys(), reverse=True)
    level = next((k for k in shared if min(int(x[k][0]), int(y[k][0])) >= LEAST), shared[-1])
    same = np.frombuffer(bytes.fromhex(x[level][1]), np.uint8) == np.frombuffer(bytes.fromhex(y[level][1]), np.uint8)
    return float(max(0.0, (same.mean() - 1 / 256) / (1 - 1 / 256)))


def edited(text: str, following: str) -> str:
    """text with its last quarter (rounded down) replaced by as much of the beginning of the following one."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def _bounds(marks: list[int]) -> list[tuple[int, int]]:
    """Distinct ends of ranges (doc_id, hash of text) from ascending quantiles of doc_id. A doc_id that is several quantiles has that share of
    all rows, and is cut into as many ranges of the hash and one more."""
    out = []
    for k in sorted(set(marks)):
        c = marks.count(k)
        out += [(k, -(1 << 63) + i * ((1 << 64) // c)) for i in range(c)]
    return out


def with_next(docs: DataFrame, per_rows, schema: str) -> DataFrame:
    """per_rows(list of (text, next text)) for all rows, as dicts with the fields of schema, in ascending order of
    doc_id; the last row's next is the first.

    Rows are dealt by ranges of doc_id, and of a hash of the text where one doc_id has many rows; the first row of each range
    also goes to the range before, so texts are shuffled once and no task sees more than its range. Ties of doc_id are ordered by a hash of the text; null doc_ids come first.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = partitions(spark)
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    slim = slim.withColumn("h", F.xxhash64("text"))
    marks = sorted(slim.select(key.cast("double").alias("k")).approxQuantile("k", [i / n for i in range(1, n)], 0.1 / n)) if n > 1 else []
    bounds = _bounds([min(int(m), (1 << 63) - 1) for m in marks])

    # halving: log2(n) comparisons a row
    def bucket(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        k, h = bounds[mid]
        return F.when((key < F.lit(k)) | ((key == F.lit(k)) & (F.col("h") < F.lit(h))), bucket(lo, mid)).otherwise(bucket(mid + 1, hi))

    slim = slim.withColumn("part", bucket(0, len(bounds)))
    firsts = sorted((r.part, r.m.k, r.m.h) for r in slim.groupBy("part").agg(F.min(F.struct(key.alias("k"), "h")).alias("m")).collect())  # one row a part
    if not firsts:
        return spark.createDataFrame([], f"doc_id long, {schema}")
    before = {p: firsts[i - 1][0] for i, (p, _, _) in enumerate(firsts)}
    heads = spark.createDataFrame([(p, k, h, before[p]) for p, k, h in firsts], "part int, k long, hh long, prior int")
    both = slim.join(F.broadcast(heads), "part")  # one row a part
    is_head = (key == F.col("k")) & (F.col("h") == F.col("hh"))
    targets = F.when(is_head, F.array(F.struct(F.col("part").alias("p"), F.lit(False).alias("halo")), F.struct(F.col("prior").alias("p"), F.lit(True).alias("halo")))).otherwise(F.array(F.struct(F.col("part").alias("p"), F.lit(False).alias("halo"))))
    dealt = both.select("doc_id", "text", "h", F.explode(targets).alias("t")).select("t.p", "t.halo", "doc_id", "h", "text")
    ordered = dealt.repartition(n, "p").sortWithinPartitions("p", "halo", F.asc_nulls_first("doc_id"), "h")

    out = to_arrow_schema(StructType.fromDDL(f"doc_id long, {schema}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, which waits for its next
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("p", "halo", "doc_id", "text")]
            for a, b in pieces(columns[3]):
                ids, pairs = [], []
                for row in zip(*[c[a:b] for c in columns], strict=True):
                    if held is not None and held[0] == row[0] and not held[1]:
                        ids.append(held[2])
                        pairs.append((held[3], row[3]))
                    held = row
                if ids:
                    found = per_rows(pairs)
                    made = {"doc_id": ids} | {k: [r[k] for r in found] for k in found[0]}
                    yield pa.RecordBatch.from_arrays([pa.array(made[f.name], type=f.type) for f in out], schema=out)

    return ordered.mapInArrow(run, f"doc_id long, {schema}")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row of docs.

    Null texts are empty; empty texts have the fingerprint ''; two empty texts are alike to 1. A table of one row is its own
    next. Rows that share a doc_id follow each other by a hash of the text, rows that are equal in any order; null doc_ids come
    first. Texts count whole, however long; an empty table gives an empty result. Other columns are not kept.
    """
    def rows(pairs: list[tuple[str, str]]) -> list[dict]:
        changed = [edited(a, b) for a, b in pairs]
        texts = list(dict.fromkeys(t for p in pairs for t in p)) + changed
        prints = fingerprints(texts)
        of = dict(zip(texts, prints, strict=True))
        out = []
        for (a, b), new, f in zip(pairs, changed, prints[len(prints) - len(changed) :], strict=True):
            digest = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
            out.append({"n_chars": len(a), "edited_sha256": digest, "fingerprint": of[a], "edited_fingerprint": f, "near_edited": likeness(of[a], f), "near_next": likeness(of[a], of[b])})
        return out

    return with_next(docs, rows, "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
