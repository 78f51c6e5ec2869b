"""SimHash near-dedup: pigeonhole blocks, join on blocks, verify the Hamming distance, connected components.

Two searches share the machinery. links_within() is exact for 64-bit fingerprints and a small distance. near_dedup()
finds documents whose five-word shingles are alike to 0.8 or more; such pairs differ in too many bits of a 64-bit
fingerprint for exact pigeonhole blocks, so it takes bands of min-hashes of the shingles as blocks, decides most pairs by the Hamming
distance of a long shingle fingerprint, and computes the similarity of those that the distance leaves open.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import components, partitions, spread_join, stage, unstage, with_columns

SEED = 42
#: Members of a block up to which it is searched in one task; larger ones are dealt out further.
TASK_MEMBERS = 2048
#: Members of a larger block that each of its parts has too.
ANCHORS = 64

# ---------------------------------------------------------------- fingerprints


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """XXH64 of each run of width words, joined by single blanks; of the whole sequence if it is shorter."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    return np.fromiter((digest(line[a : b - 1], SEED) for a, b in zip(starts, ends[width - 1 :], strict=False)), dtype=np.uint64, count=len(words) - width + 1)


def _spread(h: np.ndarray, n: int) -> np.ndarray:
    """n pseudo-random 64-bit words for each hash (splitmix64)."""
    x = h[:, None] + np.arange(1, n + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bits(h: np.ndarray) -> np.ndarray:
    """Rows of 0/1, most significant bit first."""
    return np.unpackbits(np.ascontiguousarray(h.reshape(len(h), -1).astype(">u8")).view(np.uint8), axis=1)


def majority(h: np.ndarray, weights: np.ndarray | None = None) -> bytes:
    """A bit is 1 if it is set in over half of the rows of h, by weight."""
    width = h.shape[1] if h.ndim > 1 else 1
    if not len(h):
        return bytes(8 * width)
    sums, total = np.zeros(64 * width), 0.0
    for i in range(0, len(h), 4096):  # bounded memory for very long texts
        part = _bits(h[i : i + 4096])
        w = np.ones(len(part), np.float32) if weights is None else weights[i : i + 4096].astype(np.float32)
        sums += w @ part.astype(np.float32)
        total += float(w.sum())
    return np.packbits(2 * sums > total).tobytes()


def simhash64(text: str | None, width: int = 3) -> int:
    """64-bit SimHash of the word shingles, signed; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return int.from_bytes(majority(shingle_hashes(words, width)), "big", signed=True)


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp): the 64-bit SimHash of every row of docs; null and empty texts have 0."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_columns(rows, {"fp": "long"}, lambda texts: {"fp": [simhash64(t, width) for t in texts]}).drop("text")


# ---------------------------------------------------------------- search in blocks


def _linked(bits: np.ndarray, limit: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links that connect just those rows that chains of pairs within limit connect, and the group of each row. bits: rows of uint64.

    Each row is compared only with those not yet connected, so a group of near copies gives a link a member.
    """
    rest, out, group = np.arange(len(bits)), [], np.arange(len(bits))
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            x = frontier.pop()
            near = np.bitwise_count(bits[rest] ^ bits[x]).sum(axis=1) <= limit
            out += [(int(x), int(y)) for y in rest[near]]
            group[rest[near]] = group[x]
            frontier += rest[near].tolist()
            rest = rest[~near]
    return out, group


def _doubtful(bits: np.ndarray, group: np.ndarray, loose: int) -> np.ndarray:
    """Rows within loose of a row of another group."""
    if len(group) == 2:
        return np.full(2, bool(group[0] != group[1] and np.bitwise_count(bits[0] ^ bits[1]).sum() <= loose))
    if (group == group[0]).all():
        return np.zeros(len(group), bool)
    return np.array([bool(((np.bitwise_count(bits ^ bits[x]).sum(axis=1) <= loose) & (group != group[x])).any()) for x in range(len(group))])


def _settled(bits: np.ndarray, sets: list[np.ndarray], sure: int, loose: int, similarity: float) -> list[tuple[int, int]]:
    """Links between rows that differ in over sure and at most loose bits and whose sets are alike, nearest first; pairs that links connect
    already are not compared."""
    group = _linked(bits, sure)[1]
    out = []
    for x in range(len(group) - 1):
        apart = np.bitwise_count(bits[x + 1 :] ^ bits[x]).sum(axis=1)
        near = np.flatnonzero((apart <= loose) & (group[x + 1 :] != group[x]))
        for y in (near[np.argsort(apart[near], kind="stable")] + x + 1).tolist():
            if group[y] != group[x] and jaccard(sets[x], sets[y]) >= similarity:
                out.append((x, y))
                group[group == group[y]] = group[x]
    return out


def _in_groups(rows: DataFrame, key: str, f: Callable[[np.ndarray, pd.DataFrame], Iterable[tuple]], schema: str) -> DataFrame:
    """f(bits, rows) for each group of rows (key, node, bits and others) of more than one, streamed over sorted partitions. Groups are small."""
    ordered = rows.repartition(partitions(rows.sparkSession), key).sortWithinPartitions(key, "node")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def found(whole: pd.DataFrame) -> pd.DataFrame:
            keys, out = whole[key].to_numpy(), []
            bits = np.frombuffer(b"".join(whole["bits"]), dtype=np.uint64).reshape(len(whole), -1)
            cut = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True]))).tolist()
            for a, b in itertools.pairwise(cut):
                if b - a > 1:
                    out += f(bits[a:b], whole.iloc[a:b])
            return pd.DataFrame(out, columns=names)

        for pdf in batches:
            if not len(pdf):
                continue
            last = pdf[key].iloc[-1]
            if pdf[key].iloc[0] == last and (not held or held[-1][key].iloc[-1] == last):
                held.append(pdf)
                continue
            open_ = (pdf[key] == last).to_numpy()
            yield found(pd.concat([*held, pdf[~open_]]))
            held = [pdf[open_]]
        if held:
            yield found(pd.concat(held))

    return ordered.mapInPandas(run, schema)


def _grouped_links(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """Links (a, b) inside each group of rows (key, node, bits binary) that connect what pairs within limit connect."""

    def links(bits: np.ndarray, group: pd.DataFrame) -> list[tuple[int, int]]:
        nodes = group["node"].to_numpy()
        return [(int(nodes[x]), int(nodes[y])) for x, y in _linked(bits, limit)[0]]

    return _in_groups(rows.select(key, "node", "bits"), key, links, "a long, b long")


def _members(keys: DataFrame) -> DataFrame:
    """keys (k, node) of blocks with more than one member, with the count n."""
    counts = keys.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    return keys.join(counts, "k")


def block_masks(limit: int, n: int, bits: int = 64) -> list[int]:
    """Masks such that any two values that differ in at most limit bits agree under one of them.

    bits is split into limit + r parts; a mask keeps r of them. r grows until a mask keeps more bits than it takes to tell n
    values apart, so blocks stay small at any size.
    """
    need = math.log2(max(n, 2)) + 2
    for r in range(1, 8):
        parts = limit + r
        edges = [round(i * bits / parts) for i in range(parts + 1)]
        masks = [sum(((1 << edges[i + 1]) - (1 << edges[i])) for i in c) for c in itertools.combinations(range(parts), r)]
        if min(m.bit_count() for m in masks) >= need:
            break
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links_within(classes: DataFrame, limit: int = 2, task_members: int = TASK_MEMBERS) -> DataFrame:
    """Links (a, b) among the distinct 64-bit values fp of classes that connect just what pairs within limit bits connect.

    Exact. A block of more than task_members values is not searched in one task: for limit 2 each of its values is dealt to
    the values one flipped bit away, where values within two bits meet in groups of at most 65.
    """
    assert limit == 2 or task_members >= 1 << 31, "the way for large blocks is for distance 2"
    n = classes.count()
    masks = block_masks(limit, n)
    table = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(_signed(m)).alias("m")) for i, m in enumerate(masks)])
    keys = classes.select(F.col("fp").alias("node"), F.explode(table).alias("x")).select("node", "x.i", "x.m")
    keys = keys.withColumn("k", F.xxhash64("i", F.col("node").bitwiseAND(F.col("m")))).select("k", "node", "m")
    members = stage(_members(keys))
    as_bits = F.unhex(F.lpad(F.hex("node"), 16, "0"))
    links = _grouped_links(members.where(F.col("n") <= task_members).select("k", "node", as_bits.alias("bits")), "k", limit)
    flips = F.array(F.lit(0), *[F.lit(_signed(1 << i)) for i in range(64)])
    free = F.filter(flips, lambda f: (f.bitwiseAND(F.col("m")) == 0))
    met = members.where(F.col("n") > task_members).select("k", "node", F.explode(free).alias("f")).groupBy("k", F.col("node").bitwiseXOR(F.col("f")).alias("z")).agg(F.array_sort(F.collect_list("node")).alias("g")).where(F.size("g") > 1)
    hot = met.select(F.col("g")[0].alias("a"), F.explode(F.slice("g", 2, 65)).alias("b"))
    return links.union(hot)


def near_components(docs: DataFrame, width: int = 3, limit: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) of every row of docs; component_id is the smallest doc_id that links reach.

    Rows with equal fingerprints are one class, so copies are never paired. Null and empty texts have fingerprint 0 and link
    like any other. Null doc_ids are kept, and are a component_id only where a component has no other. Repeated
    rows stay repeated. Other columns of docs are ignored.
    """
    prints = stage(fingerprints(docs, width))
    classes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    roots = components(links_within(classes, limit))
    of = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    least = of.groupBy("root").agg(F.min("least").alias("component_id"))
    of = stage(of.join(least, "root").select("fp", "component_id", "n"))
    return spread_join(prints, of, "fp", "n").select("doc_id", "fp", "component_id")


# ---------------------------------------------------------------- alike documents

SHINGLE = 5
SIMILARITY = 0.8
#: Bands of min-hashes and min-hashes of each: 0.9999 of the pairs alike to 0.8 agree in a band, whatever the edit.
BANDS, BAND_ROWS = 32, 6
#: 64-bit words of the shingle fingerprint that sorts pairs.
CHECK_WORDS = 8
#: Standard deviations of the fingerprint around the similarity within which pairs are computed.
DOUBT = 4
_FACTORS = _spread(np.array([SEED], np.uint64), BANDS * BAND_ROWS)[0] | np.uint64(1)


def hamming_limit(similarity: float = SIMILARITY, bits: int = 64 * CHECK_WORDS, deviations: float = 1) -> int:
    """Bits in which fingerprints of sets with that Jaccard similarity differ, plus standard deviations."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(bits * p + deviations * math.sqrt(bits * p * (1 - p)))


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    return np.unique(shingle_hashes((text or "").encode("utf-8", "surrogatepass").lower().split(), width))


def long_prints(text: str | None, width: int = SHINGLE) -> tuple[bytes, bytes]:
    """Hashes of the bands, eight bytes each, and the fingerprint that sorts pairs; both of the distinct shingles."""
    shingles = shingle_set(text, width)
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):
        x = shingles[i : i + 2048, None] * _FACTORS
        least = np.minimum(least, ((x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)).min(axis=0))
    band = np.zeros(BANDS, np.uint64)
    for column in least.reshape(BANDS, BAND_ROWS).T:
        band = (band ^ column) * np.uint64(0xBF58476D1CE4E5B9)
        band ^= band >> np.uint64(29)
    return band.astype(">u8").tobytes(), _majority_of(shingles, CHECK_WORDS, None)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sets of shingles; that of two empty ones is one."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(len(a) + len(b) - both, 1) if len(a) or len(b) else 1.0


def _majority_of(h: np.ndarray, n: int, weights: np.ndarray | None) -> bytes:
    sums, total = np.zeros(64 * n), 0.0
    for i in range(0, len(h), 2048):
        part = _bits(_spread(h[i : i + 2048], n)).astype(np.float32)
        w = np.ones(len(part), np.float32) if weights is None else weights[i : i + 2048]
        sums += w @ part
        total += float(w.sum())
    return np.packbits(2 * sums > total).tobytes()


def _text_hash():
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def _links(dealt: DataFrame, classes: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) inside the groups k of dealt (k, node) that connect what pairs alike to similarity connect.

    The distance of the fingerprints decides where it is DOUBT standard deviations from the one that similarity gives. Nodes with
    an open pair come again, in the groups in which they have one, with their shingles, and are compared exactly. Either
    step gives no more rows than a group has members.
    """
    sure, loose = hamming_limit(similarity, deviations=-DOUBT), hamming_limit(similarity, deviations=DOUBT)

    def near(bits: np.ndarray, group: pd.DataFrame) -> list[tuple[int, int, int]]:
        k, nodes = int(group["k"].iloc[0]), group["node"].to_numpy()
        links, of = _linked(bits, sure)
        # a node that is linked to itself has an open pair
        return [(k, int(nodes[x]), int(nodes[y])) for x, y in links] + [(k, int(x), int(x)) for x in nodes[_doubtful(bits, of, loose)]]

    def exact(bits: np.ndarray, group: pd.DataFrame) -> list[tuple[int, int]]:
        nodes = group["node"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in group["shingles"]]
        return [(int(nodes[x]), int(nodes[y])) for x, y in _settled(bits, sets, sure, loose, similarity)]

    met = stage(_in_groups(dealt.join(classes.select("node", "bits"), "node").select("k", "node", "bits"), "k", near, "k long, a long, b long"))
    links, open_ = met.where("a <> b").select("a", "b"), met.where("a = b").select("k", F.col("a").alias("node"))
    need = stage(classes.join(open_.select("node").distinct(), "node").select("node", "bits", F.col("first.doc_id").alias("_docrel_id"), F.col("first.h").alias("_docrel_h")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash().alias("h"), "text")
    texts = need.join(texts, texts["doc_id"].eqNullSafe(need["_docrel_id"]) & (texts["h"] == need["_docrel_h"])).select("node", "bits", "text").dropDuplicates(["node"])
    sets = stage(with_columns(texts, {"shingles": "binary"}, lambda ts: {"shingles": [shingle_set(t).tobytes() for t in ts]}).drop("text"))
    return links.union(_in_groups(open_.join(sets, "node").select("k", "node", "bits", "shingles"), "k", exact, "a long, b long"))


def _parts(hot: DataFrame, task_members: int) -> DataFrame:
    """(k, node): the members of large blocks (k, node, n) in parts of about task_members at most.

    The ANCHORS members with the least hashes are in every part, so the parts of one dense group are linked through them.
    """
    least = W.partitionBy("k").orderBy(F.xxhash64("node"), "node")
    parted = hot.withColumn("parts", F.expr(f"cast(n div {max(task_members - ANCHORS, 1)} + 1 as int)"))
    own = parted.select("k", "node", "parts", F.pmod(F.xxhash64("node", F.lit(1)), "parts").alias("part"))
    anchors = own.withColumn("i", F.row_number().over(least)).where(F.col("i") <= ANCHORS)
    more = anchors.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("other <> part").select("k", F.col("other").alias("part"), "node")
    return own.select("k", "part", "node").union(more).select(F.xxhash64("k", "part").alias("k"), "node")


def _across(hot: DataFrame, roots: DataFrame, task_members: int) -> DataFrame | None:
    """(k, node): pairs of parts of large blocks (k, node, n) that hold all pairs whose components differ; None if there are none.

    One of such a pair lies outside the block's largest component, so only members outside it meet all members. In a block of near copies that
    is next to none of them.
    """
    named = hot.join(roots, "node", "left").select("k", "node", "n", F.coalesce("root", "node").alias("root"))
    most = named.groupBy("k", "root").agg(F.count("*").alias("c")).groupBy("k").agg(F.max_by("root", F.struct("c", "root")).alias("most"), F.sum("c").alias("n"), F.max("c").alias("c"))
    most = stage(most.where("c < n").withColumn("rest", F.col("n") - F.col("c")))
    if most.isEmpty():
        return None
    half = max(task_members // 2, 1)
    named = named.drop("n").join(most.drop("c"), "k").withColumns({"o_parts": F.expr(f"cast(rest div {half} + 1 as int)"), "m_parts": F.expr(f"cast(n div {half} + 1 as int)")})
    named = named.withColumns({"o": F.pmod(F.xxhash64("node", F.lit(2)), "o_parts"), "m": F.pmod(F.xxhash64("node", F.lit(3)), "m_parts")})
    outside = named.where("root <> most").select("k", "node", "o", F.explode(F.sequence(F.lit(0), F.col("m_parts") - 1)).alias("m"))
    every = named.select("k", "node", F.explode(F.sequence(F.lit(0), F.col("o_parts") - 1)).alias("o"), "m")
    return outside.unionByName(every).select(F.xxhash64("k", "o", "m").alias("k"), "node").distinct()


def _keepers(docs: DataFrame, similarity: float, task_members: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows, and (doc_id, h) of the first row of each group of like texts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash().alias("h"), "text")

    def prints_of(texts: list[str | None]) -> dict[str, list]:
        both = [long_prints(t) for t in texts]
        return {"blocks": [b for b, _ in both], "bits": [c for _, c in both]}

    prints = stage(with_columns(rows, {"blocks": "binary", "bits": "binary"}, prints_of).drop("text"))
    classes = stage(prints.groupBy("blocks", "bits").agg(F.min(F.struct("doc_id", "h")).alias("first")).withColumn("node", F.xxhash64("blocks", "bits")))
    bands = F.array(*[F.xxhash64(F.lit(i), F.substring("blocks", 1 + 8 * i, 8)) for i in range(BANDS)])
    members = stage(_members(classes.select("node", F.explode(bands).alias("k"))))
    hot = members.where(F.col("n") > task_members)
    dealt, any_hot = members.where(F.col("n") <= task_members).select("k", "node"), not hot.isEmpty()
    if any_hot:
        dealt = dealt.union(_parts(hot, task_members))
    links = stage(_links(dealt, classes, docs, similarity))
    roots = stage(components(links))
    across = _across(hot, roots, task_members) if any_hot else None
    if across is not None:
        roots = components(links.union(_links(across, classes, docs, similarity)))
    of = classes.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("component")).agg(F.min("first").alias("first"))
    keep = stage(of.select(F.col("first.doc_id").alias("_docrel_id"), F.col("first.h").alias("_docrel_h")))
    for done in (links, members, classes):
        unstage(done)
    return prints, keep


def near_dedup(docs: DataFrame, similarity: float = SIMILARITY, task_members: int = TASK_MEMBERS) -> DataFrame:
    """docs without those whose five-word shingles are alike, to the given similarity, to those of a document that stays.

    Groups are connected components of such links; the row with the smallest doc_id (null first, then by a hash of the text) of
    each stays, once if rows repeat. Texts without words (null and empty ones too) form one group; texts of fewer than five words have one shingle.
    Columns stay as they are; an empty table gives an empty result. Texts count whole. Pairs that meet in a block
    are compared exactly unless their fingerprints are four standard deviations away: README.md has the share of pairs found.
    """
    prints, keep = _keepers(docs, similarity, task_members)
    out = docs.withColumn("_docrel_text_hash", _text_hash())
    out = out.join(keep, out["doc_id"].cast("long").eqNullSafe(keep["_docrel_id"]) & (out["_docrel_text_hash"] == keep["_docrel_h"]), "left_semi")
    if not prints.groupBy("doc_id", "h").count().where("count > 1").isEmpty():
        out = out.dropDuplicates(["doc_id", "_docrel_text_hash"])
    return out.select(*docs.columns)
