"""Suffix-array dedup as a common-prefix-aware distributed merge sort.

A byte goes if a string of LENGTH bytes over it also starts in a document with a smaller doc_id. Every such string holds an anchor:
the least hashed K-gram of its first LENGTH - K + 1 places, which depends on its bytes alone. So only the suffixes at anchors are sorted:

1. Chunks of documents announce the hashes of their anchors' K-grams; those no other document has are left out, as
   no string around them can be shared (what distributed string sorters do with unique prefixes).
2. Each chunk sorts its other suffixes and sends front-coded runs (common prefix lengths and the rest) by ranges of the sort order; equal suffixes
   with equal left context go once, with the least doc_id.
3. Each range merges its runs with a loser tree over common prefix lengths. In the merged order, neighbours' lengths tell which suffixes
   share 20 to 50 bytes to the right; the left contexts tell the rest. The answer for each item is a mask of the strings around the anchor that
   an earlier document has.
4. The chunks turn masks into removed bytes.
"""

from __future__ import annotations

import bisect
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, stage

LENGTH, K = 50, 20
LEFT = LENGTH - K
#: Bytes of text in a chunk, about, and in one call of the anchor search.
CHUNK, BLOCK = 8 << 20, 4 << 20
#: Suffixes that set the ends of ranges, per range.
SAMPLES = 60

_RNG = np.random.default_rng(2024)
_TABLE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POW = {n: np.uint64(pow(_BASE, n, 1 << 64)) for n in (1, 2, 4, 8)}
_HASH_BITS = 48
_WEIGHTS = _RNG.integers(0, 1 << 63, LENGTH + LEFT + 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Anchors whose surroundings are looked at together.
RECORDS = 1 << 15


def _pack(x, level: int = 3) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(pickle.dumps(x, protocol=5))


def _unpack(b: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(b))


def _planes(x: np.ndarray) -> bytes:
    """Whole numbers byte plane by byte plane: planes of zeros compress to nothing."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplanes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _slide(x: np.ndarray, w: int, f) -> np.ndarray:
    """f over each window of w neighbours."""
    size = 1
    while size * 2 <= w:
        x = f(x[:-size], x[size:])
        size *= 2
    return f(x[: len(x) - (w - size)], x[w - size :]) if size < w else x


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of a document's strings, ascending, and the hashes of their K-grams."""
    n, places, hashes = len(data), [], []
    for a in range(0, max(0, n - LENGTH + 1), BLOCK):
        x = _TABLE[np.frombuffer(data, np.uint8, min(BLOCK + LENGTH - 1, n - a), a)]
        h2 = x[:-1] * _POW[1] + x[1:]
        h4 = h2[:-2] * _POW[2] + h2[2:]
        h8 = h4[:-4] * _POW[4] + h4[4:]
        h16 = h8[:-8] * _POW[8] + h8[8:]
        h = h16[: len(x) - K + 1] * _POW[4] + h4[16:]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        least = _slide(h, LEFT + 1, np.minimum)
        pad = np.zeros(LEFT, np.uint64)
        at = np.flatnonzero(_slide(np.concatenate((pad, least, pad)), LEFT + 1, np.maximum) == h)
        places.append(at + a)
        hashes.append(h[at])
    if len(places) == 1:
        return places[0], hashes[0]
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at, first = np.unique(np.concatenate(places), return_index=True)  # blocks overlap
    return at, np.concatenate(hashes)[first]


class Chunk:
    """Documents of a chunk with the anchors of each."""

    def __init__(self, keys, blob: bytes):
        self.keys = np.array(keys, dtype=np.int64)
        self.texts: list[bytes] = _unpack(blob)
        found = [anchors(t) for t in self.texts]
        self.doc = np.repeat(np.arange(len(found)), [len(p) for p, _ in found])
        self.at = np.concatenate([p for p, _ in found] + [np.empty(0, np.int64)]).astype(np.int64)
        self.hash = np.concatenate([h for _, h in found] + [np.empty(0, np.uint64)]) >> np.uint64(64 - _HASH_BITS)
        self.unique, self.which = np.unique(self.hash, return_inverse=True)

    def several(self) -> np.ndarray:
        """Which of unique lie in documents with different keys of this chunk."""
        lo, hi = np.full(len(self.unique), np.iinfo(np.int64).max), np.full(len(self.unique), np.iinfo(np.int64).min)
        k = self.keys[self.doc]
        np.minimum.at(lo, self.which, k)
        np.maximum.at(hi, self.which, k)
        return lo < hi

    def items(self, shared: np.ndarray) -> tuple[list[tuple[bytes, bytes]], list[int], np.ndarray]:
        """Sorted distinct (suffix, reversed left context) at shared anchors, the least key of each, and (doc, place, item)."""
        d, q = self.doc[shared], self.at[shared]
        sizes = np.array([len(t) for t in self.texts], dtype=np.int64)
        pad = bytes(LENGTH)
        data = np.frombuffer(pad + pad.join(self.texts) + pad, np.uint8)
        begin = LENGTH + np.concatenate(([0], np.cumsum(sizes + LENGTH)))[:-1]

        def records(rows: np.ndarray) -> np.ndarray:
            around = data[(begin[d[rows]] + q[rows])[:, None] + np.arange(-LEFT, LENGTH)]
            return np.column_stack([around, np.minimum(sizes[d[rows]] - q[rows], LENGTH), np.minimum(q[rows], LEFT)]).astype(np.uint8)

        blocks = [np.arange(i, min(i + RECORDS, len(d))) for i in range(0, len(d), RECORDS)]
        digest = np.concatenate([(records(b) * _WEIGHTS).sum(axis=1, dtype=np.uint64) for b in blocks] + [np.empty(0, np.uint64)])
        _, first, which = np.unique(digest, return_index=True, return_inverse=True)
        if not all((records(b) == records(first[which[b]])).all() for b in blocks):  # two records with one digest
            every = np.concatenate([np.ascontiguousarray(records(b)).view(f"V{LEFT + LENGTH + 2}").ravel() for b in blocks])
            _, first, which = np.unique(every, return_index=True, return_inverse=True)
        found = []
        for doc, at in zip(d[first].tolist(), q[first].tolist(), strict=True):
            t = self.texts[doc]
            found.append((t[at : at + LENGTH], t[max(0, at - LEFT) : at][::-1]))
        least = np.full(len(found), np.iinfo(np.int64).max)
        np.minimum.at(least, which, self.keys[d])
        order = sorted(range(len(found)), key=found.__getitem__)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return [found[i] for i in order], least[order].tolist(), np.column_stack([d, q, rank[which]]).reshape(-1, 3)


def encode_run(items: list[tuple[bytes, bytes]], keys: list[int]) -> bytes:
    """A front-coded run: common prefix lengths, the rest of each suffix, left contexts, keys."""
    lens = np.array([len(s) for s, _ in items], dtype=np.uint8)
    a = np.frombuffer(b"".join(s.ljust(LENGTH, b"\0") for s, _ in items), np.uint8).reshape(-1, LENGTH)
    lcp = np.zeros(len(items), np.uint8)
    if len(items) > 1:
        lcp[1:] = np.minimum((a[1:] == a[:-1]).cumprod(axis=1, dtype=np.uint8).sum(axis=1), np.minimum(lens[1:], lens[:-1]))
    rest = b"".join(s[n:] for (s, _), n in zip(items, lcp.tolist(), strict=True))
    return _pack((lens.tobytes(), lcp.tobytes(), rest, bytes(len(c) for _, c in items), b"".join(c for _, c in items), _planes(np.array(keys, dtype=np.int64).view(np.uint64))))


class Run:
    def __init__(self, blob: bytes):
        lens, self.lcp, rest, left_lens, left, keys = _unpack(blob)
        self.strings, self.left, at, s = [], [], 0, b""
        for n, m in zip(lens, self.lcp, strict=True):
            s = s[:m] + rest[at : at + n - m]
            at += n - m
            self.strings.append(s)
        at = 0
        for n in left_lens:
            self.left.append(left[at : at + n])
            at += n
        self.keys = _unplanes(keys).view(np.int64)


def merge(runs: list[tuple[list[bytes], bytes]]) -> tuple[list[int], list[int], list[int]]:
    """Merge sorted runs (strings, common prefix lengths with the string before) with a loser tree.

    Returns run, place and common prefix length with the output before, in sorted order. The head of a run carries its common prefix
    length with the winner that beat it; of two heads the one with the longer is smaller, and only where the lengths tie are characters
    compared, from there on.
    """
    k = 1
    while k < max(1, len(runs)):
        k *= 2
    heads: list[bytes | None] = [r[0][0] if r[0] else None for r in runs] + [None] * (k - len(runs))
    h, pos = [0] * k, [0] * k
    size = [len(r[0]) for r in runs] + [0] * (k - len(runs))

    def beats(a: int, b: int) -> bool:
        """Whether a's head goes first; sets the loser's length."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return y is None
        ha, hb = h[a], h[b]
        if ha != hb:
            return ha > hb
        n = min(len(x), len(y))
        while ha < n and x[ha] == y[ha]:
            ha += 1
        if ha < n:
            first = x[ha] < y[ha]
        else:
            first = len(x) < len(y) or len(x) == len(y) and a < b
        h[b if first else a] = ha
        return first

    tree, level = [0] * k, list(range(k))
    while len(level) > 1:  # the first tournament
        up = []
        for i in range(0, len(level), 2):
            a, b = level[i], level[i + 1]
            win, lose = (a, b) if beats(a, b) else (b, a)
            tree[(len(level) + i) // 2] = lose
            up.append(win)
        level = up
    w = level[0]
    out_run, out_pos, out_h = [], [], []
    while heads[w] is not None:
        p = pos[w]
        out_run.append(w)
        out_pos.append(p)
        out_h.append(h[w])
        p += 1
        pos[w] = p
        if p < size[w]:
            heads[w], h[w] = runs[w][0][p], runs[w][1][p]
        else:
            heads[w] = None
        node = (w + k) // 2
        while node:
            other = tree[node]
            if not beats(w, other):
                tree[node], w = w, other
            node //= 2
    return out_run, out_pos, out_h


def masks(runs: list[Run]) -> list[np.ndarray]:
    """For each run, a mask for each item: bit o is set if the string that begins o bytes before the anchor also lies in a
    document with a smaller key than the item's."""
    run, pos, lcp = (np.array(x, dtype=np.int64) for x in merge([(r.strings, r.lcp) for r in runs]))
    offset = np.concatenate(([0], np.cumsum([len(r.strings) for r in runs])))
    at = offset[run] + pos
    n = len(at)
    keys = np.concatenate([r.keys for r in runs])[at]
    lens = np.array([len(s) for r in runs for s in r.strings], dtype=np.int64)[at]
    left = [c for r in runs for c in r.left]
    left_len = np.array([len(c) for c in left], dtype=np.int64)[at]
    a = np.frombuffer(b"".join(c.ljust(LEFT, b"\0") for c in left), np.uint8).reshape(-1, LEFT)[at]
    by_left = np.argsort(np.ascontiguousarray(a).view(f"V{LEFT}").ravel(), kind="stable") if n else np.empty(0, np.int64)
    near = np.zeros(n, np.int64)
    if n > 1:
        near[1:] = (a[by_left[1:]] == a[by_left[:-1]]).cumprod(axis=1, dtype=np.uint8).sum(axis=1)
    out = np.zeros(n, np.uint32)
    left_class = np.empty(n, np.int64)
    for o in range(LEFT + 1):
        right_class = np.cumsum(lcp < LENGTH - o)
        left_class[by_left] = np.cumsum(near < o)
        ok = np.flatnonzero((lens >= LENGTH - o) & (left_len >= o))
        if not len(ok):
            continue
        group = right_class[ok] * (n + 1) + left_class[ok]
        order = np.argsort(group, kind="stable")
        g = group[order]
        begin = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
        least = np.repeat(np.minimum.reduceat(keys[ok[order]], begin), np.diff(np.append(begin, len(g))))
        out[ok[order]] |= (least < keys[ok[order]]).astype(np.uint32) << np.uint32(o)
    flat = np.empty(n, np.uint32)
    flat[at] = out
    return [flat[offset[i] : offset[i + 1]] for i in range(len(runs))]


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary): every row of docs without its repeated bytes.

    Null texts are empty, and empty ones lose nothing. Rows with equal doc_ids, repeated rows too, are separate documents of which neither is
    smaller; null doc_ids are equal to each other and smaller than any other. Texts count whole, however long or repetitive. An empty table gives an
    empty result. Other columns are not kept. Cut characters can leave kept invalid as UTF-8, so it is binary.
    """
    spark = docs.sparkSession
    smallest = -(1 << 63)

    def chunked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, texts, size = [], [], 0

        def row():
            return pd.DataFrame({"chunk": [uuid.uuid4().int >> 65], "keys": [keys], "blob": [_pack(texts, 6)]})

        for pdf in batches:
            for k, t in zip(pdf["k"].tolist(), pdf["text"].tolist(), strict=True):
                keys.append(int(k))
                texts.append(t.encode("utf-8", "surrogatepass"))
                size += len(texts[-1])
                if size >= CHUNK:
                    yield row()
                    keys, texts, size = [], [], 0
        if keys:
            yield row()

    slim = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(smallest)).alias("k"), F.coalesce("text", F.lit("")).alias("text"))
    # the filter is what the first join adds anyway; with it both joins read one and the same exchange of the texts
    chunks = stage(slim.mapInPandas(chunked, "chunk long, keys array<long>, blob binary")).where("chunk IS NOT NULL")
    # from here on a row is a chunk or a blob; a range gets about as much as a chunk has, whatever there is
    ranges = max(2 * partitions(spark), chunks.count())
    edges = [(i << _HASH_BITS) // ranges for i in range(1, ranges)]

    def announce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for c, keys, blob in zip(pdf["chunk"], pdf["keys"], pdf["blob"], strict=True):
                x = Chunk(keys, blob)
                several = x.several()
                cut = [0, *np.searchsorted(x.unique, np.array(edges, dtype=np.uint64)).tolist(), len(x.unique)]
                rows = [(r, c, _pack((_planes(np.diff(x.unique[a:b], prepend=np.uint64(0))), np.packbits(several[a:b]).tobytes(), b - a))) for r, (a, b) in enumerate(zip(cut, cut[1:], strict=False)) if a < b]
                # suffixes at the anchors with the least of another hash, to set the ends of ranges
                pick = np.argsort((x.hash * np.uint64(_BASE)) ^ x.at.astype(np.uint64), kind="stable")[:SAMPLES]
                rows += [(-1, int(x.hash[i]), x.texts[x.doc[i]][x.at[i] : x.at[i] + LENGTH]) for i in pick.tolist()]
                yield pd.DataFrame(rows, columns=["r", "c", "data"])

    told = stage(chunks.mapInPandas(announce, "r int, c long, data binary"))
    # ends are K-grams: suffixes that share one may share a string, and so must meet in one range
    drawn = told.where("r = -1").select("c", F.substring("data", 1, K).alias("gram"))
    share = min(1.0, SAMPLES * ranges / max(drawn.count(), 1))  # so about SAMPLES grams a range come to the driver, from all tasks together
    drawn = drawn.where(F.pmod(F.xxhash64("c", "gram"), F.lit(1 << 31)) < int(share * (1 << 31)))
    sample = sorted(bytes(x.gram) for x in drawn.select("gram").collect())
    ends = [sample[i * len(sample) // ranges] for i in range(1, ranges)] if sample else []

    def shared(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        lists = []
        for d in pdf["data"]:
            planes, bits, n = _unpack(d)
            lists.append((np.cumsum(_unplanes(planes), dtype=np.uint64), np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)))
        values, where, count = np.unique(np.concatenate([v for v, _ in lists]), return_inverse=True, return_counts=True)
        yes, at, out = count > 1, 0, []
        for v, several in lists:
            out.append(np.packbits(yes[where[at : at + len(v)]] | several).tobytes())
            at += len(v)
        return pd.DataFrame({"chunk": pdf["c"], "r": pdf["r"], "n": [len(v) for v, _ in lists], "bits": out})

    bits = told.where("r >= 0").groupBy("r").applyInPandas(shared, "chunk long, r int, n int, bits binary")
    bits = bits.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("r", "n", "bits"))).alias("bits"))

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for c, keys, blob, found in zip(pdf["chunk"], pdf["keys"], pdf["blob"], pdf["bits"], strict=True):
                x = Chunk(keys, blob)
                on = np.concatenate([np.unpackbits(np.frombuffer(b["bits"], np.uint8), count=b["n"]).astype(bool) for b in found])
                items, least, where = x.items(on[x.which])
                if not items:
                    continue
                cut = [0, *(bisect.bisect_left(items, (e,)) for e in ends), len(items)]
                rows = [(r, c, encode_run(items[a:b], least[a:b])) for r, (a, b) in enumerate(zip(cut, cut[1:], strict=False)) if a < b]
                places = _pack((_planes(where[:, 0]), _planes(np.diff(where[:, 1], prepend=0).view(np.uint64)), _planes(where[:, 2]), _planes(np.array(least, dtype=np.int64).view(np.uint64))))
                rows.append((c % ranges, c, b"P" + places))  # passes through to the chunk's last step
                yield pd.DataFrame(rows, columns=["r", "c", "data"])

    sent = chunks.join(bits, "chunk").select("chunk", "keys", "blob", "bits").mapInPandas(send, "r int, c long, data binary")

    def merged(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        passing = pdf["data"].map(lambda d: d[:1] == b"P")
        runs = pdf[~passing]
        found = masks([Run(d) for d in runs["data"]]) if len(runs) else []
        out = [(c, key[0], b"M" + _pack(m.tobytes())) for c, m in zip(runs["c"], found, strict=True)]
        out += [(c, -1, d) for c, d in zip(pdf[passing]["c"], pdf[passing]["data"], strict=True)]
        return pd.DataFrame(out, columns=["chunk", "r", "data"])

    answers = sent.groupBy("r").applyInPandas(merged, "chunk long, r int, data binary")
    answers = answers.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("r", "data"))).alias("answers"))

    def cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for keys, blob, found in zip(pdf["keys"], pdf["blob"], pdf["answers"], strict=True):
                texts = _unpack(blob)
                begin = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))  # a byte between documents
                gone = np.zeros(begin[-1] + 1, np.int32)
                if found is not None and len(found):
                    doc, step, item, least = (_unplanes(p) for p in _unpack(found[0]["data"][1:]))
                    doc, item, least = doc.astype(np.int64), item.astype(np.int64), least.view(np.int64)
                    at = np.cumsum(step.view(np.int64))
                    mask = np.concatenate([np.frombuffer(_unpack(a["data"][1:]), np.uint32) for a in found[1:]])
                    length = np.array([len(t) for t in texts], dtype=np.int64)[doc]
                    later = np.array([int(k) for k in keys], dtype=np.int64)[doc] > least[item]  # its own chunk has it earlier
                    for o in range(LEFT + 1):
                        hit = (later & (at >= o) & (length - at >= LENGTH - o)) | ((mask[item] >> np.uint32(o)) & np.uint32(1)).astype(bool)
                        place = begin[doc[hit]] + at[hit] - o
                        np.add.at(gone, place, 1)
                        np.add.at(gone, place + LENGTH, -1)
                gone = np.cumsum(gone) > 0
                out = []
                for k, t, b in zip(keys, texts, begin.tolist(), strict=False):
                    g = gone[b : b + len(t)]
                    n = int(g.sum())
                    spans = int(g[:1].sum() + (g[1:] & ~g[:-1]).sum()) if n else 0
                    kept = np.frombuffer(t, np.uint8)[~g].tobytes() if n else t
                    out.append((int(k), len(t), n, spans, kept))
                yield pd.DataFrame(out, columns=["k", "n_bytes", "n_removed", "n_spans", "kept"])

    done = chunks.join(answers, "chunk", "left").select("keys", "blob", "answers").mapInPandas(cut_out, "k long, n_bytes long, n_removed long, n_spans long, kept binary")
    return done.select(F.when(F.col("k") != smallest, F.col("k")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")
