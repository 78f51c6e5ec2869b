"""Benchmark decontamination with suffix arrays of the training texts.

Each shard, a piece of an Arrow batch of documents, becomes an array of word numbers with a suffix array, sorted as deep as the longest
test item. Every suffix of every test item is searched in it by binary search, word by word, which gives all its verbatim matches of a
window or more with their places and whole lengths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, with_columns

WINDOW = 10
#: Bytes of item texts, about, that are searched for in one pass over the documents and broadcast for it.
BLOCK_BYTES = 16 << 20
MATCH = "array<struct<item:string,at:int,item_at:int,length:int>>"

#: A-Z become a-z; what is neither 0-9, a-z nor part of a non-ASCII character becomes a blank.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Places of ids that are not 0, in the order of the suffixes that begin there, compared over depth places at least; equal ones in
    order of place. ids has depth zeros or more at its end.

    Prefix doubling: ranks by the first k places give ranks by the first 2k, and only suffixes that are still tied are sorted again. All
    suffixes that begin with 0 rank alike, which no search looks beyond.
    """
    start = np.flatnonzero(ids)
    order = start[np.argsort(ids[start], kind="stable")]
    first = np.concatenate(([True], ids[order][1:] != ids[order][:-1])) if len(order) else np.empty(0, bool)
    rank = np.zeros(len(ids), np.int64)  # of a suffix: 1 and the number of suffixes before its group
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0)) + 1
    k = 1
    while k < depth:
        last = np.concatenate((first[1:], [True])) if len(order) else first
        tied = np.flatnonzero(~(first & last))
        if not len(tied):
            break
        places = order[tied]
        next_ = rank[np.minimum(places + k, len(ids) - 1)]
        by = np.lexsort((next_, rank[places]))
        places, group, next_ = places[by], rank[places[by]], next_[by]
        order[tied] = places  # groups lie where they lay
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (next_[1:] != next_[:-1])))
        first[tied] = new
        rank[places] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))] + 1
        k *= 2
    return order


class Suffixes:
    """The suffixes of a block of items, as numbers over the block's own words. Picklable, and so broadcast."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.window, self.vocab, self.names = window, {}, []
        text, item, at, left, need = [], [], [], [], []
        for item_id, body in items:
            w = [self.vocab.setdefault(x, len(self.vocab) + 1) for x in words(body)]
            if not w:
                continue
            text += w + [0]
            item += [len(self.names)] * (len(w) + 1)
            at += range(len(w) + 1)
            left += range(len(w), -1, -1)
            need += [min(window, len(w))] * (len(w) + 1)
            self.names.append(str(item_id))
        self.text = np.array(text, dtype=np.int64)
        self.item, self.at, self.left, self.need = (np.array(x, dtype=np.int64) for x in (item, at, left, need))
        self.depth = int(self.left.max(initial=0))

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All matches of a window or more that no match prolongs: the place in ids, the place in text, the length in words.

        ids: word numbers, 0 for words no item has, with depth zeros after each document. The suffixes of ids that share a test suffix's first
        d words are an interval of the suffix array, which a further word narrows by two binary searches. Those of the interval at the
        window's depth are matches, and each interval below tells which of them are longer by a word.
        """
        order = suffix_array(ids, self.depth)
        q = np.flatnonzero(self.text)
        lo, hi = np.zeros(len(q), np.int64), np.full(len(q), len(order))
        live, row = np.arange(len(q)), np.full(len(q), -1)
        which, begin, count, longer = [], [], [], []
        rows = 0
        for d in range(self.depth):
            live = live[self.left[q[live]] > d]
            if not len(live) or not len(order):
                break
            want = self.text[q[live] + d]
            low = _bound(ids, order, d, want, lo[live], hi[live])
            high = _bound(ids, order, d, want + 1, low, hi[live])
            there = low < high
            live, low, high = live[there], low[there], high[there]
            lo[live], hi[live] = low, high
            deep = row[live] >= 0
            longer.append((row[live[deep]], low[deep], high[deep]))
            whole = self.need[q[live]] == d + 1
            row[live[whole]] = rows + np.arange(whole.sum())
            rows += int(whole.sum())
            which.append(q[live[whole]])
            begin.append(low[whole])
            count.append(high[whole] - low[whole])
        which, begin, count = (np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64) for x in (which, begin, count))
        first = np.concatenate(([0], np.cumsum(count)))
        more = np.zeros(first[-1] + 1, np.int64)
        for r, low, high in longer:
            np.add.at(more, first[r] + low - begin[r], 1)
            np.add.at(more, first[r] + high - begin[r], -1)
        place = order[np.repeat(begin - first[:-1], count) + np.arange(first[-1])] if rows else which
        at = np.repeat(which, count)
        # a match goes on to the left if the words before are the same; separators are 0 on both sides
        before = (place > 0) & (at > 0)
        same = before & (ids[place - 1] == self.text[at - 1]) & (self.text[at - 1] > 0)
        return place[~same], at[~same], (self.need[at] + np.cumsum(more)[:-1])[~same]


def _bound(ids: np.ndarray, order: np.ndarray, d: int, want: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """For each query the first place of order in [lo, hi) whose suffix has at least want at distance d; hi if none."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) // 2
        less = ids[order[mid] + d] < want[open_]
        lo[open_[less]] = mid[less] + 1
        hi[open_[~less]] = mid[~less]


def _blocks(items: Iterator, window: int, block_bytes: int) -> Iterator[Suffixes]:
    block, size = [], 0
    for item_id, text in items:
        if block and size + len(text or "") * 4 > block_bytes:
            yield Suffixes(block, window)
            block, size = [], 0
        block.append((item_id, text))
        size += len(text or "") * 4
    yield Suffixes(block, window)


def _found(texts: list[str | None], s: Suffixes) -> tuple[list[int], list[list[dict]]]:
    """Words of each text, and its matches with the suffixes of a block."""
    split = [words(t) for t in texts]
    lengths = np.array([len(w) for w in split], dtype=np.int64)
    pad = max(s.depth, 1)
    begin = np.concatenate(([0], np.cumsum(lengths + pad)))
    ids, get = np.zeros(begin[-1], dtype=np.int64), s.vocab.get
    for b, w in zip(begin.tolist(), split, strict=False):
        ids[b : b + len(w)] = [get(x, 0) for x in w]
    out: list[list[dict]] = [[] for _ in texts]
    if s.depth:
        place, which, length = s.search(ids)
        doc = np.searchsorted(begin, place, "right") - 1
        for i, a, j, m in zip(doc.tolist(), (place - begin[doc]).tolist(), which.tolist(), length.tolist(), strict=True):
            out[i].append({"item": s.names[s.item[j]], "at": a, "item_at": int(s.at[j]), "length": m})
    return lengths.tolist(), out


def _matched(docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int) -> DataFrame:
    """docs with _docrel_words and _docrel_found, an array of item, at, item_at, length: all verbatim matches that no match prolongs."""
    sc = docs.sparkSession.sparkContext
    items = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("string"), "text").toLocalIterator()
    out, before = docs, None
    for block in _blocks(items, window, block_bytes):
        if before is not None:  # a further pass; the one before is done and its block given up
            out = stage(out)
            before.destroy()
        sent = sc.broadcast(block)  # block_bytes, about

        def search(texts: list[str | None], sent=sent) -> dict[str, list]:
            n, found = _found(texts, sent.value)
            return {"_docrel_words": n, "_docrel_more": found}

        first = before is None
        out = with_columns(out, {"_docrel_words": "long", "_docrel_more": MATCH}, search)
        out = out.withColumnRenamed("_docrel_more", "_docrel_found") if first else out.withColumn("_docrel_found", F.concat("_docrel_found", "_docrel_more")).drop("_docrel_more")
        before = sent
    return out


def _covered(found: Column) -> Column:
    """Number of words that lie in any match."""
    spans = F.array_sort(F.transform(found, lambda m: F.struct(m["at"].alias("a"), (m["at"] + m["length"]).alias("b"))))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda acc, s: F.struct(F.greatest(acc["end"], s["b"]).alias("end"), (acc["n"] + F.greatest(s["b"] - F.greatest(acc["end"], s["a"]), F.lit(0))).cast("long").alias("n"))
    return F.aggregate(spans, start, step, lambda acc: acc["n"])


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with n_words, n_hit (words in matches), n_items, items (array of item_id as strings, sorted), matches (array of item, at,
    item_at, length in words, by at: all verbatim matches of a window or more that none prolongs), longest (the most words of one) and contaminated.

    An item of fewer words than window is one window. Items stream to the driver in blocks of block_bytes; each block is broadcast on its own
    and given up before the next, and documents are read once a block. Null and empty texts have no words; items without words never occur;
    items with one item_id count once in items, each with its own text; a null item_id is ignored; an empty benchmark matches nothing. Repeated
    rows and null doc_ids stay as they are; an empty table gives an empty result. Columns with the names above are replaced, others pass untouched.
    """
    found = F.col("_docrel_found")
    items = F.array_sort(F.array_distinct(F.transform(found, lambda m: m["item"])))
    in_order = F.array_sort(F.transform(found, lambda m: F.struct(*[m[c].alias(c) for c in ("at", "item", "item_at", "length")])))
    new = {
        "n_words": F.col("_docrel_words"), "n_hit": _covered(found), "n_items": F.size(items).cast("long"), "items": items, "matches": in_order,
        "longest": F.coalesce(F.array_max(F.transform(found, lambda m: m["length"])), F.lit(0)).cast("long"), "contaminated": F.size(found) > 0,
    }
    docs = docs.drop(*new)
    out = _matched(docs, benchmark, window, block_bytes)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], *[c.alias(k) for k, c in new.items()])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs without those that hold any window of an item; all columns as before. Edge cases are those of matches()."""
    return _matched(docs, benchmark, window, BLOCK_BYTES).where(F.size("_docrel_found") == 0).select(*docs.columns)
