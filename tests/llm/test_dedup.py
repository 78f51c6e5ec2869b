"""Line dedup, SimHash and suffix dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from docrel.llm import linededup, simhash, suffixdedup
from docrel.llm.common import components
from pyspark.sql import functions as F


def test_line_dedup(spark, docs, rows):
    holders = {}
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    for n, r in enumerate(rows):
        for k in {key(x) for x in (r[1] or "").split("\n")}:
            if len(k) >= 20:
                holders.setdefault(k, []).append((n, r[0]))
    bad = {k: max((i for _, i in v if i is not None), default=None) for k, v in holders.items() if len(v) >= 3}
    want = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if key(x) not in bad or bad[key(x)] == r[0]]
        want.append((r[0], "\n".join(kept), len(lines), len(lines) - len(kept)))
    got = [(x.doc_id, x.text, x.n_lines, x.n_dropped) for x in linededup.line_dedup(docs).collect()]
    order = lambda x: (str(x[0]), x[1])
    assert sorted(got, key=order) == sorted(want, key=order)
    assert bad


def test_line_dedup_empty_and_clashing(spark, docs):
    assert linededup.line_dedup(docs.limit(0)).count() == 0
    odd = docs.selectExpr("*", "1 AS n_lines", "2 AS n_dropped", "3 AS line")
    out = linededup.line_dedup(odd)
    assert out.columns.count("n_lines") == 1 and out.count() == docs.count()


def brute_simhash(text):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(values, limit):
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= limit:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


def test_simhash_components(spark, docs, rows):
    prints = [(r[0], brute_simhash(r[1])) for r in rows]
    comp = brute_components([f for _, f in prints], 2)
    least = {}
    for d, f in prints:
        if d is not None:
            least[comp[f]] = min(least.get(comp[f], d), d)
    want = sorted(((str(d), f, least.get(comp[f])) for d, f in prints), key=str)
    got = sorted(((str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in simhash.near_components(docs).collect()), key=str)
    assert got == want


@pytest.mark.parametrize("task_members", [2048, 3])
def test_links_within(spark, task_members):
    r = random.Random(1)
    values = []
    for _ in range(60):
        x = r.getrandbits(64)
        values.append(x)
        for _ in range(r.randint(0, 6)):
            x ^= 1 << r.randrange(64) if r.random() < 0.5 else (1 << r.randrange(64)) ^ (1 << r.randrange(64))
            values.append(x)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    classes = spark.createDataFrame([(signed(x),) for x in set(values)], "fp long")
    found = {x.node: x.root for x in components(simhash.links_within(classes, 2, task_members)).collect()}
    want = brute_components(values, 2)
    groups = {}
    for v in set(values):
        groups.setdefault(want[v], set()).add(found.get(signed(v), signed(v)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_block_masks_are_exact():
    r = random.Random(2)
    for n in (10, 10**6, 10**12):
        masks = simhash.block_masks(2, n)
        for _ in range(200):
            d = (1 << r.randrange(64)) | (1 << r.randrange(64))
            assert any(d & m == 0 for m in masks)


@pytest.mark.parametrize("many", [1 << 20, 0])
def test_components_of_a_path(spark, many):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 100), (7, None), (200, 150)] + [(500, 501 + i) for i in range(60)], "a long, b long")
    got = {r.node: r.root for r in components(edges, many=many).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 150: 150, 200: 150, **dict.fromkeys(range(500, 561), 500)}
    assert components(edges.limit(0)).count() == 0


def test_near_dedup_keeps_one_of_each_group(spark, docs, rows):
    out = simhash.near_dedup(docs)
    assert out.columns == docs.columns
    kept = [r.doc_id for r in out.collect()]
    assert 203 in kept and 204 not in kept  # one word of 20,000
    assert len([d for d in kept if d in (200, 201, 202)]) == 1  # no words
    assert not {i for i in range(7, 120, 7)} & set(kept)  # exact copies
    assert kept.count(207) <= 1
    assert simhash.near_dedup(docs.limit(0)).count() == 0


@pytest.mark.parametrize("task_members", [2048, 80])
def test_near_dedup_is_exact_in_large_groups(spark, task_members):
    """Near copies of near copies in one large group, exact ones, and strangers, against the components of all pairs."""
    r = random.Random(21)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(3000)]
    base = [r.choice(vocabulary) for _ in range(150)]
    rows = []
    for i in range(330):
        w = list(base)
        for _ in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        rows.append((i, " ".join(w)))
    rows += [(500 + i, rows[0][1]) for i in range(40)]
    rows += [(600 + i, " ".join(base[:110] + [r.choice(vocabulary) for _ in range(40)])) for i in range(30)]  # a common beginning, no near copies
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    kept = sorted(x.doc_id for x in simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), task_members=task_members).collect())
    assert kept == sorted({find(i) for i in sets})
    assert 100 < len(kept) < 150


def test_parts_of_a_large_block_stay_small(spark):
    hot = spark.range(5000).select(F.lit(1).cast("long").alias("k"), F.col("id").alias("node"), F.lit(5000).cast("long").alias("n"))
    sizes = [x["count"] for x in simhash._parts(hot, 400).groupBy("k").count().collect()]
    assert max(sizes) < 520 and sum(sizes) < 1.3 * 5000


def test_suffix_dedup_of_long_repetitive_texts(spark):
    text = "a" * 150_000 + "b" + "ab" * 40_000
    rows = [(1, text), (2, "x" + text), (3, "abc" * 30_000), (4, "zz" + "abc" * 20)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffixdedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (len(text), 0, 0), 2: (len(text) + 1, len(text), 1), 3: (90_000, 0, 0), 4: (62, 60, 1)}


def test_near_dedup_finds_contiguous_edits(spark):
    r = random.Random(11)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(3000)]
    rows, similar, far = [], [], []
    for i in range(180):
        w = [r.choice(vocabulary) for _ in range(r.randint(100, 400))]
        share, new = r.choice([0.05, 0.09, 0.17]), lambda n: [r.choice(vocabulary) for _ in range(n)]  # noqa: B023
        n = int(len(w) * share * (1 if i % 3 else 2))
        v = [w + new(n), w[:-n], w[: -n // 2] + new(n // 2)][i % 3]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
        a, b = ({tuple(x[k : k + 5]) for k in range(len(x) - 4)} for x in (w, v))
        (similar if len(a & b) / len(a | b) >= 0.8 else far).append(2 * i + 1)
    kept = {x.doc_id for x in simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(similar) > 80 and len(far) > 20
    assert not kept & set(similar)
    assert set(far) <= kept


def test_near_dedup_finds_edited_copies(spark):
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(3000)]
    rows, similar, far = [], [], []
    for i in range(60):
        w = [r.choice(vocabulary) for _ in range(r.randint(100, 400))]
        rows.append((2 * i, " ".join(w)))
        for _ in range(max(1, int(len(w) * r.choice([0.003, 0.008, 0.2])))):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        rows.append((2 * i + 1, " ".join(w)))
        a, b = ({tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for _, t in rows[-2:])
        j = len(a & b) / len(a | b)
        (similar if j > 0.85 else far if j < 0.7 else []).append(2 * i + 1)
    kept = {x.doc_id for x in simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert similar and far
    assert not kept & set(similar)
    assert set(far) <= kept


def brute_suffix(rows, n=50):
    first = {}
    texts = [((r[0] is not None, r[0] or 0), (r[1] or "").encode()) for r in rows]
    for k, t in texts:
        for i in range(len(t) - n + 1):
            s = t[i : i + n]
            first[s] = min(first.get(s, k), k)
    out = []
    for (k, t), r in zip(texts, rows):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - n + 1):
            if first[t[i : i + n]] < k:
                gone[i : i + n] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((str(r[0]), len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("chunk", [1 << 23, 3000])
def test_suffix_dedup(spark, docs, rows, monkeypatch, chunk):
    monkeypatch.setattr(suffixdedup, "CHUNK", chunk)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in suffixdedup.suffix_dedup(docs).collect())
    assert got == brute_suffix(rows)
    assert suffixdedup.suffix_dedup(docs.limit(0)).count() == 0


def test_merge_is_a_sort():
    r = random.Random(9)
    for k in (0, 1, 2, 5, 9):
        runs = []
        for _ in range(k):
            s = sorted(bytes(r.choice(b"ab") for _ in range(r.randint(0, 6))) for _ in range(r.randint(0, 30)))
            lcp = [0] + [next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b))) for a, b in zip(s, s[1:])]
            runs.append((s, bytes(lcp)))
        run, pos, h = suffixdedup.merge(runs)
        out = [runs[a][0][b] for a, b in zip(run, pos)]
        assert out == sorted(x for s, _ in runs for x in s)
        for a, b, n in zip(out, out[1:], h[1:]):
            assert a[:n] == b[:n] and (n == min(len(a), len(b)) or a[n] != b[n])


def test_anchors_in_blocks(monkeypatch):
    r = random.Random(4)
    data = bytes(r.choice(b"abcd ") for _ in range(3000)) + b"x" * 200
    whole = suffixdedup.anchors(data)
    monkeypatch.setattr(suffixdedup, "BLOCK", 100)
    parts = suffixdedup.anchors(data)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
    gaps = np.diff(whole[0])
    assert gaps.max() <= suffixdedup.LEFT + 1
