"""Toxicity, language ID, mixing and the pipeline."""

import hashlib
import random
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from docrel.llm import common, langid, mixing, simhash, suffixdedup, toxicity
from pyspark.sql import functions as F

PLAIN = {"en": "the of and to in that was with for are this on".split(), "de": "der die und den von ist mit nicht ein auf das sich".split(), "es": "que los del las por una con para como más pero sus".split()}


def corpus(n=400, seed=1):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        lang = r.choice(list(PLAIN))
        words = [r.choice(PLAIN[lang]) if r.random() < 0.4 else "".join(r.choice({"en": "aeionthrs", "de": "eiunhcrgßü", "es": "aeosñícdr"}[lang]) for _ in range(r.randint(3, 8))) for _ in range(r.randint(20, 80))]
        toxic = r.random() < 0.25
        if toxic:
            for _ in range(r.randint(1, 4)):
                words[r.randrange(len(words))] = r.choice(["moron", "zorgwit", "zorgling", "zorgface", "scum", "idiot"])
        rows.append((i, " ".join(words), lang, f"src{i % 4}", 1))
        if i % 2:
            labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = corpus()
    rows += [(900, None, "en", "src1", 0), (901, "", None, None, 0), (902, "123 ...", "en", None, 7), (None, "the of and", "en", "src1", 3), (0, *rows[0][1:])]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame([*labels, (None, 1, 1), (5000, 1, None)], "doc_id long, quality int, toxic int")


def test_toxicity_held_out(spark, tables):
    docs, labels = tables
    scorer = toxicity.fit(docs, labels)
    marks = {r.doc_id: r.toxic for r in labels.collect()}
    scored = toxicity.score(docs.selectExpr("*", "1 AS score"), scorer).collect()
    assert len(scored) == docs.count()
    held = [(r.score, marks[r.doc_id]) for r in scored if r.doc_id in marks and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    right = sum((s >= 0.7) == bool(y) for s, y in held) / len(held)
    assert right > 0.9 and len(held) > 30
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in scored)
    assert all(r.predicted == 0 for r in scored if not r.text)
    again = {(r.doc_id, r.text): r.score for r in toxicity.score(docs, toxicity.fit(docs.repartition(3), labels)).collect()}
    assert all(abs(again[r.doc_id, r.text] - r.score) < 1e-9 for r in scored)


def test_toxicity_without_labels(spark, tables):
    docs, labels = tables
    scored = toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).collect()
    assert {bool(r.predicted) for r in scored if r.text and "idiot" in r.text} == {True}
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


def some_votes():
    r = np.random.default_rng(0)
    y = r.random(4000) < 0.3
    fire = lambda p, q: np.where(y, r.random(4000) < p, r.random(4000) < q).astype(float)
    bad = fire(0.3, 0.25)
    return y, np.array([*[fire(0.6, 0.02) for _ in range(4)], bad, bad, bad, bad]).T


def test_label_model_weighs_voters():
    y, votes = some_votes()
    few, marks = np.column_stack([votes, votes.sum(axis=1) == 0])[:300], y[:300]
    rates = np.array([(few[marks == c].sum(axis=0) + 0.25) / ((marks == c).sum() + 1) for c in (False, True)])
    post, model = toxicity.label_model(votes, 0.3, rates, (5 * (~marks).sum(), 5 * marks.sum()))
    assert ((post > 0.5) == y)[300:].mean() > 0.92
    assert model["share"][4] < 0.5 < model["share"][0]
    assert model["accuracy"][:4].min() > 0.9 > 0.75 > model["accuracy"][4:8].max()
    good, _ = toxicity.label_model(votes[:, :4], 0.3)  # no label, and no rate given
    assert ((good > 0.5) == y).mean() > 0.93
    assert len(toxicity.label_model(votes[:0], 0.3)[0]) == 0


def test_label_model_is_em(monkeypatch):
    """Without correlations: rows of votes, one at a time, as the rule says."""
    monkeypatch.setattr(toxicity, "CORRELATED", 2.0)
    _, votes = some_votes()
    votes, prior, weight = votes[:300], 0.25, (5.0, 2.0)
    rows = [[*v, float(not v.any())] for v in votes]
    mean = [[0.1 + 0.01 * j for j in range(9)], [0.4 - 0.02 * j for j in range(9)]]
    now = [list(m) for m in mean]
    for step in range(60):
        post = []
        for v in rows:
            odds = prior / (1 - prior)
            for j, x in enumerate(v):
                odds *= (now[1][j] / now[0][j]) if x else 1.0
            post.append(odds / (1 + odds))
        moved = 1.0 if not step else max(abs(p - q) for p, q in zip(post, last))  # noqa: F821
        last = post  # noqa: F841
        for c in (0, 1):
            mass = [p if c else 1 - p for p in post]
            now[c] = [(sum(m * v[j] for m, v in zip(mass, rows)) + (weight[c] + 0.05) * mean[c][j]) / (sum(mass) + weight[c] + 0.05) for j in range(9)]
        if moved < 1e-5 and step % 10:
            break
    got, model = toxicity.label_model(votes, prior, np.array(mean), weight)
    assert np.abs(got - np.array(post)).max() < 1e-6
    assert np.abs(model["rates"] - np.array(now)).max() < 1e-6


def test_samples_are_bounded_whatever_repeats(spark):
    same = spark.range(3000).select(F.lit(0).cast("long").alias("doc_id"), F.concat(F.lit("der die das und "), F.col("id").cast("string")).alias("text"), F.lit("de").alias("lang"))
    same = same.union(same.limit(500)).union(spark.createDataFrame([(8, "el la los las", "es")] * 2000, "doc_id long, text string, lang string"))
    assert common.chosen_rows(same, 10).count() <= 10
    assert {r.lang for r in common.chosen_rows(same, 5000).collect()} == {"de", "es"} and common.chosen_rows(same, 5000).count() == 3001
    labels = spark.createDataFrame([(0, 1), (0, 0), (8, 0)], "doc_id long, toxic int")
    assert toxicity.sample(same, labels, 20).count() <= 20
    assert toxicity.sample(same, labels, 9000).groupBy("toxic").count().where("toxic = 1").first()["count"] == 3000
    model = langid.fit(same, max_rows=12)
    assert model.langs == ["de"] or model.langs == ["de", "es"]


def test_frames_do_not_share_settings(spark, tables):
    docs, labels = tables
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    one, two = langid.predict(docs, langid.fit(docs)), suffixdedup.suffix_dedup(docs)
    three = toxicity.score(docs, toxicity.fit(docs, labels))
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    assert one.count() == two.count() == three.count() == docs.count()


def test_ids_pass_untouched(spark):
    rows = [((1 << 62) + 1, "the of and", "en"), (None, "der die das", "de"), (-(1 << 62) - 1, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    assert {(r.doc_id, r.text, r.lang) for r in langid.predict(docs, langid.fit(docs)).collect()} == set(rows)
    assert {r.doc_id for r in simhash.near_components(docs).collect()} == {r[0] for r in rows}


def test_spread_join(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 1200, 7).otherwise(F.col("id") % 40 + 100).alias("k"), "id")
    table = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("m")).where("k <> 105")
    got = common.spread_join(rows, table, "k", "n")
    assert got.columns == ["k", "id", "m"]
    want = rows.join(table.drop("n"), "k")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_scratch_needs_a_shared_folder(spark, monkeypatch):
    class Far:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})()
        sparkContext = type("S", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError, match="share"):
        common.scratch(Far())


def test_language(spark, tables):
    docs, _ = tables
    model = langid.fit(docs)
    out = langid.predict(docs, model).collect()
    held = [r for r in out if r.doc_id is not None and r.doc_id < 900 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(r.lang_pred == r.lang for r in held) > 0.95 * len(held) and len(held) > 50
    odd = {r.doc_id: r for r in out if r.doc_id and r.doc_id >= 900}
    assert all(r.lang_pred == "und" and r.score == 0 and r.rejected for r in odd.values())
    assert all(0 <= r.score <= 1 for r in out)
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(docs.where("lang IS NULL"))).collect()} == {"und"}
    assert langid.predict(docs.limit(0), model).count() == 0


def brute_budget(leaves, total):
    """leaves: {(domain, lang, source): tokens}."""
    def weigh(level, v):
        return mixing.WEIGHTS.get(level, {}).get(v, mixing.DEFAULT_WEIGHT)

    def down(prefix, budget, out):
        depth = len(prefix)
        if depth == 3:
            out[prefix] = budget
            return out
        kids = sorted({k[: depth + 1] for k in leaves if k[:depth] == prefix})
        cap = {k: 2 * sum(v for l, v in leaves.items() if l[: depth + 1] == k) for k in kids}
        w = {k: weigh(mixing.LEVELS[depth], k[-1]) for k in kids}
        got, left, rest = {}, list(kids), budget
        while True:
            share = sum(w[k] for k in left)
            full = [k for k in left if cap[k] * share <= rest * w[k]]
            if not full:
                break
            for k in full:
                got[k] = cap[k]
            rest -= sum(cap[k] for k in full)
            left = [k for k in left if k not in full]
        for k in left:
            got[k] = rest * w[k] // sum(w[x] for x in left)
        for k in kids:
            down(k, got[k], out)
        return out

    return down((), total, {})


def test_budgets_against_brute_force(spark):
    r = random.Random(3)
    for _ in range(4):
        leaves = {(d, lang, f"src{s}"): r.choice([1, 5, 100, 3000]) * r.randint(1, 9) for d in ("web", "books", "x") for lang in ("en", "fr") for s in range(r.randint(1, 3))}
        for share in (10, 500, 900, 3000):
            total = sum(leaves.values()) * share // 1000
            df = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "domain string, lang string, source string, tokens long")
            got = {tuple(x[:3]): x.budget for x in mixing.budgets(df, total).collect()}
            assert got == brute_budget(leaves, total)
            assert sum(got.values()) <= max(total, 0)


@pytest.mark.parametrize("hexes", [1, 3])
def test_mix(spark, tables, monkeypatch, hexes):
    monkeypatch.setattr(mixing, "BUCKET_HEX", hexes)
    docs, _ = tables
    got = mixing.mix(docs).collect()
    db = duckdb.connect()
    db.register("documents", docs.toArrow())
    cols = ["doc_id", "domain", "lang", "source", "tokens", "copies", "budget"]
    want = db.execute(f"SELECT {', '.join(cols)} FROM ({mixing.oracle()})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r[c] for c in cols)) for r in got)
    by = {}
    for r in got:
        by.setdefault((r.domain, r.lang, r.source, r.budget), []).append(r.tokens * r.copies)
    assert all(sum(v) <= k[3] for k, v in by.items())
    assert mixing.mix(docs.limit(0)).count() == 0


def test_pipeline(spark, tables, tmp_path):
    docs, labels = tables
    r = random.Random(9)
    passage = " ".join("".join(r.choice("abcdefg") for _ in range(6)) for _ in range(15))
    line = "This long line stands in many documents"
    extra = [(1000 + i, f"{line}\n" + " ".join(r.choices(PLAIN["en"], k=40)) + f" only{i}", "en", "src2", 1) for i in range(5)]
    extra += [(1100, "some words here " + passage.upper() + " and more", "en", "src2", 1)]
    docs.unionByName(spark.createDataFrame(extra, docs.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("q1", passage)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for i, (name, f) in enumerate(corpus_pipeline.STAGES):
        out = f(spark, now, str(tmp_path))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{i}")
        now = spark.read.parquet(f"{tmp_path}/{i}")
        seen.append({(x.doc_id, getattr(x, "text", None)) for x in now.select(*[c for c in ("doc_id", "text") if c in now.columns]).collect()})
    assert not any(t and "idiot" in t.split() for _, t in seen[0])
    assert sum(line in (t or "") for _, t in seen[1]) == 1 and len(seen[1]) == len(seen[0])
    assert 1100 in {d for d, _ in seen[2]} and 1100 not in {d for d, _ in seen[3]}
    assert seen[3] < seen[2] and {d for d, _ in seen[4]} <= {d for d, _ in seen[3]}
    ran = sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect()))
    assert ran == sorted(map(str, now.collect()))


def test_pipeline_against_brute_force(spark, tables, tmp_path):
    """All stages again, one document at a time in plain Python (the classifier's weights and the mixture's SQL are taken as they are)."""
    docs, labels = tables
    r = random.Random(19)
    passage = [r.choice(PLAIN["en"]) + str(i) for i in range(14)]
    line = "An ordinary line that stands in many documents"
    extra = []
    for i in range(60):
        words = [f"{r.choice(PLAIN['de'])}{r.randint(0, 30)}" for _ in range(60)]
        extra.append((2000 + 3 * i, " ".join(words) + ("\n" + line if i % 3 == 0 else ""), "de", f"src{i % 4}", 1))
        words[r.randrange(60)] = "anders"
        extra.append((2001 + 3 * i, " ".join(words), "de", "src1", 1))
        extra.append((2002 + 3 * i, " ".join(words[:30] + (passage if i % 10 == 0 else []) + words[:20]), "de", "src2", 1))
    extra += [extra[0], (None, "no id here " + " ".join(passage[:9]), "de", None, 1)]
    whole = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    for name, df in (("documents", whole), ("labels", labels), ("benchmark", spark.createDataFrame([("q1", " ".join(passage)), ("q2", "anders only")], "item_id string, text string"))):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    scorer = toxicity.fit(whole, labels)
    rows = [tuple(x) for x in whole.collect()]
    rows = [x for x in rows if scorer.score(x[1]) < 0.7]
    key = lambda t: t.strip(" \t\n\x0b\x0c\r").lower()
    holders = {}
    for n, x in enumerate(rows):
        for k in {key(t) for t in (x[1] or "").split("\n")}:
            if len(k) >= 20:
                holders.setdefault(k, []).append((n, x[0]))
    keep = {k: max((i for _, i in v if i is not None), default=None) for k, v in holders.items() if len(v) >= 3}
    rows = [(x[0], "\n".join(t for t in (x[1] or "").split("\n") if key(t) not in keep or keep[key(t)] == x[0]), *x[2:]) for x in rows]
    sets = [set(simhash.shingle_set(x[1]).tolist()) for x in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if (a == sets[j]) or (a and len(a & sets[j]) / len(a | sets[j]) >= 0.8):
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    order = lambda i: (rows[i][0] is not None, rows[i][0] or 0, hashlib.md5(rows[i][1].encode()).digest())
    rows = [rows[min(g, key=order)] for g in groups.values()]
    windows = {tuple(passage[i : i + 10]) for i in range(5)} | {("anders", "only")}
    words = lambda t: "".join(c if c.isalnum() or ord(c) > 127 else " " for c in t.lower()).split()
    hit = lambda w: any(tuple(w[i : i + n]) in windows for n in (2, 10) for i in range(len(w)))
    rows = [x for x in rows if not hit(words(x[1]))]
    db = duckdb.connect()
    db.register("documents", spark.createDataFrame(rows, docs.schema).toArrow())
    cols = ["doc_id", "domain", "lang", "source", "tokens", "copies", "budget"]
    want = db.execute(f"SELECT {', '.join(cols)} FROM ({mixing.oracle()})").fetchall()
    got = corpus_pipeline.run(spark, str(tmp_path)).select(*cols).collect()
    assert sorted(map(str, want)) == sorted(str(tuple(x)) for x in got)
    assert 50 < len(rows) < len(whole.collect()) - 60


def test_spread_is_stable():
    assert hashlib.sha256(simhash.long_prints("one two three four five six")[0]).hexdigest() == hashlib.sha256(simhash.long_prints("ONE two three four five six")[0]).hexdigest()
