"""Extra columns with names that operators use inside."""

from docrel.llm import decontam, fingerprints, langid, linededup, mixing, pii, secret_scan, simhash, suffixdedup, toxicity

NAMES = "_id _h _lost _lines _keys _kept _terms _text_hash line keeper n h fp node bits blocks k c r chunk data blob keys spans email term score predicted items longest lang_pred rejected part p halo t tokens copies budget domain rank bucket whole rest taken e m f o".split()


def test_clashing_names(spark, docs):
    odd = docs.where("doc_id < 12 OR doc_id IS NULL").selectExpr("*", *[f"7 AS `{n}`" for n in NAMES])
    bench = spark.createDataFrame([("a", "one two three")], "item_id string, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, toxic int")
    n = odd.count()
    for out in (
        secret_scan.scan(odd), fingerprints.compare_with_next(odd), toxicity.score(odd, toxicity.fit(odd, labels)), pii.find(odd), simhash.near_components(odd), linededup.line_dedup(odd), suffixdedup.suffix_dedup(odd),
        decontam.matches(odd, bench), langid.predict(odd, langid.fit(odd)),
    ):
        assert out.count() == n and len(set(out.columns)) == len(out.columns)
    assert simhash.near_dedup(odd).columns == odd.columns
    assert decontam.decontaminate(odd, bench).count() == n
    assert mixing.mix(odd).count() <= n
    kept = linededup.line_dedup(odd)
    assert kept.where("_id <> 7 OR _lost <> 7 OR line <> 7").count() == 0
