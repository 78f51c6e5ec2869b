"""Decoders, discovery, catalog, reports, evaluation and plans on written fixtures."""

import io
import json
import zipfile

import pytest
from docrel.operators import evaluation, evidence, extract, layout, link, reports, window
from docrel.sources import catalog, office, readers
from docrel.streaming import incremental
from pyspark.sql import functions as F

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
S = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def zipped(**files):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, text in files.items():
            z.writestr(name.replace("__", "/").replace("_rels", "_rels"), text)
    return buf.getvalue()


def make_docx():
    p = lambda t: f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>"
    cell = lambda *t: "<w:tc>" + "".join(map(p, t)) + "</w:tc>"
    table = f"<w:tbl><w:tr>{cell('item')}{cell('precio')}</w:tr><w:tr>{cell('')}{cell('')}</w:tr><w:tr>{cell('Notebook', 'X1')}{cell('500.000')}</w:tr></w:tbl>"
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{p('Oferta')}{table}{p('fin')}<w:p/></w:body></w:document>")
    return buf.getvalue()


def make_xlsx():
    rows = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>total</t></is></c></row><row r="3"><c r="A3"><v>10</v></c><c r="B3"><v>2.5</v></c><c r="C3" s="1"><v>45000</v></c><c r="D3" t="b"><v>1</v></c></row><row r="600"><c r="A600"><v>1</v></c></row>'
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {S} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Uno" r:id="r1"/><sheet name="Vacia" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="/xl/worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {S}><si><r><t>ítem </t></r><r><t>uno</t></r></si></sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {S}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {S}><sheetData>{rows}</sheetData></worksheet>")
        z.writestr("xl/worksheets/sheet2.xml", f"<worksheet {S}><sheetData/></worksheet>")
    return buf.getvalue()


def test_office_files():
    assert office.decode_docx("a.docx", make_docx()) == [(1, "Oferta\nfin\n[TABLA 1]\nFILA 1: item || precio\nFILA 3: Notebook | X1 || 500.000")]
    assert office.decode_xlsx("a.xlsx", make_xlsx()) == [(1, "[HOJA Uno]\nFILA 1: ítem uno ||  || total\nFILA 3: 10 || 2.5 || 2023-03-15 00:00:00 || True\n[HOJA Vacia]")]
    assert office.decode_xlsx("a.xlsx", make_xlsx(), 1, 1) == [(1, "[HOJA Uno]\nFILA 1: ítem uno\n[HOJA Vacia]")]
    assert [office.column_number(x) for x in ("A1", "Z9", "AA3", "")] == [1, 26, 27, 0]


def test_dispatch_and_status(spark, tmp_path):
    for name, data in (("a.docx", make_docx()), ("b.xlsx", make_xlsx()), ("c.TXT", "ñandú".encode("latin-1")), ("d.txt", b"  "), ("e.pdf", b"%PDF"), ("f.docx", b"no"), ("oferta.json", b"{}")):
        (tmp_path / name).write_bytes(data)
    got = {r.file: (r.page, r.status, r.text) for r in readers.read_documents(spark, str(tmp_path), readers.dispatch(office.DECODERS)).collect()}
    assert got["c.TXT"] == (1, "ok", "ñandú") and got["d.txt"] == (None, "sin_texto", None) and got["e.pdf"] == (None, "no_soportado", None)
    assert got["f.docx"][:2] == (None, "error") and got["a.docx"][1] == got["b.xlsx"][1] == "ok" and "oferta.json" not in got
    assert {r.file for r in readers.list_documents(spark, str(tmp_path)).collect()} == set(got)


def test_archives(spark):
    files = spark.createDataFrame([("x.zip", zipped(a="1")), ("y.7z", b"two"), ("z.7z", b"bad"), ("old.zip", zipped(b="2"))], "file string, content binary")

    def seven(content):
        if content == b"bad":
            raise OSError
        return [("in", content)]

    got = {r.file: r.content for r in readers.expand_archives(files, {".7z": seven}, spark.createDataFrame([("old.zip",)], "file string")).collect()}
    assert got == {"x.zip/a": bytearray(b"1"), "y.7z/in": bytearray(b"two"), "z.7z": None}


def test_tenders_in(spark):
    paths = ["r/m1/ofertas/T2/76__a/oferta.json", "r/m1/ofertas/T2/77__b/oferta.json", "r/m1/ofertas/t1/x/oferta.json", "r/_debug/T9/x/oferta.json", "r/m1/ofertas/T2/76__a/sub/y/oferta.json", "r/m1/a.pdf"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert [r.tender for r in readers.tenders_in(df).collect()] == ["r/m1/ofertas/t1", "r/m1/ofertas/T2"]


def test_csv_in_latin_1_and_with_line_ends(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("IDLicitacion;Nombre\n1;Computación\n".encode("latin-1"))
    (tmp_path / "b.csv").write_text('IDLicitacion,Nombre\n1,"dos\nlíneas"\n2,x\n', encoding="utf-8")
    (tmp_path / "c.csv").write_text("Otra\n1\n", encoding="utf-8")
    assert [tuple(r) for r in readers.read_csv(spark, str(tmp_path / "a.csv")).collect()] == [("1", "Computación")]
    assert [tuple(r) for r in readers.read_csv(spark, str(tmp_path / "b.csv")).collect()] == [("1", "dos\nlíneas"), ("2", "x")]
    df, bad = catalog.read_catalogs(spark, [str(tmp_path / f"{n}.csv") for n in "abcz"])
    assert df.count() == 3 and [p[-5:] for p in bad] == ["c.csv", "z.csv"]


def test_queue(spark):
    rows = [(1, "a", "Notebook", "Desierta"), (2, "a", "Notebook", "Cerrada"), (3, "a", "Notebook", "Publicada"), (4, "b", "Silla", "Cerrada"), (5, "", "Notebook", "Cerrada"), (6, "c", "Monitores y solo tinta", "Publicada"), (7, "d", "Laptop", "publicada")]
    df = spark.createDataFrame(rows, "i int, IDLicitacion string, NombreLicitacion string, Estado string")
    assert {r.i: r.reason for r in catalog.judged(df, "i").collect()} == {1: "estado", 2: "conservada", 3: "duplicada", 4: "rubro", 5: "sin_codigo", 6: "rubro", 7: "conservada"}
    assert catalog.funnel(df, "i").first().asDict() == {"total": 7, "duplicada": 1, "estado": 1, "rubro": 2, "conservada": 2, "scrapeable": 1}
    new = catalog.queue(df, "i", url="u/{}").withColumn("fecha_publicacion", F.lit("02/2025"))
    assert [(r.codigo, r.scraping_estado, r.url_ficha) for r in new.orderBy("codigo").collect()] == [("a", "pendiente", "u/a"), ("d", "no_aplica", "u/d")]
    old = spark.createDataFrame([("a", "ok", "01/2025", "3"), ("z", "", "01/2025", "")], "codigo string, scraping_estado string, fecha_publicacion string, n_ofertas string")
    merged = catalog.merge_queue(new, old).collect()
    assert [(r.codigo, r.scraping_estado, r.fecha_publicacion, r.n_ofertas) for r in merged] == [("z", None, "01/2025", None), ("a", "ok", "02/2025", "3"), ("d", "no_aplica", "02/2025", None)]
    assert [r.codigo for r in catalog.pending(catalog.merge_queue(new, old), 1).collect()] == ["z"]
    assert [r.codigo for r in catalog.pending(catalog.merge_queue(new, old), retry=True).collect()] == ["z", "d"]


def test_gold(spark, tmp_path):
    item = {"tipo": "notebook", "marca": "HP", "cantidad": 2, "precio_unitario": 100, "precio_total": 200}
    (tmp_path / "v1.json").write_text(json.dumps({"t": {"s": [item | {"marca": "Dell"}], "empty": []}}), encoding="utf-8")
    (tmp_path / "v2.json").write_text(json.dumps({"t": {"s": [item, item | {"marca": "*", "tipo": "*"}, item | {"precio_unitario": 900}, item | {"precio_unitario": 50, "ambiguo": True}]}}), encoding="utf-8")
    gold = evaluation.read_gold(spark, str(tmp_path))
    assert sorted((r.supplier, r.seq, r.brand) for r in gold.where("seq < 2 OR seq IS NULL").collect() if r.seq is not None) == [("s", 0, "HP"), ("s", 1, "*")]
    assert gold.where("supplier = 'empty' AND seq IS NULL").count() == 1
    rows = [("t", "s", 1, "notebook", "Hewlett-Packard", 2.0, 100.5, 200.0, "ok"), ("t", "s", 2, "monitor", None, None, 100.0, 201.0, "ok"), ("t", "s", 3, "notebook", "HP", 2.0, 50.0, 100.0, "revisar"), ("t", "empty", 1, "x", None, 1.0, 5.0, 5.0, "ok"), ("other", "s", 1, "x", None, 1.0, 5.0, 5.0, "ok")]
    found = spark.createDataFrame(rows, "tender string, supplier string, seq int, type string, brand string, quantity double, unit double, total double, state string")
    pairs = evaluation.matched(gold, found)
    assert sorted(r.kind for r in pairs.collect()) == ["ambiguo", "falta", "par", "par", "sobra"]
    s = evaluation.score(pairs).first()
    assert (s.gold, s.recall, s.precision, s.brand_ok, s.type_ok, s.quantity_ok, s.total_ok, s.reliability, s.false_positives, s.ok_products) == (3, 0.667, 0.667, 1.0, 1.0, 0.5, 1.0, 0.333, 1, 3)


def test_sheets(spark):
    products = spark.createDataFrame([("t", "s", 1, "Notebook", "HP", "notebook", 1.0, 5.0, 5.0, "a.pdf", "p.pdf", 2, ["a.pdf", "z.pdf"], ["x", "y"], "ok")], "tender string, supplier string, seq int, product string, brand string, type string, quantity double, unit double, total double, file string, price_file string, page int, sources array<string>, alerts array<string>, state string")
    row = reports.product_sheet(products).first()
    assert len(row) == 15 and row["Fuente de información"] == "Producto: a.pdf (p. 2); Precio: p.pdf (p. 2); Respaldo: z.pdf" and row["Alertas"] == "x; y"
    audited = products.withColumns({"level": F.lit("verificado"), "reasons": F.array(F.lit("rescatado_de_fila_economica"))})
    suppliers = spark.createDataFrame([("t", "s"), ("t", "n")], "tender string, supplier string")
    unread = spark.createDataFrame([("t", "n", "x.pdf", "sin_texto")], "tender string, supplier string, file string, reason string")
    sheets = reports.audit_sheets(audited, suppliers, unread)
    assert {r.tender: (r.suppliers, r.products, r.ratio, r.rescued, r.without_products, r.with_unread) for r in sheets["Resumen"].collect()} == {"t": (2, 1, 1.0, 1, 1, 1), "TOTAL": (2, 1, 1.0, 1, 1, 1)}
    assert sheets["Sin_productos"].first().unread == "x.pdf (sin_texto)" and sheets["Sin_leer"].count() == 1 and sheets["Productos"].first().reasons == "rescatado_de_fila_economica"
    assert json.loads(reports.review_rows(products, ["tender", "supplier"]).first().record)["product"] == "Notebook"
    steps = spark.range(1).select(reports.steps(F.array(F.lit("precio_reconciliado_fuente")), F.lit("vision"), F.lit("descripcion")).alias("s")).first().s
    assert len(steps) == 4 and steps[0].startswith("se leyó la página")
    assert spark.createDataFrame([("76__Acme SpA",), ("77",)], "f string").select(reports.folder_parts(F.col("f")).alias("x")).select("x.*").collect() == [("76", "Acme SpA"), ("77", "")]


def test_summaries(spark):
    key = ["tender", "supplier"]
    files = spark.createDataFrame([("t", "s", "a", "ok", None, 5, None), ("t", "s", "b", "http_500", 2, None, "m"), ("t", "s", "c", "solo_texto", 1, 9, "m")], "tender string, supplier string, file string, state string, calls int, tokens int, model string")
    merges = spark.createDataFrame([("t", "s", "ok", 0, 7, "k"), ("t", "n", "omitida", 0, 0, None)], "tender string, supplier string, merge_state string, merge_calls int, merge_tokens int, merge_model string")
    usage = reports.usage_rows(files, merges, key)
    assert sorted((r.call, r.file, r.calls, r.tokens) for r in usage.collect()) == [("archivo", "a", 1, 5), ("archivo", "b", 2, 0), ("consolidacion", "", 1, 7)]
    products = spark.createDataFrame([("t", "s", "ok"), ("t", "s", "revisar")], "tender string, supplier string, state string")
    pending = spark.createDataFrame([("t", "n", "x.pdf")], "tender string, supplier string, file string")
    got = {r.supplier: (r.products, r.valid, r.to_review, r.calls, r.errors, r.ocr, r.unsupported) for r in reports.supplier_summary(products, usage, pending, pending.limit(0), key).collect()}
    assert got == {"s": (2, 1, 1, 4, 1, 0, 0), "n": (0, 0, 0, 0, 0, 1, 0)}
    assert [tuple(r) for r in reports.decisions(spark.createDataFrame([("ok",), ("",), (None,)], "decision string")).collect()] == [("pendiente", 2), ("ok", 1)]
    offers = spark.createDataFrame([("t", "s", {"a": "u"}), ("t", "n", {})], "tender string, supplier string, links map<string,string>")
    assert reports.download_counts(files.select("tender", "supplier"), offers, ["tender"]).first().asDict() == {"tender": "t", "offers": 2, "without_links": 1, "files": 3, "with_files": 1}


@pytest.mark.parametrize(
    ("answer", "status", "n"),
    [
        ('{"productos": [{"producto": "x"}]}', "ok", 1), ('note {"x":1} answer {"productos":[{"producto":"a"},{"producto":"b"}]}', "ok_extraido", 2), ('```json\n{"productos": []}\n```', "ok", 0), ('{"productos": [],}', "ok_reparado", 0),
        ('first {"x": 1} last', "ok_extraido", None), ("{ nothing", "json_invalido", None), ("nothing", "sin_json", None), (None, "sin_json", None), ('{"a": "}"} {"productos": [{"producto": "}{"}]}', "ok_extraido", 1),
    ],
)
def test_parse_answer(spark, answer, status, n):
    row = readers.parse_answer(spark.createDataFrame([(answer,)], "answer string")).first()
    assert row.status in ((status, "sin_json") if status == "json_invalido" else (status,))
    assert (len(row.value.productos) if row.value is not None and row.value.productos is not None else None) == n


def test_unread_files(spark):
    rows = [("a.pdf", 0, "ok", False, False), ("b.docx", 0, "ok", False, False), ("c.pdf", 9, "http_500", True, False), ("d.zip", 0, "ok", False, True), ("e.rar", 0, "ok", False, True), ("_extraidos/d/x.pdf", 5, "solo_texto", False, False)]
    df = spark.createDataFrame([("s", *r) for r in rows], "supplier string, file string, n_chars int, model_state string, needs_ocr boolean, unsupported boolean")
    got = {(r.file, r.reason) for r in evidence.unread_files(df, ["supplier"], incremental.OK_STATES, incremental.NEUTRAL_STATES).collect()}
    assert got == {("a.pdf", "sin_texto"), ("c.pdf", "fallo_modelo"), ("c.pdf", "necesita_ocr"), ("e.rar", "no_soportado")}


def test_boxes(spark):
    words = [("t", "a.pdf", 1, 10.0, 100.0, 50.0, 110.0, "Notebook"), ("t", "a.pdf", 1, 60.0, 101.0, 90.0, 111.0, "X100A"), ("t", "a.pdf", 1, 100.0, 100.0, 140.0, 110.0, "$500.000"), ("t", "a.pdf", 1, 150.0, 100.0, 160.0, 110.0, "2,00"), ("t", "a.pdf", 1, 10.0, 130.0, 50.0, 140.0, "1.000.000")]
    w = spark.createDataFrame(words, "tender string, file string, page int, x0 double, top double, x1 double, bottom double, text string")
    p = spark.createDataFrame([("t", 1, "a.pdf", 1, "Notebook", "X100A", 500000.0, None, 2.0, (0.0, 95.0, 200.0, 115.0)), ("t", 2, "a.pdf", 1, "Notebook", "X100A", 500000.0, 1000000.0, 2.0, (0.0, 95.0, 200.0, 115.0))], "tender string, seq int, file string, page int, product string, model string, unit double, total double, quantity double, box struct<x0:double,top:double,x1:double,bottom:double>")
    got = {r.seq: (r.line, r.missing, r.located) for r in layout.box_evidence(p, w, ["tender"]).collect()}
    assert got == {1: ("Notebook X100A $500.000 2,00", [], "exacto"), 2: ("Notebook X100A $500.000 2,00", ["total"], "parcial")}
    best = {r.seq: (r.top, r.located) for r in layout.line_evidence(p.drop("box", "file", "page"), w, ["tender"]).collect()}
    assert best == {1: (100.0, "exacto"), 2: (100.0, "parcial")}


def test_identity_evidence(spark):
    p = spark.createDataFrame([("t", 1, "Notebook ProBook 450-G9 gris", "B7KF9AT (nuevo)", "HP"), ("t", 2, "Silla", None, None)], "tender string, seq int, product string, model string, brand string")
    terms = [r.t for r in p.select(evidence.identity_terms(F.col("product"), F.col("model"), F.col("brand")).alias("t")).collect()]
    assert terms == [["B7KF9AT", "450-G9", "Notebook ProBook 450-G9"], []]
    blocks = spark.createDataFrame([("t", "a.pdf", 1, "nada\nequipo probook 450 g9\notra")], "tender string, file string, page int, text string")
    assert [(r.seq, r.term, r.line_no) for r in evidence.identity_evidence(p, blocks, ["tender"]).collect()] == [(1, "450-G9", 1)]


def test_months_and_resume(spark):
    months = spark.createDataFrame([("2025-01",), ("2025-02",), ("2025-03",)], "mes string")
    done = spark.createDataFrame([("2025-01", "bajado"), ("2025-02", "bajado"), ("2025-02", "extraido")], "mes string, step string")
    assert [tuple(r) for r in incremental.month_plan(months, done).orderBy("mes").collect()] == [("2025-01", "extraer", "2025-03"), ("2025-02", "nada", None), ("2025-03", "bajar", None)]
    assert {r.step for r in incremental.month_plan(months, done, first_run=True).collect()} == {"bajar"}
    q = spark.createDataFrame([("a", "pendiente"), ("b", "ok")], "codigo string, scraping_estado string")
    out = incremental.resume(q, spark.createDataFrame([("a", "error")], "codigo string, scraping_estado string"))
    assert {r.codigo: r.scraping_estado for r in out.collect()} == {"a": "error", "b": "ok"}
    files = lambda *x: spark.createDataFrame([("s", *r) for r in x], "supplier string, file string, v int")
    kept = incremental.reuse_files(files(("a", 1), ("b", 1), ("c", 1)), files(("b", 2)), files(("b", 0), ("c", 0)), ["supplier"])
    assert sorted((r.file, r.v) for r in kept.collect()) == [("a", 1), ("b", 2)]


def test_pack_rows(spark):
    rows = spark.createDataFrame([("a", i, s, im) for i, (s, im) in enumerate([(5, 0), (5, 1), (5, 1), (20, 0), (1, 0), (9, 2)])] + [("b", 0, 99, 0)], "k string, i int, s int, im int")
    got = lambda **o: [r.call for r in extract.pack_rows(rows, ["k"], ["i"], "s", 10, **o).where("k = 'a'").orderBy("i").collect()]
    assert got() == [0, 0, 1, 2, 3, 3]
    assert got(images="im", max_images=2) == [0, 0, 1, 2, 3, 3]
    assert got(images="im", max_images=1) == [0, 0, 1, 2, 3, 4]


def test_overlapping_against_all_pairs(spark):
    import random

    r = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    sets = lambda n: [(i, r.sample(words, r.randint(0, 12))) for i in range(n)]
    a, b = sets(40), sets(60)
    want = {(i, j) for i, x in a for j, y in b if len(set(x) & set(y)) >= 3 and len(set(x) & set(y)) >= 0.5 * min(len(x), len(y))}
    got = link.overlapping(spark.createDataFrame(a, "id int, t array<string>"), spark.createDataFrame(b, "id int, t array<string>"), 0.5, 3)
    assert {(x.a_id, x.b_id) for x in got.collect()} == want and want


def test_line_hints(spark):
    text = "Notebook HP\nPrecio $ 500\nnada\n" + "x" * 400
    got = spark.createDataFrame([(text,)], "t string").select(extract.line_hints(F.col("t")).alias("h")).first().h
    assert (got.products, got.prices) == (["Notebook HP"], ["Precio $ 500"])


def test_places(spark):
    rows = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), (F.col("id") * 37 % 1000 / 7).cast("int").alias("g")).repartition(5)
    got = sorted((r.place, r.k) for r in window.placed(rows, "g", "k").collect())
    assert got == [(i, i) for i in range(1000)]
    assert window.placed(rows.limit(0), "g", "k").count() == 0
