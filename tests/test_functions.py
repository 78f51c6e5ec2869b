"""Truth tables of the column functions."""

import pytest
from docrel.functions import numbers as N
from docrel.functions import products as PR
from docrel.functions import text as TX
from pyspark.sql import functions as F


def one(spark, values, f, ddl="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")
    return [r.o for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_parse_number(spark):
    got = one(spark, ["214.555.-", "$ 1.409", "1.5", "3,250,000", "12,5", "1.234,56", "1.2.3", "", None, "abc", "-700", "471.111"], N.parse_number)
    assert got == [214555.0, 1409.0, 1.5, 3250000.0, 12.5, 1234.56, None, None, None, None, 700.0, 471111.0]


def test_parse_budget(spark):
    assert one(spark, ["21000000", "21.000.000", "123,50", "Entre 100 y 1000 UTM", "", None], N.parse_budget) == [21000000, 21000000, 12350, None, None, None]


def test_month(spark):
    got = one(spark, ["05/11/2025 10:00:00", "5/11/2025", "2025-11-05", "2025-11-05 08:00:00", "2025/3", "el 3/4/2024 fue", "junk", None], N.month)
    assert got == ["2025-11", "2025-11", "2025-11", "2025-11", "2025-03", "2024-04", "sin_fecha", "sin_fecha"]


def test_near_treats_null_as_equal(spark):
    df = spark.createDataFrame([(100.0, 101.0), (100.0, 102.0), (None, 5.0), (1.0, 2.0), (1.0, 2.5)], "a double, b double")
    assert [r.o for r in df.select(N.near(F.col("a"), F.col("b")).alias("o")).collect()] == [True, False, True, True, False]


def test_vat(spark):
    df = spark.createDataFrame([(2.0, 1000.0, 2380.0), (2.0, 1000.0, 2000.0), (2.0, 1000.0, 2500.0), (None, 1000.0, 1190.0)], "q double, u double, t double")
    assert [r.o for r in df.select(N.net_of_vat(F.col("q"), F.col("u"), F.col("t")).alias("o")).collect()] == [2000.0, 2000.0, 2500.0, 1190.0]


def test_normalisers_differ_on_accents(spark):
    assert one(spark, ["Impresión ÑANDÚ"], TX.fold) == ["impresion nandu"]
    assert one(spark, ["Impresión  X-1"], TX.tokens_text) == ["impresi n x 1"]


def test_codes(spark):
    assert one(spark, ["Notebook X100A con 16GB ddr4 y A1B2 abc 1234"], TX.model_codes) == [["x100a", "16gb", "ddr4", "a1b2"]]
    assert one(spark, ["Notebook X100A con 16GB ddr4 y A1B2"], TX.distinctive_codes) == [["x100a"]]
    assert one(spark, ["HP 15-FC0022LA i5-1335U 512GB B7KF9AT DDR5"], TX.distinctive_codes) == [["15-fc0022la", "b7kf9at"]]
    assert one(spark, ["Notebook de 14 con 16 gb ram para oficina"], TX.content_tokens) == [["notebook", "oficina"]]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Notebook Lenovo", "equipo"), ("PORTÁTIL", "equipo"), ("Monitor 24 con cable HDMI", "monitor"), ("Impresora a tinta", "impresora"), ("Smart TV 55", None), ("Estuche para MacBook", None),
        ("Carro de carga para 45 notebooks", None), ("Escáner ADS", None), ("Multifuncional con escaner", "impresora"), ("ARMADO COMPUTADOR", None), ("Servidor rack", None), ("Memoria RAM 16GB", None),
        ("Tóner negro", None), ("Pantalla display 22", "monitor"), ("Silla", None), ("HP Maletín notebook", None), ("3 All in One Delta", "equipo"),
    ],
)
def test_scope(spark, text, want):
    assert one(spark, [text], lambda c: PR.scope(c)) == [want]


def test_brands_and_types(spark):
    assert one(spark, ["hewlett-packard", "LENOVO", "intel", "Asus/MSI", "Genérica", "Acme  Corp", "", None], PR.brand) == ["HP", "Lenovo", None, None, None, "Acme Corp", None, None]
    assert one(spark, ["Laptop", "ALL_IN ONE", "Estación de trabajo", "mini-pc", "x", None], PR.type_name) == ["notebook", "all-in-one", "workstation", "desktop", None, None]


def test_equipment_type(spark):
    df = spark.createDataFrame([(None, "equipo", "ThinkStation P3", None, None), ("desktop", "equipo", "EcoTank L3250", None, "Epson"), (None, "monitor", "x", None, None), (None, "equipo", "cosa", None, None)], "d string, c string, t string, m string, b string")
    got = [r.o for r in df.select(PR.equipment_type(*map(F.col, "dctmb")).alias("o")).collect()]
    assert got == ["workstation", "impresora", "monitor", "equipo (sin especificar)"]


def test_document_kind_and_pages(spark):
    assert one(spark, ["Oferta Económica.xlsx", "ficha_tecnica_precio.pdf", "ficha.pdf", "acta.pdf", None], PR.document_kind) == ["economico", "economico", "tecnico", "otro", "otro"]
    assert one(spark, ["total 1.000.000", "Marca: X", "hdmi y ssd", "solo hdmi", None], PR.page_relevant) == [True, True, True, False, False]
    assert one(spark, [" ".join(["x"] * 30 + ["palabra"] * 12), " ".join(["de"] * 50), "corto"], PR.garbage) == [True, False, False]


def test_small_ones(spark):
    assert one(spark, [1, 26, 27, 52, 53, 702, 703, 728, 729, 1378, 1379, 18278], TX.column_letter, "int") == ["A", "Z", "AA", "AZ", "BA", "ZZ", "AAA", "AAZ", "ABA", "AZZ", "BAA", "ZZZ"]
    assert one(spark, ["Item 4", "43211503", "4 de 5", None], N.item_number) == [4, None, None, None]
    assert one(spark, [1234567], N.thousands, "long") == ["1.234.567"]
    assert one(spark, ["a 1.200 b 35 1.200", "1,234,567 y 99,5. 1.409.- 1.2.3 7,", None], N.numbers_in) == [[1200, 35], [1234567, 100, 1409, 7], []]
    assert one(spark, ["$ 1.234.567 y 999 1,500 x1.000 12.345.678.901"], N.plausible_amounts) == [[1234567, 1500]]
    assert one(spark, ["650.000,00", "$650.000", "6500001", "650", "65000000", None], lambda c: N.word_is_amount(c, F.lit(650000.0))) == [True, True, False, False, True, False]
    assert one(spark, ["10,00", "10.00", "(10)", "101", "$10", None], lambda c: N.word_is_whole(c, F.lit(10.0))) == [True, True, True, False, True, False]
    assert one(spark, [1234567.0, 12.5, 40.0], N.cell_text, "double") == ["1.234.567", "12.5", "40"]
    assert one(spark, ["$ 4", "$ 9.282.000", None], N.offered_total) == [None, 9282000.0, None]


def test_fold_is_compatibility_decomposition(spark):
    import unicodedata

    values = ["Nº 5 ﬁn", "ＡＢＣ ½ ™", "ÑANDÚ ß Œ Ø", "…x ⅷ", "plain", "", "e\u0301"]
    assert one(spark, values, TX.fold) == [unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode().lower() for v in values]


@pytest.mark.parametrize(
    ("path", "text", "want"),
    [
        ("a/economico__01__x.pdf", "", "economico"), ("ADMINISTRATIVO__02__precio.pdf", "", "administrativo"), ("Ficha técnica.pdf", "", "tecnico"), ("doc.pdf", "Declaración jurada simple", "administrativo"), ("doc.pdf", "total neto $ 1.250.000", "economico"),
        ("doc.pdf", "procesador i5, memoria RAM 16, pantalla 14", "tecnico"), ("doc.pdf", "procesador y pantalla", "otro"), ("doc.pdf", None, "otro"),
    ],
)
def test_document_role(spark, path, text, want):
    df = spark.createDataFrame([(path, text)], "p string, t string")
    assert df.select(PR.document_role(F.col("p"), F.col("t"))).first()[0] == want


def test_attachments_without_an_offer(spark):
    df = spark.createDataFrame([("administrativo__01__carnet.pdf",), ("administrativo__02__cotizacion_firma.pdf",), ("tecnico__carnet.pdf",), ("x\\administrativo__Poder.pdf",)], "p string")
    assert [r[0] for r in df.select(PR.administrative_noise(F.col("p"))).collect()] == [True, False, False, True]
    assert one(spark, ["Declaracion jurada.pdf", "oferta declaracion.pdf", "123-45-SE24.pdf", "plan.pdf"], PR.attachment_noise) == [True, False, True, False]
    rows = [("", "x.pdf"), ("nada que ver", "x.pdf"), ("Notebook HP", "x.pdf"), ("certificado de equipo notebook", "ISO 9001.pdf"), ("Marca: HP notebook", "garantia.pdf"), ("FILA 1: notebook", "garantia.pdf"), ("Notebook", "orden_de_compra 1.pdf")]
    df = spark.createDataFrame(rows, "t string, n string")
    assert [r[0] for r in df.select(PR.no_equipment(F.col("t"), F.col("n"))).collect()] == [True, True, False, True, False, False, True]
    assert one(spark, ["Channel Error: x", "no model loaded", "connection reset by peer", "timeout", None], PR.transient_error) == [True, True, True, False, False]


def test_tables_and_rectangles(spark):
    df = spark.createDataFrame([([["a", "b"], ["c", None], ["", " "]],), ([["a"], ["b"], ["c", "d"]],), ([[""]],)], "r array<array<string>>")
    assert [r[0] for r in df.select(PR.table_structured(F.col("r"))).collect()] == [True, False, False]
    box = "struct<x0:double,top:double,x1:double,bottom:double>"
    df = spark.createDataFrame([((0.0, 0.0, 1.0, 1.0), [(1.0, 0.0, 2.0, 1.0)]), ((0.0, 0.0, 1.5, 1.0), [(1.0, 0.5, 2.0, 1.0)]), ((0.0, 0.0, 1.0, 1.0), [])], f"b {box}, bs array<{box}>")
    assert [r[0] for r in df.select(PR.outside(F.col("b"), F.col("bs"))).collect()] == [True, False, True]
