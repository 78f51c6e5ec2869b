import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


WORDS = [f"wort{i}ab" if i % 3 else f"term{chr(97 + i % 26)}x{i}" for i in range(400)]


@pytest.fixture(scope="session")
def rows():
    """Documents with nulls, empty and long texts, ties, repeated rows, copies and shared passages."""
    import random

    r = random.Random(3)
    passage = " ".join(r.choice(WORDS) for _ in range(30))
    out = []
    for i in range(120):
        text = " ".join(r.choice(WORDS) for _ in range(r.randint(1, 80)))
        if i % 4 == 0:
            text = text + "\n" + passage + "\n" + "A Line that is Long enough, repeated \n short"
        if i % 7 == 0 and i:
            text = out[i - 1][1] or ""
        out.append((i, text, "en" if i % 2 else "de", f"src{i % 5}", len(text)))
    long = " ".join(r.choice(WORDS) for _ in range(20_000))
    out += [
        (200, None, "en", "src1", 0), (201, "", "en", "src1", 0), (202, "   \n\t\n ", None, None, 5), (203, long, "en", "src2", len(long)),
        (204, long + " tail", "en", None, len(long) + 5), (205, "é" * 300 + "ñ" * 60, "es", "src1", 360), (206, "a" * 500, "fr", "x", 500),
        (207, passage.upper(), "de", "src0", 1), (207, passage, "de", "src0", 1), (207, passage, "de", "src0", 1), (None, passage, "de", "src0", 1),
        (208, "\U0001f600 mail: jo.e@ex.example.com, ip 10.0.0.255 é +49 (30) 123-4567\nA Line that is Long enough, repeated", "en", "src9", 1),
        (209, "be " * 500, "en", "src3", 1500), (210, "\x00\x01 token: 'abc' \x0b", "en", "src3", 9),
    ]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
