from pyspark.sql import functions as F

from millrace.llm import licenses
from tests.llm.conftest import ODD


def test_scan(spark):
    mit = licenses.KNOWN["MIT"][2]
    rows = [
        (1, mit.upper().replace(",", " ;")), (2, "Copyright 2020 Somebody\n" + mit.split("\n", 3)[3]), (3, mit + " and more"),
        (4, "text\n  released under the mit LICENCE!\nLicensed under CC BY-NC 4.0.\nmore"), (5, None), (5, None), (6, "Copyright me"),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, digest string, license string")
    got = [(r["doc_id"], r["license"], list(r["notices"])) for r in licenses.scan_licenses(df, licenses.known_table(spark)).collect()]
    # The second has no title line, which a known text of its own would need.
    assert sorted(got) == [
        (1, "MIT", []), (2, None, []), (3, None, []), (4, None, ["CC-BY-NC-4.0", "MIT"]), (5, None, []), (5, None, []), (6, None, []),
    ]


def test_canonical_is_the_same_in_both(spark, documents):
    more = spark.createDataFrame([("Licence, sub-licence\n(c) me\n© you\n   copyright\nÉ https://x favourable\x00",)], "text string")
    df = documents.select("text").union(more)
    for r in df.select("text", licenses.canonical_lines(F.col("text")).alias("c")).collect():
        assert list(r["c"]) == licenses.canonical(r["text"])


def test_odd(spark, odd, none, monkeypatch):
    known = licenses.known_table(spark)
    assert licenses.scan_licenses(odd, known).count() == len(ODD)
    assert licenses.scan_licenses(none, known).count() == 0
    assert licenses.scan_licenses(odd, known.limit(0)).filter("license is not null").count() == 0
    monkeypatch.setattr(licenses, "is_small", lambda df: False)
    assert licenses.scan_licenses(odd, known).count() == len(ODD)
