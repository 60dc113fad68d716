import re
from collections import Counter

from millrace.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    w = WORD.findall(text or "")
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(windows)
    repeat = {i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(3)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in rules.SYMBOLS for c in text or ""), dup, len(repeat)


def test_statistics(spark, odd, documents):
    extra = [(1, "a b c a b c d"), (2, "x\nx\n\n \nx y\nx"), (3, "##$ a|b\x0bc\x0cd\re")]
    for df in (documents.select("doc_id", "text"), odd, spark.createDataFrame(extra, "doc_id long, text string")):
        for r in rules.text_statistics(df).collect():
            got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
            assert got == brute(r["text"]), r["doc_id"]


def test_learning(spark, small, documents):
    labels = spark.read.parquet(f"{small}/../sf0.1/labels.parquet")
    docs = spark.read.parquet(f"{small}/../sf0.1/documents.parquet")
    stats = rules.text_statistics(docs.join(labels, "doc_id", "left_semi")).drop("text")
    learned = rules.learn_from(stats.checkpoint() if spark.sparkContext.getCheckpointDir() else stats.cache(), labels)
    assert learned.rules
    seen = rules.judged(stats, learned).join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    count = {(r["quality"], r["kept"]): r["count"] for r in seen}
    by_rule = rules.judged(stats, learned).join(labels, "doc_id").filter("rule > 0 and quality = 1").count()
    assert count[0, False] > 0.95 * (count[0, False] + count.get((0, True), 0))
    assert by_rule < 0.01 * (count[1, True] + count.get((1, False), 0))


def test_odd(spark, odd, none):
    labels = spark.createDataFrame([(6, 1), (7, 0), (None, 0), (9, None)], "doc_id long, quality int")
    kept = rules.keep_good(odd, labels)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [6, 7, 8, 9, 10]
    assert rules.keep_good(none, labels).count() == 0
    assert rules.keep_good(odd, labels.limit(0)).count() == 5
