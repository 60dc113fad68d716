from millrace.llm import language
from millrace.llm.queries import op3_language
from tests.llm.conftest import ODD


def test_held_out(spark, small):
    folder = f"{small}/../sf0.01"
    got = op3_language(spark, folder)
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").filter("held_out").collect()
    assert len(rows) > 150
    assert sum(r["lang"] == r["lang_pred"] for r in rows) > 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd(spark, odd, none):
    model = language.Dictionaries({"a": b"one two short", "b": b"eins zwei kurz"})
    got = language.predict_language(odd, model).collect()
    assert len(got) == len(ODD)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3)} == {"und"}
    assert language.predict_language(none, model).count() == 0
    assert language.learn_dictionaries(odd).content == {}
    assert {r["lang_pred"] for r in language.predict_language(odd, language.Dictionaries({})).collect()} == {"und"}


def test_margins():
    assert language.verdict({"b": 10, "a": 10}) == ("a", 0.5, True)
    assert language.verdict({"b": 10, "a": 20})[::2] == ("b", False)
    assert language.verdict({"b": 10}) [0] == "b"


def test_letters():
    assert language.letters("Ab² ½Ⅷ 12_c, é e\u0301 \u0301x हिन्दी") == "ab c é e\u0301 x हिन्दी"


def test_texts_without_letters_are_unknown(spark):
    model = language.Dictionaries({"a": b"one two short", "b": b"eins zwei kurz"})
    docs = spark.createDataFrame([(1, "² ½ Ⅷ"), (2, "12_3 ..."), (3, "\u0301\u0308"), (4, "ª")], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict_language(docs, model).collect()}
    assert [got[n] for n in (1, 2, 3)] == ["und"] * 3 and got[4] != "und"


def test_against_plain_compression(texts):
    """Each text by the command's own steps: a fresh compressor for every language and segment."""
    import zstandard

    model = language.Dictionaries({"a": b"the of and to in is was for " * 30, "b": b"der die und das von mit nicht ein " * 30})
    for text in list(texts.values())[:60]:
        data = language.letters(text or "").encode()
        want = {}
        for name, content in model.content.items():
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            params = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
            parts = [data[i : i + language.SEGMENT] for i in range(0, len(data), language.SEGMENT)]
            want[name] = sum(len(zstandard.ZstdCompressor(level=language.LEVEL, dict_data=known, **params).compress(p)) for p in parts)
        assert language.sizes(text or "", model) == (want if data else {})
