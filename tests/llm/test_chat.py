from hashlib import sha256

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, piece string"


def test_examples(spark):
    rows = [(1, 0, "user", "hi", "x"), (1, 1, "assistant", "a<b", "x"), (1, 2, "user", "more", "x"), (1, 3, "assistant", "#2", "x")]
    got = chat.prefix_examples(spark.createDataFrame(rows, SCHEMA)).orderBy("position").collect()
    assert [(r["position"], r["n_context"], r["trainable"], r["is_last"]) for r in got] == [(2, 1, True, False), (4, 3, True, True)]
    assert got[1]["text"].startswith(got[0]["text"])
    assert [chat_text(r) for r in got] == ["a<b", "#2"]


def chat_text(row):
    part = row["text"][row["loss_start"] : row["loss_end"]]
    return part.replace("\\l", "<").replace("\\h", "#").replace("\\b", "\\")


def test_odd_conversations(spark):
    rows = [
        (1, None, None, None, ""), (1, 1, "assistant", "", ""), (2, 0, "user", "only", ""), (None, 0, "assistant", "x" * 100_000, ""),
        (3, 0, "user", "same", ""), (3, 0, "user", "same", ""),
    ]
    got = {r["conv_id"]: r for r in chat.conversation_digests(chat.prefix_examples(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert {k: (r["n_turns"], r["loss_chars"], r["n_examples"]) for k, r in got.items()} == {
        1: (2, 0, 1), 2: (1, 0, 0), None: (1, 100_000, 1), 3: (2, 0, 0)
    }
    assert got[1]["turns_sha256"] == sha256(b"\n\nassistant\n\n").hexdigest()
    assert chat.prefix_examples(spark.createDataFrame([], SCHEMA)).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a: b", "#\\"]), st.text("ab\\#<>/turn \n:###</é")), min_size=1, max_size=5))
def test_round_trip(spark, turns):
    rows = [(1, k, r, t, "") for k, (r, t) in enumerate(turns)]
    examples = chat.prefix_examples(spark.createDataFrame(rows, SCHEMA))
    read = examples.filter("is_last").select(chat.read_turns(F.col("text")).alias("t")).first()["t"]
    assert [(x["role"], x["text"]) for x in read] == turns
