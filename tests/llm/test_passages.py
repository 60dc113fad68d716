import numpy as np

from millrace.llm import passages
from millrace.llm.queries import op9_quality_attention
from tests.llm.conftest import ODD


def test_held_out(spark, small):
    folder = f"{small}/../sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = op9_quality_attention(spark, folder).join(labels, "doc_id").filter("held_out").collect()
    for label in (0, 1):
        of = [r for r in rows if r["quality"] == label]
        assert sum(r["predicted"] == label for r in of) >= 0.9 * len(of)


def test_gradient():
    """Against differences of the loss."""
    rng = np.random.default_rng(1)
    bags = [rng.random((n, passages.WIDTH)) for n in (1, 3, 2)]
    y, weight = np.array([1, 0, 1]), np.array([1.0, 2.0, 0.5])
    w = {
        "E": rng.normal(0, 0.2, (passages.WIDTH, 4)), "e": rng.normal(0, 1, 4), "V": rng.normal(0, 1, (4, 3)),
        "U": rng.normal(0, 1, (4, 3)), "w": rng.normal(0, 1, 3), "c": rng.normal(0, 1, 4), "c0": np.array([0.1]),
    }

    def loss():
        total = 0.5e-4 * (w["E"] ** 2).sum()
        for x, t, k in zip(bags, y, weight, strict=True):
            h = np.tanh(x @ w["E"] + w["e"])
            s = (np.tanh(h @ w["V"]) / (1 + np.exp(-(h @ w["U"])))) @ w["w"]
            a = np.exp(s) / np.exp(s).sum()
            p = 1 / (1 + np.exp(-(a @ h @ w["c"] + w["c0"][0])))
            total -= k * (t * np.log(p) + (1 - t) * np.log(1 - p)) / len(bags)
        return total

    for name, g in passages._gradient(w, bags, y, weight).items():
        at = tuple(rng.integers(0, n) for n in w[name].shape)
        kept = w[name][at]
        w[name][at] = kept + 1e-6
        high = loss()
        w[name][at] = kept - 1e-6
        low = loss()
        w[name][at] = kept
        assert abs((high - low) / 2e-6 - g[at]) < 1e-5, name


def test_whole_texts_are_encoded():
    text = "ab " * 400_000
    parts = list(passages.encoded(text))
    assert sum(map(len, parts)) == -(-len(text) // passages.PASSAGE) and max(map(len, parts)) == passages.SLAB


def test_odd(odd, none):
    empty = passages.fit([], np.zeros(0))
    got = passages.score_documents(odd, empty).collect()
    assert len(got) == len(ODD) and {r["score"] for r in got} == {0.5}
    one = passages.learn_attention(odd, odd.selectExpr("doc_id", "1 as quality").filter("doc_id = 6"))
    assert all(r["score"] > 0.9 for r in passages.score_documents(odd, one).collect())
    assert passages.score_documents(none, one).count() == 0


def test_score_against_a_plain_loop(texts):
    rng = np.random.default_rng(5)
    bags = [np.vstack(list(passages.encoded(t, 3))) for t in list(texts.values())[:20]]
    model = passages.fit(bags, rng.integers(0, 2, 20))

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    for text in [None, "", *list(texts.values())[20:30]]:
        want = []
        for w in model.members:
            data = (text or "").encode()
            rows, weights = [], []
            for at in range(0, max(len(data), 1), passages.PASSAGE):
                # A passage by itself is encoded as it is inside its text.
                (x,) = next(passages.encoded(data[at : at + passages.PASSAGE].decode("utf-8", "ignore")))[:1]
                x = np.clip((x - model.mean) / model.spread, -passages.FAR, passages.FAR)
                h = np.tanh(x @ w["E"] + w["e"])
                rows.append(h)
                weights.append(np.exp(sum(np.tanh(h @ w["V"])[k] * sigmoid(h @ w["U"])[k] * w["w"][k] for k in range(passages.GATE))))
            mixed = sum(a * h for a, h in zip(weights, rows, strict=True)) / sum(weights)
            want.append(sigmoid(mixed @ w["c"] + w["c0"][0]))
        assert abs(model.score(text) - np.mean(want)) < 1e-4


def test_repeated_ids_do_not_swell_the_sample(spark):
    rows = [(1, f"text {k}") for k in range(100)] + [(2, "one text")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    seen = []
    keep, passages.fit = passages.fit, lambda bags, y: seen.append(len(bags)) or keep(bags, y)
    try:
        passages.learn_attention(docs, labels, sample=50)
    finally:
        passages.fit = keep
    assert seen[0] <= 51
