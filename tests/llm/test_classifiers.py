"""Held-out accuracy and odd rows of the quality and toxicity classifiers."""

import zlib

import numpy as np
import pytest

from kinweave.llm import quality, toxicity
from kinweave.llm.labelled import training_rows

BIG = "/root/testdata/sf0.1"


def auc(scores, labels):
    order = np.argsort(scores)
    place = np.empty(len(scores))
    place[order] = np.arange(len(scores))
    return (place[labels == 1].mean() - place[labels == 0].mean()) / len(scores) + 0.5


@pytest.mark.parametrize("module,label,least", [(quality, "quality", 0.97), (toxicity, "toxic", 0.85)])
def test_held_out(spark, module, label, least):
    docs, labels = spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet")
    out = module.classify(docs, labels, columns=["doc_id"])
    rows = out.join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    s, y = np.array([r.score for r in held]), np.array([r[label] for r in held])
    cut = quality.CUT_SCORE if module is quality else 0.5
    assert auc(s, y) >= least and all(r.predicted == int(r.score >= cut) and 0 <= r.score <= 1 for r in rows)
    assert np.mean((s >= cut) == y) > 0.93


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows(spark, sf, module, label):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    odd = spark.createDataFrame(
        [(9001, None, None, None, None, 1.0), (9002, "", "en", "s", 0, 2.0), (None, "some words here", "en", "s", 5, 3.0), (9003, "word " * 60_000, "en", "s", 5, 4.0), (9003, "word " * 60_000, "en", "s", 5, 4.0)],
        "doc_id long, text string, lang string, source string, n_chars long, score double",
    )
    more = labels.union(spark.createDataFrame([(None, 1, 1), (9001, None, None), (9002, 7, 7), (1, 1, 0), (1, 0, 1)], labels.schema))
    everything = docs.unionByName(odd, allowMissingColumns=True)
    out = module.classify(everything, more).collect()
    assert len(out) == docs.count() + 5 and "score" in out[0].asDict()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert by[9001][0].score == by[9002][0].score and by[9003][0].score == by[9003][1].score and not by[None][0].held_out
    assert module.classify(docs.limit(0), labels).count() == 0
    unlabelled = module.classify(docs, labels.limit(0)).collect()
    assert len({r.score for r in unlabelled}) == 1
    # Neither source, language nor id is an input of a score.
    model = module.train(docs, labels)
    moved = docs.selectExpr("doc_id + 100000 as doc_id", "text", "'xx' as lang", "'yy' as source", "n_chars")
    a, b = ({r.text: r.score for r in module.score(d, model).collect()} for d in (docs, moved))
    assert a == b


def test_training_rows_hold_out_and_bound(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(500)] + [(3, 0, 0)], "doc_id long, quality int, toxic int")
    rows = training_rows(labels, "quality", 40, 1).collect()
    assert len(rows) == 80 and all(zlib.crc32(str(r.id).encode()) % 5 for r in rows) and 3 not in {r.id for r in rows}


def test_pairs_beat_noise():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, len(quality.FEATURES)))
    y = (x[:, 3] - x[:, 5] > 0).astype(int)
    model = quality.fit(x, y)
    assert auc(model.score(x), y) > 0.98 and model.weights[3] > 0 > model.weights[5]


def test_features_by_plain_loops():
    text = "Hello world, hello!\nTHE the end 42 \u00e9t\u00e9\nTHE the end 42 \u00e9t\u00e9"
    x = dict(zip(quality.FEATURES, quality.features(text)))
    raw, words, lines = text.encode(), text.encode().split(), text.encode().split(b"\n")
    assert np.isclose(x["log_words"], np.log(1 + len(words))) and np.isclose(x["distinct_words"], len(set(words)) / len(words))
    assert np.isclose(x["digits"], sum(chr(b).isdigit() for b in raw) / len(raw)) and np.isclose(x["upper"], sum(65 <= b <= 90 for b in raw) / len(raw))
    assert np.isclose(x["distinct_lines"], 2 / 3) and np.isclose(x["upper_words"], 2 / len(words)) and np.isclose(x["top_word"], 2 / len(words))
    assert np.isclose(x["sign_" + str(quality.SIGNS.index(b"!"))], np.log(1 + 10 / len(words))) and len(lines) == 3


def test_weights_minimise_the_pairs_loss():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((60, len(quality.FEATURES)))
    y = (x[:, 0] + 0.5 * rng.standard_normal(60) > 0).astype(int)
    seed, ridge = 5, 1e-3
    model = quality.fit(x, y, seed, ridge)
    z = np.clip((x - model.mean) / model.scale, -8, 8)
    better, worse = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    draw = np.random.default_rng(seed)
    pairs = min(quality.MAX_PAIRS, len(better) * len(worse))
    gap = z[draw.choice(better, pairs)] - z[draw.choice(worse, pairs)]

    def loss(w):
        return sum(float(np.log1p(np.exp(-g @ w))) for g in gap) / pairs + ridge * float(w @ w) / 2

    least = loss(model.weights)
    for i in range(0, len(model.weights), 7):
        for step in (-1e-2, 1e-2):
            moved = model.weights.copy()
            moved[i] += step
            assert loss(moved) >= least - 1e-9


def net_by_loops(net, text):
    """The logit of one text, filter by filter and place by place."""
    import re

    words = re.findall(r"[^\W_]+", text.lower())
    w = toxicity.words_of([text])
    vectors = [net.embed[w.buckets[c]].sum(0) for c in w.codes[: max(len(words), 1) + 2]]
    out, total = net.shift, 0.0
    for g, kernel in enumerate(net.kernels):
        for f in range(kernel.shape[2]):
            answers = [sum(float(vectors[p + j] @ kernel[j, :, f]) for j in range(len(kernel)) if p + j < len(vectors)) for p in range(max(len(words), 1))]
            at = g * toxicity.FILTERS + f
            total += np.tanh(max(answers) + net.bias[at]) * net.out[at] * 4
    return out + total


def test_net_by_plain_loops():
    net = toxicity.Net(2)
    texts = ["one two three four", "", "a", "Some words, and some more words!", "x y"]
    got = net.logits(toxicity.words_of(texts))
    assert np.allclose(got, [net_by_loops(net, t) for t in texts], atol=1e-4)


def test_step_follows_the_gradient():
    net = toxicity.Net(4)
    texts, y = ["bad bad words here", "all is good here today"], np.array([1, 0])
    w = toxicity.words_of(texts)

    def loss(n):
        p = 1 / (1 + np.exp(-n.logits(w)))
        return float(-np.log(np.where(y == 1, p, 1 - p)).mean())

    import copy

    moved, rate = copy.deepcopy(net), 1e-3
    before = loss(net)
    moved.step(w, y, np.ones(2), rate)
    by_step = {"out": (net.out - moved.out) / rate, "bias": (net.bias - moved.bias) / rate}
    for name, grad in by_step.items():
        for i in range(0, len(grad), 5):
            far = copy.deepcopy(net)
            getattr(far, name)[i] += 1e-2
            near = copy.deepcopy(net)
            getattr(near, name)[i] -= 1e-2
            assert abs((loss(far) - loss(near)) / 2e-2 - grad[i]) < 2e-3
    far = copy.deepcopy(net)
    far.kernels[1][0, 3, 2] += 1e-2
    near = copy.deepcopy(net)
    near.kernels[1][0, 3, 2] -= 1e-2
    assert abs((loss(far) - loss(near)) / 2e-2 - (net.kernels[1] - moved.kernels[1])[0, 3, 2] / rate) < 2e-3
    assert loss(moved) < before


def test_thresholds_of_few_texts_stay_near_that_of_all():
    rng = np.random.default_rng(0)
    bad, good = ["vile", "nasty", "rotten"], ["fine", "kind", "gentle"]
    text = lambda ws, lang: " ".join(rng.choice(ws, 2).tolist() + [lang] * 3 + [f"w{rng.integers(500)}" for _ in range(8)])
    rows = [(text(bad if i % 2 else good, "the"), i % 2) for i in range(800)] + [(text(bad if i % 2 else good, "nicht"), i % 2) for i in range(12)]
    net = toxicity.fit([r[0] for r in rows], np.array([r[1] for r in rows]))
    en, de, es = (net.thresholds[toxicity.LANGUAGES.index(x)] for x in ("en", "de", "es"))
    assert abs(de - es) < 1 and es == net.thresholds[-1]
    scores = net.scores(toxicity.words_of([r[0] for r in rows]))
    assert np.mean((scores >= 0.5) == np.array([r[1] for r in rows])) > 0.97
