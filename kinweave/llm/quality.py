"""Quality scores by Bradley-Terry pairwise ranking.

A document's worth is a linear function of features of its whole text. The weights are
learnt from preference pairs, a document of label 1 preferred to one of label 0, by the
logistic loss of feature differences. The worth is cut at a quantile of the training
scores; scores are logistic in the distance to that cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm.labelled import held_out, training_rows

#: Bounds of the fit: labelled documents of each class, and preference pairs.
MAX_PER_CLASS = 10_000
MAX_PAIRS = 60_000
CUT_SCORE = 0.3
SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

FEATURES = (
    ["log_words", "log_chars", "word_length", "distinct_words", "distinct_pairs", "repeated_next", "distinct_lines", "line_length", "upper", "upper_words", "digits", "spaces", "lines", "not_ascii", "signs", "signs_per_word", "sign_kinds", "ends_in_sign", "short_words", "long_words", "top_word", "no_letters"]
    + [f"sign_{i}" for i in range(len(SIGNS))]
)


def features(text: str | None) -> np.ndarray:
    """The features of one whole text; null counts as empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words, lines = raw.split(), raw.split(b"\n")
    n, w = max(len(raw), 1), max(len(words), 1)
    kinds = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    signs = kinds[list(SIGNS)]
    counts: dict[bytes, int] = {}
    for x in words:
        counts[x] = counts.get(x, 0) + 1
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = sum(1 for x in words if x[-1] in SIGNS)
    row = [
        np.log1p(len(words)), np.log1p(len(raw)), lengths.sum() / w, len(counts) / w,
        len(set(zip(words, words[1:]))) / w, sum(map(bytes.__eq__, words, words[1:])) / w,
        len(set(lines)) / len(lines), np.log1p(n / len(lines)),
        kinds[65:91].sum() / n, sum(map(bytes.isupper, words)) / w, kinds[48:58].sum() / n, kinds[32] / n, len(lines) / w,
        kinds[128:].sum() / n, signs.sum() / n, np.log1p(signs.sum() / w), (signs > 0).sum() / len(SIGNS), ends / w,
        (lengths <= 2).sum() / w, (lengths >= 15).sum() / w, max(counts.values(), default=0) / w, float(kinds[65:91].sum() + kinds[97:123].sum() + kinds[128:].sum() == 0),
    ]
    return np.concatenate([row, np.log1p(10 * signs / w)]).astype(np.float32)


@dataclass
class Model:
    """Standardised features, weights, the cut and the slope of the score."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def worth(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.slope * (self.worth(x) - self.cut) + np.log(CUT_SCORE / (1 - CUT_SCORE))
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 5, ridge: float = 1e-3) -> Model:
    """Bradley-Terry weights from pairs of a better and a worse document, by Newton's method.

    With one class only there are no pairs: every document then scores alike, just above
    the cut if the labels are 1 (or there are none), just below if they are 0.
    """
    width = len(FEATURES)
    better, worse = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(better) or not len(worse):
        return Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0 if len(better) or not len(worse) else 1.0, 1.0)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    pairs = min(MAX_PAIRS, len(better) * len(worse))
    gap = z[rng.choice(better, pairs)] - z[rng.choice(worse, pairs)]
    weights = np.zeros(width)
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(gap @ weights, -35, 35)))  # the chance given to the wrong order
        step = np.linalg.solve((gap * (p * (1 - p))[:, None]).T @ gap / pairs + ridge * np.eye(width), gap.T @ p / pairs - ridge * weights)
        weights = weights + step * min(1.0, 4 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-5:
            break
    worth = z @ weights
    # The cut: the quantile of all training scores that parts the classes best, between two scores.
    order = np.argsort(worth, kind="stable")
    s, l = worth[order], y[order]
    below1 = np.concatenate(([0], np.cumsum(l == 1))) / len(better)
    below0 = np.concatenate(([0], np.cumsum(l == 0))) / len(worse)
    gain = below0 - below1
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    q = int(best[len(best) // 2])
    cut = float((s[max(q - 1, 0)] + s[min(q, len(s) - 1)]) / 2)
    slope = 1.0
    for _ in range(50):  # the slope alone, by the labels' likelihood
        t = slope * (worth - cut) + np.log(CUT_SCORE / (1 - CUT_SCORE))
        p = 1 / (1 + np.exp(-np.clip(t, -35, 35)))
        d = worth - cut
        step = ((y - p) * d).mean() - 1e-3 * slope
        slope = float(np.clip(slope + step / ((p * (1 - p) * d * d).mean() + 1e-3), 0.05, 20))
    return Model(mean, scale, weights, cut, slope)


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", per_class: int = MAX_PER_CLASS, seed: int = 5, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from at most ``per_class`` labelled, not held out documents of each class.

    Defined cases: null texts count as empty; labels without a document, other than 0 and 1
    or of a null id are left out, as is an id with both labels; a document id that repeats
    is used as often as it stands; without labels, or with one class only, see ``fit``;
    other columns are not read.
    """
    chosen = F.broadcast(training_rows(labels, label, per_class, seed))  # at most 2 * per_class rows
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(chosen, "id").select("label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float32()))], names=["label", "x"])

    rows = sample.mapInArrow(run, "label int, x array<float>").toArrow()
    if not rows.num_rows:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1).astype(np.float64)
    y = rows.column("label").to_numpy()
    order = np.lexsort((*x.T[:6], y))  # not as the tasks ended
    return fit(x[order], y[order], seed)


def score(docs: DataFrame, model: Model, *, columns: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """``columns`` (None: all) of ``docs`` with ``score`` and ``predicted`` (score at least CUT_SCORE).

    Only the text is looked at. Defined cases: a null text scores like an empty one;
    repeated rows each give a row; an empty table gives an empty table; input columns
    named ``score`` or ``predicted`` are replaced. Texts of any length are read whole.
    """
    keep = [c for c in (columns if columns is not None else docs.columns) if c not in ("score", "predicted")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                x = np.array([features(t.as_py()) for t in part.column(0)], dtype=np.float64).reshape(part.num_rows, -1)
                s = model.score(x) if part.num_rows else np.zeros(0)
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(1, part.num_columns)] + [pa.array(s), pa.array(s >= CUT_SCORE).cast(pa.int32())], names=[*keep, "score", "predicted"])

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + ["score double", "predicted int"]
    return docs.select(docs[text_col].alias("kw_text"), *[docs[c] for c in keep]).mapInArrow(run, ", ".join(fields))


def classify(docs: DataFrame, labels: DataFrame, *, columns: list[str] | None = None, id_col: str = "doc_id", **fit_args) -> DataFrame:
    """Trains on ``labels`` and scores ``docs``, with ``held_out`` by id."""
    return score(docs, train(docs, labels, id_col=id_col, **fit_args), columns=columns).withColumn("held_out", held_out(F.col(id_col)))
