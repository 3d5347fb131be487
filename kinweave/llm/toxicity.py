"""Toxicity scores by a convolutional text classifier.

A word's embedding is the sum of hashed vectors of the word and of two of its prefixes.
Filters of widths 1 to 3 run over all words of a text, the largest answer of each is
kept, and a logistic layer weighs them. The net is trained in numpy on a bounded sample
of labelled documents; the first embedding coordinate starts from the log odds with which
a bucket occurs in either class. Thresholds are calibrated for each language on a part of
the sample that training does not see; a language's own threshold is drawn towards that
of all languages by the number of its texts in the smaller class, so that few texts move
it little. The language is guessed from the text itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm.labelled import held_out, training_rows

#: Bounds of the fit: labelled documents of each class, and the longest text it takes.
MAX_PER_CLASS = 4000
MAX_TRAIN_CHARS = 20_000
#: So many texts of the smaller class weigh as much as the threshold of all languages.
PRIOR_TEXTS = 30

BUCKETS = 1 << 17
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIXES = (4, 5)

#: Common words that tell the languages apart.
LANGUAGE_WORDS = {
    "en": "the of and to in is that it was for on are as with be at this have from",
    "fr": "le les des du et un une qui dans pour pas au avec par sur plus est",
    "de": "der die das dem und von zu mit sich auf ist im nicht ein eine als auch",
    "es": "el los las del y en se lo con para su al como una por",
}
LANGUAGES = [*LANGUAGE_WORDS, "other"]
_LANGUAGE_OF = {w: sum(2**i for i, ws in enumerate(LANGUAGE_WORDS.values()) if w in ws.split()) for ws in LANGUAGE_WORDS.values() for w in ws.split()}

_words = re.compile(r"[^\W_]+").findall


@dataclass
class Words:
    """The words of some texts: distinct ones by bucket, and each text's run of them."""

    buckets: np.ndarray  # distinct words (and the blank last) by word and prefixes
    codes: np.ndarray  # all texts one after the other, each followed by two blanks
    starts: np.ndarray
    ends: np.ndarray
    language: np.ndarray


def words_of(texts: list[str | None]) -> Words:
    """Null counts as empty; an empty text is one blank."""
    split = [_words((t or "").lower()) for t in texts]
    flat = np.empty(sum(map(len, split)), dtype=object)
    flat[:] = [w for ws in split for w in ws]
    codes, distinct = pd.factorize(flat) if len(flat) else (np.zeros(0, np.int64), flat)
    blank = len(distinct)
    forms = [distinct] + [np.array([w[:n] for w in distinct], dtype=object) for n in PREFIXES]
    salts = [np.uint64(0x9E3779B97F4A7C15 * (i + 1) % 2**64) for i in range(len(forms))]
    hashes = [(pd.util.hash_array(f, categorize=False) ^ s) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(47) if blank else np.zeros(0, np.uint64) for f, s in zip(forms, salts)]
    buckets = np.vstack([np.stack(hashes, axis=1).astype(np.int64).reshape(blank, len(forms)), np.full((1, len(forms)), BUCKETS)])
    lengths = np.array([len(ws) for ws in split], dtype=np.int64)
    runs = np.maximum(lengths, 1)
    starts = np.concatenate(([0], np.cumsum(runs + 2)[:-1])).astype(np.int64) if len(split) else np.zeros(0, np.int64)
    laid = np.full(int((runs + 2).sum()) + 3, blank, dtype=np.int64)
    laid[np.arange(len(codes)) + np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) if len(codes) else np.zeros(0, np.int64)] = codes
    marks = np.array([_LANGUAGE_OF.get(w, 0) for w in distinct] + [0], dtype=np.int64)
    language = np.full(len(split), len(LANGUAGE_WORDS), dtype=np.int64)
    if len(split):
        bits = (marks[laid][:, None] >> np.arange(len(LANGUAGE_WORDS))) & 1
        votes = np.add.reduceat(bits, np.stack([starts, starts + runs], 1).ravel(), axis=0)[::2]
        language = np.where(votes.max(1) > 0, votes.argmax(1), len(LANGUAGE_WORDS))
    return Words(buckets, laid, starts, starts + runs, language)


class Net:
    """The convolutional net and its thresholds by language."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.embed = (rng.standard_normal((BUCKETS + 1, DIM)) * 0.02).astype(np.float32)
        self.embed[BUCKETS] = 0
        self.kernels = [(rng.standard_normal((w, DIM, FILTERS)) * 0.1).astype(np.float32) for w in WIDTHS]
        for k in self.kernels:
            k[:, 0, :] = np.abs(k[:, 0, :])
            k[:, 0, 0] = 1.0 / len(k)
        self.bias = np.zeros(len(WIDTHS) * FILTERS, dtype=np.float32)
        self.out = (rng.standard_normal(len(WIDTHS) * FILTERS) * 0.1).astype(np.float32)
        self.out[::FILTERS] = 0.5
        self.shift = 0.0
        self.thresholds = np.zeros(len(LANGUAGES))
        self.slope = 1.0

    def start_from(self, buckets: list[np.ndarray], y: np.ndarray) -> None:
        """The first coordinate: shrunk log odds of each bucket, by document counts."""
        seen = np.zeros((2, BUCKETS + 1))
        for b, label in zip(buckets, y):
            seen[int(label), np.unique(b)] += 1
        n0, n1 = max(int((y == 0).sum()), 1), max(int((y == 1).sum()), 1)
        odds = np.log((seen[1] + 0.5) / (n1 + 1)) - np.log((seen[0] + 0.5) / (n0 + 1))
        total = seen.sum(0)
        self.embed[:, 0] = odds * total / (total + 5) / 4
        self.embed[BUCKETS] = 0

    def answers(self, w: Words) -> np.ndarray:
        """The answer of every filter at every place, over distinct words first."""
        vectors = self.embed[w.buckets].sum(1)
        out = []
        for k in self.kernels:
            total = (vectors @ k[0])[w.codes]
            for j in range(1, len(k)):
                total[:-j] += (vectors @ k[j])[w.codes[j:]]
            out.append(total)
        return np.concatenate(out, axis=1)

    def logits(self, w: Words) -> np.ndarray:
        if not len(w.starts):
            return np.zeros(0)
        top = np.maximum.reduceat(self.answers(w), np.stack([w.starts, w.ends], 1).ravel(), axis=0)[::2]
        return np.tanh(top + self.bias) @ self.out.astype(np.float64) * 4 + self.shift

    def step(self, w: Words, y: np.ndarray, weight: np.ndarray, rate: float) -> float:
        """One step of gradient descent on a batch; the gradient runs through the largest answers only."""
        answers = self.answers(w)
        at = np.stack([answers[a:b].argmax(0) + a for a, b in zip(w.starts, w.ends)])
        top = np.take_along_axis(answers, at, axis=0)
        act = np.tanh(top + self.bias)
        z = act @ self.out * 4 + self.shift
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        d = ((p - y) * weight / len(y)).astype(np.float32)
        d_top = 4 * d[:, None] * self.out * (1 - act * act)
        d_out, d_bias = 4 * act.T @ d, d_top.sum(0)
        for g, k in enumerate(self.kernels):
            cols = slice(g * FILTERS, (g + 1) * FILTERS)
            d_kernel = np.zeros_like(k)
            for j in range(len(k)):
                places = w.buckets[w.codes[at[:, cols] + j]]  # text, filter, form
                vectors = self.embed[places].sum(2)
                d_kernel[j] = np.einsum("tf,tfd->df", d_top[:, cols], vectors)
                d_vec = d_top[:, cols][:, :, None] * k[j].T[None]
                for form in range(places.shape[2]):
                    np.add.at(self.embed, places[:, :, form].ravel(), -rate * d_vec.reshape(-1, DIM))
            k -= rate * d_kernel
        self.embed[BUCKETS] = 0
        self.out -= rate * d_out
        self.bias -= rate * d_bias
        self.shift -= rate * float(4 * d.sum())
        return float(-(np.log(np.where(y == 1, p, 1 - p) + 1e-9) * weight).mean())

    def scores(self, w: Words) -> np.ndarray:
        """0.5 at the threshold of the text's language."""
        z = self.slope * (self.logits(w) - self.thresholds[w.language])
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _threshold(z: np.ndarray, y: np.ndarray) -> float:
    """The middle of the gap that parts the classes best."""
    order = np.argsort(z, kind="stable")
    z, y = z[order], y[order]
    gain = np.concatenate(([0], np.cumsum(y == 0))) / max((y == 0).sum(), 1) - np.concatenate(([0], np.cumsum(y == 1))) / max((y == 1).sum(), 1)
    i = int(gain.argmax())
    low, high = (z[i - 1] if i else z[0] - 1), (z[i] if i < len(z) else z[-1] + 1)
    return float((low + high) / 2)


def fit(texts: list[str], labels: np.ndarray, *, seed: int = 3, epochs: int = 4, batch: int = 32, rate: float = 0.05) -> Net:
    """Trains on three quarters of the sample and calibrates on the rest.

    With one class only nothing is trained: every text scores on that class's side of 0.5
    (label 0 if there are no labels at all).
    """
    net = Net(seed)
    if not len(labels) or labels.min() == labels.max():
        net.out[:] = 0
        net.thresholds[:] = -2.0 if len(labels) and labels[0] == 1 else 2.0
        return net
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    cut = max(1, len(order) // 4)
    held, used = order[:cut], order[cut:]
    if len(set(labels[used].tolist())) < 2:
        held = used = order
    net.start_from([words_of([texts[i]]).buckets.ravel() for i in used], labels[used])
    share = labels[used].mean()
    for epoch in range(epochs):
        rng.shuffle(used)
        for begin in range(0, len(used), batch):
            part = used[begin : begin + batch]
            weight = np.where(labels[part] == 1, 0.5 / share, 0.5 / (1 - share))
            net.step(words_of([texts[i] for i in part]), labels[part], weight, rate / (1 + epoch))
    seen = [words_of([texts[i] for i in held[a : a + 200]]) for a in range(0, len(held), 200)]
    z, language, y = np.concatenate([net.logits(w) for w in seen]), np.concatenate([w.language for w in seen]), labels[held]
    if len(set(y.tolist())) < 2:
        return net
    net.thresholds[:] = everywhere = _threshold(z, y)
    for i in range(len(LANGUAGES)):
        mine = language == i
        n = min((y[mine] == 1).sum(), (y[mine] == 0).sum())
        if n:
            net.thresholds[i] = (n * _threshold(z[mine], y[mine]) + PRIOR_TEXTS * everywhere) / (n + PRIOR_TEXTS)
    return net


def train(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", per_class: int = MAX_PER_CLASS, seed: int = 3, max_chars: int = MAX_TRAIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> Net:
    """A net from at most ``per_class`` labelled, not held out documents of each class, of at most ``max_chars`` characters.

    Defined cases: null texts count as empty; labels without a document, other than 0 and 1
    or of a null id are left out, as is an id with both labels; a document id that repeats
    is used as often as it stands; without labels, or with one class only, see ``fit``;
    other columns are not read.
    """
    chosen = F.broadcast(training_rows(labels, label, per_class, seed))  # at most 2 * per_class rows
    text = F.coalesce(F.col(text_col), F.lit(""))
    sample = docs.select(F.col(id_col).alias("id"), text.alias("text")).where(F.char_length("text") <= max_chars)
    rows = sample.join(chosen, "id").select("id", "text", "label").toArrow()
    found = sorted(zip(rows.column("id").to_pylist(), rows.column("text").to_pylist(), rows.column("label").to_pylist()))
    return fit([r[1] for r in found], np.array([r[2] for r in found], dtype=np.int64), seed=seed)


def score(docs: DataFrame, net: Net, *, columns: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """``columns`` (None: all) of ``docs`` with ``score`` and ``predicted`` (score at least 0.5).

    Only the text is looked at, whole. Defined cases: a null text scores like an empty
    one; repeated rows each give a row; an empty table gives an empty table; input
    columns named ``score`` or ``predicted`` are replaced.
    """
    keep = [c for c in (columns if columns is not None else docs.columns) if c not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            begin = 0
            texts = batch.column(0).to_pylist()
            while begin < len(texts):
                end, size = begin, 0
                while end < len(texts) and end - begin < 200 and (size < 600_000 or end == begin):
                    size += len(texts[end] or "")
                    end += 1
                s = net.scores(words_of(texts[begin:end]))
                part = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(1, part.num_columns)] + [pa.array(s), pa.array(s >= 0.5).cast(pa.int32())], names=[*keep, "score", "predicted"])
                begin = end

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + ["score double", "predicted int"]
    return docs.select(docs[text_col].alias("kw_text"), *[docs[c] for c in keep]).mapInArrow(run, ", ".join(fields))


def classify(docs: DataFrame, labels: DataFrame, *, columns: list[str] | None = None, id_col: str = "doc_id", **fit_args) -> DataFrame:
    """Trains on ``labels`` and scores ``docs``, with ``held_out`` by id."""
    return score(docs, train(docs, labels, id_col=id_col, **fit_args), columns=columns).withColumn("held_out", held_out(F.col(id_col)))
