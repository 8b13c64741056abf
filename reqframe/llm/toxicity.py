"""Toxicity by multiple-instance learning.

A document is a bag of sentences (cut at ``. ! ?`` and line ends). A sentence's logit is a bias plus
the sum of its distinct words' values, a word's value the sum of the weights of its features: the word and
its prefixes of 3 to 6 characters, hashed. The document's score is the noisy-or of its sentences,
``1 - prod(1 - p)``, and training descends the document labels' log loss through it, so that weights
land on the sentences that explain the label. The model is fitted on at most ``SAMPLE`` labelled rows
of each class; scoring reads every whole text.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqframe.llm.common import labelled_sample, share

SAMPLE = 3000  # labelled rows of each class used to fit
BITS = 18
EPOCHS = 120
L2 = 1e-4
THRESHOLD = 0.3

_TOKEN = re.compile(r"\w+|[.!?\n]")
_ENDS = frozenset(".!?\n")


def features(word: str) -> list[int]:
    """Hashed features of a lower-cased word."""
    parts = [f"={word}", *(word[:n] for n in range(3, min(6, len(word)) + 1))]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) >> (32 - BITS) for p in dict.fromkeys(parts)]


class Model:
    """``bias`` and feature ``weights``; word values are looked up through a bounded cache."""

    def __init__(self, bias: float, weights: np.ndarray):
        self.bias, self.weights, self.cache = bias, weights, {}

    def __getstate__(self):
        return {"bias": self.bias, "weights": self.weights, "cache": {}}

    def _value(self, word: str) -> float:
        if (got := self.cache.get(word)) is None:
            if len(self.cache) >= 300_000:
                self.cache.clear()
            got = np.nan if word in _ENDS else float(self.weights[features(word)].sum())
            self.cache[word] = got
        return got

    def sentences(self, text: str | None) -> np.ndarray:
        """Probability of each sentence, in order; one without words has none, the text's first excepted."""
        words = _TOKEN.findall(text.lower()) if text else []
        index: dict[str, int] = {}
        word = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
        value = np.fromiter(map(self._value, index), float, len(index))
        ends = np.isnan(value)[word]
        at, count = np.cumsum(ends), int(ends.sum()) + 1
        once = np.unique(at[~ends] * len(index) + word[~ends])  # a sentence counts each word once, as fit() does
        at, word = once // max(len(index), 1), once % max(len(index), 1)
        logit = np.bincount(at, value[word], count) + self.bias
        some = np.bincount(at, minlength=count) > 0
        some[0] |= not some.any()
        return np.where(some, 1 / (1 + np.exp(-np.clip(logit, -30, 30))), 0.0)

    def score(self, text: str | None) -> tuple[float, int, float]:
        """Noisy-or of the sentences, the number of the worst sentence and its probability."""
        p = self.sentences(text)
        worst = int(p.argmax())
        return float(-np.expm1(np.log1p(-p).sum())), worst, float(p[worst])


SLICE = 256  # texts numbered at a time while fitting
STRIDE = 1 << 17  # words summed at a time


def _add(total: np.ndarray, at: np.ndarray, values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Adds ``values[of]`` to ``total`` at ``at``, in order, without copies as long as the sample."""
    for k in range(0, len(at), STRIDE):
        np.add.at(total, at[k : k + STRIDE].astype(np.intp), values[of[k : k + STRIDE]])
    return total


def fit(texts: Iterable[str], labels: np.ndarray, weight: np.ndarray) -> Model:
    """Descend the noisy-or's log loss (Adam, full batches); features in under three texts are left out.

    ``texts`` are read once and not kept: what stays is eight bytes for each distinct word of a sentence.
    """
    index: dict[str, int] = {}
    word, sentence, document, in_documents = array("i"), array("i"), array("i"), array("i")
    texts, total, count = iter(texts), 0, 0
    while part := list(islice(texts, SLICE)):
        words, places, owners = array("q"), array("q"), array("q")
        for d, text in enumerate(part, total):
            fresh = True  # the next word begins a sentence
            for t in _TOKEN.findall(text.lower()):
                if t in _ENDS:
                    fresh = True
                    continue
                if fresh:
                    document.append(d)
                    count += 1
                    fresh = False
                words.append(index.setdefault(t, len(index)))
                places.append(count - 1)
                owners.append(d)
        total += len(part)
        # a sentence counts each word once, and so does a text
        w, s, d = (np.frombuffer(x, np.int64) for x in (words, places, owners))
        once = np.unique(s << 32 | w)
        sentence.frombytes((once >> 32).astype(np.int32).tobytes())
        word.frombytes((once & 0xFFFFFFFF).astype(np.int32).tobytes())
        once = np.unique(d << 32 | w) & 0xFFFFFFFF
        in_documents.extend([0] * (len(index) - len(in_documents)))
        held = np.frombuffer(in_documents, np.int32)
        held += np.bincount(once, minlength=len(held)).astype(np.int32)
        del held
    weights, bias = np.zeros(1 << BITS), -4.0
    if not total or not index or labels.min() == labels.max():
        rate = float(np.average(labels, weights=weight)) if len(labels) else 0.0
        return Model(float(np.log((rate + 1e-4) / (1 - rate + 1e-4))) - 4.0, weights)
    word, sentence, document = (np.frombuffer(x, np.int32) for x in (word, sentence, document))
    feature, sizes = array("i"), array("i")
    for w in index:
        feature.extend(got := features(w))
        sizes.append(len(got))
    kinds = len(index)
    del index
    owner, feature = np.repeat(np.arange(kinds, dtype=np.int32), np.frombuffer(sizes, np.int32)), np.frombuffer(feature, np.int32)
    # texts that hold each word, then each feature (an upper count: words of one feature add up)
    in_texts = _add(np.zeros(1 << BITS), feature, np.frombuffer(in_documents, np.int32), owner)
    known = in_texts[feature] >= 3
    owner, feature = owner[known], feature[known]
    sentences, y = len(document), labels.astype(float)
    scale = weight / weight.sum()
    m, v, mb, vb = np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0, 0.0
    for step in range(1, EPOCHS + 1):
        value = _add(np.zeros(kinds), owner, weights, feature)
        logit = bias + _add(np.zeros(sentences), sentence, value, word)
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        none = np.bincount(document, np.log1p(-np.minimum(p, 1 - 1e-12)), total)
        none = np.minimum(none, -1e-9)
        factor = scale * np.where(y == 1, np.exp(none) / np.expm1(none), 1.0)
        slope = factor[document] * p
        by_word = _add(np.zeros(kinds), word, slope, sentence)
        grad = _add(np.zeros(1 << BITS), feature, by_word, owner) + L2 * weights
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        rate = 0.15
        weights -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        g = slope.sum()
        mb, vb = 0.9 * mb + 0.1 * g, 0.99 * vb + 0.01 * g**2
        bias -= rate * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.99**step)) + 1e-6)
    return Model(float(bias), weights)


def train(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Model:
    """A model fitted on labelled rows outside the held-out fold (``crc32(doc_id) mod 4 = 2``)."""
    got = labelled_sample(documents, labels, "toxic", share("doc_id", 4) != 2, rows).toArrow()
    texts = (text for batch in got.to_batches(SLICE) for text in batch.column("text").to_pylist())
    return fit(texts, got.column("label").to_numpy(), got.column("weight").to_numpy())


OFFENDING = "array<struct<start:int,end:int,score:double>>"


def _scored(model: Model, field: pa.DataType):
    def run(batches):
        for batch in batches:
            score, found = [], []
            for text in batch.column("text").to_pylist():
                s, worst, _ = model.score(text)
                score.append(s)
                found.append(offending(model, text, worst) if s >= THRESHOLD else [])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64()), pa.array(found, field)], names=["doc_id", "score", "offending"])

    return run


def spans(text: str | None) -> list[tuple[int, int]]:
    """Code points of each sentence, end exclusive."""
    text, out, start = text or "", [], 0
    for end in re.finditer(r"[.!?\n]", text):
        out.append((start, end.start()))
        start = end.end()
    return [*out, (start, len(text))]


def offending(model: Model, text: str | None, worst: int) -> list[dict]:
    """The sentences that would be rejected on their own, and the likeliest one, in order."""
    p, places = model.sentences(text), spans(text)
    chosen = sorted({worst, *np.flatnonzero(p >= THRESHOLD).tolist()})
    return [{"start": places[k][0], "end": places[k][1], "score": float(p[k])} for k in chosen]


def toxic_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, offending``, a row per row.

    ``offending`` locates the sentences of a rejected text that would be rejected on their own, and its likeliest one. Null and empty texts are one empty
    sentence and get the score of the bias. A null doc_id is carried through with a null ``held_out``;
    repeated rows are scored each; other columns are ignored. Without usable labels of both classes
    the weights are zero. An empty table gives no rows.
    """
    model = train(documents, labels)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    item = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    out = docs.mapInArrow(_scored(model, item), f"doc_id long, score double, offending {OFFENDING}")
    return out.select(
        "doc_id",
        (share("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "offending",
    )


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` whose score is under the threshold, with the same columns."""
    model = train(documents, labels)

    @F.pandas_udf("boolean")
    def clean(texts):
        return texts.map(lambda x: model.score(x)[0] < THRESHOLD).astype(bool)

    return documents.where(clean(F.coalesce(F.col("text").cast("string"), F.lit(""))))
