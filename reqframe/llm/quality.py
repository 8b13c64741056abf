"""Quality classifier: a generalised additive model with pairwise interactions.

Each text gives a row of plain measurements. Every feature is cut into quantile bins. Training goes
round the features again and again; each visit fits a shallow tree to the current log-loss gradient
over that feature's bins and adds a fraction of its leaf values to the feature's lookup table. Then
the pairs of features whose best four-cell cut explains most of what is left get two-dimensional
tables by the same cyclic boosting. A score is the sum of table entries, looked up for whole batches.
The model is fitted on at most ``SAMPLE`` labelled rows of each class; scoring reads every whole text.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqframe.llm.common import labelled_sample, share

SAMPLE = 4000  # labelled rows of each class used to fit
BINS = 32
COARSE = 8
ROUNDS = 120
PAIRS = 10
RATE = 0.15
THRESHOLD = 0.5

_LETTER = re.compile(r"[^\W\d_]")
_SYMBOL = re.compile(r"[^\w\s.,;:'\"!?()-]")
_UPPER = re.compile(r"[^\W\d_a-zß-öø-ÿ]")


def measure(text: str | None) -> list[float]:
    """The features of one text, fixed in number and order."""
    text = text or ""
    words, lines = text.split(), text.split("\n")
    n, w, k = max(len(text), 1), max(len(words), 1), max(len(lines), 1)
    counts = Counter(words)
    folded = Counter(zip(words, words[1:], strict=False))
    repeated = Counter(x for x in lines if x)
    letters = len(_LETTER.findall(text))
    ends = sum(text.count(c) for c in ".!?")
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        letters / n,
        len(_UPPER.findall(text)) / max(letters, 1),
        sum(c.isdigit() for c in text) / n if any(d in text for d in "0123456789") else 0.0,
        len(_SYMBOL.findall(text)) / n,
        text.count("!") / w,
        text.count("|") / w,
        ends / w,
        text.count(",") / w,
        (n - sum(map(len, words))) / n,
        sum(map(len, words)) / w,
        len(counts) / w,
        max(counts.values(), default=0) / w,
        max(folded.values(), default=0) / w,
        sum(c - 1 for c in folded.values()) / w,
        sum(c - 1 for c in repeated.values()) / k,
        max((c * len(x) for x, c in repeated.items() if c > 1), default=0) / n,
        sum(x.isupper() for x in words) / w,
        sum(x[:1].isupper() for x in words) / w,
        sum(len(x) <= 3 for x in words) / w,
        max(map(len, words), default=0),
        sum(not x[-1].isalnum() for x in words) / w,
        n / k,
        text.count("http") / w,
    ]


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Leaf values over ordered bins of the best few splits (Newton steps, one at a time)."""
    G, H = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    gain = lambda a, b: (G[b] - G[a]) ** 2 / (H[b] - H[a] + 1.0)
    cuts = [0, len(g)]
    for _ in range(leaves - 1):
        best = (1e-12, None)
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a > 1:
                c = np.arange(a + 1, b)
                more = gain(a, c) + gain(c, b) - gain(a, b)
                top = int(more.argmax())
                if more[top] > best[0]:
                    best = (more[top], int(c[top]))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.empty(len(g))
    for a, b in zip(cuts, cuts[1:], strict=False):
        out[a:b] = -(G[b] - G[a]) / (H[b] - H[a] + 1.0)
    return out


def _quarters(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a two-dimensional table into four cells: its gain and the cells' values."""
    G, H = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    r, c = G.shape[0] - 1, G.shape[1] - 1
    best, value = 0.0, np.zeros(g.shape)
    whole = G[r, c] ** 2 / (H[r, c] + 1.0)
    for i in range(1, r):
        for j in range(1, c):
            gains, cells = 0.0, []
            for a, b in ((0, i), (i, r)):
                for d, e in ((0, j), (j, c)):
                    x = G[b, e] - G[a, e] - G[b, d] + G[a, d]
                    y = H[b, e] - H[a, e] - H[b, d] + H[a, d] + 1.0
                    gains += x * x / y
                    cells.append((slice(a, b), slice(d, e), -x / y))
            if gains - whole > best:
                best = gains - whole
                value = np.zeros(g.shape)
                for s, t, v in cells:
                    value[s, t] = v
    return best, value


class Model:
    """Cut points, one table for each feature, and tables for pairs of features."""

    def __init__(self, cuts, base, tables, pairs, coarse):
        self.cuts, self.base, self.tables, self.pairs, self.coarse = cuts, base, tables, pairs, coarse

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(self.cuts)])

    def logit(self, x: np.ndarray) -> np.ndarray:
        at = self.bins(x)
        out = np.full(len(x), self.base)
        for f, t in enumerate(self.tables):
            out += t[at[:, f]]
        for (f, g), t in self.pairs.items():
            out += t[self.coarse[f][at[:, f]], self.coarse[g][at[:, g]]]
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        x = np.array([measure(t) for t in texts])
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -40, 40)))


def _coarser(rows: np.ndarray) -> np.ndarray:
    """The coarse bin of each bin: one for each bin that has rows if these are few, else shares of the rows."""
    used = rows > 0
    if used.sum() <= COARSE:
        return np.maximum(np.cumsum(used) - 1, 0)
    middle = np.cumsum(rows) - rows / 2
    return np.minimum((middle * COARSE / rows.sum()).astype(np.int64), COARSE - 1)


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Model:
    """Boost the single tables round by round, then those of the strongest pairs."""
    count = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.empty(0) for f in range(count)]
    model = Model(cuts, 0.0, [np.zeros(BINS) for _ in range(count)], {}, [np.zeros(BINS, np.int64) for _ in range(count)])
    if not len(x):
        return model
    weight = weight / weight.mean()
    mean = float(np.clip(np.average(y, weights=weight), 1e-4, 1 - 1e-4))
    model.base = float(np.log(mean / (1 - mean)))
    if y.min() == y.max():
        return model
    at = model.bins(x)
    logit = np.full(len(x), model.base)

    def slopes():
        p = 1 / (1 + np.exp(-logit))
        return weight * (p - y), weight * p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(count):
            g, h = slopes()
            step = RATE * _tree(np.bincount(at[:, f], g, BINS), np.bincount(at[:, f], h, BINS))
            model.tables[f] += step
            logit += step[at[:, f]]
    model.coarse = [_coarser(np.bincount(at[:, f], minlength=BINS)) for f in range(count)]
    coarse = np.column_stack([c[at[:, f]] for f, c in enumerate(model.coarse)])
    grid = lambda f, g, v: np.bincount(coarse[:, f] * COARSE + coarse[:, g], v, COARSE**2).reshape(COARSE, COARSE)
    g, h = slopes()
    gains = sorted(((-_quarters(grid(a, b, g), grid(a, b, h))[0], a, b) for a in range(count) for b in range(a)))
    chosen = [(a, b) for _, a, b in gains[:PAIRS]]
    model.pairs = {k: np.zeros((COARSE, COARSE)) for k in chosen}
    for _ in range(ROUNDS // 8):
        for a, b in chosen:
            g, h = slopes()
            step = RATE * _quarters(grid(a, b, g), grid(a, b, h))[1]
            model.pairs[a, b] += step
            logit += step[coarse[:, a], coarse[:, b]]
    return model


def _measured(batches):
    for batch in batches:
        x = [list(map(float, measure(t))) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column("label"), batch.column("weight")], names=["x", "label", "weight"])


def train(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Model:
    """A model fitted on labelled rows outside the held-out fold (``crc32(doc_id) mod 3 = 1``)."""
    chosen = labelled_sample(documents, labels, "quality", share("doc_id", 3) != 1, rows)
    # texts are measured where they are; the driver gets numbers alone
    got = chosen.mapInArrow(_measured, "x array<double>, label int, weight double").toArrow()
    x = np.array(got.column("x").to_pylist()) if got.num_rows else np.empty((0, len(measure(""))))
    return fit(x, got.column("label").to_numpy().astype(float), got.column("weight").to_numpy())


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``, a row per row of ``documents``.

    Null and empty texts are scored as a text of no words. A null doc_id is carried through with a
    null ``held_out``; repeated rows are scored each; other columns are ignored. Without usable labels
    of both classes every score is the share of ones (0.5 without labels). An empty table gives no rows.
    """
    model = train(documents, labels)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.score(batch.column("text").to_pylist()), pa.float64())],
                names=["doc_id", "score"],
            )

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = docs.mapInArrow(run, "doc_id long, score double")
    return out.select(
        "doc_id",
        (share("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
