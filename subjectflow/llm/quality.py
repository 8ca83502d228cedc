"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of a text are numbers that Spark tasks compute from whole texts. Trees are
fitted on a bounded sample of labelled documents (``SAMPLE``): values are replaced by
quantile bins, and each level of a tree takes one histogram of gradients over node, feature
and bin. A fitted ensemble is a few arrays (all trees complete, nodes in heap order), and a
batch of documents walks all trees at once by array indexing.

Null and empty texts have defined statistics (zeros) and so a score. Without any usable
label the score is 0.5; with labels of one kind only it is their smoothed share.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subjectflow.llm.common import kept_by_worker, labelled_sample, small_join, text_of, whole_texts

#: Labelled documents used for fitting, about, at most.
SAMPLE = 20_000
THRESHOLD = 0.3

NAMES = (
    "chars", "words", "word_len", "long_words", "upper", "digits", "blank", "lines_per_word", "other_ascii", "beyond_ascii",
    "comma_dot", "bang", "dollar", "percent", "amp", "star", "hash", "pipe", "at_slash", "distinct_words", "distinct_pairs",
    "distinct_lines", "short_lines", "top_word", "end_mark", "one_char_words",
)


def _bytes_in(*chars: str) -> np.ndarray:
    table = np.zeros(256)
    table[[ord(c) for text in chars for c in text]] = 1
    return table


_CLASSES = np.stack([
    _bytes_in("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _bytes_in("0123456789"), _bytes_in(" \t\n\r\x0b\x0c"), _bytes_in("^~`+=<>{}[]_;:\"'()?-"),
    np.repeat([0.0, 1.0], 128), _bytes_in(",."), _bytes_in("!"), _bytes_in("$"), _bytes_in("%"), _bytes_in("&"), _bytes_in("*"), _bytes_in("#"),
    _bytes_in("|"), _bytes_in("@/"),
], axis=1)


def statistics(text: str) -> list[float]:
    """The numbers named in ``NAMES`` for one text."""
    data = text.encode("utf-8", "replace")
    n = max(1, len(data))
    share = (np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256) @ _CLASSES / n).tolist()
    words = text.split()
    w = max(1, len(words))
    lengths = list(map(len, words))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    m = max(1, len(lines))
    common = max(counts.values(), default=0) / w
    upper, digits, blank, other, beyond, *marks = share
    return [
        np.log1p(len(text)), np.log1p(len(words)), sum(lengths) / w, sum([x > 18 for x in lengths]) / w, upper, digits, blank, len(lines) / w,
        other, beyond, *marks, len(counts) / w**0.8, len(set(zip(words, words[1:]))) / max(1, w - 1), len(set(lines)) / m,
        sum([len(x) < 30 for x in lines]) / m, common, float(data[-1:] in (b".", b"!", b"?")), lengths.count(1) / w,
    ]


@dataclass
class Trees:
    """An ensemble as arrays: ``feature`` and ``limit`` by tree and inner node, ``value`` by tree and leaf."""

    base: float
    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row: all trees of all rows descend one level at a time."""
        trees, inner = self.feature.shape
        if not trees:
            return np.full(len(x), self.base)
        rows, tree, at = np.arange(len(x))[:, None], np.arange(trees)[None, :], np.zeros((len(x), trees), dtype=np.int64)
        while at.size and at.flat[0] < inner:
            at = 2 * at + 1 + (x[rows, self.feature[tree, at]] > self.limit[tree, at])
        return self.base + self.value[tree, at - inner].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 2.0) -> Trees:
    """Boosted trees for a 0/1 label by logistic loss."""
    n, wide = x.shape if x.size else (0, len(NAMES))
    positive = int(y.sum())
    base = float(np.log((positive + 1) / (n - positive + 1)))
    if n == 0 or positive in (0, n):
        empty = np.zeros((0, 2**depth - 1))
        return Trees(base, empty.astype(int), empty, np.zeros((0, 2**depth)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(wide)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(wide)], axis=1)
    inner = 2**depth - 1
    feature, limit = np.zeros((trees, inner), dtype=np.int64), np.full((trees, inner), np.inf)
    value = np.zeros((trees, inner + 1))
    margin = np.full(n, base)
    columns = np.arange(wide)[None, :] * bins
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        at = np.zeros(n, dtype=np.int64)  # heap number of each row's node
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            slot = ((at - first)[:, None] * (wide * bins) + columns + binned).ravel()
            shape = (nodes, wide, bins)
            g = np.bincount(slot, np.repeat(grad, wide), nodes * wide * bins).reshape(shape).cumsum(axis=2)
            h = np.bincount(slot, np.repeat(hess, wide), nodes * wide * bins).reshape(shape).cumsum(axis=2)
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all**2 / (h_all + ridge)
            gain[(h < 1) | (h_all - h < 1)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for k in range(nodes):
                f, b = divmod(int(best[k]), bins)
                if gain[k, f, b] > 1e-6 and b < len(edges[f]):
                    feature[t, first + k], limit[t, first + k] = f, edges[f][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[t, at]] > limit[t, at])
        leaf = at - inner
        value[t] = -rate * np.bincount(leaf, grad, inner + 1) / (np.bincount(leaf, hess, inner + 1) + ridge)
        margin += value[t, leaf]
    return Trees(base, feature, limit, value)


def _matrix(texts: pd.Series) -> np.ndarray:
    return np.array([statistics(t) for t in texts], dtype=float).reshape(-1, len(NAMES))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = SAMPLE) -> Trees:
    """Fit on documents whose label may be learned; only statistics come to the driver, of about ``bound`` rows."""
    sample = labelled_sample(docs.sparkSession, labels, label, bound)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept_by_worker(("quality",))
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "x": list(_matrix(batch["_text"]))})

    rows = (
        small_join(whole_texts(docs, "doc_id", text_of().alias("_text")), sample, ["doc_id"], 2 * bound)
        .mapInPandas(run, "doc_id long, label int, x array<double>").toPandas()
    )
    rows = rows.iloc[sorted(range(len(rows)), key=lambda i: (rows["doc_id"][i], list(rows["x"][i])))]
    return fit(np.array(rows["x"].tolist(), dtype=float).reshape(-1, len(NAMES)), rows["label"].to_numpy(dtype=float))


def score_of(text: Column, model: Trees) -> Column:
    """Score of a text column, batch by batch."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        kept_by_worker(("quality",))
        return pd.Series(np.concatenate([model.score(_matrix(texts[i : i + 512])) for i in range(0, len(texts), 512)] or [np.zeros(0)]))

    return score(text)


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject; their columns unchanged."""
    model = train(docs, labels)
    return docs.filter(score_of(text_of(), model) >= THRESHOLD)
