"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

* **Voters.** Lexicon voters fire on words or word beginnings, pattern voters on the shape of
  a text. Their lexicons are a short general list and what a bounded sample of labelled
  documents shows: words, beginnings and recurring beginnings whose share of toxic documents
  is above the base rate beyond chance (a Chernoff bound over all candidates), dealt out over several voters.
  Near copies in the sample count once, else the words of one much-copied text would look
  telling.
* **Label model.** Votes have a hidden label. Expectation maximisation estimates how often
  each voter fires under either label; conditional mutual information between voters, given
  the label, then finds which of them repeat one another, and the strongest such pairs (a
  forest) get joint tables, so that two voters who say the same are not counted twice.
* **Classifier.** A logistic regression on hit counts of the voters learns the posterior
  labels; it scores every whole text.

Null and empty texts fire no voter and get the score of such texts. Without labels the
general lists vote alone.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subjectflow.llm.common import kept_by_worker, labelled_sample, small_join, stored, text_of, whole_texts
from subjectflow.llm.neardup import mixed, runs

#: Labelled documents used for fitting, about, at most; lexicon entries; the toxic share that the
#: documents of an entry must have; nats of evidence asked of an entry beyond the logarithm of the number of candidates (at 0, one entry by chance at most).
SAMPLE = 8_000
ENTRIES = 2_000
PRECISION = 0.9
EVIDENCE = 0.0
#: Candidates that a task counts before it hands them on.
COUNTED = 200_000
THRESHOLD = 0.5

# Insults that open the general lexicon, by language.
GENERAL = {
    "en": "idiot moron stupid loser scum trash clown pathetic worthless disgusting dumb ugly fool jerk bastard filthy",
    "de": "idiot dumm dummkopf trottel arschloch abschaum wertlos widerlich versager",
    "fr": "idiot stupide imbécile connard salaud ordure débile minable crétin",
    "es": "idiota estúpido imbécil cabrón basura asqueroso inútil payaso tonto",
}

_WORDS = re.compile(r"\w+")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
_PLAIN = str.maketrans("013457@$", "oieastas")
BEGINNINGS = (3, 4, 5, 6, 7, 8)
#: How often a beginning must occur in a text to count: rare ones tell at once, others when they recur.
TIMES = (1, 2, 3)
#: Voters that share the entries of each kind: whole words, beginnings by times.
WORD_VOTERS, BEGINNING_VOTERS = 4, 3


def candidates(text: str) -> set[str]:
    """Entries that a text holds: whole words (``=word``) and recurring beginnings (``2^begin``: at least twice)."""
    words = Counter(_WORDS.findall(text.lower()))
    out = {"=" + w for w in words if len(w) <= 30}
    for k in BEGINNINGS:
        begins: Counter = Counter()
        for w, n in words.items():
            if len(w) >= k:
                begins[w[:k]] += n
        for times in TIMES:
            out.update([f"{times}^{b}" for b, n in begins.items() if n >= times])
    return out


@lru_cache(maxsize=2)
def _searcher(lexicon: tuple[tuple[str, int], ...]):
    """An automaton over the strings of all entries; each finds the numbers of its entries."""
    strings: dict[str, list[int]] = {}
    for number, (entry, _) in enumerate(lexicon):
        strings.setdefault(entry[1:] if entry[0] == "=" else entry[2:], []).append(number)
    automaton = ahocorasick.Automaton()
    for string, numbers in strings.items():
        automaton.add_word(string, (len(string), tuple((n, lexicon[n][0][0] == "=") for n in numbers)))
    if strings:
        automaton.make_automaton()
    return automaton


def _hits(lexicon: tuple, text: str) -> Counter:
    """How often each entry (by number) occurs in a lower-case text, at the beginnings of words."""
    automaton, n, hits = _searcher(lexicon), len(text), Counter()
    if not len(automaton):
        return hits
    for end, (size, entries) in automaton.iter(text):
        begin = end - size + 1
        if begin and (text[begin - 1].isalnum() or text[begin - 1] == "_"):
            continue
        closed = end + 1 == n or not (text[end + 1].isalnum() or text[end + 1] == "_")
        for number, whole in entries:
            if closed or not whole:
                hits[number] += 1
    return hits


@dataclass
class Voters:
    """``lexicon``: (entry, voter) pairs; the pattern voters come after the lexicon voters."""

    lexicon: tuple[tuple[str, int], ...]
    lexicons: int

    def counts(self, text: str) -> list[float]:
        """Hits of each voter in one text."""
        counts = [0.0] * (self.lexicons + 4)
        low = text.lower()
        hits = _hits(self.lexicon, low)
        for number, n in hits.items():
            entry, voter = self.lexicon[number]
            if entry[0] == "=" or n >= int(entry[0]):
                counts[voter] += n
        plain = low.translate(_PLAIN)
        if plain != low:  # whole words that only the spelling with look-alikes hides
            for number, n in _hits(self.lexicon, plain).items():
                if self.lexicon[number][0][0] == "=":
                    counts[self.lexicons] += max(0, n - hits[number])
        n = max(1, len(text))
        counts[self.lexicons + 1] = float(text.count("!") / n > 0.01)
        counts[self.lexicons + 2] = float(sum(map(len, _UPPER.findall(text))) / n > 0.3)
        counts[self.lexicons + 3] = float("***" in text)
        return counts


def voters_of(entries: list[str]) -> Voters:
    """Deal entries, strongest first, out over the voters of their kind; the general list votes as well."""
    lexicon = [("=" + w, 0) for line in GENERAL.values() for w in line.split()]
    first = 1
    for kind in ("=", *map(str, TIMES)):
        own = [e for e in entries if e[0] == kind]
        groups = WORD_VOTERS if kind == "=" else BEGINNING_VOTERS
        lexicon += [(e, first + i % groups) for i, e in enumerate(own)]
        first += groups
    return Voters(tuple(sorted(set(lexicon))), first)


class LabelModel:
    """Hidden label of binary votes, with a forest of dependences between voters.

    What label 1 means is held by three things: its share is given, a voter fires seldom
    under label 0 unless the votes say otherwise, and the first guess comes from the lexicons.
    """

    def __init__(self, share: float, rounds: int = 40, dependence: float = 0.005):
        self.share, self.rounds, self.dependence = min(0.5, max(0.01, share)), rounds, dependence

    def fit(self, votes: np.ndarray, start: np.ndarray) -> LabelModel:
        """``votes``: rows by voters, 0/1. ``start``: first guess of each row's probability."""
        # by the first guess: once the tables fit voters that repeat one another, the label is what they say
        self.parent = self._forest(votes, start)
        self._maximise(votes, start)
        return self

    def _maximise(self, votes: np.ndarray, q: np.ndarray) -> np.ndarray:
        for _ in range(self.rounds):
            self._estimate(votes, q)
            q = self.posterior(votes)
        return q

    def _estimate(self, votes: np.ndarray, q: np.ndarray) -> None:
        """Tables: chance that a voter fires, by label and by its parent's vote (row 0 if it has none)."""
        m = votes.shape[1]
        self.fires = np.zeros((2, 2, m))
        above = np.where(self.parent >= 0, votes[:, self.parent], 0)
        for label, weight in ((0, 1 - q), (1, q)):
            for given in (0, 1):
                w = weight[:, None] * (above == given)
                self.fires[label, given] = ((w * votes).sum(axis=0) + (0.5 if label else 0.1)) / (w.sum(axis=0) + (1.0 if label else 10.0))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        above = np.where(self.parent >= 0, votes[:, self.parent], 0).astype(int)
        columns = np.arange(votes.shape[1])
        odds = np.full(len(votes), np.log(self.share / (1 - self.share)))
        for label, sign in ((1, 1), (0, -1)):
            p = self.fires[label][above, columns]
            odds += sign * np.log(np.where(votes > 0, p, 1 - p)).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))

    def _forest(self, votes: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Parents by the largest conditional mutual information above ``dependence`` (a spanning forest)."""
        m = votes.shape[1]
        info = np.zeros((m, m))
        for weight in (1 - q, q):
            total = weight.sum() + 1e-9
            share = total / len(votes)
            both = (votes * weight[:, None]).T @ votes / total
            one = np.diag(both)
            cells = ((both, one[:, None], one[None, :]), (one[:, None] - both, one[:, None], 1 - one[None, :]),
                     (one[None, :] - both, 1 - one[:, None], one[None, :]), (1 - one[:, None] - one[None, :] + both, 1 - one[:, None], 1 - one[None, :]))
            for joint, a, b in cells:
                joint = np.clip(joint, 1e-9, 1)
                info += share * joint * np.log(joint / np.clip(a * b, 1e-9, 1))
        parent, inside = np.full(m, -1), {0} if m else set()
        while len(inside) < m:
            rest = [j for j in range(m) if j not in inside]
            i, j = max(((i, j) for i in inside for j in rest), key=lambda x: info[x])
            parent[j] = i if info[i, j] > self.dependence else -1
            inside.add(j)
        return parent


@dataclass
class Classifier:
    """A logistic regression over the voters' hit counts."""

    voters: Voters
    weights: np.ndarray
    bias: float

    def score(self, texts: pd.Series) -> np.ndarray:
        """Probability that a text is toxic."""
        x = _features(np.array([self.voters.counts(t) for t in texts]).reshape(len(texts), -1))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -40, 40))) if len(texts) else np.zeros(0)


def _features(counts: np.ndarray) -> np.ndarray:
    """Did the voter fire, and how often (damped)."""
    return np.concatenate([counts > 0, np.log1p(counts)], axis=1).astype(float)


def regression(x: np.ndarray, q: np.ndarray, ridge: float = 0.05, steps: int = 30) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft labels, by Newton steps."""
    n, m = x.shape
    design = np.concatenate([x, np.ones((n, 1))], axis=1)
    w = np.zeros(m + 1)
    penalty = np.append(np.full(m, ridge), 1e-3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - q) + penalty * w
        hess = (design * (p * (1 - p))[:, None]).T @ design + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """``label``, ``text`` of the sampled labelled documents, near copies once (written to the shared folder).

    Two texts with the same smallest run of words, under either of two hash orders, count as
    copies; a pair at a similarity of 0.8 escapes both with a chance of 0.04.
    """
    sample = labelled_sample(docs.sparkSession, labels, label, bound)
    rows = small_join(whole_texts(docs, "doc_id", text_of().alias("text")), sample, ["doc_id"], 2 * bound).select("label", "text")

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [runs(t)[0] for t in batch["text"]]
            batch["a"] = [int(u.min() >> np.uint64(1)) if len(u) else 0 for u in found]
            batch["b"] = [int(mixed(u).min() >> np.uint64(1)) if len(u) else 0 for u in found]
            yield batch

    marked = rows.mapInPandas(keyed, "label int, text string, a long, b long")
    # of copies the smallest row, so that reruns agree
    once = marked.groupBy("a").agg(F.min(F.struct("b", "label", "text")).alias("r")).select("r.*")
    return stored(once.groupBy("b").agg(F.min(F.struct("label", "text")).alias("r")).select("r.*"), "toxicity-sample")


def _mined(sample: DataFrame) -> list[str]:
    """Entries whose toxic share is above the base rate beyond chance, strongest first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept_by_worker(("toxicity",))
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def counted() -> pd.DataFrame:
            keys = [*seen[0].keys() | seen[1].keys()]
            out = pd.DataFrame({"entry": keys, "pos": [seen[1][k] for k in keys], "neg": [seen[0][k] for k in keys]})
            seen[0].clear()
            seen[1].clear()
            return out

        for batch in batches:
            for label, text in zip(batch["label"], batch["text"], strict=True):
                seen[int(label > 0)].update(candidates(text))
                if len(seen[0]) + len(seen[1]) > COUNTED:
                    yield counted()
        yield counted()

    share = _share(sample)
    if not 0 < share < 1:
        return []
    n = F.col("pos") + F.col("neg")
    p = F.col("pos") / n
    info = F.col("pos") * F.log(p / share) + F.when(F.col("neg") > 0, F.col("neg") * F.log((1 - p) / (1 - share))).otherwise(0)
    counted = sample.mapInPandas(run, "entry string, pos long, neg long").groupBy("entry").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    counted = stored(counted.filter(n >= 3), "toxicity-entries")
    needed = EVIDENCE + float(np.log(max(1, counted.count())))
    rows = (
        counted.filter((F.col("pos") >= 3) & (p > F.greatest(F.lit(PRECISION), F.lit(1.5 * share)))).withColumn("info", info)
        .filter(F.col("info") > needed).orderBy(F.desc("info"), "entry").limit(ENTRIES).select("entry").collect()
    )
    return [r["entry"] for r in rows]


def _share(sample: DataFrame) -> float:
    """Share of label 1."""
    row = sample.agg(F.avg(F.when(F.col("label") > 0, 1.0).otherwise(0.0)).alias("share")).first()
    return float(row["share"] or 0.0)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = SAMPLE) -> Classifier:
    """Mine the lexicons, fit the label model on votes over the sample, and the classifier on its posteriors."""
    sample = _sample(docs, labels, label, bound)
    voters = voters_of(_mined(sample))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"x": [voters.counts(t) for t in batch["text"]]})

    rows = sample.select("text").mapInPandas(run, "x array<double>").toPandas()["x"].tolist()
    return fit(voters, np.array(sorted(map(list, rows)), dtype=float).reshape(-1, voters.lexicons + 4), _share(sample))


def fit(voters: Voters, counts: np.ndarray, share: float) -> Classifier:
    """Label model and classifier from hit counts. Four made-up rows, silent ones and one that the
    general lexicon marks, keep both defined where the sample is small or empty."""
    silent, marked = np.zeros((1, counts.shape[1])), np.zeros((1, counts.shape[1]))
    marked[0, 0] = 1
    counts = np.concatenate([counts, silent, silent, silent, marked])
    votes = (counts > 0).astype(float)
    lexical = votes[:, : voters.lexicons].sum(axis=1)
    start = np.where(lexical > 0, 0.9, 0.02)
    said = votes[:, votes.any(axis=0)]  # a voter that never fires tells nothing
    q = LabelModel(share or 0.1).fit(said, start).posterior(said)
    weights, bias = regression(_features(counts), q)
    return Classifier(voters, weights, bias)


def score_of(text: Column, model: Classifier) -> Column:
    """Score of a text column, batch by batch."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        kept_by_worker(("toxicity",))
        return pd.Series(model.score(texts))

    return score(text)


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not found toxic; their columns unchanged."""
    model = train(docs, labels)
    return docs.filter(score_of(text_of(), model) < THRESHOLD)
