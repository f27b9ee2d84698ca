"""Toxicity by weak supervision.

Voters look at a text's words: fixed lexicons of insults, density patterns, and
word and prefix patterns mined from labelled training rows.  A generative label
model holds, for each voter, how often it fires on toxic and on clean texts, and
the correlation of voters given the class; given labels enter it as one more,
imperfect voter.  Expectation-maximisation gives every training row a posterior
probability, with correlated voters sharing their weight, and a linear
classifier over the patterns is trained on these posteriors.  Scores come from
the classifier alone: from the text, never from labels, language, source or id.

Fitting uses at most about ``TRAIN_ROWS`` labelled rows (a hash sample of whole
texts); scoring reads every text whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, slices

TRAIN_ROWS = 20_000      # labelled rows that the models are fitted on, about
LEAST_TOXIC = 4          # toxic training rows a mined pattern must be in
PATTERNS = 800           # most mined patterns
VOTERS = 60              # mined patterns that also vote
PREFIXES = (3, 4, 5, 6, 7)
LABEL_ACCURACY = 0.97    # prior accuracy of a given label as a voter
REJECT = 0.7

# Lexicons that vote (general insults, by language)
LEXICONS = {
    "insult_en": "idiot moron stupid dumb loser scum trash clown pathetic worthless disgusting fool jerk imbecile".split(),
    "insult_de": "idiot dumm dummkopf arschloch abschaum versager trottel widerlich wertlos".split(),
    "insult_fr": "idiot stupide imbécile crétin ordure minable dégoûtant nul connard".split(),
    "insult_es": "idiota estúpido imbécil basura escoria patético asqueroso inútil payaso".split(),
    "hate_en": "hate kill die vermin filth subhuman".split(),
}
DENSITIES = (0.002, 0.01, 0.03)  # shares of a text's words that are hits: one pattern each

_WORDS = re.compile(r"\w+")


def word_counts(text: str) -> Counter:
    return Counter(_WORDS.findall(text.lower()))


def patterns_of(words: Counter) -> set[str]:
    """All candidate patterns of a text: its words, and prefixes (``abc*``) of longer words."""
    out = set(words)
    for w in words:
        for n in PREFIXES:
            if len(w) > n:
                out.add(w[:n] + "*")
    return out


class Patterns:
    """The mined patterns, and the features of a text: which are present, and how densely."""

    def __init__(self, mined: list[str]):
        self.mined = mined
        self._index = {p: i for i, p in enumerate(mined)}
        self._gates = {p.rstrip("*")[:PREFIXES[0]] for p in mined}
        self._lexicon = [frozenset(x) for x in LEXICONS.values()]
        self._lexicon_words = frozenset().union(*self._lexicon)
        self.width = len(mined) + len(self._lexicon) + 2 * len(DENSITIES)

    def features(self, text: str) -> list[int]:
        """Ascending numbers of the features that are on."""
        words = word_counts(text)
        total, hits, insults = max(sum(words.values()), 1), 0, 0
        on: set[int] = set()
        index, gates = self._index, self._gates
        for w, n in words.items():
            if w[:PREFIXES[0]] not in gates:
                continue
            found = False
            if (i := index.get(w)) is not None:
                on.add(i)
                found = True
            for size in PREFIXES:
                if len(w) > size and (i := index.get(w[:size] + "*")) is not None:
                    on.add(i)
                    found = True
            hits += n * found
        base = len(self.mined)
        if not self._lexicon_words.isdisjoint(words):
            for j, lexicon in enumerate(self._lexicon):
                if not lexicon.isdisjoint(words):
                    on.add(base + j)
            insults = sum(words[w] for w in self._lexicon_words if w in words)
        base += len(self._lexicon)
        for j, share in enumerate(DENSITIES):
            if hits >= share * total and hits:
                on.add(base + j)
            if insults >= share * total and insults:
                on.add(base + len(DENSITIES) + j)
        return sorted(on)


class LabelModel:
    """Generative model of binary votes given the class, with correlated voters.

    ``rate[c, j]``: chance that voter j fires on class c.  A voter's log odds
    are divided by one plus its positive correlations, given the class, with the
    other voters, so that voters that repeat each other count once together.
    """

    def __init__(self, voters: int):
        self.rate = np.full((2, voters), 0.5)
        self.share = np.ones(voters)
        self.prior = 0.5

    def posterior(self, votes: np.ndarray, given: np.ndarray) -> np.ndarray:
        """P(toxic) of each row; ``given``: its label as a voter."""
        on = np.log(self.rate[1] / self.rate[0]) / self.share
        off = np.log((1 - self.rate[1]) / (1 - self.rate[0])) / self.share
        odds = np.log(self.prior / (1 - self.prior)) + votes @ (on - off) + off.sum()
        odds += np.where(given == 1, 1, -1) * np.log(LABEL_ACCURACY / (1 - LABEL_ACCURACY))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    def fit(self, votes: np.ndarray, given: np.ndarray, rounds: int = 12) -> np.ndarray:
        p = np.where(given == 1, LABEL_ACCURACY, 1 - LABEL_ACCURACY).astype(float)
        for _ in range(rounds):
            for c, w in ((0, 1 - p), (1, p)):
                self.rate[c] = (w @ votes + 0.5) / (w.sum() + 1)
            self.rate = np.clip(self.rate, 1e-4, 1 - 1e-4)
            self.prior = float(np.clip(p.mean(), 1e-3, 1 - 1e-3))
            together = np.zeros((votes.shape[1],) * 2)
            for c, w in ((0, 1 - p), (1, p)):
                centred = votes - self.rate[c]
                cov = (centred * w[:, None]).T @ centred / max(w.sum(), 1e-9)
                sd = np.sqrt(np.clip(np.diag(cov), 1e-9, None))
                together += np.clip(cov / np.outer(sd, sd), 0, 1) * w.mean()
            np.fill_diagonal(together, 0)
            self.share = 1 + together.sum(0)
            new = self.posterior(votes, given)
            if np.abs(new - p).max() < 1e-4:
                break
            p = new
        return p


def fit_linear(x: np.ndarray, target: np.ndarray, penalty: float = 0.5, steps: int = 25) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets by Newton steps with a ridge penalty (none on the bias)."""
    n, d = x.shape
    full = np.concatenate((x, np.ones((n, 1), x.dtype)), 1)
    ridge = np.full(d + 1, penalty)
    ridge[-1] = 1e-6
    w = np.zeros(d + 1)
    w[-1] = np.log(np.clip(target.mean(), 1e-3, 0.999) / (1 - np.clip(target.mean(), 1e-3, 0.999)))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        curve = (p * (1 - p) + 1e-6).astype(x.dtype)
        gradient = full.T @ (p - target) + ridge * w
        step = np.linalg.solve((full * curve[:, None]).T @ full + np.diag(ridge), gradient)
        w -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-3:
            break
    return w[:-1], float(w[-1])


class Classifier:
    """Linear classifier over ``Patterns``."""

    def __init__(self, patterns: Patterns, weights: np.ndarray, bias: float):
        self.patterns, self.weights, self.bias = patterns, weights, bias

    def score(self, text: str | None) -> float:
        odds = self.bias + float(self.weights[self.patterns.features(text or "")].sum())
        return float(1 / (1 + np.exp(-np.clip(odds, -30, 30))))


def is_training(doc_id: Column) -> Column:
    """Rows whose labels may be learned from: crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 != 1


def training_texts(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic) of a hash sample of about ``rows`` labelled training texts, each text of an id once.

    The bound holds for texts: their number is counted before the sample is drawn, however
    often an id or a row is repeated.
    """
    usable = (labels.where(F.col("toxic").isNotNull() & is_training(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    usable = materialise(usable, "tox-labels")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("key"))
    count = texts.select("doc_id", "key").join(usable, "doc_id").groupBy("doc_id", "key").agg(F.count("*").alias("n")).count()
    share = min(1.0, rows / max(count, 1))
    chance = F.pmod(F.xxhash64("doc_id", "key", F.lit("train")), F.lit(1 << 30)) / float(1 << 30)
    picked = texts.where(chance < share).join(usable, "doc_id")
    # copies of a row are drawn alike; they are made one before they move
    return materialise(picked.groupBy("doc_id", "key").agg(F.first("text").alias("text"), F.first("toxic").alias("toxic"))
                       .select("text", "toxic"), "tox-train")


def _tally(batches: Iterator[pa.RecordBatch], only: Callable) -> Iterator[pa.RecordBatch]:
    """(pattern, n) over the rows of a task, flushed at a bounded size."""
    seen: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            seen.update(only(patterns_of(word_counts(text))))
            if len(seen) > 400_000:
                yield _tally_rows(seen)
                seen = Counter()
    if seen:
        yield _tally_rows(seen)


def _tally_rows(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                      names=["pattern", "n"])


def mine(train: DataFrame, n_toxic: int, n_clean: int) -> list[str]:
    """The patterns that set toxic training rows apart most, by the z score of their rates."""
    shape = "pattern string, n long"
    toxic = (train.where("toxic = 1").select("text").mapInArrow(lambda it: _tally(it, lambda p: p), shape)
             .groupBy("pattern").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TOXIC))
    # at most (training patterns / LEAST_TOXIC) rows: bounded by the sample
    in_toxic = {r["pattern"]: r["n"] for r in toxic.collect()}
    candidates = frozenset(in_toxic)
    clean = (train.where("toxic = 0").select("text").mapInArrow(lambda it: _tally(it, candidates.intersection), shape)
             .groupBy("pattern").agg(F.sum("n").alias("n")))
    in_clean = {r["pattern"]: r["n"] for r in clean.collect()}
    scored = []
    for p, a in in_toxic.items():
        c = in_clean.get(p, 0)
        pooled = (a + c) / (n_toxic + n_clean)
        z = (a / n_toxic - c / n_clean) / np.sqrt(pooled * (1 - pooled) * (1 / n_toxic + 1 / n_clean) + 1e-12)
        if z > 4 and a / n_toxic > 3 * c / n_clean:
            scored.append((-z, p))
    return [p for _, p in sorted(scored)[:PATTERNS]]


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Classifier:
    """Mine patterns, fit the label model and train the classifier on its posteriors.

    Without a toxic or a clean training row only the fixed lexicons vote, against
    a prior of one toxic text in a hundred.
    """
    train = training_texts(docs, labels, rows)
    counts = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = counts.get(1, 0), counts.get(0, 0)
    if not n_toxic or not n_clean:
        patterns = Patterns([])
        weights = np.zeros(patterns.width)
        weights[:len(LEXICONS)] = 6.0
        return Classifier(patterns, weights, float(np.log(0.01 / 0.99)))
    patterns = Patterns(mine(train, n_toxic, n_clean))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            on = [patterns.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(on, pa.list_(pa.int32())), batch.column(1)], names=["features", "toxic"])

    got = train.mapInArrow(run, "features array<int>, toxic int").collect()
    x = np.zeros((len(got), patterns.width), np.float32)
    for i, r in enumerate(got):
        x[i, r["features"]] = 1
    given = np.array([r["toxic"] for r in got])
    voters = np.r_[np.arange(min(VOTERS, len(patterns.mined))), np.arange(len(patterns.mined), patterns.width)]
    posterior = LabelModel(len(voters)).fit(x[:, voters].astype(np.float64), given)
    weights, bias = fit_linear(x, posterior)
    return Classifier(patterns, weights, bias)


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id and score (0 to 1) of every row; null texts are scored as empty ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([model.score(t) for t in part.column(1).to_pylist()], pa.float64())],
                    names=["doc_id", "score"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """Score every text: doc_id, held_out, score, predicted.

    ``held_out`` rows (crc32 of the id as text, modulo 3, is 1; false for null
    ids) are never learned from.  Empty and null texts get the score of a text
    without any pattern; repeated rows are scored alike; repeated labels of an id
    count once, toxic if any is; an empty table gives no rows; other columns play
    no part.
    """
    model = fit(docs, labels)
    held = F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 1, F.lit(False))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score",
                                     (F.col("score") >= reject).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """``docs`` without the rows that score ``reject`` or more; columns as they are."""
    model = fit(docs.select("doc_id", "text"), labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column(part.schema.get_field_index("text")).to_pylist()
                yield part.filter(pa.array([model.score(t) < reject for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
