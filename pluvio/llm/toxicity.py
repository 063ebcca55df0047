"""Toxicity by weak supervision.

Many voters look at a text: lexicons of insults, patterns, and word families
found in the labelled rows that may be learned from.  The mark of a labelled
row is one more voter, of a set accuracy, that is silent elsewhere.  A
generative label model estimates how often each voter fires on toxic and on
clean texts (expectation maximisation over all sampled rows, labelled or not)
and how strongly voters depend on one another within a class; dependent votes
count for less.  Its posterior labels train a linear classifier over words, word beginnings and
votes, and the classifier scores every text.

The sample, the number of voters and the number of features are bounded by
parameters, so what is fitted on the driver and broadcast has a fixed size.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import learning_row, ship
from pluvio.llm.language_id import sampled

SAMPLE_LABELLED = 16_000      # labelled rows that voters and features are found in (expected number)
SAMPLE_UNLABELLED = 8_000     # further rows that the label model reads (expected number)
MAX_FEATURES = 4_000
LEAST_GAIN = 11.0             # log likelihood ratio of a feature; chance seldom reaches it
MAX_FAMILIES = 64             # voters found in labelled rows
BEGINNINGS = (4, 5, 6)        # lengths of word beginnings
ROUNDS = 40                   # of expectation maximisation
STEPS = 500                   # of the classifier's descent
MARK_ACCURACY = 0.98          # of the mark of a labelled row, as a voter
CLEAN_SHARE = 0.007           # of the labelled clean rows that may lie above the cut
MARGIN = 1.0                  # log odds between a text that shows nothing and the cut, at least
REMEMBERED = 300_000          # words a worker remembers

#: Lexicon voters: words that insult, by kind and language.
LEXICONS = {
    "en stupidity": "idiot idiots stupid moron morons dumb dumbass fool fools imbecile retard retarded brainless",
    "en contempt": "pathetic worthless loser losers disgusting scum trash garbage clown vermin filth parasite",
    "en profanity": "fuck fucking fucker shit shitty bitch bastard asshole ass crap damn cunt dick whore slut",
    "en threat": "kill die hurt beat destroy shoot stab hang",
    "en hate": "hate hates hateful despise disgust loathe",
    "de": "idiot idioten dumm dummkopf trottel arschloch scheiße scheiss blöd blödmann hurensohn fotze wichser abschaum",
    "fr": "idiot idiote imbécile stupide connard connasse salope putain merde crétin abruti débile ordure",
    "es": "idiota estúpido estúpida imbécil tonto puta puto mierda cabrón basura asqueroso pendejo gilipollas",
}

_WORDS = re.compile(r"[^\W\d_]+").findall
#: Pattern voters.
PATTERNS = {
    "shouting at the end": re.compile(r"[^\W\d_]{3,}\s?!{2,}").search,
    "you are": re.compile(r"\b(?:you(?:'re| are)|du bist|tu es|eres)\b", re.I).search,
    "masked word": re.compile(r"\b[^\W\d_]+[*@#$]{2,}[^\W\d_]*\b").search,
    "stretched letters": re.compile(r"([^\W\d_])\1{3,}").search,
}
_LEXICON_SETS = [frozenset(v.split()) for v in LEXICONS.values()]


def features_of(word: str) -> list[str]:
    """The word itself, and its beginnings of a fixed length (marked by a star)."""
    return [word] + [word[:n] + "*" for n in BEGINNINGS if len(word) >= n]


def distinct_words(text: str | None) -> set[str]:
    return set(_WORDS(text.lower())) if text else set()


def shown_features(text: str | None) -> set[str]:
    """All features of a text: those of its words, and for each beginning that
    two or more of its different words share one marked by two stars (a word of
    a family may be chance, several are not)."""
    words = distinct_words(text)
    out = set(words)
    for n in BEGINNINGS:
        begins = [w[:n] for w in words if len(w) >= n]
        once = set(begins)
        out.update(b + "*" for b in once)
        if len(once) < len(begins):
            out.update(b + "**" for b, c in Counter(begins).items() if c > 1)
    return out


class Reader:
    """What a text shows: which voters fire, which chosen features it has."""

    def __init__(self, families: list[str], features: list[str]):
        self.families = {f: len(LEXICONS) + len(PATTERNS) + i for i, f in enumerate(families)}
        self.voters = len(LEXICONS) + len(PATTERNS) + len(families)
        self.features = {f: i for i, f in enumerate(features)}
        # beginnings that count from the second word on: (voter or -1, feature or -1)
        self.twice = {f[:-2]: (self.families.get(f, -1), self.features.get(f, -1)) for f in [*families, *features] if f.endswith("**")}
        self._seen: dict[str, tuple] = {}

    def _word(self, word: str) -> tuple:
        """(voters, features, beginnings that count from the second word on) of one word."""
        votes = [i for i, s in enumerate(_LEXICON_SETS) if word in s]
        shown = features_of(word)
        out = (tuple(votes + [self.families[f] for f in shown if f in self.families]),
               tuple(self.features[f] for f in shown if f in self.features),
               tuple(word[:n] for n in BEGINNINGS if len(word) >= n and word[:n] in self.twice))
        if len(self._seen) >= REMEMBERED:
            self._seen.clear()
        self._seen[word] = out
        return out

    def read(self, text: str | None) -> tuple[set[int], set[int]]:
        votes, found, begun = set(), set(), set()
        if text:
            seen, slow = self._seen, self._word
            for w in distinct_words(text):
                v, f, two = seen[w] if w in seen else slow(w)
                if v:
                    votes.update(v)
                if f:
                    found.update(f)
                for b in two:
                    if b in begun:
                        v, f = self.twice[b]
                        votes.update(() if v < 0 else (v,))
                        found.update(() if f < 0 else (f,))
                    begun.add(b)
            votes.update(len(LEXICONS) + i for i, p in enumerate(PATTERNS.values()) if p(text))
        return votes, found


def label_model(votes: np.ndarray, start: np.ndarray, marks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of the toxic class for each row of a 0/1 vote matrix, the
    firing rates (2, voters) for clean and toxic, and each voter's weight, less
    than one for dependent voters.  ``start`` are first guesses of the
    posterior; ``marks`` are 1 and 0 for labelled rows, -1 for others."""
    p = start.astype(float)
    marked = 0.0 if marks is None else np.where(marks < 0, 0.0, np.where(marks > 0, 1.0, -1.0) * np.log(MARK_ACCURACY / (1 - MARK_ACCURACY)))
    weight = np.ones(votes.shape[1])
    for turn in range(ROUNDS):
        prior = np.clip(p.mean(), 1e-3, 0.5)
        on = np.clip((p @ votes + 0.1) / (p.sum() + 1.0), 1e-5, 1 - 1e-5)
        off = np.clip(((1 - p) @ votes + 0.01) / ((1 - p).sum() + 1.0), 1e-5, 1 - 1e-5)
        if turn == ROUNDS // 2:
            # dependence within a class: correlation of what the class does not explain
            left = votes - (p[:, None] * on + (1 - p)[:, None] * off)
            cov = left.T @ left / len(votes)
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
            corr = np.abs(cov / sd[:, None] / sd[None, :])
            np.fill_diagonal(corr, 0.0)
            # k copies of a voter count as one; a slight dependence costs little
            weight = 1.0 / (1.0 + (corr ** 2).sum(axis=1))
        fired, silent = weight * np.log(on / off), weight * np.log((1 - on) / (1 - off))
        score = np.log(prior / (1 - prior)) + votes @ (fired - silent) + silent.sum() + marked
        p = 1.0 / (1.0 + np.exp(-np.clip(score, -30, 30)))
    return p, np.vstack([off, on]), weight


def train_linear(rows: np.ndarray, cols: np.ndarray, y: np.ndarray, n_cols: int, ridge: float = 3e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on 0/1 features given as (row, column) pairs with
    soft labels ``y``; full-batch descent with a step of its own for each weight."""
    w, b = np.zeros(n_cols), float(np.log(np.clip(y.mean(), 1e-3, 0.999) / (1 - np.clip(y.mean(), 1e-3, 0.999))))
    gw, gb, n = np.full(n_cols, 1e-8), 1e-8, max(1, len(y))
    for _ in range(STEPS):
        z = np.bincount(rows, weights=w[cols], minlength=len(y)) + b
        d = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - y
        g = np.bincount(cols, weights=d[rows], minlength=n_cols) / n + ridge * w
        gw += g * g
        w -= g / np.sqrt(gw)
        g0 = d.mean()
        gb += g0 * g0
        b -= 0.1 * g0 / np.sqrt(gb)
    return w, b


class Classifier:
    def __init__(self, reader: Reader, weights: np.ndarray, bias: float):
        self.reader, self.weights, self.bias = reader, weights, bias

    def score(self, text: str | None) -> float:
        votes, found = self.reader.read(text)
        z = self.bias + sum(self.weights[i] for i in votes) + sum(self.weights[self.reader.voters + i] for i in found)
        return float(1.0 / (1.0 + np.exp(-min(30.0, max(-30.0, z)))))


def _count_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for y, part in b.groupby("toxic"):
            c: dict[str, int] = {}
            for t in part["text"]:
                for f in shown_features(t):
                    c[f] = c.get(f, 0) + 1
            if c:
                yield pd.DataFrame({"feature": list(c), "pos": list(c.values()) if y else 0, "neg": 0 if y else list(c.values())})


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    """A classifier from the rows of ``docs`` that may be learned from.
    Without labelled toxic rows the voters are the fixed ones alone."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", "text").filter(learning_row(F.col("doc_id")) & F.col("text").isNotNull())
    marks = labels.select("doc_id", "toxic").filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = sampled(rows.join(marks, "doc_id"), SAMPLE_LABELLED, "toxic")
    known = known.groupBy("text").agg(F.max("toxic").alias("toxic")).persist()       # copies teach nothing more
    try:
        n = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
        pos, neg = n.get(1, 0), n.get(0, 0)
        counted = (known.select("text", "toxic").mapInPandas(_count_features, "feature string, pos long, neg long")
                   .groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).filter("pos + neg >= 3"))
        ratio = F.log(((F.col("pos") + 0.5) / (pos + 1)) / ((F.col("neg") + 0.5) / (neg + 1)))
        share = pos / max(1, pos + neg)
        part = lambda c, p: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / ((F.col("pos") + F.col("neg")) * max(p, 1e-9)))).otherwise(0.0)
        gain = 2.0 * (part("pos", share) + part("neg", 1.0 - share))
        top = (counted.withColumn("ratio", ratio).withColumn("gain", gain).filter(F.col("gain") >= LEAST_GAIN)
               .orderBy(F.desc("gain"), "feature").limit(MAX_FEATURES).collect())
        features = [r["feature"] for r in top]
        families: list[str] = []
        for r in sorted(top, key=lambda r: (-r["ratio"], len(r["feature"]), r["feature"])):
            stem = r["feature"].rstrip("*")
            if r["ratio"] < 3 or r["pos"] < 4 or len(families) >= MAX_FAMILIES:
                continue
            known_stem = any(stem.startswith(f.rstrip("*")) for f in families) or any(
                w.startswith(stem) if r["feature"].endswith("*") else w == stem for s in _LEXICON_SETS for w in s)
            if not known_stem:
                families.append(r["feature"])
        reader = Reader(families, features)
        shared = docs.sparkSession.sparkContext.broadcast(reader)

        def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                got = [shared.value.read(t) for t in b["text"]]
                yield pd.DataFrame({"toxic": b["toxic"], "votes": [sorted(v) for v, _ in got], "found": [sorted(f) for _, f in got]})

        other = sampled(rows.join(marks, "doc_id", "left_anti"), SAMPLE_UNLABELLED, "others").withColumn("toxic", F.lit(-1))
        seen = known.select("text", "toxic").unionByName(other.select("text", "toxic")).mapInPandas(read, "toxic int, votes array<int>, found array<int>").toPandas()
    finally:
        known.unpersist()
    if not len(seen):
        return Classifier(reader, np.zeros(reader.voters + len(features)), -3.0)
    votes = np.zeros((len(seen), reader.voters))
    for i, v in enumerate(seen["votes"]):
        votes[i, list(v)] = 1.0
    # first guess: labelled rows as marked, others by whether a lexicon voter fires
    label = seen["toxic"].to_numpy()
    start = np.where(label >= 0, label, votes[:, : len(LEXICONS)].max(axis=1)) * 0.9 + 0.05
    y, _, _ = label_model(votes, start, label)
    lists = [np.concatenate([np.asarray(v, np.int64), np.asarray(f, np.int64) + reader.voters]) for v, f in zip(seen["votes"], seen["found"])]
    at = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    columns = np.concatenate(lists)
    weights, bias = train_linear(at, columns, y, reader.voters + len(features))
    z = np.bincount(at, weights=weights[columns], minlength=len(lists)) + bias
    return Classifier(reader, weights, bias - cut(z, label, bias))


def cut(z: np.ndarray, label: np.ndarray, bias: float) -> float:
    """The log odds that become a score of 0.5: those which all but CLEAN_SHARE
    of the labelled clean rows stay under, but not less than MARGIN above a text
    that shows nothing, and 0 at most.  Soft labels of a rare class pull scores
    down; the order of the texts does not change."""
    clean = z[label == 0]
    return min(0.0, max(bias + MARGIN, float(np.quantile(clean, 1.0 - CLEAN_SHARE)))) if len(clean) else 0.0


def score_toxicity(docs: DataFrame, labels: DataFrame | None = None, model: Classifier | None = None) -> DataFrame:
    """``doc_id, score`` for every row of ``docs``: how likely label 1 is, 0 to 1.

    Null and empty texts get the score of a text that shows nothing.  Every
    row gives one row; an empty table gives none.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs, labels))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": [shared.value.score(t) for t in b["text"]]})

    return docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text").mapInPandas(run, "doc_id long, score double")
