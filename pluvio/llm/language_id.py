"""Language identification by words first, then shorter and shorter n-grams.

A known word adds its log frequency in each language.  A word the model does
not know is scored by its character n-grams of the greatest length of which
the model knows at least one, from four characters down to one; word borders
count as characters.  The language with the largest sum wins.

The model is fitted on a bounded sample of labelled rows: counts of words and
n-grams by language, of which the most frequent are kept.  The bounds are
parameters, so the model that is broadcast has a fixed size.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import learning_row, ship

SAMPLE_ROWS = 20_000          # labelled rows that the counts are taken from (expected number)
MAX_WORDS = 40_000
MAX_GRAMS = 40_000
LONGEST = 4
SMOOTH = 0.5
UNKNOWN = "und"
REMEMBERED = 200_000          # unseen words a worker remembers
SURE = 30                     # words whose evidence a score counts at most

#: Letters only: numerals such as a half, a superscript or a Roman numeral sign are none.
_WORDS = regex.compile(r"\p{L}+").findall


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word; from two characters up, its borders take part."""
    w = word if n == 1 else f"^{word}$"
    return [w[i : i + n] for i in range(len(w) - n + 1)]


def sampled(rows: DataFrame, expected: int, salt: str) -> DataFrame:
    """About ``expected`` rows, chosen by a hash of the id: the same ones in every run."""
    n = rows.count()
    if n <= expected:
        return rows
    return rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1_000_000)) < int(1_000_000 * expected / n))


class Model:
    """Log frequencies by language for words and n-grams."""

    def __init__(self, langs: list[str], words: list[tuple[str, list[int]]], grams_by_n: dict[int, list[tuple[str, list[int]]]]):
        self.langs = langs
        k = max(1, len(langs))

        def logs(rows):
            c = np.array([r[1] for r in rows], float).reshape(-1, k)
            return np.log((c + SMOOTH) / (c.sum(axis=0) + SMOOTH * (len(rows) + 1)))

        self.row = {w: i for i, (w, _) in enumerate(words)}
        self.known = len(words)
        self.table = logs(words)
        self.grams = {}
        for n, rows in grams_by_n.items():
            self.grams[n] = dict(zip([g for g, _ in rows], logs(rows)))
        self.new: dict[str, int] = {}

    def _room(self, n: int) -> None:
        """Rows for n remembered words, in this process: they are no part of the
        model that is sent."""
        need = self.known + n
        if len(self.table) < need:
            more = min(self.known + REMEMBERED, max(need, 2 * len(self.table)))
            self.table = np.vstack([self.table, np.zeros((more - len(self.table), self.table.shape[1]))])

    def backoff(self, word: str) -> np.ndarray:
        """Mean log frequency of the word's longest known n-grams."""
        for n in range(LONGEST, 0, -1):
            have = self.grams.get(n, {})
            got = [have[g] for g in grams(word, n) if g in have]
            if got:
                return np.mean(got, axis=0)
        return np.zeros(max(1, len(self.langs)))

    def _unseen(self, word: str) -> int:
        i = self.new.get(word)
        if i is None:
            if len(self.new) >= REMEMBERED:
                self.new.clear()
            i = self.new[word] = self.known + len(self.new)
            self._room(len(self.new))
            self.table[i] = self.backoff(word)
        return i

    def predict(self, text: str | None) -> tuple[str, float]:
        words = _WORDS(text.lower()) if text else []
        if not words or not self.langs:
            return UNKNOWN, 0.0
        total, row, unseen = np.zeros(len(self.langs)), self.row, self._unseen
        for at in range(0, len(words), 50_000):
            rows = [row[w] if w in row else unseen(w) for w in words[at : at + 50_000]]
            total += self.table[rows].sum(axis=0)
        z = total / len(words) * min(len(words), SURE)
        p = np.exp(z - z.max())
        i = int(p.argmax())
        return self.langs[i], float(p[i] / p.sum())


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for lang, part in b.groupby("lang"):
            c: Counter = Counter()
            for t in part["text"]:
                c.update(_WORDS(t.lower()))
            if c:
                yield pd.DataFrame({"lang": lang, "gram": list(c), "n": 0, "c": list(c.values())})


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for lang, part in b.groupby("lang"):
            c: Counter = Counter()
            for w, k in zip(part["gram"], part["c"]):
                for n in range(1, LONGEST + 1):
                    for g in grams(w, n):
                        c[n, g] += k
            yield pd.DataFrame({"lang": lang, "gram": [g for _, g in c], "n": [n for n, _ in c], "c": list(c.values())})


def fit(docs: DataFrame) -> Model:
    """A model from the rows of ``docs`` that may be learned from and have a
    language: every language of the sample is learned."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", "text", "lang").filter(learning_row(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = sampled(rows, SAMPLE_ROWS, "lang")
    schema = "lang string, gram string, n int, c long"
    words = rows.select("lang", "text").mapInPandas(_count_words, schema).groupBy("lang", "gram", "n").agg(F.sum("c").alias("c")).persist()
    try:
        langs = sorted(r["lang"] for r in words.select("lang").distinct().collect())

        def most(counts: DataFrame, limit: int) -> list[tuple[int, str, list[int]]]:
            by = F.map_from_entries(F.collect_list(F.struct("lang", "c")))
            top = (counts.groupBy("n", "gram").agg(F.sum("c").alias("all"), by.alias("by"))
                   .orderBy(F.desc("all"), "n", "gram").limit(limit).collect())
            return [(r["n"], r["gram"], [r["by"].get(x, 0) for x in langs]) for r in top]

        known = [(g, c) for _, g, c in most(words, MAX_WORDS)]
        counted = most(words.mapInPandas(_count_grams, schema).groupBy("lang", "gram", "n").agg(F.sum("c").alias("c")), MAX_GRAMS)
    finally:
        words.unpersist()
    by_n: dict[int, list] = {}
    for n, g, c in counted:
        by_n.setdefault(n, []).append((g, c))
    return Model(langs, known, by_n)


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs``.

    ``score`` is the probability of the predicted language among those learned
    (from at most SURE words of evidence).  Null texts, and texts without a
    letter, are 'und' with score 0; so is everything if no language was
    learned.  Ties go to the smaller language code.  Every row gives one row;
    an empty table gives none.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in batches:
            got = [m.predict(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "lang_pred": [x for x, _ in got], "score": [s for _, s in got]})

    return docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text").mapInPandas(
        run, "doc_id long, lang_pred string, score double")
