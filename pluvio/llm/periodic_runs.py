"""Periodic runs of words, found with a sparse table of diagonals.

Diagonal q of a text holds how many words up to the current one equal the word
q places before them.  From word to word, an earlier occurrence of the word
raises the length of its diagonal; a diagonal that the next word does not raise
has ended, and is a run if it was long enough.

The table is sparse.  A frequent word has a great many earlier occurrences, and
all but a few of them can be part of no run: a run of smallest period q spans
four periods or more, so its words also agree with those q before them in their
last ``2 ** j`` words of context, for the j with ``2 ** (j - 1) < q <= 2 ** j``;
and as the period is the smallest, no later occurrence of that context stands
between.  So a word looks back, for each j, to the latest earlier occurrence of
itself with ``2 ** j`` words of context, and raises that one diagonal if its lag
is in j's range.  A run of n words and period q raises its diagonal exactly
``n - q - 2 ** j + 1`` times on end, and no other stretch of raises is long
enough.  Time is n log n for any text, also one of a single word repeated.

Contexts are told apart by numbers, doubled from level to level (a context of
``2 ** (j + 1)`` words is two of ``2 ** j``), for all texts of a batch at once;
a context that occurs once in its text leaves, and with it all longer ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import pieces, ship

LEAST_WORDS = 6               # of a run
PERIODS = 4                   # that a run spans at least
WORDS_AT_ONCE = 400_000       # words of short texts that are numbered together


class Run(NamedTuple):
    start: int
    length: int
    period: int


def _numbered(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers from 0 that tell apart pairs of numbers (each from 0)."""
    return pd.factorize(a.astype(np.int64) * (int(b.max(initial=0)) + 1) + b)[0].astype(np.int64)


def raises(words: np.ndarray, text: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each level j: ``j``, the places where an earlier occurrence with the
    same 2 ** j words raises a diagonal of that level, and its lags.

    ``words``: numbers of the words of several texts on end; ``text``: the
    number of each word's text, ascending."""
    at = np.arange(len(words))                                  # the places that are still looked at
    context = _numbered(text, words)                            # of the words that end there, with their text
    j = 0
    while len(at):
        order = np.argsort(context, kind="stable")
        same = context[order][1:] == context[order][:-1]
        lag = at[order][1:] - at[order][:-1]
        hit = same & (lag <= 1 << j) & (lag > (1 << j) >> 1)
        where = at[order][1:][hit]
        turn = np.argsort(where, kind="stable")
        yield j, where[turn], lag[hit][turn]
        # a longer context can occur twice only where this one does, here and 2 ** j words before
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        at, context = at[twice], context[twice]
        before = np.searchsorted(at, at - (1 << j))
        found = before < len(at)
        found[found] = (at[before[found]] == (at - (1 << j))[found])
        before = before[found]
        found = np.flatnonzero(found)
        found, before = found[text[at[found]] == text[at[before]]], before[text[at[found]] == text[at[before]]]
        at, context = at[found], _numbered(context[before], context[found]) if len(found) else context[:0]
        j += 1


def runs_of_texts(words: np.ndarray, ends: np.ndarray) -> list[list[Run]]:
    """The runs of each text, by start, then period.  ``ends``: where each
    text's words end."""
    out: list[list[Run]] = [[] for _ in ends]
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    text = np.repeat(np.arange(len(ends)), ends - begins)
    for j, places, lags in raises(words, text):
        # a diagonal that is raised at places on end; it has ended where the next place does not raise it
        ended = np.flatnonzero((np.diff(places) != 1) | (np.diff(lags) != 0) | (np.diff(text[places]) != 0))
        first = places[np.concatenate([[0], ended + 1])] if len(places) else places
        last, lag = (x[np.concatenate([ended, [len(places) - 1]])] if len(places) else x for x in (places, lags))
        start = first - (1 << j) + 1 - lag
        length = last + 1 - start
        for i in np.flatnonzero(length >= np.maximum(LEAST_WORDS, PERIODS * lag)).tolist():
            t = int(text[last[i]])
            out[t].append(Run(int(start[i] - begins[t]), int(length[i]), int(lag[i])))
    for found in out:
        found.sort(key=lambda r: (r.start, r.period))
    return out


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which of n words stay: all but those that a run holds after its first period."""
    keep = np.ones(n, bool)
    for r in runs:
        keep[r.start + r.period : r.start + r.length] = False
    return keep


def split(text: str | None) -> list[bytes]:
    """Words of a text: what stands between ASCII white space."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _batches(texts: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    """(first, after the last) of texts that are numbered together."""
    begin = n = 0
    for i, words in enumerate(texts):
        if i > begin and n + len(words) > WORDS_AT_ONCE:
            yield begin, i
            begin, n = i, 0
        n += len(words)
    if begin < len(texts):
        yield begin, len(texts)


def runs_in(texts: list[list[bytes]]) -> Iterator[list[Run]]:
    """The runs of each list of words."""
    for a, z in _batches(texts):
        ends = np.cumsum([len(w) for w in texts[a:z]])
        flat = np.empty(int(ends[-1]), object)
        flat[:] = [w for words in texts[a:z] for w in words]
        yield from runs_of_texts(pd.factorize(flat)[0].astype(np.int64), ends)


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, runs, collapsed, n_words`` for every row of ``docs``: ``runs``
    an array of ``(start, length, period)`` by start, then period; ``collapsed``
    the words without the repeats, joined by one space.

    A run is a stretch of words of smallest period q, at least max(6, 4 q)
    long, that neither neighbour extends.  A word is dropped if a run holds it
    after that run's first q words.  Null, empty and blank texts have no words,
    no runs and an empty ``collapsed``.  Every row, repeated ones and rows
    without an id too, gives one row; an empty table gives none.  Texts are
    read whole; nothing is shuffled.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 1000, 4 << 20):
            texts = [split(t) for t in b.column("text").to_pylist()]
            found, collapsed = [], []
            for words, runs in zip(texts, runs_in(texts)):
                found.append([r._asdict() for r in runs])
                keep = kept_words(len(words), runs) if runs else repeat(True)
                collapsed.append(b" ".join([w for w, k in zip(words, keep) if k] if runs else words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(found, _RUNS), pa.array(collapsed, pa.string()), pa.array([len(w) for w in texts], pa.int64())],
                names=["doc_id", "runs", "collapsed", "n_words"])

    return docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text").mapInArrow(
        run, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string, n_words long")


def with_cycles(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` of ``docs`` where a tenth of the texts, told by the
    crc32 of the id's decimal text, repeat themselves: with h that crc32 and
    g = floor(h / 10), if h % 10 is 0, word i >= a becomes word a + (i - a) % p
    of the text, where a = g % n and p = 1 + floor((n - a) / (3 + g % 8)).  The
    words of such a text are joined by one space.  Rows without an id, and
    texts without words, stay as they are."""
    text = F.col("text").cast("string")
    word = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                         F.when(h % 10 == 0, F.floor(h / 10)).alias("g"), F.when(h % 10 == 0, word).alias("w"))
    n = F.size("w").cast("long")
    a = F.col("g") % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.col("g") % 8))
    at = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
    cycled = F.array_join(F.transform(at, lambda i: F.element_at("w", (i + 1).cast("int"))), " ")
    return chosen.select("doc_id", F.when(F.col("g").isNotNull() & (F.size("w") > 0), cycled).otherwise(F.col("text")).alias("text"))


def runs_digest(runs: list[Run]) -> str:
    """Lowercase hex of the sha256 of every run's ``start,length,period`` line."""
    return hashlib.sha256("".join(f"{r.start},{r.length},{r.period}\n" for r in runs).encode()).hexdigest()
