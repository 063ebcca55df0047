"""Runs of words against a search of every lag."""

import hashlib
import random
import zlib

import numpy as np

from pluvio.llm import periodic_runs as P, queries
from pluvio.llm.common import table

SF = "/root/testdata/sf0.001"


def plain_runs(words):
    """Every stretch of matches of every lag that is long enough and has no smaller period."""
    number = {}
    w = np.array([number.setdefault(x, len(number)) for x in words], np.int64)
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[False], w[q:] == w[:-q], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        for a, z in zip(edge[::2].tolist(), edge[1::2].tolist()):
            length = z - a + q
            if length >= max(6, 4 * q) and not any((w[a + d:a + length] == w[a:a + length - d]).all() for d in range(1, q)):
                out.append((a, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    w = (text or "").encode().split()
    n = len(w)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    drop = set()
    for s, length, q in runs:
        drop.update(range(s + q, s + length))
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in drop)).hexdigest())


def test_random_words():
    rnd = random.Random(1)
    texts = []
    for _ in range(1500):
        k, n = rnd.choice([1, 2, 2, 3, 5]), rnd.randint(0, 60)
        w = [rnd.choice("abcde"[:k]) for _ in range(n)]
        if n and rnd.random() < 0.6:
            a, p = rnd.randrange(n), rnd.randint(1, 12)
            w = [w[i] if i < a else w[min(n - 1, a + (i - a) % p)] for i in range(n)]
        texts.append([x.encode() for x in w])
    for words, got in zip(texts, P.runs_in(texts)):
        assert [tuple(r) for r in got] == plain_runs(words)


def test_batches_do_not_mix(monkeypatch):
    monkeypatch.setattr(P, "WORDS_AT_ONCE", 10)
    texts = [[b"a"] * 5, [b"a"] * 5, [], [b"a"] * 30, [b"a", b"b"] * 4, []]
    assert [[tuple(r) for r in x] for x in P.runs_in(texts)] == [[], [], [], [(0, 30, 1)], [(0, 8, 2)], []]


def test_nested_and_touching_runs():
    w = [b"a"] * 6 + [b"b"]
    assert plain_runs(w * 4) == [tuple(r) for r in next(P.runs_in([w * 4]))]
    w = ([b"x", b"y"] * 4 + [b"z"] * 7) * 5 + [b"x", b"y", b"x"]
    assert plain_runs(w) == [tuple(r) for r in next(P.runs_in([w]))]


def test_frequent_word_in_a_long_text():
    rnd = random.Random(2)
    w = [b"x" if rnd.random() < 0.34 else str(rnd.randrange(500)).encode() for _ in range(4000)]
    w[1000:1900] = w[1000:1300] * 3 + []
    w[2000:3200] = w[2000:2300] * 4
    assert plain_runs(w) == [tuple(r) for r in next(P.runs_in([w]))]
    assert [tuple(r) for r in next(P.runs_in([[b"x"] * 300_000]))] == [(0, 300_000, 1)]


def test_query(spark):
    want = {r["doc_id"]: plain_row(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()}
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert got == want
    assert sum(r[0] > 0 for r in want.values()) > 10


def test_odd_rows(spark, odd):
    rows = P.find_runs(odd).collect()
    assert len(rows) == odd.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert [r["n_words"] for i in (1, 2, 3) for r in by_id[i]] == [0, 0, 0] and by_id[1][0]["runs"] == [] and by_id[3][0]["collapsed"] == ""
    assert [tuple(x) for x in by_id[4][0]["runs"]] == [(0, 40_000, 1)] and by_id[4][0]["collapsed"] == "word"
    assert by_id[8][0]["n_words"] == 5                                    # U+0085 is no ASCII white space
    assert len(by_id[None]) == 2 and P.find_runs(odd.limit(0)).count() == 0
    assert P.with_cycles(odd).count() == len(rows)
