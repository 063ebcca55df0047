"""Near duplicates against all pairs; components; odd sketches."""
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.llm import near_dup as N
from pluvio.llm.common import table
from pluvio.llm.components import components

SF = "/root/testdata/sf0.001"


def _shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def _groups(edges, nodes):
    par = {x: x for x in nodes}

    def find(a):
        while par[a] != a:
            a = par[a]
        return a

    for a, b in edges:
        p, q = find(a), find(b)
        par[max(p, q)] = min(p, q)
    return {x: find(x) for x in nodes}


def _brute(rows):
    """rows: (doc_id, text) with ids; rows of one id are one document."""
    sets = defaultdict(list)
    for d, t in rows:
        sets[d].append(_shingles(t))
    ids = sorted(sets)
    links = []
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            for x in sets[a]:
                for y in sets[b]:
                    both = len(x & y)
                    if both and 100 * both >= 75 * (len(x) + len(y) - both):
                        links.append((a, b))
    return _groups(links, ids)


def _check(df, rows):
    want = _brute([r for r in rows if r[0] is not None])
    got = df.collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None:
            assert r["component_id"] == want[r["doc_id"]], r
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_components_on_the_small_table(spark):
    docs = table(spark, SF, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    out = N.near_duplicates(docs)
    _check(out, rows)
    n = {r["doc_id"]: r["n_shingles"] for r in out.collect()}
    assert all(n[d] == len(_shingles(t)) for d, t in rows)


def test_chains_and_groups_that_do_not_all_link(spark, docs_of):
    """A chain links neighbours only; a family around 0.7 links in parts; a
    group of copies is large; short texts are one shingle."""
    rnd = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = [(1000 + k, " ".join(base[4 * k : 4 * k + 60])) for k in range(15)]                    # a chain
    words = [f"v{i}" for i in range(150)]
    for k in range(150):                                                                       # a family
        w = list(words)
        for _ in range(rnd.choice([1, 2, 3, 4, 5])):
            w[rnd.randrange(150)] = f"x{rnd.randrange(10**6)}"
        rows.append((k, " ".join(w)))
    rows += [(3000 + k, "Copy of ONE text that is\tequal in lower case") for k in range(200)]
    rows += [(4000, "a b"), (4001, "A  b"), (4002, "a b c"), (4003, ""), (4004, None), (4005, "x"), (4006, "")]
    rnd.shuffle(rows)
    _check(N.near_duplicates(docs_of(rows)), rows)


def test_odd_rows(spark, odd, docs_of):
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in N.near_duplicates(odd).collect()), key=str)
    by = defaultdict(list)
    for g in got:
        by[g[0]].append(g)
    assert by[1] == [(1, 0, 1, True)] and by[2] == [(2, 0, 2, True)] and by[3] == [(3, 0, 3, True)]
    assert by[4] == [(4, 1, 4, True)] and len(by[5]) == 3 and {g[2] for g in by[5]} == {5}
    assert all(g[2] is None and g[3] for g in by[None]) and len(by[None]) == 2
    assert N.near_duplicates(docs_of([])).count() == 0
    out = N.one_of_each(odd)
    assert out.columns == odd.columns and out.filter("doc_id = 5").count() == 2


def test_rows_of_one_id_join_their_links(spark, docs_of):
    a = " ".join(f"a{i}" for i in range(40))
    b = " ".join(f"b{i}" for i in range(40))
    rows = [(1, a), (2, b), (9, a), (9, b)]
    _check(N.near_duplicates(docs_of(rows)), rows)


def test_one_document_of_each_group_stays(spark):
    docs = table(spark, SF, "documents")
    kept = {r["doc_id"] for r in N.one_of_each(docs).collect()}
    want = _brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert kept == {d for d, c in want.items() if d == c}


@pytest.mark.parametrize("n", [40, 400, 4000])
def test_odd_sketches_are_precise(n):
    """Pairs at the threshold pass, pairs well below are dropped."""
    rng = np.random.default_rng(n)
    for common, expect in ((0.75, True), (0.8, True), (0.5, False), (0.3, False)):
        i = int(round(2 * n * common / (1 + common)))
        passed = 0
        for _ in range(60):
            x = rng.integers(0, 1 << 63, size=2 * n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            a, b = np.sort(x[:n]), np.sort(np.concatenate([x[:i], x[n : 2 * n - i]]))
            one = lambda s: N.odd_sketch(s).view(np.uint64).reshape(1, -1)
            passed += bool(N.may_link(one(a), one(b), np.array([len(a)]), np.array([len(b)]))[0])
        assert passed == 60 if expect else passed <= (3 if n <= N.SAMPLE else 15), (n, common, passed)


def test_components_against_union_find(spark):
    rnd = random.Random(8)
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r["node"]: r["label"] for r in components(df).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == _groups([e for e in edges if e[0] != e[1]], nodes)
    assert components(df.filter("u < 0")).count() == 0
