"""Line dedup against a plain version of itself; the pipeline against brute force."""
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plain_lines import boundaries, dedup as _brute
from pluvio.llm import line_dedup as L
from pluvio.llm.common import table

SF = "/root/testdata/sf0.001"


def _got(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def _para(rnd, n):
    return " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))


def test_table_against_plain_version(spark):
    docs = table(spark, SF, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert _got(L.dedup_lines(docs)) == _brute(rows)


def test_chunks_cover_the_text_and_resist_shifts():
    rnd = random.Random(1)
    lines = [_para(rnd, rnd.randrange(0, 12)) for _ in range(300)]
    parts = L.chunks(lines)
    assert [a for a, _, _ in parts] == [0] + [z for _, z, _ in parts][:-1] and parts[-1][1] == 300
    assert [a for a, _, _ in parts] == boundaries(lines)[:-1]
    front = [_para(rnd, 5), _para(rnd, 7)]
    shifted = L.chunks([*front, *lines])
    assert {a - 2 for a, _, _ in shifted if a > 2} == {a for a, _, _ in parts if a > 0}    # not one boundary moves
    assert L.chunks([""]) == [(0, 1, False)]


def test_boundary_depends_on_its_own_lines():
    rnd = random.Random(4)
    inner = [_para(rnd, 8) for _ in range(6)]
    seen = set()
    for _ in range(30):
        front, back = ([_para(rnd, 6) for _ in range(rnd.randrange(1, 5))] for _ in range(2))
        n = len(front)
        seen.add(tuple(a - n for a, _, _ in L.chunks([*front, *inner, *back]) if n < a < n + len(inner)))
    assert len(seen) == 1


def test_passages_go_everywhere_but_once(spark, docs_of):
    rnd = random.Random(2)
    passage, block = _para(rnd, 70), "\n".join(_para(rnd, 9) for _ in range(30))
    own = {i: [_para(rnd, 60), _para(rnd, 20), _para(rnd, 80)] for i in range(40)}
    rows = [(i, "\n".join([*own[i][:2], passage, own[i][2], *([block] if i % 4 == 0 else [])])) for i in range(40)]
    rows += [(100 + i, "Only one short line in common\n" + _para(rnd, 55)) for i in range(10)]
    out = dict(_got(L.dedup_lines(docs_of(rows))))
    assert sum(passage in t for t in out.values()) == 1 and passage in out[0]
    assert all(x in out[i] for i in own for x in own[i])                    # what stands once stays
    assert all(out[100 + i] == rows[40 + i][1] for i in range(10))          # a short common line is no passage
    assert not any(set(out[i].split("\n")) & set(block.split("\n")) for i in range(4, 40, 4))
    assert _got(L.dedup_lines(docs_of(rows))) == _brute(rows)


def test_equal_hashes_are_not_enough(spark, docs_of, monkeypatch):
    """With one hash for all stretches nothing but true copies of the first one goes."""
    rnd = random.Random(3)
    a, b = _para(rnd, 60), _para(rnd, 60)
    import types

    import pyspark.cloudpickle as cp
    import xxhash
    fake = types.SimpleNamespace(xxh3_64_intdigest=lambda raw: 7 if len(raw) % 8 == 0 and len(raw) < 100 else xxhash.xxh3_64_intdigest(raw))
    monkeypatch.setattr(L, "xxhash", fake)
    cp.register_pickle_by_value(L)
    try:
        out = dict(_got(L.dedup_lines(docs_of([(1, a), (2, b), (3, a), (4, a + "\n" + b)]))))
    finally:
        cp.unregister_pickle_by_value(L)
    assert out[1] == a and out[2] == b and out[3] == "" and out[4] == b


def test_odd_rows(spark, odd, docs_of):
    out = L.dedup_lines(odd)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert _got(out) == _brute(rows)
    kept = L.deduped(odd)
    assert kept.columns == odd.columns and kept.count() == 12
    assert L.dedup_lines(docs_of([])).count() == 0
    para = _para(random.Random(5), 60)
    twice = docs_of([(1, para), (1, para), (2, para), (None, para)])
    assert _got(L.dedup_lines(twice)) == [(1, para), (1, para), (2, ""), (None, "")]
    assert L.deduped(twice).count() == 2
    longer = docs_of([(1, para), (2, para + "\nmore")])
    assert {(r["doc_id"], r["n_chars"]) for r in L.deduped(longer).collect()} == {(1, len(para)), (2, 4)}


def test_pipeline_against_brute_force(spark):
    """Every stage over what the one before it kept, checked by the brute-force versions."""
    from test_native import _brute_quality, _targets
    from test_near_dup import _brute as components
    from test_tokens import _digests

    from pluvio.llm import mixing, quality_rules
    from pluvio.llm.common import word_count
    docs = table(spark, SF, "documents")
    rows = {r["doc_id"]: r for r in docs.collect()}
    kept = {r["doc_id"] for r in quality_rules.judge(docs).filter("kept").select("r.doc_id").collect()}
    assert all(_brute_quality(rows[d]["text"])[0] >= 50 for d in kept)
    lines = {d: t for d, t in _brute([(d, rows[d]["text"]) for d in kept]) if t == rows[d]["text"] or t.strip(" \t\n\r\x0b\f")}
    groups = components(list(lines.items()))
    stay = {d: lines[d] for d, c in groups.items() if d == c}
    stage = docs
    for (name, f), want in zip(corpus_pipeline.STAGES[:3], (dict.fromkeys(kept), lines, stay)):
        stage = spark.createDataFrame(f(spark, stage, SF).collect(), docs.schema)
        assert stage.columns == docs.columns and {r["doc_id"] for r in stage.collect()} == set(want), name
    assert {r["doc_id"]: r["text"] for r in stage.collect()} == stay
    size = {}
    for r in stage.select("source", word_count(F.col("text")).alias("n")).collect():
        size[r["source"]] = size.get(r["source"], 0) + r["n"]
    want = _targets(size)
    mixed = mixing.mixed_documents(stage)
    longest = max(r["n"] for r in stage.select(word_count(F.col("text")).alias("n")).collect())
    for r in mixed.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("n")).collect():
        assert abs(r["n"] - want[r["source"]]) <= longest / 2 + 1
    times = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    final = corpus_pipeline.run(spark, SF).collect()
    expect = sorted((d, *_digests(stay[d])) for d, n in times.items() for _ in range(n))
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in final) == expect


@pytest.mark.parametrize("k", range(5))
def test_stages_survive_empty_and_odd_input(spark, odd, docs_of, k):
    f = corpus_pipeline.STAGES[k][1]
    for docs in (docs_of([]), odd):
        out = f(spark, docs, SF)
        assert out.count() >= 0
        if k < 4:
            assert out.columns == docs.columns
