"""Line dedup: repeated passages of 50 words or more go whole, whatever stands next to them."""
import random

import pytest

from plain_lines import dedup as _plain
from pluvio.llm import line_dedup as L
from pluvio.llm.common import table

SF = "/root/testdata/sf0.001"


def _line(rnd, n):
    return " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))


def _got(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def short_passages():
    """For each length 2 to 8 ten passages of lines under 50 words, over 50 in all, each in two
    documents between lines that stand nowhere else."""
    rnd = random.Random(11)
    rows, passages = [], {}
    for n in range(2, 9):
        for _ in range(10):
            lines = [_line(rnd, rnd.randrange(max(1, 52 // n + 1), 50)) for _ in range(n)]
            for _ in range(2):
                before, after = ([_line(rnd, rnd.randrange(1, 40)) for _ in range(rnd.randrange(1, 6))] for _ in range(2))
                passages[len(rows)] = (before, lines, after)
                rows.append((len(rows), "\n".join([*before, *lines, *after])))
    return rows, passages


def test_short_passages_between_unrelated_lines(spark, docs_of, short_passages):
    rows, passages = short_passages
    out = {r["doc_id"]: r for r in L.dedup_lines(docs_of(rows)).collect()}
    for d, (before, lines, after) in passages.items():
        assert out[d]["text"] == (rows[d][1] if d % 2 == 0 else "\n".join(before + after)), (d, len(lines))
        assert (out[d]["removed_lines"], out[d]["removed_chunks"]) == ((0, 0) if d % 2 == 0 else (len(lines), 1))


def test_short_passages_through_the_query_and_the_stage(spark, docs_of, short_passages, tmp_path):
    import corpus_pipeline
    from pluvio.llm.queries import QUERIES
    rows, passages = short_passages
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = sorted(((d, "\n".join([*b, *(p if d % 2 == 0 else []), *a])) for d, (b, p, a) in passages.items()), key=str)
    assert _got(QUERIES["op6_line_dedup"](spark, str(tmp_path))) == want
    assert _got(corpus_pipeline.lines(spark, docs_of(rows), str(tmp_path))) == want


def test_table_against_all_stretches(spark):
    docs = table(spark, SF, "documents")
    assert _got(L.dedup_lines(docs)) == _plain([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_shorter_passages_around_a_chunk(spark, docs_of):
    """Passages under 50 words: what lies around a chunk goes, and nothing else does."""
    rnd = random.Random(13)
    rows, inner = [], {}
    for k in range(60):
        lines = [_line(rnd, rnd.randrange(2, 6)) for _ in range(rnd.randrange(2, 9))]
        for _ in range(2):
            inner[len(rows)] = lines
            rows.append((len(rows), "\n".join([_line(rnd, 20), *lines, _line(rnd, 20)])))
    out = dict(_got(L.dedup_lines(docs_of(rows))))
    assert sorted(out.items(), key=str) == _plain(rows)
    gone = 0
    for d, lines in inner.items():
        whole, left = rows[d][1].split("\n"), out[d].split("\n")
        assert left == whole if d % 2 == 0 else (left[0], left[-1]) == (whole[0], whole[-1])
        gone += len(whole) - len(left) == len(lines)
    assert gone > 15


def test_repeats_inside_a_text(spark, docs_of):
    """Of lines that repeat within a text as many stay as the first place of the passage has."""
    rnd = random.Random(12)
    one, three, own = _line(rnd, 9), [_line(rnd, 12) for _ in range(3)], _line(rnd, 30)
    rows = [(1, "\n".join([one] * 40)), (2, "\n".join(three * 10)), (3, "\n".join([own, *three * 3])), (None, "\n".join([own] + [one] * 6)),
            (4, "\n".join([_line(rnd, 60), "", *three * 2, "", _line(rnd, 60)])), (4, "\n".join(three * 10))]
    out = _got(L.dedup_lines(docs_of(rows)))
    assert out == _plain(rows)
    texts = [t for d, t in out if d == 1]
    assert len(texts[0].split("\n")) == 6 and texts[0].split("\n")[0] == one
