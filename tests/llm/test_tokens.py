"""BPE by prefixes, and counts that follow edits, against the tiktoken library."""
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pluvio.llm import byte_bpe as B
from pluvio.llm import queries, token_counts
from pluvio.llm.common import table

SF = "/root/testdata/sf0.001"
ALPHABET = list("  \n\t\r'stllrevdmax12é!.-_中🙂\x1c\x85\xa0 　²Ⅷ٣")


@pytest.fixture(scope="module")
def encoder():
    return B.encoder()


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.v.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60))
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    e = B.encoder()
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=e.v.ranks, special_tokens={})
    ids = e.encode(text).tolist()
    assert ids == lib.encode_ordinary(text) and e.decode(ids) == text.encode()


def test_white_space_and_contractions(encoder, library):
    rnd = random.Random(2)
    for _ in range(2000):
        text = "".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(30)))
        assert encoder.encode(text).tolist() == library.encode_ordinary(text), repr(text)


def test_another_vocabulary():
    ranks = B.read_ranks(B.vocabulary_path("byte_bpe_multi_50k.tiktoken"))
    e = B.Encoder(ranks, public_tokenizers.PATTERN, True)
    lib = tiktoken.Encoding("m", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("Größe und Straße", "l'été à Noël", "el niño comió", "the quick brown fox", "中文 текст"):
        assert e.encode(text).tolist() == lib.encode_ordinary(text)


@pytest.mark.parametrize("size", [300, 600, 2000])
def test_small_vocabulary_by_definition(encoder, size):
    """Against merging as defined; the first ranks are a vocabulary too."""
    rnd = random.Random(size)
    ranks = {b: i for b, i in encoder.v.ranks.items() if i < size}
    v = B.Vocabulary(ranks)
    for _ in range(1500):
        data = bytes(rnd.choice(b"  theinagordsal") for _ in range(rnd.randrange(1, 40)))
        assert B.Prefixes(v, data).tokens() == B.merge_encode(data, ranks)


def test_appends_and_edits(encoder, library):
    rnd = random.Random(5)
    alphabet = b"  aaabtheing\n\xc3\xa9\xe4xyz01"
    for _ in range(200):
        data = bytes(rnd.choice(alphabet) for _ in range(rnd.randrange(400)))
        cut = rnd.randrange(len(data) + 1)
        p = B.Prefixes(encoder.v, data[:cut])
        p.append(data[cut:])
        assert p.last == B.Prefixes(encoder.v, data).last
        i = rnd.randrange(len(data) + 1)
        j = min(len(data), i + rnd.randrange(9))
        new = bytes(rnd.choice(alphabet) for _ in range(rnd.randrange(6)))
        p.replace(i, j, new)
        q = B.Prefixes(encoder.v, data[:i] + new + data[j:])
        assert (p.data, p.last, p.states) == (q.data, q.last, q.states)
        assert not q.data or p.tokens() == library._encode_single_piece(q.data)


def test_an_edit_recomputes_its_neighbourhood_only(encoder):
    p = B.Prefixes(encoder.v, b"the thing in the inner ring and " * 2000)
    assert p.replace(30_000, 30_003, b"xyz") < 1000


def test_recent_keeps_what_is_asked_for():
    r = B.Recent(4)
    for i in range(50):
        r.keep(i, i)
        assert r.get("hot") or r.again("hot") or r.keep("hot", 1)
    assert len(r) + len(r.old) <= 5


def _digests(text):
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=B.read_ranks(B.vocabulary_path()))
    ids = lib.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_query_against_the_library(spark, odd, docs_of):
    docs = table(spark, SF, "documents")
    want = {r["doc_id"]: _digests(r["text"]) for r in docs.collect()}
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.op4_byte_level_bpe(spark, SF).collect()}
    assert got == want
    rows = sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.encoding_digests(odd).collect()), key=str)
    assert rows == sorted(((r["doc_id"], *_digests(r["text"])) for r in odd.collect()), key=str)
    assert queries.encoding_digests(docs_of([])).count() == 0


def test_tree_follows_edits(encoder):
    rnd = random.Random(6)
    for k in range(1500):
        text = "".join(rnd.choice(ALPHABET) for _ in range(rnd.choice([0, 300, 2500]) if k % 30 == 0 else rnd.randrange(60)))
        t = token_counts.TokenTree(text, encoder)
        for _ in range(3):
            i = rnd.randrange(len(t.text) + 1)
            j = min(len(t.text), i + rnd.randrange(5))
            new = "".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(4)))
            want = t.text[:i] + new + t.text[j:]
            t.replace(i, j, new)
            f = token_counts.TokenTree(want, encoder)
            assert (t.text, t.tokens, t.sums[1]) == (want, f.tokens, f.sums[1])
            assert [p for x in t.runs for p in x] == [p for x in f.runs for p in x]


def test_tree_edits_touch_few_pieces(encoder):
    t = token_counts.TokenTree("some words in a row, " * 5000, encoder)
    assert t.replace(50_000, 50_004, "other") < 10


def test_counts_query_against_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    n = lambda s: len(library.encode_ordinary(s))
    for r in queries.op7_token_counts(spark, SF).collect():
        t = texts[r["doc_id"]] or ""
        assert r["n_tokens"] == n(t)
        a = len(t) // 3
        u = t[:a] + " revised " + t[a + 7 :]
        b = int(len(t) / 3 * 2)
        u = u[:b] + "\n" + u[b:]
        u = u[1:]
        assert r["n_tokens_after"] == n(u) and r["n_chars_after"] == len(u) and r["n_edits"] == 3
        assert r["n_encoded_again"] <= 40


def test_counts_of_odd_rows(spark, odd, docs_of, library):
    rows = token_counts.count_tokens(odd).collect()
    assert sorted(r["n_tokens"] for r in rows) == sorted(len(library.encode_ordinary(r["text"] or "")) for r in odd.collect())
    kind = "doc_id long, edits array<struct<at:int,len:int,new:string>>"
    edits = spark.createDataFrame([(5, [(0, 1, "zz"), (999, 5, "!"), None, (None, 1, "q")]), (6, None)], kind)
    got = {r["doc_id"]: r for r in token_counts.count_tokens(docs_of([(5, "a b c"), (6, "x"), (7, None)]), edits).collect()}
    assert got[5]["n_tokens_after"] == len(library.encode_ordinary("zz b c!")) and got[5]["n_edits"] == 2
    assert got[6]["n_edits"] == 0 and got[7]["n_tokens"] == 0
    assert token_counts.count_tokens(docs_of([])).count() == 0
