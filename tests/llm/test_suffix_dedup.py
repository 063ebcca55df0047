"""Substring dedup against a dictionary of all 100-byte strings."""

import hashlib
import random

import numpy as np
import pytest

from pluvio.llm import queries, suffix_dedup as S
from pluvio.llm.common import table

SF = "/root/testdata/sf0.001"


def plain(texts):
    """For texts in their order, which bytes a string that also starts earlier covers."""
    seen, out = set(), []
    for t in texts:
        b = (t or "").encode("utf-8")
        cover = bytearray(len(b))
        for i in range(len(b) - 99):
            if b[i:i + 100] in seen:
                cover[i:i + 100] = b"\1" * 100
            seen.add(b[i:i + 100])
        out.append((b, cover))
    return out


def expected(rows):
    out = {}
    for (i, _), (b, cover) in zip(rows, plain([t for _, t in rows])):
        kept = bytes(x for x, gone in zip(b, cover) if not gone)
        spans = sum(gone and not before for before, gone in zip(b"\0" + cover, cover))
        out[i] = (len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest())
    return out


def found(df):
    out = {}
    for r in S.remove_repeats(df).collect():
        out[r["doc_id"]] = (r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]),
                            hashlib.sha256(bytes(r["kept"])).hexdigest())
    return out


@pytest.fixture(scope="module")
def mixed():
    """Texts that share passages, are copies, near copies or periodic."""
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdéfg") for _ in range(rnd.randint(1, 9))) for _ in range(400)]
    some = lambda a, z: " ".join(rnd.choice(words) for _ in range(rnd.randint(a, z)))
    passages = [some(10, 60) for _ in range(8)]
    rows = []
    for i in range(150):
        t = some(0, 80)
        for _ in range(rnd.randint(0, 3)):
            t += rnd.choice(passages)[rnd.randint(0, 20):] + some(0, 30)
        kind = rnd.random()
        if kind < 0.1 and rows:
            t = rnd.choice(rows)[1]
        elif kind < 0.2 and rows:
            t = "".join("#" if rnd.random() < 0.01 else c for c in rnd.choice(rows)[1])
        elif kind < 0.25:
            t = rnd.choice(["x", "ab", "abc "]) * rnd.randint(0, 400)
        rows.append((i, t))
    return rows + [(1000, "y" * 99), (1001, "y" * 100), (1002, "y" * 101), (1003, "y" * 250)]


def test_merge_gives_first_string():
    rng = np.random.default_rng(0)
    strings = [bytes(rng.integers(97, 99, int(rng.integers(100, 169))).astype(np.uint8)) for _ in range(60)]
    strings += [s[5:] + b"zzzzz" for s in strings] + [s[:120] for s in strings if len(s) > 130]
    whole, S.SHARD = S.SHARD, 2000                        # many shards
    try:
        first, ends = S.firsts(strings)
    finally:
        S.SHARD = whole
    begins = ends - np.diff(ends, prepend=0)
    for k, want in enumerate(S._by_bytes(strings)):
        assert first[begins[k]:begins[k] + len(want)].tolist() == want


def test_merge_orders_suffixes():
    """The interleave puts suffixes with equal first symbols side by side, and
    ``common`` is how many symbols neighbours share."""
    rng = np.random.default_rng(1)
    parts = [[bytes(rng.integers(97, 99, 140).astype(np.uint8)) for _ in range(9)] for _ in range(2)]
    parts[1] += parts[0][:4]
    shards = [S.Shard(np.frombuffer(b"".join(p), np.uint8), np.cumsum([len(x) for x in p])) for p in parts]
    interleave, common = S.merge(shards)

    def symbols(s, i):
        out = []
        for _ in range(S.STEPS):
            out.append(s[i:i + S.STEP] if i + S.STEP <= len(s) else b"")
            i = i + S.STEP if i + S.STEP < len(s) else i % S.STEP
        return tuple(out)

    at, rows = [0, 0], []
    for z in interleave.tolist():
        i = int(shards[z].order[at[z]])
        at[z] += 1
        rows.append(symbols(parts[z][i // 140], i % 140))
    assert at == [len(x.order) for x in shards]
    for a, b, c in zip(rows, rows[1:], common[1:].tolist()):
        assert c == next((k for k in range(S.STEPS) if a[k] != b[k]), S.STEPS)
    assert int((common < S.STEPS).sum()) == len(set(rows))


def test_anchor_depends_on_its_string_alone():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 100, 600).astype(np.uint8)
    h, place, lo, hi = S.anchors(data, np.array([600]))
    own = {}
    for k in range(len(h)):
        for s in range(lo[k], hi[k] + 1):
            own[s] = (int(h[k]), int(place[k]) - s)
    assert sorted(own) == list(range(501))
    for s in range(0, 501, 7):
        alone = S.anchors(data[s:s + 100].copy(), np.array([100]))
        assert (int(alone[0][0]), int(alone[1][0])) == own[s]


def test_mixed_texts(spark, mixed):
    df = spark.createDataFrame(mixed, "doc_id long, text string").repartition(4)
    assert found(df) == expected(mixed)


def test_crowded_anchors(spark, mixed, monkeypatch):
    monkeypatch.setattr(S, "LIMIT", 1)
    df = spark.createDataFrame(mixed, "doc_id long, text string").repartition(4)
    assert found(df) == expected(mixed)


def test_long_text_in_parts(spark, monkeypatch):
    rnd = random.Random(5)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(12_000))
    rows = [(1, long), (2, long[5000:7000]), (3, "new " + long[100:300] + " end"), (4, long)]
    monkeypatch.setattr(S, "CHUNK", 1000)
    out = []
    for raw in ([r[1].encode() for r in rows],):
        for parts in S._chunks(raw):
            out.extend((i, s) for i, a, z in parts for s in range(a, z - S.WINDOW + 1))
    assert len(out) == len(set(out)) == sum(len(r[1]) - 99 for r in rows)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows)


def test_query(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in table(spark, SF, "documents").select("doc_id", "text").collect())
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in queries.op11_suffix_array_dedup(spark, SF).collect()}
    assert got == expected(rows)


def test_odd_rows(spark, odd):
    out = S.remove_repeats(odd).collect()
    assert len(out) == odd.count()
    by_text = {}
    for r in out:
        by_text.setdefault((r["doc_id"], r["n_bytes"]), set()).add((tuple(tuple(s) for s in r["spans"]), bytes(r["kept"])))
    assert all(len(v) == 1 for v in by_text.values())                      # rows equal in id and text fare alike
    kept = {r["doc_id"]: bytes(r["kept"]) for r in out}
    assert kept[1] == kept[2] == b"" and kept[4] == b"word " and kept[6] == b"x"
    assert S.remove_repeats(odd.limit(0)).count() == 0


def test_texts_of_one_id(spark):
    a, b = "A" + "one passage of the two texts " * 5, "B" + "one passage of the two texts " * 5
    rows = [(1, a), (1, b), (1, a), (None, a), (None, "z" + b)]
    out = S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by_id = {}
    for r in out:
        by_id.setdefault(r["doc_id"], []).append((r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"])))
    assert len(out) == 5
    assert len(set(by_id[1])) == 2                                           # the two equal rows fare alike, the later text loses
    assert all(gone > 0 for _, gone in by_id[None])
