"""Language id, toxicity, nearest neighbours: held-out accuracy and brute force."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.llm import ann, language_id, queries, toxicity
from pluvio.llm.common import held_out, table

SF = "/root/testdata/sf0.01"


def test_languages_held_out(spark):
    docs = table(spark, SF, "documents").select("doc_id", "lang")
    rows = queries.op8_language_id(spark, SF).join(docs, "doc_id").collect()
    test = [r for r in rows if r["held_out"]]
    assert len(rows) == 1000 and 100 < len(test) < 300
    assert sum(r["lang"] == r["lang_pred"] for r in test) >= 0.98 * len(test)
    assert all(0.0 <= r["score"] <= 1.0 for r in rows)


def test_words_first_then_shorter_grams():
    counts = {"known": [8, 0], "other": [0, 8]}
    grams = {4: [("^abc", [9, 0])], 3: [("xyz", [0, 9])], 2: [("qu", [9, 0])], 1: [("é", [0, 9])]}
    m = language_id.Model(["aa", "bb"], list(counts.items()), grams)
    assert m.predict("known")[0] == "aa" and m.predict("other")[0] == "bb"
    assert m.predict("abcd")[0] == "aa"            # a four-character gram
    assert m.predict("wxyzw")[0] == "bb"           # none of four, one of three
    assert m.predict("zquz")[0] == "aa"            # one of two
    assert m.predict("zéz")[0] == "bb"             # a single character
    for text in (None, "", "12 34 !?", "_ 5", "½ ²", "²", "Ⅷ ⅔", "€ ° ©", "\u0301", "٣ 四".replace("四", "")):
        assert m.predict(text) == ("und", 0.0), text
    assert m.predict("² known ½")[0] == "aa" and m.predict("四")[0] != "und"
    assert language_id.Model([], [], {}).predict("word") == ("und", 0.0)


def test_predictions_against_a_plain_scorer(spark):
    """Word by word: log frequencies of known words, else of the longest known n-grams."""
    import math

    import regex
    docs = table(spark, SF, "documents")
    m = language_id.fit(docs)
    assert len(m.table) == m.known                                 # nothing but the model is sent
    known = {w: m.table[i].tolist() for w, i in m.row.items()}
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(docs, m).collect()}
    for r in docs.filter("doc_id < 150").collect():
        total, n = [0.0] * len(m.langs), 0
        for w in regex.findall(r"\p{L}+", (r["text"] or "").lower()):
            n += 1
            logs = known.get(w)
            if logs is None:
                for size in (4, 3, 2, 1):
                    s = w if size == 1 else f"^{w}$"
                    hits = [m.grams[size][s[i:i + size]] for i in range(len(s) - size + 1) if s[i:i + size] in m.grams.get(size, {})]
                    if hits:
                        logs = [sum(h[k] for h in hits) / len(hits) for k in range(len(m.langs))]
                        break
            total = [a + b for a, b in zip(total, logs or [0.0] * len(m.langs))]
        if not n:
            assert got[r["doc_id"]] == ("und", 0.0)
            continue
        z = [t / n * min(n, 30) for t in total]
        p = [math.exp(x - max(z)) for x in z]
        best = max(range(len(p)), key=lambda k: p[k])
        assert got[r["doc_id"]][0] == m.langs[best] and abs(got[r["doc_id"]][1] - p[best] / sum(p)) < 1e-6


def test_every_language_of_the_sample_can_be_predicted(spark, docs_of):
    word = lambda k: "".join(chr(97 + int(d)) for d in f"{k:03d}") + "wort"
    rows = [(i, f"{word(i % 250)} {word(i % 250)}", "s", f"l{i % 250:03d}") for i in range(1500)]
    docs = docs_of(rows)
    m = language_id.fit(docs)
    assert len(m.langs) == 250
    assert all(m.predict(word(k))[0] == f"l{k:03d}" for k in (0, 7, 249))


def test_languages_of_odd_rows(spark, odd, docs_of):
    rows = language_id.identify(odd).collect()
    assert len(rows) == 12 and {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3)} == {"und"}
    assert language_id.identify(docs_of([])).count() == 0
    nothing = language_id.identify(docs_of([(1, "some words")]).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert [(r["lang_pred"], r["score"]) for r in nothing] == [("und", 0.0)]


def test_prediction_does_not_see_the_labels(spark):
    """Changing lang, source and ids of held-out rows changes no prediction of theirs."""
    docs = table(spark, SF, "documents")
    model = language_id.fit(docs)
    changed = language_id.fit(docs.withColumn("lang", F.when(held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang"))))
    assert model.langs == changed.langs and (model.table[: model.known] == changed.table[: changed.known]).all()


def test_toxicity_held_out(spark):
    labels = table(spark, SF, "labels")
    rows = queries.op5_toxicity(spark, SF).join(labels, "doc_id").collect()
    test = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["toxic"] for r in test) >= 0.93 * len(test)
    assert sum(r["predicted"] for r in test if not r["toxic"]) <= 0.02 * len(test)
    toxic, clean = [r["score"] for r in test if r["toxic"]], [r["score"] for r in test if not r["toxic"]]
    assert np.mean([t > c for t in toxic for c in clean]) >= 0.8
    assert all(0.0 <= r["score"] <= 1.0 for r in rows)


def test_label_model_finds_good_and_dependent_voters():
    rng = np.random.default_rng(1)
    y = rng.random(6000) < 0.15
    good = [(y & (rng.random(6000) < 0.7)) | (rng.random(6000) < 0.01) for _ in range(4)]
    noise = rng.random(6000) < 0.3
    votes = np.column_stack([*good, noise, noise, noise]).astype(float)      # three copies of one useless voter
    start = 0.05 + 0.9 * votes[:, :4].max(axis=1)
    p, rates, weight = toxicity.label_model(votes, start)
    assert ((p > 0.5) == y).mean() > 0.97
    assert (rates[1, :4] > 0.5).all() and (rates[0, :4] < 0.05).all() and abs(rates[1, 4] - rates[0, 4]) < 0.1
    assert (weight[4:] < 0.5).all() and (weight[:4] > 0.8).all()


def test_toxicity_of_odd_rows(spark, odd, docs_of):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 9)] + [(5, None), (None, 1)], "doc_id long, toxic int")
    rows = toxicity.score_toxicity(odd, labels).collect()
    assert len(rows) == 12 and all(0.0 <= r["score"] <= 1.0 for r in rows)
    assert toxicity.score_toxicity(docs_of([]), labels).count() == 0
    none = toxicity.score_toxicity(docs_of([(1, "you idiot"), (2, "fine")]), labels.filter("doc_id > 100")).collect()
    assert len(none) == 2


def _brute(rows, n=20, every=20):
    """rows: (vec_id, vector); dict of query -> ids in order."""
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v
          and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    ids = np.array([i for i, _ in ok])
    x = np.array([v for _, v in ok])
    out = {}
    for i, v in ok:
        if i % every == 0:
            s = (x * v).sum(axis=1)
            order = [k for k in np.lexsort((ids, -s)) if ids[k] != i]
            out[i] = [(int(ids[k]), float(s[k])) for k in order[:n]]
    return out


def _check_exact(got, rows, least):
    want = _brute(rows)
    hit = total = 0
    score = {(q, i): s for q, w in _brute(rows, n=10**9).items() for i, s in w}
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    assert set(by) <= set(want)
    for q, w in want.items():
        g = by.get(q, [])
        assert [x[2] for x in g] == list(range(1, len(g) + 1)) and len(g) == len(w)
        assert all(s == score[q, i] for i, s, _ in g)
        assert [(-s, i) for i, s, _ in g] == sorted((-s, i) for i, s, _ in g)
        hit += len({i for i, _ in w} & {i for i, _, _ in g})
        total += len(w)
    assert total == 0 or hit >= least * total


def test_neighbours_on_the_table(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in table(spark, SF, "embeddings").collect()]
    _check_exact(queries.op10_approximate_nearest_neighbours(spark, SF).collect(), rows, 1.0)


def test_recall_without_exhaustive_search(spark, monkeypatch):
    """Random vectors of different lengths, hot copies; cells larger than a block."""
    monkeypatch.setattr(ann, "LEAST", 10)
    monkeypatch.setattr(ann, "BLOCK", 64)
    monkeypatch.setattr(ann, "PORTION", 8)
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1500, 24)) * rng.uniform(0.5, 2.0, (1500, 1))
    x[200:500] = x[200]
    rows = [(int(i) * 4, [float(f) for f in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    _check_exact(ann.nearest(df).collect(), rows, 0.9)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (60, [1.0, None]), (80, [nan, 1.0]), (100, [inf, 1.0]), (None, [1.0, 1.0]),
            (120, [1.0, 2.0, 3.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (140, [2.0, 1.0]), (3, [-1.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("x", F.lit(1)).withColumn("cells", F.lit(2))
    got = {}
    for r in sorted(ann.nearest(df).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == {0: [(140, 2.0), (1, 1.0), (2, 1.0), (3, -1.0)], 140: [(1, 3.0), (2, 3.0), (0, 2.0), (3, -1.5)]}
    assert ann.nearest(df.filter("vec_id = 20")).count() == 0
    assert ann.nearest(df.limit(0)).count() == 0
    assert ann.nearest(df.filter("vec_id = 0")).count() == 0


@pytest.mark.parametrize("table_no", [0, 5])
def test_probes_come_in_order_of_success(table_no):
    """Neighbours fall into the first probed cells more often than into later ones."""
    rng = np.random.default_rng(9)
    x = rng.standard_normal((400, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x + 0.2 * rng.standard_normal(x.shape)
    near /= np.linalg.norm(near, axis=1, keepdims=True)
    cells = ann.cells_of(near, 1.0)[:, table_no]
    score = list(ann.success_order(x))[table_no]
    place = (score > np.take_along_axis(score, cells[:, None], 1)).sum(axis=1)
    assert np.median(place) < 100 and (place < 10).mean() > (place >= 200).mean()
