"""Hard negatives from cover trees over norm-augmented vectors.

Every candidate vector gets one more component that makes all lengths equal to
the longest one (an anchor gets a zero there), so inner products with an anchor
q stay what they are and, for any centre c and row x within distance r of it,
``<q, x>`` lies in ``<q, c> -+ |q| r``.  A cover tree holds a block of
candidates: a node covers its rows within a radius that shrinks by BASE from
level to level, and the centres of its children lie further apart than the
children's radius.  A search goes down from the node with the best bound, skips
nodes whose interval no window of the anchor meets, and scores the rows of the
leaves it reaches exactly, in integers.

Blocks are dealt by the nearest of at most CELLS centres, chosen by farthest
first from a sample of SAMPLE rows: the trees' common top level.  Every row is
in a block, whatever the sample was.  The centres and radii (a fixed number)
are broadcast, and an anchor is sent to the blocks that its bounds allow.  A
large cell is several blocks, so a vector that a third of all rows repeat fills
no task; anchors come to a block in portions.

Two passes: the positives of an anchor (its first rows of the same label), then
its negatives within the windows that the positives' scores open.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pluvio.llm.common import materialise, ship

CELLS = 64                    # centres of the common top level
SAMPLE = 2048                 # rows that they are chosen from
BLOCK = 8192                  # rows in a block
PORTION = 8192                # anchors for a block at once
BASE = 1.15                   # by which the radius shrinks from level to level
LEAF = 64                     # rows that need no further node
CROWDED = 8                   # a node whose children would hold fewer rows each is a leaf
EXACT = 2.0 ** 52             # products of lengths up to here are exact in doubles

POINT = "vec_id long, label long, x array<long>"


def quantised(vectors: DataFrame, scale: float = 256.0, vec_id: str = "vec_id", embedding: str = "embedding",
              label: Column | str = "label") -> DataFrame:
    """``vec_id, label, x`` of the rows that take part: ``x`` holds
    ``floor(scale * component)`` as long.

    Rows without an id, a label or a vector, with a null or non-finite
    component, or of another length than most, take no part.  An id that is
    repeated counts once, with its smallest label and vector.
    """
    x = F.col(f"`{embedding}`").cast("array<double>")
    v = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
                       (F.col(f"`{label}`") if isinstance(label, str) else label).cast("long").alias("label"), x.alias("x"))
    bad = F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    v = v.filter("vec_id is not null and label is not null and x is not null").filter(~bad)
    top = v.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    v = v.filter(F.size("x") == (top["d"] if top else 0))
    v = v.withColumn("x", F.transform("x", lambda e: F.floor(F.lit(scale) * e).cast("long")))
    one = v.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("p"))
    return one.select("vec_id", "p.label", "p.x")


def augmented(x: np.ndarray, longest: float) -> np.ndarray:
    """Candidates with the component that makes every length ``longest``."""
    rest = np.sqrt(np.maximum(0.0, longest * longest - np.einsum("ij,ij->i", x, x)))
    return np.hstack([x, rest[:, None]])


def farthest_first(y: np.ndarray, n: int) -> np.ndarray:
    """At most n rows of y, each the farthest from those before it."""
    out = [0]
    near = np.linalg.norm(y - y[0], axis=1)
    while len(out) < n and near.max() > 0:
        out.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(y - y[out[-1]], axis=1))
    return y[out]


class CoverTree:
    """A cover tree over integer vectors ``x`` (rows).  ``order`` lists rows so
    that every node's rows lie together; node k has centre ``centre[k]``,
    covering radius ``radius[k]``, rows ``order[first[k]:last[k]]`` and
    children ``child[k]`` (a range of nodes; empty for a leaf)."""

    def __init__(self, x: np.ndarray, longest: float):
        y = augmented(x.astype(np.float64), longest)
        self.longest = longest
        n = len(y)
        self.order = np.arange(n)
        centre, radius, first, last, child = [0], [0.0], [0], [n], [(0, 0)]
        if n:
            radius[0] = float(np.linalg.norm(y - y[0], axis=1).max())
        todo = [(0, radius[0])]
        while todo:
            k, level = todo.pop()
            rows = self.order[first[k]:last[k]]
            if len(rows) <= LEAF or radius[k] <= 0:
                continue
            level = min(level, radius[k]) / BASE
            parts, left = [], rows
            while len(left) and len(parts) * CROWDED <= len(rows):
                at = centre[k] if not parts else int(left[0])     # a node's centre is one of its children's
                far = np.linalg.norm(y[left] - y[at], axis=1)
                covered = far <= level
                parts.append((at, left[covered], float(far[covered].max(initial=0.0))))
                left = left[~covered]
            if len(left):
                continue                                           # crowded: the rows lie too far apart to be told by balls
            begin = first[k]
            child[k] = (len(centre), len(centre) + len(parts))
            for at, mine, r in parts:
                self.order[begin:begin + len(mine)] = mine
                centre.append(at)
                radius.append(r)
                first.append(begin)
                last.append(begin + len(mine))
                child.append((0, 0))
                todo.append((len(centre) - 1, level))
                begin += len(mine)
        self.centres = x[centre].astype(np.float64) if n else np.empty((1, x.shape[1]))
        self.radius, self.first, self.last, self.child = np.array(radius), first, last, child

    def descend(self, q: np.ndarray, wanted, visit) -> None:
        """Visit leaves, the highest bound first.  ``wanted(low, high)`` tells
        whether scores between them are looked for; ``visit(rows)`` scores."""
        if not len(self.order):
            return
        length = float(np.linalg.norm(q))
        slack = 1e-9 * length * self.longest + 1e-9                 # more than the bounds can be off by rounding
        middle = self.centres[:1] @ q
        heap = [(-float(middle[0] + length * self.radius[0]), 0, float(middle[0] - length * self.radius[0]))]
        while heap:
            high, k, low = heapq.heappop(heap)
            if not wanted(low - slack, -high + slack):
                continue
            a, z = self.child[k]
            if a == z:
                visit(self.order[self.first[k]:self.last[k]])
                continue
            middle = self.centres[a:z] @ q
            reach = length * self.radius[a:z]
            for i, (m, r) in enumerate(zip(middle.tolist(), reach.tolist())):
                heapq.heappush(heap, (-(m + r), a + i, m - r))


class Best:
    """The first n of (score, id), highest score first, ties to the smaller id,
    among scores from ``low`` to ``high`` (integers, or None for no end)."""

    def __init__(self, n: int, low: int | None = None, high: int | None = None):
        self.n, self.low, self.high = n, low, high
        self.ids, self.scores = np.empty(0, np.int64), np.empty(0, object)

    def least(self):
        """The score from which on a row can still come in."""
        if len(self.ids) == self.n:
            return self.scores[-1]
        return self.low

    def wanted(self, low: float, high: float) -> bool:
        least = self.least()
        return (least is None or high >= least) and (self.high is None or low <= self.high)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        least = self.least()
        if self.high is not None:
            ok = scores <= self.high
            ids, scores = ids[ok], scores[ok]
        if least is not None:
            ok = scores >= least
            ids, scores = ids[ok], scores[ok]
        if not len(ids):
            return
        if len(ids) > 4 * self.n and scores.dtype != object:
            ok = scores >= np.partition(scores, len(scores) - self.n)[len(scores) - self.n]
            ids, scores = ids[ok], scores[ok]
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores.astype(scores.dtype), scores])
        order = np.lexsort((ids, -scores))[: self.n] if scores.dtype != object else np.array(
            sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[: self.n])
        self.ids, self.scores = ids[order], scores[order]


def exact_scores(x: np.ndarray, xf: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products of the rows of x (``xf``: as doubles) with q."""
    if exact:                                                      # every partial sum is a whole number below 2 ** 53
        return np.rint(xf @ q.astype(np.float64)).astype(np.int64)
    return np.array([sum(a * b for a, b in zip(row, q.tolist())) for row in x.tolist()], object)


def _long(score) -> int:
    """A score as long; beyond its range the nearest one."""
    return max(-(1 << 63), min((1 << 63) - 1, int(score)))


def _deal(cells: pd.DataFrame) -> list[tuple[int, int]]:
    """(first block, blocks) for each cell; small cells share a block."""
    out: list[tuple[int, int]] = []
    block = filled = 0
    for c in cells["c"].tolist():
        if filled and filled + c > BLOCK:
            block, filled = block + 1, 0
        n = max(1, -(-c // BLOCK))
        out.append((block, n))
        block, filled = (block + n, 0) if n > 1 else (block, filled + c)
    return out


class Index:
    """Points dealt into blocks, and what a sender must know of them."""

    def __init__(self, points: DataFrame, anchors: Column):
        spark = points.sparkSession
        self.spark = spark
        points = materialise(points, "negatives-points")
        square = F.aggregate("x", F.lit(0.0), lambda s, e: s + e.cast("double") * e.cast("double"))
        whole = points.agg(F.max(square).alias("m"), F.count(F.lit(1)).alias("n"), F.sum(anchors.cast("long")).alias("a")).first()
        self.rows, self.n_anchors = whole["n"], whole["a"] or 0
        if not self.rows or not self.n_anchors:
            self.rows = 0
            return
        longest = sqrt(whole["m"]) * (1 + 1e-12)
        self.longest, self.exact = longest, longest * longest < EXACT
        sample = points.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("x").toPandas()
        centres = farthest_first(augmented(np.stack(sample["x"].to_numpy()).astype(np.float64), longest), CELLS)

        def to_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    y = augmented(np.stack(b["x"].to_numpy()).astype(np.float64), longest)
                    far = np.stack([np.linalg.norm(y - c, axis=1) for c in centres], axis=1)
                    cell = far.argmin(axis=1)
                    yield b.assign(cell=cell.astype(np.int32), far=far[np.arange(len(b)), cell])

        self.points = materialise(points.mapInPandas(to_cells, f"{POINT}, cell int, far double"), "negatives-cells")
        seen = self.points.groupBy("cell").agg(F.count(F.lit(1)).alias("c"), F.max("far").alias("r")).toPandas()      # at most CELLS rows
        cells = pd.DataFrame({"cell": range(len(centres))}).merge(seen, "left", on="cell").fillna({"c": 0, "r": -1.0}).astype({"c": int})
        self.dealt = _deal(cells)
        self.directory = spark.sparkContext.broadcast((centres[:, :-1], cells["r"].to_numpy(), self.dealt))
        self.portions = -(-self.n_anchors // PORTION)

    def search(self, anchors: DataFrame, answer, result: str) -> DataFrame:
        """``anchors``: ``vec_id, label, x, low, high, ask``; an anchor goes to
        the blocks that may hold scores from ``low`` to ``high`` (null: no
        end).  ``answer(tree, ids, labels, scores, anchor)`` gives its rows."""
        directory, portions, longest, exact = self.directory, self.portions, self.longest, self.exact
        ask = anchors.schema["ask"].dataType.simpleString()
        schema = f"block int, portion int, anchor boolean, {POINT}, ask {ask}"

        def stored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            dealt = directory.value[2]
            for b in batches:
                first, n = (np.array(z)[b["cell"]] for z in zip(*dealt))
                block = first + (b["vec_id"].to_numpy() * 0x9E3779B1 >> 7) % n
                for p in range(portions):
                    yield pd.DataFrame({"block": block.astype(np.int32), "portion": np.int32(p), "anchor": False, "vec_id": b["vec_id"],
                                        "label": b["label"], "x": b["x"], "ask": None})

        def sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            centres, radius, dealt = directory.value
            for b in batches:
                rows = []
                for r in b.itertuples(index=False):
                    q = np.asarray(r.x, np.float64)
                    length = float(np.linalg.norm(q))
                    slack = 1e-9 * length * longest + 1e-9
                    middle = centres @ q
                    go = radius >= 0
                    if r.low is not None and not pd.isna(r.low):
                        go &= middle + length * radius + slack >= r.low
                    if r.high is not None and not pd.isna(r.high):
                        go &= middle - length * radius - slack <= r.high
                    for block in sorted({k for c in np.flatnonzero(go).tolist() for k in range(dealt[c][0], sum(dealt[c]))}):
                        rows.append((block, (r.vec_id * 0x9E3779B1 >> 7) % portions, True, r.vec_id, r.label, r.x, r.ask))
                if rows:
                    yield pd.DataFrame(rows, columns=["block", "portion", "anchor", "vec_id", "label", "x", "ask"])

        def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            key, mine, tree = None, [], None
            for b in batches:
                for k, part in b.groupby(["block", "portion"], sort=False):
                    if k != key:
                        key, mine, tree = k, [], None
                    rows = part[~part["anchor"]]
                    if len(rows):
                        mine.append((rows["vec_id"].to_numpy(), rows["label"].to_numpy(), np.stack(rows["x"].to_numpy())))
                    asked = part[part["anchor"]]
                    if not len(asked) or not mine:
                        continue
                    if tree is None:
                        ids, labels, x = (np.concatenate(z) for z in zip(*mine))
                        tree = CoverTree(x, longest)
                        # rows of a leaf lie together
                        ids, labels, x = ids[tree.order], labels[tree.order], x[tree.order]
                        xf = x.astype(np.float64)
                        tree.order = np.arange(len(ids))
                    out = []
                    for r in asked.itertuples(index=False):
                        q = np.asarray(r.x, np.int64)
                        out.extend(answer(tree, ids, labels, lambda at: exact_scores(x[at], xf[at[0]:at[-1] + 1], q, exact), r, q.astype(np.float64)))
                    if out:
                        yield pd.DataFrame(out, columns=[c.split()[0] for c in result.split(", ")])

        cols = ["vec_id", "label", "x"]
        parts = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 1)
        work = (self.points.select(*cols, "cell").mapInPandas(stored, schema)
                .unionAll(anchors.select(*cols, "low", "high", "ask").mapInPandas(sent, schema))
                .repartition(parts, "block", "portion").sortWithinPartitions("block", "portion", "anchor"))
        return work.mapInPandas(found, result)


def mine(points: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`` for the anchors of ``points`` (``vec_id, label, x``, see
    ``quantised``): the rows whose id is divisible by ``every``.

    Scores are integer inner products with the anchor; higher ones come first,
    ties by the smaller id.  An anchor's positives are its first ``positives``
    other rows of its label.  For each, the first ``negatives`` rows of another
    label with ``low * positive_score <= 100 * negative_score <= high *
    positive_score``.  An anchor without a positive, or a positive without such
    a row, gives nothing; neither does an empty table.  Scores beyond a long
    are given as the nearest long.
    """
    ship(points.sparkSession)
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    index = Index(points, F.col("vec_id") % every == 0)
    if not index.rows:
        return points.sparkSession.createDataFrame([], result)
    anchors = index.points.filter(F.col("vec_id") % every == 0).select("vec_id", "label", "x")

    def first_positives(tree, ids, labels, scores, r, q):
        best = Best(positives)

        def visit(rows):
            rows = rows[(labels[rows[0]:rows[-1] + 1] == r.label) & (ids[rows[0]:rows[-1] + 1] != r.vec_id)]
            if len(rows):
                best.add(ids[rows], scores(np.arange(rows[0], rows[-1] + 1))[rows - rows[0]])

        tree.descend(q, best.wanted, visit)
        return [(r.vec_id, i, _long(s)) for i, s in zip(best.ids.tolist(), best.scores.tolist())]

    asked = anchors.select("*", F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
                           F.lit(None).cast("array<struct<id:bigint,score:bigint>>").alias("ask"))
    found = index.search(asked, first_positives, "anchor_id long, id long, score long")
    rank = F.row_number().over(W.partitionBy("anchor_id").orderBy(F.desc("score"), "id"))
    firsts = found.withColumn("n", rank).filter(F.col("n") <= positives)
    asks = materialise(firsts.groupBy("anchor_id").agg(F.collect_list(F.struct("id", "score")).alias("ask")), "negatives-positives")
    # scores looked for lie between the lowest and the highest end of the windows
    score = F.transform("ask", lambda p: p["score"].cast("double"))
    asked = (anchors.join(asks, F.col("vec_id") == F.col("anchor_id"))
             .select("vec_id", "label", "x", (F.array_min(score) * (low / 100)).alias("low"),
                     (F.array_max(score) * (high / 100)).alias("high"), "ask"))

    def first_negatives(tree, ids, labels, scores, r, q):
        wins = [(p["id"], p["score"], Best(negatives, -(-low * p["score"] // 100), high * p["score"] // 100)) for p in r.ask]

        def wanted(a, z):
            return any(w.wanted(a, z) for _, _, w in wins)

        def visit(rows):
            other = labels[rows] != r.label
            if other.any():
                i, s = ids[rows][other], scores(rows)[other]
                for _, _, w in wins:
                    w.add(i, s)

        tree.descend(q, wanted, visit)
        return [(r.vec_id, p, sp, i, _long(s)) for p, sp, w in wins for i, s in zip(w.ids.tolist(), w.scores.tolist())]

    found = index.search(asked, first_negatives, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    rank = F.row_number().over(W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return (found.withColumn("rank", rank).filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
