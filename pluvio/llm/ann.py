"""Approximate nearest neighbours with multiprobe p-stable hashing.

Vectors are scaled by the largest length and get one more component that makes
their length one (the query gets a zero there), so the largest inner product
is the smallest Euclidean distance.  Each table hashes a vector by ``K``
Gaussian projections cut into slots of width ``WIDTH``; the slots together
name a cell.  The outermost slots are open, so a table has at most SLOTS ** K
cells and its directory of cells and counts has a fixed bound.

For a query the cells of a table are put in the order of their estimated
success probability: that a neighbour at the expected distance, whose
projections differ from the query's by a normal deviate, falls into all the
cell's slots.  Cells are visited in that order until they hold ``SHARE`` of
the table (and at least ``LEAST`` vectors).  Candidates of all tables are
merged and reranked by their exact inner product.

Cells are dealt into blocks of about ``BLOCK`` vectors.  A cell larger than a
block is spread over several, so one very common vector fills no task; the
queries that visit a block are dealt in portions likewise.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import erf, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pluvio.llm.common import materialise, ship

TABLES = 6
K = 4
SLOTS = 8
WIDTH = 0.75
SHARE = 0.2                   # of a table that a query visits
LEAST = 2000
NEAR = 1.1                    # distance of a neighbour that probes reckon with
BLOCK = 4096                  # vectors in a block
PORTION = 4096                # queries for a block at once
SEED = 7

_phi = np.vectorize(lambda z: 0.5 * (1.0 + erf(z / sqrt(2.0))), otypes=[float])


def projections(dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(TABLES, dim + 1, K) directions and (TABLES, K) offsets."""
    rng = np.random.default_rng([SEED, dim])
    return rng.standard_normal((TABLES, dim + 1, K)), rng.random((TABLES, K)) * WIDTH


def _augmented(x: np.ndarray, longest: float, query: bool) -> np.ndarray:
    lengths = np.linalg.norm(x, axis=1)
    if query:
        return np.hstack([x / np.maximum(lengths, 1e-300)[:, None], np.zeros((len(x), 1))])
    y = x / longest
    return np.hstack([y, np.sqrt(np.maximum(0.0, 1.0 - (lengths / longest) ** 2))[:, None]])


def cells_of(x: np.ndarray, longest: float) -> np.ndarray:
    """(rows, TABLES) cell numbers."""
    a, b = projections(x.shape[1])
    y = _augmented(x, longest, False)
    out = np.empty((len(x), TABLES), np.int32)
    for t in range(TABLES):
        slot = np.clip(np.floor((y @ a[t] + b[t]) / WIDTH).astype(np.int64) + SLOTS // 2, 0, SLOTS - 1)
        out[:, t] = slot @ (SLOTS ** np.arange(K))
    return out


def success_order(x: np.ndarray) -> Iterator[np.ndarray]:
    """For each table, (rows, cells) the log of the estimated success probability."""
    a, b = projections(x.shape[1])
    y = _augmented(x, 1.0, True)
    low = (np.arange(SLOTS) - SLOTS // 2) * WIDTH
    high = low + WIDTH
    low[0], high[-1] = -1e6, 1e6
    for t in range(TABLES):
        p = (y @ a[t] + b[t])[..., None]
        logs = np.log(np.maximum(_phi((high - p) / NEAR) - _phi((low - p) / NEAR), 1e-30))
        score = np.zeros((len(x),) + (1,) * K)
        for k in range(K):
            score = score + logs[:, k].reshape([len(x)] + [SLOTS if i == K - 1 - k else 1 for i in range(K)])
        yield score.reshape(len(x), -1)


def _dealt(counts: pd.DataFrame) -> dict[int, dict[int, tuple[int, int, int]]]:
    """table -> cell -> (rows, first block, blocks).  Small cells share a block."""
    out: dict[int, dict[int, tuple[int, int, int]]] = {}
    for t, part in counts.sort_values(["t", "cell"]).groupby("t"):
        block = filled = 0
        here = out.setdefault(int(t), {})
        for cell, c in zip(part["cell"], part["c"]):
            if filled and filled + c > BLOCK:
                block, filled = block + 1, 0
            n = max(1, -(-int(c) // BLOCK))
            here[int(cell)] = (int(c), block, n)
            if n > 1:
                block, filled = block + n, 0
            else:
                filled += int(c)
    return out


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", dim: int | None = None) -> DataFrame:
    """``vec_id, x`` (array of double) of the vectors that take part: not null,
    no null or non-finite component, not zero, and of the most common length
    (or of length ``dim``)."""
    x = F.col(f"`{embedding}`").cast("array<double>")
    v = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), x.alias("x")).filter("vec_id is not null and x is not null")
    bad = F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    v = v.filter(~bad & F.exists("x", lambda e: e != 0.0))
    if dim is None:
        top = v.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
        dim = top["d"] if top else 0
    return v.filter(F.size("x") == dim)


def nearest(vectors: DataFrame, n: int = 20, every: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each usable row whose id is
    divisible by ``every`` its ``n`` nearest other rows found, by inner product
    in double precision, ties to the smaller id.

    Rows that ``usable`` leaves out take no part.  Candidates are all rows with
    another id; rows that repeat an id count as one vector each but an id is
    listed once, with its best score.  A table with fewer than ``LEAST`` rows
    is searched whole.  No usable rows give no result.
    """
    spark = vectors.sparkSession
    ship(spark)
    v = usable(vectors)
    whole = v.agg(F.max(F.aggregate("x", F.lit(0.0), lambda s, e: s + e * e)).alias("m"), F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first()
    result = "query_id long, rank int, vec_id long, score double"
    if not whole["n"]:
        return spark.createDataFrame([], result)
    longest, total, dim = sqrt(whole["m"]), whole["n"], whole["d"]

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                c = cells_of(np.stack(b["x"].to_numpy()), longest)
                yield pd.DataFrame({"vec_id": b["vec_id"], "x": b["x"], "cells": list(c)})

    index = materialise(v.mapInPandas(hashed, "vec_id long, x array<double>, cells array<int>"), "ann-index")
    per_cell = index.select(F.posexplode("cells").alias("t", "cell")).groupBy("t", "cell").agg(F.count(F.lit(1)).alias("c"))
    directory = spark.sparkContext.broadcast(_dealt(per_cell.toPandas()))        # at most TABLES * SLOTS ** K rows
    spread = max(1, total // (every * PORTION))                                  # portions of the queries

    def to_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places = directory.value
        for b in batches:
            if not len(b):
                continue
            ids, cells = b["vec_id"].to_numpy(), np.stack(b["cells"].to_numpy())
            for t in range(TABLES):
                first = np.array([places[t][c][1] for c in cells[:, t].tolist()])
                blocks = np.array([places[t][c][2] for c in cells[:, t].tolist()])
                at = first + (ids * 0x9E3779B1 >> 7) % blocks
                for q in range(spread):
                    yield pd.DataFrame({"t": np.int32(t), "block": at.astype(np.int32), "portion": np.int32(q), "query": False,
                                        "id": ids, "x": b["x"], "cells": [[c] for c in cells[:, t].tolist()]})

    def to_probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places = directory.value
        wanted = max(SHARE * total, LEAST)
        counts = np.zeros((TABLES, SLOTS ** K), np.int64)
        for t, cells in places.items():
            for c, (n_rows, _, _) in cells.items():
                counts[t, c] = n_rows
        for b in batches:
            for at in range(0, len(b), 128):
                part = b.iloc[at : at + 128]
                ids, x = part["vec_id"].to_numpy(), np.stack(part["x"].to_numpy())
                rows = []
                for t, score in enumerate(success_order(x)):
                    held = np.flatnonzero(counts[t])
                    order = held[np.argsort(-score[:, held], axis=1, kind="stable")]
                    c = counts[t][order]
                    go = np.cumsum(c, axis=1) - c < wanted
                    for i in range(len(ids)):
                        by_block: dict[int, list[int]] = {}
                        for cell in order[i][go[i]].tolist():
                            _, first, blocks = places[t][cell]
                            for k in range(first, first + blocks):
                                by_block.setdefault(k, []).append(cell)
                        q = int(ids[i]) // every % spread
                        rows.extend((t, k, q, True, int(ids[i]), x[i], cells) for k, cells in by_block.items())
                if rows:
                    yield pd.DataFrame(rows, columns=["t", "block", "portion", "query", "id", "x", "cells"])

    schema = "t int, block int, portion int, query boolean, id long, x array<double>, cells array<int>"
    stored = index.mapInPandas(to_blocks, schema)
    probes = index.filter(F.col("vec_id") % every == 0).mapInPandas(to_probes, schema)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    work = (stored.unionAll(probes).repartition(parts, "t", "block", "portion")
            .sortWithinPartitions("t", "block", "portion", "query"))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        key, vec_ids, xs, cells, ready = None, [], [], [], None

        def flush() -> pd.DataFrame:
            out = pd.DataFrame({"query_id": np.repeat(np.fromiter(best, np.int64, len(best)), [len(i) for i, _ in best.values()]),
                                "vec_id": np.concatenate([i for i, _ in best.values()]) if best else np.empty(0, np.int64),
                                "score": np.concatenate([s for _, s in best.values()]) if best else np.empty(0)})
            best.clear()
            return out

        for b in batches:
            for k, part in b.groupby(["t", "block", "portion"], sort=False):
                if k != key:
                    key, vec_ids, xs, cells, ready = k, [], [], [], None
                mine = part[~part["query"]]
                if len(mine):
                    vec_ids.append(mine["id"].to_numpy())
                    xs.append(np.stack(mine["x"].to_numpy()))
                    cells.append(np.concatenate(mine["cells"].to_numpy()))
                asked = part[part["query"]]
                if not len(asked) or not vec_ids:
                    continue
                if ready is None:
                    ready = distinct(np.concatenate(vec_ids), np.concatenate(xs), np.concatenate(cells))
                ids, x, cell = ready
                marked = np.zeros(SLOTS ** K, bool)
                for at in range(0, len(asked), 64):
                    some = asked.iloc[at : at + 64]
                    rough = np.stack(some["x"].to_numpy()) @ x.T
                    for query, y, visits, r in zip(some["id"], some["x"], some["cells"], rough):
                        marked[visits] = True
                        seen = np.flatnonzero(marked[cell] & (ids != query))
                        marked[visits] = False
                        if len(seen):
                            got = top(ids, x, y, seen, r[seen], n)
                            if query in best:
                                got = merged(*(np.concatenate(z) for z in zip(got, best[query])), n)
                            best[query] = got
                if len(best) > 20_000:
                    yield flush()
        if best:
            yield flush()

    found = work.mapInPandas(search, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= n).select("query_id", "rank", "vec_id", "score")


def merged(ids: np.ndarray, scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The best n by score, ties to the smaller id; an id once."""
    order = np.lexsort((ids, -scores))
    _, first = np.unique(ids[order], return_index=True)
    order = order[np.sort(first)][:n]
    return ids[order], scores[order]


def distinct(ids: np.ndarray, x: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows without repeats of the same id and vector."""
    if len(np.unique(ids)) == len(ids):
        return ids, x, cell
    first = list({(i, v.tobytes()): k for k, (i, v) in reversed(list(enumerate(zip(ids.tolist(), x))))}.values())
    return ids[first], x[first], cell[first]


def top(ids: np.ndarray, x: np.ndarray, y: np.ndarray, at: np.ndarray, rough: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n nearest of the rows ``at`` of x to y.  The fast product finds who
    can be among them; their scores are then summed in an order that does not
    depend on where a row lies, so equal vectors tie exactly."""
    if len(rough) > n:
        bound = np.partition(rough, len(rough) - n)[len(rough) - n]
        at = at[rough >= bound - 1e-9 * max(1.0, abs(bound))]
    return merged(ids[at], (x[at] * y).sum(axis=1), n)
