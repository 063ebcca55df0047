"""Exact substring dedup by merging the Burrows-Wheeler transforms of shards.

A byte goes if a string of WINDOW bytes that covers it also starts earlier: in a
text of smaller id, or before in the same text.

Which texts to look at together: every string of WINDOW bytes has an anchor, the
ANCHOR bytes in it whose hash is smallest (the leftmost of equals).  Equal
strings have equal anchors at equal offsets, so strings are compared within an
anchor only, and an anchor that stands in one place has no repeat.  Strings on
end that share an anchor travel as one context, ANCHOR * 3 to 168 bytes; contexts
that are equal as a whole count once, under their first place, before any text
is shuffled.

What repeats: contexts of an anchor are dealt into shards.  Texts are read in
symbols of STEP bytes (by 32-bit hashes), so a string of WINDOW bytes is its
suffix's first STEPS symbols.  Each shard gets its Burrows-Wheeler transform;
the transforms of all shards are merged by refining the interleave of their
suffixes: a round reads the transforms in the order so far and deals their
symbols out stably, which is the order by one symbol more.  Suffixes are not
sorted again; only the shard number of each place in the order moves.  The round
in which two neighbours part is their common prefix in symbols; neighbours that
never part are a repeated interval, and the earliest context in it is the first
place of the string.  Bytes decide at last: the strings of an interval are
compared with its first place.

An anchor with more than LIMIT different contexts (a passage in very many texts
with all kinds of neighbours) is not put into one task: its strings are grouped
by 128-bit digests of all their bytes, row by row, which is exact up to those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import materialise, pieces, ship

WINDOW = 100                  # bytes of a string that counts as a repeat
ANCHOR = 32                   # bytes of an anchor
STEP = 25                     # bytes of a symbol
STEPS = WINDOW // STEP
SPAN = WINDOW - ANCHOR + 1    # places in a string where its anchor may stand
LIMIT = 2000                  # contexts of an anchor that are merged in one task
SHARD = 1 << 18               # bytes of a shard
PIECE = 1 << 20               # bytes of contexts that a task merges at once
CHUNK = 900_000               # strings that are given their anchors at once (below 2 ** 20)

_U = np.uint64
_BYTE = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
_ODD = np.random.default_rng(12).integers(1, 1 << 63, 8, dtype=np.uint64) | _U(1)
_LOW = _U((1 << 20) - 1)


def block_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of the ``size`` bytes from every place, by doubling."""
    if len(data) < size:
        return np.empty(0, np.uint64)
    h, have, out, done = _BYTE[data], 1, None, 0
    level = 0
    while have <= size:
        if size & have:
            # the part of ``have`` bytes that begins ``done`` bytes on
            out = h if out is None else out[: len(data) - done - have + 1] * _ODD[7] + h[done:]
            out = out[: len(data) - done - have + 1]
            done += have
        if 2 * have <= size:
            h = h[:-have] * _ODD[level] + h[have:]
            h ^= h >> _U(29)
        have *= 2
        level += 1
    out = out * _ODD[6]
    out ^= out >> _U(32)
    return out


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """For texts on end (``ends``: where each one ends; at most 2 ** 20 bytes
    together): anchor hash, place of the anchor, and the first and last start
    of the strings that it is the anchor of."""
    if len(data) < WINDOW:
        return (np.empty(0, np.uint64),) + (np.empty(0, np.int64),) * 3
    h = block_hashes(data, ANCHOR)
    least = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
    have = 1
    while 2 * have <= SPAN:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < SPAN:
        least = np.minimum(least[: len(least) - (SPAN - have)], least[SPAN - have:])
    inside = np.repeat(ends, np.diff(ends, prepend=0))[: len(least)] - np.arange(len(least)) >= WINDOW
    starts = np.flatnonzero(inside)
    at = (least[starts] & _LOW).astype(np.int64)
    if not len(at):
        return h[:0], at, at, at
    cut = np.flatnonzero(np.diff(at)) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(at)]]) - 1
    place = at[first]
    return h[place], place, starts[first], starts[last]


def _chunks(texts: list[bytes]) -> Iterator[list[tuple[int, int, int]]]:
    """(text, first byte, after the last) of what is given its anchors together;
    the parts of a long text overlap, so that each string is in one of them."""
    some: list[tuple[int, int, int]] = []
    size = 0
    for i, t in enumerate(texts):
        at = 0
        while len(t) - at >= WINDOW:
            z = min(len(t), at + CHUNK + WINDOW - 1)
            if some and size + z - at > CHUNK:
                yield some
                some, size = [], 0
            some.append((i, at, z))
            size += z - at
            at = z - WINDOW + 1
    if some:
        yield some


def _packed(place: np.ndarray, far: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Place of an anchor, and the offsets of its strings' starts before it."""
    return (place << 14) | (far << 7) | near


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, 2000):
        texts = [t or b"" for t in b.column("text").to_pylist()]
        ids, keys = b.column("doc_id"), b.column("tkey").to_numpy(zero_copy_only=False)
        for parts in _chunks(texts):
            raw = b"".join([texts[i][a:z] for i, a, z in parts])
            ends = np.cumsum([z - a for _, a, z in parts])
            h, place, lo, hi = anchors(np.frombuffer(raw, np.uint8), ends)
            if not len(h):
                continue
            part = np.searchsorted(ends, place, "right")
            shift = np.array([a for _, a, _ in parts]) - (ends - np.array([z - a for _, a, z in parts]))
            text = np.array([i for i, _, _ in parts])[part]
            digest = xxhash.xxh3_64_intdigest
            ctx = np.array([digest(raw[a:z]) for a, z in zip(lo.tolist(), (hi + WINDOW).tolist())], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(ctx.view(np.int64)), ids.take(pa.array(text)), pa.array(keys[text]),
                 pa.array(_packed(place + shift[part], place - lo, place - hi))], names=["h", "ctx", "doc_id", "tkey", "at"])


def _deal_out(symbols: np.ndarray) -> np.ndarray:
    """The stable order of small whole numbers, 16 bits at a time."""
    order = np.argsort((symbols & 0xFFFF).astype(np.uint16), kind="stable")
    high = (symbols >> 16).astype(np.uint16)
    return order[np.argsort(high[order], kind="stable")] if high.any() else order


class Shard:
    """The Burrows-Wheeler transform of strings on end, ``data`` cut at ``ends``,
    read in symbols of STEP bytes.  Each string is STEP chains of symbols; what
    is too short for a symbol is 0, and in front of a chain's first symbol
    stands its last.  ``order``: suffixes by their first STEPS symbols;
    ``before``: the symbol in front of each suffix in that order."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        sizes = np.diff(ends, prepend=0)
        end, size = np.repeat(ends, sizes), np.repeat(sizes, sizes)
        at = np.arange(len(data))
        symbol = np.zeros(len(data), np.uint32)
        h = (block_hashes(data, STEP) >> _U(32)).astype(np.uint32)
        whole = at[: len(h)] + STEP <= end[: len(h)]
        symbol[: len(h)][whole] = h[whole] | np.uint32(1)
        rel = at - (end - size)
        front = np.where(rel >= STEP, at - STEP, at + STEP * ((size - 1 - rel) // STEP))
        order = at
        for _ in range(STEPS):
            order = front[order]
            order = order[_deal_out(symbol[order])]
        self.order, self.before = order, symbol[front[order]]


def merge(shards: list[Shard]) -> tuple[np.ndarray, np.ndarray]:
    """The interleave of the shards' suffixes by their first STEPS symbols, as
    the shard at each place, and how many symbols each place has in common with
    the one before it (STEPS: all that were compared)."""
    interleave = np.repeat(np.arange(len(shards), dtype=np.int16), [len(x.order) for x in shards])
    common = np.full(len(interleave), STEPS, np.int8)
    block = np.zeros(len(interleave), np.int32)
    for r in range(STEPS):
        front = np.empty(len(interleave), np.uint32)
        for z, x in enumerate(shards):
            front[interleave == z] = x.before
        deal = _deal_out(front)
        interleave, front, block = interleave[deal], front[deal], block[deal]
        part = np.empty(len(deal), bool)
        part[:1] = True
        part[1:] = (front[1:] != front[:-1]) | (block[1:] != block[:-1])
        common[part & (common == STEPS)] = r
        block = np.cumsum(part, dtype=np.int32)
    return interleave, common


def firsts(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every place in the strings on end: the number of the first string
    that holds the WINDOW bytes from there (its own, where fewer are left), and
    the ends of the strings."""
    ends = np.cumsum([len(x) for x in strings])
    n = max(1, -(-int(ends[-1]) // SHARD))
    shards, places = [], []
    starts = ends - np.diff(ends, prepend=0)
    for k in range(n):
        mine = list(range(k, len(strings), n))
        if not mine:
            continue
        local = np.cumsum([len(strings[i]) for i in mine])
        shards.append(Shard(np.frombuffer(b"".join([strings[i] for i in mine]), np.uint8), local))
        sizes = np.diff(local, prepend=0)
        places.append(np.repeat(starts[mine] - (local - sizes), sizes)[shards[-1].order] + shards[-1].order)
    interleave, common = merge(shards)
    order = np.empty(len(interleave), np.int64)
    for z, p in enumerate(places):
        order[interleave == z] = p
    owner = np.repeat(np.arange(len(strings)), np.diff(ends, prepend=0))
    first = owner.copy()
    begin = np.flatnonzero(common < STEPS)
    whole = (np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(owner)) >= WINDOW)[order]
    least = np.minimum.reduceat(np.where(whole, owner[order], len(strings)), begin)
    first[order] = np.where(whole, np.repeat(least, np.diff(begin, append=len(order))), owner[order])
    return first, ends


def _by_bytes(strings: list[bytes]) -> list[list[int]]:
    """As ``firsts``, string by string, from the bytes alone."""
    seen: dict[bytes, int] = {}
    return [[seen.setdefault(x[i:i + WINDOW], k) for i in range(len(x) - WINDOW + 1)] for k, x in enumerate(strings)]


def repeats(strings: list[bytes], far: np.ndarray, group: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(string, first start, last start, first string that holds these) for the
    stretches of starts that stand in an earlier string.  ``far``: where the
    anchor stands in each string; ``group``: numbers of the anchors."""
    first, ends = firsts(strings)
    owner = np.repeat(np.arange(len(strings)), np.diff(ends, prepend=0))
    begins = ends - np.diff(ends, prepend=0)
    cut = np.flatnonzero((np.diff(first) != 0) | (np.diff(owner) != 0)) + 1
    a, z = np.concatenate([[0], cut]), np.concatenate([cut, [len(first)]]) - 1
    found = first[a] != owner[a]
    out, wrong = [], set()
    k, f = owner[a[found]], first[a[found]]
    for i, j, x, y in zip(k.tolist(), f.tolist(), (a[found] - begins[k]).tolist(), (z[found] - begins[k]).tolist()):
        shift = int(far[j] - far[i])
        if group[i] != group[j] or x + shift < 0 or strings[i][x:y + WINDOW] != strings[j][x + shift:y + shift + WINDOW]:
            wrong.add(int(group[i]))                            # two blocks of STEP bytes with one hash
        out.append((i, x, y, j))
    if wrong:
        out = [r for r in out if int(group[r[0]]) not in wrong]
        for g in wrong:
            mine = np.flatnonzero(group == g).tolist()
            for i, seen in zip(mine, _by_bytes([strings[i] for i in mine])):
                out.extend((i, x, x, mine[j]) for x, j in enumerate(seen) if mine[j] != i)
    return out


_RUN = pa.list_(pa.struct([("a", pa.int32()), ("z", pa.int32()), ("doc_id", pa.int64()), ("tkey", pa.int64()), ("p", pa.int64())]))
_RUN_SQL = "array<struct<a:int,z:int,doc_id:bigint,tkey:bigint,p:bigint>>"
_STRING = "h long, ctx long, n long, doc_id long, tkey long, at long, string binary"


def _merge_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts by anchor and place -> offsets of the strings that stand earlier,
    with the first place of their anchor."""

    def settled(t: pa.Table) -> pa.RecordBatch:
        h, at = t.column("h").to_numpy(), t.column("at").to_numpy()
        far = (at >> 7) & 127
        rows: dict[int, list[dict]] = {}
        ids, keys = t.column("doc_id").to_pylist(), t.column("tkey").to_pylist()
        group = np.cumsum(np.diff(h, prepend=h[0]) != 0)
        for i, x, y, j in repeats(t.column("string").to_pylist(), far, group):
            rows.setdefault(i, []).append({"a": int(far[i]) - y, "z": int(far[i]) - x, "doc_id": ids[j], "tkey": keys[j], "p": int(at[j]) >> 14})
        mine = pa.array(list(rows), pa.int64())
        return pa.RecordBatch.from_arrays([t.column("h").take(mine).combine_chunks(), t.column("ctx").take(mine).combine_chunks(),
                                           pa.array(list(rows.values()), _RUN)], names=["h", "ctx", "runs"])

    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size < PIECE or not b.num_rows:
            continue
        t = pa.Table.from_batches(held)
        h = t.column("h").to_numpy()
        edges = np.flatnonzero(np.diff(h)) + 1                    # an anchor's contexts stay together
        at, each = 0, max(1, int(len(h) * PIECE / size))
        while len(edges) and at < edges[-1]:
            z = edges[np.searchsorted(edges, min(at + each, edges[-1]))]
            yield settled(t.slice(at, z - at))
            at = int(z)
        t = t.slice(at).combine_chunks()
        held = t.to_batches()
        size = int(t.nbytes)
    if held and sum(b.num_rows for b in held):
        yield settled(pa.Table.from_batches(held))


def _strings_one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of the contexts, by the digest of its bytes."""
    for b in pieces(batches, 2000):
        rows, offsets, digests = [], [], []
        for i, (at, x) in enumerate(zip(b.column("at").to_pylist(), b.column("string").to_pylist())):
            n = len(x) - WINDOW + 1
            rows.extend([i] * n)
            offsets.extend(((at >> 7) & 127) - k for k in range(n))
            digests.extend(xxhash.xxh3_128_digest(x[k:k + WINDOW]) for k in range(n))
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([*(b.column(c).take(at) for c in ("h", "ctx", "doc_id", "tkey", "at")), pa.array(offsets, pa.int32()),
                                          pa.array(digests, pa.binary())], names=["h", "ctx", "doc_id", "tkey", "at", "o", "digest"])


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, 500):
        rows, got, strings = [], {k: [] for k in ("h", "ctx", "n", "at")}, []
        for i, (t, wanted) in enumerate(zip(b.column("text").to_pylist(), b.column("wanted").to_pylist())):
            raw = t or b""
            for w in wanted:
                p, far, near = w["at"] >> 14, (w["at"] >> 7) & 127, w["at"] & 127
                rows.append(i)
                strings.append(raw[p - far:p - near + WINDOW])
                for k, v in got.items():
                    v.append(w[k])
        at = pa.array(rows, pa.int64())
        c = {k: pa.array(v, pa.int64()) for k, v in got.items()}
        yield pa.RecordBatch.from_arrays([c["h"], c["ctx"], c["n"], b.column("doc_id").take(at), b.column("tkey").take(at), c["at"],
                                          pa.array(strings, pa.binary())], names=["h", "ctx", "n", "doc_id", "tkey", "at", "string"])


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, 500):
        spans, kept, sizes = [], [], []
        for t, hits in zip(b.column("text").to_pylist(), b.column("hits").to_pylist()):
            raw = t or b""
            mine: list[dict] = []
            for x in sorted(hits or (), key=lambda x: x["start"]):
                if mine and x["start"] <= mine[-1]["end"]:
                    mine[-1]["end"] = max(mine[-1]["end"], x["end"])
                else:
                    mine.append(dict(x))
            edges = [0, *(e for x in mine for e in (x["start"], x["end"])), len(raw)]
            spans.append(mine)
            sizes.append(len(raw))
            kept.append(b"".join(raw[a:z] for a, z in zip(edges[::2], edges[1::2])) if mine else raw)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, _SPANS), pa.array(kept, pa.binary())],
                                         names=["doc_id", "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` for every row of ``docs``: the UTF-8
    bytes of the text, the stretches ``[start, end)`` of them that are covered
    by a string of WINDOW bytes that also starts earlier, and the other bytes on
    end (which may cut a character).

    A text of smaller id is earlier (null last); texts that share an id stand in
    the order of a hash of theirs; rows equal in id and text are one text, and
    lose the same bytes.  Null, empty and short texts lose nothing.  An empty
    table gives no rows.
    """
    ship(docs.sparkSession)
    text_key = F.xxhash64("text")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # ids that several texts share; next to none, so that texts need no key of their own otherwise
    shared = materialise(base.groupBy("doc_id").agg(F.min(text_key).alias("a"), F.max(text_key).alias("z"))
                         .filter("a <> z").select(F.col("doc_id").alias("s_id"), F.lit(True).alias("s")), "suffix-shared")
    rows = (base.join(shared, F.col("doc_id").eqNullSafe(F.col("s_id")), "left")
            .select("doc_id", F.col("text").cast("binary").alias("text"), F.when(F.col("s"), text_key).otherwise(F.lit(0)).cast("long").alias("tkey")))

    found = rows.mapInArrow(_find_anchors, "h long, ctx long, doc_id long, tkey long, at long")
    twice = materialise(found.groupBy("h").count().filter("count > 1").select("h"), "suffix-anchors")
    places = materialise(found.join(twice, "h", "left_semi"), "suffix-places")
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "tkey", "at")
    contexts = materialise(places.groupBy("h", "ctx").agg(F.min(place).alias("f"), F.count(F.lit(1)).alias("c")), "suffix-contexts")
    several = contexts.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    wanted = (contexts.join(several, "h").groupBy(F.col("f.doc_id").alias("w_id"), F.col("f.tkey").alias("w_key"))
              .agg(F.collect_list(F.struct("h", "ctx", "n", F.col("f.at").alias("at"))).alias("wanted")))
    strings = materialise(
        rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("tkey") == F.col("w_key")))
        .select("doc_id", "text", "tkey", "wanted").mapInArrow(_cut_contexts, _STRING), "suffix-strings")

    merged = (strings.filter(F.col("n") <= LIMIT).repartition("h")
              .sortWithinPartitions("h", F.col("doc_id").isNull(), "doc_id", "tkey", "at")
              .mapInArrow(_merge_contexts, f"h long, ctx long, runs {_RUN_SQL}"))
    single = strings.filter(F.col("n") > LIMIT).mapInArrow(
        _strings_one_by_one, "h long, ctx long, doc_id long, tkey long, at long, o int, digest binary")
    least = single.groupBy("digest").agg(F.min(place).alias("f"))
    run = F.struct(F.col("o").alias("a"), F.col("o").alias("z"), F.col("f.doc_id").alias("doc_id"), F.col("f.tkey").alias("tkey"),
                   F.shiftright("f.at", 14).alias("p"))
    crowded = (single.join(least, "digest").filter(place != F.col("f")).groupBy("h", "ctx")
               .agg(F.collect_list(run).cast(_RUN_SQL).alias("runs")))
    inside = materialise(merged.unionByName(crowded), "suffix-repeats")

    # a place stands behind the first place of its context, and its context's strings behind theirs
    other = F.filter(F.concat(
        F.array(F.struct(F.lit(0).alias("a"), F.lit(127).alias("z"), F.col("f.doc_id").alias("doc_id"), F.col("f.tkey").alias("tkey"),
                         F.shiftright("f.at", 14).alias("p"))).cast(_RUN_SQL),
        F.coalesce("runs", F.array().cast(_RUN_SQL))),
        lambda r: ~(r["doc_id"].eqNullSafe(F.col("doc_id")) & (r["tkey"] == F.col("tkey")) & (r["p"] == F.shiftright("at", 14))))
    # written, so that the join below is one of two plain shuffles, whose hot keys Spark splits
    told = materialise(contexts.join(inside, ["h", "ctx"], "left").filter("c > 1 or runs is not null").drop("c"), "suffix-firsts")
    p, far, near = F.shiftright("at", 14), F.shiftright("at", 7).bitwiseAND(F.lit(127)), F.col("at").bitwiseAND(F.lit(127))
    hits = (places.join(told, ["h", "ctx"])
            .select("doc_id", "tkey", p.alias("p"), far.alias("far"), near.alias("near"), F.explode(other).alias("r"))
            .select("doc_id", "tkey", F.struct((F.col("p") - F.least("far", F.col("r.z").cast("long"))).alias("start"),
                                               (F.col("p") - F.greatest("near", F.col("r.a").cast("long")) + WINDOW).alias("end")).alias("hit"))
            .groupBy(F.col("doc_id").alias("g_id"), F.col("tkey").alias("g_key")).agg(F.collect_list("hit").alias("hits")))
    return (rows.join(hits, F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("tkey") == F.col("g_key")), "left")
            .select("doc_id", "text", "hits")
            .mapInArrow(_cut_texts, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"))
