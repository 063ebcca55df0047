"""Near-duplicate documents: MinHash bands, odd sketches, exact confirmation.

1. Each text becomes its set of distinct five-word shingles.  Two MinHash
   samples are taken of the set: 128 minima under as many hash functions, which
   make 32 band keys of four values each, and the 1,024 smallest values under
   one function (the whole set, if it has no more).  The second sample is
   folded into an odd sketch, a parity bitmap of 2,048 bits: the number of ones
   in the XOR of two bitmaps tells precisely in how many values they differ.
2. Equal sets are one class, so copies never form pairs.
3. Classes that share a band key are compared with the smallest class of that
   key.  A pair whose sizes or sketches rule the threshold out is dropped, the
   others are confirmed on their full sets.
4. Confirmed links give components.  What is left are keys with classes of
   several components: there every pair across components is compared, in
   blocks of a fixed size, by sketch and then on the full sets.  So each pair
   that shares a key is either linked already or was tested itself.

A pair of similarity 0.75 shares no key with probability (1 - 0.75^4)^32, or
5 in a million; the sketch bound lies six standard deviations beyond the
difference that a similarity of 0.75 allows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import materialise, pieces, ship
from pluvio.llm.components import components

WIDTH = 5                      # words in a shingle
PERCENT = 75                   # similarity of a link, in hundredths
BANDS, ROWS = 32, 4            # bands of the sample, values in each
SAMPLE = 1024                  # values that an odd sketch holds
SKETCH_BITS = 2048
SIGMAS = 6.0                   # deviations that a sketch may lie beyond its bound
BLOCK = 256                    # classes in a block of a band key

_K = BANDS * ROWS
_rng = np.random.default_rng(20240229)
_MULT = _rng.integers(1, 1 << 63, size=_K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, size=_K, dtype=np.uint64)
_WORD_MULT = _rng.integers(1, 1 << 63, size=WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_MULT = _rng.integers(1, 1 << 63, size=(BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_ADD = _rng.integers(0, 1 << 63, size=BANDS, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over the others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles.  A-Z are lowered;
    words are runs without ASCII white space; fewer words than a shingle has
    make one shingle of them all; no words make the empty set."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    if n < WIDTH:
        return _mix((h * _WORD_MULT[:n]).sum(keepdims=True) + np.uint64(n))
    s = h[: n - WIDTH + 1] * _WORD_MULT[0]
    for k in range(1, WIDTH):
        s = s + h[k : n - WIDTH + 1 + k] * _WORD_MULT[k]
    return np.unique(_mix(s + np.uint64(WIDTH)))


def _sample(s: np.ndarray) -> np.ndarray:
    low = np.full(_K, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 2048):                       # long texts in steps
        x = s[at : at + 2048]
        np.minimum(low, (x[None, :] * _MULT[:, None] + _ADD[:, None]).min(axis=1), out=low)
    return _mix(low)


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity bitmap of the SAMPLE smallest values, as 64-bit words.  The
    shingle hashes are sorted and well mixed, so their own order serves."""
    at = _mix(shingles[:SAMPLE] + np.uint64(0x9E3779B97F4A7C15)) % np.uint64(SKETCH_BITS)
    odd = (np.bincount(at.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, 4000):
        sets, counts, bands, sketches = [], [], [], []
        for t in b.column("text").to_pylist():
            s = shingle_set(t)
            counts.append(len(s))
            sets.append(xxhash.xxh3_128_digest(s.tobytes()))
            if len(s):
                x = _sample(s)
                bands.append(_mix((x.reshape(BANDS, ROWS) * _BAND_MULT).sum(axis=1) + _BAND_ADD).view(np.int64))
                sketches.append(odd_sketch(s))
            else:
                bands.append(None)
                sketches.append(None)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(sets, pa.binary()), pa.array(counts, pa.int64()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))],
            names=["doc_id", "skey", "n_shingles", "bands", "sketch"])


_SIGNATURE = "doc_id long, skey binary, n_shingles long, bands array<long>, sketch array<long>"


def may_link(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Which pairs of odd sketches (rows of a and b, of sets of n_a and n_b
    shingles) can belong to a pair of at least the threshold.

    Such a pair has at least t * (n_a + n_b) / (1 + t) shingles in common and
    sizes within a factor of t.  A sampled value of either set is missing from
    the other sample if it is not common or lies beyond the other's range;
    that bounds the difference of the samples, which the XOR estimates.
    """
    t, n = PERCENT / 100.0, float(SKETCH_BITS)
    most, least = np.maximum(n_a, n_b).astype(float), np.minimum(n_a, n_b).astype(float)
    # of the common shingles those below the range of the sample of the larger set
    seen = (most + least) * (t / (1.0 + t)) * np.minimum(1.0, SAMPLE / most)
    bound = np.minimum(most, SAMPLE) + np.minimum(least, SAMPLE) - 2.0 * seen
    spread = n / 4.0 * (np.exp(bound * (4.0 / n)) - 1.0) - bound + np.where(most > SAMPLE, 4.0 * seen, 0.0)
    allowed = bound + SIGMAS * np.sqrt(np.maximum(spread, 0.0)) + 2.0
    ones = np.bitwise_count(a ^ b).sum(axis=1)
    differ = -n / 2.0 * np.log(np.maximum(1.0 - ones * (2.0 / n), 1e-9))
    return (100 * least >= PERCENT * most) & (differ <= allowed)


def _matrix(column: pa.Array, width: int = SKETCH_BITS // 64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, width)


def _pairs(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v), pa.int64()), pa.array(np.maximum(u, v), pa.int64())], names=["u", "v"])


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of given pairs those that may be linked."""
    for b in pieces(batches, 4000, 64 << 20):
        u, v, nu, nv = (b.column(c).to_numpy(zero_copy_only=False) for c in ("u", "v", "nu", "nv"))
        ok = may_link(_matrix(b.column("su")), _matrix(b.column("sv")), nu, nv)
        yield _pairs(u[ok], v[ok])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of different components within each pair of blocks of a key that
    may be linked.  Rows come sorted by key and blocks; one pair of blocks is
    held at a time.  A pair that shares several keys is looked at, and given
    out, under its first band only: every key it shares is open, for it holds
    two components."""
    names = ("key", "i", "j", "right", "nid", "label", "n")
    held: list[np.ndarray] | None = None

    def search(rows: list[np.ndarray]) -> pa.RecordBatch | None:
        key, i, j, right, nid, label, n, sketch, bands = rows
        x, y = np.flatnonzero(~right), np.flatnonzero(right)
        found = []
        for at in range(0, len(x), 128):
            p = x[at : at + 128]
            mask = label[p][:, None] != label[y][None, :]
            if i[0] == j[0]:
                mask &= nid[p][:, None] < nid[y][None, :]
            r, c = np.nonzero(mask)
            if len(r):
                r, c = p[r], y[c]
                same = bands[r] == bands[c]
                first = bands[r, same.argmax(axis=1)] == key[:1].view(np.uint64)
                r, c = r[first], c[first]
                ok = may_link(sketch[r], sketch[c], n[r], n[c])
                found.append((nid[r[ok]], nid[c[ok]]))
        if found:
            return _pairs(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))
        return None

    for b in batches:
        rows = [b.column(c).to_numpy(zero_copy_only=False) for c in names] + [_matrix(b.column("sketch")), _matrix(b.column("bands"), BANDS)]
        if held is not None:
            rows = [np.concatenate([h, r]) for h, r in zip(held, rows)]
        if not len(rows[0]):
            continue
        new = (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1]) | (rows[2][1:] != rows[2][:-1])
        starts = np.concatenate([[0], np.flatnonzero(new) + 1, [len(rows[0])]])
        for k in range(len(starts) - 2):
            out = search([r[starts[k] : starts[k + 1]] for r in rows])
            if out is not None:
                yield out
        held = [r[starts[-2] :].copy() for r in rows]
    if held is not None:
        out = search(held)
        if out is not None:
            yield out


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets reach the threshold."""
    last: dict = {}

    def of(text: str) -> np.ndarray:
        if text not in last:
            if len(last) >= 64:
                last.clear()
            last[text] = shingle_set(text)
        return last[text]

    for b in pieces(batches):
        u, v = b.column("u").to_pylist(), b.column("v").to_pylist()
        keep = []
        for s, t in zip(b.column("text_u").to_pylist(), b.column("text_v").to_pylist()):
            x, y = of(s), of(t)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays(
            [pa.array([a for a, k in zip(u, keep) if k], pa.int64()), pa.array([a for a, k in zip(v, keep) if k], pa.int64())],
            names=["u", "v"])


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``u, v`` of ids whose texts are linked on their full sets."""
    side = lambda c: texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}"))
    return pairs.join(side("v"), "v").join(side("u"), "u").select("u", "v", "text_u", "text_v").mapInArrow(_confirm, "u long, v long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    ``component_id`` is the smallest id that links reach, ``kept`` marks the
    document whose own id that is.  Texts that are null or have no words have
    an empty set and are linked with nothing.  Rows that share an id are one
    document: their links are joined.  A row with a null id is linked with
    nothing: its ``component_id`` is null and it is kept.  An empty table
    gives no rows.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sig = materialise(docs.mapInArrow(_signatures, _SIGNATURE), "near-signatures")
    full = sig.filter("doc_id is not null and n_shingles > 0")
    # one class for each set, named after its smallest document; copies are
    # dropped before the shuffle
    classes = materialise(
        full.groupBy("skey").agg(F.min(F.struct("doc_id", "n_shingles", "bands", "sketch")).alias("c"))
        .select("skey", F.col("c.doc_id").alias("nid"), F.col("c.n_shingles").alias("n"), "c.bands", "c.sketch"), "near-classes")
    names = classes.select("skey", "nid")
    sketches = classes.select("nid", "n", "sketch")

    # 3. each class of a band key against the key's smallest class
    banded = classes.select("nid", F.explode("bands").alias("key"))
    keys = banded.groupBy("key").agg(F.min("nid").alias("low"), F.max("nid").alias("high")).filter("low < high")
    member = materialise(banded.join(keys.select("key", "low"), "key"), "near-members")
    near = member.filter("nid > low").select(F.col("low").alias("u"), F.col("nid").alias("v")).distinct()
    for c in ("v", "u"):
        near = near.join(sketches.select(F.col("nid").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}")), c)
    near = materialise(near.select("u", "v", "nu", "nv", "su", "sv").mapInArrow(_sketched, "u long, v long").distinct(), "near-pairs")
    # texts of the classes that share a key with another are set aside once;
    # the same plan at every size
    need = member.select(F.col("nid").alias("doc_id")).distinct()
    texts = materialise(docs.filter("doc_id is not null and text is not null")
                        .join(need.hint("merge"), "doc_id", "left_semi").distinct(), "near-texts")
    links = materialise(confirmed(near, texts), "near-links")
    # documents that rows of several texts share
    several = (full.join(names, "skey").groupBy("doc_id").agg(F.min("nid").alias("u"), F.max("nid").alias("v"))
               .filter("u < v").select("u", "v"))
    links = materialise(links.unionAll(several), "near-links")
    label = components(links)

    # 4. keys that still hold several components
    labelled = (member.select("key", "nid").join(label, F.col("nid") == F.col("node"), "left")
                .select("key", "nid", F.coalesce("label", "nid").alias("label")))
    labelled = materialise(labelled, "near-members")
    open_keys = (labelled.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.count(F.lit(1)).alias("c"))
                 .filter("a < b").select("key", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks")))
    split = labelled.join(open_keys, "key").join(classes.select("nid", "n", "sketch", "bands"), "nid").withColumn("block", F.expr("int(pmod(xxhash64(nid), blocks))"))
    split = materialise(split, "near-open")
    if not split.isEmpty():
        own = [F.col(c) for c in ("nid", "label", "n", "sketch", "bands")]
        left = split.select("key", F.col("block").alias("i"), F.explode(F.expr("sequence(block, blocks - 1)")).alias("j"), F.lit(False).alias("right"), *own)
        right = split.select("key", F.explode(F.expr("sequence(0, block)")).alias("i"), F.col("block").alias("j"), F.lit(True).alias("right"), *own)
        met = (left.unionAll(right).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
               .mapInArrow(_across, "u long, v long"))
        pairs = materialise(met.join(near, ["u", "v"], "left_anti"), "near-pairs")
        if not pairs.isEmpty():
            label = components(links.unionAll(materialise(confirmed(pairs, texts), "near-links")))

    # a label is the smallest class name, and so the smallest id, of its component
    group = names.join(label, F.col("nid") == F.col("node"), "left").select("skey", F.coalesce("label", "nid").alias("component_id"))
    linked = full.select("doc_id", "skey", "n_shingles").join(group, "skey").select("doc_id", "n_shingles", "component_id")
    alone = (sig.filter("doc_id is null or n_shingles = 0")
             .select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return linked.unionAll(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document is kept.  Of rows equal in id and
    text one stays; rows with a null id stay."""
    kept = near_duplicates(docs).filter("kept and doc_id is not null").select(F.col("doc_id").alias("kept_id")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("t"), F.struct("*").alias("r"))
    # ids are unique in a sound table, so the groups of (id, t) are single rows
    once = rows.join(kept, F.col("id") == F.col("kept_id"), "left_semi").dropDuplicates(["id", "t"])
    return once.unionAll(rows.filter("id is null")).select("r.*")
