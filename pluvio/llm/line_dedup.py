"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of ROLL lines on end decides whether a chunk ends
between the last two of them, by these lines alone: text put in front of a
passage, or behind it, moves no boundary inside it.  A chunk with words in two
or more lines counts.  A chunk that counts and stands in several places grows
line by line to both sides, up to the far ends of the chunks that count before
and after it; whatever is equal there is repeated as well.

A passage can be too short to hold a whole chunk.  So the shortest runs of lines
with PARAGRAPH_WORDS words or more, from every line forwards and backwards, are
looked up too, but only those without a chunk that counts strictly inside.
Together: a passage of so many words that stands in two places goes whole from
the later one, from its first line to its last, whatever stands next to it.  If
it holds a chunk strictly inside, both places have that chunk and grow it to the
passage's ends; if not, all its shortest runs are looked up in both places.  Of
shorter repeated passages what lies around a chunk goes.

Stretches of lines are looked up by hashes of their lines, which are shuffled
first; texts are shuffled once, and then only the repeated stretches: equal
hashes are only a hint, the bytes decide.  All but the first place of a stretch
are removed.
"""

from __future__ import annotations

from array import array
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import WORD, materialise, pieces, ship

PARAGRAPH_WORDS = 50          # words that make a run of lines a passage without a chunk
ROLL = 2                      # lines that the rolling hash covers
DIVISOR = 2                   # one in so many lines ends a chunk

_M = (1 << 64) - 1


def _mixed(x: int) -> int:
    x = (x ^ (x >> 33)) * 0xFF51AFD7ED558CCD & _M
    return x ^ (x >> 33)


def _line_hashes(lines: list[str]) -> list[int]:
    return [xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) for x in lines]


def chunks(lines: list[str], hashes: list[int] | None = None) -> list[tuple[int, int, bool]]:
    """(first line, line after the last, whether it counts) for each chunk of
    the lines: it counts if two or more of them have words."""
    hashes = _line_hashes(lines) if hashes is None else hashes
    out: list[tuple[int, int, bool]] = []
    begin = with_words = 0
    for i, line in enumerate(lines):
        if i - begin > 0 and i >= ROLL - 1:
            roll = 0
            for x in hashes[i - ROLL + 1:i + 1]:
                roll = (roll * 0x9E3779B97F4A7C15 + x) & _M
            if _mixed(roll) % DIVISOR == 0:
                out.append((begin, i, with_words >= 2))
                begin, with_words = i, 0
        with_words += line.strip(" \t\n\r\x0b\x0c") != ""
    out.append((begin, len(lines), with_words >= 2))
    return out


def _text_key(text: str | None) -> int:
    return xxhash.xxh3_64_intdigest((text or "").encode("utf-8", "surrogatepass")) - (1 << 63)


def _shortest(lines: list[str]) -> set[tuple[int, int]]:
    """(first line, line after the last) of the shortest runs of PARAGRAPH_WORDS
    words or more that begin or end with each line."""
    upto = [0, *accumulate(len(x.encode("utf-8", "surrogatepass").split()) for x in lines)]
    n, out = len(lines), set()
    z = 0
    for a in range(n):
        while z < n and upto[z] - upto[a] < PARAGRAPH_WORDS:
            z += 1
        if upto[z] - upto[a] < PARAGRAPH_WORDS:
            break
        out.add((a, z))
    a = n
    for z in range(n, 0, -1):
        while a > 0 and upto[z] - upto[a] < PARAGRAPH_WORDS:
            a -= 1
        if upto[z] - upto[a] < PARAGRAPH_WORDS:
            break
        out.add((a, z))
    return out


def stretches(lines: list[str], hashes: list[int] | None = None) -> Iterator[tuple[int, int, int, int]]:
    """(first line, line after the last, line that it may grow to, line that it
    may grow up to) for the chunks that count and the shortest runs without one
    strictly inside, which do not grow."""
    counted = [(a, z) for a, z, counts in chunks(lines, hashes) if counts]
    for k, (a, z) in enumerate(counted):
        yield a, z, counted[k - 1][0] if k else 0, counted[k + 1][1] if k + 1 < len(counted) else len(lines)
    begins = [a for a, _ in counted]
    for a, z in _shortest(lines):
        k = bisect_right(begins, a)
        if (k == len(counted) or counted[k][1] >= z) and (a, z) not in counted[max(0, k - 1):k]:
            yield a, z, a, z


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every stretch by the hash of its lines; ``left`` and ``right`` are the
    hashes of what it grows to, line by line."""
    digest = xxhash.xxh3_64_intdigest
    for b in pieces(batches, 4000):
        ids, texts, starts, ends, keys, left, right = [], [], [], [], [], [], []
        for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            if not t:
                continue
            lines = t.split("\n")
            hashes = _line_hashes(lines)
            raw, h = array("Q", hashes).tobytes(), None
            for a, z, lo, hi in stretches(lines, hashes):
                h = _text_key(t) if h is None else h
                ids.append(d)
                texts.append(h)
                starts.append(a)
                ends.append(z)
                keys.append(digest(raw[8 * a:8 * z]))
                left.append([digest(raw[8 * x:8 * z]) - (1 << 63) for x in range(a - 1, lo - 1, -1)])
                right.append([digest(raw[8 * a:8 * x]) - (1 << 63) for x in range(z + 1, hi + 1)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(texts, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()),
             pa.array([k - (1 << 63) for k in keys], pa.int64()), pa.array(left, pa.list_(pa.int64())), pa.array(right, pa.list_(pa.int64()))],
            names=["doc_id", "tkey", "a", "z", "key", "left", "right"])


_RUN = pa.struct([("a", pa.int32()), ("z", pa.int32()), ("lo", pa.int32()), ("f_id", pa.int64()), ("f_key", pa.int64()), ("f_a", pa.int32())])
_RUN_SQL = "struct<a:int,z:int,lo:int,f_id:bigint,f_key:bigint,f_a:int>"


def _joined(d: int | None, h: int, marks: list[dict]) -> list[dict]:
    """Repeated runs of one text that overlap or touch, and whose first places
    do so in the same way, as one.  ``lo``: the first line to remove; a run
    that overlaps its own first place loses only what goes beyond that."""
    out: list[dict] = []
    for m in sorted(marks, key=lambda m: (m["f_id"] is None, m["f_id"] or 0, m["f_key"], m["a"] - m["f_a"], m["a"], m["z"])):
        run = {**m, "lo": m["a"]}
        if (m["f_id"], m["f_key"]) == (d, h):
            run["lo"] = max(m["a"], m["f_a"] + m["z"] - m["a"])
        last = out[-1] if out else None
        if (last and run["lo"] == run["a"] and last["lo"] == last["a"] and run["a"] <= last["z"]
                and all(run[c] == last[c] for c in ("f_id", "f_key")) and run["a"] - run["f_a"] == last["a"] - last["f_a"]):
            last["z"] = max(last["z"], run["z"])
        else:
            out.append(run)
    return out


def _join_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches):
        runs = [_joined(*x) for x in zip(*(b.column(c).to_pylist() for c in ("m_id", "m_key", "marks")))]
        yield pa.RecordBatch.from_arrays([b.column("m_id"), b.column("m_key"), pa.array(runs, pa.list_(_RUN))], names=["m_id", "m_key", "runs"])


def _add_text_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, 4000):
        keys = pa.array([_text_key(t) for t in b.column("text").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), keys, b.column("r")], names=["doc_id", "text", "tkey", "r"])


def _show_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of each row's repeated runs, with their first places."""
    for b in pieces(batches):
        rows, texts = [], []
        for d, h, t, runs in zip(*(b.column(c).to_pylist() for c in ("doc_id", "tkey", "text", "runs"))):
            lines = t.split("\n")
            for x in runs:
                rows.append((d, h, x["a"], x["z"], x["f_id"], x["f_key"], x["f_a"], x["z"] - x["a"]))
                texts.append("\n".join(lines[x["a"]:x["z"]]))
        names = ["doc_id", "tkey", "a", "z", "f_id", "f_key", "f_a", "size"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        columns = zip(*rows) if rows else [()] * len(names)
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns, kinds), pa.array(texts, pa.string())], names=[*names, "passage"])


def _show_asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of the first places that runs are compared with."""
    for b in pieces(batches):
        ids, tkeys, starts, sizes, texts = [], [], [], [], []
        for d, h, t, asked in zip(*(b.column(c).to_pylist() for c in ("doc_id", "tkey", "text", "asked"))):
            lines = t.split("\n")
            for x in asked:
                ids.append(d)
                tkeys.append(h)
                starts.append(x["a"])
                sizes.append(x["size"])
                texts.append("\n".join(lines[x["a"]:x["a"] + x["size"]]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(tkeys, pa.int64()), pa.array(starts, pa.int32()), pa.array(sizes, pa.int32()), pa.array(texts, pa.string())],
            names=["g_id", "g_key", "g_a", "g_size", "first_passage"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines of ``runs``, but for the runs in ``unequal``."""
    for b in pieces(batches):
        texts, lines_out, chunks_out = [], [], []
        for t, runs, unequal in zip(*(b.column(c).to_pylist() for c in ("text", "runs", "unequal"))):
            stay = {tuple(x.values()) for x in unequal or ()}
            lines = t.split("\n")
            drop = bytearray(len(lines))
            for x in runs:
                if (x["a"], x["z"], x["f_id"], x["f_key"], x["f_a"]) not in stay:
                    drop[x["lo"]:x["z"]] = b"\1" * (x["z"] - x["lo"])
            n = sum(drop)
            texts.append("\n".join(x for x, gone in zip(lines, drop) if not gone))
            lines_out.append(n)
            chunks_out.append(sum(gone and not before for before, gone in zip(b"\0" + drop, drop)))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(texts, pa.string()), pa.array(lines_out, pa.int32()), pa.array(chunks_out, pa.int32()), b.column("r")],
            names=["doc_id", "text", "removed_lines", "removed_chunks", "r"])


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, text, removed_lines, removed_chunks, r`` for every row of
    ``docs``; ``r`` is a struct of the row's own columns but for the text.
    ``removed_chunks`` counts the stretches of lines that were removed.

    The first place of a run is the one with the smallest id (null last), then
    the smallest text hash, then the first in the text; it stays, but for lines
    of other runs that stand at still earlier places.  Rows equal in id and
    text are one place and keep or lose the same lines.  A text that loses all
    its lines becomes empty; a null text stays null and an empty one empty.  An
    empty table gives no rows.
    """
    ship(docs.sparkSession)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), own.alias("r"))
    r_type = rows.schema["r"].dataType.simpleString()
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "tkey", "a")
    found = materialise(rows.select("doc_id", "text").mapInArrow(
        _hash_runs, "doc_id long, tkey long, a int, z int, key long, left array<long>, right array<long>"), "line-runs")

    def repeated(df: DataFrame) -> DataFrame:
        at = F.xxhash64(F.col("doc_id").isNull(), "doc_id", "tkey", "a")
        several = df.groupBy("key", "n").agg(F.min(at).alias("least"), F.max(at).alias("most")).filter("least <> most")
        return df.join(several.select("key", "n"), ["key", "n"])

    seeds = materialise(repeated(found.withColumn("n", F.expr("z - a"))), "line-seeds")
    step = lambda a, z, h: F.struct(a.cast("int").alias("a"), z.cast("int").alias("z"), h.alias("key"))
    grown = (seeds.select("doc_id", "tkey", F.explode(F.concat(
                 F.transform("left", lambda h, i: step(F.col("a") - 1 - i, F.col("z"), h)),
                 F.transform("right", lambda h, i: step(F.col("a"), F.col("z") + 1 + i, h)))).alias("g"))
             .select("doc_id", "tkey", "g.a", "g.z", "g.key", F.expr("g.z - g.a").alias("n")))
    places = materialise(seeds.drop("left", "right").unionByName(repeated(grown)), "line-places")
    firsts = places.groupBy("key", "n").agg(F.min(place).alias("p"))
    marks = (places.join(firsts, ["key", "n"]).filter(place != F.col("p"))
             .select(F.col("doc_id").alias("m_id"), F.col("tkey").alias("m_key"),
                     F.struct("a", "z", F.col("p.doc_id").alias("f_id"), F.col("p.tkey").alias("f_key"), F.col("p.a").alias("f_a")).alias("mark"))
             .groupBy("m_id", "m_key").agg(F.collect_set("mark").alias("marks")))
    runs = materialise(marks.mapInArrow(_join_runs, f"m_id long, m_key long, runs array<{_RUN_SQL}>"), "line-repeats")
    asked = (runs.select(F.explode("runs").alias("x"))
             .groupBy(F.col("x.f_id").alias("m_id"), F.col("x.f_key").alias("m_key"))
             .agg(F.collect_set(F.struct(F.col("x.f_a").alias("a"), F.expr("x.z - x.a").alias("size"))).alias("asked")))
    wanted = (runs.select("m_id", "m_key", "runs", F.lit(None).cast(asked.schema["asked"].dataType).alias("asked"))
              .unionByName(asked.withColumn("runs", F.lit(None).cast(runs.schema["runs"].dataType)))
              .groupBy("m_id", "m_key").agg(F.first("runs", True).alias("runs"), F.first("asked", True).alias("asked")))
    keyed = rows.mapInArrow(_add_text_key, f"doc_id long, text string, tkey long, r {r_type}")
    marked = materialise(
        keyed.join(wanted, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("tkey") == F.col("m_key")), "left")
        .select("doc_id", "text", "tkey", "r", "runs", "asked"), "line-marked")

    # byte comparison of every repeated run with its first place
    touched = marked.filter("runs is not null")
    shown = touched.select("doc_id", "tkey", "text", "runs").mapInArrow(
        _show_runs, "doc_id long, tkey long, a int, z int, f_id long, f_key long, f_a int, size int, passage string")
    given = (marked.filter("asked is not null").select("doc_id", "tkey", "text", "asked")
             .mapInArrow(_show_asked, "g_id long, g_key long, g_a int, g_size int, first_passage string")
             .dropDuplicates(["g_id", "g_key", "g_a", "g_size"]))
    unequal = (shown.join(given, F.col("f_id").eqNullSafe(F.col("g_id")) & (F.col("f_key") == F.col("g_key"))
                          & (F.col("f_a") == F.col("g_a")) & (F.col("size") == F.col("g_size")), "left")
               .filter(~F.col("passage").eqNullSafe(F.col("first_passage")))
               .groupBy(F.col("doc_id").alias("u_id"), F.col("tkey").alias("u_key"))
               .agg(F.collect_set(F.struct("a", "z", "f_id", "f_key", "f_a")).alias("unequal")))
    unequal = materialise(unequal, "line-unequal")           # next to nothing, so the texts need not be shuffled again
    cut = (touched.join(unequal, F.col("doc_id").eqNullSafe(F.col("u_id")) & (F.col("tkey") == F.col("u_key")), "left")
           .select("doc_id", "text", "runs", "unequal", "r")
           .mapInArrow(_cut, f"doc_id long, text string, removed_lines int, removed_chunks int, r {r_type}"))
    rest = marked.filter("runs is null").select("doc_id", "text", F.lit(0).alias("removed_lines"), F.lit(0).alias("removed_chunks"), "r")
    return cut.unionAll(rest)


def deduped(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with their repeated passages removed and all their
    columns.  ``n_chars`` follows the text of changed rows.  A row that loses
    its last word has nothing left that is not elsewhere in the table, and
    leaves; all others stay."""
    out = dedup_lines(docs).filter((F.col("removed_lines") == 0) | F.col("text").rlike(WORD))
    changed = F.col("removed_lines") > 0

    def column(c: str):
        if c == "text":
            return F.col("text")
        own = F.col("r").getField(c)
        if c == "n_chars":
            own = F.when(changed, F.length("text").cast(docs.schema[c].dataType)).otherwise(own)
        return own.alias(c)

    return out.select(*[column(c) for c in docs.columns])
