"""Token counts that follow edits.

A document is cut into the tokenizer's pieces; a segment tree over runs of
pieces keeps the sums of characters and tokens.  An edit is found by walking
down the character sums; only the pieces it touches, and as many neighbours as
the pattern looks at, are cut and encoded again, until the new cuts fall on an
old border.  Then the sums above the changed runs are renewed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm import byte_bpe
from pluvio.llm.common import pieces, ship

RUN = 32                      # pieces in a leaf
AHEAD = 2                     # characters after its end that a match may look at


class TokenTree:
    """Pieces of one text with sums of characters and tokens.

    ``sums`` is a binary tree in an array (children of i at 2i and 2i + 1);
    its leaves are runs of pieces.  A piece is (characters, tokens).
    """

    def __init__(self, text: str, encoder: byte_bpe.Encoder):
        self.text, self.encoder = text, encoder
        self.encoded = 0
        self._build([self._piece(p) for p in encoder.split(text)])

    def _piece(self, piece: str) -> tuple[int, int]:
        self.encoded += 1
        e = self.encoder
        return len(piece), len(e.pieces.get(piece) or e.piece(piece)) // 4

    def _build(self, all_pieces: list[tuple[int, int]]) -> None:
        self.runs = [all_pieces[i : i + RUN] for i in range(0, len(all_pieces), RUN)] or [[]]
        self.width = 1
        while self.width < len(self.runs):
            self.width *= 2
        self.sums = [(0, 0)] * (2 * self.width)
        for i, run in enumerate(self.runs):
            self.sums[self.width + i] = (sum(c for c, _ in run), sum(t for _, t in run))
        for i in range(self.width - 1, 0, -1):
            self._renew(i)

    def _renew(self, i: int) -> None:
        (a, b), (c, d) = self.sums[2 * i], self.sums[2 * i + 1]
        self.sums[i] = (a + c, b + d)

    @property
    def tokens(self) -> int:
        return self.sums[1][1]

    @property
    def n_pieces(self) -> int:
        return sum(map(len, self.runs))

    def _find(self, at: int) -> tuple[int, int]:
        """(run, characters before it) of the run that holds character ``at``."""
        i, before = 1, 0
        while i < self.width:
            i *= 2
            if at >= before + self.sums[i][0] and self.sums[i + 1][0]:
                before += self.sums[i][0]
                i += 1
        return min(i - self.width, len(self.runs) - 1), before

    def replace(self, begin: int, end: int, new: str) -> int:
        """Put ``new`` in place of text[begin:end]; returns how many pieces were encoded."""
        done = self.encoded
        self.text = self.text[:begin] + new + self.text[end:]
        grown = len(new) - (end - begin)
        # the first piece whose match saw the edit
        run, at = self._find(max(0, begin - AHEAD))
        while run > 0 and at + AHEAD > begin:
            run -= 1
            at -= self.sums[self.width + run][0]
        k, pos = 0, at
        while k < len(self.runs[run]) and pos + self.runs[run][k][0] + AHEAD <= begin:
            pos += self.runs[run][k][0]
            k += 1
        # old borders from here on, in new positions; cut again until one is met
        old = pos
        r, j = run, k
        fresh: list[tuple[int, int]] = []
        for m in self.encoder.find(self.text, pos):
            while r < len(self.runs) and (old < end or old + grown < m.start()):
                if j < len(self.runs[r]):
                    old += self.runs[r][j][0]
                    j += 1
                else:
                    r, j = r + 1, 0
            if r < len(self.runs) and old >= end and old + grown == m.start():
                break
            fresh.append(self._piece(m.group()))
        else:
            r, j = len(self.runs) - 1, len(self.runs[-1])
        head = self.runs[run][:k] + fresh
        self.runs[run] = head + self.runs[r][j:]
        for i in range(run + 1, r + 1):
            self.runs[i] = []
        if len(self.runs[run]) > 4 * RUN:
            self._build([p for x in self.runs for p in x])
        else:
            for i in range(run, r + 1):
                x = self.runs[i]
                self.sums[self.width + i] = (sum(c for c, _ in x), sum(t for _, t in x))
            lo, hi = self.width + run, self.width + r
            while lo > 1:
                lo, hi = lo // 2, hi // 2
                for i in range(lo, hi + 1):
                    self._renew(i)
        return self.encoded - done


def count_tokens(docs: DataFrame, edits: DataFrame | None = None, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, n_pieces, n_edits, n_tokens_after, n_encoded_again, n_chars_after``
    for every row of ``docs``.

    ``edits`` has ``doc_id`` and ``edits``, an array of structs (``at``,
    ``len``, ``new``): from character ``at`` of the text as it then is,
    ``len`` characters are replaced, one edit after the other.  Positions
    beyond the text are cut to its end; null edits, or null fields, change
    nothing.  Null texts count as empty, with no tokens.  Rows that share an id
    get the same edits; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = "array<struct<at:int,len:int,new:string>>"
    if edits is None:
        rows = rows.withColumn("edits", F.lit(None).cast(kind))
    else:
        e = edits.select(F.col("doc_id").cast("long").alias("e_id"), F.col("edits").cast(kind).alias("edits"))
        rows = rows.join(e, F.col("doc_id") == F.col("e_id"), "left").drop("e_id")
    return edited_counts(rows, path)


def edited_counts(rows: DataFrame, path: str | None = None) -> DataFrame:
    """As ``count_tokens`` for rows that carry their edits: ``doc_id, text, edits``."""

    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe.encoder(path)
        for b in pieces(batches):
            out: list[tuple] = []
            for t, todo in zip(b.column("text").to_pylist(), b.column("edits").to_pylist()):
                tree = TokenTree(t or "", encoder)
                n, p, again, done = tree.tokens, tree.n_pieces, 0, 0
                for x in todo or ():
                    if x is not None and None not in x.values():
                        begin = min(max(0, x["at"]), len(tree.text))
                        again += tree.replace(begin, min(len(tree.text), begin + max(0, x["len"])), x["new"])
                        done += 1
                out.append((n, p, done, tree.tokens, again, len(tree.text)))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id")] + [pa.array([o[i] for o in out], pa.int64()) for i in range(6)],
                names=["doc_id", "n_tokens", "n_pieces", "n_edits", "n_tokens_after", "n_encoded_again", "n_chars_after"])

    return rows.select("doc_id", "text", "edits").mapInArrow(
        run, "doc_id long, n_tokens long, n_pieces long, n_edits long, n_tokens_after long, n_encoded_again long, n_chars_after long")
