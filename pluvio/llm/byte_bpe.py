"""Byte-level BPE by dynamic programming over prefixes.

In a vocabulary that merges have built, a sequence of tokens is the BPE
encoding of its bytes exactly when every two neighbours are, taken alone, the
encoding of theirs.  So each prefix of a
piece has one valid last token: the one that ends there and fits the last
token of the prefix before it.  ``Prefixes`` stores that token for each
prefix.  Appending bytes extends the table; an edit recomputes it from the
first changed byte until as many entries as the longest token has bytes agree
with the old table again.  Time is linear in the bytes, also for a piece
without any break.

Texts are first cut into pieces by the tokenizer's pattern; a piece is encoded
by itself.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from weakref import WeakValueDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from pluvio.llm.common import pieces, ship

#: The production vocabulary of the installed ``public_tokenizers`` package.
VOCABULARY = "byte_bpe_50k.tiktoken"
CACHE = 240_000               # pieces, and words, that a task remembers
PAIRS = 600_000               # pairs of tokens that a task remembers
STATES = 50_000               # states, and four times as many steps, that a task remembers
CACHED_BYTES = 64             # longer pieces are not remembered


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_encode(piece: bytes, ranks: dict[bytes, int], below: float = float("inf")) -> list[int]:
    """BPE as defined: join the neighbours of lowest rank, leftmost first,
    until none can be joined by a rank under ``below``.  Used to take single
    tokens apart."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(((ranks[j], i) for i in range(len(parts) - 1) if (j := parts[i] + parts[i + 1]) in ranks and ranks[j] < below), default=None)
        if best is None:
            break
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


class Vocabulary:
    """Ranks, token bytes, which tokens end at a byte, and which pairs of
    tokens may stand side by side."""

    START = -1                # stands for "no token before"

    def __init__(self, ranks: dict[bytes, int], like: Vocabulary | None = None):
        self.ranks = ranks
        self.token = like.token if like else {i: b for b, i in ranks.items()}
        self.longest = like.longest if like else max(map(len, ranks), default=0)
        self._heads: set[bytes] = like._heads if like else set()     # made when first asked for: decoding needs none
        # a state is the longest string that a token begins with and that ends
        # at the current byte; states and their steps are built when met
        self._state: dict[bytes, int] = {b"": 0}
        self._bytes: list[bytes] = [b""]
        # (length, token, what may stand before it) of the tokens that end here, longest first
        self.ends: list[tuple] = [()]
        self.steps: dict[int, int] = {}
        self._after: dict[int, dict[int, bool]] = {}
        self._known = 0
        self._halves: dict[int, tuple | None] = {}

    def renewed(self) -> Vocabulary:
        """Itself, or where it remembers too much the same ranks with nothing
        remembered.  Prefixes that were built with the old one go on with it."""
        full = len(self._bytes) > STATES or len(self.steps) > 4 * STATES
        return Vocabulary(self.ranks, self) if full else self

    def step(self, state: int, byte: int) -> int:
        """The state after one more byte."""
        if not self._heads:
            self._heads.update((b[:i] for b in self.ranks for i in range(len(b) + 1)), (b"",))
        s = self._bytes[state] + bytes((byte,))
        while s not in self._heads:
            s = s[1:]
        i = self._state.get(s)
        if i is None:
            i = self._state[s] = len(self._bytes)
            self._bytes.append(s)
            self.ends.append(tuple(
                (len(s) - k, t, self._after.setdefault(t, {})) for k in range(len(s)) if (t := self.ranks.get(s[k:])) is not None))
        self.steps[state << 8 | byte] = i
        return i

    def halves(self, t: int) -> tuple | None:
        """The two tokens whose merge makes t; None if merges do not make it."""
        if t not in self._halves:
            got = merge_encode(self.token[t], self.ranks, t)
            self._halves[t] = tuple(got) if len(got) == 2 else None
        return self._halves[t]

    def _fits(self, a: int, b: int) -> bool:
        """Whether the bytes of a and b together encode as a, b.  Follows the
        merges backwards: x ends and y begins at the border, and ``until`` is
        the rank of the merge that made one of them disappear; a merge of x
        and y of lower rank would have come first."""
        token = self.token
        if any(len(token[t]) > 1 and self.halves(t) is None for t in (a, b) if t != self.START):
            return False
        if a == self.START:
            return True
        x, y, until = a, b, float("inf")
        while True:
            joined = self.ranks.get(token[x] + token[y])
            if joined is not None and joined < until:
                return False
            x_made, y_made = (t if len(token[t]) > 1 else -1 for t in (x, y))
            if x_made < 0 and y_made < 0:
                return True
            if x_made > y_made:
                until, x = x_made, self.halves(x)[1]
            else:                                # of equal ranks the one on the left merges first
                until, y = y_made + 1, self.halves(y)[0]

    def fits(self, a: int, b: int) -> bool:
        """As ``_fits``, remembered."""
        self._known += 1
        if self._known > PAIRS:
            self._known = 0
            for d in self._after.values():
                d.clear()
        ok = self._after.setdefault(b, {})[a] = self._fits(a, b)
        return ok

    def last_tokens(self, data: bytes, last: list[int], states: list[int], begin: int, end: int) -> None:
        """Extend ``last`` and ``states`` by the prefixes that end in data[begin:end]."""
        steps, ends, fits = self.steps, self.ends, self.fits
        e, state = begin, states[begin]
        for byte in data[begin:end]:
            e += 1
            k = state << 8 | byte
            state = steps[k] if k in steps else self.step(state, byte)
            for length, t, after in ends[state]:
                a = last[e - length]
                ok = after.get(a)
                if ok or ok is None and fits(a, t):
                    last.append(t)
                    break
            else:
                raise ValueError("a byte has no token")
            states.append(state)

    def read_back(self, last: list[int]) -> list[int]:
        """The tokens of the whole string, from the last one backwards."""
        out, end, token = [], len(last) - 1, self.token
        while end:
            t = last[end]
            out.append(t)
            end -= len(token[t])
        out.reverse()
        return out


class Prefixes:
    """The last token of every prefix of a byte string; ``last[i]`` belongs to
    the first i bytes, ``last[0]`` to none."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.v, self.data, self.last, self.states = vocabulary, b"", [Vocabulary.START], [0]
        self.append(data)

    def _extend(self, begin: int, end: int) -> None:
        self.v.last_tokens(self.data, self.last, self.states, begin, end)

    def append(self, more: bytes) -> None:
        at = len(self.data)
        self.data += more
        self._extend(at, len(self.data))

    def replace(self, begin: int, end: int, new: bytes) -> int:
        """Put ``new`` in place of data[begin:end]; returns how many entries
        were computed again."""
        old, old_states = self.last[end + 1:], self.states[end + 1:]
        self.data = self.data[:begin] + new + self.data[end:]
        del self.last[begin + 1:], self.states[begin + 1:]
        at = border = begin + len(new)
        self._extend(begin, border)
        agree = 0
        while at < len(self.data) and agree < self.v.longest:
            self._extend(at, at + 1)
            k = at - border
            agree = agree + 1 if self.last[-1] == old[k] and self.states[-1] == old_states[k] else 0
            at += 1
        # all that later entries look at is as before
        self.last.extend(old[at - border:])
        self.states.extend(old_states[at - border:])
        return at - begin

    def tokens(self) -> list[int]:
        return self.v.read_back(self.last)


class Recent(dict):
    """A dict of bounded size: what was not asked for lately goes first."""

    def __init__(self, size: int):
        super().__init__()
        self.half, self.old = size // 2, {}

    def keep(self, key, value):
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

    def again(self, key):
        """A value that left the young half; None if it is gone."""
        value = self.old.get(key)
        return None if value is None else self.keep(key, value)


#: A space between two characters that no one counts as white space: every
#: match of the patterns below ends before it or begins with it.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_ODD = re.compile(r"\s\s|^ | $")


class Encoder:
    """Encodes whole texts; decodes ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cut_at_spaces: bool):
        self.v = Vocabulary(ranks)
        self.split, self.cut_at_spaces = regex.compile(pattern).findall, cut_at_spaces
        self.find = regex.compile(pattern).finditer           # (text, first character)
        self.pieces, self.words = Recent(CACHE), Recent(CACHE)
        n = max(self.v.token, default=-1) + 1
        self._sizes = np.zeros(n, np.int64)
        for t, b in self.v.token.items():
            self._sizes[t] = len(b)
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._table = np.frombuffer(b"".join(self.v.token.get(t, b"") for t in range(n)), np.uint8)

    def piece(self, piece: str) -> bytes:
        """Token ids of one piece as packed 32-bit integers."""
        out = self.pieces.again(piece)
        if out is not None:
            return out
        raw = piece.encode("utf-8", "surrogatepass")
        one = self.v.ranks.get(raw)
        if one is not None:
            out = array("i", (one,)).tobytes()
        else:
            self.v = self.v.renewed()
            last = [Vocabulary.START]
            self.v.last_tokens(raw, last, [0], 0, len(raw))
            out = array("i", self.v.read_back(last)).tobytes()
        return self.pieces.keep(piece, out) if len(raw) <= CACHED_BYTES else out

    def _spaced(self, word: str) -> bytes:
        """Token ids of a space and the word after it."""
        out = self.words.again(word)
        if out is None:
            out = self._all(" " + word)
            if len(word) <= CACHED_BYTES:
                self.words.keep(word, out)
        return out

    def _all(self, text: str) -> bytes:
        get, slow = self.pieces.get, self.piece
        return b"".join([get(p) or slow(p) for p in self.split(text)])

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, "<i4")
        if not self.cut_at_spaces:
            return np.frombuffer(self._all(text), "<i4")
        words = iter(_CUT.split(text) if _ODD.search(text) else text.split(" "))
        get, slow = self.words.get, self._spaced
        return np.frombuffer(self._all(next(words)) + b"".join([get(w) or slow(w) for w in words]), "<i4")

    def decode_flat(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, and where each id's bytes end."""
        sizes = self._sizes[ids]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self._starts[ids] - (ends - sizes), sizes)
        return self._table[at], ends

    def decode(self, ids) -> bytes:
        return self.decode_flat(np.asarray(ids, np.int64))[0].tobytes()


#: Encoders in use: one goes with the last task that uses it, so a worker that
#: Spark keeps for later stages holds none.
_here: WeakValueDictionary[tuple, Encoder] = WeakValueDictionary()


def encoder(path: str | None = None, pattern: str | None = None) -> Encoder:
    """The worker's encoder for a rank file on this machine."""
    import public_tokenizers

    key = (path or vocabulary_path(), pattern or public_tokenizers.PATTERN)
    e = _here.get(key)
    if e is None:
        e = _here[key] = Encoder(read_ranks(key[0]), key[1], key[1] == public_tokenizers.PATTERN)
    return e


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id, ids`` (array of int) for every row of ``docs``.

    ``path`` names a rank file that every executor has (default: that of the
    installed vocabulary package), ``pattern`` what cuts texts into pieces.
    Null and empty texts have no ids.  Every row, repeated ones too, gives one
    row; an empty table gives none.  Texts are read whole.
    """

    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        for b in pieces(batches, 1000, 4 << 20):
            ids = [e.encode(t) for t in b.column("text").to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = pa.array(np.concatenate(ids) if ids else np.empty(0, "<i4"), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), flat)], names=["doc_id", "ids"])

    return docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``encoded`` (``doc_id, ids``) with the bytes its ids stand for as ``decoded``.  Null ids stand for no bytes."""

    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        for b in pieces(batches, 1000, 8 << 20):
            ids = b.column("ids")
            flat, ends = e.decode_flat(ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            bounds = np.concatenate([[0], ends])
            counts = np.asarray(pc.fill_null(pc.list_value_length(ids), 0))
            raw = flat.tobytes()
            rows = bounds[np.concatenate([[0], np.cumsum(counts)])]
            out = pa.array([raw[i:j] for i, j in zip(rows[:-1].tolist(), rows[1:].tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), ids, out], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
