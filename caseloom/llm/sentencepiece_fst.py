"""SentencePiece encoding and decoding with weighted finite-state transducers.

The model file is compiled to transducers, each a table of arcs from a state and an input symbol to (output, weight, next state):

* R, the model's rewriting rules, leftmost-longest; the identity if the model has none;
* W, white space: three states (text's begin, in a word, spaces pending) that drop, join and escape spaces and set one before the text;
* L, the lexicon: the pieces as a trie, a piece's last arc gives its id and leads back to the root;
* B, byte fallback: an arc back to the root for each character outside the pieces, giving its bytes' ids (or the unknown one's);
* G, the grammar. In a unigram model it has one state, and a piece weighs minus its score. In a BPE model scores order merges and don't add
  up, so a state for each piece: its arc to another piece weighs 0 if merging leaves the two apart, else infinity (there is none).

An input is composed with R, W, L or B, and G, lazily, and its encoding is the output of the shortest path in the tropical semiring. States of
the composition are (position, last piece); a BPE input has one path of finite weight for each of its prefixes, so one of them is live at each position,
and arcs into it are read backwards, from L reversed. The ids are those of the SentencePiece library; tests hold them against it.

Where no piece can reach across (before a run of spaces; around a character outside the pieces' alphabet, a newline, say; looked up in
the pieces: after a Latin letter or digit before another kind of character), every path passes through one state of L, so the segments between such points
are composed apart. Their paths are remembered by W's state and the segment, twice CACHE of them in a worker at most.

Null texts are encoded as empty ones: no ids. Very long texts are encoded whole; time is linear in length. Repeated rows get equal ids, empty tables give no
rows. A column named as the one that a function adds (`token_ids`, `decoded`, `token_digest`) is replaced.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.common import table

#: The public model's place; a parameter of every function here.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Segments whose shortest path is remembered, and the longest of them; pairs of pieces whose weight in G is.
CACHE, CACHED_CHARS, PAIRS = 120_000, 32, 120_000
#: Latin letters and digits, as a class of a regular expression.
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ0-9"

#: Fixed values of the model file: kinds of pieces, and of models.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, data[at : at + n]
            at += n


class _Remembered(dict):
    """Values of `solve` by key: those used lately (`most` of them), and those used before."""

    def __init__(self, solve, most: int) -> None:
        self.solve, self.most, self.before = solve, most, {}

    def __missing__(self, key):
        made = self.before.get(key)
        if made is None:
            made = self.solve(key)
        if not isinstance(key, str) or len(key) <= CACHED_CHARS:
            if len(self) >= self.most:
                self.before = dict(self)
                self.clear()
            self[key] = made
        return made


class Rules:
    """R: the model's precompiled rules, a double-array trie of UTF-8 keys (in the public format of that structure) and their replacements."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units, self.to = np.frombuffer(blob[4 : 4 + size], "<u4").tolist(), blob[4 + size :]

    def _longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """End and replacement of the longest key that starts at `at`."""
        units, found = self.units, None
        step = lambda u: (u >> 10) << ((u & 512) >> 6)
        node = step(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units) or units[node] & 0x800000FF != data[i]:
                break
            leaf = units[node] >> 8 & 1
            node ^= step(units[node])
            if leaf:
                start = units[node] & 0x7FFFFFFF
                found = i + 1, self.to[start : self.to.index(0, start)]
        return found

    def apply(self, text: str) -> str:
        if not self.units:
            return text
        data, out, at = text.encode("utf-8", "replace"), [], 0
        while at < len(data):
            end, made = self._longest(data, at) or (0, b"")
            if not end:
                end = at + (1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4)
                made = data[at:end]
            out.append(made)
            at = end
        return b"".join(out).decode()


#: W's states.
BEGIN, WORD, GAP = 0, 1, 2


def spaces(prefix: bool, squeeze: bool) -> list[tuple[tuple[str, int], tuple[str, int]]]:
    """W: for each state the arc of a space and that of any other character: (what it gives before the character itself, next state)."""
    first = SPACE if prefix else ""
    if squeeze:
        return [(("", BEGIN), (first, WORD)), (("", GAP), ("", WORD)), (("", GAP), (SPACE, WORD))]
    return [((first + SPACE, WORD), (first, WORD)), ((SPACE, WORD), ("", WORD)), ((SPACE, WORD), (SPACE, WORD))]


class Transducer:
    def __init__(self, model: bytes) -> None:
        self.pieces: list[tuple[str, float, int]] = []
        self.kind, self.bytes_too, self.prefix, self.squeeze, rules = UNIGRAM, False, True, True, b""
        for n, v in _fields(model):
            if n == 1:
                f = dict(_fields(v))
                self.pieces.append((f.get(1, b"").decode(), struct.unpack("<f", f[2])[0] if 2 in f else 0.0, f.get(3, NORMAL)))
            elif n == 2:
                f = dict(_fields(v))
                self.kind, self.bytes_too = f.get(3, UNIGRAM), bool(f.get(35, 0))
            elif n == 3:
                f = dict(_fields(v))
                rules, self.prefix, self.squeeze = f.get(2, b""), bool(f.get(3, 1)), bool(f.get(4, 1))
        if self.kind not in (UNIGRAM, BPE) or any(k == USER for _, _, k in self.pieces):
            raise ValueError("only unigram and BPE models without user-defined symbols are compiled")
        self.ids = {p: i for i, (p, _, k) in enumerate(self.pieces) if k == NORMAL}
        self.score = [s for _, s, _ in self.pieces]
        self.alphabet = set("".join(self.ids))
        self.rules, self.spaces = Rules(rules), spaces(self.prefix, self.squeeze)
        #: L, or L reversed, as the kind's search reads it.
        self.lexicon = self._compiled((lambda p: p[::-1]) if self.kind == BPE else (lambda p: p))
        # An unknown character weighs 10 more than the dearest piece (a fixed value of the library).
        self.other = 10.0 - min((s for _, s, k in self.pieces if k == NORMAL), default=0.0)
        self.unk = next((i for i, (_, _, k) in enumerate(self.pieces) if k == UNKNOWN), 0)
        self.byte = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(self.pieces) if k == BYTE}
        self.cut = re.compile(self._boundaries()).findall
        self.merges = _Remembered(self._merges, len(self.pieces))
        self.apart = _Remembered(self._apart, PAIRS)
        solve = self._bpe if self.kind == BPE else self._unigram
        #: By W's state: a segment's ids (4-byte integers) and the state behind it.
        self.solved = [_Remembered(lambda seg, q=q: self._solved(seg, q, solve), CACHE) for q in (BEGIN, WORD, GAP)]
        #: The inverse transducer's output by id.
        self.said = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN else p.replace(SPACE, " ").encode() for p, _, k in self.pieces]

    def _compiled(self, turned) -> dict:
        """A trie of the pieces: a state is the dict of its arcs by character; the arc "" gives the piece's id and leads to the root."""
        root: dict = {}
        for p, i in self.ids.items():
            state = root
            for c in turned(p):
                state = state.setdefault(c, {})
            state[""] = i
        return root

    def _boundaries(self) -> str:
        """A pattern of segments of the text behind R, between which no piece can reach."""
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            return r"(?s).+"
        gap = f" {SPACE}"
        apart = "".join(c for c in "\n\t\r" if c not in self.alphabet)
        other = f"[^{gap}{apart}]+"
        if not any(re.search(f"[{LATIN}][^{LATIN}]", p) for p in self.ids):
            mark = f"[^{gap}{apart}{LATIN}]"
            other = f"{mark}*[{LATIN}]+|[{gap}]*{mark}+"
        return f"[{gap}]*{other}|[{gap}]+" + f"|[{apart}]" * bool(apart)

    def normalise(self, text: str) -> str:
        """The output of R and W."""
        return self._spaced(self._rewritten(text), BEGIN)[0]

    def _rewritten(self, text: str) -> str:
        """R's output; where spaces are joined those at the end have no use, nor (as in the library) their escaped forms."""
        text = self.rules.apply(text)
        return text.rstrip(f" {SPACE}") if self.squeeze else text

    def _spaced(self, segment: str, state: int) -> tuple[str, int]:
        """W's output for the segment from a state, and the state behind it."""
        out = []
        for c in segment:
            before, state = self.spaces[state][c != " "]
            out.append(before if c == " " else before + c)
        return "".join(out), state

    def _solved(self, segment: str, state: int, solve) -> tuple[bytes, int]:
        s, state = self._spaced(segment, state)
        return solve(s), state

    def _fallback(self, c: str) -> list[int]:
        """B's output."""
        return [self.byte[b] for b in c.encode("utf-8", "surrogatepass")] if self.bytes_too else [self.unk]

    def _merges(self, piece: int) -> list[tuple[float, str, str]]:
        """What merging does inside a piece's characters, in order: the score, then the parts at the left and the right edge."""
        parts = list(self.pieces[piece][0])
        out = [(np.inf, parts[0], parts[-1])]
        while len(parts) > 1:
            made = [(self.score[i], -k) for k in range(len(parts) - 1) if (i := self.ids.get(parts[k] + parts[k + 1])) is not None]
            if not made:
                break
            score, k = max(made)
            parts[-k : 2 - k] = [parts[-k] + parts[1 - k]]
            out.append((score, parts[0], parts[-1]))
        return out

    def _apart(self, pair: int) -> bool:
        """Whether G has the arc from piece to piece (pair: the first one's id times the number of pieces, plus the second one's): no merge across their border comes before those inside them that prevent it.

        Both sides' merges go on by score, the left one's first among equals; across is tried as the parts at the border stand.
        """
        first, second = divmod(pair, len(self.pieces))
        left, right = self.merges[first], self.merges[second]
        if left[-1][1] != self.pieces[first][0] or right[-1][1] != self.pieces[second][0]:
            return False  # merging never makes such a piece
        i = j = 0
        while True:
            across = self.ids.get(left[i][2] + right[j][1])
            a = left[i + 1][0] if i + 1 < len(left) else -np.inf
            b = right[j + 1][0] if j + 1 < len(right) else -np.inf
            if across is not None and self.score[across] > a and self.score[across] >= b:
                return False
            if a == b == -np.inf:
                return True
            if a >= b:
                i += 1
            else:
                j += 1

    def _bpe(self, s: str) -> bytes:
        arcs, apart, merges, pieces, width = self.lexicon, self.apart, self.merges, self.pieces, len(self.pieces)
        n = len(s)
        #: The live state at each position: the last piece (-1: none that could merge), and where it starts.
        last, start = [-1] * (n + 1), [0] * (n + 1)
        for j in range(1, n + 1):
            state, i, found = arcs, j, []
            while i:
                state = state.get(s[i - 1])
                if state is None:
                    break
                i -= 1
                if "" in state:
                    found.append((i, state[""]))
            start[j] = j - 1
            while found:  # the longest first; all but one weigh infinity
                i, piece = found.pop()
                if apart[last[i] * width + piece] if last[i] >= 0 else merges[piece][-1][1] == pieces[piece][0]:
                    last[j], start[j] = piece, i
                    break
        return self._output(s, last, start)

    def _unigram(self, s: str) -> bytes:
        n = len(s)
        cost, last, start = [0.0] + [np.inf] * n, [-1] * (n + 1), [0] * (n + 1)
        for i in range(n):
            if s[i] not in self.ids and cost[i] + self.other < cost[i + 1]:
                cost[i + 1], last[i + 1], start[i + 1] = cost[i] + self.other, -1, i
            state = self.lexicon
            for j in range(i, n):
                state = state.get(s[j])
                if state is None:
                    break
                if "" in state and cost[i] - self.score[state[""]] < cost[j + 1]:
                    cost[j + 1], last[j + 1], start[j + 1] = cost[i] - self.score[state[""]], state[""], i
        return self._output(s, last, start)

    def _output(self, s: str, last: list[int], start: list[int]) -> bytes:
        """The output of the path that ends at the last position."""
        out: list[int] = []
        j = len(s)
        while j:
            out += [last[j]] if last[j] >= 0 else self._fallback(s[start[j] : j])[::-1]
            j = start[j]
        return struct.pack(f"<{len(out)}i", *reversed(out))

    def encode(self, text: str | None) -> bytes:
        """The ids as 4-byte little-endian integers."""
        out, state = [], BEGIN
        for segment in self.cut(self._rewritten(text or "")):
            made, state = self.solved[state][segment]
            out.append(made)
        if not self.bytes_too:  # neighbouring unknown characters are one unknown piece
            ids = np.frombuffer(b"".join(out), "<i4")
            return ids[np.append(True, (ids[1:] != self.unk) | (ids[:-1] != self.unk))[: len(ids)]].tobytes()
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.said.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


@lru_cache(maxsize=4)
def transducer(model: bytes) -> Transducer:
    return Transducer(model)


def load(spark: SparkSession, path: str = MODEL) -> bytes:
    """The model's bytes, read by the driver: executors need not see the file."""
    with open(path, "rb") as f:
        return f.read()


def encoded(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """docs with `token_ids`, the ids of each whole text."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        t = transducer(shipped.value)
        made = [t.encode(x.as_py()) for x in texts]
        offsets = np.concatenate([[0], np.cumsum([len(m) // 4 for m in made])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(made), "<i4")))

    return docs.withColumn("token_ids", encode(F.col(text)))


def decoded(rows: DataFrame, model: bytes, ids: str = "token_ids") -> DataFrame:
    """rows with `decoded`, the text of the ids (null for null)."""
    shipped = rows.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def decode(column: pa.Array) -> pa.Array:
        t = transducer(shipped.value)
        return pa.array([None if x.as_py() is None else t.decode(x.as_py()) for x in column], pa.string())

    return rows.withColumn("decoded", decode(F.col(ids)))


def digested(docs: DataFrame, model: bytes) -> DataFrame:
    """docs' rows encoded and decoded again, and what a reader needs to compare them: token_digest, a struct."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("n_tokens int, n_byte_tokens int, ids_sha256 string, round_trip boolean")
    def digest(texts: pa.Array) -> pa.Array:
        t = transducer(shipped.value)
        low, high = min(t.byte.values(), default=0), max(t.byte.values(), default=-1)
        n, fallback, sha, same = [], [], [], []
        for x in texts:
            text = x.as_py() or ""
            made = t.encode(text)
            ids = np.frombuffer(made, "<i4")
            n.append(len(ids))
            fallback.append(int(((ids >= low) & (ids <= high)).sum()))
            sha.append(hashlib.sha256(made).hexdigest())
            same.append(t.decode(ids.tolist()) == text.replace(SPACE, " "))
        return pa.StructArray.from_arrays([pa.array(n, pa.int32()), pa.array(fallback, pa.int32()), pa.array(sha, pa.string()), pa.array(same, pa.bool_())], names=["n_tokens", "n_byte_tokens", "ids_sha256", "round_trip"])

    return docs.withColumn("token_digest", digest(F.col("text")))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = digested(table(spark, sf_dir, "documents").select("doc_id", "text"), load(spark))
    return found.select("doc_id", "token_digest.*")
