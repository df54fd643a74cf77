"""Byte-level BPE by prefix dynamic programming.

For a piece of bytes, `last[i]` is the one token that ends the encoding of its first i bytes: a token t with the bytes
piece[i - len(t):i] such that t may follow last[i - len(t)]. Whether one token may follow another depends on the merges at their
border alone, and is kept. Since each prefix has its table entry, appended bytes cost only their own entries, and an
edit costs the entries from its place to the piece's end; pieces before and after stay as they are.

Defined results: a null or empty text has no tokens; repeated rows repeat; bytes that the decoder gets need not be valid UTF-8;
only the id and text columns are read. A vocabulary that lacks a byte, or has a token of more than 255 bytes, raises.
"""

from __future__ import annotations

import base64

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasegrid.llm.shared import slices

#: Pieces that a worker remembers; beyond, it starts anew. A bound on memory, not on results.
KEPT = 400_000
#: Pairs of tokens whose border a worker remembers.
PAIRS = 1_500_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def runs(table: np.ndarray, start: np.ndarray, width: np.ndarray) -> np.ndarray:
    """table[start:start + width] of every pair, one after the other."""
    return table[np.repeat(start - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))]


class PrefixCoder:
    """Encodes and decodes by the ranks of a vocabulary; `pattern` splits texts into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern)
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.widest = max(map(len, ranks))
        self._follows: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}
        self._parts: dict[int, tuple[int, int]] = {}
        self._pieces: dict[str, tuple[int, ...]] = {}
        self._bytes = None
        if self.widest > 255:
            raise ValueError("tokens of over 255 bytes are not supported")
        #: Finds the tokens that end at each byte; tokens that merging never makes stay out.
        self.ends = ahocorasick.Automaton()
        for raw, token in ranks.items():
            if self._reached(token):
                self.ends.add_word(raw.decode("latin-1"), token << 8 | len(raw))
        self.ends.make_automaton()

    def _merged(self, piece: bytes, stop: int = 1) -> list[int]:
        """Plain merging, lowest rank first, leftmost of equals, down to `stop` parts; only used on the bytes of one token."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > stop:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _reached(self, token: int) -> bool:
        """Whether merging a token's own bytes gives that token."""
        if (known := self._whole.get(token)) is None:
            known = self._whole[token] = self._merged(self.bytes_of[token]) == [token]
        return known

    def _halves(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge makes this one; a single byte, or what no merge makes, has itself on both sides."""
        if (known := self._parts.get(token)) is None:
            raw, known = self.bytes_of[token], (token, token)
            if len(raw) > 1 and self._reached(token):
                table = self._merged(raw, stop=2)
                known = (table[0], table[1])
            self._parts[token] = known
        return known

    def _may_follow(self, a: int, b: int) -> bool:
        """Whether merging leaves the border between a and b alone.

        Goes back in time: of the two tokens at the border the one made later is taken apart, and each time the pair at the
        border must not have a merge that comes before that one. Of equal ranks the merge further left comes first.
        """
        ranks, bytes_of = self.ranks, self.bytes_of
        before = 1 << 60
        while True:
            joined = ranks.get(bytes_of[a] + bytes_of[b])
            if joined is not None and joined < before:
                return False
            left, right = self._halves(a)[1], self._halves(b)[0]
            if left == a and right == b:
                return True
            if right == b or (left != a and a > b):
                before, a = a, left
            else:
                before, b = b + 1, right

    def extend(self, piece: bytes, last: list[int]) -> list[int]:
        """Fills the table for the prefixes of piece that it lacks; last[0] stands for the empty prefix."""
        have, n, follows = len(last), len(piece), self._follows
        last += [-1] * (n + 1 - have)
        # Tokens that end at a place come together, place by place. One that starts before `begin` can't be a vocabulary's token.
        begin = max(0, have - self.widest)
        for end, value in self.ends.iter(piece[begin:].decode("latin-1")):
            i = begin + end + 1
            if last[i] >= 0 or i < have:
                continue
            token = value >> 8
            if j := i - (value & 255):
                key = last[j] << 32 | token
                fits = follows.get(key)
                if fits is None:
                    if len(follows) > PAIRS:
                        follows.clear()
                    fits = follows[key] = self._may_follow(last[j], token)
                if fits:
                    last[i] = token
            else:
                last[i] = token
        if -1 in last[1:]:
            raise ValueError("the vocabulary lacks a byte")
        return last

    def prefixes(self, piece: bytes) -> list[int]:
        return self.extend(piece, [-1])

    def walk_back(self, last: list[int], end: int | None = None) -> list[int]:
        """The tokens of the prefix of length `end`, from its table."""
        out, i = [], len(last) - 1 if end is None else end
        while i:
            out.append(last[i])
            i -= len(self.bytes_of[last[i]])
        return out[::-1]

    def piece_ids(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(raw)
        return (whole,) if whole is not None else tuple(self.walk_back(self.prefixes(raw)))

    def encode(self, text: str | None) -> list[int]:
        return [i for piece in self.split.findall(text or "") for i in self.piece_ids(piece)]

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Many texts at once: each distinct piece is looked up once."""
        known, split = self._pieces, self.split.findall
        flat, ends = [], [0]
        for text in texts:
            flat += split(text or "")
            ends.append(len(flat))
        coded = pa.array(flat, pa.large_string()).dictionary_encode()
        del flat
        each = []
        for piece in coded.dictionary.to_pylist():
            if (ids := known.get(piece)) is None:
                ids = self.piece_ids(piece)
                if len(piece) < 64:
                    if len(known) >= KEPT:
                        known.clear()
                    known[piece] = ids
            each.append(ids)
        width = np.fromiter(map(len, each), dtype=np.int64, count=len(each))
        table = np.fromiter((i for ids in each for i in ids), dtype="<u4", count=int(width.sum()))
        code = coded.indices.to_numpy()
        ids = runs(table, (np.cumsum(width) - width)[code], width[code])
        upto = np.concatenate([[0], np.cumsum(width[code])])[ends]
        return [ids[a:b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]

    def decode_all(self, ids: list[np.ndarray]) -> list[bytes]:
        if self._bytes is None:
            size = max(self.bytes_of) + 1
            width = np.array([len(self.bytes_of.get(i, b"")) for i in range(size)], dtype=np.int64)
            self._bytes = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(size)), np.uint8), np.cumsum(width) - width, width
        table, start, width = self._bytes
        flat = np.concatenate([*ids, np.zeros(0, "<u4")])
        raw = runs(table, start[flat], width[flat]).tobytes()
        upto = np.concatenate([[0], np.cumsum(width[flat])])[np.cumsum([0, *map(len, ids)])].tolist()
        return [raw[a:b] for a, b in zip(upto[:-1], upto[1:], strict=True)]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def open(self, text: str = "") -> "OpenText":
        return OpenText(self, text)


class OpenText:
    """A text under edit: its pieces with their prefix tables. Only pieces that an edit touches are encoded again."""

    def __init__(self, coder: PrefixCoder, text: str = ""):
        self.coder, self.pieces = coder, []
        self._put(0, 0, text)

    @property
    def text(self) -> str:
        return "".join(p for p, _ in self.pieces)

    def ids(self) -> list[int]:
        out = []
        for piece, last in self.pieces:
            whole = self.coder.ranks.get(piece.encode())
            out += [whole] if whole is not None else self.coder.walk_back(last)
        return out

    def append(self, more: str) -> None:
        self.edit(len(self.text), 0, more)

    def edit(self, at: int, cut: int, put: str) -> None:
        """Replace `cut` characters at `at` by `put`."""
        if at < 0 or cut < 0 or at + cut > len(self.text):
            raise ValueError("the edit lies outside the text")
        self._put(at, cut, put)

    def _put(self, at: int, cut: int, put: str) -> None:
        starts, pos = [], 0
        for piece, _ in self.pieces:
            starts.append(pos)
            pos += len(piece)
        # A piece looks at most one character past its end, and white space may give one character to the next piece.
        first = max(0, sum(s + len(p) < at for s, (p, _) in zip(starts, self.pieces, strict=True)) - 1)
        begin = starts[first] if first < len(starts) else pos
        old = {s - begin: entry for s, entry in zip(starts[first:], self.pieces[first:], strict=True)}
        text = "".join(p for p, _ in self.pieces[first:])
        text = text[: at - begin] + put + text[at - begin + cut :]
        moved, after, made, resume = len(put) - cut, at - begin + len(put), [], None
        for m in self.coder.split.finditer(text):
            # Past the edit, once a piece begins where an old one began, all that follow are as they were.
            if m.start() > after and (back := old.get(m.start() - moved)) is not None:
                resume = next(k for k in range(first, len(starts)) if starts[k] - begin == m.start() - moved)
                break
            piece = m.group()
            table, raw = [-1], piece.encode()
            if (back := old.get(m.start())) is not None:
                was = back[0].encode()
                same = len(bytes(a for a, b in zip(raw, was, strict=False) if a == b)) if raw[: len(was)] == was else next((k for k, (a, b) in enumerate(zip(raw, was, strict=False)) if a != b), min(len(raw), len(was)))
                table = back[1][: same + 1]
            made.append((piece, self.coder.extend(raw, table)))
        self.pieces[first:] = made + (self.pieces[resume:] if resume is not None else [])


_coders: dict[tuple[str, str], PrefixCoder] = {}


def coder_at(path: str, pattern: str) -> PrefixCoder:
    """One coder a worker process and vocabulary."""
    if (path, pattern) not in _coders:
        _coders[path, pattern] = PrefixCoder(read_ranks(path), pattern)
    return _coders[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids, n_tokens) for each row; ids are the token ids as little-endian unsigned 32-bit integers."""

    def run(batches):
        coder = coder_at(path, pattern)
        for batch in batches:
            for part in slices(batch, 1):
                ids = coder.encode_all(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int64())], names=[id_col, "ids", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string").alias(text_col)).mapInArrow(run, f"`{id_col}` {kind}, ids binary, n_tokens long")


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """(id_col, bytes) from the ids column of encode()."""

    def run(batches):
        coder = coder_at(path, pattern)
        for batch in batches:
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                texts = coder.decode_all([np.frombuffer(raw or b"", "<u4") for raw in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.binary())], names=[id_col, "bytes"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind}, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids, bytes): encoded, then decoded from the ids, in one pass over the texts."""

    def run(batches):
        coder = coder_at(path, pattern)
        for batch in batches:
            for part in slices(batch, 1):
                ids = coder.encode_all(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(coder.decode_all(ids), pa.binary())], names=[id_col, "n_tokens", "ids", "bytes"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string").alias(text_col)).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids binary, bytes binary")
