"""Byte-level BPE as a lazily determinised finite-state transducer, and its decoder.

A sequence of tokens is the BPE encoding of its bytes exactly if every neighbouring pair
is one (no merge that BPE would have made first crosses the seam). That turns the rank
table into a nondeterministic transducer over bytes, whose configurations are the places
where the token being read may have begun. Subset construction makes the configurations
alive after a byte one state; states and their transitions are made when first reached,
each with the tokens that end there. Of these exactly one fits the token before it, so
every prefix has one last token, and what all live configurations have in common is
emitted: lookahead is bounded by the longest token.

Decoding maps ids to bytes and feeds them to an incremental UTF-8 state machine, which
holds back an unfinished character at a chunk's end.

Defined results: null text is the empty text and has no tokens; whole texts are encoded,
in memory proportional to one text; repeated rows repeat; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostweave.llm.common import documents, map_batches, texts

#: Bounds of what a worker remembers; beyond them it starts afresh (results don't change).
MAX_TRANSITIONS, MAX_PAIRS, MAX_PIECES, LONG = 400_000, 600_000, 250_000, 64

#: Fixed value: the public pattern under which a space always leads the piece it is in.
SPACE_LED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

DOUBTFUL = regex.compile(r" \s").search


def load_ranks(path: str) -> dict[bytes, int]:
    """Rank of each token from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_bytes(piece: bytes, ranks: dict[bytes, int], below: float = float("inf")) -> list[bytes]:
    """Plain BPE: merges the leftmost pair of least rank, of ranks under ``below``."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], below))
        if ranks.get(parts[best] + parts[best + 1], below) >= below:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return parts


class Transducer:
    """Encodes one piece of bytes at a time; see the module text."""

    def __init__(self, ranks: dict[bytes, int], window: int = 1024) -> None:
        self.ranks, self.window = ranks, window
        self.tokens = {v: k for k, v in ranks.items()}
        self._children: dict[int, int] = {}
        self._token_at = [-1]
        for token, rank in ranks.items():
            node = 0
            for b in token:
                key = node << 8 | b
                if (step := self._children.get(key)) is None:
                    step = self._children[key] = len(self._token_at)
                    self._token_at.append(-1)
                node = step
            self._token_at[node] = rank
        self._halves: dict[int, tuple[int, ...] | None] = {}
        self._pairs: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        self._states: dict[tuple, int] = {(): 0}
        self._live: list[tuple[tuple[int, int], ...]] = [()]  # (bytes read, trie node) of each configuration, oldest first
        self._steps: dict[int, tuple[int, tuple[tuple[int, int], ...]]] = {}

    def _split(self, token: int) -> tuple[int, ...] | None:
        """The two tokens whose merge makes ``token``: () if none does, None for a byte."""
        if token not in self._halves:
            raw = self.tokens[token]
            parts = merge_bytes(raw, self.ranks, token) if len(raw) > 1 else []
            self._halves[token] = None if not parts else tuple(self.ranks[p] for p in parts) if len(parts) == 2 else ()
        return self._halves[token]

    def _fits(self, key: int) -> bool:
        """Whether BPE of the bytes of tokens ``key >> 32`` and ``key & (1 << 32) - 1`` gives just these two.

        Walks back in time: undoing the later of the two tokens' own merges shows the
        pair that met at the seam before it. A merge across the seam would have come
        first if its rank is lower than that of the merge undone last (on the left side,
        an equal rank was already done; on the right side it comes later).
        """
        limit, a, b, ok = 1 << 60, key >> 32, key & 0xFFFFFFFF, True
        while True:
            seam = self.ranks.get(self.tokens[a] + self.tokens[b])
            if seam is not None and seam < limit:
                ok = False
                break
            x, y = self._split(a), self._split(b)
            if x is None and y is None:
                break
            if y is None or x is not None and a > b:
                limit, a = a, x[1]
            else:
                limit, b = b + 1, y[0]
        self._pairs[key] = ok
        return ok

    def _step(self, state: int, byte: int) -> tuple[int, tuple[tuple[int, int], ...]]:
        live = tuple((n + 1, step) for n, node in (*self._live[state], (0, 0)) if (step := self._children.get(node << 8 | byte)) is not None)
        if (to := self._states.get(live)) is None:
            to = self._states[live] = len(self._live)
            self._live.append(live)
        ends = tuple((n, t) for n, node in live if (t := self._token_at[node]) >= 0 and self._split(t) != ())
        found = self._steps[state << 8 | byte] = (to, ends)
        return found

    def _emit(self, state: int, last: list[int], size: list[int], out: list[int]) -> None:
        """Moves to ``out`` what all live configurations share, and forgets it."""
        n = len(last) - 1
        ways = []
        for back in (0, *(age for age, _ in self._live[state])):
            if last[at := n - back] != -2:
                way = [at]
                while at:
                    at -= size[at]
                    way.append(at)
                ways.append(way[::-1])
        shared = 0
        while all(len(w) > shared for w in ways) and len({w[shared] for w in ways}) == 1:
            shared += 1
        way = ways[0][:shared]
        out += [last[at] for at in way[1:]]
        if (keep := way[-1]) > 0:
            del last[:keep], size[:keep]  # the token at the cut stays, as the one before what follows

    def encode(self, piece: bytes) -> list[int]:
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        if len(self._steps) > MAX_TRANSITIONS:
            self._forget()
        if len(self._pairs) > MAX_PAIRS:
            self._pairs.clear()
        steps, pairs, state = self._steps, self._pairs, 0
        last, size, out = [-1], [0], []  # of each prefix: its last token (-1: none yet) and that token's bytes
        for byte in piece:
            state, ends = steps.get(state << 8 | byte) or self._step(state, byte)
            for n, token in ends:
                if (before := last[-n]) < 0 or (fit := pairs.get(key := before << 32 | token)) or fit is None and self._fits(key):
                    if before != -2:
                        last.append(token)
                        size.append(n)
                        break
            else:
                last.append(-2)  # no encoding ends here
                size.append(0)
            if len(last) > self.window:
                self._emit(state, last, size, out)
        if last[-1] == -2:
            raise ValueError("no encoding: the rank table can't make these bytes")
        at, tail = len(last) - 1, []
        while at:
            tail.append(last[at])
            at -= size[at]
        return out + tail[::-1]


class _Pieces(dict):
    """Piece to packed little-endian ids; pieces are encoded when first asked for."""

    def __init__(self, transducer: Transducer) -> None:
        super().__init__()
        self.encode = transducer.encode

    def __missing__(self, piece: str) -> bytes:
        ids = array("I", self.encode(piece.encode())).tobytes()
        if len(piece) <= LONG:
            self[piece] = ids
        return ids


class _Words(dict):
    """Packed ids of a space and what follows up to the next one."""

    def __init__(self, find: Callable[[str], list[str]], pieces: _Pieces) -> None:
        super().__init__()
        self.find, self.pieces = find, pieces

    def __missing__(self, word: str) -> bytes:
        ids = b"".join(map(self.pieces.__getitem__, self.find(" " + word)))
        if len(word) <= LONG:
            self[word] = ids
        return ids


class Encoder:
    """Splits texts by the pattern, encodes the pieces, and decodes ids.

    Where every space stands between two characters that aren't white space or follows
    white space singly (no space is followed by white space), the pattern always cuts
    before a space, and what lies between two spaces can be remembered as a whole; other
    texts are split as a whole.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.transducer = Transducer(ranks)
        self.find = regex.compile(pattern).findall
        self.pieces = _Pieces(self.transducer)
        self.words = _Words(self.find, self.pieces) if pattern == SPACE_LED else None
        self.table = [self.transducer.tokens.get(i, b"") for i in range(max(ranks.values()) + 1)]

    def encode(self, text: str) -> bytes:
        """The ids of a text, as little-endian unsigned 32-bit integers."""
        for known in (self.pieces, self.words):
            if known is not None and len(known) > MAX_PIECES:
                known.clear()
        if self.words is None or text.endswith(" ") or DOUBTFUL(text):
            return b"".join(map(self.pieces.__getitem__, self.find(text)))
        first, *rest = text.split(" ")
        return b"".join([*map(self.pieces.__getitem__, self.find(first)), *map(self.words.__getitem__, rest)])

    def decode(self, ids: bytes, chunk: int = 65536) -> Iterator[str]:
        """The text in chunks, each ending at a whole character."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        numbers = array("I", ids)
        for at in range(0, len(numbers), chunk):
            yield machine.decode(b"".join(map(self.table.__getitem__, numbers[at : at + chunk])))
        yield machine.decode(b"", True)


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(ranks: dict[bytes, int], pattern: str, name: str) -> Encoder:
    """The worker's encoder of that name and pattern; made once a process."""
    if (name, pattern) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name, pattern] = Encoder(ranks, pattern)
    return _ENCODERS[name, pattern]


def tokenize(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """Encodes and decodes every text.

    ``(doc_id, n_tokens, ids array<int>, decoded string)``, or with ``digests`` SHA-256
    of the packed ids and of the decoded bytes in their place.
    """
    ranks = load_ranks(ranks_path)  # on the driver; a table of fixed size goes along with the code
    name = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = encoder(ranks, pattern, name)
        n, first, second = [], [], []
        for text in texts(batch, "text"):
            ids = own.encode(text)
            n.append(len(ids) // 4)
            if digests:
                digest = hashlib.sha256()
                for part in own.decode(ids):
                    digest.update(part.encode())
                first.append(hashlib.sha256(ids).hexdigest())
                second.append(digest.hexdigest())
            else:
                first.append(np.frombuffer(ids, dtype="<u4").astype(np.int32))
                second.append("".join(own.decode(ids)))
        kind = pa.string() if digests else pa.list_(pa.int32())
        return pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(first, kind), pa.array(second, pa.string())], names)

    names = ["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    kind = "string" if digests else "array<int>"
    return map_batches(rows, one, f"doc_id long, n_tokens long, {names[2]} {kind}, {names[3]} string")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokenize(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, digests=True)
