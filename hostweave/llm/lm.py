"""Language-model scoring with a weighted backoff automaton.

The model is an n-gram model over words, smoothed by interpolation: a context ``h`` with
count ``c(h)`` gives ``P(w | h) = (c(h w) + m * P(w | h')) / (c(h) + m)``, where ``h'`` drops
the oldest word; the empty context has add-one unigrams.

As an automaton: each seen context is a state; a seen continuation ``h w`` is an arc with
its log-probability to the state of the longest seen suffix of ``h w``; each state has a
failure arc to that of ``h'`` with the weight ``log10(m / (c(h) + m))``; the root has an arc
for every word. Reading a word, the state in hand takes its arc, or else falls along
failure arcs, adding their weights, until there is one. One pass from left to right
carries the state and accumulates.

No table of the whole model is ever held in one place. Each task turns its texts, as they
are scanned, into blocks of words by number, written once (texts are never shuffled). A
block asks for the counts of just its own n-grams: a request is a sorted array of their
64-bit hashes with the block's own training counts; requests are dealt by hash range,
summed there over all blocks, and answered with total counts, from which each block
builds its part of the automaton. So a task holds one block's n-grams or one range's, and
what is moved grows with the corpus. Every distinct n-gram of a block is asked for once,
however frequent. There is a row for each block and range, so their number grows faster
than the corpus; their sizes are parameters.

Words are told apart by 64-bit hashes and longer n-grams by 56 bits; with ``k`` different
ones the chance that any two are mixed up is about ``k * k / 2**59`` and ``k * k / 2**57``.

Defined results: null text is the empty text, one end token; an id may be null; repeated
rows repeat; very long texts are read whole (a block holds one text at least); the score
has no ties to break; with no training text counts are zero and probabilities those of an empty
model; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hostweave.llm.common import cut, documents, raw

#: Hashes of the end token and, as a context only, of what stands before a text's first word.
END, START = np.uint64(0x1F3D5B79A2C4E680), np.uint64(0x0E2C4A68B7D59F31)
MIX = np.uint64(0x9E3779B97F4A7C15)


#: By byte: an odd random number of its own, and whether it is white space.
_BYTES = np.random.default_rng(20240).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: The part of a hash by which n-grams of two words and more are known; what is sent gets shorter by the rest.
WHOLE = np.uint64(2**64 - 2**8)
#: Bytes of text that are hashed at once.
CHUNK = 1 << 16
#: Keys of a range that are summed at once.
PIECE = 1 << 19


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.r_[np.uint64(1), np.full(max(0, n - 1), 0xD6E8FEB86659FD93, dtype=np.uint64)])


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places of several runs, one after the other."""
    return np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())


def _hashed(texts: list[bytes], outer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer(b" " + b" ".join(texts).lower() + b" ", dtype=np.uint8)  # on bytes: ASCII case only
    space = _SPACE[flat]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    if outer.any():  # from the first to the last byte that isn't stripped
        inside = np.flatnonzero(~(space | outer[flat]))
        odd = np.flatnonzero(outer[flat[start]] | outer[flat[end - 1]])
        a, b = np.searchsorted(inside, start[odd]), np.searchsorted(inside, end[odd])
        some = b > a
        start[odd[some]], end[odd[some]] = inside[a[some]], inside[b[some] - 1] + 1
        start, end = np.delete(start, odd[~some]), np.delete(end, odd[~some])
    size = end - start
    at = spread(start, size)
    place = at - np.repeat(start, size)
    value = _BYTES[flat[at]] * _powers(int(size.max(initial=0)))[place]
    found = np.add.reduceat(value, np.cumsum(size) - size) if len(size) else np.zeros(0, np.uint64)
    found = (found ^ (found >> np.uint64(32))) * MIX
    found ^= found >> np.uint64(29)
    ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1)
    return found, np.diff(np.searchsorted(start, ends), prepend=0)


def hashed_words(texts: list[bytes], strip: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of some texts, one after the other, and each text's number of words.

    Words are parted by ASCII white space and lower-cased in ASCII; with ``strip`` they lose these bytes at
    their ends, and those with nothing left are no words. The hash is a polynomial of random
    numbers for bytes, mixed; two given words of up to 32 bytes share one with a chance of
    about ``2**-58``.
    """
    outer = np.zeros(256, dtype=bool)
    outer[list(strip)] = True
    hashes, counts, some, size = [], [], [], 0
    for text in texts:
        some.append(text)
        size += len(text) + 1
        if size >= CHUNK:
            h, c = _hashed(some, outer)
            hashes.append(h)
            counts.append(c)
            some, size = [], 0
    if some:
        h, c = _hashed(some, outer)
        hashes.append(h)
        counts.append(c)
    join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return join(hashes, np.uint64), join(counts, np.int64)


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values, sorted, and the place of each value among them."""
    turn = np.argsort(values).astype(np.int32)
    values = values[turn]
    first = np.r_[True, values[1:] != values[:-1]][: len(values)]
    place = np.empty(len(values), dtype=np.int32)
    place[turn] = np.cumsum(first, dtype=np.int32) - 1
    return values[first], place


def extend(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Hashes of n-grams from those of their contexts and last tokens."""
    x = context * MIX + token
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def pack(values: np.ndarray) -> bytes:
    """Sorted hashes or counts, compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel() if len(raw) else np.zeros(0, kind)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, "u8"), dtype=np.uint64)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end token after each text's words, and the texts' numbers of tokens."""
    words, count = hashed_words(texts)
    out = np.full(len(words) + len(texts), END, dtype=np.uint64)
    out[np.arange(len(words)) + np.repeat(np.arange(len(texts)), count)] = words
    return out, count + 1


BLOCK = "block long, ids binary, known binary, train binary, length binary, words binary, at binary"


def _block(name: int, ids: pa.Array, train: np.ndarray, texts: list[bytes]) -> pa.RecordBatch:
    found, length = tokens(texts)
    words, at = numbered(found)
    cells = (name, ids.fill_null(0).to_numpy().astype("i8").tobytes(), ids.is_valid().to_numpy(zero_copy_only=False).tobytes(), train.tobytes(), pack(length.astype("u4")), pack_sorted(words), pack(at.astype("u4")))
    return pa.RecordBatch.from_pydict({f.split()[0]: [c] for f, c in zip(BLOCK.split(", "), cells, strict=True)})


def blocks(rows: DataFrame, block_bytes: int, block_rows: int = 1 << 16) -> DataFrame:
    """Blocks of ``(doc_id, text, train)`` by bytes and rows, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = task = count = 0

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            train = table.column("train").to_numpy().astype(bool)
            return _block(task << 32 | count, pa.concat_arrays(table.column("doc_id").chunks), train, [x for h in held for x in raw(h, "text")])

        for batch in batches:
            if not batch.num_rows:
                continue
            task = batch.column("task")[0].as_py()
            length = np.cumsum([0 if t is None else t for t in batch.column("size").to_pylist()])
            at = 0
            while at < batch.num_rows:
                room = max(1, block_rows - sum(h.num_rows for h in held))
                before = length[at - 1] if at else 0
                upto = min(int(np.searchsorted(length, before + block_bytes - size)) + 1, at + room, batch.num_rows)
                held.append(batch.slice(at, upto - at))
                size += int(length[upto - 1] - before)
                if size >= block_bytes or sum(h.num_rows for h in held) >= block_rows:
                    yield block()
                    held, size, count = [], 0, count + 1
                at = upto
        if held:
            yield block()

    sized = rows.select("doc_id", "text", "train", F.octet_length("text").alias("size"), F.spark_partition_id().alias("task"))
    return cut(sized.mapInArrow(run, BLOCK), "blocks")


class Block:
    """The n-grams that end at each token of a block's texts, order by order."""

    def __init__(self, words: np.ndarray, at: np.ndarray, length: np.ndarray, order: int) -> None:
        self.words, self.at, self.length, self.order = words, at.astype(np.int32), length, order
        self.first = np.cumsum(length) - length
        self.place = (np.arange(len(at)) - np.repeat(self.first, length)).astype(np.int32)
        self.keys: list[np.ndarray] = []
        #: number[k][i]: the place among the sorted keys[k] of token i with k words before it (the start mark
        #: filling in once, so place >= k - 1); -1 if there is no such n-gram.
        self.number: list[np.ndarray] = []
        gram = words[self.at]
        for k in range(order):
            if k:
                gram = np.where(self.place == 0, extend(np.full(1, START), np.full(1, np.uint64(k)))[0], np.roll(gram, 1))
                gram = extend(gram, words[self.at])
            has = self.has(k)
            keys, number = numbered(gram[has] & WHOLE if k else gram[has])
            self.keys.append(keys)
            self.number.append(np.full(len(at), -1, dtype=np.int32))
            self.number[-1][has] = number

    def has(self, k: int) -> np.ndarray:
        return self.place >= k - 1

    @classmethod
    def of(cls, row: dict, order: int) -> Block:
        return cls(unpack_sorted(row["words"]), unpack(row["at"], "u4"), unpack(row["length"], "u4").astype(np.int64), order)

    @classmethod
    def from_texts(cls, texts: list[bytes], order: int) -> Block:
        found, length = tokens(texts)
        words, at = numbered(found)
        return cls(words, at, length, order)

    def counts(self, train: np.ndarray) -> list[np.ndarray]:
        """How often each key occurs in training texts."""
        use = np.repeat(train, self.length)
        return [np.bincount(n[use & (n >= 0)], minlength=len(k)).astype(np.uint32) for k, n in zip(self.keys, self.number, strict=True)]


def small(values: np.ndarray) -> bytes:
    """Counts or places, packed in the fewest bytes each that will do; the first byte tells."""
    kind = next(k for k in ("u1", "u2", "u4", "u8") if k == "u8" or values.max(initial=0) < 1 << 8 * int(k[1]))
    return kind[1].encode() + pack(values.astype(kind))


def unsmall(data: bytes) -> np.ndarray:
    return unpack(data[1:], "u" + data[:1].decode())


def requests(found: DataFrame, order: int, ranges: int) -> DataFrame:
    """``(range, block, order, keys, counts)`` of all n-grams of the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.of(row, order)
                train = np.frombuffer(row["train"], dtype=bool)
                rows: list[tuple] = []
                for k, (keys, counts) in enumerate(zip(block.keys, block.counts(train), strict=True)):
                    cuts = np.searchsorted((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32), np.arange(ranges + 1))
                    rows += [(r, row["block"], k, pack_sorted(keys[a:b]), small(counts[a:b])) for r, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if b > a]
                del block
                yield pa.record_batch([pa.array([r[j] for r in rows], kind) for j, kind in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))], ["range", "block", "order", "keys", "counts"])

    return found.select("block", "train", "length", "words", "at").mapInArrow(run, "range long, block long, order int, keys binary, counts binary")


def answers(asked: DataFrame) -> DataFrame:
    """``(block, range, order, totals, n, v)``: total counts in the order of the request's keys.

    The row of a range and order with block -1 carries, for single words, the range's share of the
    training tokens (``n``) and of the distinct training words (``v``).
    """

    def run(table: pa.Table) -> pa.Table:
        counts = [unsmall(x.as_py()) for x in table.column("counts")]
        ends = np.cumsum([len(c) for c in counts])
        keys = np.empty(ends[-1], dtype=np.uint64)
        for x, end, c in zip(table.column("keys"), ends.tolist(), counts, strict=True):
            keys[end - len(c) : end] = unpack_sorted(x.as_py())
        most = sum(int(c.sum(dtype=np.uint64)) for c in counts)
        told = np.empty(len(keys), dtype=np.uint32 if most < 1 << 32 else np.uint64)
        n = v = 0
        pieces = len(keys) // PIECE + 1
        low, high = (int(keys.min()), int(keys.max())) if len(keys) else (0, 0)
        bounds = np.array([low + (high - low) * i // pieces for i in range(1, pieces)], dtype=np.uint64)
        starts = ends - np.array([len(c) for c in counts])
        cuts = [np.r_[0, np.searchsorted(keys[a:b], bounds), b - a] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        for i in range(pieces):  # a key lies in the same piece of all requests
            spans = [(a, int(c[i]), int(c[i + 1])) for a, c in zip(starts.tolist(), cuts, strict=True)]
            part = np.concatenate([keys[a + x : a + y] for a, x, y in spans])
            if not len(part):
                continue
            turn = np.argsort(part, kind="stable")  # merges the sorted requests
            part = part[turn]
            first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            own = np.concatenate([c[x:y] for c, (_, x, y) in zip(counts, spans, strict=True)], dtype=np.uint64, casting="unsafe")
            totals = np.add.reduceat(own[turn], first)
            n, v = n + int(totals.sum()), v + int((totals > 0).sum())
            back = np.empty(len(part), dtype=told.dtype)
            back[turn] = np.repeat(totals.astype(told.dtype), np.diff(first, append=len(part)))
            at = 0
            for a, x, y in spans:
                told[a + x : a + y] = back[at : at + y - x]
                at += y - x
        del keys
        packed = [small(part) for part in np.split(told, ends[:-1])]
        r, k, many = table.column("range")[0].as_py(), table.column("order")[0].as_py(), len(packed)
        single = k == 0
        return pa.table(
            {
                "block": pa.array([*table.column("block").to_pylist(), -1], pa.int64()),
                "range": pa.array([r] * (many + 1), pa.int64()),
                "order": pa.array([k] * (many + 1), pa.int32()),
                "totals": pa.array([*packed, None], pa.binary()),
                "n": pa.array([0] * many + [n if single else 0], pa.int64()),
                "v": pa.array([0] * many + [v if single else 0], pa.int64()),
            }
        )

    return asked.groupBy("range", "order").applyInArrow(run, "block long, range long, order int, totals binary, n long, v long")


#: Tokens of a text that are read by one lane of a walk.
LANE = 256


class Automaton:
    """States, arcs and failure arcs over the words of one block.

    State 0 is the root and 1 the start of a text. ``arc_keys`` (sorted) are ``state * width
    + word``; the root's arcs are by word in ``root_weight`` and ``root_to``.
    """

    def __init__(self, block: Block, totals: list[np.ndarray], n: int, v: int, ends: float, strength: float) -> None:
        order, number, place = block.order, block.number, block.place
        self.order, self.width = order, max(1, len(block.words))
        c = [t.astype(np.float64) for t in totals]
        unigram = (c[0] + 1) / (n + v + 1)
        state = []  # of the keys of each order that can be contexts; -1: not seen in training
        size = 2
        for k in range(order - 1):
            state.append(np.where(c[k] > 0, np.cumsum(c[k] > 0) - 1 + size, -1))
            size += int((c[k] > 0).sum())
        self.fail = np.zeros(size, dtype=np.int64)
        self.fail_weight = np.zeros(size)
        self.fail_weight[1] = np.log10(strength / (ends + strength))
        self.root_weight, self.root_to = np.log10(unigram), np.maximum(state[0], 0) if order > 1 else np.zeros(len(unigram), np.int64)
        p = unigram[number[0]]
        keys, weights, to = [], [], []
        for k in range(order):
            if k:
                context = np.where(place == 0, ends, np.roll(c[k - 1][number[k - 1]], 1)) if k == 1 else np.roll(c[k - 1][number[k - 1]], 1)
                p = np.where(block.has(k), (c[k][number[k]] + strength * p) / (context + strength), p)
            first = np.full(len(block.keys[k]), -1, dtype=np.int32)
            at = np.flatnonzero(block.has(k))
            first[number[k][at]] = at  # some place where the n-gram ends
            first = first[c[k] > 0]
            if k < order - 1:  # the n-gram is a state, whose failure arc drops its first word
                own = state[k][c[k] > 0]
                self.fail_weight[own] = np.log10(strength / (c[k][c[k] > 0] + strength))
                if k:
                    self.fail[own] = state[k - 1][number[k - 1][first]]
            if k:  # and an arc from the state of what is before its last word
                before = state[k - 1][number[k - 1][first - 1]]
                if k == 1:
                    before = np.where(place[first] == 0, 1, before)
                arc = before * self.width + block.at[first]
                turn = np.argsort(arc)
                first = first[turn]
                keys.append(arc[turn])  # states of longer contexts have higher numbers, so the arcs of all orders are sorted
                weights.append(np.log10(p[first]))
                to.append(state[min(k, order - 2)][number[min(k, order - 2)][first]].astype(np.int32))
                del arc, turn, before
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.arc_keys, self.arc_weight, self.arc_to = join(keys, np.int64), join(weights, np.float64), join(to, np.int32)

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after one word each, and the log-probabilities added on the way."""
        state, added = state.copy(), np.zeros(len(state))
        todo = np.arange(len(state))
        while len(todo):
            root = state[todo] == 0
            some = todo[root]
            added[some] += self.root_weight[word[some]]
            state[some] = self.root_to[word[some]]
            todo = todo[~root]
            key = state[todo] * self.width + word[todo]
            at = np.minimum(np.searchsorted(self.arc_keys, key), max(0, len(self.arc_keys) - 1))
            hit = self.arc_keys[at] == key if len(self.arc_keys) else np.zeros(len(todo), bool)
            some = todo[hit]
            added[some] += self.arc_weight[at[hit]]
            state[some] = self.arc_to[at[hit]]
            todo = todo[~hit]
            added[todo] += self.fail_weight[state[todo]]
            state[todo] = self.fail[state[todo]]
        return state, added

    def walk(self, word: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The log-probability of each text, its words in one pass from left to right.

        Long texts are read in lanes side by side. A lane first reads the words before its
        own, as many as a state can hold, without counting them: that puts it into the
        state in which the lane before it ends.
        """
        lanes = -(-length // LANE)
        text = np.repeat(np.arange(len(length)), lanes)
        offset = spread(np.zeros(len(length), dtype=np.int64), lanes) * LANE
        begin = (np.cumsum(length) - length)[text] + offset
        upto = np.minimum(offset + LANE, length[text]) - offset
        state = np.where(offset == 0, min(1, self.order - 1), 0)
        for back in range(min(self.order - 1, LANE), 0, -1):
            some = np.flatnonzero(offset > 0)
            state[some] = self.step(state[some], word[begin[some] - back])[0]
        total = np.zeros(len(begin))
        turn = np.argsort(-upto, kind="stable")
        begin, state, total, upto = begin[turn], state[turn], total, upto[turn]
        for t in range(int(upto.max(initial=0))):
            live = int(np.searchsorted(-upto, -t, side="left"))  # lanes that have more than t words
            state[:live], added = self.step(state[:live], word[begin[:live] + t])
            total[:live] += added
        return np.bincount(text[turn], total, minlength=len(length))


def scored(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 3, strength: float = 100.0, block_bytes: int = 6 << 20, range_bytes: int = 32 << 20) -> DataFrame:
    """``(doc_id, train, n_tokens, n_known, train_tokens, base_score, score)`` for every row.

    ``train`` marks the rows to learn from. Blocks and ranges are sized by bytes of text
    (blocks also by rows), so their number follows the corpus and a task's memory doesn't.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    held = blocks(rows, block_bytes)
    size, ends = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0)), F.coalesce(F.sum(F.col("train").cast("long")), F.lit(0))).first()
    found = cut(answers(requests(held, order, int(size // range_bytes) + 1)), "counts")
    n, v = found.where("block = -1").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()

    def run(table: pa.Table, counts: pa.Table) -> pa.Table:
        row = table.to_pylist()[0]
        block = Block.of(row, order)
        parts = sorted(zip(counts.column("order").to_pylist(), counts.column("range").to_pylist(), counts.column("totals").to_pylist(), strict=True), key=lambda x: x[:2])
        totals = [np.concatenate([unsmall(t).astype(np.uint64) for k, _, t in parts if k == j] or [np.zeros(0, np.uint64)]) for j in range(order)]
        score = Automaton(block, totals, n, v, float(ends), strength).walk(block.at, block.length)
        c = totals[0][block.number[0]]
        sums = lambda x: np.add.reduceat(x, block.first)
        ids = pa.array(np.frombuffer(row["ids"], "i8"), mask=~np.frombuffer(row["known"], dtype=bool))
        learnt = np.frombuffer(row["train"], dtype=bool)
        return pa.table({"doc_id": ids, "train": pa.array(learnt), "n_tokens": block.length, "n_known": sums((c > 0).astype(np.int64)), "train_tokens": np.full(len(learnt), n, np.int64), "base_score": sums(np.log10((c.astype(np.float64) + 1) / (n + v + 1))), "score": score})

    out = "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return held.groupBy("block").cogroup(found.where("block >= 0").select("block", "range", "order", "totals").groupBy("block")).applyInArrow(run, out)


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    out = scored(documents(spark, sf_dir), ~held)
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
