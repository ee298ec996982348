"""Secret scans: fixed patterns, and a character convolutional network over candidates.

Candidates are the findings of three fixed patterns and every other long run of token
characters that holds a digit, or shorter run that is assigned to something, unless it
lies within a finding. The network (numpy: character embedding, one convolution, maximum
over places within the candidate and within its context, a logistic layer) reads a
candidate with the characters around it. A long candidate is read whole, in overlapping
windows between the same contexts, and counts by its highest. The network is trained on
the values of findings, labelled by the patterns (candidates that only overlap one have no label); half
of the positive examples have the key word in their context overwritten, so that the
shape of a value counts and not just the word before it. To these come examples that are
made: random tokens as secrets and runs of digits, grouped or not, as none, in the
context of every candidate that is no finding; so what patterns can't label is learnt too, and
there are enough positives to set a threshold by. On a calibration part, a
temperature is fitted and the threshold is the highest that still finds the wanted share
of positives (or, where no negative comes near it, halfway to the highest negative).
Recall and false findings are measured on a third part, which nothing is fitted to. Both
parts show positives without their key word, as the network has to find them.
Pattern findings always stay; the network adds other candidates above the threshold.

Every different window of the table is in one of the three parts, whatever their number.
They lie in blocks of a bounded size; in a round each block passes once over its own
examples from the network of the round before, and the blocks' networks (with the moments
of their steps) are averaged. The sums are of whole numbers, so the result doesn't depend
on how Spark deals the rows. Temperature, threshold and the measured shares come from
counts of all held-out logits by steps of 1 / ``GRID``.

Defined results: null text is the empty text without findings; spans are in code points,
end exclusive, over whole texts, very long ones too (windows are judged in blocks of a
bounded number); spans of one start are in the order of ``KINDS``; repeated rows repeat;
with no candidate but findings there is no context to learn in, and the network adds nothing; an empty table gives an
empty result. Extra columns are kept by ``redacted`` and not read by ``findings``.
"""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostweave.llm.common import cut, documents, map_batches, texts
from hostweave.sources.scratch import run_folder

# The patterns of the base findings, the least length, and the group it is of.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "net")

KEYWORDS = (b"passw", b"secret", b"token", b"api")
TOKEN = re.compile(rb"[A-Za-z0-9+/_.=-]{16,}")
ASSIGNED = re.compile(rb"""[:=] ?["']?([A-Za-z0-9+/_.=-]{8,})""")
DIGIT = re.compile(rb"[0-9]")
HEXMAP = bytes(49 if chr(i) in "0123456789abcdef" else 48 for i in range(256))

SIDE, INNER = 16, 40
#: Least made examples of either label, the alphabets of made secrets, and their lengths.
MADE, LENGTHS = 600, (20, 40)
ALPHABETS = (b"0123456789abcdef", b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", b"abcdefghijklmnopqrstuvwxyz0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
#: Width of the convolution, and the network's arrays that are learnt.
SPAN = 5
LEARNT = ("embed", "kernel", "bias", "out", "offset")
#: Windows that are judged at once.
BLOCK = 2048
#: Parts of the examples, of fifths: three to learn from, one to measure on, one to calibrate on.
LEARN, MEASURE, CALIBRATE = range(3)
FIFTHS = (LEARN, LEARN, LEARN, MEASURE, CALIBRATE)
#: Steps of a logit in counts of held-out logits, and the largest logit told apart there.
GRID, LARGEST = 1024, 64
#: What a network's numbers are multiplied by where they are summed as whole numbers.
FIXED = 2.0**40
WIDTH = SIDE + INNER + SIDE
#: Characters by number: printable ASCII, a class for the rest, and 0 for outside the text.
CODES = np.array([i - 30 if 32 <= i < 127 else 1 for i in range(256)], dtype=np.int64)


def narrow(text: str) -> bytes:
    """One byte for each code point; what isn't ASCII becomes byte 128."""
    return text.encode("ascii", "replace") if text.isascii() else bytes(np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), 128).astype(np.uint8))


def base_spans(text: str, flat: bytes | None = None) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the pattern findings, by start and then kind."""
    flat = narrow(text) if flat is None else flat
    low, out = flat.lower(), []
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if b"AKIA" in flat:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    ones = flat.translate(HEXMAP)
    at = ones.find(b"1" * LEAST["hex"])
    while at >= 0:
        end = HEX.match(text, at).end()
        out.append((at, end, "hex"))
        at = ones.find(b"1" * LEAST["hex"], end)
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def value(text: str, start: int, end: int, kind: str) -> tuple[int, int]:
    """The secret within a finding: what is assigned, without its key word."""
    return ASSIGN.match(text, start).span(2) if kind == "assign" else (start, end)


def other_candidates(flat: bytes, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, bool]]:
    """Further token-like runs that don't lie within a pattern finding, and whether they overlap one."""
    found = {(m.start(), m.end()) for m in TOKEN.finditer(flat) if DIGIT.search(m[0])}
    if b"=" in flat or b":" in flat:
        found |= {m.span(1) for m in ASSIGNED.finditer(flat)}
    furthest = list(itertools.accumulate((b for _, b, _ in taken), max))
    out, end, first = [], -1, 0
    for s, e in sorted(found, key=lambda x: (x[0], -x[1])):
        if s < end:
            continue
        while first < len(taken) and furthest[first] <= s:
            first += 1
        own = [(a, b) for a, b, _ in itertools.takewhile(lambda x: x[0] < e, itertools.islice(taken, first, None)) if b > s]
        if not any(a <= s and e <= b for a, b in own):
            out.append((s, e, bool(own)))
            end = e
    return out


def windows(flat: bytes, start: int, end: int) -> Iterator[np.ndarray]:
    """Character codes of context, candidate, context; a long candidate in overlapping pieces.

    Every run of ``SPAN`` characters of the candidate lies whole in some window.
    """
    left = flat[max(0, start - SIDE) : start]
    right = flat[end : end + SIDE]
    for at in range(start, max(start + 1, end - SPAN + 1), INNER - SPAN + 1):
        out = np.zeros(WIDTH, dtype=np.uint8)
        at = max(start, min(at, end - INNER))
        for to, part in ((SIDE - len(left), left), (SIDE, flat[at : min(end, at + INNER)]), (SIDE + INNER, right)):
            out[to : to + len(part)] = CODES[np.frombuffer(part, dtype=np.uint8)]
        yield out


@dataclass
class Net:
    """One convolution over embedded characters; maxima inside and outside the candidate."""

    embed: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    offset: float
    temperature: float = 1.0
    threshold: float = 2.0
    #: Shares of held-out findings and of held-out others that are over the threshold.
    recall: float = 0.0
    false_rate: float = 0.0

    @classmethod
    def fresh(cls, seed: int, dim: int = 12, filters: int = 24) -> Net:
        rng = np.random.default_rng(seed)
        return cls(rng.normal(0, 0.3, (98, dim)), rng.normal(0, (1 / (SPAN * dim)) ** 0.5, (SPAN * dim, filters)), np.zeros(filters), rng.normal(0, 0.2, 2 * filters), 0.0)

    def _columns(self, x: np.ndarray) -> np.ndarray:
        e = np.pad(self.embed[x], ((0, 0), (SPAN // 2, SPAN // 2), (0, 0)))
        return np.concatenate([e[:, k : k + x.shape[1]] for k in range(SPAN)], axis=2)

    def _pool(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        cols = self._columns(x)
        h = np.maximum(cols @ self.kernel + self.bias, 0)
        inner = np.zeros(x.shape[1], bool)
        inner[SIDE : SIDE + INNER] = True
        pick = [(h * m[None, :, None]).argmax(axis=1) for m in (inner, ~inner)]
        return cols, h, pick, np.concatenate([np.take_along_axis(h, p[:, None], axis=1)[:, 0] for p in pick], axis=1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        return np.concatenate([self._pool(x[i : i + 512])[3] @ self.out + self.offset for i in range(0, len(x), 512)])

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))

    def step(self, x: np.ndarray, y: np.ndarray, state: dict, rate: float, weight: np.ndarray | float = 1.0) -> None:
        """One Adam step on the (weighted) logistic loss of a batch."""
        cols, h, pick, pooled = self._pool(x)
        g = weight * (1 / (1 + np.exp(-np.clip(pooled @ self.out + self.offset, -30, 30))) - y) / len(y)
        back = g[:, None] * self.out
        dh = np.zeros_like(h)
        n = h.shape[2]
        rows, filters = np.arange(len(x))[:, None], np.arange(n)[None]
        for k, p in enumerate(pick):
            np.add.at(dh, (rows, p, filters), back[:, k * n : (k + 1) * n])
        dh *= h > 0
        dcols = dh @ self.kernel.T
        dim, places = self.embed.shape[1], x.shape[1]
        de = np.zeros((len(x), places + SPAN - 1, dim))
        for k in range(SPAN):
            de[:, k : k + places] += dcols[:, :, k * dim : (k + 1) * dim]
        dembed = np.zeros_like(self.embed)
        np.add.at(dembed, x, de[:, SPAN // 2 : SPAN // 2 + places])
        grads = {"embed": dembed, "kernel": cols.reshape(-1, cols.shape[2]).T @ dh.reshape(-1, n), "bias": dh.sum(axis=(0, 1)), "out": pooled.T @ g, "offset": g.sum()}
        state["t"] = t = state.get("t", 0) + 1
        for name, grad in grads.items():
            m, v = state.get(name, (0.0, 0.0))
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            state[name] = m, v
            setattr(self, name, getattr(self, name) - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8))

    def vector(self, state: dict) -> np.ndarray:
        """Weights, their moments (the second's roots) and the number of steps in one row, for averaging."""
        moments = [state.get(name, (0.0, 0.0)) for name in LEARNT]
        parts = [(getattr(self, name), m, np.sqrt(v)) for name, (m, v) in zip(LEARNT, moments, strict=True)]
        return np.concatenate([*(np.broadcast_to(x, np.shape(own[0])).ravel() for own in parts for x in own), [state.get("t", 0)]])

    def restored(self, vector: np.ndarray) -> tuple[Net, dict]:
        """A network of this one's shape and the state of its steps, from such a row."""
        net, state, at = replace(self), {"t": float(vector[-1])}, 0
        for name in LEARNT:
            shape, size = np.shape(getattr(self, name)), np.size(getattr(self, name))
            own, m, root = (vector[at + k * size : at + (k + 1) * size].reshape(shape) for k in range(3))
            setattr(net, name, own)
            state[name] = m, root**2
            at += 3 * size
        return net, state


def blinded(window: bytes) -> bytes:
    """The window with random lower-case letters before the candidate, so without its key word."""
    rng = random.Random(window)
    return bytes(rng.randrange(67, 93) if c else 0 for c in window[:SIDE]) + window[SIDE:]


def made(window: bytes, copies: int) -> Iterator[tuple[int, bytes]]:
    """``(label, window)``: the context of a window around ``copies`` random tokens and as many numbers."""
    rng = random.Random(window)

    def token() -> bytes:
        return bytes(rng.choices(rng.choice(ALPHABETS), k=rng.randint(*LENGTHS)))

    def number() -> bytes:
        digits = "".join(rng.choices("0123456789", k=rng.randint(8, 24)))
        every, mark = rng.randint(2, 5), rng.choice("-./_")
        grouped = mark.join(digits[i : i + every] for i in range(0, len(digits), every))
        return (grouped if rng.random() < 0.5 else digits).encode()[:INNER]

    for _ in range(copies):
        for label, inside in ((1, token()), (0, number())):
            codes = CODES[np.frombuffer(inside, dtype=np.uint8)].astype(np.uint8).tobytes()
            yield label, window[:SIDE] + codes.ljust(INNER, b"\0") + window[SIDE + INNER :]


def _windows(docs: DataFrame, text_col: str) -> DataFrame:
    """Label and window of every labelled candidate; each different one once."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        labels, rows = [], []
        for text in texts(batch, "text"):
            flat = narrow(text)
            base = base_spans(text, flat)
            for s, e, y in [*((*value(text, *x), 1) for x in base), *((s, e, 0) for s, e, overlaps in other_candidates(flat, base) if not overlaps)]:
                for found in map(bytes, windows(flat, s, e)):
                    labels.append(y)
                    rows.append(found)
        return pa.record_batch([pa.array(labels, pa.int32()), pa.array(rows, pa.binary())], ["label", "window"])

    return map_batches(docs.select(F.col(text_col).alias("text")), one, "label int, window binary").distinct()


def _blocks(found: DataFrame, copies: int, parts: int) -> DataFrame:
    """``(use, part, rows)``: all examples of the windows, as ``parts`` blocks for each use.

    An example's use and part are decided by its hash. Positives are learnt with and
    without their key word, and shown without it elsewhere.
    """

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple[int, int, int, bytes]] = []
        for label, window in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for y, x in [(label, window), *(made(window, copies) if label == 0 else ())]:
                mark = int.from_bytes(hashlib.sha256(x).digest()[:8])
                use, part = FIFTHS[mark % 5], mark // 5 % parts
                shown = [x] if y == 0 else [x, blinded(x)] if use == LEARN else [blinded(x)]
                out += [(use, part, y, w) for w in shown]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
        columns = zip(*out, strict=True) if out else ((),) * 4
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["use", "part", "label", "window"])

    rows = map_batches(found.select("label", "window"), one, "use int, part int, label int, window binary")
    dealt = rows.repartition(min(3 * parts, 1024), "use", "part")
    return dealt.groupBy("use", "part").agg(F.array_sort(F.collect_list(F.struct("label", "window"))).alias("rows"))


def _examples(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Use, part, windows and labels of each block."""
    for use, part, rows in zip(*(batch.column(k) for k in range(3)), strict=True):
        labels, found = rows.values.flatten()
        x = np.frombuffer(b"".join(found.to_pylist()), dtype=np.uint8).reshape(-1, WIDTH)
        yield use.as_py(), part.as_py(), x.astype(np.int64), labels.to_numpy()


def _round(blocks: DataFrame, net: Net, vector: np.ndarray, number: int, weights: np.ndarray, rate: float = 0.004) -> np.ndarray:
    """The average of the blocks' networks after each has passed once over its examples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(vector), dtype=np.int64), 0
        for _, part, x, y in itertools.chain.from_iterable(map(_examples, batches)):
            own, state = net.restored(vector)
            for rows in np.array_split(np.random.default_rng((number, part)).permutation(len(x)), max(1, len(x) // 64)):
                own.step(x[rows], y[rows], state, rate, weights[y[rows]])
            total += np.round(own.vector(state) * FIXED).astype(np.int64)
            n += 1
        if n:
            yield pa.record_batch([pa.array(np.arange(len(total))), pa.array(total), pa.array(np.full(len(total), n))], ["place", "total", "n"])

    sums = blocks.mapInArrow(run, "place long, total long, n long").groupBy("place").agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total"), F.sum("n").alias("n"))
    out = np.empty(len(vector))
    for r in sums.collect():
        out[r["place"]] = int(r["total"]) / (FIXED * r["n"])
    return out


def _held_out(blocks: DataFrame, net: Net) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """Of each use and label: the logits of its examples, rounded down to the grid, and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for use, _, x, y in _examples(batch):
                steps = np.floor(np.clip(net.logits(x), -LARGEST, LARGEST) * GRID).astype(np.int64)
                for label in (0, 1):
                    step, n = np.unique(steps[y == label], return_counts=True)
                    columns = [pa.array(np.full(len(step), k), pa.int32()) for k in (use, label)]
                    yield pa.record_batch([*columns, pa.array(step), pa.array(n)], ["use", "label", "step", "n"])

    counts = blocks.mapInArrow(run, "use int, label int, step long, n long").groupBy("use", "label", "step").agg(F.sum("n").alias("n"))
    found = sorted(tuple(r) for r in counts.collect())
    pick = lambda *key: np.array([r[2:] for r in found if r[:2] == key], dtype=np.int64).reshape(-1, 2)
    return {key: (x[:, 0] / GRID, x[:, 1]) for key in itertools.product((MEASURE, CALIBRATE), (0, 1)) for x in [pick(*key)]}


def calibrated(net: Net, held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]], recall: float = 0.95) -> Net:
    """Fits temperature and threshold to one part's logits, and measures on the other's."""
    (bad, many), (good, n) = held[CALIBRATE, 0], held[CALIBRATE, 1]
    if not n.sum():
        return net  # threshold 2: nothing is added
    loss = {t: (np.logaddexp(0, -good / t) @ n + np.logaddexp(0, bad / t) @ many) / (n.sum() + many.sum()) for t in np.geomspace(0.25, 8, 21)}
    lowest = good[np.searchsorted(np.cumsum(n), int((1 - recall) * n.sum()), side="right")]
    if len(bad) and bad[-1] < lowest:
        lowest = np.ceil((lowest + bad[-1]) / 2 * GRID) / GRID  # the classes are apart: halfway keeps recall and spares what is like neither
    temperature = float(min(loss, key=loss.get))
    threshold = float(1 / (1 + np.exp(-np.clip(lowest / temperature, -30, 30))))
    shares = [float(c[x >= lowest].sum() / c.sum()) if len(c) else 0.0 for x, c in (held[MEASURE, 1], held[MEASURE, 0])]
    return replace(net, temperature=temperature, threshold=threshold, recall=shares[0], false_rate=shares[1])


def train(docs: DataFrame, text_col: str = "text", block: int = 2048, rounds: int = 16, seed: int = 7) -> Net:
    """Learns from all different windows of labelled candidates, in blocks of about ``block`` examples.

    All texts are looked through, once. A task holds a block, the driver a network and
    counts; so neither grows with the table.
    """
    net = Net.fresh(seed)
    with run_folder(docs.sparkSession):
        found = cut(_windows(docs, text_col), "secret-windows")
        size = {r["label"]: r["count"] for r in found.groupBy("label").count().collect()}
        others, own = size.get(0, 0), size.get(1, 0)
        if not others:
            return net  # no context to learn in
        copies = -(-MADE // others)
        learnt = 0.6 * (others * (1 + copies) + 2 * (own + others * copies))
        blocks = cut(_blocks(found, copies, max(1, round(learnt / block))), "secret-examples")
        learn, rest = blocks.where(F.col("use") == LEARN), blocks.where(F.col("use") != LEARN)
        good, n = learn.agg(F.sum(F.size(F.filter("rows", lambda r: r["label"] == 1))), F.sum(F.size("rows"))).first()
        if not good or good == n:
            return net
        weights = np.array([0.5 * n / (n - good), 0.5 * n / good])
        vector = net.vector({})
        for number in range(rounds):
            vector = _round(learn, net, vector, number, weights)
        net, _ = net.restored(vector)
        return calibrated(net, _held_out(rest, net))


def scan(docs: list[str], net: Net) -> Iterator[list[tuple[int, int, str]]]:
    """All spans of each text, by start and then kind."""
    for i in range(0, len(docs), 256):
        some: list[list[tuple[int, int, str]]] = []
        where: list[tuple[int, int, int]] = []

        def pieces() -> Iterator[tuple[int, np.ndarray]]:
            for text in docs[i : i + 256]:  # noqa: B023
                flat = narrow(text)
                base = base_spans(text, flat)
                some.append(base)  # noqa: B023
                for s, e, _ in other_candidates(flat, base):
                    where.append((len(some) - 1, s, e))  # noqa: B023
                    yield from ((len(where) - 1, w) for w in windows(flat, s, e))  # noqa: B023

        found = set()
        for block in itertools.batched(pieces(), BLOCK):
            over = net.probability(np.array([w for _, w in block], dtype=np.int64)) >= net.threshold
            found |= {k for (k, _), yes in zip(block, over, strict=True) if yes}
        for k in sorted(found):
            d, s, e = where[k]
            some[d].append((s, e, "net"))
        yield from (sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]))) for spans in some)


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for s, e, kind in spans)


def findings(docs: DataFrame, net: Net, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, spans array<struct<start, end, kind>>)`` for every row."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        spans = [[{"start": s, "end": e, "kind": k} for s, e, k in x] for x in scan(texts(batch, "text"), net)]
        return pa.record_batch([batch.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, one, "doc_id long, spans array<struct<start: long, end: long, kind: string>>")


def blank(text: str, spans: list[tuple[int, int, str]], mask: str) -> str:
    """The text with every span (overlapping ones together) replaced by the mask."""
    out, at = [], 0
    for s, e, _ in spans:
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, net: Net, text_col: str = "text", length_col: str | None = "n_chars", mask: str = "[SECRET]") -> DataFrame:
    """All rows and columns, with findings masked in the text and the length column renewed."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        before = texts(batch, text_col)
        spans = list(scan(before, net))
        if not any(spans):
            return batch
        after = [blank(t, x, mask) if x else t for t, x in zip(before, spans, strict=True)]
        columns = {n: batch.column(n) for n in batch.schema.names}
        columns[text_col] = pa.array([None if old is None else t for old, t in zip(batch.column(text_col).to_pylist(), after, strict=True)], pa.string())
        if length_col in columns:
            kind = columns[length_col].type
            columns[length_col] = pa.array([len(t) if x else old for t, x, old in zip(after, spans, columns[length_col].to_pylist(), strict=True)], kind)
        return pa.record_batch(list(columns.values()), list(columns))

    return map_batches(docs, one, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    spans = findings(docs, train(docs)).select("doc_id", F.col("spans").alias("s"))
    count = lambda kind: F.size(F.filter("s", lambda x: x["kind"] == kind)).cast("long")
    join = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("s", lambda x: x["kind"] != "net")
    return spans.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"), F.sha2(join(base).cast("binary"), 256).alias("base_sha256"), join(F.col("s")).alias("spans"))
