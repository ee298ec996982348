"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's
probability under a language is the sum, over all ways to cut it into pieces, of the
product of their probabilities: a forward algorithm over the word's positions. A text's
log-probability is the sum over its words. Piece probabilities are learned by
expectation maximisation with the same sums (forward and backward), from word counts of
a bounded sample of labelled rows.

Defined results: ``und`` with score 0 for a null text and for one without a letter;
letters of scripts that the vocabulary lacks count as one unknown piece each; words over
``PART`` characters are scored in parts; ties go to the alphabetically first language;
with no labelled row everything is ``und``; repeated rows repeat, and texts alike are one
when the sample is taken; an empty table gives an empty result. Whole texts are read. Extra columns are kept
by ``identified`` and not read by ``predictions``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hostweave.llm.common import documents, map_batches, texts

WORD = re.compile(r"[^\W\d_]+")
PART = 24
#: Words that a worker remembers; beyond, it starts afresh (results don't change).
MAX_WORDS = 300_000


def vocabulary(path: str) -> list[str]:
    """The ordinary pieces of a public sentencepiece model, with their word-start marks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


class Trie:
    """Pieces as a trie in sorted arrays, walked for many words at a time."""

    def __init__(self, index: dict[str, int]) -> None:
        chars = sorted({c for piece in index for c in piece})
        self.chars = np.array([ord(c) for c in chars], dtype=np.int64)
        self.width = len(chars) + 1
        number = {c: i for i, c in enumerate(chars)}
        steps: dict[int, int] = {}
        at = [0]
        for piece, row in index.items():
            node = 0
            for c in piece:
                node = steps.setdefault(node * self.width + number[c], len(at))
                if node == len(at):
                    at.append(0)
            at[node] = row
        self.piece = np.array(at, dtype=np.int64)
        self.keys = np.array(sorted(steps), dtype=np.int64)
        self.nodes = np.array([steps[k] for k in self.keys.tolist()], dtype=np.int64)

    def codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Characters by word and place (``width - 1``: in no piece), and lengths."""
        length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        at = np.searchsorted(self.chars, points)
        code = np.where(self.chars[np.minimum(at, len(self.chars) - 1)] == points, at, self.width - 1) if len(self.chars) else np.zeros(len(points), np.int64)
        table = np.full((len(words), int(length.max(initial=0))), self.width - 1, dtype=np.int64)
        table[np.arange(table.shape[1]) < length[:, None]] = code
        return table, length

    def pieces(self, words: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``(start, end, words, pieces)`` in order of start; a character in no piece of its own is piece 0."""
        table, length = self.codes(words)
        for s in range(table.shape[1]):
            rows = np.flatnonzero(length > s)
            node = np.zeros(len(rows), dtype=np.int64)
            for e in range(s + 1, table.shape[1] + 1):
                key = node * self.width + table[rows, e - 1]
                at = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
                hit = self.keys[at] == key if len(self.keys) else np.zeros(len(rows), bool)
                if e == s + 1:
                    piece = np.where(hit, self.piece[self.nodes[at]] if len(self.keys) else 0, 0)
                    yield s, e, rows, piece
                    rows, node = rows[hit], self.nodes[at[hit]]
                else:
                    rows, node = rows[hit], self.nodes[at[hit]]
                    piece = self.piece[node]
                    if (full := piece > 0).any():
                        yield s, e, rows[full], piece[full]
                more = length[rows] > e
                rows, node = rows[more], node[more]
                if not len(rows):
                    break

    def forward(self, words: list[str], p: np.ndarray) -> np.ndarray:
        """Probability of each word under each language, over all segmentations."""
        longest = max(map(len, words), default=0)
        alpha = np.zeros((longest + 1, len(words), p.shape[1]))
        alpha[0] = 1
        for s, e, rows, piece in self.pieces(words):
            alpha[e, rows] += alpha[s, rows] * p[piece]
        return alpha[np.fromiter(map(len, words), dtype=np.int64, count=len(words)), np.arange(len(words))]

    def expected(self, words: list[str], weight: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in words of the given counts (one language)."""
        length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        steps = list(self.pieces(words))
        alpha = np.zeros((int(length.max(initial=0)) + 1, len(words)))
        beta = np.zeros_like(alpha)
        alpha[0] = 1
        for s, e, rows, piece in steps:
            alpha[e, rows] += alpha[s, rows] * p[piece]
        beta[length, np.arange(len(words))] = 1
        for s, e, rows, piece in reversed(steps):
            beta[s, rows] += beta[e, rows] * p[piece]
        share = weight / np.maximum(alpha[length, np.arange(len(words))], 1e-300)
        out = np.zeros(len(p))
        for s, e, rows, piece in steps:
            out += np.bincount(piece, alpha[s, rows] * p[piece] * beta[e, rows] * share[rows], minlength=len(p))
        return out


def parts(word: str) -> list[str]:
    word = "▁" + word
    return [word[i : i + PART] for i in range(0, len(word), PART)]


class _Numbers(dict):
    """Words to numbers; new words are noted."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        n = self[word] = len(self)
        return n


class Model:
    """Piece probabilities ``p[piece, language]``; remembers the scores of words seen."""

    def __init__(self, languages: list[str], index: dict[str, int], p: np.ndarray) -> None:
        self.languages, self.index, self.p = languages, index, p
        self.trie = Trie(index)
        self._forget()

    def __reduce__(self) -> tuple:
        return Model, (self.languages, self.index, self.p)

    def _forget(self) -> None:
        self._known, self._scores = _Numbers(), np.zeros((0, len(self.languages)))

    def word_scores(self, words: list[str], block: int = 8192) -> np.ndarray:
        """Log-probability of each word under each language."""
        cut = [parts(w) for w in words]
        flat = [x for c in cut for x in c]
        scores = [np.zeros((0, len(self.languages)))]
        for i in range(0, len(flat), block):
            scores.append(np.log(np.maximum(self.trie.forward(flat[i : i + block], self.p), 1e-300)))
        flat_scores = np.concatenate(scores)
        if len(flat) == len(words):
            return flat_scores
        return np.add.reduceat(flat_scores, np.r_[0, np.cumsum([len(c) for c in cut])[:-1]], axis=0)

    def predict(self, docs: list[str], batch: int = 500) -> list[tuple[str, float]]:
        """Language and posterior probability (languages equally likely beforehand)."""
        out = []
        for i in range(0, len(docs), batch):
            if len(self._known) > MAX_WORDS:
                self._forget()
            number, some = self._known.__getitem__, []
            for text in docs[i : i + batch]:
                words = WORD.findall(text.lower())
                letters = bool(self.languages) and any(c.isalpha() for w in words for c in w)
                some.append(np.fromiter(map(number, words), dtype=np.int64, count=len(words)) if letters else None)
            if self._known.new:
                self._scores = np.concatenate([self._scores, self.word_scores(self._known.new)])
                self._known.new.clear()
            for words in some:
                if words is None:
                    out.append(("und", 0.0))
                    continue
                total = self._scores[words].sum(axis=0)
                best = int(total.argmax())
                out.append((self.languages[best], float(1 / np.exp(np.minimum(total - total[best], 0)).sum())))
        return out


def fit(counts: dict[str, Counter], pieces: list[str], rounds: int = 4, smoothing: float = 0.02) -> Model:
    """Piece probabilities of each language from its word counts."""
    index = {p: i for i, p in enumerate(sorted({p.lower() for p in pieces} - {""}), start=1)}
    languages = sorted(counts)
    p = np.full((len(index) + 1, len(languages)), 1.0 / (len(index) + 1))
    trie = Trie(index)
    for k, language in enumerate(languages):
        words, weights = [], []
        for word, n in sorted(counts[language].items()):
            for x in parts(word):
                words.append(x)
                weights.append(float(n))
        for _ in range(rounds):
            use = np.full(len(p), smoothing)
            for i in range(0, len(words), 4096):
                use += trie.expected(words[i : i + 4096], np.array(weights[i : i + 4096]), p[:, k])
            p[:, k] = use / use.sum()
    return Model(languages, index, p)


#: Up to so many languages the sample's keys, a row for each text that is taken, are broadcast.
FEW_LANGUAGES = 1000
#: Parts that a language's different texts are dealt to, so that a frequent language is not ranked in one task.
PARTS = 64


def sampled(rows: DataFrame, key: Column | None = None, per_language: int = 400, few: bool = False) -> DataFrame:
    """``(lang, text)``: of each language the ``per_language`` different texts whose keys' hashes are least.

    ``few`` tells that the languages are few, so that the keys of the sample have a bound.
    """
    mark = F.xxhash64(F.col("text") if key is None else key, F.lit("language sample"))
    rows = rows.select("lang", "text", F.xxhash64("text").alias("h"), mark.alias("mark"))
    texts_of = rows.groupBy("lang", "h").agg(F.min("mark").alias("mark"))
    texts_of = texts_of.withColumn("part", F.pmod("h", F.lit(PARTS)))
    for within in (["lang", "part"], ["lang"]):  # the least of a language are among the least of its parts
        turn = F.row_number().over(Window.partitionBy(*within).orderBy("mark", "h"))
        texts_of = texts_of.withColumn("turn", turn).where(F.col("turn") <= per_language).drop("turn")
    chosen = texts_of.select("lang", "h")
    return rows.join(F.broadcast(chosen) if few else chosen, ["lang", "h"], "left_semi").groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text")


def train(docs: DataFrame, pieces: list[str], use: Column, lang_col: str = "lang", text_col: str = "text", key: Column | None = None, per_language: int = 400) -> Model:
    """Learns from ``per_language`` different texts of each labelled language where ``use`` holds.

    The sample's bound is the documented limit of a classifier's training rows: of each
    labelled language, those texts are taken whose hashes of ``key`` (the text by default)
    are least, each once however many rows have it, and all texts of a language that has
    fewer.
    """
    rows = docs.where(use & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = rows.groupBy(F.col(lang_col).alias("lang")).count().collect()  # a row for each language
    if not sizes:
        return fit({}, pieces)
    named = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), *([] if key is None else [key.alias("key")]))
    sample = sampled(named, None if key is None else F.col("key"), per_language, len(sizes) <= FEW_LANGUAGES)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        tally = Counter((lang, w) for lang, text in zip(batch.column(0).to_pylist(), texts(batch, "text"), strict=True) for w in WORD.findall(text.lower()))
        langs, words = zip(*tally, strict=True) if tally else ((), ())
        return pa.record_batch([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(list(tally.values()), pa.int64())], ["lang", "word", "n"])

    counts: dict[str, Counter] = {r["lang"]: Counter() for r in sizes}
    for r in map_batches(sample, count, "lang string, word string, n long").groupBy("lang", "word").sum("n").toLocalIterator():
        counts[r[0]][r[1]] += r[2]
    return fit(counts, pieces)


_MODELS: dict[bytes, Model] = {}


def _own(packed: bytes) -> Model:
    """The worker's copy of a model, kept between tasks with the words it has scored."""
    import pickle

    if packed not in _MODELS:
        _MODELS.clear()
        _MODELS[packed] = pickle.loads(packed)
    return _MODELS[packed]


def _packed(model: Model) -> bytes:
    import pickle

    return pickle.dumps(model)


def predictions(docs: DataFrame, model: Model, keep: list[Column], text_col: str = "text") -> DataFrame:
    """The kept columns, ``lang_pred`` and ``score``."""
    packed = _packed(model)
    rows = docs.select(*keep, F.col(text_col).alias("_hw_text"))
    names = rows.columns[:-1]

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = _own(packed).predict(texts(batch, "_hw_text"))
        return pa.record_batch([*batch.columns[:-1], pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], [*names, "lang_pred", "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return map_batches(rows, one, f"{kinds}, lang_pred string, score double")


def identified(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows, all columns as they are, whose language is found with that posterior."""
    packed = _packed(model)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = _own(packed).predict(texts(batch, text_col))
        return batch.filter(pa.array([lang != "und" and score >= least for lang, score in found], pa.bool_()))

    return map_batches(docs, one, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = documents(spark, sf_dir)
    held = F.coalesce(held_out(), F.lit(False))
    model = train(docs, vocabulary(public_tokenizers.path("piece_bpe_32k.model")), ~held)
    return predictions(docs, model, [F.col("doc_id"), held.alias("held_out")])
