"""Toxicity by compression distance: two zstandard dictionaries, window compression lengths, calibrated scores.

Texts (A-Z lower-cased) are cut into windows of ``WINDOW_WORDS`` words. Each window is compressed once with the ordinary and
once with the toxic dictionary; the bytes that the toxic one saves tell how toxic the window is. A logistic
function of how many windows save how much gives the score.

Each dictionary is trained on the texts of its own class only: as zstandard's trainer does, it takes the segments that save
most over all samples, here whole words, as passages do not repeat in text of this kind (with passages of zstandard's own
trainer, windows differ by which documents the passages came from). A word counts once for each text, and once where the same
word follows it, so that near copies of one text do not make a word frequent. It must stand in a ``SHARE`` of the texts; the
most frequent come last, where references are cheapest. The ordinary dictionary is larger and asks for a smaller share,
so that what is common in ordinary text costs nothing there.

Training takes a documented, bounded sample: at most ``MAX_TOXIC`` and ``MAX_ORDINARY`` labelled texts of the training
folds, those with the smallest hash of their doc_id, and of texts beyond ``TRAIN_BYTES`` pieces spread evenly over the text.
It runs in one task of an executor, and only the model reaches the driver. Calibration is cross-fitted over two halves of the
sample, as texts that a dictionary was made from say too much about themselves. The score of 0.7 lies where F1 is best among
cuts at which at least ``PRECISION`` of what is called toxic is (where none is, half of it).

Defined results: null and empty texts have one empty window and get the score of no saving; without toxic or without
ordinary training rows all scores are 0; duplicate labels of a doc_id count once (the largest), and of its rows one
text (the smallest); extra columns pass, also those named as ours.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import appended, free_names, named, released

WINDOW_WORDS = 1
#: Bytes of a dictionary, and the share of the texts that must hold each of its words.
TOXIC_BYTES, TOXIC_SHARE = 4_096, 0.02
ORDINARY_BYTES, ORDINARY_SHARE = 8_192, 0.005
#: Windows whose lengths a task remembers.
REMEMBERED = 16_384
MAX_TOXIC, MAX_ORDINARY = 3_000, 6_000
TRAIN_BYTES = 65_536
CUT, PRECISION = 0.7, 0.8
#: Savings in bytes whose windows are counted.
STEPS = np.arange(2, 7)
_STRIP = bytes(range(33, 48)) + b":;<=>?@[]^_`{|}~"


def _parameters() -> zstandard.ZstdCompressionParameters:
    return zstandard.ZstdCompressionParameters(window_log=17, chain_log=16, hash_log=15, search_log=7, min_match=6, target_length=64, strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS)


def windows(text: bytes) -> list[bytes]:
    words = text.lower().split()
    return [b" " + b" ".join(words[i : i + WINDOW_WORDS]) + b" " for i in range(0, len(words), WINDOW_WORDS)] or [b"  "]


def train_dictionary(texts: list[bytes], size: int, share: float) -> bytes:
    """The words in a ``share`` of ``texts`` that save most over them, within ``size`` bytes.

    The most frequent come last, words of about one frequency in the order of the alphabet: what both classes hold then lies at about
    one distance in both dictionaries, and costs the same.
    """

    def words_of(text: bytes) -> list[bytes]:
        return [w.strip(_STRIP) for w in text.lower().split()]

    held: Counter[bytes] = Counter()
    for t in texts:  # one text's words at a time
        held.update(set(words_of(t)))
    least = max(3, share * len(texts))
    places: dict[bytes, set[bytes]] = {w: set() for w, n in held.items() if n >= least}
    for words in map(words_of, texts):  # the first place of a word in a text
        first = {w: after for w, after in zip(reversed(words), [b"", *reversed(words)], strict=False) if w in places}
        for w, after in first.items():
            places[w].add(after)
    held = Counter({w: min(held[w], len(after)) for w, after in places.items()})
    chosen, total = [], 0
    for word, n in sorted(held.items(), key=lambda x: (-x[1] * (len(x[0]) - 2), x[0])):
        if n >= least and len(word) > 2:
            chosen.append((math.floor(2 * math.log2(n / len(texts))), b" " + word))
            total += len(word) + 1
            if total >= size:
                break
    return b"".join(word for _, word in sorted(chosen)).rjust(size, b"\0") + b" "


def train_both(ordinary: list[bytes], toxic: list[bytes]) -> tuple[bytes, bytes]:
    return train_dictionary(ordinary, ORDINARY_BYTES, ORDINARY_SHARE), train_dictionary(toxic, TOXIC_BYTES, TOXIC_SHARE)


@dataclass
class Model:
    """Dictionary contents and logistic weights; compressors are made in the process that scores."""

    ordinary: bytes = b""
    toxic: bytes = b""
    weights: tuple[float, ...] = ()
    shift: float = 0.0

    def scorer(self):
        if not self.weights:
            return lambda text: 0.0
        features = feature_maker(self.ordinary, self.toxic)

        def score(text: bytes) -> float:
            z = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], features(text), strict=True)) + self.shift
            return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))

        return score


def feature_maker(ordinary: bytes, toxic: bytes):
    parameters = _parameters()

    def compressor(content: bytes):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=parameters)
        return zstandard.ZstdCompressor(dict_data=d, compression_params=parameters).compress

    long, short = compressor(ordinary), compressor(toxic)

    @lru_cache(maxsize=REMEMBERED)
    def saving(window: bytes) -> int:
        return len(long(window)) - len(short(window))

    def features(text: bytes) -> tuple[float, ...]:
        saved = np.sort([saving(w) for w in windows(text)])
        n = len(saved)
        many = n - np.searchsorted(saved, STEPS)
        return (math.log1p(max(0, saved[-1])), math.log1p(max(0, saved[-4:].sum())), float(saved.mean()), *np.log1p(many).tolist(), *(many[1:4] / n).tolist(), math.log1p(n))

    return features


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Newton's method with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [1e-2] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _best_cut(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The value between two scores at which calling everything above it toxic has the best F1, PRECISION or half of it rightly."""
    order = np.argsort(-z, kind="stable")
    z, hit, called = z[order], np.cumsum((y * weight)[order]), np.cumsum(weight[order])
    f1 = 2 * hit / (called + (y * weight).sum())
    f1[:-1][z[:-1] == z[1:]] = 0  # equal scores fall on one side
    right = hit / called
    f1 = f1 * (right >= (PRECISION if ((right >= PRECISION) & (f1 > 0)).any() else 0.5))
    i = int(f1.argmax())
    if not f1[i]:
        return float(z[0]) + 1
    return float((z[i] + z[i + 1]) / 2) if i + 1 < len(z) else float(z[i]) - 1


def train(toxic: list[bytes], ordinary: list[bytes], ordinary_weight: float = 1.0) -> Model:
    """``ordinary_weight``: how many ordinary texts each of the sample stands for, against a toxic one."""
    toxic, ordinary = sorted(set(toxic)), sorted(set(ordinary))
    if len(toxic) < 2 or len(ordinary) < 2:
        return Model()
    x, y = [], []
    for side in (0, 1):  # by turns, so that either half has texts of all kinds
        features = feature_maker(*train_both(ordinary[1 - side :: 2], toxic[1 - side :: 2]))
        for label, texts in ((1, toxic[side::2]), (0, ordinary[side::2])):
            x += [features(t) for t in texts]
            y += [label] * len(texts)
    x, y = np.array(x), np.array(y, float)
    weight = np.where(y == 1, 1.0, ordinary_weight)
    weights = _logistic(x, y, weight)
    cut = _best_cut(weights[0] + x @ weights[1:], y, weight)
    return Model(*train_both(ordinary, toxic), tuple(weights.tolist()), math.log(CUT / (1 - CUT)) - cut)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def _sampled(text: str | None) -> bytes:
    """The text, or TRAIN_BYTES of it in pieces spread evenly."""
    raw = (text or "").encode()
    if len(raw) <= TRAIN_BYTES:
        return raw
    pieces = 16
    size, step = TRAIN_BYTES // pieces, len(raw) // pieces
    return b" ".join(raw[i * step : i * step + size] for i in range(pieces))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of a bounded sample of the labelled rows outside the held-out fold."""
    marks = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = {r.toxic: r["count"] for r in marks.groupBy("toxic").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = marks.filter("toxic = 1").orderBy(*order).limit(MAX_TOXIC).unionByName(marks.filter("toxic = 0").orderBy(*order).limit(MAX_ORDINARY))
    # MAX_TOXIC + MAX_ORDINARY ids at most
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))

    def learn(batches):
        texts: dict[int, list[bytes]] = {0: [], 1: []}
        for batch in batches:
            for label, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
                texts[label].append(_sampled(text))
        toxic, ordinary = texts[1], texts[0]
        weight = total.get(0, 0) / max(1, len(ordinary)) * len(toxic) / max(1, total.get(1, 0))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(toxic, ordinary, weight))])], ["model"])

    learned = rows.repartition(1).mapInArrow(released(learn), "model binary").first()
    return pickle.loads(learned["model"]) if learned else Model()


def score(docs: DataFrame, model: Model, score: str = "score", predicted: str = "predicted") -> DataFrame:
    """``docs`` with the columns ``score`` and ``predicted``, whose names must be free."""
    text = named(docs, "text")

    def make():
        own = model.scorer()

        def scores(batch):
            values = np.array([own(t or b"") for t in batch.column(text).cast(pa.binary()).to_pylist()], float)
            return [pa.array(values), pa.array((values >= CUT).astype(np.int32))]

        return scores

    return appended(docs, f"`{score}` double, `{predicted}` int", make)  # the model is two dictionaries, 12 KB


def remove_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that are predicted toxic."""
    names = free_names(docs, "score", "predicted")
    return score(docs, fit(docs, labels), *names).filter(F.col(names[1]) == 0).select(docs.columns)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract of op7."""
    return score(docs.select("doc_id", "text"), fit(docs, labels)).select("doc_id", held_out().alias("held_out"), "score", "predicted")
