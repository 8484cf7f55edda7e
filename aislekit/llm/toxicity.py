"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary
text.  Every text is cut into windows of two words; a window that the toxic
dictionary compresses shorter than the ordinary one speaks for toxicity.
The counts of windows per difference are calibrated on labelled rows into a
score from 0 to 1 (0.5 is the decision threshold).

Windows start with a fixed carrier that both dictionaries hold.  Without it
zstandard stores such short inputs raw and the length says nothing.

Training takes a bounded sample of labelled rows (``per_class``, by a hash of
the id); scoring covers every window of every text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislekit.llm._common import small_batches

CARRIER = b"\x00\x01\x02\x03" * 4 + b"\x04\x05\x06\x07"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
GRAM = 6
GAINS = 8  # differences 1..8 bytes have a feature each


def windows(text: str | None, width: int = 2) -> list[bytes]:
    """Windows of ``width`` words, each behind the carrier; at least one, also without text."""
    w = WORD.findall((text or "").lower().encode())
    return [CARRIER + b" " + b" ".join(w[i:i + width]) + b" " for i in range(0, len(w), width)] or [CARRIER]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=17, chain_log=17, search_log=6, min_match=4, target_length=999,
        strategy=zstandard.STRATEGY_DFAST, write_content_size=False, write_dict_id=False, write_checksum=False)
    kind = zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content, dict_type=kind),
                                    compression_params=params)


def _train(samples: list[bytes], size: int) -> bytes:
    """Content of a trained dictionary; too few samples make their own dictionary."""
    joined = [b"".join(samples[i:i + 20]) for i in range(0, len(samples), 20)]
    try:
        return zstandard.train_dictionary(size + 4096, joined).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def train_dictionaries(toxic: list[str], ordinary: list[str], toxic_size: int, ordinary_size: int,
                       min_docs: int, min_ratio: float) -> tuple[bytes, bytes]:
    """The two dictionaries.

    The toxic one is trained on the words of toxic texts that hold a telling
    gram: ``GRAM`` bytes (or a whole shorter word) that occur in ``min_docs``
    different toxic texts (1 in 50 if that is fewer) and ``min_ratio`` times
    more often there than in ordinary texts; what both kinds share cannot
    tell them apart.
    """
    def own(text: str) -> list[bytes]:
        return sorted({b" " + w + b" " for w in WORD.findall(text.lower().encode())})

    def grams(word: bytes) -> set[bytes]:
        return {word[i:i + GRAM] for i in range(max(1, len(word) - GRAM + 1))}

    pos, neg = [own(t) for t in dict.fromkeys(toxic)], [own(t) for t in dict.fromkeys(ordinary)]
    in_pos = Counter(g for d in pos for g in set().union(*map(grams, d)))
    in_neg = Counter(g for d in neg for g in set().union(*map(grams, d)))
    least = max(2, min(min_docs, len(pos) // 50))
    telling = {g for g, c in in_pos.items()
               if c >= least and c * max(1, len(neg)) > min_ratio * (in_neg.get(g, 0) + 0.5) * len(pos)}
    return (_train([w for d in pos for w in d if not telling.isdisjoint(grams(w))], toxic_size) + CARRIER,
            _train([w for d in neg for w in d], ordinary_size) + CARRIER)


def features(text: str | None, toxic: zstandard.ZstdCompressor, ordinary: zstandard.ZstdCompressor) -> list[float]:
    """Counts and shares of windows by bytes gained, the best gains, the mean gain, the length."""
    a, b = toxic.compress, ordinary.compress
    gain = np.array([len(b(w)) - len(a(w)) for w in windows(text)])
    over = np.array([(gain >= k).sum() for k in range(1, GAINS + 1)])
    top = np.sort(gain)[::-1]
    return [*np.log1p(over), *(over / len(gain)), top[0], top[:3].mean(), top[:10].mean(), gain.mean(),
            np.log(len(gain))]


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weighted ridge logistic regression; rows of the result: mean, scale and coefficient of each feature."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        w += np.linalg.solve(h, z.T @ (weight * (y - p)) - ridge * w)
    return np.vstack([np.r_[mean, 0], np.r_[scale, 1], w])


def fit(toxic: list[str], ordinary: list[str], ordinary_total: int | None = None, toxic_size: int = 2048,
        ordinary_size: int = 65536, min_docs: int = 20, min_ratio: float = 20.0):
    """Model (toxic content, ordinary content, calibration) from labelled texts.

    Ordinary texts count ``ordinary_total / len(ordinary)`` times each when
    they are a sample.  Without both classes there is no model: None.
    """
    if not toxic or not ordinary:
        return None
    t, o = train_dictionaries(toxic, ordinary, toxic_size, ordinary_size, min_docs, min_ratio)
    a, b = _compressor(t), _compressor(o)
    x = np.array([features(s, a, b) for s in [*toxic, *ordinary]])
    y = np.r_[np.ones(len(toxic)), np.zeros(len(ordinary))]
    up = max(1.0, (ordinary_total or 0) / len(ordinary))
    return t, o, calibrate(x, y, np.r_[np.ones(len(toxic)), np.full(len(ordinary), min(up, 4.0))])


def scores(texts: list[str | None], model) -> list[float]:
    """Score of each text; 0 without a model."""
    if model is None:
        return [0.0] * len(texts)
    t, o, (mean, scale, w) = model
    a, b = _compressor(t), _compressor(o)
    out = []
    for s in texts:
        z = (np.r_[features(s, a, b), 1.0] - mean) / scale
        out.append(float(1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))))
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int, folds: int = 5):
    """At most ``per_class`` training texts of each class, and the class totals.

    Training rows: crc32 of the id's text modulo ``folds`` is not 0.  A row
    without id, text or label trains nothing; an id with several labels
    counts as toxic if any says so.
    """
    lab = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("__y"))
    train = lab.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != 0)
    totals = {r["__y"]: r["count"] for r in train.groupBy("__y").count().collect()}
    # the ids are picked before any text is read
    picked = None
    for y in (0, 1):
        side = train.where(F.col("__y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = side if picked is None else picked.union(side)
    rows = (docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
            .groupBy("doc_id").agg(F.max("__y").alias("y"), F.min("text").alias("text")).where("text is not null"))
    return rows, totals


def train(docs: DataFrame, labels: DataFrame, per_class: int = 2000, max_text: int = 200_000):
    """Fit the model on a bounded sample of labelled rows.

    ``per_class`` rows of each class bound the sample; of those, texts over
    ``max_text`` characters are left out of training (never of scoring).
    The sample, at most 2 * per_class texts, is fitted on the driver.
    """
    rows, totals = labelled_sample(docs, labels, per_class)
    got = sorted(((r["doc_id"], r["y"], r["text"])
                  for r in rows.where(F.length("text") <= max_text).toLocalIterator()))
    return fit([t for _, y, t in got if y], [t for _, y, t in got if not y], totals.get(0))


def score(docs: DataFrame, model, text: str = "text", name: str = "toxicity_score") -> DataFrame:
    """``docs`` with the score added as ``name`` (a column of that name is replaced).

    Null and empty texts have one window, the bare carrier.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop(name)
    out = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                got = scores(part.column(at).to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got, pa.float64())],
                                                 names=[*part.schema.names, name])

    return docs.mapInArrow(run, out)


def op7_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = 2000) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = train(docs, labels, per_class)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0).alias("held_out"),
        F.col("toxicity_score").alias("score"),
        (F.col("toxicity_score") >= 0.5).cast("int").alias("predicted"))
