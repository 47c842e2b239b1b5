"""Quality by compression: zstandard dictionaries of good and bad text.

A dictionary is trained for each label on a bounded sample of labelled documents. Every
document is compressed in fixed blocks with either dictionary; the difference of the
compressed sizes, divided by the size of the text, says which kind of text the document
is made of. A logistic curve fitted on further labelled documents turns it into a score.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.text import DOCUMENT_COLUMNS, narrow, over_batches, text_key, texts

DICTIONARY_ROWS = 800  # labelled documents of each label for the dictionaries
CURVE_ROWS = 800  # and for the curve
LONGEST_SAMPLE = 64_000  # bytes; longer labelled documents are not sampled; 205 MB at most reach the driver
DICTIONARY_BYTES = 64_000
CHUNK = 2048
LEVEL = 3
STEPS = 60


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    intercept: float


@lru_cache(maxsize=4)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    kind = zstandard.DICT_TYPE_RAWCONTENT if dictionary[:4] != b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_AUTO
    trained = zstandard.ZstdCompressionDict(dictionary, dict_type=kind) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_content_size=False, write_checksum=False, write_dict_id=False)


def compressed_size(text: bytes, dictionary: bytes) -> int:
    """The whole text in blocks, so that the dictionary weighs as much at the end as at the start."""
    squeeze = _compressor(dictionary).compress
    return sum(len(squeeze(text[at : at + CHUNK])) for at in range(0, len(text), CHUNK))


def difference(text: bytes, good: bytes, bad: bytes) -> float:
    """Positive where the dictionary of good text fits better; 0 for an empty text."""
    return (compressed_size(text, bad) - compressed_size(text, good)) / len(text) if text else 0.0


def dictionary_of(samples: list[bytes]) -> bytes:
    """Trained where there is enough to train on, else the text itself; cut into blocks first."""
    parts = [s[at : at + CHUNK] for s in samples for at in range(0, len(s), CHUNK)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(parts)[-DICTIONARY_BYTES:]


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic fit by Newton steps with equal weight for both labels and a small ridge."""
    if len(set(y.tolist())) < 2:
        return 0.0, 0.0 if not len(y) else (4.0 if y[0] else -4.0)
    scale = float(np.std(x)) or 1.0
    design = np.stack([x / scale, np.ones(len(x))], axis=1)
    weight = np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean())
    beta = np.zeros(2)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - 1e-3 * beta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        beta = beta + np.linalg.solve(hessian, gradient)
    return float(beta[0] / scale), float(beta[1])


def held_out():
    """Rows never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame) -> list:
    """Labelled documents that may be learned from: the first of each label in hash order, a bounded
    number. Documents labelled both ways are left out."""
    one = (
        labels.filter(F.col("quality").isin(0, 1)).filter(~held_out())
        .groupBy(F.col("doc_id").cast("bigint").alias("_id"))
        .agg(F.min("quality").alias("_label"), F.max("quality").alias("_most")).filter("_label = _most")
    )
    first = [
        one.filter(F.col("_label") == label).orderBy(F.xxhash64("_id"), "_id").limit(DICTIONARY_ROWS + CURVE_ROWS)
        for label in (0, 1)
    ]
    chosen = F.broadcast(first[0].unionByName(first[1]).select("_id", "_label"))  # at most twice the bound
    rows = narrow(docs).filter(F.octet_length("text") <= LONGEST_SAMPLE)
    # one row for each id, however often it is repeated
    found = rows.join(chosen, rows["doc_id"] == chosen["_id"]).groupBy("_id", "_label").agg(F.min("text").alias("text"))
    return sorted(found.collect(), key=lambda r: (hash_order(r["_id"]), r["_id"]))


def hash_order(doc_id: int) -> int:
    """A fixed shuffle of the ids, so that the two uses of the sample do not follow the ids."""
    return (doc_id * 0x9E3779B97F4A7C15 + 0x7F4A7C15) % (1 << 61)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Without labels of both kinds every document gets the score of the kind there is, or 0.5."""
    by_label: dict[int, list[bytes]] = {0: [], 1: []}
    for row in _sample(docs, labels):
        by_label[row["_label"]].append(row["text"].encode())
    used = {k: len(v) // 2 for k, v in by_label.items()}
    good, bad = dictionary_of(by_label[1][: used[1]]), dictionary_of(by_label[0][: used[0]])
    rest = [(difference(t, good, bad), k) for k, v in by_label.items() for t in v[used[k] :]]
    slope, intercept = fit_curve(np.array([x for x, _ in rest]), np.array([y for _, y in rest]))
    return Model(good, bad, slope, intercept)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, text_key, score for every row; an empty or null text gets the curve's value at 0."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array([difference(t, model.good, model.bad) for t in texts(batch.column("text"))])
        score = 1 / (1 + np.exp(-np.clip(model.slope * x + model.intercept, -30, 30)))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(score)], names=["doc_id", "text_key", "score"]
        )

    rows = narrow(docs).withColumn("text_key", text_key())
    return over_batches(rows, work, "doc_id bigint, text_key bigint, score double")


def accepted_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with the columns of documents."""
    model = train(docs, labels)
    keep = [c for c in DOCUMENT_COLUMNS if c in docs.columns]
    rows = docs.select(*keep)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bodies = (t or b"" for t in texts(batch.column("text")))
        x = np.array([difference(t, model.good, model.bad) for t in bodies])
        return batch.filter(pa.array(model.slope * x + model.intercept >= 0))

    return over_batches(rows, work, rows.schema)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = scored(docs, train(docs, labels))
    return found.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
