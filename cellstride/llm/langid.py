"""Language of a text by string kernels: n-gram presence, Nyström landmarks, one-versus-rest ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import common

ORDERS = (1, 2, 3)
#: Buckets of the hashed n-grams.
WIDTH = 1 << 15
UNKNOWN = "und"
NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
LETTER = regex.compile(r"\p{L}")
BATCH = 64


def presence(text: str | None) -> np.ndarray | None:
    """Which n-grams of letters occur in the whole text, case and other characters aside; None without a letter."""
    if not text or not LETTER.search(text):
        return None
    plain = " " + NOT_LETTERS.sub(" ", text.lower()).strip(" ") + " "
    codes = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out, rolled = np.zeros(WIDTH, bool), np.zeros(len(codes), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        rolled = rolled[:len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1:] + np.uint64(n)
        if n in ORDERS:
            grams = rolled[codes != ord(" ")] if n == 1 else rolled
            mixed = grams ^ (grams >> np.uint64(31))
            out[((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(49)).astype(np.int64)] = True
    return out


@dataclass
class Model:
    """Landmarks (presence rows), their sizes, and weights that turn kernel values into one score a language."""
    languages: list[str]
    landmarks: np.ndarray
    sizes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def kernel(self, rows: np.ndarray) -> np.ndarray:
        """Shared n-grams over the geometric mean of both counts, for a batch of presence rows."""
        own = rows.sum(1).astype(np.float64)
        return (rows.astype(np.float32) @ self.landmarks.T).astype(np.float64) / np.sqrt(
            np.maximum(own, 1)[:, None] * self.sizes)


def fit(rows: np.ndarray, labels: list[str], landmarks_per_language: int = 48, ridge: float = 1e-2) -> Model:
    """Nyström kernel ridge regression: features K(x, landmarks) K(landmarks)^-1/2, targets 1 and -1 per language."""
    languages = sorted(set(labels))
    y = np.array([languages.index(x) for x in labels])
    chosen = np.concatenate([np.flatnonzero(y == i)[:landmarks_per_language] for i in range(len(languages))])
    marks = rows[chosen].astype(np.float32)
    model = Model(languages, marks, np.maximum(marks.sum(1).astype(np.float64), 1), None, None)
    values, vectors = np.linalg.eigh(model.kernel(rows[chosen]))
    keep = values > 1e-8 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    x = np.concatenate([model.kernel(rows[i:i + 512]) for i in range(0, len(rows), 512)]) @ root
    target = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)
    mean, level = x.mean(0), target.mean(0)
    solved = np.linalg.solve((x - mean).T @ (x - mean) + ridge * len(x) * np.eye(x.shape[1]) / 100,
                             (x - mean).T @ (target - level))
    model.weights, model.bias = root @ solved, level - mean @ solved
    return model


def train(df: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id",
          sample_per_language: int = 500, landmarks_per_language: int = 48, seed: int = 42) -> Model | None:
    """Fit on a bounded sample of the labelled rows: ``sample_per_language`` rows of each label, chosen by a hash.

    Rows with a null label or without a letter teach nothing; None if no row is left.  Only the sample's presence
    bits reach the driver, never texts.
    """
    label = F.col(f"`{label_col}`").cast("string")
    rows = df.where(label.isNotNull()).select(
        label.alias("label"), F.col(f"`{text_col}`").cast("string").alias("text"),
        F.pmod(F.xxhash64(F.lit(seed), F.col(f"`{id_col}`")), F.lit(1 << 40)).alias("place"))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not counts:
        return None
    within = F.lit(False)
    for name, n in counts.items():
        share = min(1.0, 2.0 * sample_per_language / n)
        within = within | ((F.col("label") == name) & (F.col("place") < int(share * (1 << 40)) + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [presence(x.as_py()) for x in batch.column("text")]
            packed = pa.array([None if b is None else np.packbits(b).tobytes() for b in bits], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("place"), packed],
                                             ["label", "place", "bits"])

    found = rows.where(within).mapInArrow(run, "label string, place bigint, bits binary").where("bits is not null")
    sample = sorted(found.collect(), key=lambda r: (r["label"], r["place"], r["bits"]))
    taken, kept = {}, []
    for r in sample:
        taken[r["label"]] = taken.get(r["label"], 0) + 1
        if taken[r["label"]] <= sample_per_language:
            kept.append(r)
    if not kept:
        return None
    bits = np.stack([np.unpackbits(np.frombuffer(r["bits"], np.uint8)).astype(bool) for r in kept])
    return fit(bits, [r["label"] for r in kept], landmarks_per_language)


def predict(df: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``df`` with lang_pred, score (0 to 1) and support (largest kernel value to a landmark) of each whole text.

    A text that is null or has no letter gets ``und``, score and support 0, as every text does without a
    model.  A text without any known n-gram has support 0.  Columns of ``df`` with these names are replaced.
    """
    kept = common.without(df, "lang_pred", "score", "support")
    names = kept.columns
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                bits = [presence(x.as_py()) if m else None for x in part.column("__text")]
                known = [i for i, b in enumerate(bits) if b is not None]
                lang, score, support = [UNKNOWN] * len(bits), np.zeros(len(bits)), np.zeros(len(bits))
                if known:
                    k = m.kernel(np.stack([bits[i] for i in known]))
                    f = k @ m.weights + m.bias
                    best = f.argmax(1)
                    score[known] = np.clip((f[np.arange(len(best)), best] + 1) / 2, 0, 1)
                    support[known] = k.max(1)
                    for i, b in zip(known, best):
                        lang[i] = m.languages[b]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in names], pa.array(lang, pa.string()), pa.array(score), pa.array(support)],
                    [*names, "lang_pred", "score", "support"])

    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("support", T.DoubleType())])
    return df.select(*[F.col(f"`{n}`") for n in names],
                     F.col(f"`{text_col}`").cast("string").alias("__text")).mapInArrow(run, schema)


def train_on_documents(docs: DataFrame) -> Model | None:
    """The model of the documents table, from rows whose id falls in three of four hash classes."""
    return train(docs.where(common.crc_bucket("doc_id", 4) != 2))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = docs.select("doc_id", (common.crc_bucket("doc_id", 4) == 2).alias("held_out"), "text")
    return predict(held, train_on_documents(docs)).drop("text")
