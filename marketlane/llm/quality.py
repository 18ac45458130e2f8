"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

Terms are pairs of neighbouring bytes, hashed to a fixed number of dimensions,
with dampened counts and unit length.  The latent space is spanned by the leading
right singular vectors of the labelled sample; the sample is bounded, so it and
its projection are broadcast.  Every document is projected, its cosine products
with all labelled vectors are computed exactly, block by block, and the labels of
the nearest ones vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marketlane.llm.common import every_column, fold, plainly_named, slices, texts
from marketlane.llm.toxicity import labelled

FOLDS = 3
#: Remainder of the ids that are held out.
HELD = 1
#: Labelled rows the classifier is fitted on at most: those with the smallest hash of the id.
SAMPLE = 4000
TERMS = 4096
LATENT = 48
NEIGHBOURS = 25
#: Similarity counts by this power.
SHARPNESS = 8

PAIRS = ((np.arange(1 << 16, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 12)).astype(np.int64)


def term_vectors(docs: list[bytes]) -> np.ndarray:
    """Unit rows of dampened counts of byte pairs in whole texts; texts of fewer than two bytes are zero."""
    out = np.zeros((len(docs), TERMS), dtype=np.float32)
    for k, text in enumerate(docs):
        b = np.frombuffer(text, dtype=np.uint8).astype(np.uint16)
        if len(b) > 1:
            pairs = np.bincount((b[:-1] << np.uint16(8)) | b[1:], minlength=1 << 16)
            out[k] = np.log1p(np.bincount(PAIRS, weights=pairs, minlength=TERMS))
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def latent_space(rows: np.ndarray, width: int = LATENT) -> tuple[np.ndarray, np.ndarray]:
    """Mean and leading right singular vectors, by subspace iteration from a fixed start; ``rows`` are centred in place."""
    mean = rows.mean(axis=0)
    rows -= mean
    basis = np.random.default_rng(9).standard_normal((rows.shape[1], width), dtype=np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(rows.T @ (rows @ basis))
    return mean, basis


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return (rows / np.where(norm > 0, norm, 1)).astype(np.float32)


def vote(similarity: np.ndarray, labels: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Share of positive labels among the nearest, weighted by similarity; the plain share where none is similar."""
    k = min(neighbours, similarity.shape[1])
    nearest = np.argpartition(-similarity, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(similarity, nearest, axis=1), 0).astype(np.float64) ** SHARPNESS
    total = weight.sum(axis=1)
    return np.where(total > 1e-12, (weight * labels[nearest]).sum(axis=1) / np.where(total > 1e-12, total, 1), labels.mean())


def quality_rows(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with the column ``__score``: the vote for label 1 on each row's whole text, missing if nothing is labelled."""
    spark = docs.sparkSession
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    known = labelled(ids, labels.select("doc_id", label), label).where(fold(FOLDS) != HELD)
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # ids alone are ranked, texts follow
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    train = own.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("label").alias("label"))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            packed = [v.astype("<f2").tobytes() for v in term_vectors(texts(batch))]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column("label")], names=["v", "label"])

    rows = train.select("text", "label").mapInArrow(terms, "v binary, label double").collect()
    if rows:
        own = np.array([r["label"] for r in rows])
        vectors = np.empty((len(rows), TERMS), dtype=np.float32)
        while rows:  # one copy of the sample in memory, not three
            row = rows.pop()
            vectors[len(rows)] = np.frombuffer(row["v"], dtype="<f2")
        mean, basis = latent_space(vectors)
        model = spark.sparkContext.broadcast((mean, basis, unit(vectors @ basis), own))
    else:
        model = spark.sparkContext.broadcast(None)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            if model.value is None:
                scores = pa.nulls(batch.num_rows, pa.float64())
            else:
                mean, basis, neighbours, own = model.value
                scores = vote(unit((term_vectors(texts(batch)) - mean) @ basis) @ neighbours.T, own)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "__score"])

    plain = plainly_named(docs, "text")
    scored = plain.mapInArrow(score, plain.withColumn("__score", F.lit(None).cast("double")).schema)
    return scored.toDF(*docs.columns, "__score")


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs`` (``doc_id, text``).

    Learns from at most ``sample`` labelled rows whose ``crc32(doc_id) mod 3`` is
    not 1; those with remainder 1 are ``held_out``.  A missing or empty text is
    scored like any other, by its zero terms.  Labels other than 0 and 1 and
    labels without a document are left out; without labels every score is 0.
    Repeated rows give equal results; further columns are ignored.
    """
    rows = quality_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels, label, sample)
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce("__score", F.lit(0.0))))
    return rows.select(
        "doc_id", (fold(FOLDS) == HELD).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """``docs`` without the rows whose score is below a half; without labels nothing is rejected."""
    return quality_rows(docs, labels, label, sample).where("coalesce(__score, 1.0) >= 0.5").select(*every_column(docs))
