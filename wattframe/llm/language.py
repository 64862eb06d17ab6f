"""Language by the nearest centroid of character n-grams.

A document is a normalised TF-IDF vector of hashed letter n-grams. Each language has several
centroids, the clusters of a bounded sample of its labelled documents. A document belongs to the
language of the centroid with the highest cosine, and is rejected when even that one is farther than
documents of its length ever are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.llm.tables import in_slices, texts, unit_interval

UNDETERMINED = "und"
DIMENSIONS = 1 << 13
GRAMS = (1, 2, 3)
#: Labelled documents per language that a model is fitted on, in expectation.
PER_LANGUAGE = 800
CLUSTERS, ROUNDS = 3, 12
#: A document is rejected below this part of the lowest hundredth of the sample's cosines.
SLACK = 0.5
#: Sample documents of about one length that a bound needs. Without, that of shorter documents holds,
#: which are less like any centroid; without any, nothing is rejected.
LEAST_FOR_BOUND = 30

_LETTER = re.compile(r"[^\W\d_]")
_SPACE = 32


def _letters(text: str) -> np.ndarray:
    """Lower-case code points; whatever is no letter or mark becomes a space, runs of them one."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    other = (points < 0xAA) & ~((points >= 97) & (points <= 122))
    other |= (points >= 0x2000) & (points <= 0x206F) | (points >= 0x3000) & (points <= 0x303F)
    other |= (points == 0xAB) | (points == 0xB7) | (points == 0xBB) | (points == 0xBF) | (points == 0xB0)
    points = np.where(other, np.uint32(_SPACE), points)
    points = np.concatenate([[_SPACE], points, [_SPACE]]).astype(np.uint64)
    again = np.zeros(len(points), bool)
    again[1:] = (points[1:] == _SPACE) & (points[:-1] == _SPACE)
    return points[~again]


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed dimensions and counts of all letter n-grams of the whole text."""
    points = _letters(text)
    shift = np.uint64(64 - 13)
    found = []
    for size in GRAMS:
        if len(points) < size:
            continue
        key = np.full(len(points) - size + 1, size, np.uint64)
        for i in range(size):
            key = key * np.uint64(0x100000001B3) + points[i : len(points) - size + 1 + i]
        key = key * np.uint64(0x9E3779B97F4A7C15)
        if size == 1:
            key = key[points != _SPACE]
        found.append(key >> shift)
    counts = np.bincount(np.concatenate(found).astype(np.int64), minlength=1) if found else np.zeros(1)
    at = np.flatnonzero(counts)
    return at, counts[at]


@dataclass
class Model:
    """Bounded by languages, clusters and dimensions. ``bounds``: cosine by length class."""

    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    bounds: np.ndarray

    def nearest(self, text: str) -> tuple[str, float, bool]:
        """Language, cosine, and whether the text is rejected."""
        if not self.languages or not _LETTER.search(text):
            return UNDETERMINED, 0.0, True
        at, counts = gram_counts(text)
        weights = (1 + np.log(counts)) * self.idf[at]
        length = float(np.sqrt(weights @ weights))
        if length == 0:
            return self.languages[int(self.owner[0])], 0.0, True
        cosines = self.centroids[:, at] @ weights / length
        best = int(cosines.argmax())
        score = min(max(float(cosines[best]), 0.0), 1.0)
        return self.languages[int(self.owner[best])], score, score < self.bounds[_length_class(counts)]


def _length_class(counts: np.ndarray) -> int:
    return min(int(counts.sum()).bit_length(), 40)


def _clusters(vectors: np.ndarray) -> np.ndarray:
    """Spherical k-means; the first centre is the mean's nearest, the next ones the farthest."""
    centres = vectors[[int((vectors @ vectors.mean(axis=0)).argmax())]]
    while len(centres) < min(CLUSTERS, len(vectors)):
        nearest = (vectors @ centres.T).max(axis=1)
        centres = np.vstack([centres, vectors[int(nearest.argmin())]])
    for _ in range(ROUNDS):
        own = (vectors @ centres.T).argmax(axis=1)
        for i in range(len(centres)):
            members = vectors[own == i]
            if len(members):
                mean = members.sum(axis=0)
                centres[i] = mean / max(np.sqrt(mean @ mean), 1e-12)
    return centres


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches):
        found = [gram_counts(text) for text in batch.column(1).to_pylist()]
        columns = [
            batch.column(0),
            pa.array([at.astype(np.int16) for at, _ in found], pa.list_(pa.int16())),
            pa.array([counts.astype(np.int32) for _, counts in found], pa.list_(pa.int32())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "at", "counts"])


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from ``doc_id, text, lang``; rows without language or letters teach nothing.

    A hash of the identifier chooses about ``per_language`` documents of each language, whole texts,
    and only their sparse n-gram counts come to the driver.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    # One row per language: a constant of the filter, so that no text is moved by its language.
    counts = [F.lit(x) for row in rows.groupBy("lang").count().collect() for x in row]
    documents = F.create_map(*counts)[F.col("lang")] if counts else F.lit(0)
    chosen = unit_interval(F.lit("language"), F.col("doc_id").cast("string"))
    found = (
        rows.where(F.col("text").rlike(r"\p{L}"))
        .where(chosen * documents < per_language)
        .select("lang", "text")
        .mapInArrow(_counted, "lang string, at array<smallint>, counts array<int>")
        .toArrow()  # numbers, not Python objects: the driver's memory stays small
    )
    at, counts = (found[name].combine_chunks() for name in ("at", "counts"))
    sample = [
        (lang, at[i].values.to_numpy().astype(np.int32), counts[i].values.to_numpy())
        for i, lang in enumerate(found["lang"].to_pylist())
    ]
    sample.sort(key=lambda row: (row[0], row[1].tobytes(), row[2].tobytes()))
    languages = sorted({row[0] for row in sample})
    if not languages:
        empty = np.zeros((0, DIMENSIONS), np.float32)
        return Model([], np.zeros(DIMENSIONS, np.float32), empty, np.zeros(0, int), np.zeros(41))
    with_gram = np.zeros(DIMENSIONS)
    for _, at, _ in sample:
        with_gram[at] += 1
    idf = np.log((1 + len(sample)) / (1 + with_gram)).astype(np.float32) + np.float32(0.05)
    centroids, owner = [], []
    cosines: dict[int, list[float]] = {}
    for i, language in enumerate(languages):
        own = [row[1:] for row in sample if row[0] == language]
        vectors = np.zeros((len(own), DIMENSIONS), np.float32)
        for vector, (at, counts) in zip(vectors, own):
            vector[at] = (1 + np.log(counts)) * idf[at]
            vector /= max(np.sqrt(vector @ vector), 1e-12)
        centres = _clusters(vectors)
        centroids.append(centres)
        owner += [i] * len(centres)
        for (_, counts), cosine in zip(own, (vectors @ centres.T).max(axis=1)):
            cosines.setdefault(_length_class(counts), []).append(float(cosine))
    bounds = np.zeros(41)
    for length in range(1, 41):
        found = cosines.get(length, [])
        enough = len(found) >= LEAST_FOR_BOUND
        bounds[length] = SLACK * float(np.quantile(found, 0.01)) if enough else bounds[length - 1]
    return Model(languages, idf, np.vstack(centroids), np.array(owner), bounds)


def _predicted(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found = [model.nearest(text) for text in batch.column(1).to_pylist()]
            columns = [
                batch.column(0),
                pa.array([lang for lang, _, _ in found], pa.string()),
                pa.array([score for _, score, _ in found], pa.float64()),
                pa.array([rejected for _, _, rejected in found], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "rejected"])

    return run


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every row of ``docs``, by the text alone; no shuffle.

    NULL, empty and letterless texts are ``und`` with score 0 and rejected, as is everything if the
    model learned no language. Texts of any length are read whole. Identifiers pass through; other
    columns are ignored; equal similarity goes to the first language by name.
    """
    return texts(docs, id_col, text_col).mapInArrow(
        _predicted(model), "doc_id long, lang_pred string, score double, rejected boolean"
    )


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from; a NULL identifier is in neither fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def keep_determined(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, with all their columns as they are.

    The rows are judged where they stand: no shuffle, so no identifier has to be unique.
    """
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found = batch.column("text").to_pylist()
            fine = [not model.nearest(text or "")[2] for text in found]
            yield batch.filter(pa.array(fine, pa.bool_()))

    return docs.mapInArrow(run, schema)
