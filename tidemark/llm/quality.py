"""Quality by nearest-neighbour voting over latent-semantic vectors of byte patterns."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.common import pieces
from tidemark.llm.wordhash import LONG, joined_bytes, stretches, word_hashes

#: Labelled rows that vote: a bounded sample, and so the size of what is broadcast (about 1 MB).
VOTERS = 4096
NEIGHBOURS, RANK = 15, 64
#: Buckets of hashed byte triples, and kinds of characters, triples of which are counted too.
TRIPLES, KINDS = 2048, 6
WIDTH = TRIPLES + KINDS**3 + 3
BLOCKS = (slice(0, TRIPLES), slice(TRIPLES, TRIPLES + KINDS**3), slice(TRIPLES + KINDS**3, WIDTH))
ACCEPTED = 0.7


def _kind_table() -> np.ndarray:
    """Kinds of bytes: white space, lower case, upper case, digits, ASCII signs, bytes above ASCII."""
    kinds = np.full(256, 4, np.uint8)
    kinds[[9, 10, 11, 12, 13, 32]] = 0
    kinds[ord("a"): ord("z") + 1] = 1
    kinds[ord("A"): ord("Z") + 1] = 2
    kinds[ord("0"): ord("9") + 1] = 3
    kinds[128:] = 5
    return kinds


KIND = _kind_table()


def counts(texts: pa.Array) -> np.ndarray:
    """One row per text: byte triples by bucket, triples of kinds, and of its words those that repeat the
    last one, those that repeat the one before it, and the rest. Null and empty texts have zeros.

    A text of more than a mebibyte is counted in stretches that end at white space.
    """
    parts: list[bytes] = []
    of: list[int] = []
    for i, text in enumerate(texts.to_pylist()):
        own = stretches((text or "").encode("utf-8", "surrogatepass"))
        parts += own
        of += [i] * len(own)
    out = np.zeros((len(texts), WIDTH), np.float32)
    at = 0
    while at < len(parts):
        end, held = at + 1, len(parts[at])
        while end < len(parts) and held + len(parts[end]) <= LONG:
            held += len(parts[end])
            end += 1
        found = _counts(parts[at:end])
        if len(set(of[at:end])) == end - at:
            out[of[at:end]] += found
        else:
            np.add.at(out, of[at:end], found)
        at = end
    return out


def _counts(values: list[bytes]) -> np.ndarray:
    n = len(values)
    data, owner = joined_bytes(values)
    out = np.zeros((n, WIDTH), np.float32)
    if len(data) > 2:
        whole = owner[:-2] == owner[2:]
        wide = data.astype(np.uint32)
        code = (wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)) * np.uint32(2654435761)
        bucket = (code >> np.uint32(21)).astype(np.int32)
        out[:, BLOCKS[0]] = np.bincount((owner[:-2] * TRIPLES + bucket)[whole], minlength=n * TRIPLES).reshape(n, -1)
        kind = KIND[data].astype(np.int32)
        shape = (kind[:-2] * KINDS + kind[1:-1]) * KINDS + kind[2:]
        out[:, BLOCKS[1]] = np.bincount((owner[:-2] * KINDS**3 + shape)[whole], minlength=n * KINDS**3).reshape(n, -1)
    word, of = word_hashes(data, owner)
    if len(word):
        again = np.zeros(len(word), bool)
        again[1:] = (word[1:] == word[:-1]) & (of[1:] == of[:-1])
        second = np.zeros(len(word), bool)
        second[2:] = (word[2:] == word[:-2]) & (of[2:] == of[:-2]) & ~again[2:]
        for i, which in enumerate((again, second, ~again & ~second)):
            out[:, TRIPLES + KINDS**3 + i] = np.bincount(of[which], minlength=n)
    return out


def weighted(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Log counts by inverse document frequency, each block of unit length; the last block stays rates."""
    out = np.log1p(rows) * idf
    out[:, BLOCKS[2]] = rows[:, BLOCKS[2]]
    for block in BLOCKS:
        length = np.linalg.norm(out[:, block], axis=1, keepdims=True)
        out[:, block] /= np.where(length > 0, length, 1)
    return out.astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    axes: np.ndarray
    voters: np.ndarray
    labels: np.ndarray
    neighbours: int = NEIGHBOURS

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest voters; without any features, their mean."""
        if not len(self.labels):
            return np.ones(len(texts))
        vectors = _unit(weighted(counts(texts), self.idf) @ self.axes)
        out = np.full(len(vectors), float(self.labels.mean()))
        k = min(self.neighbours, len(self.labels))
        for at in range(0, len(vectors), 512):
            near = vectors[at: at + 512] @ self.voters.T
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(near, best, 1), 0).astype(np.float64)
            whole = weight.sum(1)
            known = whole > 0
            out[at: at + 512][known] = ((weight * self.labels[best]).sum(1)[known] / whole[known]).clip(0, 1)
        return out


def document_frequencies(docs: DataFrame, text: str) -> tuple[int, np.ndarray]:
    """Over all documents: their number, and for each feature the number of those that have it."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(WIDTH, np.int64), 0
        for batch in pieces(batches, text):
            total += (counts(batch.column(text)) > 0).sum(0)
            n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, WIDTH)), pa.array(np.concatenate([[n], total]))], ["feature", "n"])

    rows = docs.select(text).mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    by = {r["feature"]: r["n"] for r in rows}  # one row for each feature
    return by.get(-1, 0), np.array([by.get(i, 0) for i in range(WIDTH)], np.float64)


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, text: str = "text", key: str = "doc_id",
        label: str = "quality", voters: int = VOTERS) -> Model:
    """Learns from at most ``voters`` labelled rows for which ``learnable`` holds, drawn by a hash of their key.

    Document frequencies come from all rows; axes are the leading right singular vectors of the sample's rows.
    A key labelled twice has the rounded mean of its labels, and a key of several texts gives one of them; null keys and
    labels are left out.
    """
    n, frequency = document_frequencies(docs, text)
    idf = (np.log((1 + n) / (1 + frequency)) + 0.1).astype(np.float32)
    sample = (
        labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & learnable)
        .groupBy(key).agg(F.round(F.avg(label)).alias("_label")).orderBy(F.xxhash64(key), key).limit(voters)
    )

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            rows = counts(batch.column(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_label"), batch.column("_order"), pa.array([r.tobytes() for r in rows], pa.binary())],
                ["_label", "_order", "row"],
            )

    found = docs.select(key, text).join(F.broadcast(sample), key).withColumn("_order", F.xxhash64(key, text))
    found = found.groupBy(key).agg(F.min(F.struct("_order", text, "_label")).alias("_first")).select("_first.*")
    found = found.mapInArrow(features, "_label double, _order long, row binary")
    rows = sorted(found.collect(), key=lambda r: r["_order"])  # at most as many rows as voters, about 9 KB each
    if not rows:
        return Model(idf, np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    sampled = weighted(np.stack([np.frombuffer(r["row"], np.float32) for r in rows]), idf)
    rank = min(RANK, *sampled.shape)
    probe = np.random.default_rng(3).standard_normal((WIDTH, rank + 16)).astype(np.float32)
    for _ in range(4):  # power steps of a randomised singular value decomposition
        probe = np.linalg.qr(sampled.T @ (sampled @ probe))[0]
    axes = probe @ np.linalg.svd(sampled @ probe, full_matrices=False)[2].T[:, :rank]
    return Model(idf, axes.astype(np.float32), _unit(sampled @ axes).astype(np.float32), np.array([r["_label"] for r in rows]))


def scored(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` and ``name``, the score of the whole ``text``: exact cosines against all voters, in blocks.

    Null and empty texts have the voters' mean. Without voters every score is 1. Every row is scored,
    rows that repeat alike; an empty table gives no rows. A column called ``name`` gives way to the score.
    """
    docs = docs.drop(name)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    names = docs.columns

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(batch.column(text)))], [*names, name])

    return docs.mapInArrow(score, schema)


def held_out(key: Column) -> Column:
    """Rows kept from learning: a quarter, by the checksum of the key as text."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))
