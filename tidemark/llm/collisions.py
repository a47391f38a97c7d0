"""Near vectors by collision-counting projections: sorted lines, windows around each vector, counts per pair."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import components, runs, written

COSINE = 0.93
#: Chance that a pair at the threshold itself reaches the count that is verified.
RECALL = 0.9995
#: Collisions that a pair needs; vectors that a cell of a line is expected to hold.
NEEDED, IN_CELL = 2, 16
#: In units of the distance at the threshold: width of a cell's steps, and half a window.
STEP, HALF = 4.0, 1.5
SEED = 11


@dataclass(frozen=True)
class Lines:
    """How many lines are sorted, and how many projections more cut each of them into cells."""

    cosine: float
    cells: int
    lines: int
    needed: int

    @property
    def distance(self) -> float:
        return math.sqrt(2 - 2 * self.cosine)


def _same_step(distance: float, width: float) -> float:
    """Chance that two vectors so far apart fall into one step of a projection."""
    x = width / distance
    tail = 0.5 * math.erfc(x / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * x) * (1 - math.exp(-x * x / 2))


def calibrated(most: int, cosine: float = COSINE, recall: float = RECALL, needed: int = NEEDED) -> Lines:
    """Lines for groups of up to ``most`` vectors.

    Enough projections cut a line into cells that unrelated vectors (a right angle apart) fill with IN_CELL
    on average; then lines are added until a pair at the threshold collides ``needed`` times with chance
    ``recall``. Cells grow with the logarithm of the group and lines with a small power of it, so the
    whole work stays far below the square.
    """
    near = math.sqrt(2 - 2 * cosine)
    far = _same_step(math.sqrt(2), STEP * near)
    cells = max(1, math.ceil(math.log(max(most / IN_CELL, 1)) / -math.log(far)))
    hit = _same_step(near, STEP * near) ** cells * math.erf(HALF / math.sqrt(2))
    lines = needed
    while sum(math.comb(lines, i) * hit**i * (1 - hit) ** (lines - i) for i in range(needed)) > 1 - recall:
        lines += 1
    return Lines(cosine, cells, lines, needed)


def usable(vectors: DataFrame, key: str, embedding: str, label: str) -> DataFrame:
    """(id, label, v): rows with a key, a label, and a vector that has a direction; v in double precision."""
    rows = vectors.filter(_has_direction(key, embedding, label))
    return rows.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("v"))


def _has_direction(key: str, embedding: str, label: str) -> Column:
    v = F.col(embedding).cast("array<double>")
    odd = F.coalesce(F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True))
    some = F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    return F.col(key).isNotNull() & F.col(label).isNotNull() & ~odd & some


def colliding(vectors: DataFrame, plan: Lines, seed: int = SEED) -> DataFrame:
    """Pairs (a, b) of (cid, label, v) that collide at least ``plan.needed`` times.

    For every line a vector gives its place and the cell that it lies in. Lines are sorted cell by cell; a
    window of HALF distances around each vector yields its collisions, which are counted for each pair.
    """
    width, half = STEP * plan.distance, HALF * plan.distance

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            rows = batch.column("v").to_pylist()
            sizes = np.array([len(r) for r in rows])
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                if size not in known:
                    random = np.random.default_rng((seed, size))
                    known[size] = (random.standard_normal((size, plan.lines * (plan.cells + 1))), random.random(plan.lines * plan.cells) * width)
                axes, shift = known[size]
                v = np.array([rows[i] for i in at])
                v /= np.abs(v).max(1, keepdims=True)
                v /= np.linalg.norm(v, axis=1, keepdims=True)
                on = (v @ axes).reshape(len(v), plan.lines, plan.cells + 1)
                step = np.floor((on[:, :, 1:] + shift.reshape(plan.lines, plan.cells)) / width).astype(np.int64)
                cell = np.full(step.shape[:2], size, np.int64)
                with np.errstate(over="ignore"):
                    for c in range(plan.cells):
                        cell = (cell ^ step[:, :, c]) * np.int64(6364136223846793005) + np.int64(1442695040888963407)
                many = np.repeat(at, plan.lines)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").take(pa.array(many)), pa.array(np.tile(np.arange(plan.lines, dtype=np.int32), len(at))),
                     pa.array(cell.ravel()), pa.array(on[:, :, 0].ravel()), batch.column("cid").take(pa.array(many))],
                    ["label", "line", "cell", "place", "cid"],
                )

    def collide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            a, b = (np.concatenate(x) for x in zip(*held))
            low, high = np.minimum(a, b), np.maximum(a, b)
            order = np.lexsort((high, low))
            low, high = low[order], high[order]
            first = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])]))
            n = np.diff(np.concatenate([first, [len(low)]]))
            return pa.RecordBatch.from_arrays([pa.array(low[first]), pa.array(high[first]), pa.array(n)], ["a", "b", "n"])

        for run in runs(batches, ["label", "line", "cell"]):
            if run.num_rows < 2:
                continue
            at, ids = run.column("place").to_numpy(), run.column("cid").to_numpy()
            reach = np.searchsorted(at, at + half, "right")
            for lo in range(0, len(at), 4096):
                n = reach[lo: lo + 4096] - np.arange(lo, min(lo + 4096, len(at))) - 1
                left = np.repeat(np.arange(lo, lo + len(n)), n)
                right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
                if len(left):
                    held.append((ids[left], ids[right]))
                    size += len(left)
                if size > 1_000_000:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    lines = vectors.mapInArrow(place, f"label {dict(vectors.dtypes)['label']}, line int, cell long, place double, cid long")
    lines = lines.repartition("label", "line", "cell").sortWithinPartitions("label", "line", "cell", "place", "cid")
    pairs = lines.mapInArrow(collide, "a long, b long, n long")
    return pairs.filter("a != b").groupBy("a", "b").agg(F.sum("n").alias("n")).filter(F.col("n") >= plan.needed).select("a", "b")


def near_vectors(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", label: str = "label",
                 cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """One row per row of ``vectors``: ``key``, n_links, component_id (the smallest key reachable), kept.

    Vectors of one label link when their cosine, in double precision, is at least ``cosine``; every link given
    is verified, and a link at the threshold itself is found with chance ``recall`` (nearer ones with more).
    Equal vectors of one label are compared once and link with each other. Vectors that are null, zero or hold
    null or non-finite components, and rows with a null label or key, link with nothing and are their own
    component. Vectors of different lengths do not link. Rows that repeat count as other vectors. An empty table
    gives no rows; other columns are ignored.
    """
    rows = usable(vectors, key, embedding, label).withColumn("cid", F.xxhash64("label", "v"))
    distinct = written(rows.groupBy("cid").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.count("*").alias("many")), "vectors")
    most = distinct.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    pairs = colliding(distinct.select("cid", "label", "v"), calibrated(most, cosine, recall))

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                u, v = np.array(x) / max(map(abs, x)), np.array(y) / max(map(abs, y))
                good.append(len(u) == len(v) and bool(u @ v / math.sqrt((u @ u) * (v @ v)) >= cosine))
            yield batch.select(["a", "b", "in_a", "in_b"]).filter(pa.array(good, pa.bool_()))

    side = lambda c, v, n: distinct.select(F.col("cid").alias(c), F.col("v").alias(v), F.col("many").alias(n))
    both = pairs.join(side("a", "x", "in_a"), "a").join(side("b", "y", "in_b"), "b")
    links = both.select("a", "b", "x", "y", "in_a", "in_b").mapInArrow(verify, "a long, b long, in_a long, in_b long")
    links = written(links, "vector-links")
    degree = links.select(F.col("a").alias("cid"), F.col("in_b").alias("n")).unionByName(
        links.select(F.col("b").alias("cid"), F.col("in_a").alias("n"))
    ).groupBy("cid").agg(F.sum("n").alias("others"))
    classes = components(links.select("a", "b")).select(F.col("node").alias("cid"), "comp")
    known = distinct.select("cid", "many").join(degree, "cid", "left").join(classes, "cid", "left")
    known = known.select("cid", (F.coalesce("others", F.lit(0)) + F.col("many") - 1).alias("n_links"), F.coalesce("comp", "cid").alias("comp"))
    placed = written(rows.select("id", "cid").join(known, "cid"), "vector-classes")
    least = placed.groupBy("comp").agg(F.min("id").alias("component_id"))
    found = placed.join(least, "comp").select("id", "n_links", "component_id")
    usable_rows = found.select(F.col("id").alias(key), "n_links", "component_id")
    rest = vectors.filter(~_has_direction(key, embedding, label)).select(F.col(key), F.lit(0).cast("long").alias("n_links"), F.col(key).alias("component_id"))
    return usable_rows.unionByName(rest).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))

