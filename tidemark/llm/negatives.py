"""Hard negatives by exact integer scores, computed with tables of subset sums (Four Russians).

Components are integers. For each group of eight dimensions an anchor has a table of the 256 sums over subsets of the group.
A candidate's components lie in bit planes, and the eight bits that a plane has for a group are one byte: an index into that table.
The score is the sum of the looked-up values, plane by plane from the highest, doubled in between; no candidate is left out.

Candidates and anchors are packed into blocks. Blocks of anchors are broadcast in rounds of bounded size and meet every
block of candidates; a task keeps the best few of each anchor and hands them on at its end.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import bounded_batches, small, written

#: Rows of a block of candidates and of anchors; rows that a task holds while it packs them.
BLOCK, ANCHORS, HELD = 1024, 256, 1 << 16
#: Positives meet candidates of their label's bucket only.
BUCKETS = 16
#: Bytes of the anchors that are broadcast at a time; pairs that a task scores, about.
ROUND_BYTES, TASK_PAIRS = 32 << 20, 1 << 27
NONE = np.iinfo(np.int64).min

_CANDIDATES = "dims int, bucket int, ids binary, labels binary, planes binary"
_ANCHORS = "dims int, bucket int, block bigint, ids binary, labels binary, parts binary, ceilings binary"


# --- blocks -----------------------------------------------------------------------------------------

def bit_planes(parts: np.ndarray) -> np.ndarray:
    """(planes, groups of eight dimensions, rows) bytes of whole numbers, two's complement, the lowest plane first."""
    rows, dims = parts.shape
    least, most = (int(parts.min()), int(parts.max())) if parts.size else (0, 0)
    planes = max(most.bit_length(), (-least - 1).bit_length() if least < 0 else 0) + 1
    wide = np.zeros((rows, -(-dims // 8) * 8), np.int64)
    wide[:, :dims] = parts
    out = np.empty((planes, wide.shape[1] // 8, rows), np.uint8)
    for p in range(planes):
        out[p] = np.packbits(((wide >> p) & 1).astype(np.uint8), axis=1, bitorder="little").T
    return out


def subset_sums(parts: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): for each byte the sum of the components whose bits it has."""
    rows, dims = parts.shape
    wide = np.zeros((rows, -(-dims // 8) * 8), np.int64)
    wide[:, :dims] = parts
    out = np.zeros((wide.shape[1] // 8, 256, rows), np.int64)
    for bit in range(8):
        out[:, 1 << bit: 2 << bit] = out[:, : 1 << bit] + wide[:, bit::8].T[:, None, :]
    return out


def scores(planes: np.ndarray, sums: np.ndarray, largest: int) -> np.ndarray:
    """(candidates, anchors) inner products. ``largest`` bounds the anchors' components; scores that may pass 2**52 are an error."""
    bound = len(sums) * 8 * largest << len(planes)
    if bound >= 1 << 52:
        raise ValueError("components so large that a score may pass 2**52")
    kind = np.int32 if bound < 1 << 31 else np.int64
    sums = sums.astype(kind)
    out = np.zeros((planes.shape[2], sums.shape[2]), kind)
    looked = np.empty_like(out)
    for p in range(len(planes) - 1, -1, -1):
        for table, index in zip(sums, planes[p]):
            out += np.take(table, index, axis=0, out=looked, mode="clip")
        if p == len(planes) - 1:
            np.negative(out, out=out)  # the sign's plane
        if p:
            out *= kind(2)
    return out


def _packed(rows: DataFrame, anchors: bool) -> DataFrame:
    """Blocks of rows of one dimension and bucket, in order of their ids."""
    schema, most = (_ANCHORS, ANCHORS) if anchors else (_CANDIDATES, BLOCK)

    def block(dims: int, bucket: int, held: list[tuple]) -> dict:
        held.sort(key=lambda r: r[0])
        parts = np.array([r[2] for r in held], np.int64).reshape(len(held), dims)
        ids, labels = (np.array([r[i] for r in held], np.int64) for i in (0, 1))
        out = {"dims": dims, "bucket": bucket, "ids": ids.tobytes(), "labels": labels.tobytes()}
        if not anchors:
            return out | {"planes": bit_planes(parts).tobytes()}
        ceilings = np.array([r[3] for r in held], np.int64).reshape(len(held), -1)
        return out | {"block": None, "parts": parts.tobytes(), "ceilings": ceilings.tobytes()}

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        total = 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("dims", "bucket", "id", "label")]
            parts = [np.asarray(v.values) for v in batch.column("parts")]
            ceilings = [v for v in batch.column("ceilings").to_pylist()] if anchors else [None] * len(parts)
            for dims, bucket, one, label, part, ceiling in zip(*columns, parts, ceilings):
                rows_of = held.setdefault((dims, bucket), [])
                rows_of.append((one, label, part, ceiling))
                total += 1
                full = (dims, bucket) if len(rows_of) == most else None
                if total >= HELD:
                    full = max(held, key=lambda k: len(held[k]))
                if full:
                    done = held.pop(full)
                    total -= len(done)
                    yield pa.RecordBatch.from_pylist([block(*full, done)], schema=fields)
        for key, rows_of in held.items():
            yield pa.RecordBatch.from_pylist([block(*key, rows_of)], schema=fields)

    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = pa.schema([(n, kinds[k]) for n, k in (x.split() for x in schema.split(", "))])
    packed = rows.mapInArrow(pack, schema)
    if anchors:
        packed = packed.withColumn("block", F.monotonically_increasing_id())
    return packed


# --- the best of each anchor --------------------------------------------------------------------------

class Best:
    """The ``most`` best candidates of each column: higher scores first, ties by smaller id."""

    def __init__(self, columns: int, most: int):
        self.scores = np.full((most, columns), NONE)
        self.ids = np.zeros((most, columns), np.int64)

    def add(self, found: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """``found`` (candidates, columns) where ``allowed``; ``ids`` ascend."""
        most = len(self.scores)
        better = allowed & (found >= self.scores[-1])
        at = np.flatnonzero(better.any(axis=0))
        if not len(at):
            return
        rows = len(ids)
        # One number orders by score, then by place, and places ascend with ids.
        place = np.arange(rows - 1, -1, -1, dtype=np.int64)[:, None]
        chosen = better[:, at]
        if rows > most:
            key = np.where(chosen, found[:, at].astype(np.int64) * rows + place, NONE)
            top = np.argpartition(key, rows - most, axis=0)[rows - most:]
        else:
            top = np.repeat(np.arange(rows)[:, None], len(at), axis=1)
        new = np.where(np.take_along_axis(chosen, top, axis=0), np.take_along_axis(found[:, at].astype(np.int64), top, axis=0), NONE)
        both = np.concatenate([self.scores[:, at], new])
        both_ids = np.concatenate([self.ids[:, at], ids[top]])
        order = np.lexsort((both_ids, -(both + 1)), axis=0)[:most]  # +1: NONE has no negative of its own
        self.scores[:, at] = np.take_along_axis(both, order, axis=0)
        self.ids[:, at] = np.take_along_axis(both_ids, order, axis=0)


def _met(pairs: DataFrame, positives: int, negatives: int, range_: tuple[int, int] | None) -> DataFrame:
    """(anchor, place, id, score): a task's best of each anchor. Without a range those of the anchor's label, else for
    each of its ceilings those of other labels within the range's hundredths of it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[int, tuple[np.ndarray, list[Best]]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                dims = row["dims"]
                ids, labels, a_ids, a_labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "a_ids", "a_labels"))
                planes = np.frombuffer(row["planes"], np.uint8)
                groups = -(-dims // 8)
                planes = planes.reshape(-1, groups, len(ids)) if groups else np.zeros((1, 0, len(ids)), np.uint8)
                parts = np.frombuffer(row["parts"], np.int64).reshape(len(a_ids), dims)
                found = scores(planes, subset_sums(parts), int(np.abs(parts).max(initial=0)))
                same = labels[:, None] == a_labels[None, :]
                if row["block"] not in state:
                    n, most = (1, positives) if range_ is None else (positives, negatives)
                    state[row["block"]] = a_ids, [Best(len(a_ids), most) for _ in range(n)]
                kept = state[row["block"]][1]
                if range_ is None:
                    kept[0].add(found, same & (ids[:, None] != a_ids[None, :]), ids)
                    continue
                ceilings = np.frombuffer(row["ceilings"], np.int64).reshape(len(a_ids), -1)
                for j in range(ceilings.shape[1]):
                    top = ceilings[:, j]
                    exact = np.where(top == NONE, 0, top)
                    low, high = -(-range_[0] * exact // 100), range_[1] * exact // 100
                    kept[j].add(found, ~same & (top != NONE) & (found >= low) & (found <= high), ids)
        for a_ids, kept in state.values():
            for j, best in enumerate(kept):
                at = np.nonzero(best.scores != NONE)
                yield pa.RecordBatch.from_arrays([
                    pa.array(a_ids[at[1]]), pa.array(np.full(len(at[0]), j + 1, np.int32)), pa.array(best.ids[at]), pa.array(best.scores[at]),
                ], names=["anchor", "place", "id", "score"])

    return pairs.mapInArrow(run, "anchor bigint, place int, id bigint, score bigint")


def _rounds(anchors: DataFrame) -> tuple[DataFrame, int]:
    """Blocks with the round that they are broadcast in; no round has more than ROUND_BYTES (or else one block)."""
    weight = sum((F.length(c) for c in ("ids", "labels", "parts", "ceilings")), F.lit(64))
    sizes = anchors.agg(F.sum(weight), F.max(weight)).first()
    rounds = max(1, -(-(sizes[0] or 0) // ROUND_BYTES))
    while True:
        dealt = anchors.withColumn("round", F.pmod(F.xxhash64("block"), F.lit(rounds)).cast("int"))
        largest = dealt.groupBy("round").agg(F.sum(weight).alias("w")).agg(F.max("w")).first()[0] or 0
        if largest <= max(ROUND_BYTES, sizes[1] or 0):
            return dealt, rounds
        rounds *= 2


def _all_rounds(candidates: DataFrame, anchors: DataFrame, on: list[str], label: str, *limits) -> DataFrame:
    """``_met`` over every pair of blocks with equal ``on``, the anchors broadcast round by round."""
    dealt, rounds = _rounds(anchors)
    renamed = dealt.select(
        *on, "round", "block", "parts", "ceilings", F.col("ids").alias("a_ids"), F.col("labels").alias("a_labels")
    )
    out = None
    for number in range(rounds):
        blocks = F.broadcast(renamed.filter(F.col("round") == number).drop("round"))
        met = written(_met(candidates.join(blocks, on).select("dims", "ids", "labels", "planes", *blocks.columns[len(on):]), *limits), label)
        out = met if out is None else out.unionByName(met)
    return out


def _first(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def whole_parts(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, x as a double; an error where that leaves 32 bits."""
    def part(x: Column) -> Column:
        value = x.cast("double") * scale
        return F.when(F.abs(value) < float(1 << 31), F.floor(value)).otherwise(F.raise_error(F.lit("a component of 2**31 or more")))

    return F.transform(vector, lambda x: part(x).cast("long"))


def _complete(vectors: DataFrame, is_anchor: Column, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """(id, anchor, label, parts, dims, bucket) of the rows that take part, one for each id."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    rows = vectors.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull()).filter(finite).select(
        F.col(key).cast("long").alias("id"), is_anchor.alias("anchor"), F.col(label).cast("long").alias("label"), whole_parts(F.col(vector), scale).alias("parts")
    )
    rows = written(rows, "whole-parts")
    twice = written(rows.groupBy("id").count().filter("count > 1").select("id"), "repeated-ids")
    if not twice.isEmpty():
        one = rows.join(small(twice), "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "parts", "anchor")).alias("one"))
        rows = rows.join(small(twice), "id", "left_anti").unionByName(one.select("id", "one.anchor", "one.label", "one.parts"))
    return rows.withColumns({
        "dims": F.size("parts"), "bucket": F.pmod(F.xxhash64("label"), F.lit(BUCKETS)).cast("int"),
    })


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = 5, negatives: int = 5, range_: tuple[int, int] = (80, 100), scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where ``is_anchor`` holds,
    a condition on the key.

    An anchor's positives are its ``positives`` best other rows of its label; each has as negatives the ``negatives``
    best rows of other labels whose score lies within ``range_`` hundredths of its own (none if that is negative).
    Scores are inner products of ``floor(scale * x)``; ties go by the smaller key. Every row is scored against every anchor of
    its length. Rows whose key, label, vector or any component is null, and those with a component that is not finite, take
    no part; vectors of another length than the anchor's neither. Rows that share a key count once, by the least label
    and then vector. A vector without components scores 0. Components of 2**31 or more after scaling, and so large
    ones that scores may pass 2**52, are errors. An empty table, or one without anchors, gives no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = _complete(vectors, is_anchor, key, vector, label, scale)
    anchors, rows = rows.filter("anchor").drop("anchor"), rows.drop("anchor")
    n_anchors, n_rows = anchors.count(), rows.count()
    tasks = max(spark.sparkContext.defaultParallelism, -(-n_anchors * n_rows // TASK_PAIRS))
    candidates = written(_packed(rows, False), "candidates").repartition(tasks)

    none = F.array().cast("array<bigint>")
    blocks = written(_packed(anchors.withColumn("ceilings", none), True), "anchors")
    near = _all_rounds(candidates, blocks, ["dims", "bucket"], "positives", positives, negatives, None)
    near = written(_first(near, ["anchor"], positives).withColumnRenamed("rank", "positive"), "positives")

    listed = near.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("positive", "score"))).alias("by"))
    missing = F.lit(int(NONE))
    ceilings = F.array(*[F.coalesce(F.try_element_at("by", F.lit(j + 1)), missing) for j in range(positives)])
    with_ceilings = anchors.join(listed, F.col("id") == F.col("anchor")).withColumn("ceilings", ceilings).drop("anchor", "by")
    blocks = written(_packed(with_ceilings, True), "anchors")
    hard = _all_rounds(candidates, blocks, ["dims"], "negatives", positives, negatives, range_)
    hard = _first(hard, ["anchor", "place"], negatives)
    pair = (F.col("n.anchor") == F.col("p.anchor")) & (F.col("n.place") == F.col("p.positive"))
    return hard.alias("n").join(near.alias("p"), pair).select(
        F.col("n.anchor").alias("anchor_id"), F.col("p.id").alias("positive_id"), F.col("n.rank").cast("int").alias("rank"),
        F.col("n.id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("n.score").alias("negative_score"),
    )

