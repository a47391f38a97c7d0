"""Exact duplicates by content-defined chunk recipes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import small, written

#: Bytes: least and greatest length of a chunk; a cut falls once in CUT_EVERY places on average.
LEAST, CUT_EVERY, MOST = 512, 2048, 8192
#: One random 32-bit number for each byte value; fixed, so that cuts agree everywhere.
GEAR = np.random.default_rng(20_011).integers(0, 1 << 32, 256, dtype=np.uint32)


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``.

    A place may be cut if a rolling sum of its last 32 bytes has its top bits clear, so equal passages
    are cut alike wherever they stand. No bytes: no chunks.
    """
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    rolled = GEAR[np.frombuffer(data, np.uint8)]
    for span in (1, 2, 4, 8, 16):
        longer = rolled.copy()
        longer[span:] += rolled[:-span] << np.uint32(span)
        rolled = longer
    places = np.flatnonzero(rolled < np.uint32((1 << 32) // CUT_EVERY)) + 1
    ends, start = [], 0
    while n - start > LEAST:
        i = int(np.searchsorted(places, start + LEAST))
        end = min(int(places[i]) if i < len(places) else n, start + MOST, n)
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def _chunks(text: str | None) -> list[bytes]:
    data = (text or "").encode("utf-8", "surrogatepass")
    ends = cuts(data)
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def recipes(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` and ``recipe``, the ordered digests of the chunks of ``text`` (null or empty: none)."""
    schema = T.StructType([*[docs.schema[c] for c in carry], T.StructField("recipe", T.ArrayType(T.BinaryType()))])

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[xxhash.xxh3_128_digest(c) for c in _chunks(t.as_py())] for t in batch.column(text)]
            columns = [batch.column(c) for c in carry] + [pa.array(found, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, [*carry, "recipe"])

    return docs.select(*dict.fromkeys((*carry, text))).mapInArrow(make, schema)


def unverified(docs: DataFrame, listed: DataFrame, text: str = "text") -> DataFrame:
    """Digests that stand for two or more different chunks (in practice none).

    Only chunks whose digest occurs again are moved, each distinct one once per map task; their bytes
    are compared whole.
    """
    repeated = written(
        listed.select(F.explode("recipe").alias("digest")).groupBy("digest").count().filter("count > 1").select("digest"),
        "repeated-chunks",
    )

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(text):
                if found := list(dict.fromkeys(_chunks(value.as_py()))):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([xxhash.xxh3_128_digest(c) for c in found], pa.binary()), pa.array(found, pa.binary())],
                        ["digest", "chunk"],
                    )

    content = docs.select(text).mapInArrow(cut, "digest binary, chunk binary")
    return (
        content.join(small(repeated), "digest", "left_semi").groupBy("digest", "chunk").agg(F.count("*").alias("n"))
        .groupBy("digest").count().filter("count > 1").select("digest")
    )


def exact_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``carry``, ``keep_id``, ``group_size``, ``kept``.

    Rows whose texts are identical (null counts as empty) form a group; the largest key stays, and
    rows that share that key all stay. Nulls are the least keys. An empty table gives no rows; other
    columns are ignored. Groups compare ordered lists of verified chunk digests, never the texts; a
    document with an unverified digest is compared by its whole text instead.
    """
    named = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias(text), *carry)
    listed = written(recipes(named, text, (key, *carry)), "recipes")
    doubtful = written(unverified(named, listed, text), "doubtful-chunks")
    if doubtful.isEmpty():
        listed = listed.withColumn("whole", F.lit(None).cast("string"))
    else:
        marks = doubtful.agg(F.collect_list("digest").alias("d"))  # one row; digests of collisions only
        whole = recipes(named.withColumn("whole", F.col(text)), text, (key, *carry, "whole"))
        listed = whole.crossJoin(F.broadcast(marks)).withColumn(
            "whole", F.when(F.arrays_overlap("recipe", "d"), F.col("whole"))
        ).drop("d")
    groups = listed.groupBy("recipe", "whole").agg(F.max(key).alias("keep_id"), F.count("*").alias("group_size"))
    match = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("recipe", "whole")]
    return listed.alias("l").join(groups.alias("r"), match).select(
        F.col(f"l.{key}"), *[F.col(f"l.{c}") for c in carry], "r.keep_id", "r.group_size",
        F.col(f"l.{key}").eqNullSafe(F.col("r.keep_id")).alias("kept"), F.size("l.recipe").alias("n_chunks"),
    )
