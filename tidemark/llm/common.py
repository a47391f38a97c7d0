"""Helpers shared by the operators: written tables, bounded broadcasts, numbering, components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.session import scratch_dir

#: Rows of a key table that may be broadcast: 2 M keys of 16 bytes are about 32 MB in each executor.
BROADCAST_ROWS = 2_000_000
#: Rows that one window task numbers: at most SEGMENT_ROWS, and less where that gives up to 64 segments.
SEGMENT_ROWS, LEAST_ROWS = 100_000, 500


#: Rows and bytes of an Arrow batch. Spark's own bound of 10 000 rows makes batches of long texts so large that the JVM's
#: off-heap buffers and the Python workers, both of which live on between tasks, keep hundreds of MB each.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Sets the session's Arrow batches to sizes that suit tables of texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe when an executor is lost."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Characters of the texts in a table that may be broadcast.
BROADCAST_CHARS = 64 << 20


def small(df: DataFrame, rows: int = BROADCAST_ROWS, weight: Column | None = None) -> DataFrame:
    """Marked for broadcast if a count proves it small; as it is otherwise, for a shuffled join.

    Keys of any length take a ``weight``, their length, of which the sum is bounded too.
    """
    if weight is None:
        return F.broadcast(df) if df.count() <= rows else df
    n, chars = df.agg(F.count("*"), F.sum(weight)).first()
    return F.broadcast(df) if n <= rows and (chars or 0) <= BROADCAST_CHARS else df


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where a public tokenizer file is; the package that holds them is installed beside Spark."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(batches: Iterable[pa.RecordBatch], column: str, limit: int = 1 << 20, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches, cut where the texts of ``column`` pass ``limit`` bytes or ``rows`` texts; a row is never cut."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and (held + size > limit or i - start >= rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < len(sizes):
            yield batch.slice(start)


def numbered(df: DataFrame, keys: list[str], order: list[str], amount: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``amount`` over the rows before this one within ``keys``.

    With an amount of 1 this is a gapless number from 0. Rows of a key are dealt to segments by a hash
    of ``order``, so that no task holds a whole key; a sum per segment gives each segment its start.
    Rows equal in all of ``order`` take places next to each other.
    """
    columns = df.columns
    n = F.count("*")
    segments = F.greatest(F.ceil(n / SEGMENT_ROWS), F.least(F.lit(64), F.ceil(n / LEAST_ROWS)))
    counts = df.groupBy(*keys).agg(segments.alias("_segments"))
    match = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    dealt = df.withColumn("_amount", amount.cast("long")).alias("l").join(small(counts).alias("r"), match).select(
        "l.*", F.pmod(F.xxhash64(*[F.col(f"l.{c}") for c in order]), F.col("r._segments")).alias("_segment")
    )
    sums = dealt.groupBy(*keys, "_segment").agg(F.sum("_amount").alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = small(sums.select(*keys, "_segment", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start")))
    within = Window.partitionBy(*keys, "_segment").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("_local", F.coalesce(F.sum("_amount").over(within), F.lit(0)))
    match = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in (*keys, "_segment")]
    return local.alias("l").join(starts.alias("r"), match).select(
        *[f"l.{c}" for c in columns], (F.col("l._local") + F.col("r._start")).alias(name)
    )


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for the undirected links (a, b); comp is the smallest node reachable.

    Alternates large-star and small-star steps: each is one aggregation and one join, and the number
    of rounds grows with the logarithm of the nodes. Every round is written to the shared folder.
    """

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    def star(edges: DataFrame, both: bool) -> DataFrame:
        """Points neighbours of u (those above u, or those below) at the least of u and its neighbours."""
        wide = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else edges
        least = wide.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = wide.join(least, "u")
        moved = joined.filter("v > u") if both else joined
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not both:
            out = out.unionByName(joined.select("u", F.col("m").alias("v")))
        return out.filter("u != v").distinct()

    edges = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = written(edges, "edges"), None
    while True:
        now = state(edges)
        if now == before or now[0] == 0:
            break
        edges, before = written(star(star(edges, True), False), "edges"), now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    )


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of a partition sorted by ``keys``, one table for each run of equal keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        changed = [i for i in _changes(batch, keys)]
        edges = [0, *changed, batch.num_rows]
        for lo, hi in zip(edges, edges[1:]):
            key = tuple(batch.column(k)[lo].as_py() for k in keys)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _changes(batch: pa.RecordBatch, keys: list[str]) -> list[int]:
    n = batch.num_rows
    if n < 2:
        return []
    changed = None
    for k in keys:
        column = batch.column(k)
        differ = pa.compute.fill_null(pa.compute.not_equal(column.slice(1), column.slice(0, n - 1)), False)
        differ = pa.compute.or_(differ, pa.compute.not_equal(column.slice(1).is_null(), column.slice(0, n - 1).is_null()))
        changed = differ if changed is None else pa.compute.or_(changed, differ)
    return [i + 1 for i in pa.compute.indices_nonzero(changed).to_pylist()]
