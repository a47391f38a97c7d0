"""Mixing sources to target weights: fixed-length blocks, conditional multinomial counts, permuted slots."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import free_name, numbered, pieces, small, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MOST_TIMES = 3
#: Words in a block, for every source; the last block of a source has what is left.
BLOCK_WORDS = 512
SHARDS = 64
SEED = 7


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_TIMES) -> dict:
    """Words asked of each source: shares of the total by weight, at most ``most`` times its size.

    Sources take the weights in code point order, null last. What a full source cannot take is shared
    among the others by weight until none is above its bound.
    """
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-8", "surrogatepass"))
    names += [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out: dict = {}
    left, open_ = float(sum(sizes.values())), list(names)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if unit * weight[s] > most * sizes[s]]
        if not full:
            out |= {s: unit * weight[s] for s in open_}
            break
        for s in full:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


def shard_counts(totals: list[int], shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (column) in each output shard (row).

    Shards of equal size draw multinomial counts, given that all shards together take each source's
    total: that is a multivariate hypergeometric draw from what is left.
    """
    rng, left = np.random.default_rng(seed), np.array(totals, dtype=np.int64)
    out = np.zeros((shards, len(totals)), dtype=np.int64)
    for i in range(shards):
        want = int(left.sum()) // (shards - i)
        for j in range(len(left)):  # one source after the other, each given those before it
            rest = int(left[j + 1:].sum())
            out[i, j] = _hypergeometric(rng, int(left[j]), rest, want)
            want -= int(out[i, j])
        left -= out[i]
    return out


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, sample))
    # Beyond the generator's range (some TB of text) the normal law of the same mean and variance, rounded: shards of
    # 10**7 blocks and more, whose counts it gives to within the last few.
    share = good / (good + bad)
    spread = (sample * share * (1 - share) * (1 - sample / (good + bad))) ** 0.5
    return int(min(good, sample, max(0, sample - bad, round(rng.normal(sample * share, spread)))))


def _round(right: np.ndarray, key: np.ndarray, r: int) -> np.ndarray:
    mixed = (right + key + np.uint64(r)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def permuted(slots: np.ndarray, size: np.ndarray, key: np.ndarray, back: bool = False) -> np.ndarray:
    """Pseudorandom permutation of 0..size-1, one for each key, or its inverse: a keyed Feistel network that walks in cycles."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    low = (np.uint64(1) << half) - np.uint64(1)
    value, open_ = slots.astype(np.uint64), np.ones(len(slots), dtype=bool)
    with np.errstate(over="ignore"):
        while open_.any():
            left, right = value[open_] >> half[open_], value[open_] & low[open_]
            for r in reversed(range(6)) if back else range(6):
                if back:
                    left, right = (right ^ _round(left, key[open_], r)) & low[open_], left
                else:
                    left, right = right, (left ^ _round(right, key[open_], r)) & low[open_]
            value[open_] = (left << half[open_]) | right
            open_ = value >= size.astype(np.uint64)
    return value.astype(np.int64)


def source_key(seed: int, number: int) -> int:
    return (seed * 1_000_003 + number) & ((1 << 62) - 1)


def slots_for(total: int, size: int, key: int) -> tuple[int, int]:
    """How many slots of a source of ``size`` words hold ``total`` words, and how many words the last slot gives.

    Whole epochs take every word once. In the epoch that is not whole all slots are BLOCK_WORDS long but the one that
    takes the source's last block, whose place the inverse permutation tells.
    """
    if not total:
        return 0, 0
    blocks = -(-size // BLOCK_WORDS)
    short = size - BLOCK_WORDS * (blocks - 1)
    at = int(permuted(np.array([blocks - 1]), np.array([blocks]), np.array([key], np.uint64), back=True)[0])

    def held(slots: int) -> int:
        return slots * BLOCK_WORDS - (BLOCK_WORDS - short if at < slots else 0)

    epochs, rest = divmod(total, size)
    if not rest:
        epochs, rest = epochs - 1, size
    slots = -(-rest // BLOCK_WORDS)
    if held(slots) < rest:
        slots += 1
    return epochs * blocks + slots, rest - held(slots - 1)


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source",
        weights: tuple[float, ...] = WEIGHTS, most: int = MOST_TIMES, shards: int = SHARDS,
        seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(documents, draws): what the mix takes of each document.

    documents: doc_id (the ``key``), source, mark (a hash of the text), size, source_size, target, first (the number of
    words before it in its source), taken; one row per row of ``docs``. draws: the output, one row for each block of each shard:
    source, shard, slot, epoch, block, and the words ``lo`` to ``hi`` (exclusive) of the source that it holds.

    Words of a source stand in one long line in hashed order of keys and are cut into blocks of BLOCK_WORDS. Slot s of a
    source takes block p(s mod n) in epoch s div n, where p is the source's permutation of its n blocks, so
    every block is taken once before any is taken again. The last slot of a source gives only the words that its target
    still lacks, so every source gives its target to the word. Rows that repeat count each. Documents without
    words take nothing; an empty table gives empty results. A null source is a source.
    """
    sized = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), F.xxhash64(text).alias("mark"), n_words(F.col(text)).alias("size"))
    sized = written(sized, "mix-sizes")
    # One row per source: names and sizes of sources are the catalogue that weights refer to.
    sizes = {r["source"]: int(r["n"]) for r in sized.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    wanted = targets(sizes, weights, most)
    names = list(wanted)
    blocks = {s: -(-sizes[s] // BLOCK_WORDS) for s in names}
    keys = {s: source_key(seed, j) for j, s in enumerate(names)}
    slots = {s: slots_for(min(most * sizes[s], round(wanted[s])), sizes[s], keys[s]) for s in names}
    counts = shard_counts([slots[s][0] for s in names], shards, seed)
    starts = np.vstack([np.zeros((1, len(names)), dtype=np.int64), np.cumsum(counts, axis=0)])

    spark = docs.sparkSession
    plan = spark.createDataFrame(
        [(s, sizes[s], wanted[s]) for s in names], f"source {dict(docs.dtypes)[source]}, source_size long, target double"
    )
    placed = numbered(sized, ["source"], ["doc_id", "mark"], F.col("size"), "first")
    placed = written(
        placed.alias("l").join(small(plan).alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")))
        .select("l.*", "r.source_size", "r.target"),
        "mix-places",
    )
    each = spark.createDataFrame(
        [(s, i, int(starts[i, j]), int(counts[i, j]), blocks[s], sizes[s], *slots[s], keys[s])
         for j, s in enumerate(names) for i in range(shards) if counts[i, j]],
        f"source {dict(docs.dtypes)[source]}, shard int, at long, n long, blocks long, words long, slots long, last long, key long",
    )
    step = 1 << 16  # slots that one row of work stands for
    work = each.withColumn("part", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {step}"))))
    work = work.select(
        "source", "shard", (F.col("at") + F.col("part") * step).alias("at"),
        F.least(F.lit(step), F.col("n") - F.col("part") * step).alias("n"), "blocks", "words", "slots", "last", "key",
    ).repartition("key", "shard", "at")

    def draw(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                slot = np.arange(row["at"], row["at"] + row["n"], dtype=np.int64)
                fill = np.full(len(slot), 1, dtype=np.int64)
                block = permuted(slot % row["blocks"], fill * row["blocks"], np.full(len(slot), row["key"], dtype=np.uint64))
                lo = block * BLOCK_WORDS
                hi = np.minimum(lo + BLOCK_WORDS, row["words"])
                hi = np.where(slot == row["slots"] - 1, lo + row["last"], hi)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["source"]] * len(slot), batch.schema.field("source").type),
                     pa.array(fill.astype(np.int32) * row["shard"]), pa.array(slot), pa.array(slot // row["blocks"]),
                     pa.array(block), pa.array(lo), pa.array(hi)],
                    ["source", "shard", "slot", "epoch", "block", "lo", "hi"],
                )

    draws = work.mapInArrow(
        draw, f"source {dict(docs.dtypes)[source]}, shard int, slot long, epoch long, block long, lo long, hi long"
    )
    draws = written(draws, "mix-draws")
    taken = taken_runs(placed, draws).groupBy("source", "first").agg(F.sum(F.col("hi") - F.col("lo")).alias("taken"))
    match = F.col("l.source").eqNullSafe(F.col("r.source")) & (F.col("l.first") == F.col("r.first")) & (F.col("l.size") > 0)
    out = placed.alias("l").join(taken.alias("r"), match, "left").select(
        "l.doc_id", "l.source", "l.mark", "l.size", "l.source_size", "l.target", "l.first",
        F.coalesce("r.taken", F.lit(0)).cast("long").alias("taken"),
    )
    return out, draws


def taken_runs(placed: DataFrame, draws: DataFrame) -> DataFrame:
    """Words ``lo`` to ``hi`` of each document that a draw holds: documents and draws meet at block numbers."""
    cut = placed.filter("size > 0").select(
        "doc_id", "source", "mark", "first", "size",
        F.explode(F.sequence(F.expr(f"first div {BLOCK_WORDS}"), F.expr(f"(first + size - 1) div {BLOCK_WORDS}"))).alias("block"),
    )
    match = F.col("l.source").eqNullSafe(F.col("r.source")) & (F.col("l.block") == F.col("r.block"))
    return cut.alias("l").join(draws.alias("r"), match).select(
        "l.doc_id", "l.source", "l.mark", "l.first", "r.shard", "r.slot", "r.epoch",
        (F.greatest("l.first", "r.lo") - F.col("l.first")).alias("lo"),
        (F.least(F.expr("l.first + l.size"), F.col("r.hi")) - F.col("l.first")).alias("hi"),
    ).filter("lo < hi")


def mixed_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", n_chars: str | None = "n_chars",
                    **options) -> DataFrame:
    """The mix as documents, with the columns of ``docs``.

    A document comes once for each epoch that takes words of it, whole where all of them are taken, else
    with the taken stretches of its text, joined by line feeds. ``n_chars`` is counted anew.
    """
    mixed, draws = mix(docs, text, key, source, **options)
    keys = ["doc_id", "source", "mark"]
    runs = taken_runs(mixed, draws).groupBy(*keys, "first").agg(F.collect_list(F.struct("epoch", "lo", "hi")).alias("_runs"))
    runs = runs.join(mixed.select("source", "first", "size", "mark").filter("size > 0").distinct().alias("m"), [
        runs["source"].eqNullSafe(F.col("m.source")), runs["first"] == F.col("m.first"), runs["mark"] == F.col("m.mark")
    ]).select(runs["doc_id"].alias("_id"), runs["source"].alias("_source"), runs["mark"].alias("_mark"), "_runs", F.col("m.size").alias("_size"))
    mark = free_name(docs, "_text_hash")
    named = docs.withColumn(mark, F.xxhash64(text))
    if not mixed.groupBy(*keys).count().filter("count > 1").isEmpty():
        named = named.dropDuplicates([key, source, mark])  # rows that repeat have a list of runs each
    match = F.col(f"l.{key}").eqNullSafe(F.col("r._id")) & F.col(f"l.{source}").eqNullSafe(F.col("r._source")) & (
        F.col(f"l.{mark}") == F.col("r._mark"))
    held, whole = (free_name(docs, c) for c in ("_runs", "_size"))
    both = named.alias("l").join(runs.alias("r"), match).select(
        *[F.col(f"l.{c}") for c in docs.columns], F.col("r._runs").alias(held), F.col("r._size").alias(whole)
    )
    names = docs.columns

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = re.compile(WORD)
        for batch in pieces(batches, text):
            rows, texts = [], []
            for i, (value, runs, size) in enumerate(zip(*(batch.column(c).to_pylist() for c in (text, held, whole)))):
                epochs: dict[int, list[tuple[int, int]]] = {}
                for run in runs:
                    epochs.setdefault(run["epoch"], []).append((run["lo"], run["hi"]))
                spans = None
                for epoch in sorted(epochs):
                    taken: list[list[int]] = []
                    for lo, hi in sorted(epochs[epoch]):
                        if taken and taken[-1][1] == lo:
                            taken[-1][1] = hi
                        else:
                            taken.append([lo, hi])
                    rows.append(i)
                    if taken == [[0, size]]:
                        texts.append(value)
                    else:
                        spans = spans or [m.span() for m in words.finditer(value)]
                        texts.append("\n".join(value[spans[lo][0]: spans[hi - 1][1]] for lo, hi in taken))
            out = batch.take(pa.array(rows, pa.int64()))
            columns = {c: out.column(c) for c in names} | {text: pa.array(texts, pa.string())}
            if n_chars in columns:
                columns[n_chars] = pa.array([len(t) for t in texts], out.column(n_chars).type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return both.mapInArrow(cut, docs.schema)
