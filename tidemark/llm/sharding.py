"""Shards of near equal bytes: a K-d tree over metadata, split at distributed weighted medians."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import numbered, small, written

#: Histogram bins of one round of the search for a weighted median.
BINS = 4096


def text_ranks(rows: DataFrame, name: str) -> DataFrame:
    """(_value, _rank): each distinct string of a column and its place in code point order from 0; null has none."""
    values = rows.filter(F.col(name).isNotNull()).select(F.col(name).alias("_value")).distinct().sort("_value")
    placed = values.rdd.zipWithIndex().map(lambda x: (x[0][0], x[1]))
    return written(rows.sparkSession.createDataFrame(placed, "_value string, _rank long"), "ranks")


def size_coordinate(value: Column) -> Column:
    """Sizes on a logarithmic scale in steps of a millionth; null comes first."""
    return F.coalesce((F.log2(F.greatest(value, F.lit(0)) + 1.0) * 1_000_000).cast("long"), F.lit(-1))


@dataclass
class _Node:
    """A node in search of its split. Rows of ``key`` from lo to hi are still in question."""

    leaves: int
    key: str
    lo: int
    hi: int
    want: float
    at: int | None = None


def kd_leaves(rows: DataFrame, size: str, dims: dict[str, Column], tie: Column, target_bytes: float) -> DataFrame:
    """``rows`` and ``leaf``, a number from 0: leaves of about ``target_bytes`` each.

    A node that holds k times the target is split at its weighted median (for odd k at floor(k/2)/k) along
    the dimension whose values spread widest, as a share of the spread over all rows. Rows of equal value are
    parted by ``tie``; rows equal in that too stay together. Each round of a search is one small histogram
    for each node, whatever the number of rows.
    """
    names = list(dims)
    state = rows.select("*", *[c.alias(f"_{d}") for d, c in dims.items()], tie.alias("_tie"), F.lit(0).cast("long").alias("_node"))
    state = written(state, "kd")
    spread: dict[str, int] | None = None
    done: dict[int, int] = {}
    leaves = {0: None}
    while leaves:
        held = state.filter(F.col("_node").isin(list(leaves)) if len(leaves) < 500 else F.lit(True))
        sums = [F.sum(size).alias("bytes")]
        for d in (*names, "tie"):
            sums += [F.min(f"_{d}").alias(f"lo_{d}"), F.max(f"_{d}").alias(f"hi_{d}")]
        search: dict[int, _Node] = {}
        for r in held.groupBy("_node").agg(*sums).collect():  # one row per node
            if r["_node"] not in leaves:
                continue
            width = {d: r[f"hi_{d}"] - r[f"lo_{d}"] for d in names}
            spread = spread or {d: max(w, 1) for d, w in width.items()}
            k = leaves[r["_node"]] or max(1, round(r["bytes"] / target_bytes))
            key = max(names, key=lambda d: width[d] / spread[d])
            if k == 1 or (not any(width.values()) and r["lo_tie"] == r["hi_tie"]):
                done[r["_node"]] = k
                continue
            key = key if width[key] else "tie"
            search[r["_node"]] = _Node(k, key, r[f"lo_{key}"], r[f"hi_{key}"], r["bytes"] * (k // 2) / k)
        if not search:
            break
        value_at = {n: (x.key, None) for n, x in search.items()}
        parts: dict[int, tuple[str, int, int]] = {}
        _narrow(state, size, search, {})
        for n, x in search.items():
            value_at[n] = (x.key, x.at)
        ties = {n: _Node(x.leaves, "tie", -1, 1 << 62, x.want) for n, x in search.items() if x.key != "tie"}
        _narrow(state, size, ties, {n: value_at[n] for n in ties})
        for n, x in search.items():
            end = ties[n] if n in ties else x
            parts[n] = (x.key, x.at if n in ties else -2, end.at if end.want > 0 else end.at - 1)
        state = written(_split(state, parts, names), "kd")
        leaves = {}
        for n, x in search.items():
            leaves[2 * n + 1], leaves[2 * n + 2] = x.leaves // 2, x.leaves - x.leaves // 2
    order = {n: i for i, n in enumerate(sorted(_final(done)))}
    number = F.coalesce(*[F.when(F.col("_node") == n, F.lit(i)) for n, i in order.items()], F.lit(0)).cast("int")
    return state.select(*rows.columns, number.alias("leaf"))


def _final(done: dict[int, int]) -> list[int]:
    return list(done) or [0]


def _narrow(state: DataFrame, size: str, search: dict[int, _Node], at: dict[int, tuple[str, int]]) -> None:
    """Sets ``at`` of each node: the value of its key where the running weight passes ``want``.

    ``want`` becomes positive if rows of that value belong to the left part, else not. With ``at`` given,
    only rows at that value of another key count.
    """
    spark = state.sparkSession
    while open_ := {n: x for n, x in search.items() if x.at is None}:
        asked = spark.createDataFrame(
            [(n, x.key, x.lo, max(1, -(-(x.hi - x.lo + 1) // BINS)), *(at.get(n) or ("", 0))) for n, x in open_.items()],
            "_node long, _key string, _lo long, _width long, _by string, _at long",
        )
        values = [c for c in state.columns if c.startswith("_") and c != "_node"]
        pick = F.coalesce(*[F.when(F.col("_key") == c[1:], F.col(c)) for c in values])
        other = F.coalesce(*[F.when(F.col("_by") == c[1:], F.col(c)) for c in values], F.lit(0))
        rows = state.join(F.broadcast(asked), "_node").withColumn("_value", pick).filter(other == F.col("_at"))
        rows = rows.withColumn("_bin", F.expr("(_value - _lo) div _width")).filter(f"_bin between 0 and {BINS - 1}")
        bins: dict[int, list] = {}
        found = rows.groupBy("_node", "_bin").agg(
            F.sum(size).alias("w"), F.min("_value").alias("lo"), F.max("_value").alias("hi")
        )
        for r in found.collect():  # at most BINS rows for each node
            bins.setdefault(r["_node"], []).append(r)
        for n, x in open_.items():
            ordered = sorted(bins[n], key=lambda r: r["_bin"])
            for i, r in enumerate(ordered):
                if r["w"] >= x.want or i == len(ordered) - 1:
                    break
                x.want -= r["w"]
            x.lo, x.hi = r["lo"], r["hi"]
            if x.lo == x.hi:
                x.at = x.lo
                if x.key == "tie":
                    x.want = 1.0 if x.want >= r["w"] / 2 else 0.0


def _split(state: DataFrame, parts: dict[int, tuple[str, int, int]], names: list[str]) -> DataFrame:
    cut = state.sparkSession.createDataFrame(
        [(n, key, at, tie) for n, (key, at, tie) in parts.items()], "_node long, _key string, _at long, _cut long"
    )
    value = F.coalesce(*[F.when(F.col("_key") == d, F.col(f"_{d}")) for d in names], F.lit(-2))
    left = (value < F.col("_at")) | ((value == F.col("_at")) & (F.col("_tie") <= F.col("_cut")))
    node = F.when(F.col("_key").isNull(), F.col("_node")).when(left, 2 * F.col("_node") + 1).otherwise(2 * F.col("_node") + 2)
    return state.join(F.broadcast(cut), "_node", "left").select(*[c for c in state.columns if c != "_node"], node.alias("_node"))


def shards(docs: DataFrame, n: int | None = 8, target_bytes: float | None = None, text: str = "text",
           key: str = "doc_id", metadata: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """One row per row of ``docs``: ``key``, size (UTF-8 bytes and 1), text_crc32, shard, slot.

    Gives ``n`` shards, or as many as ``target_bytes`` asks for. Dimensions are the size and the
    ``metadata`` columns. Null texts count as empty, null metadata as the least value; rows equal in key and
    text stay in one shard. ``slot`` numbers the rows of a shard from 0 in hashed order of segments.
    An empty table gives no rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"), *metadata
    )
    names = [f"d_{m}" for m in metadata]
    rows = rows.select(
        key, "size", "text_crc32", size_coordinate(F.col("size")).alias("d_bytes"), *[F.col(m).cast("string").alias(d) for m, d in zip(metadata, names)]
    )
    rows = written(rows, "shard-sizes")
    ranked = rows
    for d in names:
        others = [c for c in ranked.columns if c != d]
        ranked = ranked.join(small(text_ranks(rows, d)), F.col(d) == F.col("_value"), "left").select(
            *others, F.coalesce("_rank", F.lit(-1)).alias(d)
        )
    rows = ranked
    if target_bytes is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        target_bytes = max(1.0, total / n)
    tie = F.shiftrightunsigned(F.xxhash64(key, "text_crc32"), 2)
    placed = kd_leaves(rows, "size", {d: F.col(f"d_{d}") for d in ("bytes", *metadata)}, tie, target_bytes)
    placed = placed.select(key, "size", "text_crc32", F.col("leaf").alias("shard"))
    return numbered(placed, ["shard"], [key, "text_crc32"], F.lit(1), "slot")
