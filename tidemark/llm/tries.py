"""The prefix trie of conversations, its subtree totals summed by time-forward processing.

A node is a sequence of first turns; it is named by its depth and two 64-bit sums (exclusive or) of hashes of its turns and
their places, so that a name needs no walk along the conversation. Nodes come from one aggregation over the turns. Totals pass
from children to parents in reverse level order: a shard holds whole subtrees as a table sorted by depth, and what a
node sends to its parent waits in a priority queue, which spills, until the parent's turn comes. Subtrees are cut so that shards
stay even: nodes that many conversations share (at most HEAVY of them, at any size) lie above all shards and are
summed last, from what the shards' roots send; below a node with one conversation nothing is left to sum.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.llm.common import written

#: Turns that a rebuilt conversation may take from the first of its hundred, at most.
MOST_SHARED = 5
#: Nodes above all shards, besides the root: those of so many conversations that no more can be.
HEAVY = 2000
#: Messages that a queue holds in memory, and that it reads of a spilled run at a time.
IN_MEMORY, READ = 200_000, 4096
#: Bytes of a block of conversation numbers.
ENDS_BLOCK = 1 << 16

_KEY = ["depth", "k1", "k2"]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


# --- conversations to nodes -----------------------------------------------------------------------------

def shared_turns(conv_id: Column) -> Column:
    """How many first turns a rebuilt conversation takes from the first of its hundred, if that has them."""
    return (F.crc32(conv_id.cast("string")) % (MOST_SHARED + 1)).cast("int")


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv, place, digest, chars, part): the turns of each conversation, numbered from 1.

    Rows are sorted by ranges, so a conversation of any length is spread over partitions; those that go on in a
    later partition are at most one for each.
    """
    text, role = (F.coalesce(F.col(c), F.lit("")) for c in ("text", "role"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.char_length(text).cast("long").alias("chars"),
        F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
    )
    order = ["conv", "turn", "digest"]
    laid = written(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "turns")
    counts = laid.groupBy("conv", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.sum("n").over(before)).filter("start > 0").select("conv", "part", "start")
    within = Window.partitionBy("conv", "part").orderBy("turn", "digest")
    return laid.withColumn("place", F.row_number().over(within)).join(F.broadcast(starts), ["conv", "part"], "left").select(
        "conv", (F.col("place") + F.coalesce("start", F.lit(0))).alias("place"), "digest", "chars", "part"
    )


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations (conv, length) and their turns (conv, depth, digest, chars, part, last)."""
    shared = shared_turns(F.col("conv"))
    whole = turns.groupBy("conv").agg(F.count("*").alias("own"))
    heads = turns.filter((F.col("conv") % 100 == 0) & (F.col("place") <= MOST_SHARED)).groupBy(F.col("conv").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("place", "digest", "chars"))).alias("head")
    )
    none = F.array().cast(heads.schema["head"].dataType)
    lists = whole.withColumn("base", F.col("conv") - F.col("conv") % 100).join(heads, "base", "left")
    lists = written(lists.select("conv", "own", F.slice(F.coalesce("head", none), F.lit(1), shared).alias("head")).withColumn(
        "length", F.size("head") + F.greatest(F.col("own") - shared, F.lit(0))
    ), "rebuilt")
    lent = lists.select("conv", "length", F.explode("head").alias("t")).select(
        "conv", F.col("t.place").cast("long").alias("depth"), "t.digest", "t.chars", F.lit(-1).alias("part"),
        (F.col("t.place") == F.col("length")).alias("last"),
    )
    depth = F.col("place") - shared + F.size("head")
    kept = turns.filter(F.col("place") > shared).join(lists, "conv").select(
        "conv", depth.cast("long").alias("depth"), "digest", "chars", "part", (depth == F.col("length")).alias("last")
    )
    return lists.select("conv", "length"), lent.unionByName(kept)


def _paths(rebuilt: DataFrame) -> DataFrame:
    """Each turn with the name of its node (depth, k1, k2) and of the parent (p1, p2)."""
    laid = written(rebuilt.withColumns({
        "e1": F.xxhash64("depth", "digest"), "e2": F.xxhash64("digest", "depth", F.lit("second")),
    }), "rebuilt-turns")
    sums = laid.groupBy("conv", "part").agg(F.bit_xor("e1").alias("s1"), F.bit_xor("e2").alias("s2"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("conv", "part", *[F.coalesce(F.bit_xor(s).over(before), F.lit(0)).alias(s) for s in ("s1", "s2")])
    within = Window.partitionBy("conv", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = laid.withColumns({"l1": F.bit_xor("e1").over(within), "l2": F.bit_xor("e2").over(within)})
    named = local.join(carried, ["conv", "part"]).withColumns({
        "k1": F.col("l1").bitwiseXOR(F.col("s1")), "k2": F.col("l2").bitwiseXOR(F.col("s2")),
    })
    return named.select(
        "conv", *_KEY, F.col("k1").bitwiseXOR(F.col("e1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("e2")).alias("p2"),
        "digest", "chars", "last",
    )


def _nodes(paths: DataFrame, lists: DataFrame) -> DataFrame:
    """One row per node: its smallest conversation, members, ends, the length of its last text, its parent's name.

    Equal names must have equal last turns; as this holds for the parents too, equal names are equal sequences.
    """
    same = F.when(F.min("digest") == F.max("digest"), F.count("*")).otherwise(F.raise_error(F.lit("two turns with one name")).cast("long"))
    below = paths.groupBy(*_KEY).agg(
        F.min("conv").alias("owner"), same.alias("n"), F.count_if("last").alias("ends"), F.max("chars").alias("chars"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"),
    )
    zero = F.lit(0).cast("long")
    root = lists.agg(F.min("conv").alias("owner"), F.count("*").alias("n"), F.count_if(F.col("length") == 0).alias("ends")).filter(
        "n > 0"
    ).select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "owner", "n", "ends", zero.alias("chars"), zero.alias("p1"), zero.alias("p2"))
    return below.unionByName(root)


# --- totals ---------------------------------------------------------------------------------------------

class Queue:
    """Messages (key..., values...) of whole numbers in order of their key; beyond ``most`` in memory they spill.

    A spilled run is an unnamed file of this task alone, read once in order; it goes with the task.
    """

    def __init__(self, width: int, most: int = IN_MEMORY):
        self.width, self.most = width, most
        self.held: list[tuple] = []
        self.runs: list[tuple] = []  # (next message, number, the rest)

    def push(self, message: tuple) -> None:
        heapq.heappush(self.held, message)
        if len(self.held) > self.most:
            self._spill()

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()
        np.array(sorted(self.held), np.int64).tofile(file)
        file.seek(0)
        self.held = []
        self._next(self._read(file), len(self.runs))

    def _read(self, file) -> Iterator[tuple]:
        with file:
            while len(block := np.fromfile(file, np.int64, READ * self.width)):
                yield from map(tuple, block.reshape(-1, self.width).tolist())

    def _next(self, rest: Iterator[tuple], number: int) -> None:
        if (message := next(rest, None)) is not None:
            heapq.heappush(self.runs, (message, number, rest))

    def pop_if(self, key: tuple) -> tuple | None:
        """The first message, if it is for ``key``."""
        spilled = bool(self.runs) and (not self.held or self.runs[0][0] < self.held[0])
        if not spilled and not self.held:
            return None
        first = self.runs[0][0] if spilled else self.held[0]
        if first[: len(key)] != key:
            return None
        if spilled:
            _, number, rest = heapq.heappop(self.runs)
            self._next(rest, number)
        else:
            heapq.heappop(self.held)
        return first


def _forward(shards: DataFrame, in_memory: int = IN_MEMORY) -> DataFrame:
    """Totals of each node of a partition that is sorted by reverse level order, and what its roots send on.

    A row has, besides its name and its parent's, what came from outside the shard (``children``, ``leaves``, ``saved``),
    its own ``worth``, and whether its parent is ``inside``. Results have the node's totals; rows without an
    ``owner`` are messages to a node outside, one for each such node.
    """
    totals = [T.StructField(c, T.LongType()) for c in ("children", "leaves", "saved")]
    others = [f.name for f in shards.schema if f.name not in ("children", "leaves", "saved", "worth", "inside")]
    schema = T.StructType([*[T.StructField(c, shards.schema[c].dataType) for c in others], *totals])

    def sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, outside = Queue(5, in_memory), {}
        fields = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*_KEY, "p1", "p2", "children", "leaves", "saved", "worth", "inside")]
            found = []
            for depth, k1, k2, p1, p2, children, leaves, saved, worth, inside in zip(*columns):
                key = (-depth, k1, k2)
                while (message := queue.pop_if(key)) is not None:
                    children, leaves, saved = children + 1, leaves + message[3], saved + message[4]
                leaves, saved = leaves if children else 1, saved + worth
                found.append((children, leaves, saved))
                if inside:
                    queue.push((1 - depth, p1, p2, leaves, saved))
                elif depth:
                    sums = outside.setdefault((depth - 1, p1, p2), [0, 0, 0])
                    for i, x in enumerate((1, leaves, saved)):
                        sums[i] += x
            made = [pa.array(list(c), pa.int64()) for c in (zip(*found) if found else ((), (), ()))]
            out = pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], *made], names=schema.fieldNames())
            fields = out.schema
            yield out
        if outside:
            sent = [dict(zip((*_KEY, "children", "leaves", "saved"), (*name, *sums))) for name, sums in outside.items()]
            yield pa.RecordBatch.from_pylist(sent, schema=fields)

    return shards.mapInArrow(sweep, schema)


def _parents(nodes: DataFrame, heavy: DataFrame, light: DataFrame) -> DataFrame:
    """Nodes with their parent's owner and whether the parent is ``heavy``, ``light`` or ``single``; the root has none.

    Children of heavy nodes, of which there may be any number, find them by the broadcast; a light node has few.
    """
    def names(df: DataFrame) -> DataFrame:
        return df.select(F.col("depth").alias("_d"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("owner").alias("_owner"))

    match = (F.col("depth") == F.col("_d") + 1) & (F.col("p1") == F.col("_k1")) & (F.col("p2") == F.col("_k2"))
    first = nodes.join(F.broadcast(names(heavy)), match, "left").drop("_d", "_k1", "_k2")
    under = first.filter("_owner IS NOT NULL OR depth = 0").select(
        *nodes.columns, F.col("_owner").alias("parent"), F.when(F.col("depth") > 0, "heavy").alias("kind")
    )
    rest = first.filter("_owner IS NULL AND depth > 0").select(*nodes.columns).join(names(light), match, "left").select(
        *nodes.columns, F.coalesce("_owner", "owner").alias("parent"),
        F.when(F.col("_owner").isNotNull(), "light").otherwise("single").alias("kind"),
    )
    return under.unionByName(rest)


def _totals(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every node with its parent's owner and the totals of its subtree."""
    turns = nodes.filter("depth > 0").agg(F.sum("n")).first()[0] or 0
    least = max(2, -(-turns // HEAVY))
    heavy = written(nodes.filter((F.col("n") >= least) | (F.col("depth") == 0)), "heavy-nodes")
    light = nodes.filter((F.col("n").between(2, least - 1)) & (F.col("depth") > 0))
    linked = written(_parents(nodes, heavy, light), "linked-nodes")
    worth = ((F.col("n") - 1) * F.col("chars")).alias("worth")
    zero = F.lit(0).cast("long")

    # A node of one conversation has one leaf below it and saves nothing; where such a path begins, its parent hears of it.
    single = linked.filter("n = 1 AND depth > 0")
    begun = single.filter("kind != 'single'").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")
    ).agg(F.count("*").alias("begun"))
    begun = written(begun, "begun-paths")
    columns = ["depth", "k1", "k2", "p1", "p2", "owner", "n", "parent"]
    alone = single.select(*columns, F.when(F.col("ends") > 0, 0).otherwise(1).cast("long").alias("children"), F.lit(1).cast("long").alias("leaves"), zero.alias("saved"))

    # The first node below the heavy ones on a conversation's path is the root of its subtree: what a shard is made of.
    names = F.broadcast(heavy.select(*_KEY))
    roots = paths.join(names, _KEY, "left_anti").groupBy("conv").agg(F.min(F.struct("depth", "k1", "k2")).alias("root"))
    several = linked.filter(F.col("n").between(2, least - 1) & (F.col("depth") > 0)).join(begun, _KEY, "left").join(
        roots, F.col("owner") == F.col("conv")
    )
    outside = F.coalesce("begun", F.lit(0)).cast("long")
    shards = several.select(
        *columns, worth, outside.alias("children"), outside.alias("leaves"), zero.alias("saved"),
        (F.col("kind") == "light").alias("inside"), "root",
    ).repartition("root").drop("root").sortWithinPartitions(F.desc("depth"), "k1", "k2")
    swept = written(_forward(shards), "swept-shards")

    # Heavy nodes hear from the shards' roots and from paths of one conversation.
    sent = swept.filter("owner IS NULL").select(*_KEY, "children", "leaves", "saved").unionByName(
        begun.select(*_KEY, F.col("begun").alias("children"), F.col("begun").alias("leaves"), zero.alias("saved"))
    ).join(names, _KEY, "left_semi").groupBy(*_KEY).agg(*[F.sum(c).alias(c) for c in ("children", "leaves", "saved")])
    heard = [F.coalesce(c, F.lit(0)).alias(c) for c in ("children", "leaves", "saved")]
    top = linked.join(names, _KEY, "left_semi").join(sent, _KEY, "left").select(
        *columns, worth, *heard, (F.col("depth") > 0).alias("inside")
    ).coalesce(1).sortWithinPartitions(F.desc("depth"), "k1", "k2")  # HEAVY rows and the root, at any size
    return alone.unionByName(swept.filter("owner IS NOT NULL")).unionByName(_forward(top))


# --- ends -------------------------------------------------------------------------------------------------

def _ends(paths: DataFrame, lists: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of the nodes where conversations end.

    Numbers are packed in order by ranges of (node, number), so a node where very many end reaches its last task as a
    few blocks, whose bytes are hashed in order and never held together.
    """
    zero = F.lit(0).cast("long")
    ends = paths.filter("last").select(*_KEY, "conv").unionByName(
        lists.filter("length = 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv")
    )
    keys = [T.StructField(c, T.LongType()) for c in _KEY]
    packed = T.StructType([*keys, T.StructField("first", T.LongType()), T.StructField("numbers", T.StringType())])
    hashed = T.StructType([*keys, T.StructField("ends_sha256", T.StringType())])

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, last = [], None
            for *key, conv in zip(*[batch.column(c).to_pylist() for c in (*_KEY, "conv")]):
                if key != last or len(out[-1][4]) * 8 >= ENDS_BLOCK:
                    out.append((*key, conv, []))
                    last = key
                out[-1][4].append(str(conv))
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([r[i] for r in out], pa.int64()) for i in range(4)], pa.array([",".join(r[4]) for r in out], pa.string())],
                names=packed.fieldNames(),
            )

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for *name, numbers in zip(*[batch.column(c).to_pylist() for c in (*_KEY, "numbers")]):
                if name == key:
                    state.update(b",")
                else:
                    if state:
                        out.append((*key, state.hexdigest()))
                    key, state = name, hashlib.sha256()
                state.update(numbers.encode())
            yield _rows(out, hashed)
        if state:
            yield _rows([(*key, state.hexdigest())], hashed)

    blocks = ends.repartitionByRange(*_KEY, "conv").sortWithinPartitions(*_KEY, "conv").mapInArrow(pack, packed)
    return written(blocks, "ends").repartition(*_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(digest, hashed)


def _rows(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = [pa.string() if f.dataType == T.StringType() else pa.int64() for f in schema]
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=schema.fieldNames())


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Conversation c is rebuilt of the first ``shared_turns(c)`` turns of c - c % 100 (fewer if it has fewer, none if it is not
    there; the remainder has the sign of c) and its own turns after as many. Turns go by ``turn``, null first, ties by the SHA-256
    of role and text; repeated rows are turns of their own. Null role or text is empty. Rows without a conv_id are no
    conversation and take no part. Texts are read once, for a digest and a length. An empty table has no nodes, not even a
    root. Other columns are ignored.
    """
    turns = written(_turns(conversations.select("conv_id", "turn", "role", "text")), "numbered-turns")
    lists, rebuilt = _rebuilt(turns)
    paths = written(_paths(rebuilt), "paths")
    nodes = written(_nodes(paths, lists), "nodes")
    found = _totals(paths, nodes).alias("n").join(_ends(paths, lists).alias("e"), _KEY, "left")
    return found.select(
        F.col("owner").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"),
    )
