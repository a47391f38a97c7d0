"""Passages that repeat across documents, by compacting a De Bruijn graph of the words.

An edge is a sequence of WINDOW words, a window of one document. The graph is never held whole: edges that follow
each other in a document and share their minimizer (of the k-mers in the window, the one with the least hash) form a
path. Equal edges have equal minimizers, so an edge can only repeat where its minimizer does. Paths of a minimizer that
are all alike do not branch: they are compacted, and a repeat of the first one is a repeat edge by edge. Where paths of
a minimizer differ, the first of each kind is taken apart and its edges are joined one by one. Claims that run on
against the same source compact to long spans, and the words at both coordinates of a span are compared before it counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.llm.common import pieces, small, written
from tidemark.llm.wordhash import LONG, joined_bytes, mixed, stretches, word_hashes

#: Words of an edge and of the k-mers that minimizers are taken from.
WINDOW, KMER = 20, 8
#: Words of one text that are cut into paths at a time; a path ends at the border.
BLOCK = 1 << 20
#: Bytes of the short texts that are hashed together: arrays of about 40 bytes for each.
PIECE = 1 << 18
#: Starts of a document that one task compacts into spans.
STRETCH = 1 << 16
#: Requests that may be broadcast, summed over documents: 8 bytes each.
MOST_REQUESTS = 4_000_000
#: Windows of a document that is a copy as a whole: all of them.
ALL = (1 << 31) - 1

_FACTOR = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_ROW = ["_key", "_tag"]


# --- hashes of windows ------------------------------------------------------------------------------

def _sums(words: np.ndarray, length: int, factor: int) -> np.ndarray:
    """For each place the polynomial in ``factor`` of the ``length`` words from it on, by doubling."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, have, part, at = None, 0, words, 1
    rest = length
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                out = part if out is None else out[: len(words) - have - at + 1] * np.uint64(pow(factor, at, 1 << 64)) + part[have:]
                have += at
            rest >>= 1
            if rest:
                part = part[:-at] * np.uint64(pow(factor, at, 1 << 64)) + part[at:]
                at *= 2
        return out[:n]


def windows(words: np.ndarray, lane: int = 0) -> np.ndarray:
    """A hash of the WINDOW words from each place on; lanes are independent of each other."""
    if lane:
        words = mixed(words ^ np.uint64(_FACTOR[lane]))
    return mixed(_sums(words, WINDOW, _FACTOR[lane]))


def paths(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Minimizer, hash of all words, first window and number of windows of each path, in order.

    ``owner`` tells the text of each word; windows that cross texts are no edges. Of equal k-mers in a
    window the first is its minimizer, so a path has at most WINDOW - KMER + 1 windows.
    """
    edges = windows(words)
    n = len(edges)
    if not n:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    least = mixed(_sums(words, KMER, _FACTOR[0]))
    place = np.arange(len(least), dtype=np.int64)
    width, span = WINDOW - KMER + 1, 1
    while span < width:
        step = min(span, width - span)
        later = least[step:] < least[:-step]
        least, place = np.where(later, least[step:], least[:-step]), np.where(later, place[step:], place[:-step])
        span += step
    valid = np.flatnonzero(owner[:n] == owner[WINDOW - 1:])
    if not len(valid):
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    at = place[valid]
    cut = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (np.diff(valid) != 1)]))
    first, last = valid[cut], valid[np.concatenate([cut[1:], [len(valid)]]) - 1]
    count = last - first + 1
    with np.errstate(over="ignore"):
        whole = mixed(edges[first] * np.uint64(_FACTOR[1]) + edges[last] + count.astype(np.uint64))
    return least[first], whole, first, count


def _hashed(values: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Word hashes and their texts' numbers, with the place of the first word: short texts together, long ones by blocks."""
    data, owner = joined_bytes([v if len(v) <= LONG else b"" for v in values])
    words, of = word_hashes(data, owner)
    if len(words):
        yield words, of, 0
    for i, value in enumerate(values):
        if len(value) > LONG:
            parts = [np.frombuffer(p, np.uint8) for p in stretches(value)]
            words = np.concatenate([word_hashes(p, np.zeros(len(p), np.int8))[0] for p in parts])
            for start in range(0, max(1, len(words) - WINDOW + 1), BLOCK):
                block = words[start: start + BLOCK + WINDOW - 1]
                yield block, np.full(len(block), i, np.int32), start


def _begins(of: np.ndarray, texts: int) -> np.ndarray:
    """The place of each text's first word among the words of all."""
    return np.concatenate([[0], np.cumsum(np.bincount(of, minlength=texts))])


def _values(column: pa.Array) -> list[bytes]:
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


# --- over documents -----------------------------------------------------------------------------------

def _rows_of(batch: pa.RecordBatch, at: np.ndarray) -> list[pa.Array]:
    return [batch.column(c).take(pa.array(at)) for c in _ROW]


def _path_table(docs: DataFrame) -> DataFrame:
    schema = T.StructType([
        *[docs.schema[c] for c in _ROW], T.StructField("m", T.LongType()), T.StructField("h", T.LongType()),
        T.StructField("start", T.IntegerType()), T.StructField("n", T.IntegerType()),
    ])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", PIECE):
            values = _values(batch.column("_text"))
            for words, of, at in _hashed(values):
                m, h, first, count = paths(words, of)
                begin = _begins(of, len(values))
                text = of[first]
                yield pa.RecordBatch.from_arrays([
                    *_rows_of(batch, text), pa.array(m.view(np.int64)), pa.array(h.view(np.int64)),
                    pa.array((first - begin[text] + at).astype(np.int32)), pa.array(count.astype(np.int32)),
                ], names=schema.fieldNames())

    return docs.mapInArrow(cut, schema)


def _edge_table(docs: DataFrame) -> DataFrame:
    """Two hashes of each window that a document's ``wanted`` names."""
    schema = T.StructType([
        *[docs.schema[c] for c in _ROW], T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
        T.StructField("start", T.IntegerType()),
    ])

    def take(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", PIECE):
            values, wanted = _values(batch.column("_text")), batch.column("wanted")
            for words, of, at in _hashed(values):
                begin = _begins(of, len(values))
                one, two = windows(words), windows(words, 1)
                rows, places = [], []
                for i in np.unique(of):
                    start, n = _wanted(wanted, int(i))
                    spread = np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                    spread = spread[(spread >= at) & (spread < at + begin[i + 1] - begin[i] - WINDOW + 1)]
                    places.append(spread - at + begin[i])
                    rows.append(np.full(len(spread), i))
                place, row = np.concatenate(places).astype(np.int64), np.concatenate(rows)
                yield pa.RecordBatch.from_arrays([
                    *_rows_of(batch, row), pa.array(one[place].view(np.int64)), pa.array(two[place].view(np.int64)),
                    pa.array((place - begin[row] + at).astype(np.int32)),
                ], names=schema.fieldNames())

    return docs.mapInArrow(take, schema)


def _span() -> Column:
    """Start and number of windows as one whole number: a list of them takes 8 bytes each."""
    return F.shiftleft(F.col("start").cast("long"), 32) + F.col("n")


def _wanted(column: pa.Array, i: int) -> tuple[np.ndarray, np.ndarray]:
    listed = column[i].values.to_numpy()
    return listed >> 32, listed & 0xFFFFFFFF


def _digest_table(docs: DataFrame) -> DataFrame:
    """A digest of the words that each of a document's ``wanted`` spans covers, read from the text."""
    schema = T.StructType([
        *[docs.schema[c] for c in _ROW], T.StructField("start", T.IntegerType()), T.StructField("n", T.IntegerType()),
        T.StructField("digest", T.BinaryType()),
    ])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", PIECE):
            rows, starts, counts, digests = [], [], [], []
            for i, value in enumerate(_values(batch.column("_text"))):
                words = value.split()  # bytes split at 20 and 09 to 0D
                start, n = _wanted(batch.column("wanted"), i)
                rows += [i] * len(start)
                starts.append(start)
                counts.append(n)
                digests += [
                    hashlib.blake2b(b" ".join(words[s: s + k + WINDOW - 1]), digest_size=16).digest() for s, k in zip(start, n)
                ]
            yield pa.RecordBatch.from_arrays([
                *_rows_of(batch, np.array(rows, np.int64)), pa.array(np.concatenate(starts).astype(np.int32)),
                pa.array(np.concatenate(counts).astype(np.int32)), pa.array(digests, pa.binary()),
            ], names=schema.fieldNames())

    return docs.mapInArrow(read, schema)


def _match(left: str, right: str, names: dict[str, str]) -> Column:
    """Null-safe equality of the columns ``names`` maps to each other."""
    out = F.lit(True)
    for a, b in names.items():
        out = out & F.col(f"{left}.{a}").eqNullSafe(F.col(f"{right}.{b}"))
    return out


def _asked(docs: DataFrame, spans: DataFrame, read: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``read`` over the documents that ``spans`` (row, start, n) name, each with its spans as ``wanted``."""
    lists = written(
        spans.groupBy(*_ROW).agg(F.collect_list(_span()).alias("wanted"), F.count("*").alias("_n")), "wanted"
    )
    lists = _small(lists)
    joined = docs.alias("l").join(lists.alias("r"), _match("l", "r", dict(zip(_ROW, _ROW)))).select("l.*", "r.wanted")
    return read(joined)


def _small(lists: DataFrame) -> DataFrame:
    """Broadcast if the documents and what is asked of them are few by count, else joined by a shuffle."""
    asked = lists.agg(F.sum("_n")).first()[0] or 0
    return small(lists.drop("_n")) if asked <= MOST_REQUESTS else lists.drop("_n")


def _named(docs: DataFrame, text: str, key: str) -> DataFrame:
    """``_key``, ``_tag`` and ``_text``: the tag tells apart the texts of a repeated key, and is 0 for all others."""
    named = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    twice = written(named.groupBy("_key").count().filter("count > 1").select("_key"), "repeated-keys")
    if twice.isEmpty():
        return named.withColumn("_tag", F.lit(0).cast("long"))
    marks = small(twice.withColumn("_twice", F.lit(True)))
    return named.alias("l").join(marks.alias("r"), F.col("l._key").eqNullSafe(F.col("r._key")), "left").select(
        "l._key", "l._text", F.when(F.col("r._twice"), F.xxhash64("l._text")).otherwise(F.lit(0)).cast("long").alias("_tag")
    )


def _copies(docs: DataFrame) -> DataFrame:
    """Rows whose whole text another row of a smaller key has: they add nothing to the graph."""
    texts = written(docs.select(*_ROW, F.unhex(F.sha2("_text", 256)).alias("sha")), "texts")
    first = texts.groupBy("sha").agg(F.min(F.struct("_key")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    return texts.join(small(written(first, "first-texts")), "sha").filter(~F.col("_key").eqNullSafe(F.col("first._key"))).select(*_ROW)


def _claims(occurrences: DataFrame, identity: list[str], length: Column) -> DataFrame:
    """Occurrences later than the first of their identity, with the coordinates of the first as source."""
    first = occurrences.groupBy(*identity).agg(
        F.min(F.struct("_key", "start", "_tag")).alias("first"), F.count("*").alias("_n")
    ).filter("_n > 1").drop("_n")
    first = written(first, "first-places")  # read back, so that both sides of the join come straight from a shuffle: hot keys split
    later = ~(F.col("_key").eqNullSafe(F.col("first._key")) & (F.col("start") == F.col("first.start")))
    return occurrences.join(first, identity).filter(later).select(
        *_ROW, "start", length.cast("int").alias("n"),
        F.col("first._key").alias("s_key"), F.col("first._tag").alias("s_tag"), F.col("first.start").alias("s_start"),
    )


def _compacted(claims: DataFrame) -> DataFrame:
    """Claims that follow each other in a document and in their source become one span."""
    keys = [*_ROW, "s_key", "s_tag", "_shift", "_stretch"]
    order = Window.partitionBy(*keys).orderBy("start")
    shifted = claims.withColumns({
        "_shift": F.col("s_start") - F.col("start"), "_stretch": F.floor(F.col("start") / STRETCH),
    }).dropDuplicates([*keys, "start"])
    broken = F.col("start") != F.lag(F.col("start") + F.col("n")).over(order)
    runs = shifted.withColumn("_new", F.coalesce(broken, F.lit(True)).cast("int")).withColumn("_run", F.sum("_new").over(order))
    return runs.groupBy(*keys, "_run").agg(
        F.min("start").alias("start"), F.sum("n").cast("int").alias("n"), F.min("s_start").alias("s_start")
    ).drop("_shift", "_stretch", "_run")


def _verified(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Spans whose words equal those at their source. One that differs (a hash stood for two passages) does not count."""
    here = spans.select(*_ROW, "start", "n")
    there = spans.select(F.col("s_key").alias("_key"), F.col("s_tag").alias("_tag"), F.col("s_start").alias("start"), "n")
    wanted = here.unionByName(there).distinct()
    digests = written(_asked(docs, wanted, _digest_table).distinct(), "digests")
    own = {"_key": "_key", "_tag": "_tag", "start": "start", "n": "n"}
    source = {"s_key": "_key", "s_tag": "_tag", "s_start": "start", "n": "n"}
    return (
        spans.alias("l").join(digests.alias("o"), _match("l", "o", own)).join(digests.alias("s"), _match("l", "s", source))
        .filter(F.col("o.digest") == F.col("s.digest")).select(*[f"l.{c}" for c in spans.columns])
    )


def _repeats(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """Verified spans (row, start, n, source) over documents that are no copies as a whole."""
    alone = docs.alias("l").join(small(copies).alias("r"), _match("l", "r", dict(zip(_ROW, _ROW))), "left_anti").select("l.*")
    table = written(_path_table(alone), "paths")
    met = written(table.groupBy("m").count().filter("count > 1").select("m"), "met-minimizers")
    meeting = written(table.join(met, "m", "left_semi"), "meeting-paths")
    kinds = written(meeting.groupBy("m", "h").agg(F.min(F.struct("_key", "start", "_tag", "n")).alias("first")), "path-kinds")
    branching = written(kinds.groupBy("m").count().filter("count > 1").select("m"), "branching")
    apart = kinds.join(branching, "m", "left_semi").select("first.*")
    edges = written(_asked(docs, apart, _edge_table), "edges")
    claims = _claims(meeting, ["m", "h"], F.col("n")).unionByName(_claims(edges, ["a", "b"], F.lit(1)))
    return _verified(docs, written(_compacted(claims), "spans"))


def repeated_spans(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``start`` and ``n`` of spans of n windows that repeat, and the earlier place of the same words:
    ``source`` (a key) and ``source_start``.

    Documents that are copies as a whole are left out (``without_repeats`` has them); else as ``without_repeats``.
    """
    named = _named(docs, text, key)
    return _repeats(named, written(_copies(named), "copies")).select(
        F.col("_key").alias(key), "start", "n", F.col("s_key").alias("source"), F.col("s_start").alias("source_start")
    )


def without_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``key``, ``n_words``, ``n_removed`` and ``kept``, the text without its repeats.

    Words are runs of characters other than 20 and 09 to 0D, unchanged. A word goes if one of the windows of WINDOW
    words that cover it also starts earlier: under a smaller key, or at a smaller place under the same key. Kept words
    are joined by one space. Null text has no words; texts shorter than a window lose none. Null is the least key. Rows
    that share a key share its coordinates: their windows at one place are equally early, so a row that repeats whole
    loses nothing by it. Texts of any length are read whole. An empty table gives no rows; other columns are ignored.
    """
    named = _named(docs, text, key)
    copies = written(_copies(named), "copies")
    spans = _repeats(named, copies).select(*_ROW, "start", "n")
    whole = copies.distinct().select(*_ROW, F.lit(0).alias("start"), F.lit(ALL).alias("n"))
    lists = written(
        spans.unionByName(whole).groupBy(*_ROW).agg(F.collect_list(_span()).alias("gone"), F.count("*").alias("_n")),
        "repeats",
    )
    joined = named.alias("l").join(_small(lists).alias("r"), _match("l", "r", dict(zip(_ROW, _ROW))), "left").select(
        "l._key", "l._text", "r.gone"
    )
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()),
    ])

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", PIECE):
            gone, total, removed, kept = batch.column("gone"), [], [], []
            for i, value in enumerate(_values(batch.column("_text"))):
                words = value.split()
                total.append(len(words))
                if gone[i].is_valid and len(words) >= WINDOW:
                    start, n = _wanted(gone, i)
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, start, 1)
                    np.add.at(edge, np.minimum(start + n + WINDOW - 1, len(words)), -1)
                    stays = np.flatnonzero(np.cumsum(edge)[:-1] == 0)
                    words = [words[j] for j in stays]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([
                batch.column("_key"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()),
            ], names=schema.fieldNames())

    return joined.mapInArrow(keep, schema)
