"""BPE encoding through a table of distinct words, and decoding through a table of pieces that each task looks ids up in."""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, types as T

from tidemark.llm.common import pieces, runs


#: Words in a group of documents that shares one list of distinct words; buckets that distinct words are dealt to.
GROUP_WORDS, MOST_BUCKETS = 1_500_000, 1024

#: The split rule that the quick path stands for.
SPLIT_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WHITE = "\t\n\x0b\x0c\r \x85\xa0"
#: Characters whose lower case and composition are settled below U+0180: all there but the dotted capital I.
UNSETTLED = re.compile("[^\x00-įı-ſ]")


def _quick_rule() -> Callable[[str], list[str]]:
    """``SPLIT_RULE`` over lower-case texts below U+0180, with the classes written out."""
    kinds = {c: unicodedata.category(c)[0] for c in map(chr, range(0x180))}
    letters, digits = ("".join(map(re.escape, (c for c, k in kinds.items() if k == x))) for x in "LN")
    white = "".join(map(re.escape, WHITE))
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{white}{letters}{digits}]+").findall


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Splitter:
    """Texts into the words that the tokenizer at ``path`` encodes one by one.

    A special token in the text is a word of its own, marked by a leading NUL.
    """

    def __init__(self, path: str):
        from tokenizers import Regex, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        first = made["pre_tokenizer"]["pretokenizers"][0]
        rule = first["pattern"]["Regex"]
        self.normalize = _tokenizer(path).normalizer.normalize_str
        self.split = pre_tokenizers.Split(Regex(rule), "removed", invert=True).pre_tokenize_str
        special = [t["content"] for t in made["added_tokens"]]
        self.special = re.compile("(" + "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.quick = _quick_rule() if rule == SPLIT_RULE else None

    def _plain(self, text: str) -> list[str]:
        if self.quick and not UNSETTLED.search(text):
            return self.quick(text.lower())
        return [w for w, _ in self.split(self.normalize(text))]

    def __call__(self, text: str | None) -> list[str]:
        if not text:
            return []
        parts = self.special.split(text) if self.special else [text]
        if len(parts) == 1:
            return self._plain(text)
        return [w for i, p in enumerate(parts) for w in (["\0" + p] if i % 2 else self._plain(p))]


class WordEncoder:
    """Ids of one word, as ``Splitter`` gives it."""

    def __init__(self, path: str):
        from tokenizers import pre_tokenizers

        self.of = _tokenizer(path)
        self.special = {"\0" + t.content: i for i, t in self.of.get_added_tokens_decoder().items()}
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str

    def __call__(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        return [t.id for part, _ in self.bytes(word) for t in self.of.model.tokenize(part)]


def packed(codes: np.ndarray) -> bytes:
    """Whole numbers in one byte for each seven bits, the last of which is below 128; then deflated."""
    size = np.ones(len(codes), np.int8)
    for bits in (7, 14, 21, 28):
        size += codes >= 1 << bits
    end = np.cumsum(size, dtype=np.int64)
    out = np.zeros(int(end[-1]) if len(end) else 0, np.uint8)
    out[end - 1] = codes & 127
    for k in range(1, int(size.max(initial=1))):
        long = size > k
        out[end[long] - 1 - k] = 128 | (codes[long] >> 7 * k & 127)
    return zlib.compress(out.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(data), np.uint8)
    end = np.flatnonzero(raw < 128)
    out = raw[end].astype(np.int64)
    size = np.diff(end, prepend=-1)
    for k in range(1, int(size.max(initial=1))):
        long = size > k
        out[long] |= (raw[end[long] - k].astype(np.int64) & 127) << 7 * k
    return out


#: Rows on the way: documents of a group as codes, then lists of its words or of their ids.
ON_THE_WAY = "slot long, group long, words long, ends binary, codes binary, places binary, list binary, sizes binary"


def grouped_words(docs: DataFrame, path: str, text: str, key: str, buckets: int, group_words: int = GROUP_WORDS) -> DataFrame:
    """Two kinds of rows for each group of documents.

    One row has keys, ends (words up to each document's end) and codes, which name each word of the documents
    in turn by its place among the distinct words of the group, the frequent first. The others have those
    words, one row for each bucket of a hash of the word, with their places. A group ends at ``group_words``
    words; a longer document is a group alone.
    """
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField("keys", T.ArrayType(kind)), *T._parse_datatype_string(ON_THE_WAY).fields])

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, part, made, total = Splitter(path), TaskContext.get().partitionId(), 0, 0
        keys: list = []
        sizes: list[int] = []
        codes: list[np.ndarray] = []
        number: defaultdict[str, int] = defaultdict()
        number.default_factory = number.__len__

        def group(key_type: pa.DataType) -> pa.RecordBatch:
            of = np.concatenate(codes)
            order = np.argsort(-np.bincount(of, minlength=len(number)), kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order))
            dealt: list[tuple[list[int], list[str]]] = [([], []) for _ in range(buckets)]
            names = list(number)
            for place, i in enumerate(order.tolist()):
                to = dealt[xxhash.xxh32_intdigest(names[i]) % buckets]
                to[0].append(place)
                to[1].append(names[i])
            name = (part << 32) + made
            rows = [{"keys": keys, "slot": -1 - name, "group": name, "words": len(number), "ends": packed(np.array(sizes, np.int64)), "codes": packed(rank[of])}]
            rows += [{"slot": b, "group": name, "places": packed(np.diff(np.array(at), prepend=0)), "list": zlib.compress("\n".join(own).encode(), 1)}
                     for b, (at, own) in enumerate(dealt) if at]
            types = [(f.name, pa.list_(key_type) if f.name == "keys" else pa.binary() if f.dataType == T.BinaryType() else pa.int64()) for f in schema]
            return pa.RecordBatch.from_pylist(rows, pa.schema(types))

        key_type = None
        for batch in pieces(batches, text):
            key_type = batch.schema.field(key).type
            for k, t in zip(batch.column(key).to_pylist(), batch.column(text)):
                found = split(t.as_py())
                if keys and total + len(found) > group_words:
                    yield group(key_type)
                    made, total = made + 1, 0
                    keys, sizes, codes = [], [], []
                    number.clear()
                keys.append(k)
                sizes.append(len(found))
                total += len(found)
                codes.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
        if keys:
            yield group(key_type)

    return docs.select(key, text).mapInArrow(make, schema)


def encoded_words(groups: DataFrame, path: str) -> DataFrame:
    """``groups`` with lists of ids in place of words. A word has one bucket, so it is encoded once."""
    names = groups.columns

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = WordEncoder(path)
        known: dict[str, list[int]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                if (words := row.column("list")[0].as_py()) is not None:
                    ids = []
                    for word in zlib.decompress(words).decode().split("\n"):
                        if (own := known.get(word)) is None:
                            own = known[word] = code(word)
                        ids.append(own)
                    columns = dict(zip(names, row.columns))
                    columns["sizes"] = pa.array([packed(np.array(list(map(len, ids)), np.int64))], pa.binary())
                    columns["list"] = pa.array([packed(np.array([x for own in ids for x in own], np.int64))], pa.binary())
                    row = pa.RecordBatch.from_arrays(list(columns.values()), names)
                yield row

    return groups.repartition("slot").mapInArrow(encode, groups.schema)


def _vocabulary(path: str) -> pa.Array:
    """The pieces by id."""
    of = _tokenizer(path)
    return pa.array([of.id_to_token(i) for i in range(of.get_vocab_size())], pa.large_string())


def _spelled(lists: pa.Array, vocabulary: pa.Array) -> pa.Array:
    """Of each list of ids the pieces with a space between; null for a null list."""
    lens = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(lens)])
    found = pa.LargeListArray.from_arrays(pa.array(ends), vocabulary.take(lists.flatten()))
    joined = pc.binary_join(found, pa.scalar(" ", pa.large_string())).cast(pa.string())
    return pc.if_else(lists.is_valid(), joined, pa.scalar(None, pa.string()))


def encode(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", group_words: int = GROUP_WORDS,
           decoded: str | None = None) -> DataFrame:
    """(``key``, ids): token ids of each text, as the tokenizer file at ``path`` encodes it without added tokens.

    Null texts count as empty and have no ids. Rows that repeat are encoded each; other columns are ignored.
    An empty table gives no rows. Texts are moved as codes into their group's list of distinct words; only that
    list moves to where its words are encoded, and meets the codes again by place. With ``decoded`` a column of
    that name has what ``decode`` gives, made where the ids are: two steps in Python behind each other would keep
    two workers for each core, and each worker holds its libraries and the vocabulary for as long as it lives.
    """
    buckets = min(MOST_BUCKETS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    coded = encoded_words(grouped_words(docs, path, text, key, buckets, group_words), path)
    schema = T.StructType([docs.schema[key], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if decoded:
        schema = schema.add(decoded, T.StringType())

    def lists_of(rows: pa.Table) -> tuple[pa.Array, pa.Array]:
        """Keys and ids of the documents of one group."""
        own = rows.filter(pc.is_valid(rows.column("codes")))
        lists = rows.filter(pc.is_valid(rows.column("list")))
        n = own.column("words")[0].as_py()
        size, start = np.zeros(n, np.int64), np.zeros(n, np.int64)
        flat, used = [], 0
        for places, sizes, ids in zip(*(lists.column(c).to_pylist() for c in ("places", "sizes", "list"))):
            at, lens = np.cumsum(unpacked(places)), unpacked(sizes)
            size[at], start[at] = lens, used + np.cumsum(lens) - lens
            flat.append(unpacked(ids).astype(np.int32))
            used += len(flat[-1])
        ids = np.concatenate(flat) if flat else np.zeros(0, np.int32)
        codes = unpacked(own.column("codes")[0].as_py()).astype(np.int32)
        total = np.concatenate([[0], np.cumsum(size[codes])])
        out = np.empty(total[-1], np.int32)
        for at in range(0, len(codes), 100_000):  # in stretches, so that places are not held for all words at once
            part = codes[at: at + 100_000]
            lens, first = size[part], total[at: at + len(part)]
            lo, hi = total[at], total[at + len(part)]
            out[lo:hi] = ids[np.repeat(start[part] - first, lens) + np.arange(lo, hi)]
        ends = total[np.concatenate([[0], np.cumsum(unpacked(own.column("ends")[0].as_py()))])]
        return own.column("keys").combine_chunks().flatten(), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(out))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path) if decoded else None
        for rows in runs(batches, ["group"]):
            keys, found = lists_of(rows)
            for at in range(0, len(keys), 200):
                columns = [keys.slice(at, 200), found.slice(at, 200)]
                if decoded:
                    columns.append(_spelled(columns[1], vocabulary))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return coded.repartition("group").sortWithinPartitions("group").mapInArrow(place, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` and ``name``, the pieces of ``ids`` with a space between.

    Ids meet the table of pieces by number. The table is the vocabulary, whose size the tokenizer file
    fixes; each task holds it, so no id is shuffled. Null ids give null, no ids an empty text. A column called
    ``name`` gives way.
    """
    encoded = encoded.drop(name)
    schema = T.StructType([*encoded.schema.fields, T.StructField(name, T.StringType())])

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                yield pa.RecordBatch.from_arrays([*part.columns, _spelled(part.column(ids), vocabulary)], [*part.schema.names, name])

    return encoded.mapInArrow(join, schema)
