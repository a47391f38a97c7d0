"""Near duplicates: an exact Jaccard join on five-word shingles through signature trees."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.common import components, pieces, runs, small, written
from tidemark.llm.wordhash import shingle_sets

#: Documents link when 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Children of a node; sets and shingles of the sets that one tree is made for.
FAN, TREE, TREE_SHINGLES = 8, 2000, 2_000_000
#: Bits of a bitmap: at least LEAST_BITS; for the smallest set of an octave so many per shingle, half as many for the
#: largest: FEW where bitmaps are moved, MANY where the sets are at hand.
LEAST_BITS, FEW, MANY = 512, 4, 32
#: Shingles that stand last in the order because many documents have them: at most so many, in a task's memory.
COMMON, COMMON_IN_TASK, TASK_SHINGLES = 65_536, 8, 1_000_000


def prefix_length(n: int) -> int:
    """Of a set of n, so many of its first members (in an order shared by all sets) meet any linked set's own."""
    return n - -(-PERCENT * n // 100) + 1 if n else 0


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    both = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def octave(n: int) -> int:
    """k where 2**k <= n < 2**(k+1). Sets of an octave have bitmaps of one length."""
    return n.bit_length() - 1


def bits_of(k: int, per: int) -> int:
    return max(LEAST_BITS, per << k)


def bitmap(members: np.ndarray, per: int = FEW) -> np.ndarray:
    """Members' leading bits pick the bits that are set."""
    n = bits_of(octave(len(members)), per)
    bits = np.zeros(n, bool)
    bits[(members >> np.uint64(64 - n.bit_length() + 1)).astype(np.int64)] = True
    return np.packbits(bits).view(np.uint64)


def folded(one: np.ndarray, bits: int) -> np.ndarray:
    """The bitmap of the same members in fewer bits."""
    if len(one) * 64 == bits:
        return one
    return np.packbits(np.unpackbits(one.view(np.uint8)).reshape(bits, -1).any(1)).view(np.uint64)


def set_id(members: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(members.tobytes()) - (1 << 63)


class Tree:
    """A hierarchy over sets: each node has the OR of its bitmaps, the range of its sizes, the most members
    that share a bit with an earlier one, and the class that all its sets are in (or -1)."""

    def __init__(self, maps: np.ndarray, sizes: np.ndarray, classes: np.ndarray):
        spare = sizes - np.bitwise_count(maps).sum(1, dtype=np.int64)
        self.levels = [(maps, sizes, sizes, spare, classes)]
        while len(self.levels[-1][1]) > 1:
            maps, low, high, spare, classes = self.levels[-1]
            at = np.arange(0, len(low), FAN)
            same = np.minimum.reduceat(classes, at)
            self.levels.append((
                np.bitwise_or.reduceat(maps, at, axis=0), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                np.maximum.reduceat(spare, at), np.where(same == np.maximum.reduceat(classes, at), same, -1),
            ))

    def pairs(self, cut: int | None = None, step: int = 100_000) -> Iterator[np.ndarray]:
        """Pairs i < j of sets that may be linked and are not in one class, by descent from the root with itself.

        A pair of nodes goes when their sizes are too far apart, or when bits in common and members that
        share bits cannot make up the overlap that even their smallest sets need. With ``cut``, only pairs
        with i < cut <= j.
        """
        stack = [(len(self.levels) - 1, np.zeros((1, 2), np.int64))]
        while stack:
            level, found = stack.pop()
            maps, low, high, spare, classes = self.levels[level]
            x, y = found[:, 0], found[:, 1]
            fit = (100 * high[x] >= PERCENT * low[y]) & (100 * high[y] >= PERCENT * low[x])
            fit &= (classes[x] != classes[y]) | (classes[x] < 0)
            if cut is not None:
                width = FAN**level
                fit &= (x * width < cut) & ((y + 1) * width > cut)
            x, y = x[fit], y[fit]
            most = np.bitwise_count(maps[x] & maps[y]).sum(1, dtype=np.int64) + np.minimum(spare[x], spare[y])
            fit = (100 + PERCENT) * most >= PERCENT * (low[x] + low[y])
            x, y = x[fit], y[fit]
            if level == 0:
                fit = x < y
                if fit.any():
                    yield np.stack([x[fit], y[fit]], 1)
                continue
            n = len(self.levels[level - 1][1])
            i = (x[:, None, None] * FAN + np.arange(FAN)[None, :, None]) + np.zeros((1, 1, FAN), np.int64)
            j = (y[:, None, None] * FAN + np.arange(FAN)[None, None, :]) + np.zeros((1, FAN, 1), np.int64)
            i, j = i.ravel(), j.ravel()
            fit = (i <= j) & (i < n) & (j < n)
            below = np.stack([i[fit], j[fit]], 1)
            for at in range(0, len(below), step):
                stack.append((level - 1, below[at: at + step]))


def tree_pairs_of(
    maps: list[np.ndarray], sizes: np.ndarray, classes: np.ndarray, cut: int | None = None, per: int = FEW
) -> Iterator[np.ndarray]:
    """Pairs i < j that the trees cannot exclude: one tree for each octave of sizes and what may link with it from above."""
    for k in sorted({octave(int(n)) for n in sizes}):
        low, high = 1 << k, 2 << k
        of = np.flatnonzero((sizes >= low) & (PERCENT * sizes <= 100 * high))
        if len(of) < 2:
            continue
        tree = Tree(np.stack([folded(maps[i], bits_of(k, per)) for i in of]), sizes[of], classes[of])
        for found in tree.pairs(None if cut is None else int((of < cut).sum())):
            found = of[found]
            found = found[sizes[found].min(1) < high]
            if len(found):
                yield found


class Classes:
    """Union of numbered things; the class of a thing is its least member."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def union(self, i: int, j: int) -> None:
        a, b = sorted((self.find(i), self.find(j)))
        self.up[b] = a

    def all(self) -> np.ndarray:
        return np.array([self.find(i) for i in range(len(self.up))], np.int64)


def local_links(sets: list[np.ndarray], classes: Classes, cut: int | None = None) -> list[tuple[int, int]]:
    """Links that join classes of the list, and the classes joined. Neighbours in order are tried before the tree."""
    out = []

    def attempt(i: int, j: int) -> None:
        if classes.find(i) != classes.find(j) and linked(sets[i], sets[j]):
            classes.union(i, j)
            out.append((i, j))

    for i in range(1, len(sets)):
        attempt(0, i)
        attempt(i - 1, i)
    maps, sizes = [bitmap(m, MANY) for m in sets], np.array([len(m) for m in sets], np.int64)
    for found in tree_pairs_of(maps, sizes, classes.all(), cut, MANY):
        for i, j in found.tolist():
            attempt(i, j)
    return out


def common_shingles(docs: DataFrame, text: str) -> np.ndarray:
    """Sorted shingles that many documents have; counted over all documents.

    Each task gives those that at least COMMON_IN_TASK of its documents share in a stretch of TASK_SHINGLES;
    of these the COMMON with the greatest sums are taken. They only order shingles: any choice finds the same links.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def often() -> Iterator[pa.RecordBatch]:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            many = n >= COMMON_IN_TASK
            yield pa.RecordBatch.from_arrays([pa.array(values[many].view(np.int64)), pa.array(n[many])], ["shingle", "n"])

        for batch in pieces(batches, text):
            held += shingle_sets(batch.column(text).to_pylist())
            if sum(map(len, held)) > TASK_SHINGLES:
                yield from often()
                held = []
        if held:
            yield from often()

    found = docs.select(text).mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = found.orderBy(F.desc("n"), "shingle").limit(COMMON).select("shingle").toPandas()
    return np.sort(rows["shingle"].to_numpy(np.int64).view(np.uint64))


def signatures(docs: DataFrame, common: np.ndarray, text: str, key: str) -> DataFrame:
    """``key``, n (size of the set), sid (a hash of the set), and its prefix in two lists: rare and common
    shingles. The lists are null where the task has already given those of an equal set."""
    schema = T.StructType([
        docs.schema[key], T.StructField("n", T.LongType()), T.StructField("sid", T.LongType()),
        T.StructField("rare", T.ArrayType(T.LongType())), T.StructField("often", T.ArrayType(T.LongType())),
    ])

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in pieces(batches, text):
            keys = batch.column(key)
            sizes, ids, rare, often = [], [], [], []
            for members, valid in zip(shingle_sets(batch.column(text).to_pylist()), keys.is_valid().to_pylist()):
                sid = set_id(members) if len(members) and valid else None
                sizes.append(len(members))
                ids.append(sid)
                if sid is None or sid in seen:
                    rare.append(None)
                    often.append(None)
                    continue
                seen.add(sid)
                at = np.searchsorted(common, members)
                hot = common[np.minimum(at, len(common) - 1)] == members if len(common) else np.zeros(len(members), bool)
                p = prefix_length(len(members))
                first = members[~hot][:p]
                rare.append(first.view(np.int64))
                often.append(members[hot][: p - len(first)].view(np.int64))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), pa.array(rare, longs), pa.array(often, longs)],
                [key, "n", "sid", "rare", "often"],
            )

    return docs.select(key, text).mapInArrow(sign, schema)


def shared_only(rows: DataFrame) -> DataFrame:
    """Of (shingle, sid, n), the rows whose shingle two or more sets have, each once. Rows stream through
    sorted partitions; a task holds one row besides its batch."""

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shingle", "sid", "n"]
        last: list[np.ndarray] | None = None
        matched = False
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            if last is not None:
                cols = [np.concatenate([a, b]) for a, b in zip(last, cols)]
            fresh = np.ones(len(cols[0]), bool)
            fresh[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
            cols = [c[fresh] for c in cols]
            same = cols[0][1:] == cols[0][:-1]
            before = np.concatenate([[matched], same])
            hold = (before[:-1] | same)
            if hold.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[:-1][hold]) for c in cols], names)
            last, matched = [c[-1:] for c in cols], bool(before[-1])
        if last is not None and matched:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in last], names)

    return rows.repartition("shingle").sortWithinPartitions("shingle", "sid").mapInArrow(keep, "shingle long, sid long, n long")


def parts_of(count: str, shingles: str) -> Column:
    """Parts that so many sets are dealt to, so that one part makes one tree."""
    return F.ceil(F.greatest(F.col(count) / TREE, F.col(shingles) / TREE_SHINGLES)).cast("long")


def known_sets(rows: pa.Table, text: str) -> dict[int, np.ndarray]:
    """The sets of rows (sid, text); a row whose text has another set than its sid says is left out."""
    known: dict[int, np.ndarray] = {}
    for batch in pieces(rows.to_batches(), text):
        for sid, members in zip(batch.column("sid").to_pylist(), shingle_sets(batch.column(text).to_pylist())):
            if len(members) and set_id(members) == sid:
                if sid in known and not np.array_equal(known[sid], members):
                    raise ValueError(f"two sets have the hash {sid}")
                known[sid] = members
    return known


def home_classes(docs: DataFrame, homes: DataFrame, text: str, key: str) -> DataFrame:
    """(sid, n, class, map): classes of the sets that share a home and a part of it.

    ``homes`` has ``key``, sid, home, part. Each text moves once, to its home.
    """
    moved = docs.select(key, text).join(small(homes), key).select("home", "part", "sid", F.coalesce(text, F.lit("")).alias(text))

    def classify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, ["home", "part"]):
            if not (known := known_sets(rows, text)):
                continue
            ids = sorted(known, key=lambda s: (int(known[s][0]), len(known[s]), s))  # equal least members: likely alike
            sets, classes = [known[s] for s in ids], Classes(len(ids))
            local_links(sets, classes)
            least: dict[int, int] = {}
            found = classes.all().tolist()
            for sid, c in zip(ids, found):
                least[c] = min(least.get(c, sid), sid)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([least[c] for c in found], pa.int64()),
                 pa.array([bitmap(m).tobytes() for m in sets], pa.binary())],
                ["sid", "n", "class", "map"],
            )

    return moved.repartition("home", "part").sortWithinPartitions("home", "part").mapInArrow(
        classify, "sid long, n long, class long, map binary"
    )


def in_parts(rows: DataFrame, group: str) -> DataFrame:
    """``rows`` (group, sid, n) with p, q and side: every two parts of a group meet, and so does each with itself."""
    sizes = rows.groupBy(group).agg(F.count("*").alias("count"), F.sum("n").alias("shingles"))
    rows = rows.join(sizes.select(group, parts_of("count", "shingles").alias("parts")), group)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("sid"), "parts"))
    return rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select(
        group, "sid", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"),
        (F.col("part") > F.col("other")).cast("int").alias("side"),
    )


def families(cells: DataFrame, members: DataFrame) -> DataFrame:
    """(node, comp): sets that may be linked across classes, in families that no possible link leaves.

    In every cell (shingle, sid) the tree of its bitmaps leaves pairs that it cannot exclude. Each task joins
    these to clusters and gives a cluster as a star, so rows grow with sets and not with pairs.
    """
    rows = in_parts(cells.select("shingle", "sid", "n"), "shingle").join(members.select("sid", "n", "class", "map"), "sid")

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["shingle", "p", "q"]):
            if run.num_rows < 2:
                continue
            side, ids = run.column("side").to_numpy(), run.column("sid").to_numpy()
            maps = [np.frombuffer(m, np.uint64) for m in run.column("map").to_pylist()]
            classes = np.unique(run.column("class").to_numpy(), return_inverse=True)[1]
            cut = int((side == 0).sum()) if run.column("p")[0] != run.column("q")[0] else None
            clusters = Classes(len(ids))
            for found in tree_pairs_of(maps, run.column("n").to_numpy(), classes, cut):
                for i, j in found.tolist():
                    clusters.union(i, j)
            head = clusters.all()
            far = np.flatnonzero(head != np.arange(len(head)))
            if len(far):
                yield pa.RecordBatch.from_arrays([pa.array(ids[head[far]]), pa.array(ids[far])], ["a", "b"])

    rows = rows.repartition("shingle", "p", "q").sortWithinPartitions("shingle", "p", "q", "side", "n", "sid")
    return components(rows.mapInArrow(meet, "a long, b long").distinct())


def family_links(docs: DataFrame, rows: DataFrame, homes: DataFrame, text: str, key: str) -> DataFrame:
    """Links (a, b) that join classes within each family; ``rows`` has family, sid, n, class. Texts move once
    for each part of their family."""
    placed = in_parts(rows.select("family", "sid", "n"), "family").join(rows.select("sid", "class"), "sid")
    placed = written(placed.join(homes.select("sid", key), "sid"), "near-families")
    moved = docs.select(key, text).join(small(placed), key).select(*[c for c in placed.columns if c != key], F.coalesce(text, F.lit("")).alias(text))

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["family", "p", "q"]):
            known = known_sets(run, text)
            facts = {s: (side, c) for s, side, c in zip(*(run.column(x).to_pylist() for x in ("sid", "side", "class")))}
            ids = sorted(known, key=lambda s: (facts[s][0], int(known[s][0]), len(known[s]), s))
            classes, first = Classes(len(ids)), {}
            for i, sid in enumerate(ids):
                classes.union(first.setdefault(facts[sid][1], i), i)
            cut = sum(facts[s][0] == 0 for s in ids) if run.column("p")[0] != run.column("q")[0] else None
            found = local_links([known[s] for s in ids], classes, cut)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i, _ in found]), pa.array([ids[j] for _, j in found])], ["a", "b"])

    moved = moved.repartition("family", "p", "q").sortWithinPartitions("family", "p", "q")
    return moved.mapInArrow(check, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, homes: DataFrame, text: str, key: str) -> DataFrame:
    """Of the pairs (a, b) of sets, those that link; texts of the sets in pairs move to their pairs."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    wanted = homes.join(small(written(named, "near-asked")), "sid").select(key, "sid")

    def shingle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            sets = shingle_sets(batch.column(text).to_pylist())
            right = [(s, m.tobytes()) for s, m in zip(batch.column("sid").to_pylist(), sets) if len(m) and set_id(m) == s]
            yield pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in right], pa.int64()), pa.array([m for _, m in right], pa.binary())], ["sid", "members"]
            )

    sets = docs.select(key, text).join(small(wanted), key).select("sid", text).mapInArrow(shingle, "sid long, members binary")
    sets = written(sets.dropDuplicates(["sid"]), "near-sets")

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
                    for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    both = pairs.join(sets.select(F.col("sid").alias("a"), F.col("members").alias("x")), "a")
    both = both.join(sets.select(F.col("sid").alias("b"), F.col("members").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``key``, n_shingles, component_id (the smallest key reachable by links).

    Exact for the sets of 64-bit shingle hashes. Texts without words, or null, are empty and link with
    nothing; so do rows with a null key (their component is null). Rows that repeat share a class. An empty
    table gives no rows; other columns are ignored.

    1. Equal sets count once. Linked sets share a shingle in their prefixes, so sets meet in cells, one for
       each shingle that several prefixes hold.
    2. Each set goes to its largest cell, or to one part of it, whose signature tree gives true classes there.
    3. Cells that still hold several classes are gone through again. First the least class of a cell that was
       cut into parts is compared with the others. Then the trees of the cells give families of sets that may
       be linked across classes; each set goes to its family, where a tree with longer bitmaps and the sets
       themselves decide.
    """
    docs = docs.select(key, text)
    signed = written(signatures(docs, common_shingles(docs, text), text, key), "near-signed")
    rare = signed.select(F.explode("rare").alias("shingle"), "sid", "n")
    often = signed.select(F.explode("often").alias("shingle"), "sid", "n")
    cells = written(shared_only(rare).unionByName(often), "near-cells").select("shingle", "sid", "n")

    sizes = cells.groupBy("shingle").agg(F.count("*").alias("count"), F.sum("n").alias("shingles"))
    homes = cells.join(sizes, "shingle").groupBy("sid").agg(F.max(F.struct("count", "shingle", "shingles")).alias("h"))
    homes = homes.select("sid", F.col("h.shingle").alias("home"), F.pmod(F.xxhash64("sid"), parts_of("h.count", "h.shingles")).alias("part"))
    named = signed.filter("sid is not null").groupBy("sid").agg(F.min(key).alias(key))
    homes = written(named.join(homes, "sid"), "near-homes")
    members = written(home_classes(docs, homes, text, key), "near-members")
    found = members.select("sid", "class")

    for first in (True, False):
        classes = written(found, "near-classes")
        rows = cells.join(classes, "sid")
        mixed = rows.groupBy("shingle").agg(
            F.min("class").alias("lo"), F.max("class").alias("hi"), F.count("*").alias("sets"), F.sum("n").alias("shingles")
        )
        mixed = mixed.filter("lo != hi")
        if first:
            cut = mixed.filter(parts_of("sets", "shingles") > 1).select("shingle", "lo")
            heads = rows.join(cut, "shingle").groupBy("shingle", "lo", "class").agg(F.min("sid").alias("sid"))
            heads = written(heads, "near-heads")
            pairs = heads.filter("class = lo").select("shingle", F.col("sid").alias("a")).join(
                heads.filter("class != lo").select("shingle", F.col("sid").alias("b")), "shingle"
            ).select("a", "b").distinct()
            pairs = written(pairs, "near-pairs")
            links = None if pairs.isEmpty() else verified(pairs, docs, homes, text, key)
        else:
            # Cells with the same sets give the same pairs: one of them will do.
            rows = rows.join(mixed.select("shingle"), "shingle")
            marks = rows.groupBy("shingle").agg(
                F.count("*").alias("sets"), F.sum(F.xxhash64("sid").cast("decimal(20,0)")).alias("mark"),
                F.sum(F.xxhash64("sid", F.lit(1)).cast("decimal(20,0)")).alias("second"),
            )
            once = marks.groupBy("sets", "mark", "second").agg(F.min("shingle").alias("shingle")).select("shingle")
            rows = written(rows.join(once, "shingle").dropDuplicates(["shingle", "sid"]), "near-mixed")
            known = members.drop("class").join(classes, "sid")
            related = families(rows, known).select(F.col("node").alias("sid"), F.col("comp").alias("family"))
            related = written(related.join(known.drop("map"), "sid"), "near-related")
            links = None if related.isEmpty() else family_links(docs, related, homes, text, key)
        if links is None:
            continue
        links = links.join(classes.select(F.col("sid").alias("a"), F.col("class").alias("u")), "a")
        links = links.join(classes.select(F.col("sid").alias("b"), F.col("class").alias("v")), "b")
        merged = components(links.select(F.col("u").alias("a"), F.col("v").alias("b")))
        found = classes.join(merged, F.col("class") == F.col("node"), "left").select(
            "sid", F.coalesce("comp", "class").alias("class")
        )
    every = signed.select(key, "n", "sid").join(found, "sid", "left").withColumn("class", F.coalesce("class", "sid"))
    every = written(every, "near-found")
    least = every.filter("class is not null").groupBy("class").agg(F.min(key).alias("component_id"))
    return every.join(least, "class", "left").select(
        key, F.col("n").alias("n_shingles"), F.coalesce("component_id", key).alias("component_id")
    )
