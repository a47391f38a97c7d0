"""Repeated passages, hard negatives and the conversation trie against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, documents, odd_rows
from tidemark.llm import debruijn, negatives, tries


def windows_of(rows):
    """(doc, words, removed, kept) by looking every window up."""
    listed = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, *_ in rows]
    at = lambda d, s: (d is not None, d or 0, s)
    first = {}
    for d, words in listed:
        for s in range(len(words) - 19):
            key = tuple(words[s: s + 20])
            first[key] = min(first.get(key, at(d, s)), at(d, s))
    out = []
    for d, words in listed:
        gone = {p for s in range(len(words) - 19) if at(d, s) > first[tuple(words[s: s + 20])] for p in range(s, s + 20)}
        out.append((d, len(words), len(gone), " ".join(w for p, w in enumerate(words) if p not in gone)))
    return sorted(out, key=repr)


def found_repeats(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in debruijn.without_repeats(df).collect()), key=repr)


def passages(seed):
    """Texts of shared passages cut at random, own words, repeats within a text, and odd rows."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    shared = [[rng.choice(vocabulary) for _ in range(rng.randrange(15, 90))] for _ in range(8)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randrange(0, 6)):
            own = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 60))]
            words += rng.choice(shared)[rng.randrange(0, 10): rng.randrange(20, 90)] if rng.random() < 0.5 else own
        rows.append((i, "\n".join(words) if i % 7 else "\t ".join(words) + "   end"))
    periodic = [(204, "a " * 200), (205, "a b c " * 100), (206, "a b c " * 50 + "x"), (208, " ".join(shared[0] + shared[1]) + " x " * 30)]
    repeats = [(200, rows[3][1]), (201, rows[3][1]), (201, rows[5][1]), (201, rows[3][1]), (None, rows[7][1]), (None, rows[8][1]), (2, rows[9][1])]
    return rows + periodic + repeats + [(202, None), (203, ""), (209, " \t\n"), (210, " ".join(shared[2][:19]))]


def test_repeated_passages(spark):
    rows = passages(1)
    assert found_repeats(documents(spark, rows, clashing=True).withColumn("start", F.lit("x"))) == windows_of(rows)


def test_repeated_passages_of_odd_rows(spark):
    rows = odd_rows()
    assert found_repeats(documents(spark, rows)) == windows_of(rows)
    assert found_repeats(spark.createDataFrame([], DOCS)) == []


def test_long_texts_cut_into_blocks(spark):
    rng = random.Random(5)
    long = [str(rng.randrange(10**6)) for _ in range(debruijn.BLOCK + 5000)]
    border = " ".join(long[debruijn.BLOCK - 100: debruijn.BLOCK + 100])
    rows = [(1, " ".join(long)), (2, "before " + border + " after"), (0, "x " + " ".join(long[50:150]))]
    assert found_repeats(documents(spark, rows)) == windows_of(rows)


def test_spans_name_an_earlier_place(spark):
    rows = passages(2)
    words = {d: t.split() for d, t in rows if t and [x for x, _ in rows].count(d) == 1}
    spans = [r for r in debruijn.repeated_spans(documents(spark, rows)).collect() if r.doc_id in words and r.source in words]
    assert spans
    for r in spans:
        length = r.n + debruijn.WINDOW - 1
        assert words[r.doc_id][r.start: r.start + length] == words[r.source][r.source_start: r.source_start + length]
        assert (r.source, r.source_start) < (r.doc_id, r.start)


def test_a_false_claim_is_not_believed(spark):
    docs = debruijn._named(documents(spark, [(1, " ".join(map(str, range(50)))), (2, " ".join(map(str, range(100, 150))))]), "text", "doc_id")
    columns = "_key bigint, _tag bigint, start int, n int, s_key bigint, s_tag bigint, s_start int"
    claims = spark.createDataFrame([(2, 0, 3, 4, 1, 0, 3), (2, 0, 0, 1, 2, 0, 0)], columns)
    assert [tuple(r) for r in debruijn._verified(docs, claims).collect()] == [(2, 0, 0, 1, 2, 0, 0)]


def test_window_sums():
    words = np.random.default_rng(1).integers(0, 1 << 63, 100).astype(np.uint64)
    for length in (1, 5, 8, 13, 20, 100):
        want = [sum(int(words[i + j]) * 3 ** (length - 1 - j) for j in range(length)) % (1 << 64) for i in range(101 - length)]
        assert [int(x) for x in debruijn._sums(words, length, 3)] == want
    assert len(debruijn._sums(words[:7], 8, 3)) == 0


# --- hard negatives ---------------------------------------------------------------------------------------

def mined(rows, anchors, positives=5, negatives_=5):
    """By scoring every pair."""
    by_id = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(256 * float(np.float32(x))) for x in v])
        by_id[i] = min(by_id.get(i, row), row)
    out = []
    for a in sorted(filter(anchors, by_id)):
        label, vector = by_id[a]
        scored = sorted(
            (-sum(x * y for x, y in zip(vector, w)), i, other == label)
            for i, (other, w) in by_id.items() if i != a and len(w) == len(vector)
        )
        for score, p in [(-s, i) for s, i, same in scored if same][:positives]:
            hard = [(-s, i) for s, i, same in scored if not same and 80 * score <= -100 * s <= 100 * score][:negatives_]
            out += [(a, p, rank, n, score, s) for rank, (s, n) in enumerate(hard, 1)]
    return sorted(out)


VECTORS = "vec_id bigint, embedding array<float>, label int"


def found_negatives(df, every):
    return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % every == 0).collect())


@pytest.mark.parametrize("dims", [8, 13, 64])
def test_hard_negatives(spark, dims):
    rng = np.random.default_rng(dims)
    centre = rng.normal(size=dims)
    rows = [(i, (centre + rng.normal(size=dims) * 0.7).tolist(), int(rng.integers(0, 4))) for i in range(-20, 300)]
    rows += [(i, rows[40][1], i % 4) for i in range(300, 380)]  # ties
    df = spark.createDataFrame(rows, VECTORS).withColumns({"id": F.lit("x"), "score": F.lit("y"), "anchor": F.lit(0), "parts": F.lit(1)})
    want = mined(rows, lambda i: i % 20 == 0)
    assert want and found_negatives(df, 20) == want


def test_hard_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0 + i % 3, -0.5, i / 50], i % 3) for i in range(40)]
    rows += [(50, None, 1), (51, [], 1), (52, [], 2), (60, [1.0, None, 0.0], 1), (61, [nan, 0.0, 0.0], 0), (62, [0.0, inf, 0.0], 2)]
    rows += [(70, [2.0, 1.0, 1.0], None), (None, [2.0, 1.0, 1.0], 1), (5, rows[5][1], 2), (5, rows[5][1], 2), (10, [9.0, 9.0, 9.0], 0)]
    rows += [(80, [1.0, 2.0], 0), (81, [1.0, 2.0], 0), (82, [1.0, 1.7], 1), (90, [0.0, 0.0, 0.0], 1)]
    assert found_negatives(spark.createDataFrame(rows, VECTORS), 5) == mined(rows, lambda i: i % 5 == 0)
    assert found_negatives(spark.createDataFrame([], VECTORS), 5) == []
    assert found_negatives(spark.createDataFrame([(1, [1.0], 1)], VECTORS), 5) == []


def test_hard_negatives_in_rounds_and_many_labels(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROUND_BYTES", 20_000)
    rng = np.random.default_rng(4)
    rows = [(i, (1 + rng.normal(size=16)).tolist(), int(rng.integers(0, 90))) for i in range(600)]
    assert found_negatives(spark.createDataFrame(rows, VECTORS).repartition(3), 4) == mined(rows, lambda i: i % 4 == 0)


def test_scores_of_any_width():
    rng = np.random.default_rng(2)
    for most in (1, 100, 1 << 20):
        a, c = rng.integers(-most, most + 1, (7, 19)), rng.integers(-most, most, (30, 19))
        assert (negatives.scores(negatives.bit_planes(c), negatives.subset_sums(a), int(np.abs(a).max())) == c @ a.T).all()
    with pytest.raises(ValueError, match="so large"):
        negatives.scores(negatives.bit_planes(c << 30), negatives.subset_sums(a), int(np.abs(a).max()))


# --- the trie ---------------------------------------------------------------------------------------------

def trie(rows):
    """By listing every prefix of every conversation."""
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns.setdefault(c, []).append(((turn is not None, turn or 0, tie), (role, text)))
    turns = {c: [t for _, t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(turns.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:])
    members = {}
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    below = {}
    for node in members:
        if node:
            below.setdefault(node[:-1], []).append(node)
    out = []
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        kids, n = below.get(node, []), len(members[node])
        leaves = sum(totals[k][0] for k in kids) or 1
        totals[node] = leaves, sum(totals[k][1] for k in kids) + (n - 1) * (len(node[-1][1]) if node else 0)
        ends = ",".join(map(str, sorted(c for c in members[node] if len(rebuilt[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(members[node]), len(node), parent, n, len(kids), *totals[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


TURNS = "conv_id bigint, turn bigint, role string, text string"


def found_trie(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[n] for n in names) for r in tries.prefix_trie(df).collect()), key=repr)


def talks(seed):
    """Conversations with common openings, copies, odd turns, missing and short first ones, and a long one."""
    rng = random.Random(seed)
    openings = [("system", "be kind"), ("system", "é🙂"), ("user", None), (None, "hello")]
    rows = []
    for c in [*range(0, 130), *range(205, 260), 300, *range(301, 340), -3, -150, 10**12]:
        n = 1 if c == 300 else rng.randrange(1, 12)
        said = [rng.choice(openings)] + [("user", f"t{rng.randrange(3)}" * rng.randrange(4)) for _ in range(n - 1)]
        rows += [(c, i, *t) for i, t in enumerate(said)]
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(40) for t in range(6)]
    rows += [(2000, t, "user", f"long {t % 5}") for t in range(3000)] + [(2001, t, "user", f"long {t % 5}") for t in range(3000)]
    rows += [(7, None, "user", "no turn"), (7, 3, "a", "tie"), (7, 3, "b", "tie"), (7, 3, "b", "tie"), (None, 1, "user", "none"), (8, 1, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("heavy", [2000, 40, 1])
def test_trie(spark, monkeypatch, heavy):
    """With few heavy nodes, subtrees are summed in shards."""
    monkeypatch.setattr(tries, "HEAVY", heavy)
    rows = talks(heavy)
    df = spark.createDataFrame(rows, TURNS).withColumns({"depth": F.lit("x"), "n": F.lit("y"), "k1": F.lit(0), "part": F.lit(0)})
    assert found_trie(df.repartition(5)) == trie(rows)


def test_trie_of_few_rows(spark):
    assert found_trie(spark.createDataFrame([], TURNS)) == []
    for c in range(6):
        rows = [(c, 0, "user", "one")]
        assert found_trie(spark.createDataFrame(rows, TURNS)) == trie(rows)


def test_queue_spills():
    rng = random.Random(3)
    queue, out = tries.Queue(3, 10), []
    waiting = [(rng.randrange(50), rng.randrange(3), i) for i in range(500)]
    for message in waiting:
        queue.push(message)
    assert len(queue.runs) > 10
    for a in range(50):
        for b in range(3):
            while (message := queue.pop_if((a, b))) is not None:
                out.append(message)
    assert out == sorted(waiting) and queue.pop_if((0, 0)) is None
