"""Exact and near duplicates, shards, mixing and licences."""


import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import documents, near_classes, odd_rows, shingles, words
from tidemark.llm import chunks, common, jaccard, licenses, mixing, sharding
from tidemark.llm.wordhash import shingle_sets


def test_cuts_follow_the_text_and_keep_it_whole():
    rng = random.Random(2)
    text = bytes(rng.randrange(256) for _ in range(200_000))
    ends = chunks.cuts(text)
    sizes = [b - a for a, b in zip([0, *ends], ends)]
    assert ends[-1] == len(text) and max(sizes) <= chunks.MOST and min(sizes[:-1]) >= chunks.LEAST
    moved = chunks.cuts(b"x" * 37 + text)
    assert len({e - 37 for e in moved} & set(ends)) > 0.9 * len(ends)  # the cuts move with the text
    assert chunks.cuts(b"") == [] and chunks.cuts(b"ab") == [2]


def brute_copies(rows):
    groups = defaultdict(list)
    for d, t, *_ in rows:
        groups[t or ""].append(d)
    out = []
    for d, t, *_ in rows:
        own = groups[t or ""]
        keep = max((x for x in own if x is not None), default=None)
        out.append((d, keep, len(own), d == keep))
    return sorted(out, key=repr)


@pytest.mark.parametrize("clashing", [False, True])
def test_exact_duplicates(spark, clashing):
    rows = odd_rows()
    found = chunks.exact_duplicates(documents(spark, rows, clashing)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found), key=repr) == brute_copies(rows)


def test_exact_duplicates_with_a_digest_for_all(spark, monkeypatch):
    """Even if every digest is doubtful, whole texts decide."""
    rows = odd_rows()
    docs = documents(spark, rows)

    def all_doubtful(named, listed, text):
        return listed.selectExpr("explode(recipe) AS digest").distinct()

    monkeypatch.setattr(chunks, "unverified", all_doubtful)
    found = chunks.exact_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found), key=repr) == brute_copies(rows)


def test_unverified_finds_two_chunks_of_one_digest(spark, monkeypatch):
    docs = documents(spark, [(1, "a"), (2, "b"), (3, "a")])
    listed = spark.createDataFrame([([b"1"],), ([b"1"],)], "recipe array<binary>")
    assert chunks.unverified(docs, listed).count() == 0  # the digests of the texts are others, and differ


def test_empty_tables(spark):
    none = documents(spark, [])
    assert chunks.exact_duplicates(none).count() == 0
    assert jaccard.near_duplicates(none).count() == 0
    assert sharding.shards(none).count() == 0
    mixed, draws = mixing.mix(none)
    assert mixed.count() == 0 and draws.count() == 0 and mixing.mixed_documents(none).count() == 0
    assert licenses.scan(none).count() == 0


def test_shards_split_along_names_that_begin_alike(spark):
    for names in (["common_crawl", "common_voice"], ["web_de", "web_de_forum"], [None, "é"]):
        rows = [(i, "same text", names[i % 2], "en") for i in range(64)]
        found = sharding.shards(documents(spark, rows), 2).collect()
        assert len(found) == 64 and {(r.doc_id % 2, r.shard) for r in found} == {(0, 0), (1, 1)}


def test_components_on_chains_stars_and_repeats(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(5, i) for i in range(6, 30)] + [(29, 2), (2, 29), (7, 7)]
    found = {r.node: r.comp for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 100 for i in range(100, 141)} | {i: 2 for i in (2, *range(5, 30))}


def test_numbered_is_gapless_for_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(common, "SEGMENT_ROWS", 7)
    monkeypatch.setattr(common, "LEAST_ROWS", 3)
    rows = [(i % 3 if i < 60 else None, i) for i in range(100)] + [(None, 99)]
    df = common.numbered(spark.createDataFrame(rows, "k long, v long"), ["k"], ["v"], common.F.lit(1), "no")
    by = defaultdict(list)
    for r in df.collect():
        by[r.k].append(r.no)
    assert {k: sorted(v) for k, v in by.items()} == {0: [*range(20)], 1: [*range(20)], 2: [*range(20)], None: [*range(41)]}


def test_shingle_sets_agree_with_tuples():
    rng = random.Random(4)
    texts = [None, "", " \n", "A b\tC", "a B c d", "a b c d E", "a b c d e f a b c d e f"] + [" ".join(words(rng, 40, 6)) for _ in range(50)]
    found = shingle_sets(texts)
    assert [len(s) for s in found] == [len(shingles(t)) for t in texts]
    assert np.array_equal(found[3], shingle_sets(["x y", "a B c"])[1]) and not np.array_equal(found[3], found[4])
    for i in range(7, 56):
        for j in range(7, 56):
            assert len(np.intersect1d(found[i], found[j])) == len(shingles(texts[i]) & shingles(texts[j]))


def near_rows(rng, groups=12):
    rows, n = [], 0
    passage = words(rng, 30)
    for g in range(groups):
        base = words(rng, rng.choice([6, 20, 60, 200, 900]))
        if g % 2:
            base[len(base) // 2: len(base) // 2] = passage
        for _ in range(rng.randrange(1, 14)):
            own = list(base)
            for _ in range(rng.randrange(0, 1 + len(own) // 40)):
                own[rng.randrange(len(own))] = f"edit{rng.randrange(10**6)}"
            rows.append((n, " ".join(own)))
            n += 1
    return rows


@pytest.mark.parametrize("tree", [2000, 4])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, tree):
    monkeypatch.setattr(jaccard, "TREE", tree)  # 4: cells are cut into parts, and parts meet again
    rows = near_rows(random.Random(tree)) + [(d + 1000 if d is not None else None, t) for d, t, _ in odd_rows()]
    found = jaccard.near_duplicates(documents(spark, rows, clashing=True)).collect()
    want = near_classes(rows)
    assert len(found) == len(rows)
    sizes = {d: len(shingles(t)) for d, t in rows if d is not None}
    for r in found:
        assert r.component_id == want.get(r.doc_id)
        assert r.doc_id is None or r.n_shingles == sizes[r.doc_id]


def test_near_duplicates_with_common_shingles(spark, monkeypatch):
    """The order of shingles changes cells, never links."""
    rows = near_rows(random.Random(9))
    every = np.unique(np.concatenate(shingle_sets([t for _, t in rows])))
    monkeypatch.setattr(jaccard, "common_shingles", lambda docs, text: every[::2])
    monkeypatch.setattr(jaccard, "TREE", 3)
    assert {r.doc_id: r.component_id for r in jaccard.near_duplicates(documents(spark, rows)).collect()} == near_classes(rows)


def test_prefixes_of_linked_sets_meet():
    rng = np.random.default_rng(1)
    for _ in range(500):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 10**9, n).astype(np.uint64))
        b = np.unique(np.concatenate([rng.permutation(a)[: max(1, int(len(a) * rng.uniform(0.7, 1)))], rng.integers(0, 10**9, int(rng.integers(0, 6))).astype(np.uint64)]))
        if jaccard.linked(a, b):
            assert set(a[: jaccard.prefix_length(len(a))].tolist()) & set(b[: jaccard.prefix_length(len(b))].tolist())


def test_trees_keep_every_linked_pair():
    rng = np.random.default_rng(2)
    sets = []
    for _ in range(40):
        base = np.unique(rng.integers(0, 1 << 63, int(rng.choice([1, 5, 40, 63, 64, 70, 300]))).astype(np.uint64) * np.uint64(2))
        sets += [np.unique(np.concatenate([base[rng.random(len(base)) > 0.05], rng.integers(0, 1 << 63, 2).astype(np.uint64)])) for _ in range(3)]
    maps, sizes = [jaccard.bitmap(s) for s in sets], np.array([len(s) for s in sets])
    found = {tuple(p) for part in jaccard.tree_pairs_of(maps, sizes, np.arange(len(sets))) for p in part.tolist()}
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if jaccard.linked(sets[i], sets[j])}
    assert want <= found and len(want) > 30 and len(found) < len(sets) ** 2 / 4


def test_shards_are_near_equal_and_numbered(spark):
    rng = random.Random(3)
    rows = [(i, "x" * rng.randrange(10, 400), rng.choice(["a", "a", "a", "b", None])) for i in range(2000)] + odd_rows()[:60]
    found = sharding.shards(documents(spark, rows, clashing=True), 8).collect()
    assert len(found) == len(rows)
    total, slots = Counter(), defaultdict(list)
    for r in found:
        total[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert sorted(total) == list(range(8)) and max(total.values()) / min(total.values()) < 1.05
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by = {r.doc_id: r for r in found if r.doc_id is not None and r.doc_id >= 100}
    for d, t, *_ in rows:
        if d is not None and d >= 100:
            assert by[d].size == len(t.encode()) + 1 and by[d].text_crc32 == zlib.crc32(t.encode())


def test_shards_of_equal_and_few_rows(spark):
    assert {r.shard for r in sharding.shards(documents(spark, [(1, "a")] * 20), 8).collect()} == {0}
    same = sharding.shards(documents(spark, [(i, "same") for i in range(64)]), 8).collect()
    assert Counter(r.shard for r in same) == {i: 8 for i in range(8)}
    assert sharding.shards(documents(spark, [(1, None), (2, "")]), 8).count() == 2
    leaves = sharding.shards(documents(spark, [(i, "x" * 99) for i in range(50)]), target_bytes=1000.0).collect()
    assert len({r.shard for r in leaves}) == 5


def test_targets_share_by_weight_up_to_three_times():
    assert mixing.targets({"a": 10, "b": 10, None: 10, "c": 10}) == pytest.approx({"a": 40 * 5 / 13, "b": 40 * 2 / 13, "c": 40 / 13, None: 40 * 5 / 13})
    found = mixing.targets({"a": 1, "b": 100, "c": 10})
    assert found["a"] == 3 and found["b"] + found["c"] == pytest.approx(108) and found["c"] == 30
    assert mixing.targets({"a": 0, "b": 0}) == {"a": 0, "b": 0} and mixing.targets({}) == {}


def test_permutations_hold_each_number_once():
    for n in (1, 2, 3, 17, 64, 1000):
        full = np.full(n, n)
        assert sorted(mixing.permuted(np.arange(n), full, np.full(n, 5, np.uint64)).tolist()) == list(range(n))


def test_shard_counts_keep_totals_and_spread():
    counts = mixing.shard_counts([1000, 10, 0, 90], 8, 1)
    assert counts.sum(0).tolist() == [1000, 10, 0, 90] and counts.sum(1).max() - counts.sum(1).min() <= 1


def test_permutations_run_back():
    for n in (1, 2, 3, 17, 1000):
        full, key = np.full(n, n), np.full(n, 99, np.uint64)
        there = mixing.permuted(np.arange(n), full, key)
        assert mixing.permuted(there, full, key, back=True).tolist() == list(range(n))


def test_slots_hold_the_words_asked_for():
    """Against a walk over the slots, for sources of a few words to many blocks."""
    rng = random.Random(8)
    for size in (1, 10, 511, 512, 513, 5000, 51_200, 100_001):
        blocks = -(-size // 512)
        order = mixing.permuted(np.arange(blocks), np.full(blocks, blocks), np.full(blocks, 77, np.uint64))
        for total in (0, 1, size - 1, size, size + 1, 2 * size, 3 * size, rng.randrange(3 * size + 1)):
            slots, last = mixing.slots_for(total, size, 77)
            held = [min(512, size - 512 * int(order[i % blocks])) for i in range(slots)]
            assert sum(held[:-1]) + (last if slots else 0) == total and (not slots or 0 < last <= held[-1])


@pytest.mark.parametrize("good, bad, sample", [(600_000_000, 300_000_000, 10_000_000), (800_000_000, 400_000_000, 10_000_000)])
def test_counts_on_both_sides_of_the_exact_draw(good, bad, sample):
    rng = np.random.default_rng(3)
    draws = [mixing._hypergeometric(rng, good, bad, sample) for _ in range(400)]
    share = good / (good + bad)
    spread = (sample * share * (1 - share) * (1 - sample / (good + bad))) ** 0.5
    assert abs(np.mean(draws) - sample * share) < 4 * spread / 20 and 0.85 < np.std(draws) / spread < 1.15


def test_mix_replayed_by_hand(spark):
    """Every source gives its target to the word, in blocks of one length, and draws replay in plain Python."""
    rng = random.Random(9)
    parts = {"a": [1000] * 1000, "b": [10], "c": [500] * 10, None: [3] * 7}
    rows, number = [], 0
    for source, lengths in parts.items():
        for n in lengths:
            rows.append((number, " ".join(["w"] * n), source))
            number += 1
    rng.shuffle(rows)
    mixed, draws = mixing.mix(documents(spark, rows))
    found, drawn = mixed.collect(), draws.collect()
    lines = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.source or "~", r.first)):
        lines[r.source] += [r.doc_id] * r.size
    taken, words_of = Counter(), Counter()
    for d in drawn:
        size = len(lines[d.source])
        assert d.lo == 512 * d.block and d.hi <= min(size, d.lo + 512) and d.epoch == d.slot // -(-size // 512)
        words_of[d.source] += d.hi - d.lo
        taken.update(lines[d.source][d.lo: d.hi])
    assert {r.doc_id: r.taken for r in found} == {r.doc_id: taken[r.doc_id] for r in found}
    assert {r.source: round(r.target) for r in found} == dict(words_of)
    for s in parts:
        short = [d for d in drawn if d.source == s and d.hi - d.lo < 512 and d.hi < len(lines[s])]
        assert len(short) <= 1 and sorted(d.slot for d in drawn if d.source == s) == list(range(sum(d.source == s for d in drawn)))


def test_mix(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(words(rng, rng.randrange(1, 300))), rng.choice(["a"] * 5 + ["b", "c", None])) for i in range(400)] + odd_rows()
    docs = documents(spark, rows, clashing=True)
    mixed, draws = mixing.mix(docs)
    found = mixed.collect()
    assert len(found) == len(rows)
    size, taken, target = Counter(), Counter(), {}
    for r in found:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 3 * r.size
    assert all(r.source_size == size[r.source] for r in found)
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    for s in size:
        assert taken[s] == round(target[s])
    again, _ = mixing.mix(docs.repartition(3))
    key = lambda r: (r.doc_id or -1, r.size, r.source or "", r.taken)
    assert sorted(map(key, found)) == sorted(map(key, again.collect()))
    per_shard = Counter(r.shard for r in draws.collect())
    assert max(per_shard.values()) - min(per_shard.values()) <= 1


def test_mixed_documents_hold_the_words_taken(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(words(rng, rng.randrange(1, 300))), rng.choice(["a", "a", "a", "b", None])) for i in range(200)] + odd_rows()
    docs = documents(spark, rows)
    mixed, _ = mixing.mix(docs)
    want = Counter()
    for r in mixed.collect():
        want[r.doc_id, r.source] += r.taken
    out = mixing.mixed_documents(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    got = Counter()
    texts = defaultdict(set)
    for d, t, s in rows:
        texts[d, s].add(t)
    for r in out.collect():
        got[r.doc_id, r.source] += len(r.text.split(" ")) if "\n" not in r.text else sum(len(x.split()) for x in r.text.split("\n"))
        assert r.n_chars == len(r.text) and any(t and all(p in t for p in r.text.split("\n")) for t in texts[r.doc_id, r.source])
    assert {k: v for k, v in got.items() if v and k[0] not in (62, 68)} == {k: v for k, v in want.items() if v and k[0] not in (62, 68)}


def test_licences(spark):
    mit = "MIT License\n\n" + "\n".join(s + "." for s in [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"])
    rows = [
        (1, "Some text. Released under the MIT License."), (2, mit), (3, "Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0."),
        (4, "the license of a driver"), (5, None), (6, ""), (7, "This work is licensed under the GNU General Public License, version 3.\n" * 3),
        (8, "See the GNU General Public License for more details."), (1, "Some text. Released under the MIT License."),
        (9, "x " * 200_000 + "\nReleased under the MIT License."),
    ]
    found = licenses.scan(documents(spark, rows, clashing=True)).collect()
    assert sorted((r.doc_id, ",".join(r.licenses), len(r.sentence_ids)) for r in found) == [
        (1, "MIT", 1), (1, "MIT", 1), (2, "MIT", 3), (3, "Apache-2.0,CC-BY-NC-4.0", 2), (7, "GPL-3.0-only", 3), (8, "", 1), (9, "MIT", 1),
    ]


MIT = """The MIT License (MIT)

Copyright (c) 2024 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are
met:

1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
MPL = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not\ndistributed\n"


@pytest.mark.parametrize("leader", ["", "# ", " * ", "// ", ";; ", "! ", "\t"])
def test_wrapped_licence_texts(spark, leader):
    want = [(MIT, "MIT", 4), (BSD, "BSD-2-Clause", 3), (ISC, "ISC", 1), (GPL, "GPL-3.0-or-later", 3), (APACHE, "Apache-2.0", 5), (MPL, "MPL-2.0", 1),
            ("Licensed under the Apache License,\nVersion 2.0.\n", "Apache-2.0", 1), ("code\nReleased under\nthe MIT License\ncode\n", "MIT", 1)]
    for feed in ("\n", "\r\n"):
        texts = ["first line" + feed + "".join((leader + line).rstrip(" ") + feed for line in text.splitlines()) for text, *_ in want]
        found = licenses.scan(documents(spark, list(enumerate(texts)))).collect()
        assert {r.doc_id: (",".join(r.licenses), len(r.sentence_ids)) for r in found} == {i: (name, n) for i, (_, name, n) in enumerate(want)}


def test_blank_lines_and_full_stops_end_sentences(spark):
    texts = ["Released under\n\nthe work of others", "Released under.\nThe MIT licence", "released\n#\n# under the mit license", "\n" * 300_000 + "; " * 100_000]
    assert licenses.scan(documents(spark, list(enumerate(texts)))).count() == 0


@pytest.mark.parametrize("text, want", [
    ("# SPDX-License-Identifier: MIT\n", "MIT"), ("// SPDX-License-Identifier: Apache-2.0\nint x;", "Apache-2.0"),
    ("/* SPDX-License-Identifier: GPL-2.0-or-later */", "GPL-2.0-or-later"), ("SPDX-License-Identifier: LGPL-2.1-only", "LGPL-2.1-only"),
    ("This project is licensed under the MIT License - see the [LICENSE](LICENSE) file", ""),
    ("This project is licensed under the MIT License - see the LICENSE file for details.", "MIT"),
    ("This project is licensed under the MIT License - see the LICENSE.md file for details", "MIT"),
    ("Licensed under the Apache License 2.0.", "Apache-2.0"),
    ("This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy", "Unlicense"),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU\nLesser General Public License as published by "
     "the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.", "LGPL-2.1-or-later"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published\n"
     "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "AGPL-3.0-or-later"),
    ("This program and the accompanying materials are made available under the\nterms of the Eclipse Public License 2.0 which is available at\n"
     "https://www.eclipse.org/legal/epl-2.0/\n\nSPDX-License-Identifier: EPL-2.0", "EPL-2.0"),
])
def test_notices_of_more_licences(spark, text, want):
    found = licenses.scan(documents(spark, [(1, text)])).collect()
    assert [",".join(r.licenses) for r in found] == ([want] if want else [])


@pytest.mark.parametrize("run", [".", ":", ";.", "\n", "\n#", ". ", ";", "?!", "\n.", "the ", "v. "])
def test_runs_of_signs_take_time_in_proportion(spark, run):
    docs = documents(spark, [(1, "x" + run * (1_000_000 // len(run)) + "y\n\nReleased under the MIT License.")])
    started = time.perf_counter()
    assert [r.licenses for r in licenses.scan(docs).collect()] == [["MIT"]]
    assert time.perf_counter() - started < 20


def test_rules_follow_the_order_of_sentences(spark):
    known, rules = {"a": "alpha", "b": "beta", "c": "gamma"}, (("AB", ("a", "b")), ("A", ("a",)), ("BC", ("b", "c")))
    texts = ["alpha.\nbeta.", "beta.\nalpha.", "Alpha; noise. BETA!\ngamma", "alpha\nalpha\nbeta"]
    found = licenses.scan(documents(spark, list(enumerate(texts))), known=known, rules=rules).collect()
    assert {r.doc_id: r.licenses for r in found} == {0: ["AB"], 1: ["A"], 2: ["AB"], 3: ["A", "AB"]}


