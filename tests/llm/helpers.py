import random
import re

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names the operators also use for themselves.
CLASHING = ("size", "n", "class", "kept", "shingle", "first", "slot", "score", "ids", "path", "label", "_score", "_text_hash")


def documents(spark, rows, clashing=False):
    """rows: (doc_id, text[, source[, lang]])."""
    full = []
    for row in rows:
        doc_id, text, *rest = row
        full.append((doc_id, text, rest[1] if len(rest) > 1 else "en", rest[0] if rest else "a", None if text is None else len(text)))
    df = spark.createDataFrame(full, DOCS)
    if clashing:
        for name in CLASHING:
            df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def words(rng, n, vocabulary=4000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def odd_rows(seed=1):
    """Nulls, empty and blank texts, repeats, ties and one very long text, among ordinary ones."""
    rng = random.Random(seed)
    rows = [(i, " ".join(words(rng, rng.randrange(1, 120)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, " \t\n"), (63, "one"), (64, "one"), (65, rows[3][1]), (66, rows[3][1])]
    rows += [(67, " ".join(words(rng, 60_000, 50_000))), (68, "Ünï 漢字 🙂 \x00 é"), (5, rows[5][1]), (None, "no number"), (None, None)]
    return [(d, t, rng.choice(["a", "b", None, "é"])) for d, t in rows]


def shingles(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    found = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(found) < 5:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(tuple(found[i: i + 5]) for i in range(len(found) - 4))


def classes_of(ids, links):
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    return {i: find(i) for i in ids}


def near_classes(rows):
    """doc_id -> smallest doc_id reachable, by comparing all pairs."""
    sets = {d: shingles(t) for d, t, *_ in rows if d is not None}
    ids = sorted(sets)
    links = []
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                links.append((a, b))
    return classes_of(ids, links)
