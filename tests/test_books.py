import random

import pytest

from tidemark.operators import books

COLUMNS = (
    "exchange string, symbol string, first_update_id bigint, final_update_id bigint, kafka_offset bigint, session int"
)
BOOKS = [("binance", "SOL-USD"), ("binance", "XRP-USD"), ("coinbase", "SOL-USD")]


def deltas(seed, n=120):
    """Deltas of several books that follow on, overlap, lie within what is known, or leave ids out."""
    rng, last, rows = random.Random(seed), {}, []
    for offset in range(n):
        book, session = rng.choice(BOOKS), offset // 50
        known = last.get((book, session), rng.randrange(3000, 9000))
        first = known + rng.choice([1, 1, 1, -4, -1, 2, 6])
        final = first + rng.randrange(0, 5)
        last[book, session] = max(known, final)
        rows.append((*book, first, final, offset, session))
    return rows


def expected(rows, by_session):
    """Of the exchange whose ids follow on; the other's are not checked."""
    newest, out = {}, []
    for exchange, symbol, first, final, _, session in rows:
        if exchange != "binance":
            continue
        book = (exchange, symbol, session if by_session else None)
        before = newest.get(book)
        missing = max(0, first - before - 1) if before is not None else 0
        out.append((before is None, missing > 0, missing))
        newest[book] = max(final, before or final)
    return out


@pytest.mark.parametrize("width", [2, 7, 1_000_000])
@pytest.mark.parametrize("by_session", [False, True])
def test_gaps_equal_a_walk_through_the_log(spark, width, by_session):
    rows = deltas(width)
    options = {"session": "session"} if by_session else {}
    found = books.sequence_gaps(spark.createDataFrame(rows, COLUMNS), segment_width=width, **options).orderBy("kafka_offset")
    assert [(r.first_seen, r.is_gap, r.missing) for r in found.collect()] == expected(rows, by_session)


def test_a_delta_within_the_known_does_not_set_the_book_back(spark):
    rows = [("binance", "XRP-USD", f, l, n, 0) for n, (f, l) in enumerate([(7021, 7038), (7024, 7025), (7039, 7039), (7043, 7050)])]
    found = books.sequence_gaps(spark.createDataFrame(rows, COLUMNS), segment_width=2).orderBy("kafka_offset").collect()
    assert [r.missing for r in found] == [0, 0, 0, 3]


def test_counts(spark):
    rows = deltas(11)
    totals = {}
    for row, (_, gap, missing) in zip((r for r in rows if r[0] == "binance"), expected(rows, False)):
        n, gaps, ids = totals.get(row[1], (0, 0, 0))
        totals[row[1]] = (n + 1, gaps + gap, ids + missing)
    counted = books.gap_counts(books.sequence_gaps(spark.createDataFrame(rows, COLUMNS)))
    assert {r.symbol: (r.deltas, r.gaps, r.missing_ids) for r in counted.collect()} == totals
