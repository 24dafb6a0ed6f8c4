"""Vector codes against Lloyd's rounds in plain Python."""

import math
import random

import numpy as np
import pytest

from corpusflow.llm import vector_codes as V

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, parts=8, entries=16, rounds=6):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], []
    width = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == width]
    cuts = [width * p // parts for p in range(parts + 1)]
    whole = [[math.floor(4096 * float(np.float32(x))) for x in r[1]] for r in kept]
    cut = [[v[a:b] for a, b in zip(cuts, cuts[1:])] for v in whole]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            at = [nearest(v[p], books[p])[1] for v in cut]
            for i in range(len(books[p])):
                own = [v[p] for v, j in zip(cut, at) if j == i]
                if own:
                    books[p][i] = [sum(c) // len(own) for c in zip(*own)]
    found = [[nearest(v[p], books[p]) for p in range(parts)] for v in cut]
    out = [(r[0], r[2], tuple(i for _, i in f), sum(d for d, _ in f)) for r, f in zip(kept, found)]
    return sorted(out, key=str), [x for book in books for e in book for x in e]


def coded(df, **options):
    codes, books = V.encode(df, **options)
    rows = [(r.vec_id, r.label, tuple(r.codes), r.error) for r in codes.collect()]
    return sorted(rows, key=str), [int(x) for b in books for x in b.reshape(-1)]


def vectors(seed, n, width=16):
    draw = random.Random(seed)
    return [(i, [float(np.float32(draw.gauss(i % 5, 0.5))) for _ in range(width)], draw.choice([None, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("members", [64, V.HOME_MEMBERS])
def test_codes_of_odd_rows(workers, monkeypatch, members):
    """Ties, repeated rows, a group of equal vectors, nulls and unfit vectors."""
    monkeypatch.setattr(V, "HOME_BITS", members.bit_length() - 1)
    rows = vectors(1, 300)
    rows += [(1000 + i, [0.25] * 16, 3) for i in range(200)] + [(5, [0.5] * 16, 1)] * 3
    rows += [(None, [1.0] * 16, 2), (2000, None, 1), (2001, [None] + [0.0] * 15, 1), (2002, [math.nan] * 16, 1), (2003, [math.inf] * 16, 1)]
    rows += [(2004, [1.0] * 8, 1), (2005, [], 1), (2006, [-0.0, -1e-9] * 8, None)]
    random.Random(2).shuffle(rows)
    df = workers.createDataFrame(rows, SCHEMA).repartition(4).selectExpr("*", "1 as rid", "2 as v", "3 as k", "4 as g", "5 as codes", "6 as position")
    assert coded(df) == plain(rows)


def test_few_rows_narrow_vectors_and_other_sizes(workers):
    for rows, options in [
        (vectors(3, 5, 5), {}),
        (vectors(4, 40, 10), {"parts": 3, "entries": 4, "rounds": 2}),
        (vectors(5, 30, 8), {"rounds": 0}),
        ([(1, [], None), (2, [], 1)], {}),
    ]:
        assert coded(workers.createDataFrame(rows, SCHEMA), **options) == plain(rows, **options)


def test_no_rows(workers):
    for rows in ([], [(1, None, 1), (2, [math.nan], 1)]):
        codes, books = V.encode(workers.createDataFrame(rows, SCHEMA))
        assert codes.columns == ["vec_id", "label", "codes", "error"] and codes.collect() == [] and books == []


def test_very_large_components_count_as_the_bound(workers):
    rows = [(1, [3e38] * 8, 1), (2, [-3e38] * 8, 1), (3, [0.0] * 8, 1)]
    bound = [(i, [max(-32768.0, min(32768.0, x)) for x in v], g) for i, v, g in rows]
    assert coded(workers.createDataFrame(rows, SCHEMA)) == plain(bound)


def test_only_members_that_change_their_entry_travel(workers):
    """The blocks that enter the shuffle of a round are those of members with another entry."""
    books = [np.array([[0], [10]], np.int64)]
    ids, members = np.arange(4), np.array([[0], [1], [9], [4]], np.int32)
    moves = list(V.reassigned(iter([((0, 0, 7), V.pack(ids, members))]), books))
    assert [(go, home) for go, (home, _) in moves] == [(False, (0, 0, 7)), (True, (0, 1, 7))]
    assert V.unpack(moves[0][1][1], 1)[0].tolist() == [0, 1, 3] and V.unpack(moves[1][1][1], 1)[0].tolist() == [2]
    sc = workers.sparkContext
    state = sc.parallelize([((0, 0, 7), V.pack(ids, members))], 2).partitionBy(6, V.home_hash)
    after, marked = V.moved(state, books, lambda b: b.partitionBy(6, V.home_hash), [1])
    assert after.getNumPartitions() == 6  # joined partition by partition, not appended
    assert {home: V.unpack(block, 1)[0].tolist() for home, block in after.collect()} == {(0, 0, 7): [0, 1, 3], (0, 1, 7): [2]}
    marked.unpersist()
