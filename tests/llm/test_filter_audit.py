"""The filter audit against counting documents one by one."""

import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F

from corpusflow.llm import filter_audit as A

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
BITS = ["a", "b", "Ab", "ÄÖ", "漢字", "😀", " ", "\n", "\t", "\x0b", "\x1f", "#", "|", "long" * 9, "longlong" * 2, "x" * 8, "\x00"]


def plain_measures(text):
    words = WORDS.findall(text)
    return [len(words), len(set(words)), len(text), len(re.findall("[A-Z]", text)), len(re.findall(r"[#$%&*|]", text))]


def texts(seed, n, most=60):
    draw = random.Random(seed)
    return ["".join(draw.choice(BITS) for _ in range(draw.randint(0, most))) for _ in range(n)]


def test_measures_are_those_of_plain_python():
    some = [*texts(1, 400), "", " ", "w" * 100_000, "a b " * 50_000, " ".join(map(str, range(30_000)))]
    assert A.measure([t.encode() for t in some]).tolist() == [plain_measures(t) for t in some]


def test_equal_hashes_decide_nothing():
    some = texts(2, 60)
    for bits in (1, 3):
        assert A.measure([t.encode() for t in some], bits).tolist() == [plain_measures(t) for t in some]


def test_the_transducer_step_by_step():
    """Whole-array states are those of a walk from byte to byte, broken characters included."""
    draw = random.Random(3)
    for _ in range(300):
        data = np.array([draw.choice([32, 65, 36, 97, 0xC3, 0xE2, 0xF0, 0x80, 0xBF, 9]) for _ in range(40)], np.uint8)
        state, expected = A.GAP, []
        for kind in A.CLASS[data]:
            state = A.AFTER[state, kind]
            expected.append(state)
        assert A.run(A.CLASS[data]).tolist() == expected


def failed(m):
    return "".join(x for x, bad in zip("ABCD", (m[0] < 20, 2 * m[1] < m[0], 100 * m[3] > 30 * m[2], m[4] > 0)) if bad)


def filters():
    return {
        "A": F.col("m.words") < 20,
        "B": 2 * F.col("m.distinct_words") < F.col("m.words"),
        "C": 100 * F.col("m.capitals") > 30 * F.col("m.code_points"),
        "D": F.col("m.symbols") > 0,
    }


def expected(docs, labels):
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    marked = []
    for i, t, part in docs:
        fails = failed(plain_measures(t or "")) + ("E" if i is not None and least[t or ""] < i else "")
        own = [x for x in labels if i is not None and x[0] == i]
        marked.append((part or "", fails, any(q == 1 for _, q, _ in own), any(x == 1 for _, _, x in own)))
    out, shapley = {}, {}
    for part in {m[0] for m in marked}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [m for m in marked if m[0] == part]
            every = left
            for step, own in enumerate(order, 1):
                gone = [m for m in left if own in m[1]]
                left = [m for m in left if own not in m[1]]
                redundant = sum(own in m[1] and bool(set(m[1]) & set(order[: step - 1])) for m in every)
                unique = sum(m[1] == own for m in every)
                shapley[part, own] = shapley.get((part, own), 0) + len(gone)
                out[part, order, step] = (len(left), len(gone), redundant, unique, sum(m[2] for m in gone), sum(m[3] for m in gone))
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(spark, docs, labels):
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").selectExpr("*", "1 as m", "2 as k", "3 as n", "4 as spread", "5 as failed")
    said = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").selectExpr("*", "1 as k", "2 as good", "3 as spread")
    rows = A.audit(df.repartition(3), said, filters(), copies="E").collect()
    found = {tuple(r)[:3]: tuple(r)[3:] for r in rows}
    assert len(found) == len(rows)
    return found


def test_audit_of_odd_rows(workers):
    draw = random.Random(5)
    some = texts(6, 120, 90)
    docs = [(i, draw.choice(some[:80]), draw.choice(["x", "y", None, ""])) for i in range(200)]
    docs += [(i, "same words " * 3, "x") for i in range(300, 420)]  # a large group of copies
    docs += [(7, "again", "x")] * 5 + [(8, "again", "x"), (7, "other", "y"), (None, "again", "x"), (None, None, None), (500, None, "z"), (501, "", "z")]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1])) for i in range(0, 400, 2)] + [(7, 1, 0), (7, 0, 1), (None, 1, 1), (9_999, 1, 1)]
    assert audited(workers, docs, labels) == expected(docs, labels)


def test_audit_of_empty_tables(workers):
    assert audited(workers, [], []) == {}
    assert audited(workers, [(1, "a #", "x")], []) == expected([(1, "a #", "x")], [])
