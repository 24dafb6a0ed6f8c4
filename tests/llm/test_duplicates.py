"""Near-duplicates, fingerprints, contamination and repeats against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import combinations
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import bag_minhash, order_minhash, suffix_buckets, winnowing
from corpusflow.llm.components import components
from corpusflow.llm.queries import QUERIES, ORACLE

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def multiset(text):
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def near_classes(texts, similarity=0.8):
    """Class by id, from all pairs."""
    sets = {i: multiset(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(texts), 2):
        if texts[a] is None or texts[b] is None:
            continue
        union = sum((sets[a] | sets[b]).values())
        alike = sum((sets[a] & sets[b]).values()) / union >= similarity if union else texts[a] == texts[b]
        if alike:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: find(i) for i in texts}


@pytest.fixture(scope="module")
def small(workers, small_dir):
    return {r.doc_id: r.text for r in workers.read.parquet(f"{small_dir}/documents.parquet").collect()}


def test_signatures_estimate_weighted_similarity():
    draw = np.random.default_rng(2)
    for _ in range(4):
        keys = draw.integers(0, 2**63, 50).astype(np.uint64)
        a = draw.integers(0, 9, 50)
        b = np.maximum(0, a + draw.integers(-2, 3, 50))
        owner = np.concatenate([np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)])
        times = bag_minhash.signatures(
            owner, np.concatenate([keys[a > 0], keys[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), 2, 8192
        )
        assert abs((times[0] == times[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03


def test_signatures_ignore_the_batch():
    texts = [b"a b c d e f g", b"", b"x", b"a b c d e f g " * 30]
    together = bag_minhash.signatures(*bag_minhash.shingles(bag_minhash.read_words(texts), 4), 4)
    for i, t in enumerate(texts):
        alone = bag_minhash.signatures(*bag_minhash.shingles(bag_minhash.read_words([t]), 1), 1)
        assert np.array_equal(together[i], alone[0])


def test_pairs_at_the_threshold_are_hardly_ever_missed():
    """By the bands, and by the screen of signatures, at 0.8."""
    size, share = bag_minhash.COMPONENTS, Fraction(4, 5)
    apart = (1 - share**bag_minhash.BAND_ROWS) ** (size // bag_minhash.BAND_ROWS)
    least = round(bag_minhash.least_agreement(0.8) * size)
    dropped = sum(comb(size, k) * share**k * (1 - share) ** (size - k) for k in range(least))
    assert apart <= 1e-9 and dropped <= 1e-7 < dropped + comb(size, least) * share**least * (1 - share) ** (size - least)


def test_near_duplicates_of_a_table(workers, small_dir, small):
    got = {r.doc_id: r.class_id for r in QUERIES["op2_bag_minhash"](workers, small_dir).collect()}
    assert got == near_classes(small)


def test_chains_groups_and_odd_rows(table):
    draw = random.Random(4)
    base = [f"w{draw.randint(0, 10**6)}" for _ in range(120)]
    texts, current = {}, base
    for i in range(60):  # a chain: neighbours are alike, the ends are not
        texts[100 + i] = " ".join(current)
        at = draw.randrange(120)
        current = [*current[:at], f"x{i}", *current[at + 1 :]]
    for i in range(40):  # a star whose members differ from each other
        text = list(base[::-1])
        text[draw.randrange(120)] = f"y{i}"
        text[draw.randrange(120)] = f"z{i}"
        texts[300 + i] = " ".join(text)
    texts |= {1: None, 2: "", 3: "", 4: "!!!", 5: "...", 6: "One two", 7: "one TWO!", 8: "a " * 50, 9: "a " * 49, 10: None}
    rows = [*texts.items(), (6, "One two"), (None, "one two"), (50, "this"), (50, "that"), (51, "this")]
    rows += [(52, " ".join(base)), (52, "that"), (None, "one two"), (None, "ONE  two"), (None, " ".join(base[::-1])), (None, None), (10, None), (2, None)]
    found = bag_minhash.near_duplicates(table(rows, lang="x").withColumnRenamed("lang", "class_id")).collect()
    assert_classes(found, rows)
    assert bag_minhash.near_duplicates(table([])).count() == 0
    # Copies of a text are found whatever becomes of their ids.
    found = bag_minhash.near_duplicates(table([(1, "A b"), (1, "C d"), (2, "A b"), (None, "A b")])).collect()
    assert sorted((r.doc_id or 9, r.class_id, r.kept) for r in found) == [(1, 1, True), (1, 1, True), (2, 1, False), (9, 1, False)]
    assert {r.class_digest for r in found if r.doc_id != 1} == {hashlib.sha256(b"A b").hexdigest()}
    for rows in ([(None, "x y"), (None, "X y"), (None, "z")], [(2**63 - 1, "x"), (2**63 - 1, "y"), (None, "x"), (None, None)]):
        assert_classes(bag_minhash.near_duplicates(table(rows)).collect(), rows)


def assert_classes(found, rows):
    """One row for each id and text, in the class of a brute-force comparison."""
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest() if t is not None else ""
    each = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, digest(r[1])))
    classes = near_classes({n: t for n, (_, t) in enumerate(each)})
    texts_of = defaultdict(set)
    for i, t in each:
        if t is not None:
            texts_of[i].add(t)
    expected = Counter()
    for n, (i, t) in enumerate(each):
        own, first = digest(t), each[classes[n]]
        named = lambda r: r[1] is None or (r[0] is not None and len(texts_of[r[0]]) == 1)
        expected[i, None if named((i, t)) else own, first[0], classes[n] == n] += 1
    assert Counter((r.doc_id, r.digest, r.class_id, r.kept) for r in found) == expected


@pytest.mark.parametrize("bound, size", [("GROUP_NODES", 3), ("GROUP_BYTES", 2_000)])
def test_centres_are_dealt_out(table, monkeypatch, bound, size):
    monkeypatch.setattr(bag_minhash, bound, size)
    base = " ".join(f"w{i}" for i in range(100))
    texts = {i: f"{base} tail{i}" for i in range(20)}
    assert {r.class_id for r in bag_minhash.near_duplicates(table(list(texts.items()))).collect()} == {0}


def test_components(workers):
    draw = random.Random(9)
    links = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 500)]
    got = {r.node: r.root for r in components(workers.createDataFrame(links, "a bigint, b bigint")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    assert got == {n: find(n) for n in parent if find(n) != n}
    assert components(workers.createDataFrame([], "a bigint, b bigint")).count() == 0


def repeats(texts, length=200):
    """Per id: bytes, removed, runs, kept."""
    data = {i: (t or "").encode() for i, t in texts}
    seen = Counter(t[p : p + length] for t in data.values() for p in range(len(t) - length + 1))
    out = {}
    for i, t in data.items():
        hit = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                hit[p : p + length] = b"\1" * length
        runs = sum(1 for k in range(len(t)) if hit[k] and not (k and hit[k - 1]))
        out[i] = (sum(hit), runs, bytes(c for c, h in zip(t, hit) if not h))
    return out


def test_repeats_of_a_table(workers, small_dir, small):
    expected = repeats(small.items())
    for r in QUERIES["op9_suffix_buckets"](workers, small_dir).collect():
        gone, runs, kept = expected[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(small[r.doc_id].encode()), gone, runs)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_repeats_at_the_borders(table):
    draw = random.Random(6)
    line = lambda n: "".join(draw.choice("abcdefghij klmn") for _ in range(n))
    shared, accents = line(200), "é" * 3 + line(300)
    rows = [
        (1, line(50) + shared + line(9)), (2, line(7) + shared), (3, shared[:199] + "Z" + line(30)), (4, "ab" * 300),
        (5, None), (6, ""), (7, shared[1:]), (8, line(199)), (9, "q" * 201), (10, "r" * 200), (11, accents + "x"),
        (12, "è" + accents[1:] + "y"), (13, line(400)), (None, shared + line(3)),
    ]
    rows += [(20 + i, shared[i:] + line(40)) for i in range(8)]
    expected = repeats([(i if i is not None else -1, t) for i, t in rows])
    df = table(rows, lang="x").withColumnRenamed("lang", "n_spans").withColumnRenamed("source", "kept")
    result = suffix_buckets.without_repeats(df)
    assert result.columns == ["doc_id", "text", "n_chars", *suffix_buckets.NEW]
    for r in result.collect():
        assert (r.n_removed, r.n_spans, bytes(r.kept)) == expected[-1 if r.doc_id is None else r.doc_id]
        assert r.kept_text.encode() in (bytes(r.kept), r.kept_text.encode())
    cut = {r.doc_id: r.kept_text for r in result.collect()}
    assert cut[12] == "èéé"[:1] + "y" or "�" not in cut[12]


def test_repeated_rows_and_blocks_of_any_size(table, monkeypatch):
    monkeypatch.setattr(suffix_buckets, "BLOCK_BYTES", 700)
    draw = random.Random(8)
    rows = [(i, "".join(draw.choice("ab ") for _ in range(draw.randint(0, 600)))) for i in range(30)]
    rows += [(100 + i, rows[i][1][50:450] + "#") for i in range(10)]
    expected = repeats(rows)
    for r in suffix_buckets.without_repeats(table(rows)).collect():
        assert (r.n_removed, r.n_spans, bytes(r.kept)) == expected[r.doc_id]
    twice = suffix_buckets.without_repeats(table([(1, "c" * 50 + rows[0][1] * 2 + "d" * 200)] * 2)).collect()
    assert [len(r.kept) for r in twice] == [0, 0]
    assert suffix_buckets.without_repeats(table([])).count() == 0


def contaminated(docs, items):
    out = {}
    for key, text in docs:
        w, hit, names = words(text), set(), set()
        for item, t in items:
            v = words(t)
            n = min(10, len(v))
            windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else set()
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in windows:
                    hit |= set(range(p, p + n))
                    names.add(str(item))
        out[key] = (len(w), len(hit), sorted(names))
    return out


def test_contamination(workers, table):
    draw = random.Random(12)
    vocabulary = ["a", "b", "é", "c3", "漢"]
    say = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    items = [(i, say(draw.randint(1, 40))) for i in range(25)]
    items += [(30, items[3][1]), (31, "Rare, SHORT item"), (32, ""), (33, None), (34, "é" * 5_000), (35, "x y z " * 20)]
    docs = [(i, say(draw.randint(0, 80))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "rare short ITEM"), (103, f"{say(5)}. {items[0][1]}, {items[1][1]}!"), (104, "x y z " * 50)]
    frame = workers.createDataFrame(items, "item_id bigint, text string")
    rows = winnowing.contamination(table(docs, lang="x").withColumnRenamed("lang", "item_id"), frame).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in rows} == contaminated(docs, items)
    same = winnowing.contamination(table([(1, items[5][1])] * 2 + [(None, "a b")]), frame.filter("item_id in (5, 33)")).collect()
    assert len(same) == 3 and sorted(r.n_hit for r in same) == [0, *[len(words(items[5][1]))] * 2]
    assert all(r.n_hit == 0 for r in winnowing.contamination(table(docs), frame.limit(0)).collect())
    assert winnowing.contamination(table([]), frame).count() == 0


def test_winnowing_keeps_one_mark_in_every_window():
    draw = np.random.default_rng(5)
    for size in (6, 7, 100):
        hashes = draw.integers(0, 12, size).astype(np.uint64)
        first = np.arange(size)
        chosen = winnowing.winnow(hashes, first, np.zeros(size + 4, np.int64))
        for p in range(size - 5):
            inside = chosen[(chosen >= p) & (chosen < p + 6)]
            assert len(inside) and hashes[inside].min() == hashes[p : p + 6].min()


M64 = (1 << 64) - 1


def mixed(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & M64
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & M64
    return x ^ (x >> 31)


def sketch_by_definition(text, kmer=order_minhash.KMER):
    """Each function's two smallest occurrence-numbered k-mers, found one by one."""
    factor = lambda seed: mixed((seed + 1) * 0x9E3779B97F4A7C15 & M64)
    points = [ord(c) + 1 for c in text]
    width = min(kmer, len(points))
    seen, grams = Counter(), []
    for i in range(max(1, len(points) - kmer + 1)):
        content = mixed((width + sum(points[i + t] * factor(t) for t in range(width))) & M64) >> 24
        grams.append((content, seen[content]))
        seen[content] += 1
    out = []
    for j in range(order_minhash.FUNCTIONS):
        ranks = [mixed((c + n * factor(99)) & M64) * (factor(500 + j) | 1) & M64 for c, n in grams]
        two = sorted(sorted(range(len(grams)), key=ranks.__getitem__)[:2])
        a, b = two[0], two[-1]
        out.append(mixed((mixed(grams[a][0]) * 3 + mixed(mixed(grams[b][0]))) & M64) >> 32)
    return out


def test_sketch_follows_the_definition():
    draw = random.Random(11)
    for text in ["", "a", "abcdef", "abab abcab cabcab ab" * 3, "é漢字😀" * 20, "".join(draw.choice("ab") for _ in range(900))]:
        assert order_minhash.sketch(text).tolist() == sketch_by_definition(text)


def test_long_texts_have_the_same_kmers(monkeypatch):
    text = "".join(random.Random(12).choice("abc ") for _ in range(5_000))
    packed = order_minhash.by_content(order_minhash.mix(np.arange(5_000, dtype=np.uint64) % np.uint64(700)))
    expected = np.argsort(packed[1], kind="stable")
    assert np.array_equal(expected, np.arange(5_000))
    usual = order_minhash.sketch(text)
    # The other way to sort, for texts whose places need more bits.
    hashes = order_minhash.mix(np.arange(5_000, dtype=np.uint64) % np.uint64(700))
    content = hashes >> np.uint64(24)
    place = np.argsort(content, kind="stable")
    assert np.array_equal(place, packed[0]) and np.array_equal(content[place], packed[1])
    assert usual.tolist() == sketch_by_definition(text)


def test_likeness_does_not_depend_on_the_length_class():
    draw = random.Random(13)
    for kmers in (1_023, 2_047, 4_095):
        text = "".join(draw.choice("abcdefghijklmnop ") for _ in range(kmers + order_minhash.KMER - 1))
        assert order_minhash.likeness(order_minhash.sketch(text), order_minhash.sketch(text + "#")) >= 0.9
        assert order_minhash.likeness(order_minhash.sketch(text), order_minhash.sketch(text[:-1])) >= 0.9


def test_likeness_falls_with_edits_and_moves():
    text = "abab abcab cabcab ab" * 3
    moved = text[30:] + text[:30]
    assert order_minhash.likeness(order_minhash.sketch(text), order_minhash.sketch(moved)) < 1
    draw = random.Random(3)
    base = "".join(draw.choice("abcdefghijklmnop ") for _ in range(3_000))
    scores = []
    for edits in (0, 10, 60, 400):
        changed = list(base)
        for _ in range(edits):
            changed[draw.randrange(len(changed))] = "#"
        scores.append(order_minhash.likeness(order_minhash.sketch(base), order_minhash.sketch("".join(changed))))
    assert scores[0] == 1 and scores == sorted(scores, reverse=True) and scores[-1] < 0.3


def test_edits_follow_the_next_document(workers, small_dir, small, table, edge):
    def expected(texts):
        for i, text in enumerate(texts):
            changed = order_minhash.edited(text, texts[(i + 1) % len(texts)])
            prints = [order_minhash.sketch(t) for t in (text, changed, texts[(i + 1) % len(texts)])]
            yield (
                len(text), hashlib.sha256(changed.encode()).hexdigest(),
                order_minhash.likeness(prints[0], prints[1]), order_minhash.likeness(prints[0], prints[2]),
            )

    ids = sorted(small)
    want = dict(zip(ids, expected([small[i] for i in ids])))
    got = QUERIES["op5_order_minhash"](workers, small_dir).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got} == want
    assert len({(small[r.doc_id], r.fingerprint) for r in got}) == len(set(small.values()))
    rows = sorted(((i is None, i or 0, t or "") for i, t, *_ in edge.collect()))
    odd = order_minhash.with_edits(edge.withColumnRenamed("lang", "fingerprint")).collect()
    assert Counter((r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in odd) == Counter(expected([t for _, _, t in rows]))
    assert order_minhash.with_edits(table([])).count() == 0
    assert order_minhash.with_edits(table([(1, "abc")])).first().near_next == 1.0


def test_sql(workers, small_dir):
    from compare import compare, duck

    con = duck(small_dir)
    assert [compare(workers, con, name, small_dir) for name in ORACLE] == [""] * len(ORACLE)


def test_pipeline(workers, small_dir, small):
    """Each stage against brute force on its own input."""
    import corpus_pipeline
    from corpusflow.sources.scratch import stage

    docs = workers.read.parquet(f"{small_dir}/documents.parquet")
    items = [(r.item_id, r.text) for r in workers.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    (_, good), (_, single), (_, cut), (_, apart), (_, tokens) = corpus_pipeline.STAGES
    kept = stage(good(workers, docs, small_dir), "t")
    assert kept.columns == docs.columns
    scores = {r.doc_id: r.score for r in QUERIES["op3_quality"](workers, small_dir).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, s in scores.items() if s >= 0.7}
    texts = {r.doc_id: r.text for r in kept.collect()}
    once = stage(single(workers, kept, small_dir), "t")
    assert {r.doc_id for r in once.collect()} == set(near_classes(texts).values())
    texts = {r.doc_id: r.text for r in once.collect()}
    expected = repeats(texts.items())
    shorter = stage(cut(workers, once, small_dir), "t")
    rows = shorter.collect()
    assert shorter.columns == docs.columns and len(rows) == len(texts)
    assert all(r.text == expected[r.doc_id][2].decode("utf-8", "ignore") and r.n_chars == len(r.text) for r in rows)
    left = stage(apart(workers, shorter, small_dir), "t")
    marks = contaminated([(r.doc_id, r.text) for r in rows], items)
    assert {r.doc_id for r in left.collect()} == {i for i, m in marks.items() if not m[1]}
    assert tokens(workers, left, small_dir).count() == left.count()


#: Names that operators and stages use inside, or for their results.
INSIDE = (
    "marks n_words n_hit item_ids row _text words given _d _t _x _m _spans kept kept_text n_removed n_spans _score score id t k y"
    " class_id class_digest digest wordless node label bucket ids bytes n_tokens ids_sha256 decoded_sha256 item_id h p s e d"
).split()


def with_clashes(docs):
    """A column of each such name, with contents of its own."""
    return docs.select("*", *[F.concat_ws("|", F.lit(name), "doc_id", F.length("text")).alias(name) for name in INSIDE])


def test_further_columns_keep_their_contents(workers, small_dir, edge):
    import corpus_pipeline

    docs = edge.unionByName(workers.read.parquet(f"{small_dir}/documents.parquet").limit(60).select(edge.columns))
    docs = docs.withColumn("text0", F.col("text"))
    wide = with_clashes(docs)
    given = {tuple(r[c] for c in INSIDE) for r in wide.collect()}
    for _, work in corpus_pipeline.STAGES[:4]:
        made = work(workers, wide, small_dir)
        assert made.columns == wide.columns and made.dtypes == wide.dtypes
        rows = made.collect()
        assert rows and all(tuple(r[c] for c in INSIDE) in given for r in rows)
        plain = work(workers, docs, small_dir).collect()
        own = lambda rs: Counter((r.doc_id, r.text, r.n_chars, r.text0) for r in rs)
        assert own(rows) == own(plain)
    last = corpus_pipeline.STAGES[4][1]
    made = last(workers, wide, small_dir)
    new = ["n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    assert made.columns == [c for c in wide.columns if c not in ("text", "n_chars", *new)] + new
    assert all(r.marks == f"marks|{r.doc_id}|{len(r.text0)}" for r in made.collect() if r.doc_id and r.text0)
    bare = last(workers, docs.select("doc_id", "text"), small_dir)
    assert bare.columns == ["doc_id", *new] and bare.count() == docs.count()

    items = workers.read.parquet(f"{small_dir}/benchmark.parquet")
    found = winnowing.contamination(wide, items)
    assert found.columns == [c for c in wide.columns if c not in ("text", "n_words", "n_hit", "item_ids")] + ["n_words", "n_hit", "item_ids"]
    assert all(r.marks == f"marks|{r.doc_id}|{len(r.text0)}" and r.row.startswith("row|") for r in found.collect() if r.doc_id and r.text0)
    found = suffix_buckets.without_repeats(wide)
    assert all(r._x == f"_x|{r.doc_id}|{len(r.text0)}" for r in found.collect() if r.doc_id and r.text0)


def test_anchors_do_not_depend_on_the_block():
    """Equal runs have their minimum at one offset, in blocks of any length, ties included."""
    draw = np.random.default_rng(5)
    run = draw.integers(0, 4, 400).astype(np.uint64) << np.uint64(30)
    run |= draw.integers(0, 2, 400).astype(np.uint64) << np.uint64(23)  # beyond what is compared
    expected = suffix_buckets.sliding_last_minimum(run, 151)
    for before, after in ((0, 10), (5_000, 3), (70_000, 70_000)):
        high = np.full(before, 2**63, np.uint64), np.full(after, 2**63, np.uint64)
        whole = suffix_buckets.sliding_last_minimum(np.concatenate((high[0], run, high[1])), 151)
        assert np.array_equal(whole[before : before + len(expected)] - before, expected)


def test_blocks_of_any_length_have_the_same_anchors(monkeypatch):
    values = np.random.default_rng(6).integers(0, 50, 5_000).astype(np.uint64) << np.uint64(40)
    whole = suffix_buckets.sliding_last_minimum(values, 30)
    assert all(values[m] == values[i : i + 30].min() and values[m + 1 : i + 30].min(initial=2**63) > values[m] for i, m in enumerate(whole.tolist()))
    monkeypatch.setattr(suffix_buckets, "PLACE_BITS", 8)
    assert np.array_equal(suffix_buckets.sliding_last_minimum(values, 30), whole)


@pytest.mark.parametrize("bound", [0, 1 << 30])
def test_sent_and_shuffled_tables_give_the_same(workers, small_dir, small, monkeypatch, bound):
    """Both sides of the size that decides whether a table is sent to the texts."""
    from corpusflow.llm import runtime

    monkeypatch.setattr(runtime, "BROADCAST_BYTES", bound)
    docs = workers.read.parquet(f"{small_dir}/documents.parquet")
    got = {r.doc_id: (r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_buckets.without_repeats(docs).collect()}
    assert got == {i: (e[0], e[1], e[2]) for i, e in repeats(small.items()).items()}


def test_pipeline_on_odd_rows(workers, small_dir, edge):
    import corpus_pipeline

    docs = edge.unionByName(workers.read.parquet(f"{small_dir}/documents.parquet").select(edge.columns))
    docs = docs.withColumnsRenamed({"source": "score"}).withColumn("kept", docs.lang)
    for _, work in corpus_pipeline.STAGES[:4]:
        docs = work(workers, docs, small_dir)
        assert docs.columns == ["doc_id", "text", "lang", "score", "n_chars", "kept"]
    assert docs.count() > 50
    left = defaultdict(int)
    for work in (corpus_pipeline.drop_near_duplicates, corpus_pipeline.cut_repeats, corpus_pipeline.drop_contaminated):
        left[work.__name__] = work(workers, edge, small_dir).count()
        assert work(workers, edge.limit(0), small_dir).count() == 0
    # Of the twelve rows one repeats another, and two differ in case alone.
    assert left["drop_near_duplicates"] == 10 and left["cut_repeats"] == 12
