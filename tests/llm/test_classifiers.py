"""Classifiers: held-out accuracy, exact steps, and odd inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import features, language_id, quality, toxicity
from corpusflow.llm.queries import QUERIES
from corpusflow.llm.runtime import fold

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(workers):
    return workers.read.parquet(f"{DATA}/labels.parquet")


@pytest.mark.parametrize(
    "name, label, fold_of, least", [("op3_quality", "quality", (4, 2), 0.95), ("op4_toxicity", "toxic", (3, 1), 0.9)]
)
def test_held_out_accuracy(workers, labels, name, label, fold_of, least):
    rows = QUERIES[name](workers, DATA)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    all_rows = rows.collect()
    assert len(all_rows) == workers.read.parquet(f"{DATA}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in all_rows)
    known = {r.doc_id: r[label] for r in labels.collect()}
    held = [r for r in all_rows if r.held_out and r.doc_id in known]
    assert np.mean([(r.score >= 0.5) == known[r.doc_id] for r in held]) >= least
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % fold_of[0] == fold_of[1]) for r in all_rows)


def test_held_out_labels_are_not_learned(workers, labels):
    docs = workers.read.parquet(f"{DATA}/documents.parquet")
    other = labels.withColumn("quality", F.when(fold(F.col("doc_id"), 4) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    taught = fold(F.col("k"), 4) != 2
    a, b = quality.fit(docs, labels, taught=taught), quality.fit(docs, other, taught=taught)
    assert np.array_equal(a.weights, b.weights) and (a.slope, a.offset) == (b.slope, b.offset)


def test_document_counts_cover_all_rows(table):
    extract = features.quality_features(10)
    rows = [(i, " ".join(np.random.default_rng(i).choice(list("abcdefg"), 5))) for i in range(60)]
    df = table(rows).select(F.col("doc_id").alias("k"), F.col("text").alias("t"), (F.col("doc_id") % 2).cast("int").alias("y"))
    counts = quality.document_counts(df.repartition(5), extract, 10)
    expected = np.zeros((2, 1024), np.int64)
    for i, t in rows:
        expected[i % 2][extract([t.encode()])[1]] += 1
    assert np.array_equal(counts, expected)


def test_dual_descent_reaches_the_optimum():
    """The primal value equals the dual value."""
    draw = np.random.default_rng(3)
    x = draw.normal(size=(40, 6))
    y = np.where(x @ draw.normal(size=6) + draw.normal(size=40) > 0, 1.0, -1.0)
    vectors = [(np.arange(6), row) for row in x]
    w = quality.descend(vectors, y, np.ones(40), 6, 2000)
    primal = 0.5 * w @ w + np.maximum(0, 1 - y * (x @ w)).sum()
    for _ in range(200):
        near = w + draw.normal(scale=0.02, size=6)
        assert 0.5 * near @ near + np.maximum(0, 1 - y * (x @ near)).sum() >= primal - 1e-3


def test_ftrl_weights_follow_the_formula():
    f = toxicity.FtrlProximal(4, rate=0.5, smooth=1.0, l1=0.1, l2=0.2)
    z, n = np.zeros(4), np.zeros(4)
    for at, y in (([0, 1], 1), ([1, 2], 0), ([0, 3], 1), ([1, 2], 0)):
        w = np.array([0.0 if abs(z[i]) <= 0.1 else -(z[i] - np.sign(z[i]) * 0.1) / ((1 + np.sqrt(n[i])) / 0.5 + 0.2) for i in at])
        g = 1 / (1 + np.exp(-w.sum())) - y
        for i, wi in zip(at, w):
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / 0.5 * wi
            n[i] += g * g
        f.learn(np.array(at), y, 1.0)
    assert np.allclose(f.z, z) and np.allclose(f.n, n)


def test_toxicity_learns_from_6000_rows_of_a_class(workers, monkeypatch):
    """5,000 rows of each class fit the documented sample whole."""
    drawn, seen = features.drawn, []
    monkeypatch.setattr(features, "drawn", lambda *a: seen.append(drawn(*a)) or seen[-1])
    ids = workers.range(10_000, numPartitions=4)
    docs = ids.select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 7).alias("text"))
    toxicity.fit(docs, ids.select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic")), bits=10, epochs=1)
    assert [sum(y == label for y, _ in seen[0]) for label in (0, 1)] == [5000, 5000]


@pytest.mark.parametrize("per_class", [200, 10_000])
def test_toxicity_scores_have_the_class_shares(workers, per_class):
    """One row in 50 is toxic and the texts tell nothing: scores say so at any size of the sample."""
    ids = workers.range(10_000, numPartitions=4)
    docs = ids.select(F.col("id").alias("doc_id"), F.lit("same words").alias("text"))
    labels = ids.select(F.col("id").alias("doc_id"), (F.col("id") % 50 == 0).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels, bits=10, sample_per_class=per_class)
    assert 0.01 <= toxicity.score(docs.limit(1), model).first().score <= 0.04


def test_features_ignore_the_batch():
    texts = ["One two, two three!", "", "x", "é ß 12 12 12", "!!! ???"]
    for extract in (features.quality_features(16), features.toxicity_features(16)):
        owner, found = extract([t.encode() for t in texts])
        for i, t in enumerate(texts):
            assert np.array_equal(found[owner == i], extract([t.encode()])[1])


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows(workers, edge, module, label):
    odd = workers.createDataFrame([(2, 1), (5, 0), (6, 1), (7, None), (None, 1), (99, 1), (9, 0), (1, 0)], f"doc_id bigint, {label} int")
    clash = edge.withColumnRenamed("lang", "score").withColumnRenamed("source", label)
    rows = module.score(clash, module.fit(clash, odd)).collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows)
    same = [r.score for r in rows if not r.text or not r.text.strip()]
    assert len(set(same)) == 1
    none = module.fit(edge, odd.limit(0))
    assert len({r.score for r in module.score(edge, none).collect()}) == 1
    assert module.score(edge.limit(0), none).count() == 0


def test_language_held_out(workers):
    docs = {r.doc_id: r.lang for r in workers.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = QUERIES["op8_language_id"](workers, DATA).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([docs[r.doc_id] == r.lang_pred for r in held]) >= 0.95


def test_language_odd_rows(workers, edge, table):
    taught = workers.createDataFrame(
        [(1, "the quick brown fox and the dog " * 9, "en"), (2, "der schnelle braune fuchs und der hund " * 9, "de"),
         (3, None, "en"), (None, "x", "en"), (4, "y", None)], "doc_id bigint, text string, lang string"
    )
    learned = language_id.learn(taught)
    assert sorted(learned) == ["de", "en"]
    rows = language_id.identify(table([(1, "The dog and the fox"), (2, "Der Hund und der Fuchs")]), learned).collect()
    assert [r.language.lang for r in rows] == ["en", "de"]
    rows = language_id.identify(edge.withColumnRenamed("lang", "language"), learned).collect()
    assert len(rows) == 12
    for r in rows:
        assert (r.language.lang == "und") == (not any(c.isalpha() for c in r.text or ""))
    assert language_id.learn(taught.limit(0)) == {}
    assert {r.language.lang for r in language_id.identify(edge, {}).collect()} == {"und"}


def test_a_rare_language_changes_nothing_for_the_others(workers):
    docs = workers.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang")
    rare = workers.createDataFrame([(10**6 + i, f"zwukx qolp vrint {i} dluk zwukx mepf", "xx") for i in range(5)], docs.schema)
    plain, more = language_id.learn(docs), language_id.learn(docs.unionByName(rare))
    assert {n: c for n, c in more.items() if n != "xx"} == plain and "xx" in more
    held = docs.filter(fold(F.col("doc_id"), 4) == 2).limit(150)
    before = {r.doc_id: r.language for r in language_id.identify(held, plain).collect()}
    after = {r.doc_id: r.language for r in language_id.identify(held, more).collect()}
    known = {r.doc_id: r.lang for r in held.collect()}
    right = lambda found: np.mean([found[i].lang == known[i] for i in known])
    assert right(after) >= right(before) - 0.01
    own = language_id.identify(rare.limit(2), more).collect()
    assert {r.language.lang for r in own} == {"xx"}


def test_rare_languages_are_compared_at_their_size():
    """Dictionaries of three sizes; a text of each language, and one that none knows."""
    words = {n: [f"{n}{i * i % 997}" for i in range(4_000)] for n in ("aa", "bb", "cc", "dd")}
    sizes = {"aa": 4_000, "bb": 3_000, "cc": 900, "dd": 60}
    contents = {n: " ".join(words[n][: sizes[n]]).encode() for n in words}
    judge = language_id.Judge(tuple(contents.items()), 5)
    assert judge.rare == ["bb", "cc", "dd"] or judge.rare == ["cc", "dd"]
    for n in words:
        assert judge.name(" ".join(words[n][20:50]))[0] == n
    assert 0 <= judge.name("?! 0")[1] <= 1
