"""Token operators against the libraries they stand for."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken

from corpusflow.llm import byte_bpe, piece_counts

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
MODEL = P.path("piece_bpe_32k.model")
PARTS = ["a", "b", "e", "th", "in", "é", "漢", "字", "ß", " ", "  ", "\n", "1", "23", "!!", "<s>", "　", "ﬁ", "▁", "x" * 50, "ing", "THE", "😀", "\x00"]


def texts():
    draw = random.Random(7)
    mixed = ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 200))) for _ in range(300)]
    letters = "".join(draw.choice("abcdefghijkl") for _ in range(6_000))
    return [*mixed, "", " ", "a" * 3_000, "ab" * 2_000, letters, "    " * 300, "漢字" * 800, "aab" * 1_000]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_tree_gives_the_ids_of_the_library(reference):
    encode = byte_bpe.encoder_of(RANKS, P.PATTERN)
    for text in texts():
        assert np.frombuffer(encode(text), np.int32).tolist() == reference.encode_ordinary(text)


def test_join_is_a_monoid():
    tree = byte_bpe.tree_of(RANKS)
    draw = random.Random(3)
    for _ in range(300):
        data = "".join(draw.choice(PARTS) for _ in range(12)).encode()
        i, j = sorted(draw.randint(0, len(data)) for _ in range(2))
        a, b, c = map(tree.merge, (data[:i], data[i:j], data[j:]))
        assert tree.join(tree.join(a, b), c) == tree.join(a, tree.join(b, c)) == tree.merge(data)
        assert tree.join((), a) == tree.join(a, ()) == a


def test_small_tables_of_ranks():
    """Tokens that no merge reaches, and ranks that don't follow the order of merges."""
    ranks = {bytes([b]): i for i, b in enumerate(b"abc")} | {b"bc": 3, b"abc": 4, b"ab": 5, b"cab": 6, b"abcab": 7}
    tree = byte_bpe.BytePairTree(ranks)
    draw = random.Random(5)
    for _ in range(300):
        data = bytes(draw.choice(b"abc") for _ in range(draw.randint(1, 60)))
        assert tree.reduce(data) == tree.merge(data)


def test_encode_and_decode_columns(edge, reference):
    coded = byte_bpe.decode(byte_bpe.encode(edge.withColumnRenamed("lang", "ids"), RANKS, P.PATTERN), RANKS)
    assert coded.columns == ["doc_id", "text", "ids", "source", "n_chars", "bytes"]
    rows = coded.collect()
    assert len(rows) == 12
    for row in rows:
        assert row.ids == reference.encode_ordinary(row.text or "")
        assert bytes(row.bytes) == (row.text or "").encode()


def test_unknown_ids_fail(workers):
    bad = workers.createDataFrame([([10**6],)], "ids array<int>")
    with pytest.raises(Exception, match="1000000"):
        byte_bpe.decode(bad, RANKS).collect()


def test_counts_are_those_of_the_library():
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    counter = piece_counts.TokenCounter(piece_counts.counter_of(MODEL).merges)
    expected = [len(model.encode(t)) for t in texts()]
    assert counter.count(texts()) == expected
    assert counter.count(texts()) == expected  # from the known words


def test_counts_survive_a_full_table(monkeypatch):
    monkeypatch.setattr(piece_counts, "CACHE_ENTRIES", 10)
    counter = piece_counts.TokenCounter(piece_counts.counter_of(MODEL).merges)
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in texts()[:60]:
        assert counter.count([text]) == [len(model.encode(text))]


def test_long_sequences_with_unordered_ranks():
    """Merging many places at once equals merging one by one, also where a new pair goes first."""
    pieces = {"a": 0.0, "b": 0.0, "c": 0.0, "aba": -1.0, "ab": -2.0, "ba": -3.0, "abab": -4.0, "bc": -2.0, "abc": -0.5}
    merges = piece_counts.PieceMerges(pieces)
    draw = random.Random(11)
    for _ in range(200):
        word = "".join(draw.choice("abc") for _ in range(draw.randint(1, 80)))
        symbols = list(word)
        while True:
            scores = [pieces.get(x + y, -np.inf) for x, y in zip(symbols, symbols[1:])]
            if not scores or max(scores) == -np.inf:
                break
            k = scores.index(max(scores))
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
        ids, counts = np.array([merges.ids[c] for c in word], np.int64), np.zeros(1, np.int64)
        merges.merge_by_rank(ids, np.zeros(len(ids), np.int64), counts)
        assert merges.count([word])[0] == counts[0] == len(symbols)


def test_count_column(edge, table):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = piece_counts.count_tokens(edge.withColumnRenamed("lang", "n_tokens"), MODEL).collect()
    assert len(rows) == 12
    assert all(r.n_tokens == len(model.encode(r.text or "")) for r in rows)
    assert piece_counts.count_tokens(table([]), MODEL).count() == 0


def test_queries(workers, small_dir, reference):
    from corpusflow.llm.queries import QUERIES

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r.doc_id: r.text for r in workers.read.parquet(f"{small_dir}/documents.parquet").collect()}
    for row in QUERIES["op7_byte_bpe"](workers, small_dir).collect():
        ids = reference.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
    for row in QUERIES["op10_piece_counts"](workers, small_dir).collect():
        assert row.n_tokens == len(model.encode(texts[row.doc_id]))
        assert row.n_bytes == len(texts[row.doc_id].encode()) and row.over_limit == (row.n_tokens > 4096)


def test_long_words_are_those_of_the_library():
    """Long sequences with few and many distinct pairs, several at once, and what can't merge."""
    draw = random.Random(8)
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    counter = piece_counts.TokenCounter(piece_counts.counter_of(MODEL).merges)
    some = ["".join(draw.choice(a) for _ in range(n)) for a in ("ab", "aeinrst", "abcdefghijklmnopqrstuvwxyz", "é漢th字😀") for n in (65, 130, 700, 5_000)]
    some += ["a" * n for n in (63, 64, 65, 66, 1_001, 4_096)] + ["ab" * 999, "aab" * 700, "thethe" * 300, "😀" * 300, "x😀" * 300]
    assert counter.count(some) == [len(model.encode(t)) for t in some]
    together = " ".join(some)
    assert counter.count([together]) == [len(model.encode(together))]


def test_both_ways_to_merge_agree(monkeypatch):
    """Ranks that don't follow the order of merges: merges that make lower pairs than their own."""
    draw = random.Random(9)
    for round_ in range(60):
        tokens = {c: 0.0 for c in "abc"}
        while len(tokens) < 14:
            tokens.setdefault(draw.choice(list(tokens)) + draw.choice(list(tokens)), -float(draw.randint(1, 9)))
        merges = piece_counts.PieceMerges(tokens)
        some = ["".join(draw.choice("abc") for _ in range(draw.randint(1, 90))) for _ in range(12)]
        monkeypatch.setattr(piece_counts, "SHORT_SYMBOLS", 10_000)
        expected = merges.count(some).tolist()
        monkeypatch.setattr(piece_counts, "SHORT_SYMBOLS", 0)
        assert merges.count(some).tolist() == expected


def test_long_words_take_no_longer_than_text():
    import time

    draw = random.Random(10)
    merges = piece_counts.counter_of(MODEL).merges
    letters = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(300_000))
    start = time.perf_counter()
    merges.count([letters[:200_000]])
    one = time.perf_counter() - start
    merges.count([letters[i : i + 300] for i in range(0, 300_000, 300)])
    many = time.perf_counter() - start - one
    assert one < 6 and many < 9  # seconds, on a machine that is doing something else as well


def test_a_long_pre_token_is_decoded_again(reference):
    encode = byte_bpe.encoder_of(RANKS, P.PATTERN)
    letters = "".join(random.Random(2).choice("abcdefghij") for _ in range(60_000))
    for text in (letters, "b" * 50_000, "漢字" * 20_000):
        ids = np.frombuffer(encode(text), np.int32)
        assert byte_bpe.tree_of(RANKS).decode(ids) == text.encode()
    assert np.frombuffer(encode(letters), np.int32).tolist() == reference.encode_ordinary(letters)


def test_the_pipeline_leaves_no_encoder_in_workers(workers, monkeypatch):
    """The same ids without what workers keep from task to task; the pipeline's stage does without."""
    import corpus_pipeline

    rows = list(enumerate(["", "plain words, plain words", "ünïcode 漢字 \n\n  x", None, "a" * 300]))
    docs = workers.createDataFrame(rows, "doc_id long, text string").repartition(2)
    kept = byte_bpe.decode(byte_bpe.encode(docs, RANKS, P.PATTERN), RANKS).collect()

    def unwanted(*_):
        raise AssertionError("kept beyond a task")

    monkeypatch.setattr(byte_bpe, "encoder_of", unwanted)
    monkeypatch.setattr(byte_bpe, "tree_of", unwanted)
    anew = byte_bpe.decode(byte_bpe.encode(docs, RANKS, P.PATTERN, remember=False), RANKS, remember=False).collect()
    assert sorted((r.doc_id, r.ids, bytes(r.bytes)) for r in anew) == sorted((r.doc_id, r.ids, bytes(r.bytes)) for r in kept)
    staged = {r.doc_id: r.ids for r in corpus_pipeline.encode_bytes(workers, docs, "").collect()}
    assert staged == {r.doc_id: r.ids for r in kept} and staged[1]
