"""Near-duplicate documents by BagMinHash, banding, and exact overlap of shingle multisets.

A document is the multiset of its word shingles. Every shingle carries Poisson processes of points
in time, one for each range of a dyadic hierarchy of weights: (0, 1], (1, 2], (2, 4], and so on. A
point also has a component of the signature and a weight level within its range; it counts if the
level is not above the shingle's count. A component of the signature is the time of its first
point. Points depend on the shingle alone, so two documents agree in a component with the
probability of their weighted Jaccard similarity. Points are made in order of time, and a process
ends once it has passed the latest component of its document.

Documents with equal words are one node. Nodes that agree in a band meet in a bucket. First each
node is compared with the node of its bucket that meets most others, which links most of a group
of near copies at once. In buckets that still hold several classes, all pairs of different classes
are judged by their signatures, in tiles of bounded size; pairs that agree far too little for the
similarity asked for (fewer equal components than chance gives in one of ten million) are dropped.
Nothing is written per pair: a node gets one list of partners for each cell, a bounded set of nodes
around the same centre. Then cells and their visitors meet, and the multisets themselves are
compared. No pair of different classes is left out. Groups, cells and visitors are bounded by the
bytes of their texts as well as by their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import bloom
from corpusflow.llm.components import components, relabelled, staged
from corpusflow.llm.runtime import slices
from corpusflow.llm.wordhash import Words, mix, ngrams, read_words, seeded
from corpusflow.sources.scratch import stage

SHINGLE = 5
SIMILARITY = 0.8
COMPONENTS = 160
BAND_ROWS = 4
#: Chance that the signatures of a pair at the similarity asked for agree too little to be compared.
SCREEN_MISS = 1e-7
BLOCK_BYTES = 1 << 19
GROUP_NODES = 64
#: Nodes of a tile's side, and of a cell and its visitors, at most (about, for cells).
TILE_NODES = 1024
CELL_NODES = 256
#: Bytes of texts in a group, a cell or its visitors (about; one text may be longer).
GROUP_BYTES = 4 << 20
HUB_JUMPS = 3


def shingles(words: Words, texts: int, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles: text number, hash, count. A text of fewer words is one shingle."""
    counts = np.bincount(words.owner, minlength=texts)
    groups = [ngrams(words.hashes, words.owner, tuple(range(size)), 300)]
    for n in range(1, size):
        hashes, owner = ngrams(words.hashes, words.owner, tuple(range(n)), 300 + n)
        whole = counts[owner] == n
        groups.append((hashes[whole], owner[whole]))
    hashes, owner = (np.concatenate(x) for x in zip(*groups))
    _, first, count = np.unique(mix(hashes + seeded(7) * owner.astype(np.uint64)), return_index=True, return_counts=True)
    order = np.argsort(owner[first], kind="stable")
    return owner[first][order], hashes[first][order], count[order]


def signatures(owner: np.ndarray, hashes: np.ndarray, counts: np.ndarray, texts: int, size: int = COMPONENTS) -> np.ndarray:
    """BagMinHash of each text: times, float64 (texts, size). Texts without shingles: infinity."""
    times = np.full((texts, size), np.inf)
    flat = times.reshape(-1)
    # One process for each range (low, high] of weights that begins below the shingle's count.
    who, key, low, width, count = [owner], [hashes], [np.zeros(len(owner))], [np.ones(len(owner))], [counts]
    level = 1
    while (more := counts > level).any():
        who.append(owner[more])
        key.append(mix(hashes[more] + seeded(400 + level.bit_length())))
        low.append(np.full(more.sum(), level, float))
        width.append(np.full(more.sum(), level, float))
        count.append(counts[more])
        level *= 2
    who, key, low, width, count = (np.concatenate(x) for x in (who, key, low, width, count))
    time, step = np.zeros(len(who)), 0
    while len(who):
        step += 1
        draw = mix(key + mix(np.array([step], np.uint64)))
        time = time - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / width
        draw = mix(draw)
        part = (draw % np.uint64(size)).astype(np.int64)
        height = low + 1 + np.floor((draw >> np.uint64(20)).astype(float) * 2.0**-44 * width)
        here = height <= count
        np.minimum.at(flat, who[here] * size + part[here], time[here])
        going = time < times.max(axis=1)[who]
        who, key, low, width, count, time = (x[going] for x in (who, key, low, width, count, time))
    return times


def bands(times: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """One hash per band of `rows` components: int64 (texts, bands)."""
    bits = times.view(np.uint64).reshape(len(times), -1, rows)
    total = np.zeros(bits.shape[:2], np.uint64)
    for i in range(rows):
        total = mix(total + bits[:, :, i] * seeded(600 + i))
    return mix(total + np.arange(bits.shape[1], dtype=np.uint64) * seeded(9)).view(np.int64)


def sketches(times: np.ndarray) -> np.ndarray:
    """One byte per component: enough to estimate how many components two texts share."""
    return mix(times.view(np.uint64)).astype(np.uint8)


def least_agreement(similarity: float) -> float:
    """Share of equal components that a pair of this similarity falls below with a chance of
    SCREEN_MISS at most. Their number is binomial."""
    chance = 0.0
    for equal in range(COMPONENTS):
        chance += comb(COMPONENTS, equal) * similarity**equal * (1 - similarity) ** (COMPONENTS - equal)
        if chance > SCREEN_MISS:
            return equal / COMPONENTS
    return 1.0


def content_keys(words: Words, texts: list[bytes]) -> np.ndarray:
    """128 bits of each text's words in order, or of its bytes if it has no word: uint64 (2, n)."""
    begin = np.searchsorted(words.owner, np.arange(len(texts)))
    place = (np.arange(len(words.owner)) - begin[words.owner]).astype(np.uint64)
    out = np.zeros((2, len(texts)), np.uint64)
    for i in (0, 1):
        np.add.at(out[i], words.owner, mix(words.hashes + mix(place + seeded(700 + i))))
    none = np.flatnonzero(np.bincount(words.owner, minlength=len(texts)) == 0)
    if len(none):
        import xxhash

        for t in none:
            digest = xxhash.xxh3_128_intdigest(texts[t], seed=1)
            out[:, t] = digest >> 64, digest & (2**64 - 1)
    return out


SIGNED = "id bigint, size bigint, k1 bigint, k2 bigint, wordless boolean, bands array<bigint>, sketch binary"


def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), [t.encode("utf-8") for t in batch.column(1).to_pylist()]
        for a, b in slices([len(t) for t in texts], BLOCK_BYTES):
            words = read_words(texts[a:b])
            keys = content_keys(words, texts[a:b]).view(np.int64)
            times = signatures(*shingles(words, b - a), b - a)
            found, small = bands(times), sketches(times)
            wordless = np.bincount(words.owner, minlength=b - a) == 0
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(b - a + 1) * found.shape[1], pa.int32()), pa.array(found.reshape(-1))
            )
            yield pa.RecordBatch.from_arrays(
                [ids[a:b], pa.array([len(t) for t in texts[a:b]], pa.int64()), pa.array(keys[0]), pa.array(keys[1]), pa.array(wordless), lists,
                 pa.array([row.tobytes() for row in small], pa.binary())],
                ["id", "size", "k1", "k2", "wordless", "bands", "sketch"],
            )


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two multisets (ascending hashes, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = int(np.minimum(a[1][i], b[1][j]).sum())
    return least / max(1, int(a[1].sum() + b[1].sum()) - least)


def multisets(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    data = [t.encode("utf-8") for t in texts]
    out = []
    for a, b in slices([len(t) for t in data], BLOCK_BYTES):
        owner, hashes, counts = shingles(read_words(data[a:b]), b - a)
        for t in range(b - a):
            mine = slice(*np.searchsorted(owner, [t, t + 1]))
            order = np.argsort(hashes[mine])
            out.append((hashes[mine][order], counts[mine][order]))
    return out


LINK = "a bigint, b bigint"


def link_table(found: list[tuple[int, int]]) -> pa.Table:
    a, b = zip(*found) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def verifier(similarity: float):
    """Of one group: its centre's text against the texts of some nodes; yields links."""

    def verify(table: pa.Table) -> pa.Table:
        centre = table.column("centre")[0].as_py()
        ids = table.column("id").to_pylist()
        sets = dict(zip(ids, multisets(table.column("t").to_pylist())))
        middle = sets.get(centre)
        return link_table([(centre, i) for i in sets if i != centre and middle and overlap(middle, sets[i]) >= similarity])

    return verify


def cell_verifier(similarity: float):
    """Of one cell and some visitors: each visitor against its partners; yields links."""

    def verify(table: pa.Table) -> pa.Table:
        ids, lists = table.column("id").to_pylist(), table.column("partners").to_pylist()
        sets = dict(zip(ids, multisets(table.column("t").to_pylist())))
        pairs = {(i, j) for i, partners in zip(ids, lists) for j in partners or () if j in sets}
        return link_table([(i, j) for i, j in pairs if overlap(sets[i], sets[j]) >= similarity])

    return verify


def tile_judge(least: float):
    """Of one tile of a bucket: pairs of different classes whose signatures agree enough, as
    lists of partners. A pair is judged in the first bucket it shares."""

    def judge(table: pa.Table) -> pa.Table:
        number = lambda c: table.column(c).to_numpy()
        ids, label, side, hub, chunk = map(number, ("id", "label", "side", "hub", "chunk"))
        bucket = table.column("bucket")[0].as_py()
        sketch = np.stack([np.frombuffer(x, np.uint8) for x in table.column("sketch").to_pylist()])
        band = np.stack(table.column("bands").combine_chunks().to_numpy(zero_copy_only=False))
        whole = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        lists: dict[tuple[int, int, int], list[int]] = {}
        for p in range(len(ids) - 1):
            later = np.flatnonzero(label[p + 1 :] != label[p]) + p + 1
            if not whole:
                later = later[side[later] != side[p]]
            later = later[(sketch[later] == sketch[p]).mean(axis=1) >= least]
            if len(later):
                shared = band[later] == band[p]
                later = later[band[p][shared.argmax(axis=1)] == bucket]
            for q in later.tolist():
                lists.setdefault((int(ids[p]), int(hub[q]), int(chunk[q])), []).append(int(ids[q]))
        keys = list(zip(*lists)) or [(), (), ()]
        return pa.table({
            "id": pa.array(keys[0], pa.int64()), "hub": pa.array(keys[1], pa.int64()),
            "chunk": pa.array(keys[2], pa.int32()), "partners": pa.array(list(lists.values()), pa.list_(pa.int64())),
        })

    return judge


def links(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (centre, id, size) whose texts (id, t) overlap enough, as (a, b).

    A centre with many partners is dealt out: its text goes to every group of about 64 of them. A
    Bloom filter keeps texts without a pair out of the shuffle.
    """
    sizes = pairs.groupBy("centre").agg(parts_of(GROUP_NODES).alias("parts"))
    salted = pairs.join(sizes, "centre").select("centre", dealt("parts").alias("salt"), "id")
    heads = salted.select("centre", "salt", F.col("centre").alias("id")).distinct()
    needed = stage(salted.unionByName(heads), "comparisons")
    rows = with_texts(needed, texts).select("centre", "salt", "id", "t")
    return rows.groupBy("centre", "salt").applyInArrow(verifier(similarity), LINK)


def with_texts(needed: DataFrame, texts: DataFrame) -> DataFrame:
    bitmap = bloom.build(needed.select("id").distinct(), "id")
    return needed.join(texts.filter(bloom.may_hold(bitmap, F.col("id"))), "id")


def parts_of(most: int) -> Column:
    """Parts that a group of rows with a size is cut into: of about `most` rows and GROUP_BYTES."""
    return F.greatest(F.ceil(F.count("*") / most), F.ceil(F.sum("size") / GROUP_BYTES)).cast("int")


def dealt(parts: str, *more: Column) -> Column:
    """The part that a node goes to."""
    return F.pmod(F.xxhash64("id", *more), F.col(parts)).cast("int")


def cell_links(members: DataFrame, hubs: DataFrame, sketched: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between nodes of different labels that share a bucket.

    members: (bucket, id, label); hubs: (id, hub, size), hub being the centre that a node was
    compared with.
    """
    sized = hubs.groupBy("hub").agg(parts_of(CELL_NODES).alias("parts"))
    placed = stage(hubs.join(sized, "hub").select("id", "hub", "size", dealt("parts").alias("chunk")), "cells")
    tiles = members.groupBy("bucket").agg(F.ceil(F.count("*") / TILE_NODES).cast("int").alias("k"))
    # Some cells of a hub lie in one part, so that a node meets a cell in one tile of a bucket only.
    some = F.floor(F.col("chunk") / (TILE_NODES // CELL_NODES))
    part = F.pmod(F.xxhash64("hub", some, F.lit("tile")), F.col("k")).cast("int").alias("part")
    rows = members.join(stage(tiles, "tiles"), "bucket").join(placed.drop("size"), "id").select(
        "bucket", "id", "label", "hub", "chunk", part, F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other")
    )
    rows = rows.join(sketched, "id").select(
        "bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
        (F.col("part") > F.col("other")).alias("side"), "id", "label", "hub", "chunk", "sketch", "bands",
    )
    found = rows.groupBy("bucket", "i", "j").applyInArrow(
        tile_judge(least_agreement(similarity)), "id bigint, hub bigint, chunk int, partners array<bigint>"
    )
    # A node's partners in a cell, at most the cell's nodes, from all tiles and buckets.
    found = found.groupBy("hub", "chunk", "id").agg(F.flatten(F.collect_list("partners")).alias("partners"))
    visits = stage(found.join(placed.select("id", "size"), "id"), "visits")
    crowd = visits.groupBy("hub", "chunk").agg(parts_of(CELL_NODES).alias("groups"))
    crowd = stage(crowd, "crowds")
    visitors = visits.join(crowd, ["hub", "chunk"]).select(
        "hub", "chunk", dealt("groups", F.lit("visit")).alias("salt"), "id", "partners"
    )
    residents = placed.join(crowd, ["hub", "chunk"]).select(
        "hub", "chunk", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("salt"), "id",
        F.lit(None).cast("array<bigint>").alias("partners"),
    )
    needed = stage(visitors.unionByName(residents), "comparisons")
    met = with_texts(needed, texts).select("hub", "chunk", "salt", "id", "partners", "t")
    return met.groupBy("hub", "chunk", "salt").applyInArrow(cell_verifier(similarity), LINK)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """One row for each key and text: key (bigint), class_id (bigint), wordless, kept (boolean),
    digest and class_digest (string).

    Two documents are linked if the weighted Jaccard similarity of their multisets of five-word
    shingles is at least `similarity`; classes are the connected components. Documents with the
    same words are always of one class; documents without a word are so if their texts are equal.
    A null text is a class of its own. A pair at the threshold is missed with probability 1e-7 at
    most: 7e-10 by 40 bands of 4 components, the rest by the comparison of 160.

    One row of each class is `kept`: that with the smallest key, of several such rows, or without
    any key, that with the smallest digest. A class is named by that row: its key is the class_id,
    its digest the class_digest. `digest`, the SHA-256 of the text, is there where the key alone
    doesn't name the text: with null keys, and keys that several texts have. Rows alike in key and
    text give one row. Further columns are not read.
    """
    named = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("t"))
    texts = named.filter("id is not null and t is not null")
    every = stage(texts.mapInArrow(signed, SIGNED), "signatures")
    several = every.groupBy("id").agg(F.min("k1").alias("x"), F.max("k1").alias("y")).filter("x <> y").select("id")
    several = stage(several, "several-texts")
    nameless = named.filter("id is null and t is not null")
    if several.isEmpty() and nameless.isEmpty():
        found = _found(every, texts, similarity)
        kept = (F.col("id") == F.col("node")).alias("kept")
        found = found.select("id", F.col("node").alias("class_id"), "wordless", kept, _none("digest"), _none("class_digest"))
    else:
        found = _found_by_content(named, every, texts, several, nameless, similarity)
    alone = named.filter("t is null").distinct().select(
        "id", F.col("id").alias("class_id"), F.lit(True).alias("wordless"), F.lit(True).alias("kept"), _none("digest"), _none("class_digest")
    )
    return found.unionByName(alone).withColumnRenamed("id", key)


def _none(name: str) -> Column:
    return F.lit(None).cast("string").alias(name)


def _found_by_content(
    named: DataFrame, every: DataFrame, texts: DataFrame, several: DataFrame, nameless: DataFrame, similarity: float
) -> DataFrame:
    """The same where some keys don't name a text: each text of theirs gets a number as its key,
    beyond all keys there are."""
    odd = texts.join(several, "id", "left_semi").unionByName(nameless).distinct()
    odd = odd.withColumn("digest", F.sha2("t", 256))
    low, high = named.agg(F.min("id"), F.max("id")).first()
    number = F.monotonically_increasing_id()
    if high is None or high < (1 << 62):
        number = number + F.lit((high or 0) + 1)
    elif low > -(1 << 62):
        number = F.lit(low - 1) - number
    else:
        raise ValueError("no keys are left to number texts with")
    odd = stage(odd.withColumn("number", number), "odd-texts")
    numbered = odd.select(F.col("number").alias("id"), "t")
    clear = every.join(several, "id", "left_anti")
    signed_all = stage(clear.unionByName(numbered.mapInArrow(signed, SIGNED)), "signatures")
    texts_all = texts.join(several, "id", "left_anti").unionByName(numbered)
    found = _found(signed_all, texts_all, similarity).join(
        odd.select(F.col("number").alias("id"), F.col("id").alias("own"), "digest"), "id", "left"
    )
    own = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("own"))
    found = stage(found.select(own.alias("id"), "node", "wordless", "digest"), "members")
    first = F.struct(F.col("id").isNull().alias("a"), F.col("id").alias("b"), F.coalesce("digest", F.lit("")).alias("c"))
    names = found.groupBy("node").agg(F.min(first).alias("first"))
    return found.withColumn("rank", first).join(names, "node").select(
        "id", F.col("first.b").alias("class_id"), "wordless", (F.col("rank") == F.col("first")).alias("kept"), "digest",
        F.nullif(F.col("first.c"), F.lit("")).alias("class_digest"),
    )


def _found(every: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(id, node, wordless) of texts whose ids name them: node is the smallest id of the class."""
    clear = every.select("id", "k1", "k2", "wordless").distinct()
    groups = stage(
        clear.groupBy("k1", "k2").agg(F.min("id").alias("node"), F.max("wordless").alias("wordless")), "nodes"
    )
    worded = groups.filter(~F.col("wordless")).select(F.col("node").alias("id"))
    nodes = every.filter(~F.col("wordless")).join(worded, "id", "left_semi")
    buckets = nodes.select("id", F.explode(F.array_distinct("bands")).alias("bucket")).distinct()
    names = classes(stage(buckets, "buckets"), every.select("id", "size", "sketch", "bands"), texts, similarity)
    member = clear.join(groups.select("k1", "k2", "node"), ["k1", "k2"]).select("id", "node", "wordless")
    return relabelled(member, "node", names) if names is not None else member


def classes(buckets: DataFrame, sketched: DataFrame, texts: DataFrame, similarity: float) -> DataFrame | None:
    """(node, root) of the nodes (id, bucket) that aren't the smallest of their class."""
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = stage(buckets.join(stage(shared, "shared-buckets"), "bucket"), "members")
    scores = stage(members.groupBy("id").agg(F.sum("n").alias("score")), "scores")
    members, left = staged(members.join(scores, "id").select("bucket", "id", "score"), "members")
    if not left:
        return None
    heads = stage(members.groupBy("bucket").agg(F.max(F.struct("score", "id")).alias("centre")), "centres")
    met = members.join(heads, "bucket").filter(F.col("id") != F.col("centre.id"))
    pairs = stage(met.select("id", "centre").distinct(), "pairs")
    sizes = sketched.select("id", "size").distinct()
    sized = pairs.join(sizes, "id").select(F.col("centre.id").alias("centre"), "id", "size")
    names = components(links(sized, texts, similarity))
    rest = relabelled(members.select("bucket", "id", F.col("id").alias("label")), "label", names)
    mixed = rest.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y")
    rest, left = staged(rest.join(stage(mixed.select("bucket"), "mixed-buckets"), "bucket"), "members")
    if not left:
        return names
    live = stage(rest.select("id").distinct(), "live-nodes")
    compared = pairs.groupBy("id").agg(F.max("centre").alias("c")).select("id", F.col("c.id").alias("hub"))
    # A centre was compared with another one, up to the node that meets most: one hub for a group.
    compared = stage(compared, "compared")
    above = compared.select(F.col("id").alias("node"), F.col("hub").alias("root"))
    for _ in range(HUB_JUMPS):
        compared = relabelled(compared, "hub", above)
    hubs = live.join(compared, "id", "left").join(sizes, "id").select("id", F.coalesce("hub", "id").alias("hub"), "size")
    sketched = stage(sketched.drop("size").join(live, "id", "left_semi").dropDuplicates(["id"]), "sketches")
    found = cell_links(rest, stage(hubs, "hubs"), sketched, texts, similarity)
    more = components(relabelled(relabelled(found, "a", names), "b", names))
    return stage(relabelled(names, "root", more).unionByName(more), "names")
