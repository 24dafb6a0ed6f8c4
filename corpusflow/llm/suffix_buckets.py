"""Repeated substrings by bucket-pointer refinement of suffixes.

A suffix's bucket is the group of suffixes that begin alike. Buckets for longer beginnings come
from those for shorter ones: two suffixes of one bucket for d bytes stay together for d + k bytes
if the suffixes d bytes later share a bucket for k bytes. So 5 bytes refine to 10, 20, 25, 50, 100
and 200, each step using the identifiers of the step before. Identifiers are made from the content
(64 bits each), so equal buckets of different documents have equal identifiers and nothing has to
be numbered globally.

Sorting all suffixes of a corpus would move many times its size. These steps settle almost all of
them first, and lose nothing:

1. Each run of 200 bytes is filed under its anchor: the suffix in it whose 50-byte bucket has the
   smallest identifier (the last of equal ones). Equal runs have equal anchors at equal offsets.
   An anchor whose 50-byte bucket has no other member settles all its runs: they aren't repeated.
2. The runs filed under one anchor are consecutive. Together they are a block, identified by the
   200-byte buckets of its first and last suffix. Equal blocks settle all their runs: repeated.
3. Where an anchor's bucket holds different blocks, one copy of each is opened into cells of up to
   32 runs, cut at fixed offsets from the anchor. All runs of a cell share a core of 169 bytes. A
   core that no other cell has settles its runs, and so do equal cells.
4. Where a core is shared by different cells, one copy of each is opened into its suffixes, which
   are grouped by their 200-byte buckets, the pair of 100-byte identifiers 100 apart.

Only a text's own bytes are looked at in a task; matches never cross documents. Equality is that of
identifiers, of 128 bits where runs, blocks and cells are told apart: of n different ones two are
taken for one with a probability below n^2 / 2^129, and then a run too many is removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm import bloom
from corpusflow.llm.runtime import is_small, packed, slices, unpacked
from corpusflow.llm.wordhash import mix, seeded
from corpusflow.sources.scratch import stage

LENGTH = 200
HALF = 100
GRAM = 50
CELL = 32
CORE = LENGTH - CELL + 1
BLOCK_BYTES = 1 << 18
NO_KEY = -(1 << 62)


def refine(names: np.ndarray, later: np.ndarray, offset: int, seed: int) -> np.ndarray:
    """Identifiers for longer beginnings: each with the one `offset` bytes later."""
    n = min(len(names), len(later) - offset)
    return names[:n] * seeded(seed) + later[offset : offset + n] * seeded(seed + 1)


def buckets(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers of the 50-byte and 100-byte buckets of all suffixes long enough."""
    if len(data) < HALF:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    base = data.astype(np.uint64) + np.uint64(1)
    n = len(base) - 4
    five = base[:n] * seeded(800)
    for t in range(1, 5):
        five += base[t : t + n] * seeded(800 + t)
    ten = refine(five, five, 5, 810)
    twenty = refine(ten, ten, 10, 812)
    names = mix(refine(twenty, five, 20, 814))
    gram = mix(refine(names, names, 25, 816))
    return gram, mix(refine(gram, gram, 50, 818))


#: Values are compared by their upper 40 bits; the lower ones give way to the place.
PLACE_BITS = 24


def sliding_last_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest value (the last of equal ones) of each `width` values in a row.

    Values count by their upper 40 bits, however many there are, so equal runs have their minimum
    at the same offset wherever they lie.
    """
    most = 1 << PLACE_BITS
    if len(values) > most:
        step = most - width + 1
        parts = range(0, len(values) - width + 1, step)
        return np.concatenate([a + sliding_last_minimum(values[a : a + most], width) for a in parts])
    mask = np.uint64(most - 1)
    n = len(values)
    rows = -(-n // width)
    packed = np.full(rows * width, np.iinfo(np.uint64).max)
    packed[:n] = (values & ~mask) | (mask - np.arange(n, dtype=np.uint64))
    table = packed.reshape(rows, width)
    upto = np.minimum.accumulate(table, axis=1).reshape(-1)
    onward = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    last = n - width + 1
    return (mask - (np.minimum(onward[:last], upto[width - 1 : width - 1 + last]) & mask)).astype(np.int64)


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each anchor: text number, 50-byte bucket, two block identifiers, its place, and the
    first and last start of the runs filed under it, counted from the beginning of the text."""
    sizes = np.diff(bounds)
    runs = np.maximum(sizes - LENGTH + 1, 0)
    if not runs.any():
        return tuple(np.zeros(0, np.int64) for _ in range(7))
    gram, half = buckets(data)
    owner = np.repeat(np.arange(len(sizes)), runs)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs) + bounds[owner]
    place = sliding_last_minimum(gram, LENGTH - GRAM + 1)[start]
    new = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])))
    first, last = start[new], start[np.append(new[1:], len(start)) - 1]
    owner, place = owner[new], place[new]
    base = bounds[owner]
    b1, b2 = block_names(half, first, last, place)
    return owner, gram[place], b1, b2, place - base, first - base, last - base


def block_names(half: np.ndarray, first: np.ndarray, last: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers of consecutive runs: the buckets of the first and the last, and where they lie."""

    def name(p: np.ndarray, extra: np.ndarray, seed: int) -> np.ndarray:
        return mix(half[p] * seeded(seed) + half[p + HALF] * seeded(seed + 1) + extra.astype(np.uint64)).view(np.int64)

    return name(first, place - first, 820), name(last, last - first, 822)


def text_blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Parts of a string column without nulls: rows a to b, their bytes, the bounds of each text."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    for a, b in slices(np.diff(offsets).tolist(), BLOCK_BYTES):
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


UNIT = "d bigint, t bigint, g bigint, b1 bigint, b2 bigint, x int, s int, e int, w int"
NAMES = ["d", "t", "g", "b1", "b2", "x", "s", "e", "w"]


def batch_of(d: np.ndarray, t: np.ndarray, names: list[np.ndarray], places: list[np.ndarray]) -> pa.RecordBatch:
    columns = [d, t, *names, *(x.astype(np.int32) for x in places)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], NAMES)


def anchor_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The 50-byte buckets of all anchors, with how many anchors each batch has of them."""
    for batch in batches:
        found = [anchors(data, bounds)[1] for _, _, data, bounds in text_blocks(batch.column(0))]
        grams, number = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(number)], ["g", "n"])


def shared_anchors(bitmap: np.ndarray):
    """The blocks of the anchors whose 50-byte bucket may have another member."""

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, t = (batch.column(i).to_numpy() for i in (0, 1))
            for a, b, data, bounds in text_blocks(batch.column(2)):
                found = anchors(data, bounds)
                some = bloom.held_hashes(bitmap, found[1].view(np.uint64))
                owner, g, b1, b2, x, s, e = (c[some] for c in found)
                yield batch_of(d[a:b][owner], t[a:b][owner], [g.view(np.int64), b1, b2], [x, s, e, np.ones(len(x))])

    return file


def opened_parts(lists: pa.Array, i: int) -> tuple[np.ndarray, ...]:
    inside = lists[i].values
    return tuple(inside.field(f).to_numpy().astype(np.int64) for f in ("x", "s", "e", "w"))


def spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first, first + 1, … for each size, one after another."""
    return np.arange(sizes.sum()) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)


def open_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of the opened blocks, grouped by their cores."""
    for batch in batches:
        d, t = (batch.column(i).to_numpy() for i in (0, 1))
        for a, b, data, bounds in text_blocks(batch.column(2)):
            _, half = buckets(data)
            for i in range(a, b):
                x, s, e, w = opened_parts(batch.column(3), i)
                low = (x - e) // CELL
                number = (x - s) // CELL - low + 1
                cell = spread(low, number)
                x, s, e, w = (np.repeat(c, number) for c in (x, s, e, w))
                first, last = np.maximum(s, x - cell * CELL - CELL + 1), np.minimum(e, x - cell * CELL)
                base = bounds[i - a]
                core = base + x - cell * CELL
                g = mix(half[core] * seeded(830) + half[core + CORE - HALF] * seeded(831) + cell.astype(np.uint64))
                b1, b2 = block_names(half, base + first, base + last, base + x)
                yield batch_of(np.full(len(x), d[i]), np.full(len(x), t[i]), [g.view(np.int64), b1, b2], [x, first, last, w])


RUN = "d bigint, t bigint, p int, w int, k1 bigint, k2 bigint"


def open_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All runs of the opened cells, with their 200-byte buckets."""
    for batch in batches:
        d, t = (batch.column(i).to_numpy() for i in (0, 1))
        for a, b, data, bounds in text_blocks(batch.column(2)):
            _, half = buckets(data)
            for i in range(a, b):
                _, s, e, w = opened_parts(batch.column(3), i)
                at = spread(s, e - s + 1)
                here = bounds[i - a] + at
                columns = [
                    np.full(len(at), d[i]), np.full(len(at), t[i]), at.astype(np.int32),
                    np.repeat(w, e - s + 1).astype(np.int32), half[here].view(np.int64), half[here + HALF].view(np.int64),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["d", "t", "p", "w", "k1", "k2"])


def settle(units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans (d, t, s, e) of units that have an equal, and what has to be opened, by text.

    A unit of weight 2 stands for two or more; only units of weight 1 give spans. Of a group that
    holds a unit without an equal and others, one of each kind is opened.
    """
    kinds = units.groupBy("g", "b1", "b2").agg(F.sum("w").alias("n"), F.min(F.struct("d", "t", "x", "s", "e")).alias("one"))
    kinds = stage(kinds, "kinds")
    again = kinds.filter("n > 1").select("g", "b1", "b2")
    whole = units.filter("w = 1").join(again, ["g", "b1", "b2"], "left_semi")
    mixed = kinds.groupBy("g").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
    mixed = stage(mixed.filter("kinds > 1 and least = 1").select("g"), "mixed")
    weight = F.least(F.col("n"), F.lit(2)).cast("int").alias("w")
    opened = kinds.join(mixed, "g", "left_semi").groupBy("one.d", "one.t").agg(
        F.collect_list(F.struct("one.x", "one.s", "one.e", weight)).alias("parts")
    )
    return whole.select("d", "t", "s", (F.col("e") + LENGTH).alias("e")), stage(opened, "opened")


def with_parts(source: DataFrame, opened: DataFrame) -> DataFrame:
    """(d, t, x, parts): the texts that hold something to open. A small table of parts goes to the
    texts; otherwise texts are shuffled, most of those without parts left out."""
    texts = source.select(F.col("_d").alias("d"), F.col("_t").alias("t"), F.col("_x").alias("x"))
    if is_small(opened):
        return texts.join(F.broadcast(opened), ["d", "t"]).select("d", "t", "x", "parts")
    texts = texts.filter(bloom.may_hold(bloom.build(opened, "t"), F.col("t")))
    return texts.join(opened, ["d", "t"]).select("d", "t", "x", "parts")


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """All columns, with the key, a hash of the text and the text without nulls."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns(
        {"_d": F.coalesce(F.col(key).cast("bigint"), F.lit(NO_KEY)), "_t": F.xxhash64(body), "_x": body}
    )


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(d, t, spans): bytes s to e - 1 of the text with key d (null: NO_KEY) and hash t are covered
    by runs of 200 bytes that also begin elsewhere, in the same text or another. Rows alike in key
    and text share their spans, which are maximal. What is gathered for a text is its own.
    """
    source = _keyed(docs, key, text)
    long = source.filter(F.octet_length("_x") >= LENGTH)
    grams = long.select("_x").mapInArrow(anchor_grams, "g bigint, n bigint")
    shared = stage(grams.groupBy("g").agg(F.sum("n").alias("n")).filter("n > 1").select("g"), "shared-grams")
    # What passes the filter by chance is alone in its bucket: it has no equal and is not opened.
    bitmap = bloom.from_hashes(shared, "g")
    blocks = stage(long.select("_d", "_t", "_x").mapInArrow(shared_anchors(bitmap), UNIT), "blocks")
    whole, opened = settle(blocks)
    cells = stage(with_parts(source, opened).mapInArrow(open_blocks, UNIT), "cells")
    more, opened = settle(cells)
    runs = stage(with_parts(source, opened).mapInArrow(open_cells, RUN), "runs")
    twice = runs.groupBy("k1", "k2").agg(F.sum("w").alias("n")).filter("n > 1").select("k1", "k2")
    partly = runs.filter("w = 1").join(stage(twice, "repeated-runs"), ["k1", "k2"])
    partly = partly.select("d", "t", F.col("p").alias("s"), (F.col("p") + LENGTH).alias("e"))
    every = whole.unionByName(more).unionByName(partly).groupBy("d", "t").agg(F.collect_set(F.struct("s", "e")).alias("all"))
    return every.select("d", "t", F.arrow_udf(merged, "array<struct<s:int,e:int>>")("all").alias("spans"))


def merged(lists: pa.Array) -> pa.Array:
    """Spans joined where they overlap or touch, in order."""
    starts, ends, sizes = [], [], [0]
    for spans in lists:
        s, e = (spans.values.field(f).to_numpy() for f in ("s", "e"))
        order = np.argsort(s, kind="stable")
        s, e = s[order], np.maximum.accumulate(e[order])
        new = np.flatnonzero(np.append(True, s[1:] > e[:-1]))
        starts.append(s[new])
        ends.append(e[np.append(new[1:], len(s)) - 1])
        sizes.append(len(new))
    parts = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int32), pa.int32()) for c in (starts, ends)]
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.StructArray.from_arrays(parts, ["s", "e"]))


NEW = ("kept", "kept_text", "n_removed", "n_spans")


def cutter(kept: list[str]):
    """Adds the bytes outside the spans, the characters wholly outside, how many bytes are gone,
    and how many runs of them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(len(kept)), batch.column(len(kept) + 1)
            out: list[bytes] = []
            whole: list[bytes] = []
            gone, runs = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            for i in range(len(texts)):
                data = texts[i].as_buffer()
                if spans[i].is_valid:
                    covered = np.zeros(len(data) + 1, np.int64)
                    inside = spans[i].values
                    np.add.at(covered, inside.field("s").to_numpy(), 1)
                    np.add.at(covered, inside.field("e").to_numpy(), -1)
                    hit = np.cumsum(covered)[:-1] > 0
                    gone[i], runs[i] = hit.sum(), np.count_nonzero(np.diff(hit.astype(np.int8), prepend=0) == 1)
                    raw = np.frombuffer(data, np.uint8)
                    out.append(raw[~hit].tobytes())
                    begins = np.flatnonzero((raw & 0xC0) != 0x80)
                    broken = np.maximum.reduceat(hit, begins) if len(raw) else hit
                    whole.append(raw[~np.repeat(broken, np.diff(np.append(begins, len(raw))))].tobytes())
                else:
                    out.append(data.to_pybytes())
                    whole.append(out[-1])
            columns = [batch.column(i) for i in range(len(kept))]
            columns += [pa.array(out, pa.binary()), pa.array(whole, pa.binary()).cast(pa.string())]
            columns += [pa.array(gone), pa.array(runs)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *NEW])

    return cut


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns, with kept (binary), kept_text (string: without characters cut in two),
    n_removed and n_spans (bigint, maximal removed runs).

    Every byte covered by a run of 200 bytes that also begins elsewhere is removed, from all its
    places; runs are judged on the input. Null and empty texts keep nothing. Columns that have the
    names of the new ones are replaced; all others pass through, whatever their names. A small table of spans goes to the texts. Otherwise texts
    that hold no repeat, by a Bloom filter of fixed size, stay where they are, and the others are
    shuffled to their spans.
    """
    columns = docs.drop(*NEW)
    whole = packed(columns.withColumn(" key", F.col(key)), text, " key")
    spans = stage(repeated_spans(whole, " key", text), "spans")
    source, shown = _keyed(whole, " key", text), ["given", text]
    lists = spans.select(F.col("d").alias("_d"), F.col("t").alias("_t"), F.col("spans").alias("_spans"))
    if is_small(spans):
        found = source.join(F.broadcast(lists), ["_d", "_t"], "left").select(*shown, "_x", "_spans")
    else:
        source = source.withColumn("_m", bloom.may_hold(bloom.build(spans, "t"), F.col("_t")))
        none = F.lit(None).cast("array<struct<s:int,e:int>>").alias("_spans")
        found = source.filter(~F.col("_m")).select(*shown, "_x", none)
        found = found.unionByName(source.filter("_m").join(lists, ["_d", "_t"], "left").select(*shown, "_x", "_spans"))
    schema = whole.select(*shown).schema
    for name, kind in zip(NEW, (T.BinaryType(), T.StringType(), T.LongType(), T.LongType())):
        schema = schema.add(name, kind)
    made = found.mapInArrow(cutter(shown), schema)
    return made.select(*unpacked(made.select(*shown), columns), *NEW)
