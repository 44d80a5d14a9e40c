"""N-gram Jaccard join: sets of word shingles linked at a Jaccard similarity, with set relations.

1. Equal sets are one class. Shingles get a total order, rare first: a table of ``SLOTS`` counters
   counts all shingles of all texts and gives each a level; the order is level, then hash.
2. A set that can link with another shares a shingle of its prefix with it. Index lists hold a
   shingle's sets with size and position. Lists are cut by bands of size, and every set is compared
   with the first of its list and band (a star, never all pairs). Links found unite sets.
3. Only lists with other pairs that may link by size and position, and with sets of several
   components, are read again, sorted by position in
   blocks; block pairs that no link fits by size, position or component are skipped whole. The first
   rounds ask the few pairs of smallest hash of each component only, so components that many
   links join become one before all pairs that are left are asked in the last round. Lists whose
   pairs are no more than that ask all; the round after which no list has kept one back is the last.
4. The answers of a star's centre are computed first; bounds from the overlap with the centre
   decide most pairs of its members, and the rest is verified.

A parity bitmap per set (whose difference never exceeds the sets' difference) drops pairs before
their sets are fetched; verification intersects the whole sets. No pair is dropped otherwise.

Defined results: a set is the distinct runs of ``width`` words of a lower-cased (A-Z) text; a
shorter text's words are one shingle; null texts and texts without words have no shingles, no links
and are their own component. Rows that share an id are one document with the greatest of their
texts. An empty table gives no rows. Other columns take no part.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import (
    LOWER,
    Rolling,
    mixed,
    one_text_each,
    slices,
    small,
    smallest_reached,
    stored,
    stored_alone,
    text_bytes,
    word_spans,
)

SLOT_BITS, PART_BITS = 22, 12
IS_WORD = np.ones(256, bool)
IS_WORD[[32, 9, 10, 11, 12, 13]] = False
STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
LIST_BLOCK = 512
# Pairs that a component asks from a list in each round; the last round asks all.
ASKED = (4, 16, None)
MOST_COPIES = 2_000_000
MOST_LINKS = 1_000_000


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The distinct shingle hashes of every text, ascending."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    begins, ends, first = word_spans(data, offsets, IS_WORD)
    hashes = Rolling(data).ranges(begins, ends)
    out = []
    with np.errstate(over="ignore"):
        runs = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
        for k in range(width):
            runs = mixed(runs * STEPS[0] + hashes[k : k + len(runs)] * STEPS[1] + STEPS[2])
        for b, e in zip(first[:-1], first[1:], strict=True):
            if e - b >= width:
                out.append(np.unique(runs[b : e - width + 1]))
                continue
            whole = np.full(min(1, e - b), e - b, np.uint64)
            for k in range(b, e):
                whole = mixed(whole * STEPS[0] + hashes[k : k + 1] * STEPS[1] + STEPS[2])
            out.append(whole)
    return out


def parts_of(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        for part in slices(batch, "text"):
            yield part, shingle_sets(part.column("text"), width)


def levels(texts: DataFrame, width: int) -> np.ndarray:
    """For every slot of the counter table, the logarithm of how many shingles fall into it."""
    per_part = 1 << PART_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << SLOT_BITS, np.uint32)
        for _, sets in parts_of(batches, width):
            slot = (np.concatenate(sets) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
            np.add.at(held, slot, np.uint32(1))
        held = np.minimum(held, 65535).astype(np.uint16).reshape(-1, per_part)
        some = np.flatnonzero(held.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([zlib.compress(held[i].tobytes(), 1) for i in some], pa.binary())],
            ["part", "counts"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "counts")), strict=True):
                if part not in sums:
                    sums[part] = np.zeros(per_part, np.int64)
                sums[part] += np.frombuffer(zlib.decompress(counts), np.uint16)
        log = {k: np.ceil(np.log2(v + 1)).astype(np.uint8).tobytes() for k, v in sums.items()}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(log), pa.int32()), pa.array(list(log.values()), pa.binary())], ["part", "counts"]
        )

    form = "part int, counts binary"
    out = np.zeros(1 << SLOT_BITS, np.uint8).reshape(-1, per_part)
    # the table is of fixed size, so this is what the driver gets at any size of the input
    summed = stored(texts.mapInArrow(count, form).repartition("part").mapInArrow(add, form), "levels")
    for row in summed.collect():
        out[row.part] = np.frombuffer(row.counts, np.uint8)
    return out.ravel()


def required(size_a, size_b, percent: int):
    """The least overlap at which two sets of these sizes link."""
    return -(-(percent * (size_a + size_b)) // (100 + percent))


def bitmap(tokens: np.ndarray) -> bytes:
    """Parity of the tokens in each of a power of two of bits, about half as many as tokens."""
    bits = 1 << max(8, int(len(tokens) // 2).bit_length())
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def bitmap_difference(a: tuple[int, int], b: tuple[int, int]) -> int:
    """Never more than the number of tokens in one of the two sets only; bitmaps as (bits, value)."""
    if a[0] > b[0]:
        a, b = b, a
    bits, value = b
    while bits > a[0]:
        bits //= 2
        value = (value >> bits) ^ (value & ((1 << bits) - 1))
    return (a[1] ^ value).bit_count()


def described(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Per text: id, n, digest, and for sets that can link the prefix in order and the bitmap."""
    level = levels(texts, width)
    kind = texts.schema["id"].dataType.simpleString()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in parts_of(batches, width):
            rows = []
            for tokens in sets:
                n = len(tokens)
                digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if n else None
                if n and 100 * n >= percent * (n + 1):  # else only an equal set links
                    keep = n - -(-percent * n // 100) + 1
                    order = np.argsort(level[(tokens >> np.uint64(64 - SLOT_BITS)).astype(np.int64)], kind="stable")
                    rows.append((n, digest, tokens[order[:keep]].tobytes(), bitmap(tokens)))
                else:
                    rows.append((n, digest, None, None))
            n, digest, prefix, bits = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array(n, pa.int64()),
                    *(pa.array(x, pa.binary()) for x in (digest, prefix, bits)),
                ],
                ["id", "n", "digest", "prefix", "bits"],
            )

    return texts.mapInArrow(describe, f"id {kind}, n long, digest binary, prefix binary, bits binary")


def index_lists(classes: DataFrame, percent: int) -> DataFrame:
    """Entries of the lists with several sets: token, id, n, place, first, open.

    ``first`` is the first set of the entry's list and band of sizes. A list is not ``open`` where
    none of its pairs may link by size and place but those with the first of their band. One
    exchange brings lists together; they pass in order, and only short ones are held whole.
    """
    kind = classes.schema["id"].dataType.simpleString()

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), 512):
                part = batch.slice(begin, 512)
                tokens = [np.frombuffer(x, np.int64) for x in part.column("prefix").to_pylist()]
                if not tokens:
                    continue
                row = np.repeat(np.arange(len(tokens)), [len(x) for x in tokens])
                place = np.concatenate([np.arange(len(x)) for x in tokens])
                taken = part.select(["id", "n"]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(tokens)),
                        taken.column("id"),
                        taken.column("n"),
                        pa.array(place, pa.int32()),
                    ],
                    ["token", "id", "n", "place"],
                )

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        sent = None  # token, band and first of the last entry sent, where its list may go on
        for batch in chain(batches, [None]):
            if batch is not None and not len(batch):
                continue
            rows = pa.Table.from_batches([*held, *([] if batch is None else [batch])]) if held or batch else None
            if rows is None:
                continue
            rows = rows.combine_chunks().to_batches()[0]
            token = np.asarray(rows.column("token"))
            cut = len(token) if batch is None else int(np.searchsorted(token, token[-1]))
            if len(token) - cut > LIST_BLOCK:
                cut = len(token)
            held = [rows.slice(cut)] if cut < len(token) else []
            if cut:
                made, sent = marked(rows.slice(0, cut), sent, percent)
                yield made

    entries = classes.select("id", "n", "prefix").mapInArrow(spread, f"token long, id {kind}, n long, place int")
    return (
        entries.repartition("token")
        .sortWithinPartitions("token", "n", "id")
        .mapInArrow(listed, f"token long, id {kind}, n long, place int, first {kind}, open boolean")
    )


def marked(rows: pa.RecordBatch, sent: tuple | None, percent: int) -> tuple[pa.RecordBatch, tuple]:
    """Entries of lists with several sets, with first and open, and what the next entries go on from.

    ``rows`` are in order of token, n, id; ``sent`` is what the call before returned. Its last list
    may go on here if it is long, and is open then.
    """
    token, n, place = (np.asarray(rows.column(c), dtype=np.int64) for c in ("token", "n", "place"))
    ids = rows.column("id")
    band = np.floor(np.log(n) / np.log(100 / percent)).astype(np.int64)
    new = np.r_[True, token[1:] != token[:-1]]
    starts = new | np.r_[True, band[1:] != band[:-1]]
    at = np.maximum.accumulate(np.where(starts, np.arange(len(token)), 0))
    first = ids.take(pa.array(at))
    begin = np.flatnonzero(new)
    length = np.diff(np.r_[begin, len(token)])
    run = np.cumsum(new) - 1
    open_run = length > LIST_BLOCK
    kept = length > 1
    if sent is not None and sent[0] == token[0]:
        open_run[0] = kept[0] = True
        same = int(np.searchsorted(at, 0, "right")) if sent[1] == band[0] else 0
        first = pa.concat_arrays([pa.array([sent[2]] * same, ids.type), first.slice(same)])
    end = (begin + length)[run]
    alone = np.arange(len(token))  # every entry is a component of its own here
    u, apart = np.flatnonzero(~open_run[run]), 1
    while len(u := u[u + apart < end[u]]):
        v = u + apart
        asked = (band[u] == band[v]) & (at[u] == u)
        open_run[run[u[fitting(u, v, n, place, alone, percent) & ~asked]]] = True
        u = u[~open_run[run[u]]]
        apart += 1
    made = pa.RecordBatch.from_arrays(
        [*(rows.column(c) for c in ("token", "id", "n", "place")), first, pa.array(open_run[run])],
        ["token", "id", "n", "place", "first", "open"],
    )
    return made.filter(pa.array(kept[run])), (token[-1], band[-1], first[-1].as_py())


def block_pairs(size: np.ndarray, place: np.ndarray, comp: np.ndarray, percent: int):
    """Pairs (i, j) of a list sorted by place that may link and lie in two components.

    The list is cut into blocks; a pair of blocks is skipped when by its bounds of size and
    place no pair of it can link, or when both hold one and the same component.
    """
    cuts = np.arange(0, len(size), LIST_BLOCK)
    low = np.minimum.reduceat(size, cuts)
    high = np.maximum.reduceat(size, cuts)
    least = np.minimum.reduceat(place, cuts)
    only = [comp[c] if (comp[c : c + LIST_BLOCK] == comp[c]).all() else None for c in cuts]
    for i, a in enumerate(cuts):
        for j in range(i, len(cuts)):
            if only[i] is not None and only[i] == only[j]:
                continue
            if high[i] * 100 < low[j] * percent or high[j] * 100 < low[i] * percent:
                continue
            if min(high[i] - least[i], high[j] - least[j]) < required(low[i], low[j], percent):
                continue
            u, v = np.meshgrid(
                np.arange(a, min(a + LIST_BLOCK, len(size))),
                np.arange(cuts[j], min(cuts[j] + LIST_BLOCK, len(size))),
                indexing="ij",
            )
            u, v = u.ravel(), v.ravel()
            if i == j:
                u, v = u[u < v], v[u < v]
            good = fitting(u, v, size, place, comp, percent)
            yield u[good], v[good]


def fitting(u, v, size, place, comp, percent: int) -> np.ndarray:
    """Whether entries u and v of a list lie in two components and may link by size and place."""
    n, m = size[u], size[v]
    good = np.minimum(n - place[u], m - place[v]) >= required(n, m, percent)
    return good & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (comp[u] != comp[v])


def run_pairs(token: np.ndarray, size, place, comp, percent: int):
    """Pairs of entries within each run of equal tokens; short runs all at once, long ones by block."""
    cuts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
    lengths = np.diff(np.r_[cuts, len(token)])
    for b, m in zip(cuts[lengths > LIST_BLOCK], lengths[lengths > LIST_BLOCK], strict=True):
        own = slice(b, b + m)
        for u, v in block_pairs(size[own], place[own], comp[own], percent):
            yield u + b, v + b
    rows = np.flatnonzero(np.repeat(lengths <= LIST_BLOCK, lengths))
    end = np.repeat(cuts + lengths, lengths)
    apart = 1
    while len(rows := rows[rows + apart < end[rows]]):
        good = fitting(rows, rows + apart, size, place, comp, percent)
        yield rows[good], rows[good] + apart
        apart += 1


def first_pairs(u: np.ndarray, v: np.ndarray, comp: np.ndarray, key: np.ndarray, most: int):
    """Of pairs (u, v), those among the ``most`` of smallest hash of one of their components.

    The hash depends on the two sets alone, so lists with the same sets choose the same pairs.
    """
    with np.errstate(over="ignore"):
        turn = mixed(np.minimum(key[u], key[v]) * STEPS[0] + np.maximum(key[u], key[v]) * STEPS[1])
    pair = np.tile(np.arange(len(u)), 2)
    owner = np.r_[comp[u], comp[v]]
    order = np.lexsort((np.tile(turn, 2), owner))
    owner = owner[order]
    begin = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    rank = np.arange(len(owner)) - np.repeat(begin, np.diff(np.r_[begin, len(owner)]))
    chosen = np.unique(pair[order[rank < most]])
    return u[chosen], v[chosen]


def list_pairs(lists: DataFrame, percent: int, most: int | None) -> DataFrame:
    """Candidate pairs (a, b, their sizes) of lists that hold several components.

    Pairs that differ too much by their bitmaps do not leave the task; with ``most``, only so many
    of each component do where a set has more on average. A row without ids tells that some were kept back.
    """
    kind = lists.schema["id"].dataType.simpleString()

    def pairs(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(rows).combine_chunks()
        number = whole.column("id").combine_chunks().dictionary_encode()
        ids, code = number.dictionary, np.asarray(number.indices, dtype=np.int64)
        comp = np.asarray(whole.column("comp").combine_chunks().dictionary_encode().indices)
        token, n, place = (np.asarray(whole.column(c), dtype=np.int64) for c in ("token", "n", "place"))
        _, at = np.unique(code, return_index=True)
        size = n[at]
        bits = [(len(x) * 8, int.from_bytes(x, "little")) for x in whole.column("bits").take(at).to_pylist()]
        key = np.asarray(whole.column("key"), dtype=np.int64)[at].view(np.uint64)
        own = comp[at]
        done: np.ndarray = np.zeros(0, np.int64)
        few: tuple[np.ndarray, np.ndarray] = (done, done)
        back = False
        for u, v in run_pairs(token, n, place, comp, percent):
            u, v = code[u], code[v]
            new = np.setdiff1d(np.minimum(u, v) * len(ids) + np.maximum(u, v), done)
            done = np.union1d(done, new) if len(done) < 1 << 20 else new
            u, v = new // len(ids), new % len(ids)
            limit = size[u] + size[v] - 2 * required(size[u], size[v], percent)
            apart = np.array([bitmap_difference(bits[i], bits[j]) for i, j in zip(u, v, strict=True)], np.int64)
            u, v = u[apart <= limit], v[apart <= limit]
            if most is None:
                yield from named(ids, size, u, v)
            elif len(u):
                few = (np.r_[few[0], u], np.r_[few[1], v])
                if back or len(few[0]) > most * len(ids):
                    chosen = first_pairs(*few, own, key, most)
                    back, few = back or len(chosen[0]) < len(few[0]), chosen
        yield from named(ids, size, *few)
        if back:
            none, zero = pa.nulls(1, ids.type), pa.array([0], pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, zero, zero], ["a", "b", "n_a", "n_b"])

    def named(ids: pa.Array, size: np.ndarray, u: np.ndarray, v: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(u):
            a, b = ids.take(pa.array(u)), ids.take(pa.array(v))
            less = pa.compute.less(a, b)
            n_a, n_b = pa.array(size[u]), pa.array(size[v])
            yield pa.RecordBatch.from_arrays(
                [pa.compute.if_else(less, x, y) for x, y in ((a, b), (b, a), (n_a, n_b), (n_b, n_a))],
                ["a", "b", "n_a", "n_b"],
            )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            tokens = np.asarray(batch.column("token"))
            if not len(tokens):
                continue
            # whole lists only: the last one may go on in the next batch
            cut = int(np.searchsorted(tokens, tokens[-1]))
            if cut:
                yield from pairs([*held, batch.slice(0, cut)])
                held = []
            elif held and held[-1].column("token")[0].as_py() != tokens[0]:
                yield from pairs(held)
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from pairs(held)

    return (
        lists.select("token", "id", "n", "place", "comp", "bits")
        .repartition("token")
        .sortWithinPartitions("token", "place", "id")
        .withColumn("key", F.xxhash64("id"))
        .mapInArrow(search, f"a {kind}, b {kind}, n_a long, n_b long")
        .distinct()
    )


def with_bitmaps(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with their sizes, without those whose bitmaps differ too much."""
    side = lambda x: classes.select(
        F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}")
    )
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    kind = classes.schema["id"].dataType.simpleString()

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [np.asarray(batch.column(c), dtype=np.int64) for c in ("n_a", "n_b")]
            most = sizes[0] + sizes[1] - 2 * required(*sizes, percent)
            bits = (
                [(len(x) * 8, int.from_bytes(x, "little")) for x in batch.column(c).to_pylist()]
                for c in ("bits_a", "bits_b")
            )
            apart = [bitmap_difference(x, y) for x, y in zip(*bits, strict=True)]
            near = pa.array(np.array(apart, np.int64) <= most)
            yield batch.select(["a", "b", "n_a", "n_b"]).filter(near)

    return joined.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(
        keep, f"a {kind}, b {kind}, n_a long, n_b long"
    )


def sets_of(ids: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """The whole sets of the ids given, stored: id, tokens."""
    kind = texts.schema["id"].dataType.simpleString()
    needed = texts.join(small(stored(ids.distinct(), "set-ids")), "id", "left_semi")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in parts_of(batches, width):
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([x.tobytes() for x in sets], pa.binary())], ["id", "tokens"]
            )

    return stored(needed.mapInArrow(make, f"id {kind}, tokens binary"), "sets")


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The exact overlap of the sets of each pair: the columns of ``pairs`` and ``common``."""
    names = pairs.columns
    joined = pairs.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("x")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("tokens").alias("y")), "b"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common = [
                len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                for x, y in zip(*(batch.column(c).to_pylist() for c in ("x", "y")), strict=True)
            ]
            yield batch.select(names).append_column("common", pa.array(common, pa.int64()))

    form = T.StructType(pairs.schema.fields[:]).add("common", "long")
    return joined.select(*names, "x", "y").mapInArrow(count, form)


def ids_in(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(F.explode(F.array(*columns)).alias("id"))


def class_components(classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The smallest id that a class reaches by links, where that is not its own: node, component."""
    lists = stored(index_lists(classes, percent), "lists")
    star = lists.where("first <> id").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    near = stored(with_bitmaps(star, classes, percent), "star-pairs")
    spark = classes.sparkSession
    known = stored_alone(
        spark, lambda: overlaps(near, sets_of(ids_in(near, "a", "b"), texts, width)), "star-overlaps"
    )
    linked = known.where(F.col("common") >= required_column("n_a", "n_b", percent))
    # answers of a star's centre stand for its members: |b & a| lies between bounds of |b & centre|
    centres = (
        linked.groupBy(F.col("b").alias("a"))
        .agg(F.max(F.struct("common", F.col("a").alias("centre"), F.col("n_a").alias("n_centre"))).alias("c"))
        .select("a", "c.*")
        .withColumnRenamed("common", "with_centre")
    )
    comps = stored_alone(spark, lambda: smallest_reached(linked.select("a", "b"), "sets"), "components")
    asked = known.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    lists = lists.where("open")
    for most in ASKED:
        named = small(comps.withColumnRenamed("node", "id"), MOST_LINKS)
        labelled = lists.select("token", "id", "n", "place").join(named, "id", "left")
        labelled = labelled.withColumn("comp", F.coalesce("component", "id")).drop("component")
        several = (
            labelled.groupBy("token")
            .agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
            .where("x <> y")
            .select("token")
        )
        # components only grow, so the lists of a round are among those of the round before
        lists = stored(labelled.join(several, "token", "left_semi"), "rest-lists")
        described_lists = lists.join(classes.select("id", "bits"), "id")
        wanted = list_pairs(described_lists, percent, most).join(small(asked, MOST_LINKS), ["a", "b"], "left_anti")
        pairs = stored(wanted, "rest-pairs")
        new, back = pairs.agg(F.count("a"), F.count_if(F.col("a").isNull())).first()
        if new:
            pairs = pairs.where("a is not null")
            links = stored_alone(spark, lambda: answered(pairs, centres, texts, width, percent), "set-links")  # noqa: B023
            asked = asked.unionByName(pairs.select("a", "b"))
            if not links.isEmpty():
                links = links.unionByName(comps.select(F.col("node").alias("a"), F.col("component").alias("b")))
                comps = stored_alone(spark, lambda: smallest_reached(links, "sets"), "components")  # noqa: B023
        if not back:
            break
    return comps


def answered(pairs: DataFrame, centres: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by the answers of the centre of a where its bounds decide."""
    placed = (
        pairs.join(centres, "a", "left")
        .withColumn("centre", F.coalesce("centre", "a"))
        .withColumn("n_centre", F.coalesce("n_centre", "n_a"))
        .withColumn("with_centre", F.coalesce("with_centre", "n_a"))
    )
    placed = stored(placed, "placed-pairs")
    sets = sets_of(ids_in(placed, "a", "b", "centre"), texts, width)
    answers = overlaps(placed.select(F.col("centre").alias("a"), "b").distinct(), sets)
    need = required_column("n_a", "n_b", percent)
    bounded = placed.join(answers.withColumnRenamed("a", "centre"), ["centre", "b"]).select(
        "a", "b", "n_a", "n_b",
        (F.col("common") - (F.col("n_centre") - F.col("with_centre")) >= need).alias("surely"),
        (F.col("common") + (F.col("n_a") - F.col("with_centre")) >= need).alias("maybe"),
    )
    bounded = stored(bounded, "bounded-pairs")
    open_pairs = bounded.where("maybe and not surely").select("a", "b", "n_a", "n_b")
    verified = overlaps(open_pairs, sets).where(F.col("common") >= need)
    return bounded.where("surely").select("a", "b").unionByName(verified.select("a", "b"))


def required_column(a: str, b: str, percent: int):
    return F.ceil((F.col(a) + F.col(b)) * percent / (100 + percent) - 1e-9)


def linked_documents(
    docs: DataFrame,
    width: int = 3,
    percent: int = 90,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: its id, n_shingles, component_id.

    Documents link when 100 * intersection >= ``percent`` * union of their shingle sets.
    """
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    found = stored_alone(docs.sparkSession, lambda: linked_sets(one_text_each(texts), width, percent), "linked-sets")
    return found.select(F.col("id").alias(id_column), "n_shingles", "component_id")


def linked_sets(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Of texts with distinct ids: id, n_shingles, component_id."""
    spark = texts.sparkSession
    sets = stored(described(texts, width, percent), "described-sets")
    reps = sets.where("n > 0").groupBy("digest").agg(F.min("id").alias("rep"))
    member = sets.select("id", "n", "digest").join(reps, "digest", "left")
    member = stored(member.select("id", "n", F.coalesce("rep", "id").alias("rep")), "set-members")
    copies = member.where("id <> rep").select("id")

    def united() -> DataFrame:
        classes = sets.where("prefix is not null and id is not null").drop("digest")
        few = copies.limit(MOST_COPIES + 1).count() <= MOST_COPIES
        classes = classes.join(F.broadcast(copies) if few else copies, "id", "left_anti")
        # with few copies the sets need no shuffle, so they are not stored a second time
        classes = classes if few else stored(classes, "class-sets")
        return class_components(classes, texts, width, percent).withColumnRenamed("node", "rep")

    comps = stored_alone(spark, united, "set-components")
    return member.join(comps, "rep", "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id")
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Documents without those linked with one of a smaller id, directly or by others.

    Documents without an id stay, linked or not: none of them is known to have the larger one.
    """
    linked = linked_documents(docs, width, percent).where("doc_id <> component_id").select("doc_id")
    return docs.join(small(linked), "doc_id", "left_anti").select(*docs.columns)
