"""Suffix-array dedup by difference cover: bytes in strings of ``length`` that start twice are removed.

Only the order of suffixes up to ``length`` bytes matters here, and of that order only where two
suffixes tie. So suffixes are sorted by fingerprints (96 bits) of what they begin with.

1. Positions of a perfect difference cover modulo v (v = q*q + q + 1, q + 1 positions of each v)
   are ranked by the first length - v + 1 bytes of their suffixes. Any two equal strings of
   ``length`` bytes have a common shift below v at which both are in the cover, so both hold a
   cover position of equal rank there: a tie as long as ``length`` needs one of a cover rank.
2. Suffixes within v before a cover position of repeated rank are the only ones that can tie. They
   are sorted by all ``length`` bytes, bucket by bucket of the fingerprint, some buckets in one
   round after the other, so that a round holds a bounded part of the input on disk and a task
   one bucket. A text block sends each fingerprint once, marked if the block has it twice, and
   gets one bit back for it, so a passage in a third of all rows is no large group.

Removed are all bytes that a tied suffix covers with its first ``length`` bytes, judged on the input.

Defined results: null and empty texts have no bytes; matches never cross rows. Rows that share an id
are one document with the greatest of their texts, and so are the rows without an id. Ids are whole
numbers. Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Rolling, one_text_each, slices, small, stored, text_bytes

BUCKET_ENTRIES = 1 << 20
FLUSH_ENTRIES = 1 << 20
BLOCK_BYTES = 1 << 21
# Fixed value: stands for a missing id inside of this module, so it is no id of its own.
NO_ID = -(2**63)


def difference_cover(q: int) -> np.ndarray:
    """q + 1 residues modulo q*q + q + 1 (q prime) whose differences are all residues.

    The powers of a root of an irreducible cubic over the field of q that have no square term.
    """
    c0, c1 = next(
        (a, b) for b in range(q) for a in range(1, q) if all((x**3 - b * x - a) % q for x in range(q))
    )
    place, found = (1, 0, 0), []
    for i in range(q * q + q + 1):
        if place[2] == 0:
            found.append(i)
        a, b, c = place
        place = (c * c0 % q, (a + c * c1) % q, b)
    return np.array(found)


def cover_positions(n: int, cover: np.ndarray, v: int, depth: int) -> np.ndarray:
    """Cover positions of a text of n bytes whose suffix has ``depth`` bytes."""
    at = (np.arange(0, n, v)[:, None] + cover).ravel()
    return at[at <= n - depth]


def runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal keys begins, and how long it is."""
    begin = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]]) if len(sorted_keys) else np.zeros(0, int)
    return begin, np.diff(np.r_[begin, len(sorted_keys)])


def powers_of_two(x: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(1.0, x)))))


def repeated_cover(texts: DataFrame, length: int, q: int, total: int) -> DataFrame:
    """Cover positions whose rank is repeated: id, places (array)."""
    v, cover = q * q + q + 1, difference_cover(q)
    depth = length - v + 1
    buckets = powers_of_two(total * (q + 1) / v / BUCKET_ENTRIES)
    shift = np.uint64(64 - int(np.log2(buckets))) if buckets > 1 else None
    names = ["bucket", "keys", "ids", "places"]

    def record(bucket: int, keys, ids, places) -> tuple:
        return bucket, keys.tobytes(), ids.tobytes(), places.tobytes()

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
        )

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        keys, ids, places = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, ids, places = keys[order], ids[order], places[order]
        begin, count = runs(keys)
        twice = np.repeat(count > 1, count)
        if twice.any():  # known here; no bucket needs to tell
            yield batch([record(-1, keys[:0], ids[twice], places[twice])])
        # a place of -1 stands for a rank that is repeated already
        places = np.where(count > 1, -1, places[begin]).astype(np.int32)
        keys, ids = keys[begin], ids[begin]
        bucket = (keys >> shift).astype(np.int64) if shift is not None else np.zeros(len(keys), np.int64)
        cut = np.searchsorted(bucket, np.arange(buckets + 1))
        rows = [
            record(b, keys[x:y], ids[x:y], places[x:y])
            for b, (x, y) in enumerate(zip(cut[:-1], cut[1:], strict=True))
            if x < y
        ]
        for i in range(0, len(rows), 256):
            yield batch(rows[i : i + 256])

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for whole in batches:
            for part in slices(whole, "text"):
                data, offsets = text_bytes(part.column("text"))
                roll, ids = Rolling(data), np.asarray(part.column("id"))
                at, who = [], []
                for i, (b, e) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                    if e - b >= length:
                        own = cover_positions(int(e - b), cover, v, depth)
                        at.append(own)
                        who.append(np.full(len(own), i))
                if not at:
                    continue
                at, who = np.concatenate(at), np.concatenate(who)
                begin = offsets[who] + at
                held.append((roll.ranges(begin, begin + depth), ids[who], at.astype(np.int32)))
                size += len(at)
                if size >= FLUSH_ENTRIES:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    def tied(rows: list[tuple]) -> pa.RecordBatch:
        keys, ids, places = (
            np.concatenate([np.frombuffer(r[i], kind) for r in rows])
            for i, kind in enumerate((np.uint64, np.int64, np.int32))
        )
        order = np.argsort(keys, kind="stable")
        begin, count = runs(keys[order])
        hit = order[np.repeat(count > 1, count)]
        hit = hit[places[hit] >= 0]
        return pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(places[hit])], ["id", "place"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket = [], None
        for batch in batches:
            for b, *row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if b < 0:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.frombuffer(row[1], np.int64)), pa.array(np.frombuffer(row[2], np.int32))],
                        ["id", "place"],
                    )
                    continue
                if b != bucket and held:
                    yield tied(held)
                    held = []
                bucket = b
                held.append(row)
        if held:
            yield tied(held)

    ranked = texts.mapInArrow(rank, "bucket int, keys binary, ids binary, places binary")
    spread = F.when(F.col("bucket") < 0, F.xxhash64("ids")).otherwise(F.col("bucket"))
    found = ranked.repartition(spread).sortWithinPartitions("bucket").mapInArrow(sort, "id long, place int")
    return found.groupBy("id").agg(F.collect_list("place").alias("places"))


def candidates(places: np.ndarray, n: int, v: int, length: int) -> np.ndarray:
    """Starts of suffixes of at least ``length`` bytes with one of ``places`` less than v ahead."""
    edge = np.zeros(n + 2, np.int32)
    np.add.at(edge, np.maximum(0, places - v + 1), 1)
    np.add.at(edge, places + 1, -1)
    return np.flatnonzero(np.cumsum(edge)[: n - length + 1] > 0)


def fingerprints(table: pa.Table, v: int, length: int, wanted=None):
    """Of a block of texts, in order of id: per candidate suffix its row, start and fingerprint.

    With ``wanted``, a function of the 64-bit keys, only of suffixes for which it holds.
    """
    data, offsets = text_bytes(table.column("text").combine_chunks())
    row, start = [], []
    for i, places in enumerate(table.column("places").to_pylist()):
        own = candidates(np.array(places, np.int64), int(offsets[i + 1] - offsets[i]), v, length)
        row.append(np.full(len(own), i))
        start.append(own)
    row, start = np.concatenate(row), np.concatenate(start)
    begin = offsets[row] + start
    key = Rolling(data).ranges(begin, begin + length)
    if wanted is not None:
        mine = np.flatnonzero(wanted(key))
        key, begin, row, start = key[mine], begin[mine], row[mine], start[mine]
    keys = np.empty(len(begin), [("key", "<u8"), ("check", "<u4")])
    keys["key"] = key
    keys["check"] = Rolling(data, 1).ranges(begin, begin + length) >> np.uint64(33) << np.uint64(1)
    return data, offsets, row, start, keys


def distinct_keys(keys: np.ndarray):
    """Distinct fingerprints in order, the number of each, and the place of each input among them."""
    order = np.argsort(keys["key"])
    first = keys["key"][order]
    same = first[1:] == first[:-1]
    check = keys["check"][order]
    if (same & (check[1:] != check[:-1])).any():  # equal keys of unequal strings
        order = np.lexsort((keys["check"], keys["key"]))
        first, check = keys["key"][order], keys["check"][order]
        same = (first[1:] == first[:-1]) & (check[1:] == check[:-1])
    new = np.r_[True, ~same] if len(keys) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return keys[order[begin]], np.diff(np.r_[begin, len(keys)]), inverse


def share_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` equal shares of all 64-bit numbers each key is in; it grows with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def removed_spans(
    docs: DataFrame, length: int = 400, q: int = 17, id_column: str = "doc_id", text_column: str = "text",
    round_share: float = 2.0,
) -> DataFrame:
    """Documents that lose bytes: id, spans (removed runs, bytes), kept (remaining bytes).

    ``q`` is a prime with q*q + q + 1 < ``length``. ``round_share`` bounds what one round of buckets
    stores, as a share of the bytes of the input.
    """
    v = q * q + q + 1
    if v >= length:
        raise ValueError("the cover must be shorter than the strings")
    texts = one_text_each(docs.select(number_of(id_column).alias("id"), F.col(text_column).alias("text")))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    places = stored(repeated_cover(texts, length, q, total), "cover")
    blocks = max(1, -(-total // BLOCK_BYTES))
    blocked = stored(
        texts.join(small(places.select("id")), "id", "left_semi")
        .join(places, "id")
        .withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")),
        "repeat-blocks",
    )
    starts = (
        blocked.select(F.least(F.octet_length("text"), F.size("places") * v).cast("long").alias("n"))
        .agg(F.sum("n"))
        .first()[0]
        or 0
    )
    rounds = max(1, int(np.ceil(12 * starts / max(1.0, round_share * total))))
    buckets = powers_of_two(starts / rounds / BUCKET_ENTRIES)

    def in_order(table: pa.Table) -> pa.Table:
        return table.sort_by("id")

    def cuts(distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of fingerprints in order: the shares of rounds and buckets that have some, and where each begins."""
        share = share_of(distinct["key"], rounds * buckets)
        begin, _ = runs(share)
        return share[begin], np.r_[begin, len(share)]

    def send(number: int):
        def run(table: pa.Table) -> pa.Table:
            table = in_order(table)
            *_, keys = fingerprints(table, v, length, lambda k: share_of(k, rounds * buckets) // buckets == number)
            distinct, count, _ = distinct_keys(keys)
            distinct["check"] |= (count > 1).astype(np.uint32)
            share, cut = cuts(distinct)
            parts = [distinct[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)]
            return pa.table(
                {
                    "bucket": pa.array(share % buckets, pa.int32()),
                    "block": pa.array([table.column("block")[0].as_py()] * len(parts), pa.int32()),
                    "keys": pa.array([x.tobytes() for x in parts], pa.binary()),
                }
            )

        return run

    form = np.dtype([("key", "<u8"), ("check", "<u4")])

    def answer(rows: list[tuple]) -> pa.RecordBatch:
        keys = np.concatenate([np.frombuffer(r[2], form) for r in rows])
        distinct, count, inverse = distinct_keys(_unmarked(keys))
        known = np.zeros(len(distinct), bool)
        known[inverse[(keys["check"] & 1) == 1]] = True
        hit = (known | (count > 1))[inverse]
        cut = np.cumsum([len(r[2]) // form.itemsize for r in rows])[:-1]
        bits = [np.packbits(x).tobytes() for x in np.split(hit, cut)]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[1] for r in rows], pa.int32()), pa.array([r[0] for r in rows], pa.int32()), pa.array(bits, pa.binary())],
            ["block", "bucket", "bits"],
        )

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "block", "keys")), strict=True):
                if held and held[-1][0] != row[0]:
                    yield answer(held)
                    held = []
                held.append(row)
        if held:
            yield answer(held)

    answers = None
    for number in range(rounds):
        sent = blocked.groupBy("block").applyInArrow(send(number), "bucket int, block int, keys binary")
        got = stored(
            sent.repartition("bucket")
            .sortWithinPartitions("bucket")
            .mapInArrow(sort, "block int, bucket int, bits binary")
            .withColumn("round", F.lit(number)),
            "ties",
        )
        answers = got if answers is None else answers.unionByName(got)

    def remove(texts: pa.Table, bits: pa.Table) -> pa.Table:
        out = []
        if len(texts):
            texts = in_order(texts)
            data, offsets, row, start, keys = fingerprints(texts, v, length)
            distinct, _, inverse = distinct_keys(keys)
            hit = np.zeros(len(distinct), bool)
            said = {
                (r, b): np.frombuffer(x, np.uint8)
                for r, b, x in zip(*(bits.column(c).to_pylist() for c in ("round", "bucket", "bits")), strict=True)
            }
            share, cut = cuts(distinct)
            for k, x, y in zip(share, cut[:-1], cut[1:], strict=True):
                hit[x:y] = np.unpackbits(said[int(k) // buckets, int(k) % buckets], count=y - x).astype(bool)
            tied = hit[inverse]
            row, start = row[tied], start[tied]
            edge = np.zeros(len(data) + 1, np.int32)
            np.add.at(edge, offsets[row] + start, 1)
            np.add.at(edge, offsets[row] + start + length, -1)
            gone = np.cumsum(edge[:-1]) > 0
            for i, number in enumerate(texts.column("id").to_pylist()):
                text, lost = data[offsets[i] : offsets[i + 1]], gone[offsets[i] : offsets[i + 1]]
                if lost.any():
                    turn = np.flatnonzero(np.diff(np.r_[False, lost, False].astype(np.int8)))
                    spans = [{"begin": int(x), "end": int(y)} for x, y in turn.reshape(-1, 2)]
                    out.append((number, spans, text[~lost].tobytes()))
        ids, spans, kept = zip(*out, strict=True) if out else ((), (), ())
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        return pa.table({"id": pa.array(ids, pa.int64()), "spans": pa.array(spans, kind), "kept": pa.array(kept, pa.binary())})

    return (
        blocked.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(remove, "id long, spans array<struct<begin:long,end:long>>, kept binary")
        .withColumn("id", F.nullif("id", F.lit(NO_ID)))
        .withColumnRenamed("id", id_column)
    )


def number_of(id_column: str) -> Column:
    """The id, and ``NO_ID`` for none: Arrow columns with a null are not read as whole numbers."""
    return F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID))


def _unmarked(keys: np.ndarray) -> np.ndarray:
    plain = keys.copy()
    plain["check"] &= np.uint32(0xFFFFFFFE)
    return plain


def summary(docs: DataFrame, removed: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id, n_bytes, n_removed, n_spans, kept_sha256."""
    texts = one_text_each(docs.select(number_of(id_column).alias("id"), F.col(text_column).alias("text")))
    whole = texts.select(
        "id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("whole_sha256"),
    )
    lost = removed.select(
        number_of(id_column).alias("id"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"]).alias("lost"),
        F.size("spans").cast("long").alias("spans"),
        F.sha2("kept", 256).alias("sha256"),
    )
    return whole.join(lost, "id", "left").select(
        F.nullif("id", F.lit(NO_ID)).alias(id_column),
        "n_bytes",
        F.coalesce("lost", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("sha256", "whole_sha256").alias("kept_sha256"),
    )
