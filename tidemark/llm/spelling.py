"""Spelling variants: words within one edit, found in a reduced alphabet and verified on letters.

Words are the distinct results of the runs of letters of all texts (``counted_words``). Letters are
hashed to ``SYMBOLS`` symbols. If two words differ by one inserted, deleted or replaced letter, their
reduced words are equal or differ by one such edit too. So the full one-edit neighbourhood of every
distinct reduced word is generated as 64-bit hashes and joined with the hashes of the reduced
vocabulary. As the relation has no direction, a reduced word keeps only neighbours whose hash is not
below its own: every pair meets once. Words of reduced words that met are then compared on their
letters, so neither reduction nor hashes let a false pair through, and none is missed.

A reduced word that more than ``CROWD`` words share is not held against its neighbours pair by pair:
the words there and next to it meet on hashes of their own letters, whole or with one left out. A
letter can be put back into such a remainder in a bounded number of ways, so no group grows with the
table, and words within one edit always share one.

Defined results: null and empty texts have no words; the id of a document without one counts as an
empty text in the hash of its runs. Rows that repeat are counted as often as they stand there. Ties
between forms of equal count go to the word first in code-point order. Words have no bound of length.
An empty table gives an empty result. Other columns of the input take no part, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, importable, mixed, slices, small, stored, stored_alone, text_bytes

SYMBOLS = 8
CROWD = 200
PIECE = 1 << 20
WORDS_HELD = 200_000
CELLS = 1 << 18
# The letters that words are made of, after A-Z are in lower case.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
BASE = 0x9E3779B97F4A7C15


def pieces(text: bytes) -> Iterator[bytes]:
    """``text`` in parts of about ``PIECE`` bytes that end at blanks."""
    begin = 0
    while begin < len(text):
        end = len(text)
        if end - begin > PIECE:
            at = text.rfind(b" ", begin, begin + PIECE)
            at = at if at >= 0 else text.find(b" ", begin + PIECE)
            end = at + 1 if at >= 0 else end
        yield text[begin:end]
        begin = end


def letters_only(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z in lower case and blanks for all but a-z and U+00C0 to U+00FF."""
    data = LOWER[data]
    lead = data == 0xC3  # leads U+00C0 to U+00FF and nothing else
    keep = lead | ((data >= 97) & (data <= 122))
    keep[1:] |= lead[:-1]
    return np.where(keep, data, np.uint8(32))


def without(run: bytes, drawn: int, one_in: int) -> bytes:
    """``run`` without one code point where ``one_in`` divides ``drawn``, the run's hash."""
    if drawn % one_in:
        return run
    if run.isascii():
        at = drawn % len(run)
        return run[:at] + run[at + 1 :]
    text = run.decode()
    at = drawn % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def long_enough(word: bytes, least: int) -> bool:
    return len(word) >= least and (word.isascii() or len(word.decode()) >= least)


def counted_words(
    docs: DataFrame, id_column: str, text_column: str, least_length: int, one_in: int
) -> DataFrame:
    """word, n: each document's distinct runs are counted and changed once, then summed by task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def given() -> pa.RecordBatch:
            words = pa.array(held.keys(), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = text_bytes(part.column("text"))
                data = letters_only(data)
                for row, name in enumerate(part.column("id").to_pylist()):
                    runs: Counter[bytes] = Counter()
                    for piece in pieces(data[offsets[row] : offsets[row + 1]].tobytes()):
                        runs.update(piece.split())
                    begun = zlib.crc32(f"{name}:".encode())
                    for run, times in runs.items():
                        if len(run) >= least_length:
                            word = without(run, zlib.crc32(run, begun), one_in)
                            if long_enough(word, least_length):
                                held[word] += times
                    if len(held) > WORDS_HELD:
                        yield given()
                        held.clear()
        if held:
            yield given()

    rows = docs.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.col(text_column).alias("text")
    )
    found = rows.mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def symbol_of(letter: str, symbols: int) -> int:
    return zlib.crc32(letter.encode()) % symbols


def reduced(word: str | Column, symbols: int) -> Column:
    """A word in the reduced alphabet."""
    return F.translate(word, LETTERS, "".join(chr(97 + symbol_of(c, symbols)) for c in LETTERS))


class Hashes:
    """Polynomial hashes of equally long words (rows of character codes) and of their edits."""

    def __init__(self, codes: np.ndarray):
        self.codes, (rows, length) = codes, codes.shape
        with np.errstate(over="ignore"):
            base = np.uint64(BASE)
            self.powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(length, base)]))
            self.terms = self.value(codes) * self.powers[:length]
            self.sums = np.zeros((rows, length + 1), np.uint64)
            np.cumsum(self.terms, axis=1, out=self.sums[:, 1:])
        self.whole = self.sums[:, -1:]

    @staticmethod
    def value(codes: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((codes.astype(np.uint64) + np.uint64(1)) * np.uint64(BASE))

    def deleted(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes with one place left out, and which of them to take: of equal letters in a row the first."""
        back = np.uint64(pow(BASE, -1, 2**64))
        with np.errstate(over="ignore"):
            found = self.sums[:, :-1] + (self.whole - self.sums[:, 1:]) * back
        first = np.ones(self.codes.shape, bool)
        first[:, 1:] = self.codes[:, 1:] != self.codes[:, :-1]
        return found, first

    def replaced(self, code: int) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            found = self.whole - self.terms + self.value(np.array([code])) * self.powers[:-1]
        return found, self.codes != code

    def inserted(self, code: int) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            found = self.sums + self.value(np.array([code])) * self.powers
            found += (self.whole - self.sums) * np.uint64(BASE)
        first = np.ones(self.sums.shape, bool)
        first[:, :-1] = self.codes != code
        return found, first


def of_equal_length(words: list[str]) -> Iterator[tuple[np.ndarray, Hashes]]:
    """Numbers of words of one length and their hashes, at most about ``CELLS`` letters at a time."""
    lengths = np.array([len(w) for w in words], np.int64)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        step = max(1, CELLS // max(1, int(length)))
        for begin in range(0, len(rows), step):
            some = rows[begin : begin + step]
            text = "".join([words[k] for k in some]).encode("utf-32-le")
            yield some, Hashes(np.frombuffer(text, np.uint32).reshape(len(some), length))


def longs(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns.values()], list(columns))


def neighbourhoods(symbols: int):
    """For reduced words: their hash as ``code``, and each one-edit neighbour's that is not below it."""

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, held in of_equal_length(batch.column(0).to_pylist()):
                own = held.whole
                edits = [held.deleted()]
                for code in range(97, 97 + symbols):
                    edits += [held.replaced(code), held.inserted(code)]
                    for found, take in edits:
                        at, place = np.nonzero(take & (found >= own))
                        yield longs(near=found[at, place], code=own[at, 0])
                    edits = []
                yield longs(near=own[:, 0].copy(), code=own[:, 0].copy())

    return generate


def with_code(words: DataFrame, symbols: int) -> DataFrame:
    """word, n and the hash of the reduced word."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.zeros(len(batch), np.uint64)
            for rows, held in of_equal_length(batch.column("reduced").to_pylist()):
                codes[rows] = held.whole[:, 0]
            kept = [batch.column("word"), batch.column("n"), pa.array(codes.view(np.int64))]
            yield pa.RecordBatch.from_arrays(kept, ["word", "n", "code"])

    return words.select("word", "n", reduced(F.col("word"), symbols).alias("reduced")).mapInArrow(
        add, "word string, n long, code long"
    )


def remainders(words: DataFrame) -> DataFrame:
    """word, n, crowded and a hash of the word's letters, whole or with one left out, per row."""

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, held in of_equal_length(batch.column("word").to_pylist()):
                found, take = held.deleted()
                at, place = np.nonzero(take)
                keys = np.concatenate([held.whole[:, 0], found[at, place]])
                which = pa.array(np.concatenate([rows, rows[at]]))
                columns = [batch.column(c).take(which) for c in ("word", "n", "crowded")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(keys.view(np.int64))], ["word", "n", "crowded", "key"])

    return words.select("word", "n", "crowded").mapInArrow(
        generate, "word string, n long, crowded boolean, key long"
    )


def one_edit_apart(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.levenshtein("word", "other", 1) == 1)


def near_pairs(words: DataFrame, symbols: int, crowd: int) -> DataFrame:
    """word, n, other, other_n: words one edit apart, each pair once; ``words``: word, n."""
    coded = stored(with_code(words, symbols), "spelling-coded")
    codes = coded.groupBy("code").agg(F.count("*").alias("held"))
    codes = stored(codes, "spelling-codes")
    near = words.select(reduced(F.col("word"), symbols).alias("reduced")).distinct().mapInArrow(
        neighbourhoods(symbols), "near long, code long"
    )
    met = near.join(small(codes.select(F.col("code").alias("near"))), "near")
    met = stored(met.select("near", "code"), "spelling-met")

    crowded = codes.where(F.col("held") > crowd).select("code")
    some_crowded = not crowded.isEmpty()
    apart = met
    if some_crowded:
        for side in ("near", "code"):
            apart = apart.join(small(crowded.select(F.col("code").alias(side))), side, "left_anti")
    left = coded.select("code", "word", "n")
    right = coded.select(F.col("code").alias("near"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    candidates = apart.join(left, "code").join(right, "near")
    once = (F.col("code") != F.col("near")) | (F.col("word") < F.col("other"))
    found = one_edit_apart(candidates.where(once)).select("word", "n", "other", "other_n")
    if not some_crowded:
        return found

    beside = met.join(small(crowded), "code", "left_semi").select(F.col("near").alias("code"))
    above = met.join(small(crowded.select(F.col("code").alias("near"))), "near", "left_semi").select("code")
    around = beside.unionByName(above).unionByName(crowded).distinct()
    marked = around.join(crowded.withColumn("crowded", F.lit(True)), "code", "left")
    meeting = remainders(
        coded.join(marked, "code").select("word", "n", F.coalesce("crowded", F.lit(False)).alias("crowded"))
    )
    other = meeting.select("key", F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("crowded").alias("too"))
    more = meeting.join(other, "key").where("word < other and (crowded or too)")
    return found.unionByName(one_edit_apart(more).select("word", "n", "other", "other_n").distinct())


def followed(forms: DataFrame) -> DataFrame:
    """word, root: where the forms of ``forms`` (word, form) lead in the end.

    Every round doubles the steps that a word has gone; each step has at least ``ratio`` times the
    count, so a few rounds reach the end.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        on = stored(now.join(ahead, "root", "left"), "spelling-roots")
        if on.where("further is not null").isEmpty():
            return now
        now = on.select("word", F.coalesce("further", "root").alias("root"))


def spelling_variants(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_length: int = 7,
    least_count: int = 2,
    ratio: int = 10,
    one_in: int = 31,
    symbols: int = SYMBOLS,
    crowd: int = CROWD,
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    spark: SparkSession = docs.sparkSession
    importable(spark)

    def make() -> DataFrame:
        counted = counted_words(docs, id_column, text_column, least_length, one_in)
        words = stored(counted.where(F.col("n") >= least_count), "spelling-words")
        pairs = stored(near_pairs(words, symbols, crowd), "spelling-pairs")
        turned = pairs.select(
            F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")
        )
        best = (
            pairs.unionByName(turned)
            .groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("rank"), "other")).alias("best"))
        )
        strong = -F.col("best.rank") >= ratio * F.col("n")
        formed = words.join(best, "word", "left").select(
            "word",
            F.when(strong, F.col("best.other")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(strong, -F.col("best.rank")).alias("form_n"),
        )
        formed = stored(formed, "spelling-forms")
        roots = followed(formed.where("form is not null"))
        return formed.join(roots, "word", "left").select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
        )

    return stored_alone(spark, make, "spelling")
