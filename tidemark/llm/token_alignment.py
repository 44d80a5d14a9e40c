"""Cross-tokenizer alignment: groups of tokens of two vocabularies that cover the same bytes.

A text after one space is encoded by a byte-level vocabulary (A) and, with the space that the
library puts before every text, by a sentencepiece vocabulary (B). The byte offsets at which tokens
end are keys of one dictionary for each side, with the tokens' places as values. The keys that both
dictionaries have, found as a set intersection and sorted, cut both lists of ids into groups; the
last tokens of a group end together and are linked.

A single space between two characters that are no white space is a safe boundary where A's splitter
never takes white space into the token before, and no piece of B holds a space mark after another
character. Such a part is encoded alone, with the space in front, and its boundary is a common end.
Parts that are equal are aligned once per worker (a table of ``KEPT_PARTS`` of them; when it is full, a
new one is begun, which takes parts over from the last one as they occur again). New parts without white
space at their ends are encoded ``JOINED_PARTS`` to a text with the spaces between them, which are safe. A text
with a part whose tokens do not give its bytes back is encoded once more as a whole, which decides.

How often two ids are linked is counted over the whole corpus, and each document's links then take
their counts: from a broadcast where a count of the pairs shows at most ``MOST_PAIRS``, by a shuffled
join beyond that. Per-document links are summed by pair before any of them is shuffled.

Defined results: texts that are null or empty, or that either vocabulary does not give back byte by
byte (B reads U+2581 as a space), have no tokens, groups or links. Repeated rows and ids, null ids
too, are aligned row by row and all count. Links of equal count are all best. An empty table gives an
empty result. Other columns of the input take no part, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import accumulate, chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import importable, slices, small, stored, stored_alone

KEPT_PARTS = 200_000
JOINED_PARTS = 64
ALIGNED_ROWS = 32
MOST_PAIRS = 2_000_000
B_BITS = 30
LOW = (1 << 32) - 1
MARK = "▁"
SAFE = re.compile(r" (?<=\S )(?=\S)")
LINK = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("times", pa.int64())])
GROUPED = "number long, id {}, n_a long, n_b long, n_groups long, groups string, links array<struct<a:int,b:int,times:long>>"


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def ends(lengths: np.ndarray) -> dict[int, int]:
    """Each token's end in bytes, and the number of tokens up to there."""
    return dict(zip(np.cumsum(lengths).tolist(), count(1)))


def common_ends(a_ends: dict[int, int], b_ends: dict[int, int]) -> list[int]:
    return sorted(a_ends.keys() & b_ends.keys())


class Aligner:
    """Both vocabularies, and the parts aligned so far."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        letters = byte_letters()
        self.a_bytes = {
            k: bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
            for token, k in self.a.get_vocab().items()
        }
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(k) else p.replace(MARK, " ").encode()
            for k, p in enumerate(pieces)
        ]
        rules = json.loads(self.a.to_str())
        splitter = rules["pre_tokenizer"] or {}
        self.parted = (
            rules["normalizer"] is None
            and splitter.get("type") == "ByteLevel"
            and splitter.get("use_regex", True)
            and not splitter.get("add_prefix_space", True)
            and not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
        )
        self.a_sizes = np.zeros(1 + max(self.a_bytes), np.int64)
        self.a_sizes[list(self.a_bytes)] = list(map(len, self.a_bytes.values()))
        self.b_sizes = np.array(list(map(len, self.b_bytes)), np.int64)
        self.a_names = [str(k) for k in range(len(self.a_sizes))]
        self.b_names = [str(k) for k in range(len(pieces))]
        self.forget()
        self.forget()

    def forget(self) -> None:
        """Begin a new generation of known parts; what is used again comes over from the last one.

        Of a part: its groups, and the bytes of two 64-bit numbers for each group: its link, and the
        numbers of A's and B's tokens. A part whose tokens don't give its bytes back has no groups.
        """
        self.before = getattr(self, "groups", {}), getattr(self, "links", {})
        self.groups: dict[str, str] = {}
        self.links: dict[str, bytes] = {}

    def know(self, parts: set[str]) -> None:
        """Take over or learn the parts of ``parts`` that this generation does not know."""
        new = parts.difference(self.groups)
        groups, links = self.before
        again = new.intersection(groups)
        self.groups.update((p, groups[p]) for p in again)
        self.links.update((p, links[p]) for p in again)
        self.learn(list(new.difference(again)))

    def learn(self, parts: list[str]) -> None:
        """Encode and align parts one after the other, some as one text: the spaces between them are safe.

        A part with white space at an end has no safe space there, and is a text of its own.
        """
        plain = [p for p in parts if p == p.strip()] if self.parted else []
        rows = [plain[i : i + JOINED_PARTS] for i in range(0, len(plain), JOINED_PARTS)]
        if len(plain) < len(parts):
            rows += [[p] for p in set(parts).difference(plain)]
        while rows:
            rows, now = rows[ALIGNED_ROWS:], rows[:ALIGNED_ROWS]
            rows += self.align(now)

    def align(self, rows: list[list[str]]) -> list[list[str]]:
        """Returns the parts that are left: those of rows whose bytes the tokens don't give back, each alone.

        A part that is alone in such a row is kept without groups.
        """
        texts = [" ".join(row) for row in rows]
        a_ids = [x.ids for x in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        b_ids = self.b.encode(texts, num_threads=1)
        given, left = [], []
        for k, text in enumerate(texts):
            whole = b" " + text.encode()
            if (
                b"".join(map(self.a_bytes.__getitem__, a_ids[k])) == whole
                and b"".join(map(self.b_bytes.__getitem__, b_ids[k])) == whole
            ):
                given.append(k)
            elif len(rows[k]) > 1:
                left += [[p] for p in rows[k]]
            else:
                self.groups[rows[k][0]], self.links[rows[k][0]] = "", b""
        parts = [p for k in given for p in rows[k]]
        if not parts:
            return left
        a, b = (list(chain.from_iterable([ids[k] for k in given])) for ids in (a_ids, b_ids))
        a_row, b_row = np.array(a), np.array(b)
        a_ends, b_ends = ends(self.a_sizes[a_row]), ends(self.b_sizes[b_row])
        common = common_ends(a_ends, b_ends)
        place = dict(zip(common, count(1)))
        part_ends = list(accumulate([len(p.encode()) + 1 for p in parts]))
        if not place.keys() >= set(part_ends):
            return left + [[p] for p in parts]
        a_to, b_to = list(map(a_ends.__getitem__, common)), list(map(b_ends.__getitem__, common))
        a_names, b_names = list(map(self.a_names.__getitem__, a)), list(map(self.b_names.__getitem__, b))
        groups = [
            (a_names[i] if k - i == 1 else ",".join(a_names[i:k])) + "|" + (b_names[j] if m - j == 1 else ",".join(b_names[j:m]))
            for i, k, j, m in zip([0, *a_to], a_to, [0, *b_to], b_to)
        ]
        a_to, b_to = np.array(a_to), np.array(b_to)
        links = np.empty((len(common), 2), np.int64)
        links[:, 0] = a_row[a_to - 1] << B_BITS | b_row[b_to - 1]
        links[:, 1] = np.diff(a_to, prepend=0) << 32 | np.diff(b_to, prepend=0)
        held = links.tobytes()
        upto = list(map(place.__getitem__, part_ends))
        cuts = list(zip([0, *upto], upto))
        self.groups.update(zip(parts, [";".join(groups[x:y]) for x, y in cuts], strict=True))
        self.links.update(zip(parts, [held[16 * x : 16 * y] for x, y in cuts], strict=True))
        return left

    def texts(self, texts: list[str]) -> Iterator[tuple[int, int, int, str, dict[int, int]]]:
        """Of each text: tokens of A and of B, groups, the groups written out, links and how often it has them."""
        for *found, links, times in self.summed(texts):
            yield *found, dict(zip(links.tolist(), times.tolist(), strict=True))

    def summed(self, texts: list[str]) -> Iterator[tuple[int, int, int, str, np.ndarray, np.ndarray]]:
        """As ``texts``, with the distinct links in order and their numbers as two arrays."""
        parts = [(SAFE.split(t) if self.parted else [t]) if t else [] for t in texts]
        if len(self.groups) > KEPT_PARTS:
            self.forget()
        self.know(set(chain.from_iterable(parts)))
        for text, own in zip(texts, parts, strict=True):
            groups = list(map(self.groups.__getitem__, own))
            if "" in groups:
                self.know({text})
                own = [text] if self.groups[text] else []
                groups = list(map(self.groups.__getitem__, own))
            held = np.frombuffer(b"".join(map(self.links.__getitem__, own)), np.int64)
            size = int(held[1::2].sum())
            links, times = np.unique(held[::2], return_counts=True)
            yield size >> 32, size & LOW, len(held) // 2, ";".join(groups), links, times


_loaded: dict[tuple[str, str], Aligner] = {}


def aligner(*paths: str) -> Aligner:
    """One aligner per worker and pair of files."""
    if paths not in _loaded:
        _loaded[paths] = Aligner(*paths)
    return _loaded[paths]


def align_tokens(
    docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per document: number (of the row), id, n_a, n_b, n_groups, groups (``a1,a2|b1;a3|b2,b3``), links.

    ``links`` has each pair of linked ids once, with the number of times it is linked there.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = aligner(a_path, b_path)
        for batch in batches:
            for part in slices(batch, "text"):
                found = list(held.summed(part.column("text").fill_null("").to_pylist()))
                offsets = np.cumsum([0, *(len(f[4]) for f in found)], dtype=np.int32)
                pairs, times = (np.concatenate([f[k] for f in found]) for k in (4, 5))
                columns = (pairs >> B_BITS, pairs & ((1 << B_BITS) - 1), times)
                links = pa.StructArray.from_arrays(
                    [pa.array(c).cast(f.type) for c, f in zip(columns, LINK, strict=True)], fields=list(LINK)
                )
                numbers = [pa.array([f[k] for f in found], pa.int64()) for k in range(3)]
                groups = pa.array([f[3] for f in found], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("number"), part.column("id"), *numbers, groups, pa.ListArray.from_arrays(pa.array(offsets), links)],
                    ["number", "id", "n_a", "n_b", "n_groups", "groups", "links"],
                )

    rows = docs.select(
        F.monotonically_increasing_id().alias("number"), F.col(id_column).alias("id"), F.col(text_column).alias("text")
    )
    return rows.mapInArrow(work, GROUPED.format(rows.schema["id"].dataType.simpleString()))


def link_counts(aligned: DataFrame) -> DataFrame:
    """a, b, held (links of the pair in the corpus), best (no id of A is linked with b more often)."""
    held = stored(
        aligned.select(F.inline("links")).groupBy("a", "b").agg(F.sum("times").alias("held")), "alignment-pairs"
    )
    tops = held.groupBy("b").agg(F.max("held").alias("top"))
    return held.join(small(tops), "b").select("a", "b", "held", (F.col("held") == F.col("top")).alias("best"))


def summary(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    most_pairs: int = MOST_PAIRS,
) -> DataFrame:
    """Per document: its sizes, a digest of its groups, and its links weighed by the corpus's counts."""
    spark: SparkSession = docs.sparkSession
    importable(spark)

    def make() -> DataFrame:
        aligned = align_tokens(docs, a_path, b_path, id_column, text_column)
        digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
        aligned = stored(aligned.withColumn("groups", digest), "alignment")
        counts = stored(link_counts(aligned), "alignment-counts")
        weighed = aligned.select("number", F.inline("links")).join(small(counts, most_pairs), ["a", "b"])
        sums = weighed.groupBy("number").agg(
            F.sum("times").alias("n_links"),
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("held")).alias("count_sum"),
        )
        numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_links", "n_best", "count_sum")]
        return aligned.join(sums, "number", "left").select(
            F.col("id").alias(id_column), "n_a", "n_b", "n_groups", *numbers, F.col("groups").alias("groups_sha256")
        )

    return stored_alone(spark, make, "alignment")
