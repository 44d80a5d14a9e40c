"""Line dedup by pairwise alignment: common blocks of lines are deleted from the later document.

Lines are compared by a hash of their trimmed text. Aligned runs of lines with at least
``min_block`` characters are deleted from the document of the larger id, so partners are documents
that share a run of consecutive lines of that size: of the runs from each line, and of those up to
each line, the shortest that reach ``min_block``, however short their lines. Every line of a common
block lies in such a run that is within the block. Documents that share a run are partners: every
two where it is rare (in at most ``rare`` documents), and each with the first of them where it is
not, so a run in any number of documents gives partners in proportion.
A frequent run that is left in a document after that, because the first one has it in another place
of the order or not as often, makes all earlier documents with it partners (equal ones once), so the
result is that of all pairs. Two partners are aligned by patience diff (lines unique in both are
anchors, the longest increasing run of anchors holds, neighbours that agree extend it, the gaps are
aligned alike).

Defined results: null texts stay null, empty ones empty; a text whose lines are all deleted is empty.
Lines repeated within one document stay. Documents are ordered by id; rows that share an id are
aligned by the greatest of their texts, and rows with another text stay as they are. Other columns
are carried along untouched.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Rolling, fresh, mixed, one_text_each, small, stored, stored_alone


def patience(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Aligned places (i, j) of two sequences, ascending in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        once_a, once_b = Counter(a[i:m]), Counter(b[j:n])
        where = {b[y]: y for y in range(j, n) if once_b[b[y]] == 1}
        anchors = [(x, where[a[x]]) for x in range(i, m) if once_a[a[x]] == 1 and a[x] in where]
        if not anchors:
            continue
        tops: list[int] = []  # the smallest end of an increasing run of each length
        pile: list[int] = []
        before: list[int] = []
        for k, (_, y) in enumerate(anchors):
            at = bisect_left(tops, y)
            before.append(pile[at - 1] if at else -1)
            tops[at : at + 1] = [y]
            pile[at : at + 1] = [k]
        k, chain = pile[-1], []
        while k >= 0:
            chain.append(anchors[k])
            k = before[k]
        x0, y0 = i, j
        for x, y in reversed(chain):
            out.append((x, y))
            todo.append((x0, x, y0, y))
            x0, y0 = x + 1, y + 1
        todo.append((x0, m, y0, n))
    return sorted(out)


def common_blocks(a: Sequence[int], b: Sequence[int], chars: Sequence[int], least: int) -> list[int]:
    """Lines of ``b`` in aligned runs whose ``chars`` sum up to ``least`` at least."""
    gone: list[int] = []
    run: list[int] = []
    last = (-2, -2)
    for i, j in [*patience(a, b), (-9, -9)]:
        if (i, j) != (last[0] + 1, last[1] + 1):
            if sum(chars[k] for k in run) >= least:
                gone += run
            run = []
        run.append(j)
        last = (i, j)
    return gone


def lines(texts: DataFrame) -> DataFrame:
    """Per document: id, sig (of its text), h (hash of each line) and chars (of each line)."""
    split = F.split("text", "\n")
    return texts.where("text is not null").select(
        "id",
        F.xxhash64("text").alias("sig"),
        F.transform(split, lambda x: F.xxhash64(F.trim(x))).alias("h"),
        F.transform(split, lambda x: F.length(F.trim(x))).alias("chars"),
    )


def shortest_runs(chars: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Of each document (its lines begin at ``offsets``), runs of lines that reach ``least`` characters.

    From each line, and up to each line, the shortest. Returns documents, begins and ends.
    """
    sums = np.concatenate([[0], np.cumsum(chars)])
    at = np.arange(len(chars))
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    after = np.searchsorted(sums, sums[at] + least, "left")
    before = np.searchsorted(sums, sums[at + 1] - least, "right") - 1
    forth, back = after <= offsets[doc + 1], before >= offsets[doc]
    begins = np.concatenate([at[forth], before[back]])
    ends = np.concatenate([after[forth], at[back] + 1])
    begins, ends = np.unique(np.stack([begins, ends]), axis=1)
    return doc[begins], begins, ends


def run_hashes(h: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of runs of lines, from the lines' hashes."""
    with np.errstate(over="ignore"):
        powers, inverses = (
            np.cumprod(np.full(len(h), b, np.uint64)) for b in (Rolling.BASE, pow(Rolling.BASE, -1, 2**64))
        )
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(h.view(np.uint64)) * powers)])
        return mixed((sums[ends] - sums[begins]) * inverses[begins]).view(np.int64)


def runs(held: DataFrame, min_block: int) -> DataFrame:
    """Runs that documents may share: id, seq (of all its lines), run (its hash), first (in the document), begin, end."""
    kind = held.schema["id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, chars = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("h", "chars"))
            sizes = pc.list_value_length(batch.column("h")).to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            doc, begins, ends = shortest_runs(chars.astype(np.int64), offsets, min_block)
            run = run_hashes(h.astype(np.int64), begins, ends)
            first = np.zeros(len(run), bool)
            first[np.unique(np.stack([doc, run]), axis=1, return_index=True)[1]] = True
            ids = batch.select(["id", "seq"]).take(pa.array(doc))
            at = [pa.array((x - offsets[doc]).astype(np.int32)) for x in (begins, ends)]
            yield pa.RecordBatch.from_arrays(
                [*ids.columns, pa.array(run), pa.array(first), *at], ["id", "seq", "run", "first", "begin", "end"]
            )

    rows = held.select("id", F.xxhash64("h").alias("seq"), "h", "chars")
    return rows.mapInArrow(find, f"id {kind}, seq long, run long, first boolean, begin int, end int")


def shared_runs(held: DataFrame, min_block: int) -> DataFrame:
    """Of ``runs`` those in several documents, with held (how many) and home (the first of them)."""
    rows = stored(runs(held, min_block), "runs")
    shared = rows.where("first").groupBy("run").agg(F.count("*").alias("held"), F.min("id").alias("home"))
    return stored(rows.join(shared.where("held > 1"), "run"), "shared-runs")


def partners(found: DataFrame, rare: int) -> DataFrame:
    """Pairs of documents that share a run: a (earlier), b."""
    often = found.where((F.col("held") > rare) & (F.col("id") > F.col("home"))).select(
        F.col("home").alias("a"), F.col("id").alias("b")
    )
    few = (
        found.where(F.col("held") <= rare)
        .groupBy("run")
        .agg(F.array_sort(F.collect_set("id")).alias("ids"))  # ``rare`` ids at most
        .select("ids", F.posexplode("ids").alias("at", "b"))
        .select(F.explode(F.slice("ids", F.lit(1), F.col("at"))).alias("a"), "b")
    )
    return often.unionByName(few).distinct()


def runs_left(found: DataFrame, gone: DataFrame, rare: int) -> DataFrame:
    """Frequent runs of which a line is left in a document after the first: run, b."""
    often = found.where((F.col("held") > rare) & (F.col("id") > F.col("home")))
    there = F.expr("exists(sequence(begin, end - 1), x -> not array_contains(gone, x))")
    return (
        often.join(gone.select("id", "gone"), "id", "left")
        .where(F.col("gone").isNull() | there)
        .select("run", F.col("id").alias("b"))
        .distinct()
    )


def other_partners(found: DataFrame, left: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs beside ``pairs`` of a document and those before it, equal ones once, with a run it has left."""
    holders = found.join(left.select("run").distinct(), "run", "left_semi")
    holders = holders.groupBy("run", "seq").agg(F.min("id").alias("a")).drop("seq")
    both = left.join(holders, "run").where("a < b").select("a", "b").distinct()
    return both.join(pairs, ["a", "b"], "left_anti")


def aligned_lines(held: DataFrame, pairs: DataFrame, min_block: int) -> DataFrame:
    """Per document that loses lines by ``pairs``: id, sig, gone (their numbers from 0)."""
    joined = pairs.join(held.select(F.col("id").alias("a"), F.col("h").alias("h_a")), "a").join(
        held.select(F.col("id").alias("b"), "sig", "h", "chars"), "b"
    )
    kind = held.schema["id"].dataType.simpleString()

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("h_a", "h", "chars"))
            gone = [common_blocks(a, b, chars, min_block) for a, b, chars in zip(*columns, strict=True)]
            row = np.repeat(np.arange(len(gone)), [len(x) for x in gone])
            ids = batch.select(["b", "sig"]).take(pa.array(row))
            at = pa.array([x for own in gone for x in own], pa.int32())
            yield pa.RecordBatch.from_arrays([*ids.columns, at], ["id", "sig", "line"])

    aligned = joined.select("b", "sig", "h_a", "h", "chars").mapInArrow(
        align, f"id {kind}, sig long, line int"
    )
    return aligned.groupBy("id", "sig").agg(F.collect_set("line").alias("gone"))


def deleted_lines(texts: DataFrame, min_block: int = 100, rare: int = 8) -> DataFrame:
    """Per document that loses lines: id, sig, gone (their numbers from 0)."""
    held = stored(lines(texts), "lines")
    found = shared_runs(held, min_block)
    pairs = stored(partners(found, rare), "partners")
    gone = stored(aligned_lines(held, pairs, min_block), "aligned")
    left = stored(runs_left(found, gone, rare), "runs-left")
    if left.isEmpty():
        return gone
    more = aligned_lines(held, stored(other_partners(found, left, pairs), "other-partners"), min_block)
    both = gone.unionByName(more).groupBy("id", "sig").agg(F.collect_list("gone").alias("gone"))
    return both.withColumn("gone", F.array_distinct(F.flatten("gone")))


def without_common_blocks(
    docs: DataFrame, id_column: str = "doc_id", counts: tuple[str, str] = ("n_lines", "n_removed"), **options
) -> DataFrame:
    """``docs`` with the text that is left, and two columns of counts, named by ``counts``.

    Columns of these names in ``docs`` are replaced.
    """
    texts = one_text_each(docs.select(F.col(id_column).alias("id"), "text"))
    found = stored_alone(docs.sparkSession, lambda: deleted_lines(texts, **options), "deleted-lines")
    id_, sig, gone_ = (fresh(c, docs.columns) for c in ("_id", "_sig", "_gone"))
    gone = small(found.select(F.col("id").alias(id_), F.col("sig").alias(sig), F.col("gone").alias(gone_)),
                 size=32 + 4 * F.size(gone_))
    same = (F.col(id_column) == F.col(id_)) & (F.xxhash64("text") == F.col(sig))
    split = F.split("text", "\n")
    kept = F.array_join(F.filter(split, lambda _, i: ~F.array_contains(gone_, i)), "\n")
    text = F.when(F.col(gone_).isNull(), F.col("text")).otherwise(kept)
    lines_of = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(split))
    return docs.join(gone, same, "left").select(
        *[text.alias(c) if c == "text" else F.col(c) for c in docs.columns if c not in counts],
        lines_of.cast("long").alias(counts[0]),
        F.when(F.col(gone_).isNull(), F.lit(0)).otherwise(F.size(gone_)).cast("long").alias(counts[1]),
    )


def deduped(docs: DataFrame, **options) -> DataFrame:
    """Documents without common blocks; one that had text and is left without any goes."""
    counts = fresh("_lines", docs.columns), fresh("_removed", docs.columns)
    out = without_common_blocks(docs, counts=counts, **options)
    return out.where((F.col(counts[1]) == 0) | (F.trim("text") != "")).select(*docs.columns)


def summary(docs: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """One row per document: its id, n_lines, n_removed, kept_chars, kept_sha256."""
    return without_common_blocks(docs, id_column, **options).select(
        id_column,
        "n_lines",
        "n_removed",
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("kept_chars"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
