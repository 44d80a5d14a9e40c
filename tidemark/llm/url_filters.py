"""URL filters: allow and block entries in a trie of reversed host labels and path segments.

An entry (host, path, verdict) fits a url whose host is the entry's or a subdomain of it and whose
path starts with the entry's path. Of the entries that fit, the one with the most host labels wins,
then the one with the longest path; of an allow and a block entry for the same place, block wins.
An entry with an empty host fits every host, one with an empty path every path, the empty one too.

The trie has one edge per host label, last label first; the entries of a host hang at its node in a
second trie with one edge per whole path segment. What follows the last ``/`` of an entry's path
need not be a whole segment, so it is kept at the node as an ending that the rest of a url's path
must start with. A url is judged by walking its labels once, then, from the deepest host that has
entries upwards, its segments. The hosts of a batch are walked once each.

Entries are counted in bytes before the trie is built. Up to ``MOST_BYTES`` they go to the
executors as one broadcast; longer lists are joined on the suffixes of each url's host instead,
with the same result (``judge_by_join``).

Defined results: the host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end,
A-Z in lower case, a port or a user name included; the path goes on from there up to ``?``, ``#``
or the end. A url that is null, empty or without ``://`` has an empty host and path, so only an
entry without host and path fits it. A url without a fitting entry gets ``otherwise``. Repeated rows
and null ids are judged row by row, an empty table gives an empty result. Columns of the input named
``host``, ``path``, ``rule`` or ``verdict`` are replaced by the operator's, whatever their case; all
others are carried along.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import importable, stored

MOST_BYTES = 64 << 20
HOSTS_KEPT = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
A_TO_Z = str.maketrans(UPPER, LOWER)
ADDED = ("host", "path", "rule", "verdict")


class Entry(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The entries that the query on ``pages`` is held to.
ENTRIES = [
    Entry("com", "/", "allow"),
    Entry("example.com", "/en/", "block"),
    Entry("www.example.com", "/en/", "allow"),
    Entry("net", "/es/", "block"),
    Entry("net", "/fr/", "block"),
]


class Node:
    """A place in either trie: edges to longer places, and what ends here."""

    __slots__ = ("edges", "held")

    def __init__(self) -> None:
        self.edges: dict[str, Node] = {}
        self.held: Any = None

    def reach(self, steps: Iterable[str]) -> Node:
        node = self
        for step in steps:
            node = node.edges.setdefault(step, Node())
        return node


def labels(host: str) -> list[str]:
    return host.split(".")[::-1] if host else []


class Trie:
    """The entries, and the longest of them that fits a host and a path."""

    def __init__(self, entries: Iterable[Entry]):
        self.root = Node()
        self.paths: dict[str, list[Node]] = {}
        for entry in entries:
            at = self.root.reach(labels(entry.host.translate(A_TO_Z)))
            at.held = at.held or Node()
            *segments, ending = entry.path.split("/")
            place = at.held.reach(segments)
            place.held = place.held or {}
            if place.held.get(ending, ("", ""))[1] != "block":
                place.held[ending] = (entry.host.translate(A_TO_Z) + entry.path, entry.verdict)

    def of_host(self, host: str) -> list[Node]:
        """Path tries of the hosts that ``host`` lies below, the deepest first."""
        found = self.paths.get(host)
        if found is None:
            node, found = self.root, [self.root.held] if self.root.held else []
            for label in labels(host):
                node = node.edges.get(label)
                if node is None:
                    break
                if node.held:
                    found.append(node.held)
            found.reverse()
            if len(self.paths) >= HOSTS_KEPT:
                self.paths.clear()
            self.paths[host] = found
        return found

    def judge(self, host: str, path: str) -> tuple[str, str] | None:
        for node in self.of_host(host):
            best, begin = None, 0
            while True:
                if node.held:
                    fitting = [e for e in node.held if path.startswith(e, begin)]
                    if fitting:
                        best = node.held[max(fitting, key=len)]
                end = path.find("/", begin)
                if end < 0 or (node := node.edges.get(path[begin:end])) is None:
                    break
                begin = end + 1
            if best:
                return best
        return None


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return F.coalesce(F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*(/[^?#]*)", 1), F.lit(""))


def parted(urls: DataFrame, url: str) -> DataFrame:
    """The rows with host and path in place of columns of the operator's names."""
    others = [F.col(f"`{c}`") for c in urls.columns if c.lower() not in ADDED]
    return urls.select(*others, host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))


def judge_by_trie(rows: DataFrame, entries: Iterable[Entry], otherwise: str) -> DataFrame:
    """Rows with host and path, judged with a broadcast trie."""
    trie = rows.sparkSession.sparkContext.broadcast([tuple(e) for e in entries])
    kept = rows.columns

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Trie(Entry(*e) for e in trie.value)
        for batch in batches:
            places = zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)
            found = [held.judge(*place) or (None, otherwise) for place in places]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array([f[k] for f in found], pa.string()) for k in (0, 1))],
                [*kept, "rule", "verdict"],
            )

    told = [T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())]
    return rows.mapInArrow(judged, T.StructType([*rows.schema.fields, *told]))


def judge_by_join(rows: DataFrame, entries: DataFrame, otherwise: str) -> DataFrame:
    """The same by a join on host suffixes, for lists of any length; ``entries``: host, path, verdict.

    Every row is numbered, so that repeated rows stay apart, and only its number, host and path are
    joined. A row meets the entries of its own host and of the hosts above it.
    """
    held = entries.select(
        F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("of"),
        F.coalesce("path", F.lit("")).alias("starts"),
        F.col("verdict").alias("says"),
    )
    packed = stored(
        rows.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number"), "host", "path"),
        "url-rows",
    )
    parts = F.split("host", "[.]", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    # A host such as "a." has an empty last label; the empty host stands for all hosts once.
    places = packed.select("number", "path", F.explode(F.array_distinct(F.concat(above, F.array(F.lit(""))))).alias("of"))
    rank = F.struct(
        F.when(F.col("of") == "", 0).otherwise(F.size(F.split("of", "[.]", -1))).alias("labels"),
        F.octet_length("starts").alias("long"),
        (F.col("says") == "block").alias("block"),
        F.concat("of", "starts").alias("rule"),
        F.col("says").alias("verdict"),
    )
    best = (
        places.join(held, "of")
        .where(F.expr("startswith(path, starts)"))
        .groupBy("number")
        .agg(F.max(rank).alias("best"))
    )
    return packed.join(best, "number", "left").select(
        "row.*",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"),
    )


def judge_urls(
    urls: DataFrame,
    entries: Iterable[Entry] | DataFrame,
    url_column: str = "url",
    otherwise: str = "allow",
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """``urls`` with host, path, rule (the winning entry, or null) and verdict.

    ``entries`` is a list, or a DataFrame with host, path and verdict.
    """
    spark: SparkSession = urls.sparkSession
    importable(spark)
    rows = parted(urls, url_column)
    if not isinstance(entries, DataFrame):
        entries = [Entry(*e) for e in entries]
        if sum(len(e.name) + 32 for e in entries) <= most_bytes:
            return judge_by_trie(rows, entries, otherwise)
        entries = spark.createDataFrame(entries, "host string, path string, verdict string")
        return judge_by_join(rows, entries, otherwise)
    size = F.coalesce(F.length("host"), F.lit(0)) + F.coalesce(F.length("path"), F.lit(0)) + 32
    held = entries.agg(F.sum(size)).first()[0] or 0
    if held > most_bytes:
        return judge_by_join(rows, entries, otherwise)
    listed = entries.select("host", "path", "verdict").toLocalIterator()
    return judge_by_trie(rows, [Entry(e[0] or "", e[1] or "", e[2]) for e in listed], otherwise)


def sql(entries: Iterable[Entry] = ENTRIES, otherwise: str = "allow") -> str:
    """The query on ``pages`` in DuckDB's SQL."""
    values = ", ".join(f"('{e.host}', '{e.path}', '{e.verdict}')" for e in entries)
    return f"""
        WITH entries(of, starts, says) AS (VALUES {values}),
        rests AS (
            SELECT page_id, url,
                CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ),
        places AS (
            SELECT row_number() OVER () AS number, page_id,
                translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
                regexp_extract(coalesce(rest, ''), '^[^/?#]*(/[^?#]*)', 1) AS path
            FROM rests
        ),
        fitting AS (
            SELECT number, of || starts AS rule, says, row_number() OVER (
                PARTITION BY number
                ORDER BY len(string_split(of, '.')) DESC, strlen(starts) DESC, says DESC
            ) AS place
            FROM places JOIN entries
                ON (host = of OR ends_with(host, '.' || of)) AND starts_with(path, starts)
        )
        SELECT page_id, host, path, rule, coalesce(says, '{otherwise}') AS verdict
        FROM places LEFT JOIN (SELECT * FROM fitting WHERE place = 1) USING (number)
    """
