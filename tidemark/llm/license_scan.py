"""Licence scans: ordered signature rules behind a keyword gate, overlaps resolved by priority.

Each text is lower-cased (A-Z). A rule is tried only where all its gate keywords occur. Its
detections are intervals of bytes; in order of priority, then length, a detection is suppressed
where an accepted one of the same or a higher priority contains it. Places of given phrases are
found besides and never suppressed.

Defined results: null and empty texts have no words, places or detections. Of equal intervals of one
priority the first label is kept. Texts are scanned whole; memory grows with the longest text, time
with the detections times the logarithm of their number. Repeated rows give repeated results. Other columns of
the input take no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, slices, text_bytes, word_spans
from tidemark.llm.license_rules import CONFIDENCE, Rule, pattern, rules

# Phrases and the labels they stand for.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True
PLACE = pa.struct([("label", pa.string()), ("word", pa.int64())])
DETECTION = pa.struct(
    [
        ("label", pa.string()),
        ("priority", pa.int32()),
        ("begin", pa.int64()),
        ("end", pa.int64()),
        ("kept", pa.bool_()),
    ]
)


def resolve(found: list[tuple[int, int, int, str]]) -> list[dict]:
    """Detections (priority, begin, end, label) with the suppressed ones marked.

    From left to right, longer ones first, what contains a detection comes before it. So one holds
    it if the furthest end so far among those of its priority or a higher one is not before its own
    end. One that is suppressed itself lies in an accepted one, so it need not be told apart.
    """
    rows = sorted(set(found), key=lambda d: (d[1], -d[2], d[0], d[3]))
    reach = dict.fromkeys(sorted({d[0] for d in rows}), -1)
    out = []
    for priority, begin, end, label in rows:
        inside = reach[priority] >= end
        for lower in reach:
            if lower >= priority:
                reach[lower] = max(reach[lower], end)
        out.append({"label": label, "priority": priority, "begin": begin, "end": end, "kept": not inside})
    return sorted(out, key=lambda d: (d["priority"], d["begin"] - d["end"], d["begin"], d["label"]))


class Gate:
    """Rules by the rarest-looking (longest) of their keywords, tried first."""

    def __init__(self, table: list[Rule]):
        self.by_key: dict[bytes, list[Rule]] = {}
        for rule in table:
            self.by_key.setdefault(max(rule.gates, key=len, default=b""), []).append(rule)

    def detections(self, text: bytes) -> list[tuple[int, int, int, str]]:
        found = []
        for key, group in self.by_key.items():
            if key not in text:
                continue
            for rule in group:
                if all(g in text for g in rule.gates):
                    found += [
                        (rule.priority, m.start(), m.end(), rule.label)
                        for m in rule.pattern.finditer(text)
                    ]
        return found


def scan_licenses(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    phrases: dict[str, str] | None = None,
) -> DataFrame:
    """Per document: its id, n_words, base (label and word of each place), detections."""
    phrases = PHRASES if phrases is None else phrases

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gate = Gate(rules())
        places = [
            (max(p.split(), key=len).encode(), _places(p), label)
            for p, label in phrases.items()
        ]
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = text_bytes(part.column("text"))
                data = LOWER[data]
                begins, _, first = word_spans(data, offsets, IS_WORD)
                base, detected = [], []
                for row in range(len(part)):
                    text = data[offsets[row] : offsets[row + 1]].tobytes()
                    starts = [
                        (m.start(), label)
                        for key, rule, label in places
                        if key in text
                        for m in rule.finditer(text)
                    ]
                    words = np.searchsorted(begins, [offsets[row] + s for s, _ in starts]) - first[row]
                    base.append([{"label": x[1], "word": int(w)} for x, w in zip(starts, words, strict=True)])
                    detected.append(resolve(gate.detections(text)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array(base, pa.list_(PLACE)),
                        pa.array(detected, pa.list_(DETECTION)),
                    ],
                    ["id", "n_words", "base", "detections"],
                )

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        scan,
        f"id {kind}, n_words long, base array<struct<label:string,word:long>>, detections "
        "array<struct<label:string,priority:int,begin:long,end:long,kept:boolean>>",
    ).withColumnRenamed("id", id_column)


def _places(phrase: str):
    """Every place where the words of ``phrase`` stand one after the other, overlaps included."""
    inner = pattern(phrase).pattern
    return re.compile(rb"(?=" + inner + rb")")


def summary(scanned: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts, first and last place, labels and a score per document."""
    kept = F.filter("detections", lambda d: d["kept"])
    base_labels = F.transform("base", lambda p: p["label"])
    weight = F.array(*[F.lit(c) for c in CONFIDENCE])
    scores = F.transform(kept, lambda d: F.element_at(weight, d["priority"] + 1))
    base_score = F.when(F.size("base") > 0, F.lit(CONFIDENCE[1])).otherwise(F.lit(0.0))
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return scanned.select(
        id_column,
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda p: p["word"])).alias("first_word"),
        F.array_max(F.transform("base", lambda p: p["word"])).alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(F.concat(base_labels, F.transform(kept, lambda d: d["label"]))).alias("labels"),
        F.greatest(base_score, F.coalesce(F.array_max(scores), F.lit(0.0))).alias("score"),
    )
