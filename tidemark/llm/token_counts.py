"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts are gathered to batches of about ``batch_bytes`` bytes, whatever their number of rows. With
a sentencepiece model none of whose pieces holds a space mark after another character, no merge
crosses from a character into the first space of a run, so such places are safe boundaries: a text
is split there and the mark that the library puts before every text stands for the space. Equal
parts are encoded once per worker (a table of at most ``KEPT_PARTS`` lengths).

Defined results: null and empty texts have 0 bytes and 0 tokens, over_limit false. Repeated rows
and ids are counted row by row. An empty table gives an empty result. Other columns of the input
take no part, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices

KEPT_PARTS = 400_000
MARK = "▁"
AFTER_RUN = re.compile(f"(?<=[^ {MARK}]) ")
_loaded: dict[str, "Counter"] = {}


class Counter:
    """Lengths of texts under one vocabulary file."""

    def __init__(self, path: str):
        self.lengths: dict[str, int] = {}
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_padding()
            model.no_truncation()
            self.encode = lambda texts: [
                len(x.ids) for x in model.encode_batch(texts, add_special_tokens=False)
            ]
            self.safe = False
        else:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            pieces = map(model.id_to_piece, range(model.get_piece_size()))
            self.safe = not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces) and (
                model.encode("a", out_type=str)[0].startswith(MARK)
                and len(model.encode(" a")) == len(model.encode("  a")) == 2
                and model.encode("  a", out_type=str)[0] == MARK * 2
            )

    def parts(self, text: str) -> list[str]:
        """The parts of a text at safe boundaries; an empty part stands for a last space."""
        if MARK in text or "  " in text or text[:1] == " ":
            return AFTER_RUN.split(text)
        return text.split(" ")

    def counts(self, texts: list[str]) -> list[int]:
        if not self.safe:
            return self.encode(texts)
        known = self.lengths
        if len(known) > KEPT_PARTS:
            known.clear()
        known[""] = 1
        split = [self.parts(t) if t else [] for t in texts]
        new = list(set().union(*split).difference(known))
        known.update(zip(new, self.encode(new), strict=True))
        return [sum(map(known.__getitem__, parts)) for parts in split]


def counter(path: str) -> Counter:
    """One counter per worker and file."""
    if path not in _loaded:
        _loaded[path] = Counter(path)
    return _loaded[path]


def count_tokens(
    docs: DataFrame,
    vocabulary: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = 4096,
    batch_bytes: int = 1 << 20,
) -> DataFrame:
    """One row per document: its id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``)."""

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary).counts
        for batch in batches:
            for part in slices(batch, "text", batch_bytes):
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("n_bytes"),
                        pa.array(count(part.column("text").fill_null("").to_pylist()), pa.int64()),
                    ],
                    ["id", "n_bytes", "n_tokens"],
                )

    text = F.col(text_column)
    rows = docs.select(
        F.col(id_column).alias("id"),
        text.alias("text"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(lengths, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("id").alias(id_column),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
