"""Language ID with string kernels.

The kernel of two texts is the number of character n-grams (n = 1 to ``NGRAM``) present in both,
over the root of the product of the numbers in each (blended spectrum, presence); n-grams are
those of a dictionary of at most ``features`` that occur in several landmarks. ``landmarks`` texts
give the Nystroem map; one-versus-rest ridge regression in that space gives a column of weights per
language. Texts are scored chunk by chunk (``CHUNK`` characters, all of them): presence matrix times
landmark matrix, normalised, times weights; a text's score is the mean over its chunks by length.

What is learned comes from a sample of at most ``rows_per_language`` labelled rows of each
language, one chunk each, picked by hash. Everything else covers all rows.

Defined results: null texts and texts without a letter are ``und`` with score 0; without any
labelled row all are. A text of an unlearned language gets the nearest learned one and a low
``familiar``. Equal scores go to the first language by name. Long texts are walked in runs of
``RUN`` chunks. Repeated rows are scored alike. Rows with a null language teach nothing. Other
columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices

NGRAM, CHUNK, TABLE_BITS = 3, 2000, 20
RUN = 512  # chunks whose presence is held at a time
UNKNOWN = "und"
SHARPNESS = 4.0  # of the softmax that makes a score of the regressions' outputs
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def grams(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Slots of the n-grams that begin at each code point, for n = 1 to NGRAM."""
    wide, key = codes.astype(np.uint64), np.zeros(len(codes), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(NGRAM):
            key[: len(codes) - n] += (wide[n:] + np.uint64(1)) * FACTORS[n]
            yield ((key ^ (key >> np.uint64(29))) * FACTORS[1]) >> np.uint64(64 - TABLE_BITS)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, lower-cased, each followed by NGRAM zeros; lengths without them."""
    low = [t.lower() for t in texts]
    joined = "".join(t + "\0" * NGRAM for t in low).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, np.uint32), np.array([len(t) for t in low], np.int64)


def chunk_starts(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the chunks of ``code_points`` begin, and the end; the text of each chunk.

    The last chunk of a text takes the zeros that follow it.
    """
    per_text = np.maximum(1, -(-lengths // CHUNK))
    text = np.repeat(np.arange(len(lengths)), per_text)
    begin = np.cumsum(lengths + NGRAM) - (lengths + NGRAM)
    number = np.arange(len(text)) - (np.cumsum(per_text) - per_text)[text]
    return np.r_[begin[text] + number * CHUNK, (lengths + NGRAM).sum()], text


@dataclass
class Model:
    languages: list[str]
    slots: np.ndarray  # number of the dictionary's n-gram in each slot of the table, or -1
    size: int
    landmarks: np.ndarray  # features x landmarks, normalised presence
    weights: np.ndarray  # landmarks x languages
    typical: float = 1.0  # median share of known n-grams in the sample

    def presence(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Presence matrix of the chunks that begin at ``starts``, the last of which is an end.

        Also, by chunk, how many of the longest n-grams that begin with a letter there are, and how
        many of them the dictionary has.
        """
        begin, end = int(starts[0]), int(starts[-1])
        rows = np.repeat(np.arange(len(starts) - 1), np.diff(starts)) * (self.size + 1)
        present = np.zeros((len(starts) - 1, self.size + 1), bool)
        # n-grams belong to the chunk they begin in and may reach into the next one
        for slot in grams(codes[begin : end + NGRAM - 1]):
            number = self.slots[slot[: end - begin]]
            present.ravel()[rows + number] = True
        here = codes[begin:end]
        letter = (here >= 128) | ((here >= 97) & (here <= 122))
        counts = np.stack([letter, letter & (number < self.size)]).astype(np.int64)
        return present[:, : self.size], np.add.reduceat(counts, starts[:-1] - begin, axis=1)

    def kernel(self, present: np.ndarray) -> np.ndarray:
        dense = present.astype(np.float32)
        norm = np.sqrt(np.maximum(1, dense.sum(axis=1)))
        return (dense @ self.landmarks) / norm[:, None]

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The number of the best language of every text, its score, and how familiar it looks."""
        codes, lengths = code_points(texts)
        starts, text = chunk_starts(lengths)
        sizes = np.diff(starts) - 0.0
        scores = np.empty((len(text), len(self.languages)))
        known = np.empty((2, len(text)))
        for i in range(0, len(text), RUN):
            present, known[:, i : i + RUN] = self.presence(codes, starts[i : i + RUN + 1])
            scores[i : i + RUN] = self.kernel(present) @ self.weights
        scores *= sizes[:, None]
        begins = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
        mean = np.add.reduceat(scores, begins) / np.add.reduceat(sizes, begins)[:, None]
        best = mean.argmax(axis=1)
        soft = np.exp(SHARPNESS * (mean - mean.max(axis=1, keepdims=True)))
        letters, known = np.add.reduceat(known, begins, axis=1)
        return best, 1.0 / soft.sum(axis=1), known / np.maximum(1, letters) / self.typical


def first_chunks(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Presence matrix of the first chunk of every text, and its share of known n-grams."""
    codes, lengths = code_points([t[:CHUNK] for t in texts])
    starts = np.cumsum(np.r_[0, lengths + NGRAM])
    present, (letters, known) = model.presence(codes, starts)
    return present, known / np.maximum(1, letters)


def fit(
    rows: list[tuple[str, str]], landmarks: int = 192, features: int = 4096, ridge: float = 1e-3
) -> Model | None:
    """A model from (language, text) pairs; None without any."""
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    each = max(1, landmarks // len(languages))
    chosen = [t for lang in languages for t in [x for la, x in rows if la == lang][:each]]
    found: dict[int, int] = {}
    for text in chosen:
        codes, _ = code_points([text[:CHUNK]])
        for slot in np.unique(np.concatenate(list(grams(codes)))):
            found[int(slot)] = found.get(int(slot), 0) + 1
    least = 2 if len(chosen) > 2 else 1
    kept = sorted((s for s, n in found.items() if n >= least), key=lambda s: (-found[s], s))[:features]
    slots = np.full(1 << TABLE_BITS, len(kept), np.int32)
    slots[kept] = np.arange(len(kept))
    model = Model(languages, slots, len(kept), np.zeros((len(kept), 0), np.float32), np.zeros((0, 0)))
    present, _ = first_chunks(model, chosen)
    norms = np.sqrt(np.maximum(1, present.sum(axis=1)))
    model.landmarks = (present / norms[:, None]).T.astype(np.float32)
    values, vectors = np.linalg.eigh(model.kernel(present).astype(np.float64))
    good = values > 1e-8 * max(values.max(), 1e-30)
    nystroem = vectors[:, good] / np.sqrt(values[good])
    parts = [
        first_chunks(model, [t for _, t in rows[i : i + 256]]) for i in range(0, len(rows), 256)
    ]
    kernel = np.concatenate([model.kernel(present) for present, _ in parts])
    model.typical = max(float(np.median(np.concatenate([known for _, known in parts]))), 1e-9)
    mapped = kernel.astype(np.float64) @ nystroem
    wanted = np.array([[1.0 if lang == x else -1.0 for x in languages] for lang, _ in rows])
    gram = mapped.T @ mapped + ridge * len(rows) * np.eye(mapped.shape[1])
    model.weights = (nystroem @ np.linalg.solve(gram, mapped.T @ wanted)).astype(np.float32)
    return model


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a row is kept from learning: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, rows_per_language: int, id_column: str = "doc_id") -> list[tuple[str, str]]:
    """At most ``rows_per_language`` labelled chunks of each language, by hash of the id."""
    place = F.xxhash64(F.col(id_column), F.lit(1))
    labelled = docs.where("lang is not null and text is not null").where(~held_out(id_column)).select(
        "lang",
        F.xxhash64(id_column).alias("picked"),
        F.substring(
            F.col("text"),
            F.pmod(place, F.greatest(F.lit(1), F.ceil(F.length("text") / CHUNK))).cast("int") * CHUNK + 1,
            F.lit(CHUNK),
        ).alias("chunk"),
    )
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return []
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, rows_per_language / n)])
    rows = labelled.where(F.col("picked") / F.lit(2.0**64) + 0.5 < share[F.col("lang")]).collect()
    taken: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.picked, r.chunk)):
        taken.setdefault(r.lang, []).append((r.lang, r.chunk))
    return [x for group in taken.values() for x in group[:rows_per_language]]


def identify(
    docs: DataFrame,
    rows_per_language: int = 600,
    landmarks: int = 192,
    id_column: str = "doc_id",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per document: its id, the columns of ``keep``, held_out, lang_pred, score, familiar.

    ``familiar`` is the share of a text's longest n-grams that the dictionary has, of those that
    begin with a letter, over the sample's median: near 1 for texts like the sample, near 0 for other scripts and for junk.
    """
    model = fit(sample(docs, rows_per_language, id_column), landmarks)
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(
        id_column, *keep, held_out(id_column).alias("held_out"),
        F.when(has_letter, F.col("text")).alias("_text"),
    )
    out = rows.drop("_text").schema.add("lang_pred", "string").add("score", "double").add("familiar", "double")
    names = out.fieldNames()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", 1 << 20):
                texts = part.column("_text").to_pylist()
                some = [i for i, t in enumerate(texts) if t is not None] if model else []
                lang = [UNKNOWN] * len(texts)
                best, familiar = np.zeros(len(texts)), np.zeros(len(texts))
                if some:
                    number, best[some], familiar[some] = model.predict([texts[i] for i in some])
                    for i, k in zip(some, number, strict=True):
                        lang[i] = model.languages[k]
                kept = [part.column(name) for name in names[:-3]]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(lang, pa.string()), pa.array(best), pa.array(familiar)], names
                )

    return rows.mapInArrow(score, out)


def known_languages(
    docs: DataFrame, least_familiar: float = 0.25, rows_per_language: int = 600, landmarks: int = 192
) -> DataFrame:
    """Documents in a learned language; those without letters or less familiar ones go.

    A score says which learned language is nearest, however far it is. So texts of other languages
    and junk are told by their n-grams, of which the dictionary has but a few.
    """
    model = fit(sample(docs, rows_per_language), landmarks)
    # columns by place, so that each text is sent once and no name can clash
    places = [f"c{i}" for i in range(len(docs.columns))]
    text = places[[c.lower() for c in docs.columns].index("text")]
    rows = docs.select(
        *[F.col(f"`{c}`").alias(p) for c, p in zip(docs.columns, places, strict=True)],
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, 1 << 20):
                part = part.filter(part.column("letters")).select(places)
                if model and len(part):
                    _, _, familiar = model.predict(part.column(text).to_pylist())
                    yield part.filter(pa.array(familiar >= least_familiar))

    return rows.mapInArrow(kept, rows.drop("letters").schema).toDF(*docs.columns)
