"""Mixing sources to target weights with soft membership.

A softmax regression, trained on at most ``rows_per_domain`` labelled rows of each domain, gives
every document its posterior over the domains of the label table (a domain is a pair of quality
and toxic). Document rates r >= 0 then minimise the squared distance of the expected domain totals
sum(r * tokens * posterior) from the targets, as shares of all tokens, plus ``ridge`` times the mean
of (r - 1) ** 2 by tokens. Of rates that meet the targets alike these are the ones nearest to 1, so
documents keep a rate as far as the targets allow; targets out of reach are met as nearly as least
squares can. At the optimum r = max(0, 1 - posterior . m) with one number in m for each domain,
namely (totals - targets) / ridge. So m is sought by Newton steps: a round computes the totals and the
Gram matrix of the documents with a rate in one aggregation, and rates are never stored in between.
Tokens are runs of characters other than ASCII white space.

Defined results: null and empty texts have no tokens, a posterior from no evidence, and the rate
their posterior gives. Without labelled rows there is one domain ``all``. Label rows with a null are
not used; of repeated label rows of one document the smallest domain counts. Rows are rated one by
one, repeated ones alike. An empty table gives no rows. Other columns are carried along.
"""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import LOWER, Rolling, fresh, slices, small, stored, text_bytes, word_spans

log = logging.getLogger(__name__)
IS_TOKEN = np.ones(256, bool)
IS_TOKEN[[32, 9, 10, 11, 12, 13]] = False
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True
# Shares of the mixture: toxic, else poor, else good text.
TOXIC, POOR = 0.02, 0.1


def counted(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens and byte shares of every text, and of every word its text and hash."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    tokens = np.diff(word_spans(data, offsets, IS_TOKEN)[2])
    begins, ends, first = word_spans(data, offsets, IS_WORD)
    row = np.repeat(np.arange(len(texts)), np.diff(first))
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    shares = np.bincount(owner * 256 + data, minlength=256 * len(texts)).reshape(-1, 256)
    shares = shares / np.maximum(1, np.diff(offsets))[:, None]
    return tokens, shares, row, Rolling(data).ranges(begins, ends)


def parts(texts: pa.Array) -> Iterator[pa.Array]:
    """``texts`` in runs of bounded size."""
    for part in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
        yield part.column("text")


@dataclass
class Model:
    domains: list[str]
    words: np.ndarray  # hashes of the dictionary, ascending
    weights: np.ndarray  # (1 + 256 + words) x domains

    def features(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The feature matrix and the number of tokens of every text."""
        n, shares, row, hashes = counted(texts)
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        known = self.words[at] == hashes if len(self.words) else np.zeros(len(at), bool)
        size = len(self.words)
        x = np.ones((len(texts), 1 + 256 + size), np.float32)
        x[:, 1:257] = 10 * np.sqrt(shares)
        if size:
            counts = np.bincount(row[known] * size + at[known], minlength=size * len(texts))
            x[:, 257:] = counts.reshape(len(texts), size)
            x[:, 257:] = np.log1p(200 * x[:, 257:] / np.maximum(1, n)[:, None])
        return x, n

    def posteriors(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        x, n = self.features(texts)
        z = (x @ self.weights).astype(np.float64)
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True), n


def telling_words(texts: pa.Array, label: np.ndarray, domains: int, most: int) -> np.ndarray:
    """The words, in three texts at least, whose presence depends most on the domain (chi squared)."""
    held, begin = [], 0
    for part in parts(texts):
        *_, row, hashes = counted(part)
        held.append(np.unique(np.rec.fromarrays([hashes, row + begin], names="word,row")))
        begin += len(part)
    pairs = np.concatenate(held) if held else np.zeros(0, [("word", np.uint64), ("row", np.int64)])
    if not len(pairs):
        return pairs["word"]
    found, number = np.unique(pairs["word"], return_inverse=True)
    seen = np.bincount(number * domains + label[pairs["row"]], minlength=len(found) * domains)
    seen = seen.reshape(-1, domains)
    often = seen.sum(axis=1)
    expected = often[:, None] * (np.bincount(label, minlength=domains) / len(label))
    chi = ((seen - expected) ** 2 / np.maximum(expected, 1e-9)).sum(axis=1)
    chi[often < 3] = -1
    top = np.lexsort((found, -chi))[:most]
    return np.sort(found[top[chi[top] > 0]])


def fit(
    rows: list[tuple[str, str]], sizes: dict[str, int], words: int = 128, steps: int = 300, ridge: float = 1e-2
) -> Model:
    """A softmax regression from (domain, text) pairs, corrected to the domains' ``sizes``."""
    domains = sorted({d for d, _ in rows}) or ["all"]
    texts = pa.array([t for _, t in rows], pa.large_string())
    label = np.array([domains.index(d) for d, _ in rows], np.int64)
    model = Model(domains, telling_words(texts, label, len(domains), words), np.zeros((0, 0)))
    x = np.concatenate([model.features(part)[0] for part in parts(texts)] or [model.features(texts)[0]])
    y = np.array([[float(d == k) for k in domains] for d, _ in rows], np.float32).reshape(len(rows), len(domains))
    w = np.zeros((x.shape[1], len(domains)), np.float32)
    spread = x.std(axis=0) + 1e-3 if len(rows) else np.ones(x.shape[1])
    x = x / spread
    # Adam, from zero: the same result for the same rows
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1 if len(domains) > 1 else 1):
        z = x @ w
        e = np.exp(z - z.max(axis=1, keepdims=True))
        g = x.T @ (e / e.sum(axis=1, keepdims=True) - y) / len(rows) + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    model.weights = (w / spread[:, None]).astype(np.float32)
    taken = Counter(d for d, _ in rows)
    model.weights[0] += [np.log(sizes[d] / taken[d]) if d in taken else 0.0 for d in domains]
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, rows_per_domain: int):
    """``rows_per_domain`` labelled texts of each domain, or all it has, by hash of the id; all its rows.

    Only rows of ``docs`` count, and their texts are whole.
    """
    domain = F.concat(F.lit("q"), F.col("quality"), F.lit("t"), F.col("toxic"))
    known = labels.select("doc_id", domain.alias("domain")).where("doc_id is not null and domain is not null")
    known = known.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    rows = docs.where("text is not null")
    picked = F.xxhash64("doc_id", F.lit(4))
    found = rows.select("doc_id").join(known, "doc_id")
    sizes = {r.domain: r.n for r in found.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    # some more than are wanted, as the number below a share of the hashes varies
    most = rows_per_domain + 6 * rows_per_domain**0.5 + 40
    if not sizes:
        return [], {}
    share = F.create_map(*[F.lit(x) for d, n in sizes.items() for x in (d, most / n)])
    chosen = known.where(picked / F.lit(2.0**64) + 0.5 < share[F.col("domain")])
    chosen = chosen.withColumn("picked", picked)
    taken: dict[str, list] = {}
    found = rows.select("doc_id", "text").join(small(chosen), "doc_id")
    for r in sorted(found.collect(), key=lambda r: (r.domain, r.picked, r.text)):
        taken.setdefault(r.domain, []).append((r.domain, r.text))
    return [x for group in taken.values() for x in group[:rows_per_domain]], sizes


def default_targets(domains: list[str]) -> dict[str, float]:
    """Shares of the mixture by domain: toxic and poor text to their shares, the rest good text."""
    toxic = [d for d in domains if d.endswith("t1")]
    poor = [d for d in domains if d.startswith("q0") and d not in toxic]
    good = [d for d in domains if d not in toxic and d not in poor]
    weights = {d: TOXIC / len(toxic) for d in toxic} | {d: POOR / len(poor) for d in poor}
    weights |= {d: (1 - sum(weights.values())) / len(good) for d in good}
    return {d: w / sum(weights.values()) for d, w in weights.items()}


def memberships(docs: DataFrame, model: Model, names: tuple[str, str] = ("_n", "_p")) -> DataFrame:
    """``docs`` with tokens and the posterior, in order of the model's domains, as ``names``."""
    carried = docs.columns
    form = T.StructType(docs.schema.fields[:]).add(names[0], "long").add(names[1], T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                p, n = model.posteriors(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(n, pa.int64()), pa.array(list(p), pa.list_(pa.float64()))],
                    [*carried, *names],
                )

    return docs.mapInArrow(run, form)


def rate(p: Column, steps: list[np.ndarray]) -> Column:
    """The rate after the given steps from 1, kept from falling below 0 after each."""
    if not steps:
        return F.lit(1.0)
    taken = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps])
    dot = lambda s: F.aggregate(
        F.zip_with(p, s, lambda x, y: x * y), F.lit(0.0), lambda a, b: a + b
    )
    return F.aggregate(taken, F.lit(1.0), lambda r, s: F.greatest(F.lit(0.0), r - dot(s)))


@dataclass
class Sums:
    """Over all documents, as shares of all tokens: totals by domain, the rest of those with a rate."""

    totals: np.ndarray
    gram: np.ndarray  # of the posteriors
    squares: float  # of the rates


def rated_sums(rated: DataFrame, steps: list[np.ndarray], size: int) -> Sums | None:
    """The sums of rows with _n and _p at the rates after ``steps``; None without tokens."""
    n, p, r = F.col("_n"), F.col("_p"), F.col("_r")
    pairs = [(i, j) for i in range(size) for j in range(i + 1)]
    found = rated.select("_n", "_p", rate(F.col("_p"), steps).alias("_r")).agg(
        F.sum(n),
        F.sum(n * r * r),
        *[F.sum(n * r * p[i]) for i in range(size)],
        *[F.sum(F.when(r > 0, n * p[i] * p[j]).otherwise(0.0)) for i, j in pairs],
    )
    total, squares, *rest = found.first()
    if not total:
        return None
    gram = np.zeros((size, size))
    for (i, j), x in zip(pairs, rest[size:], strict=True):
        gram[i, j] = gram[j, i] = x / total
    return Sums(np.array(rest[:size], float) / total, gram, squares / total)


def fit_rates(
    rated: DataFrame, targets: np.ndarray, rounds: int = 100, tolerance: float = 1e-9, ridge: float = 1e-6
) -> list[np.ndarray]:
    """The step that leads from rates of 1 to the optimum, over rows with _n and _p.

    ``targets`` are shares of the present total. Ends when the gradient's norm is at ``tolerance``,
    which bounds the projected gradient of every document's rate, or where sums of doubles show no
    descent any more. The totals reached are logged.
    """
    size = len(targets)
    at = np.zeros(size)
    now = rated_sums(rated, [at], size)
    if now is None:
        return []
    value = lambda m, sums: (ridge * m @ m + sums.squares) / 2 + m @ targets
    slope = lambda m, sums: ridge * m - (sums.totals - targets)
    share = 1.0
    for _ in range(rounds):
        g = slope(at, now)
        if np.linalg.norm(g) <= tolerance or share < 1e-6:
            break
        way = -np.linalg.solve(now.gram + ridge * np.eye(size), g)
        m = at + share * way
        tried = rated_sums(rated, [m], size)
        less = value(m, tried) <= value(at, now) + 1e-4 * share * (g @ way)
        if less or np.linalg.norm(slope(m, tried)) < np.linalg.norm(g) / 2:
            at, now, share = m, tried, 1.0
        else:
            share /= 2
    else:
        log.warning("the mixing rates did not settle in %s rounds", rounds)
    log.info("mixing totals %s for targets %s", now.totals.tolist(), list(targets))
    return [at]


def mixed_rates(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float] | None = None,
    rows_per_domain: int = 800,
) -> DataFrame:
    """``docs`` with n_tokens, domain (the likeliest), its posterior and the rate.

    Columns of these names in ``docs`` are replaced.
    """
    made = ("n_tokens", "domain", "posterior", "rate")
    model = fit(*labelled_sample(docs, labels, rows_per_domain))
    wanted = targets or default_targets(model.domains)
    kept = [c for c in docs.columns if c.lower() not in made]
    names = fresh("_n", kept), fresh("_p", kept)
    soft = memberships(docs.select(*kept), model, names)
    # posteriors are computed again for the result, which is cheaper than to store texts
    slim = stored(memberships(docs.select("text"), model).select("_n", "_p"), "memberships")
    steps = fit_rates(slim, np.array([wanted.get(d, 0.0) for d in model.domains]))
    tokens, p = (F.col(f"`{c}`") for c in names)
    best = F.array_max(p)
    domain = F.element_at(
        F.array(*[F.lit(d) for d in model.domains]), F.array_position(p, best).cast("int")
    )
    return soft.select(
        *[F.col(f"`{c}`") for c in kept],
        tokens.alias("n_tokens"),
        domain.alias("domain"),
        best.alias("posterior"),
        rate(p, steps).alias("rate"),
    )
