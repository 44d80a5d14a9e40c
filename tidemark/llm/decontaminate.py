"""Benchmark decontamination: size-partitioned MinHash containment search, then an exact check.

A document contains an item when at least ``threshold`` of the item's distinct five-word shingles
occur in it. Items are partitioned by the number of their shingles. The MinHash sketch of an item
is its m smallest shingle hashes, where m is one more than the number of shingles that may be
missing at the upper size of its partition, so a document that contains the item shares a hash of
the sketch for certain; no leak is lost to chance. Documents keep only hashes not above the largest
sketch hash of all partitions. Candidates are verified by counting common shingles (as text).

Only DataFrame functions are used. The sketches are broadcast while their bytes, which are counted,
stay under ``broadcast_bytes``, and joined by shuffle beyond.

Words are maximal runs of letters and digits, lower-cased. Defined results: null texts, texts and
items with fewer than five words have no shingle and are in no pair; repeated items and documents
give their own pairs, and rows with the same id are one document. Empty tables give no pairs. Other
columns take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, small, stored

WORDS = 5
BETWEEN = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), BETWEEN), lambda w: w != "")


def starts(words_column: str) -> Column:
    """Places at which a shingle begins."""
    n = F.size(words_column)
    return F.when(n >= WORDS, F.sequence(F.lit(1), n - WORDS + 1)).otherwise(F.array().cast("array<int>"))


def shingle(words_column: str, at: Column) -> list[Column]:
    return [F.get(F.col(words_column), at + (k - 1)) for k in range(WORDS)]


def shingles(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct shingles of each row: keys, shingle."""
    return (
        df.select(*keys, words(F.col("text")).alias("w"))
        .select(*keys, F.explode(F.transform(starts("w"), lambda i: F.concat_ws(" ", *shingle("w", i)))).alias("shingle"))
        .distinct()
    )


def sketches(item_shingles: DataFrame, threshold: float) -> DataFrame:
    """The sketch of every item: item_id, n_item, part, h."""
    from pyspark.sql import Window

    hashed = item_shingles.withColumn("h", F.xxhash64(*[F.get(F.split("shingle", " "), F.lit(k)) for k in range(WORDS)]))
    sized = hashed.withColumn("n_item", F.count("*").over(Window.partitionBy("item_id")))
    # sizes of a partition lie in (2**part, 2**(part + 1)]
    sized = sized.withColumn("part", F.ceil(F.log2(F.col("n_item"))).cast("int") - 1)
    upper = F.least(F.col("n_item"), F.floor(F.pow(F.lit(2.0), F.col("part") + 1) * (1 - threshold) + 1e-9) + 1)
    ranked = sized.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy("h", "shingle")))
    return ranked.where(F.col("rank") <= upper).select("item_id", "n_item", "part", "h")


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = 0.8,
    broadcast_bytes: int = 64 << 20,
    id_column: str = "doc_id",
) -> DataFrame:
    """Pairs (doc_id, item_id) with n_common, n_item and containment >= ``threshold``."""
    item_shingles = stored(
        shingles(items.select("item_id", "text"), ["item_id"]), "item-shingles"
    )
    sketch = stored(sketches(item_shingles, threshold), "item-sketches")
    n, top = sketch.agg(F.count("*"), F.max("h")).first()
    sides = sketch.select("h", F.col("item_id").alias("item")).distinct()
    if n * 64 <= broadcast_bytes:
        sides = F.broadcast(sides)
    top = F.lit(top).cast("long")
    texts = docs.select(F.col(id_column).alias("doc_id"), "text")
    probes = (
        texts.select("doc_id", words(F.col("text")).alias("w"))
        .select(
            "doc_id",
            F.explode(
                F.filter(
                    F.transform(starts("w"), lambda i: F.xxhash64(*shingle("w", i))), lambda h: h <= top
                )
            ).alias("h"),
        )
    )
    candidates = stored(probes.join(sides, "h").select("doc_id", "item").distinct(), "candidates")
    near = texts.join(small(candidates.select("doc_id").distinct()), "doc_id", "left_semi")
    both = (
        shingles(near, ["doc_id"])
        .join(_checked(item_shingles, broadcast_bytes), "shingle")
        .groupBy("doc_id", "item_id")
        .agg(F.count("*").alias("n_common"))
        .join(candidates.withColumnRenamed("item", "item_id"), ["doc_id", "item_id"], "left_semi")
    )
    sizes = item_shingles.groupBy("item_id").agg(F.count("*").alias("n_item"))
    ratio = F.col("n_common") / F.col("n_item")
    return (
        both.join(sizes, "item_id")
        .where(ratio >= threshold)
        .select(F.col("doc_id").alias(id_column), "item_id", "n_common", "n_item", ratio.alias("containment"))
    )


def _checked(item_shingles: DataFrame, broadcast_bytes: int) -> DataFrame:
    size = item_shingles.agg(F.sum(F.octet_length("shingle") + 64)).first()[0] or 0
    return F.broadcast(item_shingles) if size <= broadcast_bytes else item_shingles


def without_items(docs: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Documents that contain no item; those without an id are told apart by their texts."""
    leaks = stored(contained_items(docs, items, threshold).select("doc_id").distinct(), "leaks")
    kept = docs.join(small(leaks), "doc_id", "left_anti").select(*docs.columns)
    nameless = docs.where("doc_id is null")
    if nameless.isEmpty():
        return kept
    digest = F.sha2("text", 256)
    texts = nameless.where("text is not null").select(digest.alias("doc_id"), "text").distinct()
    found = contained_items(texts, items, threshold).select("doc_id").distinct()
    found = found.select(F.col("doc_id").alias(name := fresh("digest", docs.columns)))
    clean = nameless.join(small(found), digest == F.col(name), "left_anti").select(*docs.columns)
    return kept.where("doc_id is not null").unionByName(clean)


def sql(threshold: float = 0.8) -> str:
    """The pairs in SQL over ``documents`` and ``benchmark``."""
    def parts(table: str, key: str) -> str:
        return f"""
          SELECT DISTINCT {key}, array_to_string(w[i : i + {WORDS - 1}], ' ') AS shingle
          FROM (SELECT {key}, w, unnest(generate_series(1, len(w) - {WORDS - 1})) AS i
                FROM (SELECT {key}, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'),
                                                lambda x: x <> '') AS w
                      FROM {table} WHERE text IS NOT NULL))"""

    return f"""
        WITH d AS ({parts("documents", "doc_id")}), i AS ({parts("benchmark", "item_id")}),
        n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id),
        c AS (SELECT doc_id, item_id, count(*) AS n_common FROM d JOIN i USING (shingle)
              GROUP BY doc_id, item_id)
        SELECT doc_id, item_id, n_common, n_item, n_common / n_item AS containment
        FROM c JOIN n USING (item_id) WHERE n_common / n_item >= {threshold}"""
