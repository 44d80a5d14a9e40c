"""Null ids, extreme vectors and clashing column names."""

import hashlib

from tidemark.llm import decontaminate, embedding_dups, line_dedup, mixing, suffix_dedup


def test_suffix_dedup_beside_a_missing_id(spark):
    rows = [(None, "x" * 1000), (1, "y" * 900), (2, "clean " * 20), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = {r.doc_id: r for r in suffix_dedup.summary(df, suffix_dedup.removed_spans(df)).collect()}
    assert {k: (r.n_bytes, r.n_removed, r.n_spans) for k, r in found.items()} == {
        None: (1000, 1000, 1), 1: (900, 900, 1), 2: (120, 0, 0), 3: (0, 0, 0),
    }
    assert found[2].kept_sha256 == hashlib.sha256(b"clean " * 20).hexdigest()


def test_extreme_vectors_link_by_their_cosine(spark):
    rows = [
        (1, [1e-170, 1e-171]), (2, [1e-171, 1e-170]), (3, [1e200, 1e199]), (4, [2e200, 2e199]), (5, [5e-324, 0.0]),
        (6, [1.7e308, 0.0]), (7, [0.0, 0.0]), (8, [float("inf"), 1.0]), (9, None), (10, [None, 1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dups.near_vectors(df).collect()}
    # 1, 3 and 4 have one direction and lie within 0.9 of 5 and 6; 2 does not
    assert found == {k: (4, 1) for k in (1, 3, 4, 5, 6)} | {k: (0, k) for k in (2, 7, 8, 9, 10)}


LINES = "\n".join(f"a line of its own number {k} and some more" for k in range(6))
CLASHING = "doc_id long, text string, _n string, _p string, _id string, _sig string, _gone string, _lines string, _removed string, N_Lines int"


def clashing(spark):
    rows = [(1, LINES), (2, LINES + "\nmore of the second"), (3, "alone"), (None, LINES), (4, None)]
    return spark.createDataFrame([(*r, *["mine"] * 7, 3) for r in rows], CLASHING)


def test_line_dedup_with_clashing_names(spark):
    df = clashing(spark)
    kept = line_dedup.deduped(df)
    assert kept.columns == df.columns
    found = {r.doc_id: r for r in kept.collect()}
    assert found[2].text == "more of the second" and found[1].text == found[None].text == LINES
    assert all(list(r[2:9]) == ["mine"] * 7 for r in found.values()) and set(found) == {1, 2, 3, None, 4}


def test_mixing_with_clashing_names(spark):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    rated = mixing.mixed_rates(clashing(spark), labels)
    assert {(r["_n"], r["_p"], r["_id"]) for r in rated.collect()} == {("mine",) * 3}
    assert rated.columns[-4:] == ["n_tokens", "domain", "posterior", "rate"] and rated.count() == 5


def test_decontamination_of_documents_without_an_id(spark):
    item = "one two three four five six seven eight nine ten"
    rows = [(1, f"x {item} y"), (None, f"so {item}"), (None, "quite another text without any of it at all"), (None, None), (2, "clean")]
    docs = spark.createDataFrame([(*r, "d") for r in rows], "doc_id long, text string, digest string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = decontaminate.without_items(docs, items)
    assert left.columns == docs.columns
    assert sorted(str(tuple(r)) for r in left.collect()) == sorted(str((*r, "d")) for r in rows[2:])
    assert decontaminate.without_items(docs, items.limit(0)).count() == 5
