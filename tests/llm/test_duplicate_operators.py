"""N-gram join, line dedup, suffix dedup, embeddings, decontamination, mixing and the pipeline."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tidemark.llm import (
    catalog, common, decontaminate, embedding_dups, line_dedup, mixing, ngram_join, suffix_dedup,
)
from tidemark.llm.common import components, importable

SF = "/root/testdata/sf0.001"


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def prose(seed, n):
    pick = random.Random(str(seed))
    return " ".join("".join(pick.choices("abcdefgh", k=4)) for _ in range(n))


@pytest.fixture(scope="module")
def copies(spark):
    """Originals, exact and near copies, shared passages, and odd rows."""
    rows, pick = [], random.Random(3)
    for i in range(40):
        rows.append((i, "\n".join(prose((i, k), 25) for k in range(8))))
    shared = prose("shared", 90)
    for i in range(40, 120):
        words = rows[i % 12][1].split(" ")
        for _ in range(i % 5):
            words[pick.randrange(len(words))] = "new" + str(pick.randrange(10**6))
        rows.append((i, " ".join(words)))
    rows += [(i, prose(i, 20) + "\n" + shared + "\n" + prose(-i, 20)) for i in range(120, 150)]
    rows += [(200, None), (201, ""), (202, "  "), (203, "one"), (204, "one two"), (205, "ONE  two"), (206, "a" * 900)]
    rows += [(207, rows[0][1]), (207, rows[0][1])]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "'x' as block", "0.5 as rate")


def test_components(spark):
    pick = random.Random(1)
    edges = [(pick.randrange(60), pick.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 130)]
    parent = {x: x for e in edges for x in e}
    for a, b in edges:
        x, y = find(parent, a), find(parent, b)
        parent[max(x, y)] = min(x, y)
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert all(found.get(x, x) == find(parent, x) for x in parent)


def brute_join(rows, width=3, percent=90):
    sets = {}
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        runs = [tuple(words[k : k + width]) for k in range(len(words) - width + 1)] or ([tuple(words)] if words else [])
        sets[i] = set(runs)
    parent = {i: i for i in sets}
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(parent, a), find(parent, b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(parent, i)) for i in ids}


def test_ngram_join_is_exact(spark, copies):
    wanted = brute_join([(r.doc_id, r.text) for r in copies.collect()])
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.linked_documents(copies).collect()}
    assert found == wanted
    assert sum(k != v[1] for k, v in found.items()) > 30


def test_one_of_each_keeps_documents_without_an_id(spark):
    same = prose("copy", 40)
    rows = [(None, prose("own", 40)), (None, same), (None, None), (1, same), (2, same), (3, prose(3, 40)), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter(tuple(r) for r in ngram_join.one_of_each(docs).collect())
    assert kept == Counter(r for r in rows if r[0] != 2)


def listed_by_hand(entries, percent=90):
    """(token, id) -> (first of list and band, open) of lists with several sets."""
    lists, out = defaultdict(list), {}
    for token, i, n, place in entries:
        lists[token].append((n, i, place, int(np.floor(np.log(n) / np.log(100 / percent)))))
    for token, rows in lists.items():
        firsts = {}
        for n, i, _, band in sorted(rows):
            firsts.setdefault(band, i)
        n, place, alone = np.array([r[0] for r in rows]), np.array([r[2] for r in rows]), np.arange(len(rows))
        u, v = np.triu_indices(len(rows), 1)
        good = ngram_join.fitting(u, v, n, place, alone, percent)
        left = [
            rows[a][3] != rows[b][3] or firsts[rows[a][3]] not in (rows[a][1], rows[b][1])
            for a, b in zip(u[good], v[good], strict=True)
        ]
        if len(rows) > 1:
            is_open = any(left) or len(rows) > ngram_join.LIST_BLOCK
            out |= {(token, i): (firsts[band], is_open) for _, i, _, band in rows}
    return out


def test_index_lists_take_one_exchange_and_tell_which_are_open(spark):
    pick = np.random.default_rng(5)
    rows, entries = [], []
    for i in range(900):
        n = int(pick.integers(20, 60))
        # one list of most sets, some of a few, and tokens of one set only
        prefix = [1] if i % 9 else []
        prefix += [int(x) for x in np.unique(pick.integers(10, 700, 4))] + [10_000 + i]
        rows.append((i, n, bytearray(np.array(prefix, np.int64).tobytes())))
        entries += [(token, i, n, place) for place, token in enumerate(prefix)]
    lists = ngram_join.index_lists(spark.createDataFrame(rows, "id long, n long, prefix binary"), 90)
    assert lists._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    wanted = listed_by_hand(entries)
    for size in (10_000, 97):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            found = {(r.token, r.id): (r.first, r.open) for r in lists.collect()}
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert found == wanted
    assert {o for _, o in wanted.values()} == {True, False}


def test_results_are_written_in_small_arrow_batches(spark):
    importable(spark)
    docs = spark.range(6000, numPartitions=1).selectExpr("id doc_id", "repeat('word ', 400) text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    assert docs.mapInArrow(sizes, "size long").agg({"size": "max"}).first()[0] < 5 << 20


def test_block_pairs_of_long_lists():
    pick = np.random.default_rng(0)
    size, place = pick.integers(20, 60, 1500), np.sort(pick.integers(0, 6, 1500))
    comp = pick.integers(0, 40, 1500)
    token = np.zeros(1500, np.int64)
    found = {(min(p), max(p)) for u, v in ngram_join.run_pairs(token, size, place, comp, 90) for p in zip(u, v, strict=True)}
    every = np.triu_indices(1500, 1)
    good = ngram_join.fitting(*every, size, place, comp, 90)
    assert found == set(zip(every[0][good], every[1][good], strict=True))


def test_bitmap_never_exceeds_the_difference():
    pick = np.random.default_rng(2)
    for _ in range(50):
        a = np.unique(pick.integers(0, 2**63, pick.integers(1, 3000)).astype(np.uint64))
        b = np.union1d(a[: len(a) // 2], pick.integers(0, 2**63, 50).astype(np.uint64))
        bits = [(len(x) * 8, int.from_bytes(x, "little")) for x in map(ngram_join.bitmap, (a, b))]
        assert ngram_join.bitmap_difference(*bits) <= len(np.setxor1d(a, b))


def counted_steps(monkeypatch):
    """The names of the steps stored from now on."""
    names, stored = [], common.stored
    for module in (common, ngram_join):
        monkeypatch.setattr(module, "stored", lambda df, name: names.append(name) or stored(df, name))
    return names


def test_components_end_without_a_round_that_changes_nothing(spark, monkeypatch):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    for parts, most in ((1, 2), (3, 20)):
        names = counted_steps(monkeypatch)
        found = components(edges.repartition(parts), "t").collect()
        assert sorted((r.node, r.component) for r in found) == [(i, 0) for i in range(201)]
        assert len(names) <= most
        monkeypatch.undo()


def test_join_ends_when_every_pair_is_asked(spark, copies, monkeypatch):
    names = counted_steps(monkeypatch)
    ngram_join.linked_documents(copies).collect()
    assert names.count("rest-pairs") == 1


def test_list_tells_that_it_keeps_pairs_back(spark):
    bits = ngram_join.bitmap(np.arange(40, dtype=np.uint64))
    lists = spark.createDataFrame(
        [(1, i, 40, 0, i, bytearray(bits)) for i in range(30)],
        "token long, id long, n long, place int, comp long, bits binary",
    )
    importable(spark)
    for most, back in ((4, True), (16, False), (None, False)):
        pairs = [(r.a, r.b) for r in ngram_join.list_pairs(lists, 90, most).collect()]
        assert ((None, None) in pairs) == back
        asked = Counter(x for p in pairs if p != (None, None) for x in p)
        assert min(asked[i] for i in range(30)) >= (4 if back else 29)
        assert (len(pairs) < 30 * 29 // 2) == back


def test_suffix_dedup_is_exact(spark, copies):
    docs = {r.doc_id: (r.text or "").encode() for r in copies.collect()}
    length = 400
    seen = Counter(t[k : k + length] for t in docs.values() for k in range(len(t) - length + 1))
    wanted = {}
    for i, t in docs.items():
        lost = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                lost[k : k + length] = b"x" * length
        kept = bytes(c for c, x in zip(t, lost, strict=True) if not x)
        runs = [x for x in bytes(lost).split(b"\0") if x]
        wanted[i] = (len(t), sum(map(len, runs)), len(runs), hashlib.sha256(kept).hexdigest())
    found = suffix_dedup.summary(copies, suffix_dedup.removed_spans(copies)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == wanted
    assert sum(w[1] > 0 for w in wanted.values()) > 50 and wanted[206][1] == 900
    empty = copies.limit(0)
    assert suffix_dedup.summary(empty, suffix_dedup.removed_spans(empty)).collect() == []


def test_fingerprints_of_a_share_are_those_of_all_in_it():
    """Rounds take shares of the keys before they are checked and sorted; equal keys may differ in check."""
    text = prose("share", 300)
    table = pa.table({"text": [text, text[:900]], "places": [list(range(0, 1000, 50)), [0, 300]]})
    *_, every = suffix_dedup.fingerprints(table, 307, 400)
    found = []
    for number in range(3):
        *_, keys = suffix_dedup.fingerprints(table, 307, 400, lambda k, n=number: suffix_dedup.share_of(k, 3) == n)
        found.append(suffix_dedup.distinct_keys(keys))
    distinct, count, inverse = suffix_dedup.distinct_keys(every)
    assert (distinct[inverse] == every).all() and count.sum() == len(every) and (count > 1).any()
    assert (np.concatenate([f[0] for f in found]) == distinct).all()
    assert (np.concatenate([f[1] for f in found]) == count).all()
    clash = np.array([(5, 4), (5, 2), (3, 2), (5, 4)], every.dtype)
    distinct, count, inverse = suffix_dedup.distinct_keys(clash)
    assert distinct.tolist() == [(3, 2), (5, 2), (5, 4)] and count.tolist() == [1, 1, 2] and (distinct[inverse] == clash).all()


@pytest.mark.parametrize("q", [2, 3, 5, 17])
def test_difference_cover(q):
    v, cover = q * q + q + 1, suffix_dedup.difference_cover(q)
    assert len(cover) == q + 1 and {(a - b) % v for a in cover for b in cover} == set(range(v))


def brute_vectors(rows):
    good = {}
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, float) / np.linalg.norm(np.array(v, float))
    links, parent = Counter(), {i: i for i, _ in rows}
    ids = sorted(good)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if len(good[a]) == len(good[b]) and good[a] @ good[b] >= 0.9:
                links[a] += 1
                links[b] += 1
                x, y = find(parent, a), find(parent, b)
                parent[max(x, y)] = min(x, y)
    return {i: (links[i], find(parent, i), find(parent, i) == i) for i, _ in rows}


def test_embedding_links(spark):
    pick = np.random.default_rng(5)
    heart = pick.standard_normal((30, 16))
    rows = [(i, [float(np.float32(x)) for x in heart[i % 30] + 0.08 * pick.standard_normal(16)]) for i in range(900)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [1.0, None] * 8), (2004, [float("nan")] * 16), (2005, [1.0, 0.0]), (2006, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as n", "2 as leaf")
    wanted = brute_vectors(rows)
    found = embedding_dups.near_vectors(df, leaf=64, block=100, trees=10, spill=0.12)
    got = {r.vec_id: tuple(r)[1:] for r in found.collect()}
    assert got.keys() == wanted.keys()
    assert sum(g[0] for g in got.values()) >= 0.99 * sum(w[0] for w in wanted.values())
    assert all(got[i][0] <= wanted[i][0] for i in got)
    assert sum(got[i][1] == wanted[i][1] for i in got) >= 0.99 * len(got)
    assert embedding_dups.near_vectors(df.limit(0)).collect() == []


def test_decontamination_matches_sql_and_is_native(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    result = con.execute(catalog.oracle_sql()["op9_decontaminate"])
    names = [c[0] for c in result.description]
    found = catalog.op9_decontaminate(spark, SF)
    wanted = result.fetchall()
    assert wanted and sorted(map(tuple, found.select(*names).collect())) == sorted(wanted)
    assert not re.search("Python|Pandas|ArrowEval", found._jdf.queryExecution().toString())


def test_decontamination_of_odd_rows(spark, copies):
    item = " ".join(copies.where("doc_id = 3").first().text.split()[5:45])
    items = spark.createDataFrame([(1, item), (2, None), (3, "two words"), (4, item.upper())], "item_id long, text string")
    for most in (64 << 20, 0):  # broadcast and shuffled sketches
        found = decontaminate.contained_items(copies, items, broadcast_bytes=most).collect()
        assert {(r.doc_id, r.item_id) for r in found} >= {(3, 1), (3, 4)} and all(r.containment >= 0.8 for r in found)
    kept = decontaminate.without_items(copies, items)
    assert kept.columns == copies.columns and kept.where("doc_id = 3").isEmpty()
    assert decontaminate.contained_items(copies, items.limit(0)).collect() == []


def test_patience_alignment():
    pick = random.Random(8)
    for _ in range(200):
        a, b = ([pick.randrange(12) for _ in range(pick.randrange(15))] for _ in range(2))
        pairs = line_dedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
    assert line_dedup.patience([1, 2, 3, 4], [9, 2, 3, 8]) == [(1, 1), (2, 2)]


def test_line_dedup_against_all_pairs(spark, copies):
    docs = {r.doc_id: r.text for r in copies.collect() if r.text is not None}
    split = {i: [x.strip(" ") for x in t.split("\n")] for i, t in docs.items()}
    gone = defaultdict(set)
    for b in docs:
        for a in docs:
            if a < b and any(len(x) >= 20 and x in split[a] for x in split[b]):
                gone[b] |= set(line_dedup.common_blocks(split[a], split[b], [len(x) for x in split[b]], 100))
    found = {r.doc_id: r for r in line_dedup.without_common_blocks(copies, rare=1000).collect()}
    for i, t in docs.items():
        assert found[i].n_removed == len(gone[i])
        assert found[i].text == "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i])
    hot = {r.doc_id: r.n_removed for r in line_dedup.without_common_blocks(copies).collect()}
    assert all(hot[i] for i in range(121, 150))  # the shared line leaves all but the first
    kept = line_dedup.deduped(copies)
    assert kept.columns == copies.columns and {200, 201, 202, 203} <= {r.doc_id for r in kept.collect()}


def brute_line_dedup(docs, least=100):
    """Lines that any two documents have in aligned blocks, all pairs compared."""
    split = {i: [x.strip(" ") for x in t.split("\n")] for i, t in docs.items()}
    gone = defaultdict(set)
    for b in docs:
        for a in docs:
            if a < b:
                gone[b] |= set(line_dedup.common_blocks(split[a], split[b], [len(x) for x in split[b]], least))
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in docs.items()}


def test_blocks_of_frequent_lines_with_other_first_documents(spark):
    line_a, line_b = prose("a", 12), prose("b", 12)
    docs = {0: line_a, 1: line_b} | {i: f"{line_a}\n{line_b}" for i in range(2, 11)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = {r.doc_id: r.text for r in line_dedup.without_common_blocks(df).collect()}
    assert found == brute_line_dedup(docs)
    assert found[2] == docs[2] and all(found[i] == "" for i in range(3, 11))


def test_line_dedup_defaults_against_all_pairs(spark):
    pick = random.Random(12)
    pool = [prose(("line", k), pick.randrange(5, 30)) for k in range(14)] + [""]
    blocks = [[pick.choice(pool) for _ in range(pick.randrange(1, 5))] for _ in range(6)]
    docs = {}
    for i in range(150):  # blocks in any order, repeated too, with own lines between
        parts = [pick.choice(blocks) + [prose((i, k), 8)] * pick.randrange(2) for k in range(pick.randrange(1, 5))]
        docs[i] = "\n".join(x for p in parts for x in p)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = {r.doc_id: r.text for r in line_dedup.without_common_blocks(df).collect()}
    assert found == brute_line_dedup(docs)
    assert sum(found[i] != docs[i] for i in docs) > 50


def test_line_dedup_of_short_lines(spark):
    verse = [prose(("verse", k), 3) for k in range(12)]
    docs = {i: "\n".join([prose((i, 0), 3), *verse, prose((i, 1), 3)]) for i in range(12)}
    docs |= {20: "\n".join(verse), 21: "\n".join(verse[:7]), 22: "\n".join(verse[4:9] + verse[:7])}
    assert all(len(x) < 20 for t in docs.values() for x in t.split("\n"))
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = {r.doc_id: r.text for r in line_dedup.without_common_blocks(df).collect()}
    assert found == brute_line_dedup(docs)
    assert found[20] == "" and all(found[i].count("\n") == 1 for i in range(1, 12))


def test_mixing_meets_targets(spark):
    good, bad = prose("g", 40).split(), prose("b", 40).split()
    pick = random.Random(4)
    rows = [(i, " ".join(pick.choices(bad if i % 4 == 0 else good, k=30))) for i in range(400)] + [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 as rate", "1 as _x")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(0, 400, 2)] + [(1, None, 0)], "doc_id long, quality int, toxic int")
    targets = {"q1t0": 0.9, "q1t1": 0.05}
    found = mixing.mixed_rates(docs, labels, targets).collect()
    assert len(found) == 402 and all(r.rate >= 0 for r in found)
    assert all(r.domain == ("q1t1" if r.doc_id % 4 == 0 else "q1t0") for r in found if r.doc_id < 400)
    total = sum(r.n_tokens for r in found)
    # posteriors are all but certain here, so sums by the likeliest domain show the expected totals
    for domain, share in targets.items():
        assert sum(r.rate * r.n_tokens for r in found if r.domain == domain) / total == pytest.approx(share, abs=0.02)
    assert {r.domain for r in mixing.mixed_rates(docs, labels.limit(0)).collect()} == {"all"}
    assert mixing.mixed_rates(docs.limit(0), labels).collect() == []


def test_mixing_learns_from_whole_texts_that_are_there(spark):
    same = prose("same", 1000)  # 4999 characters
    rows = [(i, f"{same} {prose(('own', i % 2), 40)} {prose(i, 5)}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(4000)], "doc_id long, quality int, toxic int")
    sample, sizes = mixing.labelled_sample(docs, labels, 80)
    assert sizes == {"q1t0": 100, "q1t1": 100}
    assert Counter(d for d, _ in sample) == {"q1t0": 80, "q1t1": 80}
    assert {t for _, t in sample} <= {t for _, t in rows}
    found = mixing.mixed_rates(docs, labels, rows_per_domain=80).collect()
    assert all(r.domain == f"q1t{r.doc_id % 2}" for r in found)


def test_projected_rates_by_brute_force(spark):
    pick = np.random.default_rng(9)
    p, n = pick.dirichlet([0.3, 0.3, 0.3], 60), pick.integers(1, 100, 60)
    df = spark.createDataFrame([(int(k), [float(x) for x in q]) for k, q in zip(n, p, strict=True)], "_n long, _p array<double>")
    targets = np.array([0.9, 0.05, 0.0])
    steps = mixing.fit_rates(df, targets)
    r = np.ones(60)
    for s in steps:
        r = np.maximum(0, r - p @ s)
    got = np.array([x.r for x in df.select(mixing.rate(mixing.F.col("_p"), steps).alias("r")).collect()])
    assert np.allclose(np.sort(got), np.sort(r))
    before, after = ((w * n) @ p / n.sum() - targets for w in (np.ones(60), r))
    assert np.linalg.norm(after) < 0.3 * np.linalg.norm(before)


def least_squares(p, n, targets, rounds=200_000):
    """Rates >= 0 of the least distance of totals from ``targets``: accelerated projected gradient."""
    a = (p * (n / n.sum())[:, None]).T
    step = 1 / np.linalg.norm(a, 2) ** 2
    r, y, k = np.ones(len(n)), np.ones(len(n)), 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * (a.T @ (a @ y - targets)))
        if (y - new) @ (new - r) > 0:
            k = 1.0
        after = (1 + np.sqrt(1 + 4 * k * k)) / 2
        y, r, k = new + (k - 1) / after * (new - r), new, after
        if np.linalg.norm(a @ r - targets) < 1e-9:
            break
    return r


@pytest.mark.parametrize("targets", [[0.7, 0.18, 0.1, 0.02], [0.6, 0.3, 0.09, 0.01], [0.999, 0.001, 0.0, 0.0]])
def test_rates_are_the_least_squares_optimum(spark, targets):
    pick = np.random.default_rng(6)
    p, n = pick.dirichlet([2, 0.6, 0.3, 0.1], 300), pick.integers(1, 500, 300)
    df = spark.createDataFrame([(int(k), [float(x) for x in q]) for k, q in zip(n, p, strict=True)], "_n long, _p array<double>")
    (m,) = mixing.fit_rates(df, np.array(targets))
    off = (np.maximum(0, 1 - p @ m) * n) @ p / n.sum() - targets
    # at the optimum the rates' own gradient vanishes: m is the distance over the ridge
    assert np.allclose(off, 1e-6 * m, atol=1e-8)
    plain, share = least_squares(p, n, np.array(targets)), n / n.sum()
    least = np.linalg.norm((plain * share) @ p - targets)
    assert off @ off <= least**2 + 1e-6 * share @ (plain - 1) ** 2
    assert least > 1e-4 or np.linalg.norm(off) < 1e-4


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "mixing",
    ]
    assert set(docs.columns) < set(out.columns) and 0 < len(rows) < docs.count()
    assert len({r.doc_id for r in rows}) == len(rows) and all(r.rate > 0 for r in rows)
    linked = brute_join([(r.doc_id, r.text) for r in rows], 5, 80)
    assert all(k == v[1] for k, v in linked.items())
    leaks = decontaminate.contained_items(out, spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert leaks.isEmpty()
