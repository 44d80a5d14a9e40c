"""Spelling variants against brute force over the words of a folder."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import catalog, spelling

SF = "/root/testdata/sf0.001"


def words_of(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def brute(rows):
    words = words_of(rows)
    by_rest = defaultdict(set)
    near = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            by_rest[i, w[:i] + w[i + 1 :]].add(w)
            if (v := w[:i] + w[i + 1 :]) in words:
                near[w].add(v)
                near[v].add(w)
    for group in by_rest.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), form[w] and words[form[w]]))
    return out


def test_all_words_of_a_folder(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = catalog.op12_spelling_variants(spark, SF)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in found.collect()]
    wanted = brute(docs)
    assert set(rows) == wanted and len(rows) == len(wanted) > 500
    assert any(r[1] for r in rows) and any(r[4] > 1 for r in rows)


CHAIN = ["abcdefgh"] * 2000 + ["abcdefg"] * 200 + ["abcdefgx"] * 20 + ["bcdefgx"] * 2 + ["éàçñüöß"] * 3 + ["éàçñüöÿ"] * 30
ODD = [
    (1, None), (2, ""), (None, "Straßenbahn straßenbahn Ünlikely ünlikely ÜNLIKELY"), (None, "\x00\n1234567 a_b"),
    *((k, " ".join(CHAIN)) for k in range(30, 34)), (4, "y" * 30_000 + " " + "y" * 30_000 + " x" + "y" * 29_999), (5, "x" + "y" * 29_999),
    (6, "tieaaaa tieaaaa tiebbbb " + "tiebaaa " * 25 + "tieabaa " * 25), (6, "tieaaaa tieaaaa tiebbbb"),
    (7, "łabcdefgł Éabcdefé×÷ Éabcdefé×÷"),
]


@pytest.mark.parametrize("symbols, crowd", [(8, 200), (1, 3), (2, 1), (4, 0)])
def test_odd_rows_and_crowded_codes(spark, symbols, crowd):
    draw = random.Random(symbols)
    mixed = " ".join("".join(draw.choice("abé") for _ in range(draw.randint(7, 8))) for _ in range(900))
    rows = [*ODD, (8, mixed), (9, mixed)]
    df = spark.createDataFrame([(*r, "own", 1) for r in rows], "doc_id long, text string, word string, n int")
    found = [tuple(r) for r in spelling.spelling_variants(df, symbols=symbols, crowd=crowd).collect()]
    wanted = brute(rows)
    assert sorted(map(str, found)) == sorted(map(str, wanted))
    assert any(r[2] not in (r[0], r[1]) for r in found)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id string, text string")
    assert spelling.spelling_variants(df).collect() == []


def test_neighbourhood_is_full():
    """Every reduced word within one edit is a neighbour of one of the two, no other is."""
    draw = random.Random(5)
    words = sorted({"".join(draw.choice("abc") for _ in range(draw.randint(1, 5))) for _ in range(300)})
    own = {}
    for rows, held in spelling.of_equal_length(words):
        own |= {int(h): words[k] for k, h in zip(rows, held.whole[:, 0].view(np.int64), strict=True)}
    import pyarrow as pa

    met = set()
    for batch in spelling.neighbourhoods(3)(iter([pa.record_batch([pa.array(words)], ["reduced"])])):
        for near, code in zip(*(batch.column(c).to_pylist() for c in ("near", "code")), strict=True):
            if near in own:
                pair = tuple(sorted((own[near], own[code])))
                assert pair not in met
                met.add(pair)

    def edits(w):
        yield w
        for i in range(len(w) + 1):
            for c in "abc":
                yield w[:i] + c + w[i:]
                yield w[:i] + c + w[i + 1 :] if i < len(w) else w
            yield w[:i] + w[i + 1 :]

    assert met == {tuple(sorted((w, v))) for w in words for v in edits(w) if v in set(words)}
