"""Language ID, chat formatting, licence scan and token counts."""

import hashlib
import random
import re
import time
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import catalog, chat, language_id, license_scan, token_counts
from tidemark.llm.license_rules import rules
from tidemark.llm.template import TemplateError, compile_template, fold, parse

SF = "/root/testdata/sf0.001"
ODD = [
    (1, None, None), (2, "", "en"), (3, "  \n\t ", "en"), (4, "the MIT license; under the mit  license", "en"),
    (5, "cc by nc cc by nc apache license version 2", None), (6, "Ünder\x00the mit license", "de"),
    (7, "1234 ... !!", "en"), (7, "1234 ... !!", "en"), (8, "a" * 30000 + " under the mit license", "en"),
]


@pytest.fixture
def odd(spark):
    rows = [(i, t, x, "n", 1.5) for i, t, x in ODD]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, n_words string, score double"
    ).withColumnRenamed("x", "held_out")


def texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def test_language_accuracy_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = catalog.op1_language_id(spark, folder).collect()
    assert {r.doc_id for r in rows} == set(lang)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.97


def test_language_of_odd_rows(spark, odd):
    found = {r.doc_id: r for r in language_id.identify(odd).collect()}
    assert {i for i, r in found.items() if r.lang_pred == "und"} == {1, 2, 3, 7}
    assert found[1].score == 0
    assert language_id.identify(odd.limit(0)).collect() == []
    kept = language_id.known_languages(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} <= {4, 5, 6, 8}
    unlabelled = odd.where("lang is null")
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}


def brute_kernel(a, b, held):
    """Shared 1- to 3-grams of two chunks by the root of the product of their numbers."""
    sets = []
    for text in (a, b):
        padded = text.lower() + "\0" * language_id.NGRAM
        found = {padded[i : i + n] for n in (1, 2, 3) for i in range(len(padded))}
        sets.append({g for g in found if g in held})
    return len(sets[0] & sets[1]) / (max(1, len(sets[0])) * max(1, len(sets[1]))) ** 0.5


def test_language_kernel_and_map_by_brute_force():
    rows = [("en", "the cat sat on the mat"), ("en", "the dog and the cat"), ("de", "der hund und die katze"),
            ("de", "und der kater"), ("en", "a mat on the dog")]
    model = language_id.fit(rows, landmarks=4)
    chosen = [t for lang in ("de", "en") for t in [x for la, x in rows if la == lang][:2]]
    codes = [t.lower() + "\0" * 3 for t in chosen]
    grams = lambda t: {t[i : i + n] for n in (1, 2, 3) for i in range(len(t))}
    held = {g for t in codes for g in grams(t) if sum(g in grams(u) for u in codes) >= 2}
    present, known = language_id.first_chunks(model, [t for _, t in rows])
    got = model.kernel(present)
    wanted = [[brute_kernel(t, u, held) for u in chosen] for _, t in rows]
    assert np.allclose(got, wanted, atol=1e-6)
    assert all(0 <= k <= 1 for k in known) and model.typical == np.median(known)
    # Nystroem: with all landmarks' own kernel, mapped landmarks give that kernel back
    square = np.array([[brute_kernel(t, u, held) for u in chosen] for t in chosen])
    y = np.array([[1.0 if lang == x else -1.0 for x in ("de", "en")] for lang, _ in rows])
    values, vectors = np.linalg.eigh(square)
    good = values > 1e-8 * values.max()
    mapped = np.array(wanted) @ (vectors[:, good] / np.sqrt(values[good]))
    assert np.allclose(mapped[[2, 3, 0, 1]] @ mapped[[2, 3, 0, 1]].T, square, atol=1e-5)
    fitted = np.linalg.solve(mapped.T @ mapped + 1e-3 * len(rows) * np.eye(mapped.shape[1]), mapped.T @ y)
    assert np.allclose(got @ model.weights, mapped @ fitted, atol=1e-3)


def test_language_of_very_long_texts_in_bounded_runs(monkeypatch):
    rows = [("en", "the cat sat on the mat " * 9), ("de", "der hund und die katze " * 9)]
    model = language_id.fit(rows)
    texts = ["the mat and the cat " * 2000, "die katze und der hund " * 1500, "x", "der " * 3000 + "the " * 999]
    whole = model.predict(texts)
    monkeypatch.setattr(language_id, "RUN", 3)
    for a, b in zip(whole, model.predict(texts), strict=True):
        assert np.allclose(a, b, atol=1e-6)


def test_other_languages_and_junk_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    letters = docs.where(r"text rlike '\\p{L}'").count()
    pick = random.Random(1)
    junk = [" ".join("".join(pick.choices("bcdfghjklmnpqrstvwxz", k=6)) for _ in range(n)) for n in (30, 600)]
    junk += ["Привет мир, это текст на русском языке. " * n for n in (1, 90)] + ["日本語の文章です。" * 40]
    rows = spark.createDataFrame([(-i - 1, t, None) for i, t in enumerate(junk)], docs.schema)
    kept = language_id.known_languages(docs.union(rows)).collect()
    assert min(r.doc_id for r in kept) >= 0 and len(kept) == letters


def test_chat_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    result = con.execute(catalog.oracle_sql()["op2_chat_format"])
    names = [c[0] for c in result.description]
    found = catalog.op2_chat_format(spark, SF)
    assert sorted(found.columns) == sorted(names)
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(result.fetchall())


def test_chat_of_odd_rows_in_small_parts(spark):
    rows = [
        (1, 2, "user", "x\\n<|im_end|>\n\\<|"), (1, None, None, "first"), (1, 3, "assistant", None),
        (1, 3, "assistant", "<|im_end|><|im_start|>assistant ok"), (None, 1, "us\ner<|", ""), (1, 4, "assistant", "é" * 50),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as part")
    whole = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    parts = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df, part_chars=5)).collect()}
    assert whole == parts
    said = ["", "<|im_end|><|im_start|>assistant ok", "é" * 50]
    turns = [("", "first"), ("user", rows[0][3]), *(("assistant", s) for s in said)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert whole[1].n_turns == 5 and whole[1].loss_chars == len("".join(said))
    assert whole[1].loss_sha256 == sha("".join(said))
    assert whole[1].turns_sha256 == sha("".join(f"{r}\n{t}\n" for r, t in turns))
    assert whole[None].turns_sha256 == sha("us\ner<|\n\n")
    assert chat.format_conversations(df.limit(0)).collect() == []


@given(st.text(alphabet="\\<|>ab\nim_end", max_size=30))
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert chat.unescape_role(chat.escape_role(text)) == text
    assert "<|" not in chat.escape(text) and "\n" not in chat.escape_role(text)


def test_template_language():
    run = lambda t, m=(), **v: "".join(p for p, _ in compile_template(t, {"up": str.upper})(m, v))
    messages = [{"role": "a", "text": "x"}, {"role": "b", "text": "y"}]
    loop = "{% for m in messages %}{{ m.text|up }}{% if not loop.last %}, {%- endif %}{% endfor %}"
    assert run(loop, messages) == "X,Y"
    assert run("{{ 'a' ~ 1 ~ none }}{# no #}{% if 'b' in 'abc' and x == 2 %}y{% elif true %}z{% else %}w{% endif %}", x=2) == "a1y"
    assert parse("{{ 'a' ~ 'b' }}c", {})[1] != [("text", "abc")]
    assert fold(parse("{{ 'a' ~ 'b' }}c{% if false %}d{% endif %}", {})[1], {}) == [("text", "abc")]
    assert run("{{ x.__class__ }}", x="s") == ""  # keys of mappings only
    marked = compile_template("a{% generation %}b{% endgeneration %}")([], {})
    assert list(marked) == [("a", False), ("b", True)]
    for bad in ("{% if x %}", "{% endfor %}", "{{ x( }}", "{{ x|no }}", "{% for m in x %}{% endfor %}", "{{ import }} {% foo %}"):
        with pytest.raises(TemplateError):
            compile_template(bad)


def brute_licenses(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = []
    for phrase, label in license_scan.PHRASES.items():
        parts = phrase.split()
        places += [(k, label) for k in range(len(words)) if words[k : k + len(parts)] == parts]
    starts = [k for k, _ in places]
    labels = ",".join(sorted({x for _, x in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


def test_license_base_columns(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    both = docs.union(odd.selectExpr("doc_id + 1000000", "text"))
    given_rows = sorted((r.doc_id, *brute_licenses(r.text)) for r in both.collect())
    found = license_scan.summary(license_scan.scan_licenses(both)).collect()
    got = sorted((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found)
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(given_rows, key=key)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in found)
    assert all(r.score == 0 for r in found if not r.labels) and all(0 <= r.score <= 1 for r in found)
    assert license_scan.scan_licenses(odd.limit(0)).collect() == []


def test_license_rules_and_suppression():
    table = rules()
    assert 200 <= len(table) and [r.priority for r in table] == sorted(r.priority for r in table)
    gate = license_scan.Gate(table)
    found = license_scan.resolve(gate.detections(b"licensed under cc by-nc 4.0. all rights reserved."))
    kept = {d["label"] for d in found if d["kept"]}
    assert kept == {"cc-by-nc-4", "all-rights-reserved"}
    assert any(d["label"] == "cc-by" and not d["kept"] for d in found)
    for rule in table:  # the gate never hides a match of the rule's own words
        plain = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)\??|\[sc\]|\\w\*|\\d\\d| \?", lambda m: m[1] or {"[sc]": "c", "\\d\\d": "19"}.get(m[0], " "), rule.source)
        for m in [plain.encode()] if rule.pattern.search(plain.encode()) else []:
            assert all(g in m for g in rule.gates), rule


def brute_resolve(found):
    """Detections by priority, length, place and label; each against all accepted before it."""
    kept, out = [], []
    for d in sorted(set(found), key=lambda d: (d[0], d[1] - d[2], d[1], d[3])):
        inside = any(b <= d[1] and d[2] <= e for _, b, e, _ in kept)
        kept += [] if inside else [d]
        out.append((*d, not inside))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9), st.integers(1, 6), st.sampled_from("ab")), max_size=12))
def test_license_suppression_by_brute_force(places):
    found = [(p, b, b + n, x) for p, b, n, x in places]
    got = [(d["priority"], d["begin"], d["end"], d["label"], d["kept"]) for d in license_scan.resolve(found)]
    assert got == brute_resolve(found)


def test_license_suppression_of_very_many_places():
    found = [(i % 4, 10 * i, 10 * i + 8 + i % 5, "x") for i in range(200_000)]
    began = time.perf_counter()
    assert len(license_scan.resolve(found)) == len(found)
    assert time.perf_counter() - began < 20


def test_token_counts_match_the_library(spark, odd):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=catalog.vocabulary())
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(odd.select("doc_id", "text"))
    wanted = sorted((r.doc_id, len((r.text or "").encode()), len(model.encode(r.text or ""))) for r in docs.collect())
    found = token_counts.count_tokens(docs, catalog.vocabulary(), batch_bytes=5000).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in found) == wanted
    assert all(r.over_limit == (r.n_tokens > 4096) for r in found)
    assert token_counts.count_tokens(odd.limit(0), catalog.vocabulary()).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "▁", "\n", "a", "the", "é", "\t", "<s>", " ▁", "\x00"]), max_size=9))
def test_safe_boundaries(parts):
    held = token_counts.counter(catalog.vocabulary())
    text = "".join(parts)
    assert held.safe and held.counts([text]) == held.encode([text])


def test_token_counts_with_the_other_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    model = Tokenizer.from_file(path)
    docs = spark.createDataFrame([(1, "a b  c"), (2, None)], "doc_id long, text string")
    found = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, path).collect()}
    assert found == {1: len(model.encode("a b  c", add_special_tokens=False).ids), 2: 0}
