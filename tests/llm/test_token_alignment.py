"""Cross-tokenizer alignment against whole texts encoded by the libraries."""

import hashlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import catalog, token_alignment
from tidemark.llm.token_alignment import B_BITS, aligner, byte_letters

SF = "/root/testdata/sf0.001"


def paths():
    return catalog.vocabulary("byte_bpe_50k.json"), catalog.vocabulary()


def plain(text):
    """n_a, n_b, groups (lists of ids), links of a whole text."""
    import sentencepiece
    from tokenizers import Tokenizer

    if not text:
        return 0, 0, [], []
    if not hasattr(plain, "models"):
        a = Tokenizer.from_file(paths()[0])
        a.encode_special_tokens = True
        plain.models = a, sentencepiece.SentencePieceProcessor(model_file=paths()[1]), byte_letters()
    a, b, letters = plain.models
    a_ids = a.encode(" " + text, add_special_tokens=False).ids
    b_ids = b.encode(text)
    a_bytes = [bytes(letters[c] for c in a.id_to_token(k)) for k in a_ids]
    b_bytes = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in b_ids]
    if not b"".join(a_bytes) == b"".join(b_bytes) == b" " + text.encode():
        return 0, 0, [], []
    groups, links, i, j, a_end, b_end, a_begin, b_begin = [], [], 0, 0, 0, 0, 0, 0
    while i < len(a_ids) or j < len(b_ids):
        if a_end <= b_end:
            a_end, i = a_end + len(a_bytes[i]), i + 1
        else:
            b_end, j = b_end + len(b_bytes[j]), j + 1
        if a_end == b_end:
            groups.append((a_ids[a_begin:i], b_ids[b_begin:j]))
            links.append((a_ids[i - 1], b_ids[j - 1]))
            a_begin, b_begin = i, j
    return len(a_ids), len(b_ids), groups, links


def wanted(texts):
    found = [plain(t) for t in texts]
    counts = Counter(link for *_, links in found for link in links)
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for n_a, n_b, groups, links in found:
        said = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append((
            n_a, n_b, len(groups), len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(said.encode()).hexdigest() if n_a else "",
        ))
    return out


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "\n\n a\n b \n", "tab\t x  y 　z", "▁", "a▁b c", "a ▁ b", "x\x00y z",
    "<|endoftext|> <s> </s> <unk> <0x41> x<|endoftext|>y", "naïve Ünïcode 漢字 かな 🙂 👩‍👩‍👧 é é", "it's they'll  we've 'tis",
    "123 4567,89 0.5 --- ... !?", "\x1c \x1d a \x85 b   c", "def f(x):\n    return x  # so\n\n\n", "a" * 20_000, "ab " * 20_000, " " * 5000,
    "​ x ﻿ y", "ﬁne ½ Å", "same text", "same text",
]


@pytest.mark.parametrize("most_pairs", [2_000_000, 0])
def test_odd_rows(spark, most_pairs):
    rows = [(i if i % 7 else None, t, "own", 3) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string, groups string, n_a int")
    found = token_alignment.summary(df, *paths(), most_pairs=most_pairs)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    expected = [(r[0], *w) for r, w in zip(rows, wanted(ODD), strict=True)]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))
    assert token_alignment.summary(df.limit(0), *paths()).collect() == []


def test_all_documents_of_a_folder(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = sorted(map(tuple, catalog.op13_token_alignment(spark, SF).collect()))
    assert found == sorted((i, *w) for (i, _), w in zip(docs, wanted([t for _, t in docs]), strict=True))
    assert all(r[4] for r in found)


TEXTS = st.text(st.sampled_from("aeth \n\t'sd.,1▁é漢  \x1c🙂<|>") | st.characters(codec="utf-8"), max_size=40)


def test_generations_of_known_parts(monkeypatch):
    monkeypatch.setattr(token_alignment, "KEPT_PARTS", 4)
    held = token_alignment.Aligner(*paths())
    texts = ["a b c d e", "a b x y z", "a ▁ b", "a b q r s t", "u v a b"] * 3
    for text in texts:
        found = next(held.texts([text]))
        n_a, n_b, groups, links = plain(text)
        assert found[:3] == (n_a, n_b, len(groups)) and sum(found[4].values()) == len(links)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_parts_equal_whole_texts(text):
    held = aligner(*paths())
    *sizes, groups_said, links = next(held.texts([text]))
    n_a, n_b, groups, wanted_links = plain(text)
    said = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
    assert (*sizes, groups_said) == (n_a, n_b, len(groups), said)
    assert Counter({(k >> B_BITS, k % (1 << B_BITS)): n for k, n in links.items()}) == Counter(wanted_links)


def test_links_of_repeated_parts_are_summed_as_arrays():
    held = aligner(*paths())
    texts = ["the cat the cat the", "", "▁ the", "the"]
    for text, (*found, links, times) in zip(texts, held.summed(texts), strict=True):
        n_a, n_b, groups, wanted_links = plain(text)
        assert found[:3] == [n_a, n_b, len(groups)]
        assert list(links) == sorted(set(links)) and times.sum() == len(wanted_links)
        said = Counter({(int(k) >> B_BITS, int(k) % (1 << B_BITS)): int(n) for k, n in zip(links, times, strict=True)})
        assert said == Counter(wanted_links)
    # a part is kept as bytes: no list of numbers for each of them
    assert all(isinstance(x, bytes) for x in held.links.values())


def test_new_parts_are_encoded_many_to_a_text():
    held = token_alignment.Aligner(*paths())
    encode, sent = held.a.encode_batch_fast, []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            sent.extend(texts)
            return encode(texts, **options)

    held.a = Counted()
    words = [f"w{i:x}{'xyz'[i % 3]}." for i in range(3000)]
    # one part that does not give its bytes back, and parts with white space at an end, among them
    texts = [" ".join(words[:2000]), " ".join([*words[2000:2500], "a▁b", *words[2500:]]), "  w1  \n b ", "\tw2 w3\t"]
    found = list(held.texts(texts))
    for text, (*sizes, groups_said, links) in zip(texts, found, strict=True):
        n_a, n_b, groups, wanted_links = plain(text)
        said = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        assert (*sizes, groups_said) == (n_a, n_b, len(groups), said)
        assert Counter({(k >> B_BITS, k % (1 << B_BITS)): n for k, n in links.items()}) == Counter(wanted_links)
    assert found[0][2] and not found[1][2]
    assert len(sent) < 200
