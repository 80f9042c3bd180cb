"""Cross-tokenizer alignment against brute force over the libraries' tokens."""

import hashlib
import json
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siltstone.llm import alignment, bpe, queries

SF_DIR = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
KINDS = "doc_id long, text string"
TEXTS = [
    (1, "A text that is not too short, with wörds and 你好 and ½ and \t tabs  and   spaces "),
    (1, "A text that is not too short, with wörds and 你好 and ½ and \t tabs  and   spaces "),
    (2, None),
    (3, ""),
    (None, "no id"),
    (4, "the sign ▁ of a space"),
    (5, "<|endoftext|> and <s> </s> <unk> <0x41> are plain"),
    (6, " "),
    (7, "\n\n  indented\n\0nul ﬁ Ω 👍🏽 é"),
    (8, "internationalisation antidisestablishmentarianism " * 40),
    (9, "a" * 300 + " b c 1 d"),
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    letters = bpe.byte_letters()
    with open(A, encoding="utf-8") as file:
        by_id = {i: t for t, i in json.load(file)["model"]["vocab"].items()}
    b = sentencepiece.SentencePieceProcessor(model_file=B)

    def encode(text):
        """[(id, bytes)] of both; nothing where the bytes differ."""
        if not text:
            return [], []
        left = [(i, bytes(letters[c] for c in by_id[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        want = (" " + text).encode()
        same = all(b"".join(x for _, x in side) == want for side in (left, right))
        return (left, right) if same else ([], [])

    return encode


def ranges(tokens):
    out, at = [], 0
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def linked(encoded):
    """[(a id, b id, a place, b place, shared bytes)] of one text."""
    left, right = (ranges(side) for side in encoded)
    return [
        (i, j, m, n, min(f, h) - max(e, g))
        for m, (i, e, f) in enumerate(left)
        for n, (j, g, h) in enumerate(right)
        if max(e, g) < min(f, h)
    ]


def grouped(encoded):
    left, right = (ranges(side) for side in encoded)
    cuts = sorted({end for _, _, end in left} & {end for _, _, end in right})
    out, since = [], 0
    for cut in cuts:
        out.append(tuple([i for i, s, e in side if since <= s and e <= cut] for side in (left, right)))
        since = cut
    return out


def by_hand(rows, encode):
    encoded = [encode(text) for _, text in rows]
    counts = Counter((i, j) for e in encoded for i, j, *_ in linked(e))
    top = {}
    for (_, j), n in counts.items():
        top[j] = max(n, top.get(j, 0))
    out = []
    for (doc, _), e in zip(rows, encoded, strict=True):
        pairs = [(i, j) for i, j, *_ in linked(e)]
        groups = grouped(e)
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append(
            (
                doc,
                len(e[0]),
                len(e[1]),
                len(groups),
                len(pairs),
                sum(counts[p] == top[p[1]] for p in pairs),
                sum(counts[p] for p in pairs),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
                sum(len(a) * len(b) for a, b in groups),
            )
        )
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("limit", [alignment.CHUNK, 100])
def test_odd_texts(spark, libraries, limit):
    """Also with a chunk for nearly every text, so that all counts cross chunks."""
    docs = spark.createDataFrame(TEXTS, KINDS).repartition(3)
    docs = docs.select("*", *[F.lit("x").alias(n) for n in ("id", "chunk", "links", "a", "total", "slot")])
    got = found(alignment.summary(docs, A, B, limit=limit))
    assert got == by_hand(TEXTS, libraries)
    assert sum(row[1] == 0 for row in got) >= 3


def test_documents(spark, libraries):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.where(F.coalesce(F.length("text"), F.lit(0)) < 4000).collect()]
    few = spark.createDataFrame(rows, KINDS)
    assert found(alignment.summary(few, A, B)) == by_hand(rows, libraries)
    whole = queries.op13_alignment(spark, SF_DIR)
    assert whole.count() == docs.count() and whole.where("n_links < greatest(n_a, n_b)").count() == 0


def test_links(spark, libraries):
    docs = spark.createDataFrame(TEXTS, KINDS)
    got = found(alignment.links(docs, A, B))
    want = [(d, m, n, i, j, s) for d, text in TEXTS for i, j, m, n, s in linked(libraries(text))]
    assert got == sorted(want, key=repr)
    shared = found(alignment.links(docs, A, B, "group").select("doc_id", "id_a", "id_b"))
    want = [(d, i, j) for d, text in TEXTS for a, b in grouped(libraries(text)) for i in a for j in b]
    assert shared == sorted(want, key=repr)
    with pytest.raises(ValueError, match="no links of kind"):
        alignment.links(docs, A, B, "other")


def test_tokens_spell_the_text(spark, libraries):
    docs = spark.createDataFrame(TEXTS[4:], KINDS)
    rows = {r.doc_id: r for r in alignment.tokens(docs, A, B).collect()}
    for doc, text in TEXTS[4:]:
        left, right = libraries(text)
        row = rows[doc]
        assert row.ids_a == [i for i, _ in left] and row.sizes_b == [len(x) for _, x in right]
        want = grouped((left, right))
        assert [row.groups_a.count(g) for g in range(len(want))] == [len(a) for a, _ in want]
        assert [row.groups_b.count(g) for g in range(len(want))] == [len(b) for _, b in want]


ODD = st.text(st.sampled_from(list("abest' \n\t\x85\x1c.,\"0192½²é你<|>_▁-ΩЖ😀́　   ")), max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(ODD | st.sampled_from([t for _, t in TEXTS if t]), min_size=1, max_size=6))
def test_words_have_the_tokens_of_whole_texts(texts):
    both = alignment.pair(A, B)
    a, count_a, b, count_b = both.encode(texts)
    whole = [e.ids for e in both.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert [x.tolist() for x in np.split(a, np.cumsum(count_a)[:-1])] == [w if t else [] for t, w in zip(texts, whole, strict=True)]
    assert [x.tolist() for x in np.split(b, np.cumsum(count_b)[:-1])] == [both.b.encode(t) if t else [] for t in texts]
    assert all(" ".join(alignment.words_of(t)) == t for t in texts)


def test_a_full_lexicon_starts_anew(monkeypatch):
    both = alignment.Pair(A, B)
    texts = ["one two three", "four five", "one six", "x" * 50]
    want = [x.tolist() for x in both.encode(texts)]
    for words, chars in ((3, 1000), (1000, 10)):
        monkeypatch.setattr(alignment, "WORDS", words)
        monkeypatch.setattr(alignment, "LEXICON", chars)
        for _ in range(3):
            assert [x.tolist() for x in both.encode(texts)] == want
            assert len(both.place) == 7


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6), st.integers(1, 6), st.integers(1, 6), st.randoms())
def test_products_are_those_of_dense_matrices(n, m, k, rng):
    def matrix(rows, columns):
        dense = np.array([[rng.randrange(3) for _ in range(columns)] for _ in range(rows)])
        row, column = np.nonzero(dense)
        begin = np.append(0, np.cumsum(np.bincount(row, minlength=rows)))
        return dense, alignment.Rows(begin, column, dense[row, column], columns)

    (x, a), (y, b) = matrix(n, m), matrix(k, m)
    i, j, v = alignment.product(a, alignment.transposed(b))
    dense = np.zeros((n, k), int)
    dense[i, j] = v
    assert (dense == x @ y.T).all() and (np.diff(i * k + j) > 0).all()


def test_blocks_of_rows(monkeypatch):
    sizes_a, sizes_b = np.array([1, 2, 3, 4, 2]), np.array([4, 4, 4])
    m = alignment.incidence(sizes_a), alignment.transposed(alignment.incidence(sizes_b))
    whole = alignment.product(*m)
    monkeypatch.setattr(alignment, "ROWS", 3)
    parts = list(alignment.products(*m))
    assert len(parts) > 2
    assert all((np.concatenate(x) == y).all() for x, y in zip(zip(*parts, strict=True), whole, strict=True))


def test_empty_table(spark):
    assert alignment.summary(spark.createDataFrame([], KINDS), A, B).count() == 0
