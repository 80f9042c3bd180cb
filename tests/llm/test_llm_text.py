"""Encoding, token counts, licenses and shingles against brute force."""

import hashlib
import random
import re
import time
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from siltstone.llm import arrow_text, bpe, licenses, pieces, shingles, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPECIAL = "<|endoftext|>"
ODD = st.text(st.sampled_from(list("abest' \n\t\x85\x1c.,\"0192½²é你日<|>_-ΩЖ😀́　")), max_size=40)


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(PATH)


def encoded(encoder, texts):
    data, offsets = arrow_text.flat(pa.array(texts, pa.string()))
    ids, begin = encoder.block(data, offsets)
    return [ids[a:b].tolist() for a, b in zip(begin[:-1], begin[1:], strict=True)]


@settings(max_examples=60, deadline=None)
@given(st.lists(ODD, min_size=1, max_size=6))
def test_pieces_follow_the_pattern(texts):
    data, offsets = arrow_text.flat(pa.array(texts, pa.string()))
    at = pieces.cut(data, offsets, {SPECIAL.encode(): 0})
    bounds = [*at.tolist(), len(data)]
    got = [data[a:b].tobytes().decode() for a, b in zip(bounds, bounds[1:], strict=False)]
    # The library's white space has no separators of information.
    pattern = regex.compile(public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
    want = []
    for text in texts:
        for i, part in enumerate(text.split(SPECIAL)):
            want += [SPECIAL] * (i > 0) + pattern.findall(part)
    assert got == want


@settings(max_examples=60, deadline=None)
@given(st.lists(ODD | st.sampled_from(["it's we're 's 'll've", f"a {SPECIAL} b{SPECIAL}", "", "a" * 3000, " " * 900]), min_size=1, max_size=5))
def test_encoding_is_the_librarys(encoder, reference, texts):
    want = [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]
    assert encoded(encoder, texts) == want


def test_every_token_is_its_own_encoding(encoder, reference):
    texts = [b.decode("utf-8", "ignore") for b in encoder.v.bytes_of]
    want = [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]
    assert encoded(encoder, texts) == want


def test_stream_in_portions_keeps_little_and_gives_the_same(encoder):
    rng = random.Random(5)
    data = "".join(rng.choice("abcdeinorst") for _ in range(30_000)).encode()
    whole = bpe.Transducer(encoder.v)
    want = [*whole.feed(data), *whole.close()]
    machine, got, most = bpe.Transducer(encoder.v), [], 0
    at = 0
    while at < len(data):
        step = rng.randint(1, 700)
        got += machine.feed(data[at : at + step])
        most = max(most, len(machine.data))
        at += step
    assert got + machine.close() == want
    assert most <= 3 * encoder.v.lookahead + 700
    assert b"".join(encoder.v.bytes_of[t] for t in want) == data


def test_lookahead_settles_boundaries(encoder):
    """What follows beyond the lookahead doesn't change the tokens before."""
    rng = random.Random(6)
    n = encoder.v.lookahead
    head = "".join(rng.choice("aeinrst") for _ in range(200)).encode()

    def ends(data):
        machine = bpe.Transducer(encoder.v)
        sizes = [len(encoder.v.bytes_of[t]) for t in [*machine.feed(data), *machine.close()]]
        return [e for e in np.cumsum(sizes).tolist() if e <= len(head)]

    shared = "".join(rng.choice("aeinrst") for _ in range(n)).encode()
    assert ends(head + shared + b"thing") == ends(head + shared + b"zzz" * 40)


def test_decoder_waits_for_whole_characters(encoder, reference):
    ids = encoded(encoder, ["日本 😀é"])[0]
    machine = bpe.Decoder(encoder.v)
    parts = [machine.feed([i]) for i in ids]
    assert "".join(parts) + machine.close() == "日本 😀é" and "" in parts
    broken = ids[:1]
    assert "".join(bpe.decoded(encoder.v, np.array(broken))) == reference.decode(broken, skip_special_tokens=False)


def test_digests_and_round_trip(spark, reference):
    texts = ["Hello there", None, "", f"x {SPECIAL}", "é" * 50, "Hello there"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs, PATH).collect()}
    for i, text in enumerate(texts):
        ids = reference.encode(text or "", add_special_tokens=False).ids
        back = reference.decode(ids, skip_special_tokens=False)
        want = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), back)]
        assert got[i] == (len(ids), *want)
    back = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert sorted((r.doc_id, r.text) for r in back.collect()) == [(i, t or "") for i, t in enumerate(texts)]


# Token counts -------------------------------------------------------------------


def spans_of(encoder, text):
    sizes = [len(encoder.v.bytes_of[t]) for t in encoded(encoder, [text])[0]]
    ends = np.cumsum(sizes).tolist()
    return [(e - s, e) for s, e in zip(sizes, ends, strict=True)]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_line_counts_by_hand(spark, encoder, rule):
    texts = ["one two\n\nthree\n", "", None, "no break", "a\n\n\n\nb é\n😀", "\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.section): (r.char_start, r.char_end, r.n_tokens) for r in token_counts.attribute(docs, PATH, rule).collect()}
    want = {}
    for i, text in enumerate(texts):
        lines = (text or "").split("\n")
        lines = [x + "\n" for x in lines[:-1]] + lines[-1:]
        char = byte = 0
        bounds = []
        for n, line in enumerate(lines):
            bounds.append((byte, byte + len(line.encode())))
            want[i, n] = [char, char + len(line), 0.0]
            char, byte = char + len(line), byte + len(line.encode())
        for a, b in spans_of(encoder, text or ""):
            held = [max(0, min(b, y) - max(a, x)) for x, y in bounds]
            if rule == "split":
                for n, h in enumerate(held):
                    want[i, n][2] += h / (b - a)
            else:
                pick = next(n for n, h in enumerate(held) if h) if rule == "first" else int(np.argmax(held))
                want[i, pick][2] += 1
    assert got.keys() == want.keys()
    for k, (a, b, n) in got.items():
        assert [a, b] == want[k][:2] and n == pytest.approx(want[k][2])


def test_given_spans(spark):
    docs = spark.createDataFrame(
        [(1, "héllo wörld again", [(0, 5), (6, 11)]), (2, "x", None), (3, None, [(0, 1)]), (4, "abc", [(1, 1)])],
        "doc_id long, text string, s array<struct<start:int,end:int>>",
    )
    got = sorted((r.doc_id, r.section, r.char_start, r.char_end, r.n_tokens) for r in token_counts.attribute(docs, PATH, "split", "s").collect())
    assert [g[:4] for g in got] == [(1, 0, 0, 5), (1, 1, 6, 11), (3, 0, 0, 0), (4, 0, 1, 1)]
    assert got[0][4] > 0 and got[2][4] == got[3][4] == 0


# Licenses -----------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=8), min_size=1, max_size=4),
    st.lists(st.sampled_from("abcx"), max_size=40),
)
def test_matching_statistics(templates, text):
    scan = licenses.Scanner(tuple(("t", " ".join(t)) for t in templates), {})
    words = [w.encode() for w in text]
    got = {place: length for place, _, length in scan.statistics(words)}
    runs = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    for place in range(len(text)):
        longest = max((n for n in range(1, place + 2) if tuple(text[place + 1 - n : place + 1]) in runs), default=0)
        assert got.get(place, 0) == longest


def test_licenses_by_hand(spark):
    gpl = "This work is licensed under the GNU General Public License, version 3."
    texts = [gpl, "the MIT License MIT license", None, "", "ÄMIT License x mit-license", "nothing here", "Licensed under CC BY-NC 4.0."]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, labels string")
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert [(got[i].n_words, got[i].n_base, got[i].first_word, got[i].last_word, got[i].base_labels) for i in range(7)] == [
        (12, 1, 7, 7, "gpl"),
        (5, 2, 1, 3, "mit"),
        (0, 0, None, None, ""),
        (0, 0, None, None, ""),
        (5, 1, 3, 3, "mit"),
        (2, 0, None, None, ""),
        (7, 0, None, None, ""),
    ]
    assert got[0].labels == "gpl,gpl-3.0" and got[6].labels == "cc-by-nc-4.0" and got[5].labels == ""
    assert got[0].score == 1.0 and got[5].score == 0.0
    assert [(s.label, s.first_word, s.last_word) for s in got[6].spans] == [("cc-by-nc-4.0", 0, 6)]


def base_by_hand(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(lower))
    places = []
    for phrase, label in licenses.BASE.items():
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.sampled_from(["MIT", "mit", "License", "license", "apache", "General", "public", "gnu", "ünd", "the", "7", "\x00"]),
        max_size=40,
    ),
    st.sampled_from([" ", "-", "\n", ", ", "\x7f", "/"]),
)
def test_base_places_are_those_of_brute_force(words, between):
    text = between.join(words)
    row = licenses._document(licenses.scanner(), text.encode())
    assert row[:5] == base_by_hand(text)
    assert set(filter(None, row[4].split(","))) <= set(row[5].split(",")) and 0 <= row[6] <= 1
    assert row[6] == 1.0 or not row[1]


def test_scan_of_documents_is_that_of_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = licenses.scan(docs).collect()
    assert len(found) == len(texts) and any(r.n_base for r in found)
    for r in found:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_by_hand(texts[r.doc_id])


def test_every_template_gets_its_label():
    for label, text in licenses.TEMPLATES:
        shouted = "Copyright 2020. " + text.upper() + "; the rest follows"
        row = licenses._document(licenses.scanner(), shouted.encode())
        assert label in row[5].split(","), text
        span = next(s for s in row[7] if s["label"] == label)
        assert (span["first_word"], span["last_word"], span["covered"]) == (2, 1 + len(text.split()), 1.0)


def test_the_larger_notice_labels():
    texts = dict((label, text) for label, text in licenses.TEMPLATES if label in ("lgpl", "agpl", "cc-by-sa-4.0"))
    labels = {k: set(licenses._document(licenses.scanner(), t.encode())[5].split(",")) for k, t in texts.items()}
    assert labels == {"lgpl": {"lgpl", "gpl"}, "agpl": {"agpl", "gpl"}, "cc-by-sa-4.0": {"cc-by-sa-4.0"}}  # gpl: a base phrase


def naive_best(spans):
    chosen = []
    for x in sorted((x for x in spans if x.covered >= licenses.COVERED), key=lambda x: (-x.covered, x.first, x.last, x.label)):
        if all(x.label != c.label or x.last <= c.first or c.last <= x.first for c in chosen):
            chosen.append(x)
    stays = [
        x
        for x in chosen
        if not any(c.label != x.label and c.first <= x.first and x.last <= c.last and c.words > x.words for c in chosen)
    ]
    return [(x.label, x.first, x.last - 1) for x in sorted(stays, key=lambda x: (x.first, x.label))]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 30), st.integers(1, 9), st.sampled_from([0.5, 0.8, 1.0]), st.integers(1, 9)), max_size=25))
def test_chosen_spans(found):
    spans = [licenses.Span(label, first, first + size, covered, words) for label, first, size, covered, words in found]
    assert [(b["label"], b["first_word"], b["last_word"]) for b in licenses.best_spans(spans)] == naive_best(spans)


def test_a_long_repetitive_text_takes_time_in_proportion():
    notice = "released under the MIT license. "
    seconds = []
    for size in (1 << 19, 1 << 21):
        began = time.process_time()
        row = licenses._document(licenses.scanner(), (notice * (size // len(notice))).encode())
        seconds.append(time.process_time() - began)
        assert row[1] == size // len(notice) and row[5] == "mit" and len(row[7]) == size // len(notice)
    assert seconds[1] < 8 * seconds[0] and seconds[1] < 20


def test_changed_notice_is_chained():
    text = "Redistribution and use in source and binary forms, with changes or without modification, are permitted provided that the following conditions hold"
    words = licenses.text_words(text.encode())
    _, spans = licenses.scanner().scan(words)
    best = licenses.best_spans(spans)
    assert [b["label"] for b in best] == ["bsd"] and best[0]["first_word"] == 0


# Shingles -----------------------------------------------------------------------


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB \n\tcé"), max_size=24), min_size=1, max_size=6), st.integers(1, 4))
def test_shingle_hashes_stand_for_shingles(texts, width):
    data, offsets = arrow_text.flat(pa.array(texts, pa.string()))
    rows, starts, ends = shingles.words(data, offsets, shingles.NOT_WHITE)
    rows, values = shingles.distinct(*shingles.shingles(rows, shingles.range_hashes(data, starts, ends, lower=True), width))
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen = {}
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(lower))
        want = {tuple(words[j : j + width]) for j in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
        mine = set(values[rows == i].tolist())
        assert len(mine) == len(want)
        seen[i] = (want, mine)
    for a, b in [(x, y) for x in seen for y in seen]:
        assert len(seen[a][0] & seen[b][0]) == len(seen[a][1] & seen[b][1])


def test_hashing_a_block_takes_little_memory(monkeypatch):
    rng = np.random.default_rng(5)
    data = rng.integers(97, 123, arrow_text.BLOCK_BYTES).astype(np.uint8)
    data[rng.random(len(data)) < 0.15] = 32
    data[500_000:700_000] = 97  # one long word
    _, starts, ends = shingles.words(data, np.array([0, len(data)]), shingles.NOT_WHITE)
    monkeypatch.setattr(shingles, "_powers", [])
    tracemalloc.start()
    try:
        found = shingles.range_hashes(data, starts, ends)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 16 * len(data)
    monkeypatch.setattr(shingles, "PORTION", len(data))
    assert np.array_equal(found, shingles.range_hashes(data, starts, ends))
