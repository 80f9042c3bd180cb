"""Sharding, mixing, near duplicates, passages, quality and searches against brute force."""

import itertools
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.llm import components, hnsw, minhash, mixing, oracle, quality, queries, sharding, substrings, topk

DIR = "/root/testdata/sf0.001"
WORDS = [a + b + c for a in "btk" for b in "aeiou" for c in ("n", "r", "st", "l")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def canonical(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([r[i] for i in order]) for r in records)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_against_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DIR}/{table}.parquet'")
    found = duck.execute(oracle.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    df = queries.queries()[name](spark, DIR)
    assert canonical(df.collect(), df.columns) == canonical(found.fetchall(), columns)


# Sharding -----------------------------------------------------------------------


def test_table_is_filled_in_turns():
    names, size = sharding.shard_names(7), 97
    table = sharding.fill_table(names, size)
    counts = Counter(table)
    assert set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    heavy = Counter(sharding.fill_table(names[:2], 1009, [1.0, 0.25]))
    assert heavy[0] / heavy[1] == pytest.approx(4, rel=0.05)


def test_removing_a_shard_moves_little():
    names = sharding.shard_names(20)
    before = sharding.fill_table(names, 2003)
    after = sharding.fill_table(names[:-1], 2003)
    stayed = [b == a for b, a in zip(before, after, strict=True) if b != 19]
    assert sum(stayed) / len(stayed) > 0.85


@pytest.mark.parametrize("size", [98, 3])
def test_table_sizes_are_checked(size):
    with pytest.raises(ValueError):
        sharding.fill_table(sharding.shard_names(5), size)


# Mixing -------------------------------------------------------------------------


def filled(sizes, weights, share=1.5, cap=2):
    """Shares by handing out again what is above the caps, until nothing is."""
    total = share * sum(sizes)
    share_of, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        left = total - sum(share_of[i] for i in range(len(sizes)) if i not in open_)
        weight = sum(weights[i] for i in open_)
        above = {i for i in open_ if left * weights[i] / weight > cap * sizes[i]}
        for i in above or open_:
            share_of[i] = cap * sizes[i] if above else left * weights[i] / weight
        open_ -= above or set(open_)
    return share_of


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), min_size=1, max_size=5), min_size=1, max_size=6))
def test_targets_are_met(spark, sources):
    docs = [(f"s{i}" if i else None, "w " * n) for i, sizes in enumerate(sources) for n in sizes]
    frame = spark.createDataFrame([(k, *d) for k, d in enumerate(docs)], "doc_id long, source string, text string")
    got = mixing.mixture(frame).collect()
    names = [f"s{i}" for i in range(1, len(sources))] + [None]
    sizes = [sum(sources[i]) for i in [*range(1, len(sources)), 0]]
    want = dict(zip(names, filled(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))]), strict=True))
    taken = Counter()
    for r in got:
        source = docs[r.doc_id][0]
        assert r.target == pytest.approx(want[source])
        assert 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= 0.5 + 1e-6


def test_training_order(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randint(1, 30)), f"s{i % 4}", 7) for i in range(80)] + [(5, "a  b c", "s9", 7)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    out = mixing.training_order(docs).collect()
    again = mixing.training_order(docs.repartition(5)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    taken = sum(r.taken for r in mixing.mixture(docs).collect())
    assert sum(len(r.text.split()) for r in out) == taken
    texts = {(r[0], r[2]): r[1] for r in rows}
    for r in out:
        whole = texts[r.doc_id, r.source]
        assert whole.startswith(r.text.rstrip()) and r.n_chars == (7 if r.text == whole else len(r.text))


def test_schedules_meet_their_integrals():
    """Positions follow from D(t) = T * (t + a * (t * t - t)), whose inverse is used."""
    for a in (-0.5, 0.0, 0.5):
        for t in np.linspace(0, 1, 11):
            u = t + a * (t * t - t)
            back = u if abs(a) < 1e-9 else 2 * u / ((1 - a) + math.sqrt((1 - a) ** 2 + 4 * a * u))
            assert back == pytest.approx(t)


# Components and near duplicates -------------------------------------------------


def joined(edges):
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(4)
    edges = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(500, i) for i in range(200)],
        "random": [(rng.randint(0, 99), rng.randint(0, 99)) for _ in range(70)],
        "none": [],
    }[kind]
    edges = [(a, b) for a, b in edges if a != b]
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == joined(edges)


def grouped(rows, near):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        runs = {tuple(w[j : j + near.width]) for j in range(len(w) - near.width + 1)}
        sets[i] = runs or ({tuple(w)} if w else set())
    ids = sorted(sets)
    edges = []
    for x in ids:
        for y in ids:
            common = len(sets[x] & sets[y])
            if x < y and common and 100 * common >= near.percent * (len(sets[x]) + len(sets[y]) - common):
                edges.append((x, y))
    labels = joined(edges)
    return {i: (len(sets[i]), labels.get(i, i)) for i in ids}


def edited(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(WORDS).upper()
    return " ".join(words)


@pytest.mark.parametrize("near", [minhash.Near(3, 85), minhash.Near(5, 80), minhash.Near(3, 85, chunk_errors=0)])
def test_near_duplicates_against_all_pairs(spark, near):
    rng = random.Random(8)
    texts = []
    for _ in range(12):
        base = prose(rng, rng.choice([1, 2, 4, 60, 120, 300]))
        texts += [edited(rng, base, rng.randint(0, 4)) for _ in range(rng.choice([1, 3, 12]))]
    # A large group of near copies, of which some only reach each other through others.
    base = prose(rng, 150)
    texts += [edited(rng, base, rng.randint(1, 5)) for _ in range(60)] + [base] * 5 + [None, "", "  \n", "one", "one"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(*r, True) for r in rows], "doc_id long, text string, kept boolean")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, near).collect()}
    want = grouped(rows, near)
    assert got == {i: (n, c, i == c) for i, (n, c) in want.items()}
    kept = minhash.keep_one(docs, near)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if i == c)


def test_near_duplicates_stored_twice_in_mixed_buckets(spark):
    rng = random.Random(9)
    near = minhash.Near(width=1, percent=85)
    core = [f"c{i}" for i in range(95)]
    # Every bucket of a pair also holds texts of smaller id that are linked to neither.
    rows = [
        (f"0{i:02}", " ".join([*rng.sample(core, 80), *(f"r{i}x{j}" for j in range(20))])) for i in range(60)
    ]
    for pair in ("p", "q"):
        rows += [(pair + side, " ".join([*core, *(f"{pair}{side}{j}" for j in range(5))])) for side in "ab"]
    rows.append(("z", prose(rng, 40)))
    want = grouped(rows, near)
    assert want["pb"][1] == "pa" and want["059"][1] == "059"
    docs = spark.createDataFrame(rows + rows, "doc_id string, text string")
    found = minhash.near_duplicates(docs, near).collect()
    assert len(found) == 2 * len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want


def test_rows_of_one_id_are_one_document(spark):
    """Unlike texts under one id, some of them linked to others: one component for the id, a text of it stays."""
    rng = random.Random(10)
    a, b, c, d, e = (prose(rng, 80) for _ in range(5))
    rows = [(3, a), (7, a), (7, b), (9, b), (11, c), (20, d), (15, d), (15, e), (16, e), (15, c + " end"), (30, ""), (30, a)]
    rows += [(40 + i, prose(rng, 30)) for i in range(5)] + [(2, None), (2, None), (42, prose(rng, 30))]
    named = [(f"{k:02}", text) for k, (_, text) in enumerate(rows)]
    near = minhash.Near(3, 85)
    of_text = grouped(named, near)
    edges = [(i, j) for k, (i, t) in enumerate(rows) for m, (j, u) in enumerate(rows) if t and u and of_text[f"{k:02}"][1] == of_text[f"{m:02}"][1] and i != j]
    labels = joined(edges)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, near).collect())
    want = [
        (i, of_text[f"{k:02}"][0], labels.get(i, i) if text else i) for k, (i, text) in enumerate(rows)
    ]
    assert found == sorted(want)
    assert labels[7] == labels[9] == labels[30] == 3 and labels[20] == labels[16] == 11
    stays = {r.doc_id for r in minhash.keep_one(docs, near).collect()}
    assert stays == {i for i, _ in rows} - {i for i in labels if labels[i] != i}


def test_pigeonhole_finds_every_signature_within_the_distance(spark):
    """All pairs within the distance share a key, whatever symbols differ."""
    near, rng = minhash.Near(3, 85), np.random.default_rng(9)
    names = minhash.SIGNATURE
    first = rng.integers(-(2**63), 2**63 - 1, len(names), dtype=np.int64)
    rows = [(0, *first.tolist())]
    for i in range(1, 60):
        changed = first.copy()
        for symbol in rng.choice(minhash.SYMBOLS, near.distance, replace=False):
            lane = int(symbol) % minhash.PER_LONG * minhash.SYMBOL_BITS
            changed[symbol // minhash.PER_LONG] ^= np.uint64(int(rng.integers(1, 2**16)) << lane).astype(np.int64)
        rows.append((i, *changed.tolist()))
    frame = spark.createDataFrame(rows, ["id", *names])
    keys = {r.id: set(r.k) for r in frame.select("id", minhash.index_keys(near).alias("k")).collect()}
    assert all(keys[0] & keys[i] for i in range(1, 60))
    pairs = frame.alias("x").join(frame.alias("y"), F.col("x.id") < F.col("y.id")).where("x.id = 0")
    distances = {r.d for r in pairs.select(minhash.signature_distance("x", "y").alias("d")).collect()}
    assert distances == {near.distance}


# Passages -----------------------------------------------------------------------


def test_cuts_resist_shifts():
    rng = random.Random(10)
    text = prose(rng, 3000).encode()
    how = substrings.Chunking()

    def pieces(data):
        data = np.frombuffer(data, np.uint8)
        _, starts = substrings.chunks(data, np.array([0, len(data)]), how)
        return [bytes(data[a:b]) for a, b in zip(starts, [*starts[1:], len(data)], strict=True)]

    whole = pieces(text)
    assert b"".join(whole) == text and 4 < 3000 / len(whole) < 9
    moved = pieces(text[:5000] + b"an insertion " + text[5000:])
    assert len(set(whole) - set(moved)) <= 3


def test_gear_hash_rolls():
    data = np.frombuffer(b"some bytes to roll over, and some more", np.uint8)
    h, want = 0, []
    for b in data:
        h = (2 * h + int(substrings.GEAR[b])) % (1 << 16)
        want.append(h)
    assert substrings.gear_hashes(data).tolist() == want


def test_passages_are_found_and_removed(spark):
    rng = random.Random(11)
    passage, other = prose(rng, 60), prose(rng, 80) + " é日本"
    texts = [prose(rng, rng.randint(20, 200)) for _ in range(30)]
    for i in (3, 7, 19):
        cut = len(texts[i]) // 2
        texts[i] = texts[i][:cut] + " " + passage + " " + texts[i][cut:]
    texts[11] = other + "\n" + texts[11] + "\n" + other
    texts += [texts[2], None, "", "日本" * 4000]
    rows = [(i, t, len(t or ""), "x") for i, t in enumerate(texts)] + [(2, texts[2], len(texts[2]), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, _found string")
    found = substrings.passages(docs).collect()
    holders = {r.doc_id for r in found}
    assert holders == {7, 19, 11, 30} and {r.first_id for r in found if r.doc_id in (7, 19)} == {3}
    clean = substrings.remove_repeats(docs)
    assert clean.columns == docs.columns
    after = {r.doc_id: r for r in clean.collect()}
    assert clean.count() == len(rows)
    assert [i for i in after if after[i].text and passage in after[i].text] == [3]
    assert after[11].text.count(other) == 1 and after[30].text == "" and after[31].text is None
    for i, text in enumerate(texts):
        if i not in holders:
            assert after[i].text == text
        elif text:
            assert after[i].n_chars == len(after[i].text)


# Quality ------------------------------------------------------------------------


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    drawn = {r.doc_id for r in quality.resample(docs, labels).collect()}
    held = quality.labelled_sample(labels).where(~F.col("fits")).collect()
    good = [r.doc_id in drawn for r in held if r.good]
    bad = [r.doc_id in drawn for r in held if not r.good]
    assert sum(good) / len(good) >= 0.99 and sum(bad) / len(bad) <= 0.05
    kept = quality.keep_good(docs, labels)
    assert {r.doc_id for r in kept.select("doc_id").collect()} == drawn and kept.columns == docs.columns


def gram_counts(text):
    """Hashed n-grams of one text, as the library cuts and hashes them."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return np.bincount(quality.ngrams(raw, np.array([0, len(raw)]))[1], minlength=quality.BUCKETS)


def test_ngrams_are_tokens_and_pairs():
    def buckets(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        return sorted(quality.ngrams(raw, np.array([0, len(raw)]))[1].tolist())

    single = {w: buckets(w)[0] for w in ("ab", "cd", ",", "ünd", "7x")}
    got = buckets("ab, cd\tünd 7x ab")
    assert len(got) == 6 + 5
    for word, times in (("ab", 2), ("cd", 1), (",", 1), ("ünd", 1), ("7x", 1)):
        assert got.count(single[word]) >= times
    pair = {single["ab"], single["cd"]}
    assert len(set(buckets("ab cd")) - pair) == 1 and buckets("ab cd") != buckets("cd ab")
    assert set(buckets("ab ab")) - pair == set(buckets("cd cd")) - pair


def test_resampling_is_that_of_brute_force(spark):
    """Weights, noise, cut and top-k by hand; rows that share ids or have none are drawn one by one."""
    rng = random.Random(21)
    good_words, bad_words = [f"good{i}" for i in range(40)], [f"bad{i}" for i in range(40)]
    rows = []
    for i in range(400):
        words = good_words if i % 3 else bad_words
        rows.append((i, " ".join(rng.choice(words if rng.random() < 0.8 else good_words + bad_words) for _ in range(30))))
    rows += [(None, rows[3][1])] * 5 + [(None, rows[4][1])] * 5 + [(7, rows[6][1]), (6, rows[7][1]), (9, rows[9][1]), (8, None)]
    rows += [(50, rows[51][1]), (51, rows[50][1])]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _w string").repartition(3)
    known = [(i, int(i % 3 > 0)) for i in range(0, 300)] + [(7, None), (None, 1)]
    labels = spark.createDataFrame(known, "doc_id long, quality int")

    sample = {r.doc_id: r for r in quality.labelled_sample(labels).collect()}
    assert set(sample) == set(range(300)) and all(r.good == (r.doc_id % 3 > 0) for r in sample.values())
    raw = sum(gram_counts(t) for _, t in rows)
    target = sum(gram_counts(t) for i, t in rows if i in sample and sample[i].good and sample[i].fits)
    expected = raw * (target.sum() / raw.sum())
    ratios = np.log((target + quality.PRIOR) / (expected + quality.PRIOR))
    weight = [float((gram_counts(t) * ratios).sum()) for _, t in rows]
    held = {}
    for (i, _), w in zip(rows, weight, strict=True):
        if i in sample and not sample[i].fits:
            held[i] = min(w, held.get(i, w))
    good, bad = ([w for i, w in held.items() if sample[i].good is kind] for kind in (True, False))
    cuts = [-math.inf, *[(a + b) / 2 for a, b in itertools.pairwise(sorted({*good, *bad}))]]
    errors = {
        c: sum(w < c for w in good) / len(good) + sum(w >= c for w in bad) / len(bad)
        for c in cuts
        if sum(w < c for w in good) <= quality.LOST * len(good)
    }
    cut = min(c for c in errors if errors[c] == min(errors.values()))
    noise = {r.doc_id: r.n for r in docs.select("doc_id", quality.gumbel(F.col("doc_id")).alias("n")).collect()}
    keys = [w + noise[i] for (i, _), w in zip(rows, weight, strict=True)]
    k = sum(w >= cut for w in weight)
    least = sorted(keys, reverse=True)[k - 1]
    want = sorted(((r, key) for r, key in zip(rows, keys, strict=True) if key >= least - 1e-9), key=repr)
    assert 0 < len(want) < len(rows)

    drawn = sorted((r.doc_id, round(r.key, 6)) for r in quality.resample(docs, labels).where("doc_id >= 0").collect())
    assert drawn == sorted((i, round(key, 6)) for (i, _), key in want if i is not None)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted((r for r, _ in want), key=repr)


def test_noise_is_gumbels(spark):
    noise = spark.range(20_000).agg(F.avg(quality.gumbel(F.col("id"))), F.var_samp(quality.gumbel(F.col("id")))).first()
    assert noise[0] == pytest.approx(0.5772, abs=0.03) and noise[1] == pytest.approx(math.pi**2 / 6, abs=0.08)


def test_cuts():
    good, bad = np.array([5.0, 6.0, 7.0] * 100), np.array([1.0, 2.0] * 100)
    assert quality.best_cut(good, bad) == 3.5
    # One good document in 300 that weighs like a bad one doesn't drag the cut down; bad ones have a say.
    assert quality.best_cut(np.append(good, -9.0), bad) == 3.5
    assert quality.best_cut(np.append(good, [-9.0] * 100), bad) < -9
    assert quality.best_cut(good, np.append(bad, 6.5)) == 3.5
    assert quality.best_cut(good, np.array([])) == quality.best_cut(np.array([]), bad) == -math.inf


# Searches -----------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")


ODD_VECTORS = [
    (1000, None, 1),
    (1020, [], 1),
    (1040, [1.0, None, 1.0, 0.0], 1),
    (1060, [float("nan"), 1.0, 1.0, 1.0], 1),
    (1080, [float("inf"), 1.0, 1.0, 1.0], 1),
    (1100, [1.0, 2.0], 1),
    (1101, [2.0, 2.0], 1),
    (None, [1.0, 1.0, 1.0, 1.0], 1),
]


def by_hand(rows, k, convert, zero=True):
    sound = [(i, [convert(np.float32(x).item()) for x in v]) for i, v, _ in rows if i is not None and v and None not in v and all(map(math.isfinite, v))]
    sound = [(i, v) for i, v in sound if zero or any(v)]
    out = {}
    for i, v in {i: v for i, v in sound if i % 20 == 0}.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in sound if j != i and len(w) == len(v))
        out[i] = [(j, -s) for s, j in scores[:k]]
    return out


@pytest.mark.parametrize("kind", ["normal", "lengths", "ties", "clusters"])
def test_exact_search(spark, kind, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 50)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(12)
    x = rng.normal(size=(400, 4))
    if kind == "lengths":
        x *= np.exp(rng.normal(size=(400, 1)) * 2)
    elif kind == "ties":
        x = np.where(np.arange(400)[:, None] % 3 == 0, 0.5, np.round(x))
    elif kind == "clusters":
        x = np.repeat(x[:20], 20, axis=0) + 0.01 * x
    rows = [(i, x[i].tolist(), 0) for i in range(400)] + ODD_VECTORS
    got = {}
    for r in topk.top_k(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = by_hand(rows, 5, lambda v: math.floor(64 * v))
    assert got == {i: w for i, w in want.items() if w}


def test_exact_search_of_large_numbers(spark):
    """Beyond 2**28, beyond 2**53, and scores next to 2**63: all exact, in one block and over several."""
    rows = [
        (20, [1e7, 1.0], 0),
        (1, [1.0, 2.0], 0),
        (2, [2.0, 1.0], 0),
        (40, [2.0**25, 1.0], 0),
        (3, [2.0**25 - 1, 0.0], 0),
        (4, [-(2.0**25), 63 / 64], 0),
        (60, [0.0, 1e290], 0),
        (5, [1.0, 0.0], 0),
    ]
    doubles = spark.createDataFrame([r[:2] for r in rows], "vec_id long, embedding array<double>")

    def wanted(k):
        whole = {i: [math.floor(64 * x) for x in v] for i, v, _ in rows}
        out = {}
        for i in (20, 40):
            scores = sorted((-sum(map(int.__mul__, whole[i], v)), j) for j, v in whole.items() if j not in (i, 60))
            out[i] = [(j, -s) for s, j in scores[:k]]
        return out

    def found(df, k):
        got = {}
        for r in topk.top_k(df, F.col("vec_id").isin(20, 40), k=k).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        return got

    small = doubles.where("vec_id <> 60")
    assert found(small, 6) == wanted(6)
    assert dict(found(small, 6)[20])[1] == 64 * 64 * 10**7 + 64 * 128
    # A score beyond 64 bits stops the query if it is among the best, and only then.
    with pytest.raises(Exception, match="no 64-bit number"):
        found(doubles, 2)
    low = small.union(spark.createDataFrame([(9, [-1e200, 0.0])], small.schema))
    assert found(low, 5) == wanted(5)
    with pytest.raises(Exception, match="beyond the range of doubles"):
        found(small.union(spark.createDataFrame([(9, [1e307, 0.0])], small.schema)), 2)


def test_products_of_any_size():
    rng = np.random.default_rng(3)
    for power in (3, 27, 31, 40, 70):
        q = np.floor(rng.normal(size=(5, 3)) * 2.0**power)
        c = np.floor(rng.normal(size=(7, 3)) * 2.0 ** rng.integers(0, power, (7, 1)))
        want = [[sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for y in c] for x in q]
        assert [[int(v) for v in row] for row in topk.products(q, c)] == want


def test_searches_refuse_other_ids(spark):
    named = spark.createDataFrame([("a", [1.0])], "vec_id string, embedding array<double>")
    for search in (topk.top_k, hnsw.nearest):
        with pytest.raises(TypeError, match="ids must be of type bigint or int"):
            search(named, F.lit(True))


def test_coordinate_pruning_loses_nothing():
    rng = np.random.default_rng(13)
    c = rng.integers(-50, 50, (500, 6))
    norm = np.sqrt((c.astype(float) ** 2).sum(1))
    q = c[7] / norm[7]
    for cosine in (0.8, 0.9, 0.99):
        near = np.flatnonzero(c @ q >= cosine * norm)
        assert set(near) <= set(topk._by_coordinates(q, cosine, c, norm))


def test_recall_of_full_shards(spark):
    """A full shard each of vectors of one length, of spread lengths, and with copies in a third of the rows."""
    rng = np.random.default_rng(16)
    n = hnsw.SHARD
    kinds = {}
    for dim in (64, 65, 66):
        x = rng.normal(size=(n, dim)).astype(np.float32)
        if dim == 65:
            x *= np.exp(rng.normal(size=(n, 1)) / 2).astype(np.float32)
        elif dim == 66:
            x[::3] = x[0]
        kinds[dim] = x
    ids = {dim: 10_000_000 * k + np.arange(n) for k, dim in enumerate(kinds)}
    rows = [(int(i), v.tolist()) for dim, x in kinds.items() for i, v in zip(ids[dim], x, strict=True)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(8)
    got = {}
    for r in hnsw.nearest(table, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append(r.score)
    for dim, x in kinds.items():
        x = x.astype(np.float64)
        asked = np.flatnonzero(ids[dim] % 20 == 0)
        scores = x[asked] @ x.T
        scores[np.arange(len(asked)), asked] = -np.inf
        least = np.partition(scores, -20, axis=1)[:, -20]
        hits = [sum(s >= at - 1e-9 for s in got[int(i)]) for i, at in zip(ids[dim][asked], least, strict=True)]
        print(f"recall {dim}: {np.mean(hits) / 20:.4f}")
        assert np.mean(hits) / 20 >= 0.95


@pytest.mark.parametrize("lengths", [False, True])
def test_graph_search(spark, lengths):
    rng = np.random.default_rng(14)
    x = rng.normal(size=(1500, 16)) * (np.exp(rng.normal(size=(1500, 1))) if lengths else 1)
    x[::3] = x[0]
    rows = [(i, x[i].tolist(), 0) for i in range(1500)] + ODD_VECTORS + [(1520, [0.0] * 16, 1)]
    found = hnsw.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=10, shard_rows=600)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = by_hand(rows, 10, float, zero=False)
    assert got.keys() == {i for i, w in want.items() if w}
    # Copies may stand in for each other: products are compared.
    hits = sum(sum(g >= w[-1][1] - 1e-6 for _, g in got[i]) for i, w in want.items() if w)
    assert hits / sum(len(w) for w in want.values()) >= 0.9
    for i, found in got.items():
        scores = dict(by_hand([(i, rows[i][1] if i < 1500 else dict((r[0], r[1]) for r in rows)[i], 0)] + [r for r in rows if r[0] in dict(found)], 10, float)[i])
        assert all(scores[j] == pytest.approx(s, abs=1e-9) for j, s in found)


def test_graph_search_past_copies(spark):
    rng = np.random.default_rng(15)
    x = rng.normal(size=(3000, 24)) + 1
    x[::3] = x.mean(axis=0)
    rows = [(i, x[i].tolist(), 0) for i in range(3000)]
    # A repeated query counts once, a repeated candidate each time, -0.0 is 0.0.
    rows += [(20, x[20].tolist(), 0)] * 12 + [(3001, [0.0, 9.0], 0)] * 3 + [(3020, [-0.0, 9.0], 0), (3002, [-0.0, 9.0], 0)]
    found = hnsw.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=10)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = by_hand(rows, 10, float, zero=False)
    assert got.keys() == want.keys()
    assert [i for i, _ in got[3020]] == [3001, 3001, 3001, 3002]
    hits = {i: sum(g[0] in dict(w) for g in got[i]) / len(w) for i, w in want.items()}
    assert len(got[60]) == 10 and sum(hits.values()) / len(hits) >= 0.98
