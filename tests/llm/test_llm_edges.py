"""Nulls, empty and long texts, repeated rows, empty tables, clashing columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siltstone.llm import (
    alignment,
    bpe,
    hnsw,
    licenses,
    manifest,
    minhash,
    mixing,
    quality,
    sharding,
    substrings,
    suffixes,
    token_counts,
    topk,
)

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LONG = "wörd and another thing " * 20_000
ROWS = [
    (1, "some words of a text that is kept", "en", "a", 33),
    (1, "some words of a text that is kept", "en", "a", 33),
    (2, None, None, None, None),
    (3, "", "en", None, 0),
    (None, "a text without an id", "en", "b", 20),
    (None, None, None, None, None),
    (4, LONG, "en", "a", len(LONG)),
    (5, " \n\t ", "en", "b", 4),
]
NAMES = ("size", "kept", "slot", "shard", "section", "component_id", "key", "n_tokens", "labels", "_row", "_found")


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    return plain.select("*", *[F.lit("x").alias(n) for n in NAMES])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (5, 0), (None, 1), (3, None)], "doc_id long, quality int")


OPERATORS = {
    "substrings": lambda d, labels: substrings.passages(d),
    "remove_repeats": lambda d, labels: substrings.remove_repeats(d),
    "digests": lambda d, labels: bpe.digests(d, PATH),
    "encode": lambda d, labels: bpe.encode(d, PATH, verify=True),
    "sharding": lambda d, labels: sharding.place(d, "doc_id", sharding.shard_names(3), 101),
    "licenses": lambda d, labels: licenses.scan(d),
    "token_counts": lambda d, labels: token_counts.attribute(d, PATH),
    "mixture": lambda d, labels: mixing.mixture(d),
    "training_order": lambda d, labels: mixing.training_order(d),
    "resample": lambda d, labels: quality.resample(d, labels),
    "keep_good": lambda d, labels: quality.keep_good(d, labels),
    "near_duplicates": lambda d, labels: minhash.near_duplicates(d),
    "keep_one": lambda d, labels: minhash.keep_one(d),
    "manifest": lambda d, labels: manifest.audit(d),
    "suffixes": lambda d, labels: suffixes.digests(d),
    "alignment": lambda d, labels: alignment.summary(d, PATH, PIECES),
}
ROW_FOR_ROW = {"remove_repeats", "digests", "encode", "sharding", "licenses", "mixture", "near_duplicates"}
ROW_FOR_ROW |= {"manifest", "suffixes", "alignment"}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows(docs, labels, name):
    out = OPERATORS[name](docs, labels)
    rows = out.collect()
    if name in ROW_FOR_ROW:
        assert len(rows) == len(ROWS)
    if name in {"remove_repeats", "training_order", "keep_good", "keep_one"}:
        assert out.columns == docs.columns and {r["kept"] for r in rows} == {"x"}
    if name == "near_duplicates":
        found = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows}
        assert {(1, 4, 1, True), (2, 0, 2, True), (3, 0, 3, True), (None, 0, None, True)} <= found
    if name == "mixture":
        assert {r.size for r in rows if r.doc_id in (2, 3, 5)} == {0}
        assert all(r.taken <= 2 * r.size for r in rows)
    if name == "encode":
        assert all(r.lossless for r in rows)
    if name == "substrings":
        # Only the long text repeats itself.
        assert {r.doc_id for r in rows} <= {4}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_tables(docs, labels, name):
    assert OPERATORS[name](docs.where("false"), labels.where("false")).count() == 0


def test_without_labels_every_document_stays(docs, labels):
    assert quality.keep_good(docs, labels.where("quality = 1")).count() == len(ROWS)


def test_empty_searches(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    for search in (topk.top_k, hnsw.nearest):
        assert search(empty, F.col("vec_id") % 20 == 0).count() == 0
    one = spark.createDataFrame([(20, [1.0, 2.0])], "vec_id long, embedding array<float>")
    for search in (topk.top_k, hnsw.nearest):
        assert search(one, F.col("vec_id") % 20 == 0).count() == 0


def test_pipeline_stages(spark):
    """Each stage but the last returns the columns of its input; clean documents stay."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "substrings", "mixing", "bpe"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    clean = {r.doc_id for r in labels.where("quality = 1").collect()}
    kept = {r.doc_id for r in corpus_pipeline.STAGES[0][1](spark, docs, sf_dir).collect()}
    assert len(clean - kept) <= 0.02 * len(clean)
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.where("NOT lossless").count() == 0 and out.count() > 0
