"""The manifest against trees built by hand, and against its SQL."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from siltstone.llm import manifest, oracle, queries

SF_DIR = "/root/testdata/sf0.001"
CLASHING = ("row", "group", "block", "hash", "tie", "n", "pos", "g", "id", "leaf", "path", "_part", "_row")


def hashed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return hashed(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([hashed(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return found


def by_hand(rows):
    """Result rows of (doc_id, source, lang, n_chars, text) rows."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[name] = levels([leaf_of(r) for r in groups[name]])
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for k, name in enumerate(names):
        for i, row in enumerate(groups[name]):
            node, siblings = leaf_of(row), []
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                node = leaf_of((*row[:3], row[3] + 1, row[4]))
            for place, tree in ((i, trees[name]), (k, top)):
                for level in tree[:-1]:
                    other = level[place ^ 1] if place ^ 1 < len(level) else ""
                    siblings.append(other)
                    node = hashed(other, node) if place & 1 else hashed(node, other)
                    place >>= 1
            root = top[-1][0]
            out.append((row[0], leaf_of(row), trees[name][-1][0], root, hashed(*siblings), node, node == root))
    return sorted(out, key=repr)


def rows_of(sizes):
    rows, i = [], 0
    for lang, size in sizes.items():
        for _ in range(size):
            i += 1
            rows.append((i * 13 % 100_003, "s" if i % 3 else None, lang, i if i % 5 else None, f"wörd {i}" if i % 11 else None))
    return rows


KINDS = "doc_id long, source string, lang string, n_chars long, text string"


def audited(spark, rows, parts=3):
    docs = spark.createDataFrame(rows, KINDS).repartition(parts)
    docs = docs.select("*", *[F.lit("x").alias(n) for n in CLASHING])
    return sorted((tuple(r) for r in manifest.audit(docs).collect()), key=repr)


@pytest.mark.parametrize(
    "sizes",
    [{"en": 1}, {"en": 2, None: 3}, {"en": 257, "": 1, "zh": 255, None: 256, "é": 5}, {str(i): 1 + i % 3 for i in range(300)}],
)
def test_trees_are_those_built_by_hand(spark, sizes):
    rows = rows_of(sizes)
    assert audited(spark, rows) == by_hand(rows)


def test_odd_rows(spark):
    long = "wörd and another " * 50_000
    rows = [
        (None, None, None, None, None),
        (7, "-", "en", 2**63 - 1, long),
        (7, "a", "en", 1, ""),
        (8, "", "en", -5, "1:a"),
        *[(9, "a", "en", 3, "copy")] * 600,
    ]
    got, want = audited(spark, rows), by_hand(rows)
    assert got == want
    assert not all(r[-1] for r in by_hand([(i, "a", "en", 1, "b") for i in range(40)]))


def test_empty_table(spark):
    docs = spark.createDataFrame([], KINDS)
    assert manifest.audit(docs).count() == 0


def test_any_table_gets_a_manifest(spark):
    """Other ids, groups and leaves; a changed leaf breaks its own proof only."""
    leaves = spark.range(700).select(
        F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("key"),
        (F.col("id") % 2).alias("part"),
        manifest.leaf([F.col("id")]).alias("h"),
    )
    found = manifest.manifest(leaves, "part", "key", "h")
    assert found.columns == ["part", "key", "h", "subroot", "root", "path"]
    changed = F.when(F.col("key") == "k0013", manifest.digest(F.lit("other"))).otherwise(F.col("h"))
    broken = found.where(manifest.folded(changed, F.col("path")) != F.col("root"))
    assert [r.key for r in broken.collect()] == ["k0013"]


def test_against_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    want = sorted(duck.execute(oracle.OP11).fetchall())
    assert sorted(tuple(r) for r in queries.op11_manifest(spark, SF_DIR).collect()) == want
