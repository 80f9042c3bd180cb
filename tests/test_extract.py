"""Text extraction against brute force on small documents."""

import re
from contextlib import contextmanager

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.plans import prep
from siltstone.sources import files
from siltstone.sources.nested import flatten_catalogue

# Fixed value: the entry grammar as specified, with a backtracking loop. Ours
# must find the same entries without one.
SPECIFIED_ENTRY = re.compile(
    r'\["([^"]+)"\]\s*=\s*\{([^}]*(?:\{[^}]*\}[^}]*)*)\}(?=\s*,?\s*(?:\["|$))'
)

TEXT = """return {
  ["Ann"] = {
    ["id"] = 1,
    ["skins"] = {
      ["Original"] = { ["id"] = 0, ["cost"] = 880, ["release"] = "2010-01-01" },
      ["Red"] = { ["id"] = 1, ["cost"] = 975, ["colours"] = { "a", "b" } },
      ["Gold"] = { ["id"] = 2, ["rarity"] = "Special" },
      ["Lost"] = { ["id"] = 3 },
      ["Bare"] = { ["cost"] = 520 },
      ["Late"] = { ["colours"] = { 1, 2 }, ["id"] = 5, ["cost"] = 520 },
      ["Free"] = { ["id"] = 6, ["cost"] = 0 },
      ["Odd"] = { ["id"] = 7, ["cost"] = 999 }
    }
  },
  ["Bob Two"] = {
    ["id"] = 2,
    ["skins"] = {
      ["Blue"] = { ["id"] = 0, ["cost"] = 1820, ["release"] = "Jan 5, 2011" },
      ["Great"] = { ["id"] = 1, ["cost"] = 3250 },
      ["Red"] = { ["id"] = 2, ["cost"] = 1350 }
    }
  }
}
"""


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def listed(df):
    return [tuple(r) for r in df.orderBy("doc_id", "block_pos", "entry_pos").select(*prep.EXTRACTED).collect()]


def test_extract_skins(spark):
    assert listed(prep.extract_skins(docs(spark, TEXT))) == [
        ("Ann", 0, "Default", "Ann", "2010-01-01"),
        ("Red Ann", 975, "Legacy", "Ann", None),
        ("Gold Ann", 0, "Special", "Ann", None),
        ("Free Ann", 0, "Special", "Ann", None),
        ("Odd Ann", 999, "Epic", "Ann", None),
        ("Blue Bob Two", 1820, "Legendary", "Bob Two", "Jan 5, 2011"),
        ("Great Bob Two", 3250, "Ultimate", "Bob Two", None),
        ("Red Bob Two", 1350, "Epic", "Bob Two", None),
    ]


pieces = st.lists(
    st.sampled_from(['["a"]', '["b"]', " = ", "=", "{", "}", ", ", "\n", "x", '["id"] = 1', " "]), max_size=40
)


@settings(max_examples=15, deadline=None)
@given(st.lists(pieces, min_size=30, max_size=60))
def test_entries_follow_the_specified_grammar(spark, cases):
    texts = ["".join(c) for c in cases]
    frame = spark.createDataFrame([(i, "c", t) for i, t in enumerate(texts)], "doc_id long, champion string, block string")
    found = prep.skin_entries(frame.withColumn("block_pos", F.lit(0)))
    got = {}
    for r in found.orderBy("doc_id", "entry_pos").collect():
        got.setdefault(r.doc_id, []).append((r.name, r.props))
    want = {i: SPECIFIED_ENTRY.findall(t) for i, t in enumerate(texts)}
    assert got == {i: w for i, w in want.items() if w}


def test_deeply_filled_entries_do_not_overflow(spark):
    """50,000 nested lists in one entry: a recursing pattern would end the JVM."""
    filling = ", ".join('"k" = { 1 }' for _ in range(50_000))
    text = '  ["Ann"] = {\n    ["id"] = 1,\n    ["skins"] = {\n      ["Red"] = { ["id"] = 1, ["cost"] = 520, ' + filling + " }\n    }\n  }\n"
    assert listed(prep.extract_skins(docs(spark, text))) == [("Red Ann", 520, "Legacy", "Ann", None)]


def cost_entry(name, cost, lead=""):
    return f'["{name}"] = {{ {lead}["cost"] = {cost} }}'


# Enough to put an id out of sight of the next entry.
FAR = "\n" * 100

# Documents and the rows they hold for the simpler extraction.
FALLBACK_CASES = [
    # Without a champion only names of several words count; their last word stands in.
    ([cost_entry("Ann", 520), cost_entry("Dark Ann", 1350)], [("Dark Ann", 1350, "Epic", "Ann", None)]),
    # An id just before makes a capitalised word the champion, from itself on.
    (
        ['["id"] = 4 ', cost_entry("Zed", 520), cost_entry("red", 4000), FAR, cost_entry("Original", 520)],
        [("red Zed", 4000, "Ultimate", "Zed", None), ("Zed", 0, "Default", "Zed", None)],
    ),
    # An id too far away, or a skin list already open, makes no champion.
    (['["id"] = 4', "\n" * 100, cost_entry("Zed", 520), cost_entry("red", 520)], []),
    (['["id"] = 4, ["skins"] = ', cost_entry("Zed", 520), cost_entry("red", 520)], []),
    # Short names and names of several words are no champions; the last one stays.
    (
        ['["id"] = 4 ', cost_entry("Éva", 520), '["id"] = 5 ', cost_entry("Bo", 1820)],
        [("Bo Éva", 1820, "Legendary", "Éva", None)],
    ),
    # Costs of more than 64 bits are no costs, but the original needs none.
    (
        ['["id"] = 4 ', cost_entry("Zed", 1), cost_entry("Big One", "9" * 25), FAR, cost_entry("Original", "9" * 25)],
        [("Zed", 0, "Default", "Zed", None)],
    ),
    # A long gap hides nothing that lies within the last hundred characters.
    (
        ["x" * 5000, '["id"] = 4', "y" * 80, cost_entry("Zed", 520), "z" * 9000, cost_entry("Dark", 975)],
        [("Dark Zed", 975, "Legacy", "Zed", None)],
    ),
    ([], []),
]


def test_fallback_on_documents_by_hand(spark):
    texts = ["".join(parts) for parts, _ in FALLBACK_CASES]
    found = {}
    df = prep.extract_skins_fallback(docs(spark, *texts))
    for r in df.orderBy("doc_id", "entry_pos").collect():
        found.setdefault(r.doc_id, []).append(tuple(r[c] for c in prep.EXTRACTED))
    assert found == {i: want for i, (_, want) in enumerate(FALLBACK_CASES) if want}


def test_costs_beyond_64_bits_are_no_costs(spark):
    text = TEXT.replace('["cost"] = 975', '["cost"] = 99999999999999999999')
    assert "Red Ann" not in [r[0] for r in listed(prep.extract_skins(docs(spark, text)))]
    large = TEXT.replace('["cost"] = 975', '["cost"] = 99999999999')
    assert ("Red Ann", 99999999999, "Ultimate", "Ann", None) in listed(prep.extract_skins(docs(spark, large)))


@contextmanager
def small_parts(spark, size):
    """Files are read in parts of so many bytes."""
    names = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in names:
            spark.conf.unset(name)


def test_a_file_is_read_by_several_tasks(spark, tmp_path):
    blocks = [TEXT.replace('"Ann"', f'"Ann{i}"').replace('"Bob Two"', f'"Bob {i}"') for i in range(200)]
    (tmp_path / "a.txt").write_text("".join(blocks))
    (tmp_path / "b.txt").write_text(TEXT)
    whole = listed(prep.extract_skins(files.read_documents(spark, str(tmp_path))))
    assert len(whole) == 201 * 8
    with small_parts(spark, 2_000):
        pieces = prep.read_catalogues(spark, str(tmp_path)).cache()
        assert pieces.groupBy("doc_id").count().where("count >= 300").count() == 1
        assert pieces.agg(F.max(F.length("text"))).first()[0] < 2 * len(TEXT)
        found = prep.extract_skins(pieces).orderBy("doc_id", "piece", "block_pos", "entry_pos")
        assert [tuple(r) for r in found.select(*prep.EXTRACTED).collect()] == whole
        # Put together, the pieces are the files.
        texts = {r.doc_id[-5:]: [] for r in pieces.select("doc_id").distinct().collect()}
        for r in pieces.orderBy("doc_id", "piece").collect():
            texts[r.doc_id[-5:]].append(r.text)
        assert {k: "".join(v) for k, v in texts.items()} == {"a.txt": "".join(blocks), "b.txt": TEXT}


broken = st.lists(
    st.sampled_from(
        ['["Ann"] = {', '["id"] = 1', '["skins"] = {', '["Red"] = { ["id"] = 1, ["cost"] = 520 }', "\n    }", "\n  }", ",\n"]
        + ['\n  ["Bob"] = {', "return {", '"', "{", "}", "x", '["', "\n    }\n", " = ", '["skins"] = ', "\r\n    }", "é"]
    ),
    max_size=30,
)


@settings(max_examples=12, deadline=None)
@given(st.lists(broken, min_size=6, max_size=12), st.sampled_from([7, 40]))
def test_pieces_hold_the_blocks_of_the_whole_text(spark, tmp_path_factory, cases, size):
    """Also where braces and quotes don't match, and a part ends anywhere."""
    folder = tmp_path_factory.mktemp("docs")
    texts = {f"{i:02}.txt": "".join(c) for i, c in enumerate(cases) if c}
    for name, text in texts.items():
        (folder / name).write_bytes(text.encode())

    def blocks(docs, *order):
        found = prep.champion_blocks(docs).orderBy("doc_id", *order, "block_pos").collect()
        return [(r.doc_id, r.champion, r.block) for r in found]

    whole = blocks(files.read_documents(spark, str(folder)))
    with small_parts(spark, size):
        pieces = prep.read_catalogues(spark, str(folder))
        assert blocks(pieces, "piece") == whole
        put_together = {}
        for r in pieces.orderBy("doc_id", "piece").collect():
            put_together[r.doc_id[-6:]] = put_together.get(r.doc_id[-6:], "") + r.text
        assert put_together == texts


def test_dedup_keeps_the_first_and_drops_special(spark):
    again = TEXT.replace('["cost"] = 975', '["cost"] = 520')
    kept = prep.dedup_and_filter(prep.extract_skins(docs(spark, TEXT, again)))
    assert sorted((r.skin_name, r.price_rp, r.skin_name_norm) for r in kept.collect()) == [
        ("Ann", 0, "ann"),
        ("Blue Bob Two", 1820, "bluebobtwo"),
        ("Great Bob Two", 3250, "greatbobtwo"),
        ("Odd Ann", 999, "oddann"),
        ("Red Ann", 975, "redann"),
        ("Red Bob Two", 1350, "redbobtwo"),
    ]


def test_flatten_catalogue(spark):
    json = '{"Ann": {"name": "Ann!", "skins": [{"num": 0, "name": "default"}, {"num": 1, "name": "Red"}]}, "Bo": {"name": "Bo", "skins": []}}'
    flat = flatten_catalogue(spark.createDataFrame([(json,)], "json string"))
    assert [tuple(r) for r in flat.orderBy("skin_num").collect()] == [
        ("Ann", "Ann!", 0, "default"),
        ("Ann", "Ann!", 1, "Red"),
    ]
