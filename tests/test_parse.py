"""Parsers against plain state machines."""

import random
import re

from pyspark.sql import functions as F

from chroniq.functions import parse as P


def entries(spark, text, f):
    x = spark.createDataFrame([(text,)], "t string").select(f("t").alias("x")).first().x
    return None if x is None else {e.key: e.value for e in x}


def test_front_matter(spark):
    f = P.front_matter
    assert entries(spark, "---\na: 1\n# c: 2\nb\n  d : 'x'\na: 3\n---\ne: 4", f) == {"a": "3", "d": "x"}
    assert entries(spark, "---\na: 1", f) is None
    assert entries(spark, "", f) is None
    assert entries(spark, " --- \n --- ", f) == {}
    assert entries(spark, "x\n---\na: 1\n---", f) is None


def test_top_level(spark):
    assert entries(spark, "a: 1\n b: 2\n\n#c: 3\nd\ne: \"q\"\n\tf: 1", P.top_level) == {"a": "1", "e": "q"}


def rows(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f("t").alias("x")).first().x


TEXT = "x: 1\ns:\n  a: 1\n\n  b: 2\ns: \n  l:\n    - x: 1\n  m: 2\nt: 3\ns:\n  z: 1"


def test_sections(spark):
    assert rows(spark, TEXT, lambda t: P.section_lines(t, "s")) == ["  a: 1", "", "  b: 2", "  l:", "    - x: 1", "  m: 2"]
    assert rows(spark, "s: []\n  a: 1", lambda t: P.section_lines(t, "s")) == []
    assert rows(spark, TEXT, lambda t: P.mapping_keys(P.section_lines(t, "s"), 2)) == ["a", "b", "l", "m"]
    assert rows(spark, TEXT, lambda t: P.nested_list(P.section_lines(t, "s"), "l")) == ["    - x: 1"]
    assert rows(spark, TEXT, lambda t: P.nested_scalar(t, "s", "b")) == "2"
    assert rows(spark, TEXT, lambda t: P.nested_scalar(t, "s", "zz")) is None
    assert rows(spark, "  - a: 1\n  -  b\n   - c", lambda t: P.raw_items(F.split(t, "\n"), 2)) == 2


def plain_records(lines, n):
    out, owner = [], None
    for x in lines:
        item, field, child = (re.match(p, x) for p in (rf"^ {{{n}}}-\s+(\w+):\s*(.*?)\s*$", rf"^ {{{n + 2}}}(\w+):\s*(.*?)\s*$", rf"^ {{{n + 4}}}-\s+(.*?)\s*$"))
        if item:
            out.append({item[1]: item[2].strip("\"'")})
            owner = None
        elif field and out:
            out[-1][field[1]] = field[2].strip("\"'")
            owner = field[1] if not out[-1][field[1]] else None
        elif child and out and owner:
            out[-1][owner] += "\n" + child[1].strip("\"'")
    return out


def test_records(spark):
    rng = random.Random(5)
    pool = ["  - a: 1", "  - b:", "    a: 'x'", "    b:", "    c: ", "      - p", '      - "q"', "      -  ", "   bad", "", "    a:", "  - c: 3 "]
    texts = [[rng.choice(pool) for _ in range(rng.randrange(14))] for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, lines array<string>")
    got = {}
    for r in P.records(df, ["id"], "lines", 2).collect():
        got.setdefault(r.id, {})[r.idx] = r.fields
    for i, lines in enumerate(texts):
        assert [got.get(i, {}).get(k + 1) for k in range(len(got.get(i, {})))] == plain_records(lines, 2), lines


def test_markdown_sections(spark):
    text = "# T\n## A\n<!-- x -->\n---\n### deeper\n## B\n\ntext\n## A\n```\n# End\nlost\n## C \n### only"
    lines = spark.createDataFrame([("p", i + 1, x) for i, x in enumerate(text.split("\n"))], "path string, line_no int, line string")
    assert {r.name: r.meaningful for r in P.sections(lines).collect()} == {"A": False, "B": True, "C": False}


def test_documents_by_batches_are_as_by_columns(spark):
    """A document's header, parts and records, parsed over Arrow batches, against the column functions and plain Python."""
    rng = random.Random(6)
    pool = ["a:", "a: ", "b:\u3000", "b: 1", "c: 'x'", "#d: 1", " a:", "  k:", "  k: 1", "  l:", "    - x: 1", "      y:", "        - z", "  - x: 2", "    y: 3", "\ta:", "", "plain"]
    texts = [rng.choice(["\n", "\r\n", "\u2028"]).join(rng.choice(pool) for _ in range(rng.randrange(16))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    below = P.section_lines("text", "a")
    d = df.select("id", "text", P.top_level("text").alias("top"), below.alias("a"), P.nested_list(below, "k").alias("k"))
    want = {r.id: ({e.key: e.value for e in r.top}, r.a, r.k) for r in d.collect()}
    drop = lambda lines, pattern: [x for x in lines if not re.match(pattern, x)]
    for i, t in enumerate(texts):
        header, (a, k) = P.parts_of(t, [("a",), ("a", "k")])
        assert (header, drop(a, r"a:\s*\Z"), drop(k, r"(?:  k|a):\s*\Z")) == want[i], t
    got = {r.id: (dict(map(tuple, r.header)), r.a, r.k) for r in P.parted(df, ["id"], "text", {"a": (("a",), 2, "[a-z]"), "k": (("a", "k"), 4, "-")}).collect()}
    records = {}
    for r in P.record_lists(df, ["id"], "text", {"a": (("a",), 2), "k": (("a", "k"), 4)}, ["c"]).collect():
        assert r.c == want[r.id][0].get("c")
        records.setdefault((r.id, r.section), {})[r.idx] = r.fields
    for i, t in enumerate(texts):
        header, (a, k) = P.parts_of(t, [("a",), ("a", "k")])
        assert got[i] == (header, [x for x in a if re.match("  [a-z]", x)], [x for x in k if x.startswith("    -")])
        for name, lines, n in (("a", a, 2), ("k", k, 4)):
            assert [f for _, f in sorted(records.get((i, name), {}).items())] == plain_records(lines, n)
