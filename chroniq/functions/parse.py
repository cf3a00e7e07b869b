"""Parsers of semi-structured text. All of it stays within a document's row: nothing is exchanged or sorted.

Record lists are parsed line by line in Python, over Arrow batches: a lambda over each of a document's lines, which Spark interprets, took several times
as long.

A parsed map is an array of (key, value) entries in file order; ``get`` takes the last of a key, so that a later line wins. A record's
fields are a map.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chroniq.functions import text as T

ENTRY = "array<struct<key:string,value:string>>"


def get(entries: Column | str, key: str) -> Column:
    """The last value of a key; null if there is none."""
    return F.get(F.transform(F.slice(F.filter(T.col(entries), lambda e: e["key"] == key), -1, 1), lambda e: e["value"]), F.lit(0))


def has(entries: Column | str, key: str) -> Column:
    return F.coalesce(F.exists(T.col(entries), lambda e: e["key"] == key), F.lit(False))


def filled(entries: Column | str, key: str) -> Column:
    """Whether a key is there with a value that is not empty (``null`` is a value)."""
    return F.coalesce(get(entries, key), F.lit("")) != ""


def _entries(lines: Column) -> Column:
    return F.transform(lines, lambda x: F.struct(T.key_of(x).alias("key"), T.value_of(x).alias("value")))


def front_matter(text: Column | str) -> Column:
    """Entries between the first line ``---`` and the next; null without either."""

    def inside(lines: Column, end: Column) -> Column:
        body = F.slice(lines, F.lit(2), F.greatest(end - 1, F.lit(0)).cast("int"))
        kept = F.filter(body, lambda x: (T.strip(x) != "") & ~T.lstrip(x).startswith("#") & x.contains(":"))
        return F.when((T.strip(F.get(lines, F.lit(0))) == "---") & (end > 0), _entries(kept))

    fence = lambda lines: F.array_position(F.transform(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), lambda x: T.strip(x)), "---")
    return T.let(T.lines(text), lambda lines: T.let(fence(lines), lambda end: inside(lines, end)))


def indented(x: Column) -> Column:
    return x.rlike(rf"\A{T.SPACES}")


#: The line that opens a section, and the one that opens a list below it, by their indentation; a key at an
#: indentation; what an item, a field and a child of a record are made of, without the blanks before them.
SECTION_LINE, NESTED_LINE, NESTED_KEY = r"(?U)\A([^:]*):\s*\z", r"(?U)\A {{{0}}}([a-zA-Z0-9_]+):\s*\z", r"\A {{{0}}}[a-zA-Z0-9_]+:"
MAPPING_KEY, LIST_ITEM = r"(?U)\A {{{0}}}([a-zA-Z0-9_]+):(?:\s|\z)", r"(?U)\A {{{0}}}-\s+"
ITEM, FIELD, CHILD = (re.compile(p) for p in (rf"-{T.SPACES}+([a-zA-Z0-9_]+):", "([a-zA-Z0-9_]+):", rf"-{T.SPACES}"))
#: Records of an Arrow batch, about.
BATCH_RECORDS = 20_000


def top_level(text: Column | str) -> Column:
    """Entries of all lines that are not indented."""
    return header_of(tops(T.lines(text)))


def _marks(lines: Column, begins, pattern: str) -> Column:
    """at, name, line of each line that begins something; the name is null where the line holds more than a name."""
    name = lambda x: F.when(x.rlike(pattern), F.regexp_extract(x, pattern, 1))
    return F.filter(F.transform(lines, lambda x, i: F.when(begins(x), F.struct(i.alias("at"), name(x).alias("name"), x.alias("line")))), lambda m: m.isNotNull())


def tops(lines: Column) -> Column:
    """at, name, line of the lines that are not indented: where sections begin and end."""
    return _marks(lines, lambda x: (x != "") & ~x.startswith(" ") & ~indented(x), SECTION_LINE)


def header_of(marks: Column) -> Column:
    """The entries among the lines that are not indented."""
    return _entries(F.filter(F.transform(marks, lambda m: m["line"]), lambda x: ~x.startswith("#") & x.contains(":")))


def span(marks: Column, name: str, end: Column) -> Column:
    """start, stop of the lines below the first mark of a name, up to the next one of another; null without one."""
    first = F.array_position(F.transform(marks, lambda m: m["name"]), name).cast("int")
    later = lambda at: F.get(F.filter(F.slice(marks, at + 1, F.size(marks)), lambda m: ~m["name"].eqNullSafe(F.lit(name))), F.lit(0))
    found = lambda at: F.when(at > 0, F.struct((F.get(marks, at - 1)["at"] + 1).alias("start"), F.coalesce(later(at)["at"], end).alias("stop")))
    return T.let(first, found)


def between(lines: Column, of: Column) -> Column:
    """The lines of a span; a null span has none."""
    return F.when(of.isNotNull(), F.slice(lines, of["start"] + 1, of["stop"] - of["start"])).otherwise(F.array().cast("array<string>"))


def _below(lines: Column, marks, name: str, header: str) -> Column:
    body = lambda a: T.let(marks(a), lambda m: T.let(span(m, name, F.size(a)), lambda s: between(a, s)))
    return F.filter(T.let(lines, body), lambda x: ~x.rlike(header))


def section_lines(text: Column | str, section: str) -> Column:
    """Lines below the exact header ``section:`` up to the next line that is not indented."""
    return section_of(T.lines(text), section)


def section_of(lines: Column, section: str) -> Column:
    """The same of lines that are split already."""
    return _below(lines, tops, section, rf"(?U)\A{section}:\s*\z")


def nested_marks(lines: Column, indent: int) -> Column:
    """at, name, line of the keys at an indentation: where lists below them begin and end."""
    return _marks(lines, lambda x: x.startswith(" " * indent) & x.rlike(NESTED_KEY.format(indent)), NESTED_LINE.format(indent))


def nested_list(lines: Column, key: str, indent: int = 2) -> Column:
    """Lines below ``key:`` at ``indent`` up to the next key there."""
    return _below(lines, lambda a: nested_marks(a, indent), key, rf"(?U)\A {{{indent}}}{key}:\s*\z")


def nested_scalar(text: Column | str, section: str, key: str) -> Column:
    """The first value of ``key:``, indented by 2, in a section."""
    return scalar_of(section_lines(text, section), key)


def scalar_of(lines: Column, key: str) -> Column:
    """The same of a section's lines."""
    pattern = rf"(?U)\A  {key}:\s*(.*?)\s*\z"
    hit = F.get(F.filter(lines, lambda x: x.startswith(f"  {key}:") & x.rlike(pattern)), F.lit(0))
    return T.unquote_marks(T.strip(F.regexp_extract(hit, pattern, 1)))


def mapping_keys(lines: Column, indent: int) -> Column:
    """Distinct keys at exactly ``indent`` blanks."""
    pattern = MAPPING_KEY.format(indent)
    return F.array_distinct(F.transform(F.filter(lines, lambda x: x.startswith(" " * indent) & x.rlike(pattern)), lambda x: F.regexp_extract(x, pattern, 1)))


def raw_items(lines: Column, indent: int) -> Column:
    return F.size(F.filter(lines, lambda x: x.startswith(" " * indent + "-") & x.rlike(LIST_ITEM.format(indent))))


def flat_records(lines: Iterable[str], indent: int) -> list[dict[str, str]]:
    """The fields of each record of a list of flat mappings.

    A line is an item, a field of the record before it (2 blanks deeper) or a child (4 deeper) of the last field without a
    value; anything else is ignored. The children of a field are its value, each after a line feed. A later value of a key wins.
    """
    out, fields, owner = [], None, None
    for x in lines:
        t = x.lstrip(" ")
        depth = len(x) - len(t) - indent
        if depth == 2:
            if fields is not None and (m := FIELD.match(t)):
                fields[m[1]] = value = t[m.end() :].strip().strip("\"'")
                owner = None if value else m[1]
        elif depth == 4:
            if owner and CHILD.match(t):
                fields[owner] += "\n" + t[1:].strip().strip("\"'")
        elif depth == 0 and (m := ITEM.match(t)):
            fields, owner = {m[1]: t[m.end() :].strip().strip("\"'")}, None
            out.append(fields)
    return out


def _titled(x: str) -> str | None:
    """The name that a line ends with a colon."""
    name, colon, rest = x.partition(":")
    return name if colon and not rest.strip() else None


def _part(lines: list[str], marks: list[tuple[int, str | None]], name: str) -> list[str]:
    """The lines below the first mark of a name, up to the next one of another."""
    k = next((k for k, m in enumerate(marks) if m[1] == name), None)
    return [] if k is None else lines[marks[k][0] + 1 : next((at for at, n in marks[k + 1 :] if n != name), len(lines))]


def parts_of(text: str, places: list[tuple[str, ...]]) -> tuple[dict[str, str], list[list[str]]]:
    """A document's header, and the lines of each part: below a section, or below a key of it that is indented by 2."""
    lines = text.splitlines()
    tops = [(i, x) for i, x in enumerate(lines) if x and not x[0].isspace()]
    header = {k.strip(): v.strip().strip("\"'") for _, x in tops if ":" in x and x[0] != "#" for k, _, v in [x.partition(":")]}
    marks, out = [(i, _titled(x)) for i, x in tops], []
    for section, *key in places:
        part = _part(lines, marks, section)
        inner = [(i, _titled(x[2:])) for i, x in enumerate(part) if x[2:3] != " " and x.startswith("  ") and FIELD.match(x, 2)] if key else []
        out.append(_part(part, inner, key[0]) if key else part)
    return header, out


def _declared(df: DataFrame, scope: list[str]) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.select(*scope).schema)


def parted(df: DataFrame, scope: list[str], text: str, places: dict[str, tuple[tuple[str, ...], int, str]]) -> DataFrame:
    """(scope, header, ...) of each document: its header's entries, and of each named part (``parts_of``) the lines of an indentation that begin with a pattern there."""
    own, begins, entries = [p for p, _, _ in places.values()], [(n, " " * n, re.compile(b)) for _, n, b in places.values()], pa.list_(pa.struct([("key", pa.string()), ("value", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [parts_of(x.as_py(), own) for x in rows.column(len(scope))]
            headers = pa.array([[{"key": k, "value": v} for k, v in h.items()] for h, _ in found], entries)
            parts = [pa.array([[x for x in p[i] if x[n : n + 1] != " " and x.startswith(lead) and b.match(x, n)] for _, p in found], pa.list_(pa.string())) for i, (n, lead, b) in enumerate(begins)]
            yield pa.RecordBatch.from_arrays([*rows.columns[: len(scope)], headers, *parts], [*scope, "header", *places])

    lists = "".join(f", {name} array<string>" for name in places)
    return df.select(*scope, text).mapInArrow(run, f"{_declared(df, scope)}header {ENTRY}{lists}")


def _mapped(df: DataFrame, scope: list[str], column: str, keys: list[str], found_in) -> DataFrame:
    """(scope, keys, section, idx, fields) of the records that ``found_in`` finds in a column's values, as (section, records), and of the header's keys."""

    def batch(rows: pa.RecordBatch, found: list[tuple[int, list[str | None], str, int, dict[str, str]]]) -> pa.RecordBatch:
        at, heads, section, idx, fields = zip(*found, strict=True)
        offsets = [0]
        for f in fields:
            offsets.append(offsets[-1] + len(f))
        maps = pa.MapArray.from_arrays(pa.array(offsets, pa.int32()), pa.array([k for f in fields for k in f], pa.string()), pa.array([v for f in fields for v in f.values()], pa.string()))
        own = [rows.column(i).take(pa.array(at, pa.int32())) for i in range(len(scope))] + [pa.array([h[i] for h in heads], pa.string()) for i in range(len(keys))]
        return pa.RecordBatch.from_arrays([*own, pa.array(section, pa.string()), pa.array(idx, pa.int32()), maps], [*scope, *keys, "section", "idx", "fields"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = []
            for i, x in enumerate(rows.column(len(scope))):
                header, lists = found_in(x.as_py())
                head = [header.get(k) for k in keys]
                found += [(i, head, name, k, f) for name, fs in lists for k, f in enumerate(fs, 1)]
                if len(found) >= BATCH_RECORDS:
                    yield batch(rows, found)
                    found = []
            if found:
                yield batch(rows, found)

    heads = "".join(f"{k} string, " for k in keys)
    return df.select(*scope, column).mapInArrow(run, f"{_declared(df, scope)}{heads}section string, idx int, fields map<string,string>")


def records(df: DataFrame, scope: list[str], lines: str, indent: int) -> DataFrame:
    """(scope, idx, fields) of each record of a list of flat mappings (``flat_records``); ``idx`` counts from 1."""
    return _mapped(df, scope, lines, [], lambda x: ({}, [("", flat_records(x or (), indent))])).drop("section")


def record_lists(df: DataFrame, scope: list[str], text: str, lists: dict[str, tuple[tuple[str, ...], int]], keys: list[str]) -> DataFrame:
    """(scope, keys, section, idx, fields) of the records of several lists of a document, with the values of its header's ``keys``.

    ``lists`` names the place of each list (``parts_of``) and the indentation of its items.
    """
    names, places, indents = list(lists), [p for p, _ in lists.values()], [n for _, n in lists.values()]

    def found_in(x: str):
        header, parts = parts_of(x, places)
        return header, [(name, flat_records(part, n)) for name, part, n in zip(names, parts, indents, strict=True)]

    return _mapped(df, scope, text, keys, found_in)


#: A heading of Markdown (fixed value).
HEADING = r"(?U)\A(#{1,6})\s+(.+?)\s*\z"


def sections(lines: DataFrame) -> DataFrame:
    """(path, name, meaningful) of each level-2 heading name: whether its bodies hold more than blanks, comments and rules.

    A heading of level 1 closes a section, deeper ones are skipped; bodies of one name are merged.
    """
    level = F.length(F.regexp_extract("line", HEADING, 1))
    d = lines.withColumn("level", level)
    opened = F.when(F.col("level") == 2, T.strip(F.regexp_extract("line", HEADING, 2))).when(F.col("level") == 1, F.lit(""))
    d = d.withColumn("name", F.last(opened, ignorenulls=True).over(W.partitionBy("path").orderBy("line_no"))).filter("name <> ''")
    s = T.strip("line")
    content = (F.col("level") == 0) & (s != "") & ~s.startswith("<!--") & ~s.isin("---", "```")
    return d.filter("level in (0, 2)").groupBy("path", "name").agg(F.bool_or(content).alias("meaningful"))
