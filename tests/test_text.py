"""String functions whose meaning differs from Spark's own."""

from urllib.parse import unquote

from pyspark.sql import functions as F

from chroniq.functions import text as T


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("x")).first().x


def test_strip_is_unicode(spark):
    for s in ("\t a \n", "  x  ", "\x1c a b \x85", " ", ""):
        assert one(spark, s, T.strip) == s.strip()


def test_lines_are_those_of_splitlines(spark):
    for s in ("", "a", "a\n", "a\r\nb\rc\x0bd\x0ce\x1cf\x85g h i\n\nj", "\n", "a\n\n", "a b"):
        assert one(spark, s, T.lines) == s.splitlines(), repr(s)


def test_full_match_has_unicode_digits_and_no_final_line_feed(spark):
    assert one(spark, "cp-٠٠٠١", lambda c: T.full_match(c, r"cp-\d{4}"))
    assert not one(spark, "cp-0001\n", lambda c: T.full_match(c, r"cp-\d{4}"))
    assert one(spark, None, lambda c: T.full_match(c, "a")) is None


def test_key_and_value(spark):
    for line, key, value in (("a: b", "a", "b"), (" a :  \"'b'\" ", "a", "b"), ("a: b: c", "a", "b: c"), ("a:", "a", ""), ("a: b # c", "a", "b # c")):
        assert (one(spark, line, T.key_of), one(spark, line, T.value_of)) == (key, value)


def test_normalized_id(spark):
    assert one(spark, ' "a.b" # note', T.normalized_id) == "a.b"
    assert one(spark, "a#b", T.normalized_id) == "a#b"


def test_link_target(spark):
    for raw, want in (("a.md", "a.md"), ("<a b.md> title", "a b.md"), ("a.md#x", "a.md"), ("#x", ""), ("a%20b+c.md 't'", "a b+c.md"), ("a%zz", "a%zz"), ("  ", "")):
        assert one(spark, raw, T.link_target) == want, raw
    assert unquote("a%20b+c") == "a b+c"


def test_folded_paths(spark):
    for path, want in (("a/../b/./c.md", "b/c.md"), ("a//b", "a/b"), ("a/../../b", None), ("..", None)):
        assert one(spark, path, T.folded) == want
