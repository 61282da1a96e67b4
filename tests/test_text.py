import pytest
from pyspark.sql import functions as F

from docquarry.functions.cells import cell_list, first_part, trimmed_parts
from docquarry.functions.markup import with_html_text
from docquarry.functions.text import (
    clean_text,
    filter_keyword_matches,
    is_blank,
    match_column,
    match_keywords,
    trim_u,
)


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "text string")


def column(df, name):
    return [r[name] for r in df.collect()]


@pytest.mark.parametrize(
    ("keyword", "hits", "misses"),
    [
        ("été", ["l'ÉTÉ", "été"], ["ete"]),
        ("k", ["K"], ["x"]),  # Kelvin sign
        ("s", ["ſ"], ["x"]),  # long s
        ("I", ["i"], ["ı", "İ"]),  # Turkish letters are no case variants
        ("ı", ["ı"], ["i", "I"]),
        ("a.b", ["xA.By"], ["axb"]),
        ("c++", ["C++"], ["ccc"]),
        ("earth observation", ["Earth Observation"], ["earthobservation"]),
        ("a-b #1", ["A-B #1"], ["a b #1"]),
    ],
)
def test_keyword_is_a_case_insensitive_literal(spark, keyword, hits, misses):
    df = match_keywords(texts(spark, *hits, *misses), [keyword])
    assert column(df, match_column(keyword)) == [True] * len(hits) + [False] * len(misses)


def test_null_text_gives_null_match_and_is_filtered(spark):
    df = match_keywords(texts(spark, None, "a", "b"), ["a", "z"])
    assert [tuple(r) for r in df.collect()] == [(None, None, None), ("a", True, False), ("b", False, False)]
    assert column(filter_keyword_matches(df, ["a", "z"]), "text") == ["a"]


def test_column_names_change_blanks_and_hyphens_only():
    assert match_column("Earth-Obs data.v2 C++") == "match_earth_obs_data.v2_c++"


def test_dotted_keyword_names_work(spark):
    df = match_keywords(texts(spark, "x A.B", "y"), ["a.b"])
    assert column(filter_keyword_matches(df, ["a.b"]), "text") == ["x A.B"]


def test_keywords_with_one_name_are_an_error(spark):
    with pytest.raises(ValueError, match="'a b' and 'a-b'"):
        match_keywords(texts(spark, "x"), ["a b", "a-b"])


def test_no_keywords_change_nothing_and_empty_input_has_the_columns(spark):
    df = texts(spark, "x")
    assert match_keywords(df, []) is df
    assert filter_keyword_matches(df, []) is df
    assert match_keywords(df.filter("false"), ["a"]).columns == ["text", "match_a"]


def test_cleaning_is_off_by_default_and_rules_apply_in_order(spark):
    df = texts(spark, "a  b .C\n")
    assert clean_text(df) is df
    assert column(clean_text(df, ["space_before_period"]), "text") == ["a  b.C\n"]
    assert column(clean_text(df, ["strip", "collapse_spaces", "space_before_period", "space_after_period"]), "text") == ["a b. C"]
    with pytest.raises(ValueError, match="unknown"):
        clean_text(df, ["nope"])


@pytest.mark.parametrize(
    ("rule", "before", "after"),
    [
        ("join_hyphenated", "pre- processing", "preprocessing"),
        ("join_hyphenated", "a- b- c", "ab- c"),  # a letter that ends one match starts no other
        ("join_hyphenated", "é- \nà x-y", "éà x-y"),
        ("collapse_spaces", "a   b\n\n c", "a b\n\n c"),
        ("ligatures", "eﬃcient ﬁrst ﬂow", "eﬃcient first flow"),
        ("strip", " 　 x  \n", "x"),
        ("space_before_period", "a \n .b", "a.b"),
        ("space_before_period", "a" + " " * 50_000 + "b", "a" + " " * 50_000 + "b"),
        ("strip", "a" + " " * 50_000 + "b", "a" + " " * 50_000 + "b"),
    ],
)
def test_cleaning_rule(spark, rule, before, after):
    assert column(clean_text(texts(spark, before), [rule]), "text") == [after]


def test_trim_equals_python_strip(spark):
    values = ["".join((chr(c), "x y", chr(c))) for c in [*range(33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0x200B, 0xFEFF]]
    df = texts(spark, *values, "", "   ").select("text", trim_u(F.col("text")).alias("t"), is_blank(F.col("text")).alias("b"))
    for row in df.collect():
        assert row.t == row.text.strip()
        assert row.b == (not row.text.strip())


@pytest.mark.parametrize(
    ("cell", "parts", "listed", "first"),
    [
        ("", [""], [], ""),
        ("|||", ["", ""], [], ""),
        (" a ||| |||b", ["a", "", "b"], ["a", "b"], " a "),
        ("a||||b", ["a", "|b"], ["a", "|b"], "a"),
        (None, None, [], None),
    ],
)
def test_cells(spark, cell, parts, listed, first):
    c = F.col("text")
    row = texts(spark, cell).select(trimmed_parts(c), cell_list(c), first_part(c)).first()
    assert tuple(row) == (parts, listed, first)


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p>a</p><p>b</p>", "ab"),
        ("<title>T</title><!-- x <b> --><script>if (a<b) '</p>'</script><STYLE>p{}</STYLE >z", "Tz"),
        ("<!DOCTYPE html><?xml version='1.0'?><ruby>k<rp>(</rp><rt>r</rt></ruby>", "k"),
        ("<template><p>no</p></template>yes", "yes"),
        ("1 < 2 &lt;b&gt; &amp;lt; &quot;", '1 < 2 <b> &lt; "'),
        ("&eacute;&#233;&#xE9; &amp;amp;", "ééé &amp;"),
        ("R&D a&b", "R&D a&b"),
        ("<![CDATA[x]]>y", "xy"),
        ("a\n <br/> b\n", "a\n  b\n"),
        (None, None),
    ],
)
def test_html(spark, html, text):
    assert column(with_html_text(texts(spark, html), F.col("text"), "out"), "out") == [text]
