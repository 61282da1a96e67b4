"""Text rules as Column expressions: trimming, opt-in cleaning, keyword matching."""

import functools
import operator
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Java's \s is ASCII only unless (?U) makes it the Unicode White_Space property. A Python strip
# removes four separators besides (fixed values 1C..1F).
WHITE_SPACE = r"\s"
STRIP_SPACE = r"\s\x1c-\x1f"


def _strip(col: Column, chars: str) -> Column:
    # A trailing run is tried from its first character only, and never given back, so a long run
    # of blanks inside a text costs one pass.
    return F.regexp_replace(col, rf"(?U)\A[{chars}]++|[{chars}](?<![{chars}][{chars}])[{chars}]*+\z", "")


def trim_u(col: Column) -> Column:
    """Strip both ends of all Unicode whitespace; ``F.trim`` removes U+0020 only."""
    return _strip(col, STRIP_SPACE)


def is_blank(col: Column) -> Column:
    """True for null and for text of whitespace only."""
    return ~F.coalesce(col.rlike(rf"(?U)[^{STRIP_SPACE}]"), F.lit(False))


# The opt-in cleaning rules, in the order they apply. Line breaks survive the default (no rule).
# The hyphen rule looks for the rare hyphen first; \G keeps a letter that ended one match from
# starting the next.
CLEAN_RULES = {
    "space_before_period": lambda c: F.regexp_replace(c, r"(?U)\s(?<!\s\s)\s*+\.", "."),
    "space_after_period": lambda c: F.regexp_replace(c, r"\.([A-Z])", r". $1"),
    "collapse_spaces": lambda c: F.regexp_replace(c, " {2,}", " "),
    "join_hyphenated": lambda c: F.regexp_replace(c, r"(?U)-(?<=\w-)(?<!\G-)\s++(\w)", "$1"),
    "ligatures": lambda c: F.replace(F.replace(c, F.lit("ﬁ"), F.lit("fi")), F.lit("ﬂ"), F.lit("fl")),
    "strip": lambda c: _strip(c, WHITE_SPACE),
}


def clean_text(df: DataFrame, rules: Sequence[str] = (), column: str = "text") -> DataFrame:
    """Apply the chosen rules to ``column``; without rules the frame is returned unchanged."""
    unknown = set(rules) - set(CLEAN_RULES)
    if unknown:
        raise ValueError(f"unknown cleaning rules: {sorted(unknown)}")
    if not rules:
        return df
    text = F.col(column)
    for name, rule in CLEAN_RULES.items():
        if name in rules:
            text = rule(text)
    return df.withColumn(column, text)


def match_column(keyword: str) -> str:
    """Column name of a keyword: lower case, blanks and hyphens become underscores, no more."""
    return "match_" + re.sub("[ -]", "_", keyword.lower())


def match_columns(keywords: Sequence[str]) -> dict[str, str]:
    """Column name -> keyword; two keywords that share a name are an error."""
    names: dict[str, str] = {}
    for keyword in keywords:
        name = match_column(keyword)
        if name in names:
            raise ValueError(f"keywords {names[name]!r} and {keyword!r} both map to column {name!r}")
        names[name] = keyword
    return names


def keyword_pattern(keyword: str) -> str:
    """Case-insensitive literal, by simple Unicode case folding.

    Java's ``(?iu)`` also takes the dotless and the dotted Turkish i for an i, which simple
    folding does not, so the letters of that family are spelled out.
    """

    def one(ch: str) -> str:
        if ch in "iI":
            return "(?-i:[iI])"
        if ch in "İı":
            return f"(?-i:{ch})"
        return re.escape(ch)

    return "(?iu)" + "".join(one(ch) for ch in keyword)


def match_keywords(df: DataFrame, keywords: Sequence[str], column: str = "text") -> DataFrame:
    """Add one boolean column per keyword, all in one pass; null text gives null."""
    named = match_columns(keywords)
    if not named:
        return df
    kept = [F.col(f"`{c}`") for c in df.columns if c not in named]
    return df.select(*kept, *[F.col(column).rlike(keyword_pattern(k)).alias(n) for n, k in named.items()])


def filter_keyword_matches(df: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """Keep rows with any match; a null match counts as unknown, so it never keeps a row alone."""
    if not keywords:
        return df
    return df.filter(functools.reduce(operator.or_, [F.col(f"`{n}`") for n in match_columns(keywords)]))
