"""Secrets in texts: patterns, and strings that pass for random.

All of it is column expressions. Candidates are runs of code characters. The encoding is the
smallest of hex, base32, base36, base62 and base64 that explains a run's mix of characters; plain
words have none. Three tests ask whether the run is random in its encoding: chi-squared uniformity
of its symbols, runs above and below the middle of the alphabet, and serial correlation of
neighbours. The smallest of the three p-values, times three, is the run's. Over all candidates of
the table, the Benjamini-Hochberg procedure with weights in proportion to length then fixes which
p-values are discoveries of order; the rest pass for random and are secrets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.llm.common import Scratch

KINDS = ("assign", "access", "hex", "random")

# The patterns of the base kinds and the least length of what counts.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16

#: Shorter matches of ACCESS and HEX never count, so the patterns may ask for the length at once:
#: a match starts where a maximal run does, and every later start in the run leaves less of it.
ACCESS_LONG = r"AKIA[A-Z0-9]{14,}"
HEX_LONG = r"[0-9a-f]{16,}"

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Name, pattern that all characters fit, characters of which each class must occur, alphabet. The first that fits holds.
ENCODINGS = (
    ("hex", r"^[0-9a-f]+$", ("[0-9]", "[a-f]"), "0123456789abcdef"),
    ("hex_upper", r"^[0-9A-F]+$", ("[0-9]", "[A-F]"), "0123456789ABCDEF"),
    ("base32", r"^[A-Z2-7]+$", ("[2-7]", "[A-Z]"), _UPPER + "234567"),
    ("base36", r"^[a-z0-9]+$", ("[0-9]", "[a-z]"), _DIGITS + _LOWER),
    ("base62", r"^[A-Za-z0-9]+$", ("[0-9]", "[a-z]", "[A-Z]"), _DIGITS + _UPPER + _LOWER),
    ("base64", r"^[A-Za-z0-9+/]+$", ("[0-9]", "[a-z]", "[A-Z]"), _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64_url", r"^[A-Za-z0-9_-]+$", ("[0-9]", "[a-z]", "[A-Z]"), _UPPER + _LOWER + _DIGITS + "-_"),
)
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
_CHUNK = 256


@dataclass(frozen=True)
class SecretParams:
    """``false_discovery``: bound on the share of random runs among those set aside as ordered."""

    false_discovery: float = 0.05
    #: Bins of -log10(p) per unit, and the largest value told apart.
    bins: int = 50
    deepest: int = 30


def _scan(values: Column, start: Column) -> Column:
    """Sums before each element, from ``start``. Appending copies the array, so it is for short ones."""
    first = F.struct(start.cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(values, first, lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))["out"]


def running_starts(lengths: Column) -> Column:
    """Sums before each element, by chunks, so that long arrays cost no more than their length."""
    n_chunks = F.ceil(F.size(lengths) / _CHUNK).cast("int")
    chunks = F.transform(F.sequence(F.lit(1), F.greatest(n_chunks, F.lit(1))), lambda c: F.slice(lengths, (c - 1) * _CHUNK + 1, F.lit(_CHUNK)))
    totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x))
    return F.flatten(F.zip_with(chunks, _scan(totals, F.lit(0)), _scan))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (start, end, value) of all matches, in code points; leftmost and non-overlapping."""
    # The texts between matches and the matches themselves add up to the whole.
    whole, value = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p).cast("long"))
    sizes = F.transform(whole, lambda m: F.length(m).cast("long"))
    # A gap and the match after it make one step. Arrays are paired, not indexed: inside a lambda
    # function, an array expression would be computed again for every element.
    steps = F.zip_with(gaps, sizes, lambda g, m: g + F.coalesce(m, F.lit(0)))
    starts = F.zip_with(running_starts(steps), gaps, lambda s, g: s + g)
    parts = F.zip_with(sizes, value, lambda n, v: F.struct(n.alias("n"), v.alias("v")))
    found = F.zip_with(starts, parts, lambda s, p: F.struct(s.alias("start"), (s + p["n"]).alias("end"), p["v"].alias("value")))
    found = F.filter(found, lambda m: m["end"].isNotNull())
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    return F.when(text.rlike(pattern), found).otherwise(none)


def _tail(z: Column) -> Column:
    """Probability that a standard normal variable exceeds ``z``, by a logistic approximation."""
    z = F.least(F.greatest(z, F.lit(-12.0)), F.lit(12.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.070565992 * z * z * z))


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _order_tests(places: Column, k: Column) -> Column:
    """(chi, runs, serial): p-values of three tests of randomness of symbol numbers ``places`` below ``k``."""
    n = F.size(places).cast("double")
    squares = _sum(F.transform(F.sequence(F.lit(0), k.cast("int") - 1), lambda p: F.pow(F.size(F.filter(places, lambda x: x == p)).cast("double"), F.lit(2.0))))
    df = k - 1
    cube = 2 / (9 * df)
    chi = (F.pow((squares * k / n - n) / df, F.lit(1 / 3)) - (1 - cube)) / F.sqrt(cube)
    after = F.slice(places, F.lit(2), F.size(places))
    pairs = F.filter(F.zip_with(places, after, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda p: p["b"].isNotNull())
    high = F.size(F.filter(places, lambda x: x >= k / 2)).cast("double")
    changes = F.size(F.filter(pairs, lambda p: (p["a"] >= k / 2) != (p["b"] >= k / 2))).cast("double")
    mean = 2 * high * (n - high) / n
    spread = mean * F.greatest(mean - 1, F.lit(1e-9)) / (n - 1)
    runs = F.when((high > 0) & (high < n), F.abs(changes - mean) / F.sqrt(F.greatest(spread, F.lit(1e-9)))).otherwise(12.0)

    def correlation(middle: Column) -> Column:
        variance = _sum(F.transform(places, lambda x: F.pow(x - middle, F.lit(2.0))))
        product = _sum(F.transform(pairs, lambda p: (p["a"] - middle) * (p["b"] - middle)))
        return F.when(variance > 0, F.abs(product / F.greatest(variance, F.lit(1e-9)) + 1 / n) * F.sqrt(n)).otherwise(12.0)

    serial = _let(_sum(places) / n, correlation)
    return F.struct(_tail(chi).alias("chi"), F.least(F.lit(1.0), 2 * _tail(runs)).alias("runs"), F.least(F.lit(1.0), 2 * _tail(serial)).alias("serial"))


def _encoding(value: Column) -> Column:
    """(name, alphabet) of the inferred encoding; null name if no encoding explains the characters."""
    out = F.lit(None).cast("struct<name:string,alphabet:string>")
    for name, every, some, alphabet in reversed(ENCODINGS):
        fits = value.rlike(every)
        for one in some:
            fits = fits & value.rlike(one)
        out = F.when(fits, F.struct(F.lit(name).alias("name"), F.lit(alphabet).alias("alphabet"))).otherwise(out)
    return out


def _candidates(text: Column) -> Column:
    """Runs of code characters with an encoding: start, end, encoding, and -log10 of the smallest p-value times three."""
    coded = F.transform(matches(text, CANDIDATE), lambda m: F.struct(m["start"], m["end"], m["value"], _encoding(m["value"]).alias("code")))
    coded = F.filter(coded, lambda m: m["code"].isNotNull())

    def tested(m: Column) -> Column:
        places = F.transform(F.filter(F.split(m["value"], ""), lambda c: c != ""), lambda c: F.instr(m["code"]["alphabet"], c).cast("double") - 1)
        tests = _let(places, lambda x: _order_tests(x, F.length(m["code"]["alphabet"]).cast("double")))
        order = _let(tests, lambda t: -F.log10(F.greatest(F.least(F.lit(1.0), 3 * F.least(t["chi"], t["runs"], t["serial"])), F.lit(1e-300))))
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), m["code"]["name"].alias("encoding"), order.alias("order"))

    return F.transform(coded, tested)


def _plain(kind: str, found: Column) -> Column:
    no = KINDS.index(kind)
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(no).alias("no"), m["end"].alias("end")))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["no"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _weighted(c: Column, mean: float) -> Column:
    """-log10 of a candidate's p-value over its weight, its length in proportion to the mean."""
    return c["order"] + F.log10((c["end"] - c["start"]) / F.lit(mean))


def _order_bound(scanned: DataFrame, params: SecretParams) -> tuple[float, float]:
    """(bound, mean length): from this weighted -log10(p) on, a candidate counts as ordered."""
    candidates = scanned.select(F.explode("candidates").alias("c"))
    total = candidates.agg(F.avg(F.col("c.end") - F.col("c.start")).alias("mean"), F.count("*").alias("m")).first()
    if not total.m:
        return float("inf"), 1.0
    place = F.floor(F.greatest(_weighted(F.col("c"), total.mean), F.lit(0.0)) * params.bins)
    bins = candidates.groupBy(F.least(place, F.lit(params.bins * params.deepest)).alias("bin")).agg(F.count("*").alias("n"))
    # At most bins * deepest rows. A bin's largest p-value stands for all of its.
    ranked = bins.withColumn("rank", F.sum("n").over(Window.orderBy(F.desc("bin"))))
    passed = ranked.where(F.pow(F.lit(10.0), -F.col("bin") / params.bins) <= params.false_discovery * F.col("rank") / total.m)
    least = passed.agg(F.min("bin")).first()[0]
    return (float("inf") if least is None else least / params.bins), float(total.mean)


def scan_secrets(docs: DataFrame, params: SecretParams = SecretParams()) -> DataFrame:
    """Secrets of every whole text of ``docs`` (doc_id, text).

    One row per input row: ``doc_id``; ``base`` and ``found``, arrays of (start, no, end) by start and kind
    (``no`` counts ``KINDS``), in code points with exclusive ends, of the base patterns alone and of all;
    ``spans`` and ``base_spans``, the same as ``kind:start:end`` joined by commas. A random run
    inside a base span is not repeated.

    Defined cases: a null or empty text has no secret. Rows that repeat an id, or have a null one,
    are scanned each. The bound for random runs depends on all candidates of the table, so texts are best
    scanned together. An empty table gives an empty result. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    scanned = scratch.keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_scanned()))
    out = _found(scanned, params)
    return out.select("doc_id", "base", "found", _joined(F.col("base")).alias("base_spans"), _joined(F.col("found")).alias("spans"))


def mask_secrets(docs: DataFrame, mark: str, params: SecretParams = SecretParams()) -> DataFrame:
    """``docs`` (text, and any other columns) with each secret of ``text`` replaced by ``mark``.

    All rows and columns stay, nulls too; ``n_chars``, if there, counts the code points of a text that changed
    anew. The texts are scanned a second time, as rows may lack or share the id that a join would need; the
    bound for random runs comes from the first scan.
    """
    scratch = Scratch(docs.sparkSession, "mask-secrets")
    bound, mean = _order_bound(scratch.keep(docs.select(_scanned()[1])), params)
    base, candidates = _scanned()
    rows = docs.select(F.struct(*docs.columns).alias("row"), base, candidates, F.col("text").cast("string").alias("text"))
    spans = F.array_sort(F.concat("base", _plain("random", _random("candidates", "base", bound, mean))))
    rows = rows.select("row", redact(F.col("text"), spans, mark).alias("masked"))
    changed = F.coalesce(F.col("masked") != F.col("row.text"), F.lit(False))
    new = {"text": F.col("masked"), "n_chars": F.when(changed, F.length("masked").cast("long")).otherwise(F.col("row.n_chars") if "n_chars" in docs.columns else F.lit(None))}
    return rows.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])


def _scanned() -> list[Column]:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    assign = F.filter(matches(text, ASSIGN, 2), lambda m: F.length(m["value"]) >= LEAST_ASSIGN)
    kinds = [_plain("assign", assign), _plain("access", matches(text, ACCESS_LONG)), _plain("hex", matches(text, HEX_LONG))]
    base = F.array_sort(F.concat(*kinds))
    return [base.alias("base"), _candidates(text).alias("candidates")]


def _random(candidates: str, base: str, bound: float, mean: float) -> Column:
    """The candidates that pass for random and lie in no base span."""
    passes = F.filter(candidates, lambda c: _weighted(c, mean) < F.lit(bound))
    return F.filter(passes, lambda c: ~F.exists(base, lambda b: (b["start"] <= c["start"]) & (b["end"] >= c["end"])))


def _found(scanned: DataFrame, params: SecretParams) -> DataFrame:
    bound, mean = _order_bound(scanned, params)
    return scanned.withColumn("found", F.array_sort(F.concat("base", _plain("random", _random("candidates", "base", bound, mean)))))


def redact(text: Column, found: Column, mark: str) -> Column:
    """``text`` with every span of ``found`` replaced by ``mark``; spans that overlap become one."""
    first = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        before = F.substring(text, (a["at"] + 1).cast("int"), F.greatest(s["start"] - a["at"], F.lit(0)).cast("int"))
        # A span that starts inside the one before only moves the end.
        out = F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(a["out"], before, F.lit(mark)))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), out.alias("out"))

    done = F.aggregate(found, first, step)
    return F.when(F.size(found) > 0, F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.lit((1 << 31) - 1)))).otherwise(text)
