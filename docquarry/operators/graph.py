"""Metadata of documents from RDF quads ``(g, s, p, o, o_lang)``.

The rows wanted are one per (work, date, language) with the distinct values of eleven properties.
Joining all properties first would multiply them with each other for every work, only for the
duplicates to be dropped again. Here every property is reduced to a set first: one aggregation per
(graph, work), one per expression and one per manifested expression; only these one-row-per-key
frames are joined. That is exact, as properties of a work correlate through the graph alone, and
the CELEX order of preference holds per (graph, work).
"""

import datetime
from collections.abc import Sequence
from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.functions.cells import join_cell
from docquarry.operators.calendar import with_window, with_window_bounds
from docquarry.sources.tables import stored

ENGLISH = "en"


@dataclass(frozen=True)
class Vocabulary:
    """Predicate names (fixed values); ``with_prefixes`` turns them into full IRIs."""

    type: str = "rdf:type"
    label: str = "prefLabel"
    identifier: str = "identifier"
    date: str = "work_date_document"
    work_id: str = "work_id_document"
    resource_type: str = "work_has_resource-type"
    celex_1: str = "resource_legal_id_celex"
    celex_2: str = "resource_legal_celex_number"
    celex_3: str = "work_id_celex"
    eli: str = "resource_legal_eli"
    procedure: str = "procedure_id"
    directory_code: str = "resource_legal_is_about_concept_directory_code"
    subject: str = "work_is_about_concept_eurovoc"
    expression_work: str = "expression_belongs_to_work"
    title: str = "expression_title"
    language: str = "expression_uses_language"
    manifestation_expression: str = "manifestation_manifests_expression"
    manifestation_type: str = "manifestation_type"
    contributed: str = "work_contributed_to_by_agent"
    created: str = "work_created_by_agent"
    authored: str = "work_authored_by_agent"

    def with_prefixes(self, cdm: str, skos: str, dc: str, rdf: str) -> "Vocabulary":
        prefix = {"type": rdf, "label": skos, "identifier": dc}
        full = {f.name: prefix.get(f.name, cdm) + getattr(self, f.name) for f in fields(self)}
        return replace(self, **{**full, "type": rdf + "type"})

    @property
    def agents(self) -> tuple[str, str, str]:
        return self.contributed, self.created, self.authored


VOCABULARY = Vocabulary()


def pattern(quads: DataFrame, *predicates: str) -> DataFrame:
    """Quads of the given predicates: a partition-pruned scan of stored quads."""
    if len(predicates) == 1:
        return quads.filter(F.col("p") == predicates[0])
    return quads.filter(F.col("p").isin(*predicates))


def dated_works(quads: DataFrame, start: str, end: str, vocabulary: Vocabulary = VOCABULARY) -> DataFrame:
    """Distinct works with any date in ``[start, end)``; the range is pushed to the scan."""
    dates = pattern(quads, vocabulary.date).filter((F.col("o") >= start) & (F.col("o") < end))
    return dates.select(F.col("s").alias("work")).distinct()


def _among(rows: DataFrame, keys: DataFrame, column: str = "work") -> DataFrame:
    return rows.join(keys.select(F.col(keys.columns[0]).alias(column)), column, "left_semi")


def _few(keys: DataFrame) -> bool:
    """Whether Spark broadcasts these keys by its own estimate, which for a written table is its real size.

    Rows are then filtered by them before they are gathered. Otherwise both sides would be shuffled to meet: the rows
    are better shuffled once, to be gathered by that key, and what was gathered is filtered where it is.
    """
    threshold = keys.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(keys._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= threshold


def window_works(
    quads: DataFrame,
    start: str,
    end: str,
    vocabulary: Vocabulary = VOCABULARY,
    limit: int | None = None,
    offset: int = 0,
) -> DataFrame:
    """Distinct works with a type, a document id and any date in the half-open window."""
    works = dated_works(quads, start, end, vocabulary)
    for predicate in (vocabulary.work_id, vocabulary.type):
        works = _among(pattern(quads, predicate).select(F.col("s").alias("work")), works)
    works = works.distinct()
    if limit is None and not offset:
        return works
    works = works.orderBy("work").offset(offset)
    return works if limit is None else works.limit(limit)


def labels(quads: DataFrame, lang: str = ENGLISH, vocabulary: Vocabulary = VOCABULARY) -> DataFrame:
    """``(label_graph, node, label)`` with exactly the given language tag."""
    tagged = pattern(quads, vocabulary.label).filter(F.col("o_lang") == lang)
    return tagged.select(F.col("g").alias("label_graph"), F.col("s").alias("node"), F.col("o").alias("label"))


def any_graph_labels(quads: DataFrame, vocabulary: Vocabulary = VOCABULARY) -> DataFrame:
    return labels(quads, vocabulary=vocabulary).select("node", "label").distinct()


@dataclass(frozen=True)
class Names:
    """What codes stand for: labels of the own graph (g, o, label), of any graph (node, label), identifiers of languages (o, ident)."""

    own_graph: DataFrame
    any_graph: DataFrame
    idents: DataFrame


def names_of(quads: DataFrame, vocabulary: Vocabulary = VOCABULARY) -> Names:
    graph_labels = labels(quads, vocabulary=vocabulary).withColumnRenamed("label_graph", "g").withColumnRenamed("node", "o")
    idents = pattern(quads, vocabulary.identifier).select(F.col("s").alias("o"), F.col("o").alias("ident")).distinct()
    return Names(graph_labels, any_graph_labels(quads, vocabulary), idents)


def stored_names(quads: DataFrame, path: str, vocabulary: Vocabulary = VOCABULARY) -> Names:
    """``names_of``, for the codes that are used, as written tables.

    There are as many as the vocabularies have terms, however many works use them. Labels of all nodes, agents among
    them, would be estimated as large, and every quad with a code be shuffled to meet its label.
    """
    v, names = vocabulary, names_of(quads, vocabulary)
    about = F.col("p") == v.subject
    used = pattern(quads, v.resource_type, v.directory_code, v.subject).select(about.alias("about"), F.when(~about, F.col("g")).alias("g"), "o")
    used = stored(used.distinct(), f"{path}/used")
    return Names(
        stored(names.own_graph.join(used.filter("NOT about").select("g", "o"), ["g", "o"], "left_semi").distinct(), f"{path}/own"),
        stored(_among(labels(quads, vocabulary=v), used.filter("about").select("o"), "node").select("node", "label").distinct(), f"{path}/any"),
        stored(names.idents, f"{path}/idents"),
    )


def _sets(rows: DataFrame, key: str, kinds: Sequence[str]) -> DataFrame:
    """Sorted distinct values of every kind, one row per graph and key, from (g, key, kind, value) rows.

    ``kind`` is a place in ``kinds``. All graphs of a key are gathered in one place: what is grouped or joined by that
    key afterwards is there already, and not shuffled again. One set per key and map task is built before the shuffle,
    so repeated values of a key that holds very many rows never leave their task.
    """
    pairs = rows.groupBy(key).agg(F.sort_array(F.collect_set(F.struct("g", "kind", "value"))).alias("pairs"))
    per_graph = pairs.select(key, "pairs", F.explode(F.array_distinct("pairs.g")).alias("g"))
    per_graph = per_graph.select("g", key, F.filter("pairs", lambda pair: pair["g"].eqNullSafe(F.col("g"))).alias("pairs"))

    def values(kind: int) -> Column:
        return F.transform(F.filter("pairs", lambda pair: pair["kind"] == F.lit(kind)), lambda pair: pair["value"])

    return per_graph.select("g", key, *[values(i).alias(kind) for i, kind in enumerate(kinds)])


def _kind_of(names: dict[str, str], kinds: Sequence[str]) -> Column:
    """Place in ``kinds`` of the predicate in column ``p``."""
    kind = F.lit(None).cast("byte")
    for predicate, name in names.items():
        kind = F.when(F.col("p") == predicate, F.lit(kinds.index(name)).cast("byte")).otherwise(kind)
    return kind


def preferred_celex(first: Column, second: Column, third: Column) -> Column:
    """The first of three sets that is not empty."""
    return F.when(F.size(first) > 0, first).when(F.size(second) > 0, second).otherwise(third)


_WORK_KINDS = (
    "type", "id", "dates", "c1", "c2", "c3", "eli_ids", "procedure_ids", "work_types", "directory_codes", "subjects",
)
_WORK_SETS = ("work_types", "celex_ids", "eli_ids", "procedure_ids", "directory_codes", "subjects")


def work_properties(
    quads: DataFrame, works: DataFrame, vocabulary: Vocabulary = VOCABULARY, names: Names | None = None
) -> DataFrame:
    """One row per (graph, work) that has type, date, id and a labelled subject, with its sets.

    Labels of resource types and directory codes count only from the work's own graph, subject
    labels from any. A missing label leaves the optional sets empty.
    """
    v, few = vocabulary, _few(works)
    names = names_of(quads, v) if names is None else names
    direct = {
        v.type: "type",
        v.work_id: "id",
        v.date: "dates",
        v.celex_1: "c1",
        v.celex_2: "c2",
        v.celex_3: "c3",
        v.eli: "eli_ids",
        v.procedure: "procedure_ids",
    }
    own_graph = {v.resource_type: "work_types", v.directory_code: "directory_codes"}

    def of_works(*predicates: str) -> DataFrame:
        found = pattern(quads, *predicates).select("g", F.col("s").alias("work"), "p", "o")
        return _among(found, works) if few else found

    # Only the existence of a type or an id matters, so their values are not carried.
    exists_only = F.col("p").isin(v.type, v.work_id)
    rows = of_works(*direct).select(
        "g", "work", _kind_of(direct, _WORK_KINDS).alias("kind"), F.when(exists_only, "").otherwise(F.col("o")).alias("value")
    )
    coded = of_works(*own_graph).join(names.own_graph, ["g", "o"])
    rows = rows.unionByName(coded.select("g", "work", _kind_of(own_graph, _WORK_KINDS).alias("kind"), F.col("label").alias("value")))
    about = of_works(v.subject).join(names.any_graph.withColumnRenamed("node", "o"), "o")
    subject = F.lit(_WORK_KINDS.index("subjects")).cast("byte")
    rows = rows.unionByName(about.select("g", "work", subject.alias("kind"), F.col("label").alias("value")))

    sets = _sets(rows, "work", _WORK_KINDS)
    mandatory = [F.size(c) > 0 for c in ("type", "id", "dates", "subjects")]
    complete = sets.filter(mandatory[0] & mandatory[1] & mandatory[2] & mandatory[3])
    if not few:
        complete = _among(complete, works)
    celex = preferred_celex(F.col("c1"), F.col("c2"), F.col("c3"))
    return complete.withColumn("celex_ids", celex).drop("type", "id", "c1", "c2", "c3")


def _merge_sets(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Union of sorted sets per key; rows with equal sets collapse where they are."""
    grouped = df.groupBy(*keys).agg(F.collect_set(F.struct(*columns)).alias("sets"))
    merged = [F.array_sort(F.array_distinct(F.flatten(f"sets.{c}"))).alias(c) for c in columns]
    return grouped.select(*keys, *merged)


def work_dates(quads: DataFrame, works: DataFrame, vocabulary: Vocabulary = VOCABULARY, names: Names | None = None) -> DataFrame:
    """One row per (work, date), the sets of its graphs merged; hash-partitioned by work."""
    per_graph = work_properties(quads, works, vocabulary, names).drop("g")
    dated = per_graph.withColumn("date", F.explode("dates"))
    return _merge_sets(dated, ("work", "date"), _WORK_SETS)


def _in_language(quads: DataFrame, idents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(g, exp) of the expressions in a language of ``idents`` (o, ident)."""
    uses = pattern(quads, vocabulary.language).select("g", F.col("s").alias("exp"), "o")
    return uses.join(idents, "o", "left_semi").select("g", "exp")


def works_in_language(quads: DataFrame, works: DataFrame, lang: str, vocabulary: Vocabulary = VOCABULARY) -> DataFrame:
    """Those of ``works`` (work) that have an expression in a language; no other gives rows of that language."""
    v = vocabulary
    idents = pattern(quads, v.identifier).filter(F.col("o") == lang).select(F.col("s").alias("o"))
    belongs = pattern(quads, v.expression_work).select("g", F.col("s").alias("exp"), F.col("o").alias("work"))
    spoken = _among(belongs, works).join(_in_language(quads, idents, v), ["g", "exp"], "left_semi")
    return _among(works, spoken.select("work"))


_EXPRESSION_KINDS = ("works", "titles", "langs")


def work_languages(
    quads: DataFrame, works: DataFrame, lang: str | None = None, vocabulary: Vocabulary = VOCABULARY, names: Names | None = None
) -> DataFrame:
    """One row per (work, language): titles and manifestation types of its expressions."""
    v = vocabulary
    belongs = pattern(quads, v.expression_work).select("g", F.col("s").alias("exp"), F.col("o").alias("work"))
    idents = (names_of(quads, v) if names is None else names).idents
    titled = pattern(quads, v.title, v.language).select("g", F.col("s").alias("exp"), "p", "o")
    manifests = pattern(quads, v.manifestation_expression).select("g", F.col("s").alias("man"), F.col("o").alias("exp"))
    early = lang is not None or _few(works)
    if early:
        belongs = _among(belongs, works)
        if lang is not None:
            # The language acts first: of other expressions neither titles nor manifestations are looked up.
            idents = idents.filter(F.col("ident") == lang)
            belongs = belongs.join(_in_language(quads, idents, v), ["g", "exp"], "left_semi")
        titled = titled.join(belongs.select("g", "exp"), ["g", "exp"], "left_semi")
        manifests = _among(manifests, belongs.select("exp"), "exp")

    # Titles and languages come from one scan; a language is replaced by its identifier.
    spoken = F.col("p") == v.language
    named = titled.join(idents.withColumnRenamed("o", "node"), spoken & (F.col("o") == F.col("node")), "left")
    named = named.withColumn("value", F.when(spoken, F.col("ident")).otherwise(F.col("o"))).filter("value IS NOT NULL")

    works_kind, titles_kind, langs_kind = [F.lit(i).cast("byte") for i in range(len(_EXPRESSION_KINDS))]
    rows = belongs.select("g", "exp", works_kind.alias("kind"), F.col("work").alias("value"))
    rows = rows.unionByName(named.select("g", "exp", F.when(spoken, langs_kind).otherwise(titles_kind).alias("kind"), "value"))
    expressions = _sets(rows, "exp", _EXPRESSION_KINDS)
    expressions = expressions.filter((F.size("works") > 0) & (F.size("titles") > 0) & (F.size("langs") > 0))

    types = pattern(quads, v.manifestation_type).select("g", F.col("s").alias("man"), F.col("o").alias("mtype"))
    mtypes = manifests.join(types, ["g", "man"]).groupBy("exp").agg(F.sort_array(F.collect_set("mtype")).alias("mtypes"))

    by_work = expressions.join(mtypes, "exp").select(F.explode("works").alias("work"), "langs", "titles", "mtypes")
    by_work = by_work.repartition("work")
    if not early:
        by_work = _among(by_work, works)
    by_lang = by_work.select("work", F.explode("langs").alias("lang_id"), "titles", "mtypes")
    return _merge_sets(by_lang, ("work", "lang_id"), ("titles", "mtypes"))


def work_agents(quads: DataFrame, works: DataFrame, vocabulary: Vocabulary = VOCABULARY) -> DataFrame:
    """English names of contributing, creating and authoring agents per work."""
    v = vocabulary
    links = pattern(quads, *v.agents).select(F.col("s").alias("work"), F.col("o").alias("node"))
    few = _few(works)
    named = (_among(links, works) if few else links).join(any_graph_labels(quads, v), "node")
    agents = named.groupBy("work").agg(F.sort_array(F.collect_set("label")).alias("authors"))
    return agents if few else _among(agents, works)


def assemble_metadata(
    quads: DataFrame,
    start: str,
    end: str,
    lang: str | None = None,
    vocabulary: Vocabulary = VOCABULARY,
    works: DataFrame | None = None,
    names: Names | None = None,
) -> DataFrame:
    """One row per (work, date, language) of the works with a date in ``[start, end)``.

    A work with two dates comes back with both. ``works`` may name the works instead, as a stored
    one-column table: Spark then knows its real size, and broadcasts it or not by that. Type and
    id need not be asked of these works again, as every output row demands both in its own graph.
    ``names`` may be ``stored_names``: quads with codes are then not shuffled.
    """
    selected = dated_works(quads, start, end, vocabulary) if works is None else works
    dated = work_dates(quads, selected, vocabulary, names)
    spoken = work_languages(quads, selected, lang, vocabulary, names)
    agents = work_agents(quads, selected, vocabulary)
    return (
        dated.join(spoken, "work")
        .join(agents, "work", "left")
        .select(
            F.array("work").alias("cellar_uris"),
            "titles",
            "lang_id",
            "mtypes",
            "work_types",
            F.coalesce("authors", F.array().cast("array<string>")).alias("authors"),
            "date",
            "subjects",
            "celex_ids",
            "eli_ids",
            "procedure_ids",
            "directory_codes",
        )
    )


def works_by_window(quads: DataFrame, today: datetime.date, total_days: int, step: int, vocabulary: Vocabulary = VOCABULARY) -> DataFrame:
    """Distinct (work, window_no): every lookback window a work has a date in."""
    # The span as text reaches the scan; the window number is arithmetic on what it lets through.
    first = (today - datetime.timedelta(days=total_days - 1)).isoformat()
    near = pattern(quads, vocabulary.date).filter((F.col("o") >= first) & (F.col("o") < (today + datetime.timedelta(days=1)).isoformat()))
    dates = near.select(F.col("s").alias("work"), F.col("o").alias("date"))
    return with_window(dates, today, total_days, step).select("work", "window_no").distinct()


def metadata_by_window(
    quads: DataFrame,
    today: datetime.date,
    total_days: int,
    step: int = 1,
    lang: str | None = None,
    vocabulary: Vocabulary = VOCABULARY,
    members: DataFrame | None = None,
    names: Names | None = None,
) -> DataFrame:
    """Metadata rows with the window they are mined in, all windows in one job.

    A row belongs to the windows of its *work*: one whose own date lies elsewhere is still mined
    where another date of the work falls. ``members`` may be a stored ``works_by_window`` table, ``names`` ``stored_names``.
    """
    if members is None:
        members = works_by_window(quads, today, total_days, step, vocabulary)
    works = members.select("work").distinct()
    rows = assemble_metadata(quads, "", "", lang, vocabulary, works=works, names=names)
    placed = rows.withColumn("work", F.get("cellar_uris", F.lit(0))).join(members, "work").drop("work")
    return with_window_bounds(placed, today, total_days, step)


# String column <- list column, for the cell form of the metadata.
_CELLS = {
    "cellarURIs": "cellar_uris",
    "title": "titles",
    "mtypes": "mtypes",
    "workTypes": "work_types",
    "authors": "authors",
    "subjects": "subjects",
    "celexIds": "celex_ids",
    "eliIds": "eli_ids",
    "procedureIds": "procedure_ids",
    "directoryCodes": "directory_codes",
}


def as_bindings(metadata: DataFrame) -> DataFrame:
    """The string form of assembled metadata, one ``|||`` cell per list."""
    cells = [join_cell(F.col(c)).alias(v) for v, c in _CELLS.items()]
    return metadata.select(*cells, F.col("lang_id").alias("langIdentifier"), "date")
