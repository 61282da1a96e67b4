"""Every schema of the data model, declared once."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRING = T.StringType()
_STRINGS = T.ArrayType(_STRING)

# The document columns, in the order they are written.
DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("url", _STRING),
        T.StructField("celex", _STRING),
        T.StructField("eli", _STRING),
        T.StructField("title", _STRING),
        T.StructField("date", _STRING),
        T.StructField("lang", _STRING),
        T.StructField("institutions", _STRINGS),
        T.StructField("work_types", _STRINGS),
        T.StructField("procedure_ids", _STRINGS),
        T.StructField("directory_codes", _STRINGS),
        T.StructField("formats", _STRINGS),
        T.StructField("eurovoc_concepts", _STRINGS),
        T.StructField("eurovoc_concepts_ids", _STRINGS),
        T.StructField("text", _STRING),
    ]
)

QUAD_SCHEMA = T.StructType([T.StructField(c, _STRING) for c in ("g", "s", "p", "o", "o_lang")])

# The variables of one metadata result row.
BINDING_VARIABLES = (
    "cellarURIs",
    "title",
    "langIdentifier",
    "mtypes",
    "workTypes",
    "authors",
    "date",
    "subjects",
    "workIds",
    "celexIds",
    "eliIds",
    "procedureIds",
    "directoryCodes",
)
BINDINGS_SCHEMA = T.StructType([T.StructField(c, _STRING) for c in BINDING_VARIABLES])

# One result file: {"results": {"bindings": [{variable: {"type": ..., "value": ...}}]}}
RESULT_FILE_SCHEMA = T.StructType(
    [
        T.StructField(
            "results",
            T.StructType(
                [
                    T.StructField(
                        "bindings",
                        T.ArrayType(
                            T.MapType(
                                _STRING,
                                T.StructType([T.StructField("type", _STRING), T.StructField("value", _STRING)]),
                            )
                        ),
                    )
                ]
            ),
        )
    ]
)

TAXONOMY_SCHEMA = T.StructType([T.StructField("term_key", _STRING), T.StructField("concept_id", _STRING)])

PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("url", _STRING),
        T.StructField("format", _STRING),
        T.StructField("lang", _STRING),
        T.StructField("content", T.BinaryType()),
    ]
)

# What a run set aside: rows that lack required fields (``quarantine``), and documents without text (``extraction``).
PROBLEM_SCHEMA = T.StructType(
    [
        T.StructField("kind", _STRING),
        T.StructField("missing", _STRINGS),
        T.StructField("error", _STRING),
        T.StructField("format", _STRING),
        *[f for f in DOCUMENT_SCHEMA.fields if f.name != "text"],
    ]
)

INVENTORY_SCHEMA = T.StructType(
    [T.StructField("date", _STRING), T.StructField("path", _STRING), T.StructField("num_rows", T.LongType())]
)

PLAN_SCHEMA = T.StructType([T.StructField("date", _STRING), T.StructField("reason", _STRING)])

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("date", _STRING),
        T.StructField("reason", _STRING),
        T.StructField("status", _STRING),
        T.StructField("n_rows", T.LongType()),
        T.StructField("path", _STRING),
        T.StructField("error", _STRING),
    ]
)

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("day", _STRING),
        T.StructField("scope", _STRING),
        T.StructField("status", _STRING),
        T.StructField("n_rows", T.LongType()),
        T.StructField("error", _STRING),
        T.StructField("run_id", _STRING),
        T.StructField("seq", T.LongType()),
        T.StructField("attempt", _STRING),
        T.StructField("columns", _STRING),
    ]
)

RANGE_MANIFEST_SCHEMA = T.StructType([T.StructField("window_start", _STRING), T.StructField("window_end", _STRING), *MANIFEST_SCHEMA.fields[1:]])


def conform(df: DataFrame, schema: T.StructType, keep_extra: bool = False) -> DataFrame:
    """Project to the declared columns, in order and cast; columns the frame lacks become null.

    With ``keep_extra`` the frame's other columns follow (the ``match_*`` tail).
    """
    present = set(df.columns)
    cols = [
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ]
    if keep_extra:
        declared = set(schema.fieldNames())
        cols += [F.col(f"`{c}`") for c in df.columns if c not in declared]
    return df.select(*cols)
