"""Multi-valued cells: strings that hold a list joined by ``|||``."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquarry.functions.text import trim_u

SEPARATOR = "|||"
_SPLIT = r"\|\|\|"
_STRINGS = "array<string>"


def split_cell(cell: Column) -> Column:
    """Parts of a cell as they stand; a null cell stays null."""
    return F.split(cell, _SPLIT)


def trimmed_parts(cell: Column) -> Column:
    """Trimmed parts, empty ones kept: ``''`` gives ``['']``."""
    return F.transform(split_cell(cell), trim_u)


def cell_list(cell: Column) -> Column:
    """Trimmed non-empty parts; a missing cell gives ``[]``."""
    parts = F.filter(trimmed_parts(cell), lambda part: part != "")
    return F.coalesce(parts, F.array().cast(_STRINGS))


def first_part(cell: Column) -> Column:
    """First part, not trimmed; null for a missing cell."""
    return F.element_at(split_cell(cell), 1)


def join_cell(values: Column) -> Column:
    """The string form of a list; an empty list gives ``''``."""
    return F.array_join(values, SEPARATOR)
