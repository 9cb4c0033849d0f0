"""French department codes in authority and project names.

Native expressions throughout.  Names are found by pulling the parenthesised
texts out once and looking each up in a literal map, not by trying a hundred
patterns per row; regions by one alternation instead of one pattern each.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from docmonitor import reference_data as ref

NO_CODES = "array<string>"


def _fold(col: Column) -> Column:
    """Case-folded text, with the three letters ``lower`` does not fold on its own."""
    for letter, plain in (("ſ", "s"), ("ı", "i"), ("İ", "i")):
        col = F.replace(col, F.lit(letter), F.lit(plain))
    return F.lower(col)


def _literal_map(pairs: dict) -> Column:
    cells = []
    for key, value in pairs.items():
        cells.append(F.lit(key))
        cells.append(F.array(*map(F.lit, value)) if isinstance(value, list) else F.lit(value))
    return F.create_map(*cells)


def _empty() -> Column:
    return F.array().cast(NO_CODES)


_NAMES = {name.lower(): code for name, code in ref.DEPARTMENTS.items()}
_SPACED_NAMES = {name.lower().replace("-", " "): code for name, code in ref.DEPARTMENTS.items()}
_REGIONS = {
    form: codes
    for name, codes in ref.REGIONS.items()
    for form in (name.lower(), name.lower().replace("-", " "))
}
_REGION_PATTERN = r"(?U)\brégion (" + "|".join(map(re.escape, _REGIONS)) + r")\b"


def department_code(label: Column) -> Column:
    """Two-digit code of a ``Name (NN)`` label, or null."""
    return F.nullif(F.regexp_extract(label, ref.LABEL_CODE_PATTERN, 1), F.lit(""))


def dept_from_authority(authority: Column) -> Column:
    """Code of the last overseas keyword the authority contains, or ``''``."""
    found = F.lit("")
    for keyword, code in ref.AUTHORITIES.items():
        found = F.when(F.contains(authority, F.lit(keyword)), F.lit(code)).otherwise(found)
    return found


def dept_numbers(project: Column) -> Column:
    """Codes written as numbers in parentheses, in text order, repeats kept."""
    groups = F.regexp_extract_all(project, F.lit(ref.CODE_GROUP_PATTERN), F.lit(1))
    # "(" cannot occur inside a group, so no code reaches across two of them
    text = F.replace(F.array_join(groups, "("), F.lit("+"), F.lit(" "))
    return F.when(
        F.contains(project, F.lit("(")),
        F.regexp_extract_all(text, F.lit(ref.CODE_PATTERN), F.lit(1)),
    ).otherwise(_empty())


def dept_names(project: Column) -> Column:
    """Codes of names in parentheses; the spaced spelling counts at the end only."""
    text = _fold(project)
    groups = F.regexp_extract_all(text, F.lit(r"\(([^()]*)\)"), F.lit(1))
    last = F.regexp_extract(text, r"\(([^()]*)\)\n?\z", 1)
    anywhere = F.transform(groups, lambda g: F.try_element_at(_literal_map(_NAMES), g))
    at_end = F.try_element_at(_literal_map(_SPACED_NAMES), last)
    return F.when(
        F.contains(project, F.lit("(")),
        F.array_compact(F.concat(anywhere, F.array(at_end))),
    ).otherwise(_empty())


def dept_regions(project: Column) -> Column:
    """All codes of every ``région <Name>`` in the text."""
    text = _fold(project)
    found = F.regexp_extract_all(text, F.lit(_REGION_PATTERN), F.lit(1))
    codes = F.transform(found, lambda r: F.try_element_at(_literal_map(_REGIONS), r))
    return F.when(F.contains(text, F.lit("région ")), F.flatten(codes)).otherwise(_empty())


def sorted_codes(codes: Column) -> Column:
    return F.array_sort(F.array_distinct(codes))


def depts_from_project(project: Column) -> Column:
    """Numbers, else names, else regions: sorted, without repeats."""
    numbers, names = dept_numbers(project), dept_names(project)
    return sorted_codes(
        F.when(F.size(numbers) > 0, numbers)
        .when(F.size(names) > 0, names)
        .otherwise(dept_regions(project))
    )
