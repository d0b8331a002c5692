"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelflife.functions import fixed

# All white space a Python-style strip removes, at either end.
_OUTER_SPACE = r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_filled(*texts: Column) -> Column:
    """The first argument that is neither null nor empty."""
    return F.coalesce(*[blank_to_null(text) for text in texts])


def fill(template: str, *values: Column) -> Column:
    """Put values into the ``{}`` places of a template; null if any value is null."""
    pieces = template.split("{}")
    parts = [F.lit(pieces[0])]
    for value, piece in zip(values, pieces[1:], strict=True):
        parts += [value, F.lit(piece)]
    return F.concat(*parts)


def is_blank(text: Column) -> Column:
    return text.isNull() | (text == "")


def name_key(text: Column) -> Column:
    """Comparison key that ignores case and outer spaces (spaces only)."""
    return F.lower(F.trim(text))


def strip(text: Column) -> Column:
    """Remove outer white space of any kind."""
    return F.regexp_replace(text, _OUTER_SPACE, "")


def last_guid(text: Column) -> Column:
    """The last GUID in the text, null when there is none."""
    return F.try_element_at(
        F.regexp_extract_all(text, F.lit(fixed.GUID_PATTERN), F.lit(0)), F.lit(-1)
    )


def flexible_bool(text: Column) -> Column:
    """Boolean that arrives as a JSON boolean or as text; anything else is false."""
    return F.coalesce(F.lower(text) == "true", F.lit(False))


def collapse_files_folder(path: Column) -> Column:
    """Replace the first ``/Files/Files/`` by ``/Files/``; later ones stay."""
    collapsed = F.regexp_replace(path, r"(?s)\A(.*?)/Files/Files/", "$1/Files/")
    return F.when(path.contains("/Files/Files/"), collapsed).otherwise(path)  # few paths have any


def is_reserved(name: Column) -> Column:
    return name.isin(fixed.RESERVED_NAMES)


def is_read_only(activity: Column) -> Column:
    return activity.isin(fixed.READ_ONLY_ACTIVITIES)


def modifies(activity: Column) -> Column:
    """Keep an event: unknown and missing activities count as modifications.

    Written as an OR, not over a coalesce, so that Parquet scans can push it down.
    """
    return activity.isNull() | ~is_read_only(activity)


def personal_label(owner: Column, masked: bool) -> Column:
    """Name of a personal workspace; the owner shows only when not masked."""
    if masked:
        return F.lit(fixed.PERSONAL_LABEL)
    shown = F.coalesce(blank_to_null(owner), F.lit("unknown"))
    return F.concat(F.lit(f"{fixed.PERSONAL_LABEL} ("), shown, F.lit(")"))
