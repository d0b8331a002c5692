"""Activity events from landed pages, one folder per requested day."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflife.functions import fixed, text, times
from shelflife.schemas import entry_seq
from shelflife.sources.pages import entries

# The fields an event is read for, and how each may be spelled.
_FIELDS = {
    "activity": fixed.ACTIVITY_KEYS,
    "time": fixed.TIME_KEYS,
    "direct_id": fixed.DIRECT_ID_KEYS,
    "other_id": fixed.OTHER_ID_KEYS,
    "object_url": fixed.OBJECT_URL_KEYS,
    "name": fixed.NAME_KEYS,
    "type": fixed.TYPE_KEYS,
    "workspace_id": fixed.WORKSPACE_ID_KEYS,
    "workspace_name": fixed.WORKSPACE_NAME_KEYS,
    "user": fixed.USER_KEYS,
}

# from_json tells spellings that differ by case apart, but column resolution does not.
# So the parsed struct is renamed by position: activity_0, activity_1, time_0, ...
_SPELLED = ",".join(f"`{key}`:string" for keys in _FIELDS.values() for key in keys)
_NUMBERED = ",".join(
    f"{field}_{i}:string" for field, keys in _FIELDS.items() for i in range(len(keys))
)


def event_entries(pages: DataFrame) -> DataFrame:
    """One row per event: ``event_date`` (the requested day), ``seq`` and the fields ``e``."""
    found = entries(
        pages,
        f"activityEventEntities array<struct<{_SPELLED}>>",
        lambda body: body["activityEventEntities"].cast(f"array<struct<{_NUMBERED}>>"),
    )
    return found.select("event_date", entry_seq().alias("seq"), "e")


def _field(name: str) -> Column:
    """The first filled spelling of a field, null when all are missing or blank."""
    return text.first_filled(*[F.col(f"e.{name}_{i}") for i in range(len(_FIELDS[name]))])


def parsed_events(pages: DataFrame, mail_dates: bool = False) -> DataFrame:
    """Named columns for every event, nothing filtered.

    Missing text is empty, except the raw time and the id, whose absence decides
    whether an event is kept.  ``mail_dates`` also accepts ``17 Mar 2026 12:00:00``.
    """
    return event_entries(pages).select("event_date", "seq", *_columns(_field, mail_dates))


def _columns(field: Callable[[str], Column], mail_dates: bool) -> list[Column]:
    """The named columns of an event, from a way to read a field."""
    parse = times.parse_any if mail_dates else times.parse_iso

    def filled(name: str) -> Column:
        return F.coalesce(field(name), F.lit(""))

    direct, raw_time = field("direct_id"), field("time")
    url_id = text.last_guid(field("object_url"))
    return [
        raw_time.alias("raw_time"),
        parse(raw_time).alias("event_timestamp"),
        filled("activity").alias("activity"),
        direct.isNotNull().alias("has_direct_id"),
        F.coalesce(direct, field("other_id"), url_id).alias("artifact_id"),
        filled("name").alias("artifact_name"),
        filled("type").alias("artifact_type"),
        filled("workspace_id").alias("workspace_id"),
        filled("workspace_name").alias("workspace_name"),
        filled("user").alias("user_id"),
    ]


# Every spelling that some field is read by.
LISTED = [key for keys in _FIELDS.values() for key in keys]


def event_variants(pages: DataFrame) -> DataFrame:
    """One row per event with all its fields: ``event_date``, ``seq`` and the variant ``e``."""
    found = entries(pages, "activityEventEntities array<variant>", lambda body: body["activityEventEntities"])
    return found.select("event_date", entry_seq().alias("seq"), "e")


def parsed_variants(pages: DataFrame, mail_dates: bool = False) -> DataFrame:
    """The columns of :func:`parsed_events`, and ``extra``: the event's other fields as variants.

    A page is parsed once; each field is read from the variant, by any of its spellings.
    """

    def field(name: str) -> Column:
        return text.first_filled(*[F.try_variant_get("e", f"$['{key}']", "string") for key in _FIELDS[name]])

    whole = F.try_variant_get("e", "$", "map<string,variant>")
    extra = F.map_filter(whole, lambda key, _: ~key.isin(LISTED))
    return event_variants(pages).select("event_date", "seq", *_columns(field, mail_dates), extra.alias("extra"))


def unlisted_fields(events: DataFrame) -> DataFrame:
    """One row per event of :func:`parsed_variants` and field no spelling lists, its value as text.

    Objects and arrays are JSON text; a JSON null is null.
    """
    kept = ["event_date", "seq", "event_timestamp", "artifact_id"]
    return events.select(*kept, F.explode("extra").alias("key", "v")).select(
        *kept, "key", F.col("v").cast("string").alias("value")
    )


def discovered_schema(pages: DataFrame) -> str:
    """The type of all events' fields together, as far as they agree: one small row."""
    return event_variants(pages).agg(F.schema_of_variant_agg("e").alias("kind")).first()["kind"]


def with_fields(events: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Columns for some of the other fields, by name and type; null where a value is of another type."""
    columns = [F.try_variant_get(F.get(F.map_values(_only(name)), F.lit(0)), "$", kind).alias(name) for name, kind in kinds.items()]
    return events.select("*", *columns)


def _only(name: str) -> Column:
    return F.map_filter("extra", lambda key, _: key == F.lit(name))
