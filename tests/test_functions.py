"""Edge rows of the column expressions."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, moment
from shelflife.functions import scoring, text, times

T10 = datetime(2026, 1, 1, 10)
MAIL = datetime(2026, 3, 17, 12)


def evaluate(spark, values, expression, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = frame.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()
    return [row["r"] for row in rows]


@pytest.mark.parametrize(
    "raw, iso, mail",
    [
        (None, None, None),
        ("", None, None),
        ("garbage", None, None),
        ("2026", None, None),
        ("2026-01", None, None),
        ("2026-02-30T10:00:00Z", None, None),
        ("2026-01-01", datetime(2026, 1, 1), datetime(2026, 1, 1)),
        ("2026-01-01T10:00:00Z", T10, T10),
        ("2026-01-01T10:00:00+05:00", T10, T10),
        ("2026-01-01T10:00:00-0800", T10, T10),
        ("2026-01-01 10:00:00", T10, T10),
        ("2026-01-01T10:00", T10, T10),
        ("2026-01-01T10:00:00.1234567Z", datetime(2026, 1, 1, 10, 0, 0, 123456), datetime(2026, 1, 1, 10, 0, 0, 123456)),
        ("2026-01-01T10:00:00 and more", T10, T10),
        ("2026-1-1T10:00:00", T10, T10),
        ("Tue, 17 Mar 2026 12:00:00 GMT", None, MAIL),
        ("17 Mar 2026 12:00:00 +0200", None, MAIL),
        ("Tue, 17 Mar 26 12:00:00 GMT", None, MAIL),
        ("17 Mar 69 12:00 GMT", None, datetime(1969, 3, 17, 12)),
        ("20260317T120000Z", MAIL, MAIL),
        ("20260317", datetime(2026, 3, 17), datetime(2026, 3, 17)),
        ("2026-03-17T120000", MAIL, MAIL),
        ("20260317 12:00:00.5", datetime(2026, 3, 17, 12, 0, 0, 500000), datetime(2026, 3, 17, 12, 0, 0, 500000)),
        ("2026-03-17T12:00:00,25+01:00", datetime(2026, 3, 17, 12, 0, 0, 250000), datetime(2026, 3, 17, 12, 0, 0, 250000)),
        ("2026-0317", None, None),
        ("20260230", None, None),
        ("2026-W12-2", datetime(2026, 3, 17), datetime(2026, 3, 17)),
        ("2026W122T120000", MAIL, MAIL),
        ("2026-W12", datetime(2026, 3, 16), datetime(2026, 3, 16)),
        ("2026-W53-5", datetime(2027, 1, 1), datetime(2027, 1, 1)),
        ("2027-W53-1", None, None),
        ("2026-W00-1", None, None),
        ("2026-01-01T10", T10, T10),
        ("Tue, 17 Foo 2026 12:00:00 GMT", None, None),
        ("Tue, 17 Anf 2026 12:00:00 GMT", None, None),
        ("Tue, 41 Mar 2026 12:00:00 GMT", None, None),
    ],
)
def test_time_parsing(spark, raw, iso, mail):
    assert evaluate(spark, [raw], times.parse_iso) == [iso]
    assert evaluate(spark, [raw], times.parse_any) == [mail]


def test_time_parsing_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist on this day in New York.
        found = evaluate(
            spark, ["2026-03-08T02:30:00Z", "Sun, 08 Mar 2026 02:30:00 GMT"], times.parse_any
        )
        reference = evaluate(spark, [moment("2026-03-08T02:30:00")], lambda v: times.plus_days(v, F.lit(1)), "timestamp_ntz")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == [datetime(2026, 3, 8, 2, 30)] * 2
    assert reference == [datetime(2026, 3, 9, 2, 30)]


@pytest.mark.parametrize(
    "reference, days",
    [
        ("2026-03-10T12:00:00", 10),
        ("2026-03-10T12:00:01", 9),
        ("2026-03-10T11:59:59", 10),
        ("2026-03-20T12:00:00", 0),
        ("2026-03-20T12:00:01", -1),
        ("2026-03-21T12:00:00", -1),
        ("2026-03-21T12:00:01", -2),
        (None, None),
    ],
)
def test_age_rounds_down_also_below_zero(spark, reference, days):
    age = evaluate(
        spark, [moment(reference)],
        lambda v: times.whole_days_between(v, times.at(AS_OF)), "timestamp_ntz",
    )
    assert age == [days]


def test_last_guid(spark):
    a, b = "0000000a-0000-4000-8000-000000000001", "0000000B-0000-4000-8000-000000000002"
    values = [f"https://x/groups/{a}/items/{b}", f"https://x/{a}", "https://x/none", "", None]
    assert evaluate(spark, values, text.last_guid) == [b, a, None, None, None]


def test_text_rules(spark):
    assert evaluate(spark, ["true", "True", "false", "yes", None], text.flexible_bool) == [
        True, True, False, False, False,
    ]
    assert evaluate(spark, [" Ab ", "\tAb\n", "  Ab "], text.strip) == ["Ab"] * 3
    # The DataFrame key strips spaces only.
    assert evaluate(spark, [" Ab ", "\tAb"], text.name_key) == ["ab", "\tab"]
    assert evaluate(spark, ["L/Files/Files/a/Files/Files/b", "L/Files/a"], text.collapse_files_folder) == [
        "L/Files/a/Files/Files/b", "L/Files/a",
    ]
    assert evaluate(spark, ["", "x", None], text.blank_to_null) == [None, "x", None]


def test_every_read_only_name_is_excluded_and_blanks_are_kept(spark):
    from shelflife.functions import fixed

    assert len(set(fixed.READ_ONLY_ACTIVITIES)) == 32
    assert evaluate(spark, fixed.READ_ONLY_ACTIVITIES, text.modifies) == [False] * 32
    assert evaluate(spark, [None, "", "viewreport", "EditReport"], text.modifies) == [True] * 4


def test_personal_label(spark):
    masked = evaluate(spark, ["ann", ""], lambda v: text.personal_label(v, True))
    shown = evaluate(spark, ["ann", "", None], lambda v: text.personal_label(v, False))
    assert masked == ["My workspace"] * 2
    assert shown == ["My workspace (ann)", "My workspace (unknown)", "My workspace (unknown)"]


def test_scoring_by_timestamp(spark):
    rows = spark.createDataFrame(
        [
            ("Notebook", moment("2020-01-01T00:00:00"), moment("2026-03-10T12:00:00")),
            ("Notebook", None, moment("2026-03-10T11:59:59")),
            ("Report", moment("2026-03-01T00:00:00"), None),
            ("Something", moment("2026-03-21T00:00:00"), None),
            ("Notebook", None, None),
        ],
        "item_type string, created_ts timestamp_ntz, modified_ts timestamp_ntz",
    )
    found = scoring.score(rows, AS_OF).collect()
    assert [r["retention_period_days"] for r in found] == [10, 10, 20, 10, 10]
    assert [r["is_overdue"] for r in found] == [False, True, False, False, None]
    assert [r["age_days"] for r in found] == [10, 10, 19, -1, None]
    assert [str(r["deletion_due_date"]) for r in found] == [
        "2026-03-20", "2026-03-20", "2026-03-21", "2026-03-31", "None",
    ]
    custom = scoring.score(rows, AS_OF, {"Notebook": 3}, 7).collect()
    assert [r["retention_period_days"] for r in custom] == [3, 3, 7, 7, 3]


PLAIN_TIMES = [
    "2024-01-05T10:11:12", "2024-01-05 10:11:12Z", "2024-01-05T10:11:12.123+02:00", "2024-01-05T10:11:12.1234567",
    "2024-01-05T10:11:12.5-0330", "Tue, 05 Mar 2024 23:59:59 GMT", "xyz, 01 jan 1999 00:00:00 GMT",
]
ODD_TIMES = [
    "2024-01-05T10:11:123", "2024-01-05 10:11:123", "2024-01-05T10:11:12,5", "2024-01-05T10:11:12.", "20240105T101112Z",
    "2024-13-05T10:11:12", "2024-02-30 10:11:12", "2024-01-05T24:00:00", "2024-01-05T10:11:12.12345678+5", "2024-W03-2T10:00:00",
    "2024-01-05", "2024-1-5T1:2:3", "0000-01-05T10:11:12", "Tue, 5 Mar 24 23:59 GMT", "5 March 2024 1:02:03", "Tue, 31 Feb 2024 10:00:00 GMT",
    "Tue, 05 Foo 2024 10:00:00 GMT", "Tue, 05 Mar 2024 25:00:00 GMT", "Tue, 05 Mar 2024 10:00:00 GMT\n", "2024-01-05T10:11:12\n",
    "12345 Mar 2024 10:00", "", " 2024-01-05T10:11:12", "n/a", None, "Tue, 05 anf 2024 10:00:00 GMT",
]


def test_common_times_are_read_without_the_general_expressions(spark, monkeypatch):
    """The same values as the general expressions give, and those are not needed for common spellings."""
    frame = spark.createDataFrame([(t,) for t in [*PLAIN_TIMES, *ODD_TIMES]], "t string")

    def parsed():
        column = F.col("t")
        kinds = {"any": times.parse_any(column), "iso": times.parse_iso(column), "mail": times.parse_mail_date(column)}
        return frame.select("t", *[c.cast("string").alias(name) for name, c in kinds.items()]).collect()

    found = parsed()
    assert all(r["any"] is not None for r in found if r.t in PLAIN_TIMES)
    with monkeypatch.context() as general:
        general.setattr(times, "_PLAIN_ISO", "^(no such text)$")
        general.setattr(times, "_PLAIN_MAIL", "^(no such text)$")
        assert parsed() == found
    assert all(r["any"] == (r.iso if r.iso is not None else r.mail) for r in found)
    monkeypatch.setattr(times, "_parse_any_iso", lambda text: F.lit(None).cast("timestamp_ntz"))
    monkeypatch.setattr(times, "_MAIL_DATE", "^(no)( such)( text)()$")
    assert [r["any"] for r in parsed()[: len(PLAIN_TIMES)]] == [r["any"] for r in found[: len(PLAIN_TIMES)]]
