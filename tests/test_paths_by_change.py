"""Path discovery from differences, against discovery of each listing as a whole."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, moment
from shelflife.operators import discovery
from shelflife.plans import paths_by_change

SEGMENTS = ["a", "b", "_x", "Tables", "Files", "k=1", "TableMaintenance"]


def listing(spark, entries):
    """(lakehouse, name, is_dir, day) rows in name order."""
    rows = [(lake, name, is_dir, None if day is None else moment(f"2026-01-{day:02}T00:00:00")) for lake, name, is_dir, day in entries]
    frame = spark.createDataFrame(rows, "lakehouse_id string, name string, is_dir boolean, modified_ts timestamp_ntz")
    return paths_by_change.in_name_order(frame)


def tables(frame):
    return sorted((str(r.lakehouse_id), r.name, str(r.modified_ts)) for r in frame.collect())


def some(rng):
    path = "/".join(rng.choices(SEGMENTS, k=rng.randint(1, 4)))
    lake = rng.choice(["L1", "L2", "L3", None])
    return (lake, rng.choice(["Tables/", "Tables/", ""]) + path, rng.random() < 0.5, rng.choice([None, *range(1, 29)]))


@pytest.mark.parametrize("ignore", [False, True])
def test_every_listing_equals_discovery_from_scratch(spark, tmp_path, ignore):
    rng = random.Random(4 + ignore)
    entries = [some(rng) for _ in range(120)]
    old = listing(spark, entries)
    kept = paths_by_change.kept_folders(spark, str(tmp_path))
    paths_by_change.begin(kept, old, AS_OF, ignore)
    assert tables(paths_by_change.tables(kept)) == tables(discovery.discovered_tables(old, ignore))
    again = 0
    for _ in range(3):
        rng.shuffle(entries)
        entries = entries[12:]  # removed
        entries[:6] = [(*e[:3], rng.randint(1, 28)) for e in entries[:6]]  # changed
        entries += [some(rng) for _ in range(8)] + [entries[0]]  # added, one a second time
        new = listing(spark, entries)
        difference = paths_by_change.listing_difference(old, new)
        again += paths_by_change.update(kept, difference, lambda new=new: new, AS_OF, ignore)
        assert tables(paths_by_change.tables(kept)) == tables(discovery.discovered_tables(new, ignore))
        old = new
    assert again > 0


def test_the_listing_is_read_only_where_a_folder_lost_its_entry(spark, tmp_path):
    entries = [("L", f"Tables/s/t{n}/part-{p}.parquet", False, 1 + p) for n in range(4) for p in range(3)]
    old = listing(spark, entries)
    kept = paths_by_change.kept_folders(spark, str(tmp_path))
    paths_by_change.begin(kept, old, AS_OF)

    def refused():
        raise AssertionError("the listing was read")

    def step(new, read=refused):
        new = listing(spark, new)
        n = paths_by_change.update(kept, paths_by_change.listing_difference(old, new), read, AS_OF)
        assert tables(paths_by_change.tables(kept)) == tables(discovery.discovered_tables(new))
        return n, new

    # Later files go, a folder goes as a whole, new ones come: no listing needed.
    entries = [e for e in entries if "part-2" not in e[1] and "/t3/" not in e[1]] + [("L", "Tables/s/new/x", False, 9)]
    _, old = step(entries)
    changed = kept.runs()[-1]["tables"][0]
    assert changed["whole"] or changed["n_rows"] == 5
    # The first file of one folder goes: that folder alone is derived again.
    entries = [e for e in entries if e[1] != "Tables/s/t1/part-0.parquet"]
    seen = []

    def read():
        seen.append(1)
        return listing(spark, entries)

    n, old = step(entries, read)
    assert n == 1 and seen == [1]
    # The last sign of the schema goes with its files: a folder of the name is a table now.
    entries = [("L", "Tables/s", True, 5)]
    n, old = step(entries)
    assert tables(paths_by_change.tables(kept)) == [("L", "s", "2026-01-05 00:00:00")]
    step([])
    assert tables(paths_by_change.tables(kept)) == []


def test_difference_counts_copies(spark):
    one = listing(spark, [("L", "Tables/a", True, 1)] * 3 + [("L", "Tables/b", True, None)])
    two = listing(spark, [("L", "Tables/a", True, 1)] + [("L", "Tables/b", True, 2)])
    rows = paths_by_change.listing_difference(one, two).select("name", F.col("modified_ts").isNull(), "weight").collect()
    assert sorted(map(tuple, rows)) == [("Tables/a", False, -2), ("Tables/b", False, 1), ("Tables/b", True, -1)]
