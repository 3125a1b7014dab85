import re
from datetime import date

import pytest
from conftest import rows
from landing_zone import time_entry, write_pages

from jornada.plans import jobs
from jornada.plans.listings import list_landing
from jornada.sources.day_index import landed_days, update_day_index
from jornada.sources.landing import read_landing

DAYS = [f"2024-01-{d:02}" for d in range(1, 29)]


def entry(key, day, person="e1", **more):
    return time_entry(key, person, f"{day}T08:00:00Z", f"{day}T09:00:00Z", **more)


@pytest.fixture
def root(tmp_path):
    """An entry a day; x3 was moved to the 20th and landed there, x5 was edited on the 25th."""
    folder = tmp_path / "landing"
    for n, day in enumerate(DAYS, 1):
        found = [entry(f"x{n}", day)]
        if n == 20:
            found.append(entry("x3", day, comment="moved"))
        if n == 25:
            found.append(entry("x5", "2024-01-05", comment="edited"))
        write_pages(folder, "time_entries", "north", found, date=day, at=1_000_000_000 + n)
    return folder


def ask(spark, root, index, first, last):
    listed = list_landing(spark, str(root), "time_entries", index=index, from_date=first, to_date=last)
    return rows(listed.select("id", "comment"))


@pytest.fixture(autouse=True)
def active(root):
    from landing_zone import employee

    write_pages(root, "employees", "north", [employee("e1", "Acme")])


RANGES = [("2024-01-03", "2024-01-05"), ("2024-01-20", "2024-01-20"), ("2024-01-27", "2024-02-10"), ("2023-01-01", "2023-02-01")]


def test_index_changes_no_listing(spark, root, tmp_path):
    index = f"{tmp_path}/index"
    plain = [ask(spark, root, None, *r) for r in RANGES]
    assert plain[0] == [("x4", "did things"), ("x5", "edited")]
    assert ("x3", "moved") in plain[1]
    # No index yet, a complete one, and one that lacks files.
    assert [ask(spark, root, index, *r) for r in RANGES] == plain
    assert len(update_day_index(spark, str(root), index, "time_entries")) == 28
    assert update_day_index(spark, str(root), index, "time_entries") == []
    assert [ask(spark, root, index, *r) for r in RANGES] == plain
    write_pages(root, "time_entries", "north", [entry("x4", "2024-01-28", comment="late")], date="2024-01-28", name="b", at=1_000_000_900)
    write_pages(root, "time_entries", "south", [entry("x1", "2024-01-04", comment="other")], date="2024-02-01", at=1_000_000_901)
    plain = [ask(spark, root, None, *r) for r in RANGES]
    assert plain[0] == [("x1", "other"), ("x5", "edited")] and ("x4", "late") in plain[2]
    assert [ask(spark, root, index, *r) for r in RANGES] == plain
    assert sorted(update_day_index(spark, str(root), index, "time_entries")) == [date(2024, 1, 28), date(2024, 2, 1)]
    assert [ask(spark, root, index, *r) for r in RANGES] == plain


def test_only_the_named_days_are_read(spark, root, tmp_path):
    index = f"{tmp_path}/index"
    update_day_index(spark, str(root), index, "time_entries")
    days = landed_days(spark, str(root), index, "time_entries", date(2024, 1, 3), date(2024, 1, 5))
    assert days == [date(2024, 1, d) for d in (3, 4, 5, 20, 25)]
    raw = read_landing(spark, str(root), "time_entries", on_days=days)
    assert len({r[0] for r in raw.select("date").distinct().collect()}) == 5
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*date#\d+ (IN|INSET) ", plan)
    listed = list_landing(spark, str(root), "time_entries", index=index, from_date="2024-01-03", to_date="2024-01-05")
    read = listed._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*date#\d+ (IN|INSET) ", read)


def test_loads_through_an_index_are_the_same(spark, root, tmp_path):
    index, found = f"{tmp_path}/index", []
    update_day_index(spark, str(root), index, "time_entries")
    for name, use in (("plain", None), ("indexed", index)):
        table = f"{tmp_path}/{name}"
        jobs.load_time_entries(spark, str(root), table, "2024-01-03", "2024-01-20", index=use)
        stored = jobs.read_table(spark, f"{table}/fact_time_entry")
        found.append(rows(stored.select("time_entry_sesame_id", "time_entry_in", "comment")))
    assert found[0] == found[1] and len(found[0]) == 18


def test_files_outside_day_folders_have_no_index(spark, tmp_path):
    write_pages(tmp_path, "time_entries", "north", [entry("x1", "2024-01-03")])
    assert update_day_index(spark, str(tmp_path), f"{tmp_path}/index", "time_entries") == []
    assert landed_days(spark, str(tmp_path), f"{tmp_path}/index", "time_entries", date(2024, 1, 1), date(2024, 1, 5)) is None
    assert update_day_index(spark, str(tmp_path), f"{tmp_path}/index", "work_entries") == []
