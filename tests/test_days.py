"""Search facts kept by day: what a refresh reads, and how far sketches are off."""

import json
import shutil
from datetime import date

import pytest

from serplens.sources import days

WINDOW = date(2026, 1, 1), date(2026, 1, 31)


def land(folder, day, rows, name="a"):
    (folder / f"run_date=2026-01-{day:02d}").mkdir(parents=True, exist_ok=True)
    line = {"rows": [{"keys": list(keys), "clicks": n, "impressions": 2 * n, "ctr": 0.5, "position": 4.0} for *keys, n in rows]}
    (folder / f"run_date=2026-01-{day:02d}" / f"{name}.json").write_text(json.dumps(line) + "\n")


def stored(spark, base, window=WINDOW):
    return sorted((r["run_date"].day, r["query"], r["page"], r["clicks"], r["impressions"], r["weighted_position"])
                  for r in days.read_sums(spark, base, window).collect())


def test_only_changed_days_are_read(spark, tmp_path):
    landed, base = tmp_path / "landed", str(tmp_path / "base")
    landed.mkdir()
    assert days.refresh(spark, str(landed), base, WINDOW) == [] and stored(spark, base) == []
    for day in (1, 2, 3, 4):
        land(landed, day, [("q", "p", day)])
    assert days.refresh(spark, str(landed), base, WINDOW) == [date(2026, 1, d) for d in (1, 2, 3, 4)]
    assert days.refresh(spark, str(landed), base, WINDOW) == []
    # Late rows, a new day, a replaced file and a removed day; the unchanged day is not read again.
    land(landed, 1, [("q", "p", 10), ("r", "p", 1)], "late")
    land(landed, 5, [("q", "p", 5)])
    land(landed, 2, [("s", "p2", 7)])
    shutil.rmtree(landed / "run_date=2026-01-03")
    assert days.refresh(spark, str(landed), base, WINDOW) == [date(2026, 1, d) for d in (1, 2, 3, 5)]
    assert stored(spark, base) == [
        (1, "q", "p", 11, 22, 88.0), (1, "r", "p", 1, 2, 8.0), (2, "s", "p2", 7, 14, 56.0),
        (4, "q", "p", 4, 8, 32.0), (5, "q", "p", 5, 10, 40.0)]
    runs = sorted((tmp_path / "base/days/sums").iterdir())
    assert [sorted(f.name[-2:] for f in run.glob("run_date=*")) for run in runs] == [["01", "02", "03", "04"], ["01", "02", "05"]]
    # Other windows merge the same days.
    assert [r[0] for r in stored(spark, base, (date(2026, 1, 2), date(2026, 1, 4)))] == [2, 4]
    assert {r["page"]: r["query_count"] for r in days.query_estimates(spark, base, WINDOW).collect()} == {"p": 2, "p2": 1}


def test_a_failed_refresh_leaves_the_old_days(spark, tmp_path, monkeypatch):
    landed, base = tmp_path / "landed", str(tmp_path / "base")
    land(landed, 1, [("q", "p", 1)])
    days.refresh(spark, str(landed), base, WINDOW)
    before = stored(spark, base)
    land(landed, 1, [("q", "p", 2)], "late")
    with monkeypatch.context() as m:
        m.setattr(days, "SKETCH_BITS", 99)
        with pytest.raises(Exception):
            days.refresh(spark, str(landed), base, WINDOW)
    assert stored(spark, base) == before
    assert days.refresh(spark, str(landed), base, WINDOW) == [date(2026, 1, 1)]
    assert stored(spark, base) == [(1, "q", "p", 3, 6, 24.0)]


def test_sketches_bound_their_error_and_thresholds_are_exact(spark, tmp_path):
    landed, base = tmp_path / "landed", str(tmp_path / "base")
    sizes = {"none": 1, "under": 1999, "at": 2000, "over": 2001, "near": 2100, "many": 40000}
    for day in (1, 2, 3):
        # Each day has two thirds of a page's queries, so every query is on two days.
        land(landed, day, [(f"{p} {i}", p, 1) for p, n in sizes.items() for i in range(n) if i % 3 != day - 1])
    days.refresh(spark, str(landed), base, WINDOW)
    got = {r["page"]: r["query_count"] for r in days.query_estimates(spark, base, WINDOW).collect()}
    assert all(abs(got[p] - n) <= days.ERRORS * days.STANDARD_ERROR * n for p, n in sizes.items())
    pages = {r["page"] for r in days.pages_with_queries(spark, base, WINDOW, 2000).collect()}
    assert pages == {"at", "over", "near", "many"}
    assert {r["page"] for r in days.pages_with_queries(spark, base, WINDOW, 1).collect()} == set(sizes)
