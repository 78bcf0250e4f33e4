"""Box plot numbers per group, one of which holds a third of the rows."""

import numpy as np
import pytest

from chartmill.operators.profiling import box_stats


def plain(values):
    v = np.array(values)
    q1, q2, q3 = np.quantile(v, [0.25, 0.5, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    kept = v[(v >= low) & (v <= high)]
    return len(v), q1, q2, q3, min(kept.min(), q1), max(kept.max(), q3), int(len(v) - len(kept))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    out = []
    for i in range(3000):
        g = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"g{i % 40}"
        x = float(rng.standard_cauchy()) if i % 4 else 2.5  # a frequent value, long tails
        out.append((g, x if i % 11 else None, float(rng.normal()) if i % 13 else float("nan")))
    return [*out, ("one", 7.0, None), ("flat", 1.0, 1.0), ("flat", 1.0, 1.0)]


def columns(rows, g=...):
    for name, at in (("x", 1), ("y", 2)):
        values = [r[at] for r in rows if (g is ... or r[0] == g) and r[at] is not None and r[at] == r[at]]
        if values:
            yield name, plain(values)


FIELDS = ("n", "q1", "median", "q3", "whisker_low", "whisker_high", "outliers")


def test_boxes_per_group(table, rows):
    got = {(r["g"], r["column"]): tuple(r[f] for f in FIELDS) for r in box_stats(table(rows, "g string, x double, y double"), ["x", "y"], by="g").collect()}
    want = {(g, name): pytest.approx(numbers) for g in {r[0] for r in rows} for name, numbers in columns(rows, g)}
    assert got == want


def test_boxes_of_all_rows(table, rows):
    df = table(rows, "g string, x double, y double")
    got = {r["column"]: tuple(r[f] for f in FIELDS) for r in box_stats(df, ["x", "y"]).collect()}
    assert got == {name: pytest.approx(numbers) for name, numbers in columns(rows)}
    assert box_stats(df.limit(0), ["x"], by="g").count() == 0


def test_values_meet_by_slice(table, rows):
    """Rows of values are joined by slice; by group alone only totals of slices and limits are."""
    df = box_stats(table(rows, "g string, x double, y double"), ["x", "y"], by="g")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert joins and sum("_slice" not in line for line in joins) <= 2
