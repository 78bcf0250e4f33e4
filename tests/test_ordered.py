import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartmill.operators import ordered as O
from chartmill.operators.metrics import curve_areas, roc_curve


@pytest.fixture(scope="module")
def numbers():
    rng = random.Random(7)
    # A third of the rows share one value; some are missing.
    rows = []
    for i in range(3000):
        group = rng.choice(["a", "b", None])
        value = 5.0 if i % 3 == 0 else rng.choice([None, float("nan"), rng.gauss(0, 1), round(rng.gauss(5, 0.01), 3), 1e9])
        rows.append((group, value))
    return rows


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("slices", [2, 16, 1024])
def test_running_totals(table, descending, slices):
    rng = random.Random(3)
    rows = list({(rng.choice("xy"), round(rng.random(), 3)): rng.randint(0, 9) for _ in range(500)}.items())
    df = table([(g, v, n) for (g, v), n in rows], "g string, v double, n int")
    got = {(r["g"], r["v"]): (r["cum_n"], r["all_n"]) for r in O.running_totals(df, "v", ["n"], ["g"], descending, slices).collect()}
    expected = {}
    for g in "xy":
        total, mine = 0, sorted(((v, n) for (h, v), n in rows if h == g), reverse=descending)
        for v, n in mine:
            total += n
            expected[g, v] = (total, sum(n for _, n in mine))
    assert got == expected


def test_slices_must_be_a_power_of_two(table):
    with pytest.raises(ValueError):
        O.running_totals(table([(1.0, 1)], "v double, n int"), "v", ["n"], slices=1000)


def test_percentiles_are_exact(table, numbers):
    df = table(numbers, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    by_group = defaultdict(list)
    for g, v in numbers:
        if v is not None and v == v:
            by_group[g].append(v)
    got = {r["g"]: r for r in O.percentiles(df, ["v"], probs, by=["g"]).collect()}
    assert set(got) == set(by_group)
    for g, values in by_group.items():
        assert got[g]["n"] == len(values)
        found = [got[g][O.percent_name(p)] for p in probs]
        assert found == pytest.approx(np.quantile(values, probs), rel=1e-12)


def test_approximate_percentiles(table, numbers):
    df = table(numbers, "g string, v double")
    got = O.percentiles(df, ["v"], [0.5], accuracy=10000).first()
    assert got["p50"] == 5.0


def test_no_task_sorts_all_values(table):
    df = table([(float(i), 1) for i in range(50)], "v double, n int")
    plan = O.running_totals(df, "v", ["n"])._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "windowspecdefinition(v" in line]
    assert not windows, "a window over the values must be cut by slice"


def test_empty_table(table):
    df = table([], "v double, n int")
    assert O.running_totals(df, "v", ["n"]).count() == 0
    assert O.percentile_row(df, ["v"], 0.5).first()["v"] is None


def test_totals_read_one_exchange(spark, table):
    df = table([(float(i % 97), 1) for i in range(5000)], "v double, y int")
    counts = df.groupBy("v").agg(F.sum("y").alias("n"), F.count("*").alias("m"))
    out = O.running_totals(counts, "v", ["n"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan


def test_the_source_of_a_curve_is_read_once(spark, tmp_path):
    """Edges, slice totals and sums come from one written table of counts; nothing after that looks at the source."""
    path = str(tmp_path / "scored")
    scored = spark.range(2_000).select((F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 300 / 300).alias("p"))
    scored.repartition(3).write.parquet(path)
    seen = spark.sparkContext.accumulator(0)

    def tell(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.read.parquet(path).mapInArrow(tell, "y int, p double")
    for run in (lambda: roc_curve(rows, "y", "p"), lambda: O.percentiles(rows, ["p"]), lambda: curve_areas(rows, "y", "p")):
        seen.value = 0
        out = run()
        assert out.count() > 0 and len(out.collect()) > 0
        assert seen.value == 2_000
        assert not any(f.startswith(f"file:{path}") for f in out.inputFiles())
