from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lateline.functions import expressions as x
from lateline.operators import ranks


def one(spark, column, **values):
    literals = [F.lit(v).alias(k) for k, v in values.items()]
    return spark.range(1).select(*literals).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("text", ["same day", "HOME-OFFICE", "o'neil shop", "3rd class", "éa été", "a  b", ""])
def test_title_matches_python(spark, text):
    assert one(spark, x.title(F.col("t")), t=text) == text.title()


def test_strip_removes_all_white_space(spark):
    assert one(spark, x.strip(F.col("t")), t="\t Same Day \n") == "Same Day"


def test_titles_of_plain_letters_and_trims_need_no_pattern_a_row(spark):
    texts = [None, "", " ", " FIRST  class ", "x\n", "x \u2028", "\x0bx\x1c", "dON't stop", "B_c", "ǆabc", "İz", "a1b", "x\x00y z", "\u00a0ab"]
    table = spark.createDataFrame([(t,) for t in texts], "t string")
    words = F.split(F.lower("t"), r"(?<=[^\p{L}])(?=\p{L})")
    by_word = F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))), "")
    found = table.select("t", x.strip(F.col("t")).alias("s"), F.regexp_replace("t", r"^\s+|\s+$", "").alias("ps"),
                         x.title(F.col("t")).alias("w"), by_word.alias("pw"))
    assert all(r["s"] == r["ps"] and r["w"] == r["pw"] for r in found.collect())
    plan = found.select("s", "w")._jdf.queryExecution().optimizedPlan().toString()
    assert "initcap" in plan.lower() and "trim" in plan.lower()


@pytest.mark.parametrize("value,label", [(-0.01, None), (0.0, "none"), (0.1, "low"), (0.2, "medium"), (0.21, "high"),
                                         (1.0, "high"), (1.01, None)])
def test_bins_are_right_closed(spark, value, label):
    bins = x.right_closed_bins(F.col("v"), [-0.01, 0.0, 0.1, 0.2, 1.0], ["none", "low", "medium", "high"])
    assert one(spark, bins, v=value) == label


def test_flags_lookups_and_ratios_of_nulls(spark):
    df = spark.createDataFrame([(None, None), (5.0, 0.0)], "a double, b double")
    rows = df.select(x.flag(F.col("a") >= 5).alias("flag"), x.per_nonzero(F.col("a"), F.col("b")).alias("safe"),
                     x.ratio(F.col("a"), F.col("b")).alias("ratio"), x.clip(F.col("a"), 0.0, 3.0).alias("clip"),
                     x.mean_of_known([F.col("a"), F.col("b")]).alias("mean")).collect()
    assert rows[0].asDict() == {"flag": 0, "safe": None, "ratio": None, "clip": None, "mean": None}
    assert rows[1].asDict() == {"flag": 1, "safe": 5.0, "ratio": None, "clip": 3.0, "mean": 2.5}
    assert one(spark, x.lookup(F.col("k"), {"a": 1.0}, 0.5), k=None) == 0.5


@pytest.mark.parametrize("value", [0.125, 0.135, 2.5, -0.285, 12.345])
def test_rounding_matches_numpy(spark, value):
    assert one(spark, x.round_half_even(F.col("v"), 2), v=value) == float(np.round(value, 2))


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(42)
    values = np.concatenate([np.full(1000, 7.25), rng.lognormal(3, 2, 1500), [1e9, -1e9]])
    data = [(float(v), float(round(v)), None if i % 7 == 0 else float(v % 10)) for i, v in enumerate(rng.permutation(values))]
    return spark.createDataFrame(data + [(None, None, float("nan"))], "a double, b double, c double").cache()


@pytest.mark.parametrize("window", [1_000_000, 200, 5])
def test_percentiles_match_pandas_at_every_window(spark, skewed, window, monkeypatch):
    monkeypatch.setattr(ranks, "WINDOW_ROWS", window)
    fractions = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    found = ranks.exact_percentiles(skewed, {c: (F.col(c), fractions) for c in "abc"})
    frame = skewed.toPandas()
    for c in "abc":
        np.testing.assert_allclose(found[c], frame[c].quantile(fractions), rtol=1e-12)


def test_percentile_of_nothing(spark, skewed):
    assert ranks.exact_percentiles(skewed.limit(0), {"a": (F.col("a"), [0.5])}) == {"a": [None]}


def test_approximate_percentiles_are_close(spark, skewed):
    exact = ranks.exact_percentiles(skewed, {"a": (F.col("a"), [0.5])})["a"][0]
    assert ranks.exact_percentiles(skewed, {"a": (F.col("a"), [0.5])}, approx=True)["a"][0] == pytest.approx(exact, rel=0.1)


@pytest.mark.parametrize("window", [1_000_000, 40, 3])
def test_cuts_have_exact_sizes_and_follow_the_order(spark, window):
    rows = [(None if i % 50 == 0 else f"k{(i * 37) % 11:02d}", i % 3, f"t{(i * 7919) % 997:03d}") for i in range(900)]
    df = spark.createDataFrame(rows, "k string, n int, t string")
    cuts = ranks.find_cuts(df, ["k", "n", "t"], [300, 620], window)
    got = ranks.label_by_cuts(df, cuts, ["a", "b", "c"], "part").toPandas()
    expected = df.toPandas().sort_values(["k", "n", "t"], na_position="last").reset_index(drop=True)
    expected["part"] = ["a"] * 300 + ["b"] * 320 + ["c"] * 280
    key = ["k", "n", "t", "part"]
    pd.testing.assert_frame_equal(got.sort_values(key)[key].reset_index(drop=True),
                                  expected.sort_values(key)[key].reset_index(drop=True), check_dtype=False)


def test_cut_inside_identical_rows(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("a"), F.lit("x").alias("b"))
    cuts = ranks.find_cuts(df, ["a", "b"], [700, 850], window_rows=1)
    parts = ranks.label_by_cuts(df, cuts, ["p", "q", "r"], "part")
    assert {r["part"]: r["count"] for r in parts.groupBy("part").count().collect()} == {"p": 700, "q": 150, "r": 150}
    assert {r["a"]: r["count"] for r in parts.groupBy("a").count().collect()} == {0: 334, 1: 333, 2: 333}


@pytest.mark.parametrize("window", [1_000_000, 90])
def test_running_totals_per_group(spark, window):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), F.xxhash64("id").alias("k"), F.lit(1).alias("v"))
    got = ranks.with_running_totals(df, [F.col("k").desc()], {"r": F.col("v")}, by=["g"], window_rows=window).toPandas()
    for _, part in got.groupby("g"):
        assert part.sort_values("k", ascending=False)["r"].tolist() == list(range(1, 501))
