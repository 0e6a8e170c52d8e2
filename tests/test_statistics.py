"""Tests against brute force on small data, published values and identities between the tests."""

import math
import time
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from guestlens.functions import normal, royston, tails
from guestlens.operators import describe
from guestlens.operators import significance as sig
from guestlens.plans import comparison, ranking

ABC = ("a", "b", "c")


def frame(spark, values):
    return spark.createDataFrame([(g, float(v)) for g, vs in values.items() for v in vs], "g string, v double")


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one value, and one group holds most rows."""
    rng = np.random.default_rng(5)
    values = {
        "a": np.concatenate([np.full(300, 8.0), rng.normal(6, 2, 300).round(1)]),
        "b": rng.normal(6.4, 2, 120).round(1),
        "c": rng.integers(1, 11, 40).astype(float),
    }
    return values, frame(spark, values)


def pooled(values):
    pdf = pd.DataFrame([(g, v) for g, vs in values.items() for v in vs], columns=["g", "v"])
    pdf["r"] = pdf.v.rank()
    return pdf


def tie_sum(pdf):
    t = pdf.v.value_counts().to_numpy(float)
    return float((t**3 - t).sum())


def brute_h(pdf):
    n = len(pdf)
    by = pdf.groupby("g").r.agg(["sum", "count"])
    h = 12 / (n * (n + 1)) * (by["sum"] ** 2 / by["count"]).sum() - 3 * (n + 1)
    return h / (1 - tie_sum(pdf) / (n**3 - n))


def test_special_functions():
    assert tails.chi2_upper(9.487729, 4) == pytest.approx(0.05, abs=1e-7)
    assert tails.chi2_upper(7.814728, 3) == pytest.approx(0.05, abs=1e-7)
    assert tails.chi2_upper(3.841459, 1) == pytest.approx(0.05, abs=1e-7)
    assert round(tails.chi2_upper(26.957, 2), 4) == 0.0
    assert tails.f_upper(4.102821, 2, 10) == pytest.approx(0.05, abs=1e-7)
    assert tails.t_both(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    for q, k, df in ((3.877, 3, 10), (3.977, 5, 60), (4.501, 2, 3), (3.314, 3, 1_000_000)):
        assert tails.studentized_range_critical(0.05, k, df) == pytest.approx(q, abs=1e-3)
    assert math.isnan(tails.chi2_upper(1.0, 0))
    # with degrees of freedom as in a huge table the tests reach their limits
    for df in (1e6, 9e7, 1e9, 1e12):
        assert tails.t_both(1.959963985, df) == pytest.approx(0.05, rel=1e-5)
        assert tails.f_upper(9.487729 / 4, 4, df) == pytest.approx(0.05, rel=1e-4 if df < 1e7 else 1e-6)
        assert tails.studentized_range_upper(3.31449, 3, df) == pytest.approx(0.05, rel=1e-3)


def test_exact_rank_sum_against_enumeration():
    from itertools import combinations

    n1, n2 = 4, 6
    us = [sum(c) - n1 * (n1 + 1) / 2 for c in combinations(range(1, n1 + n2 + 1), n1)]
    for u in (12, 15, 20, 23, 24):
        expected = min(1.0, 2 * sum(x >= u for x in us) / len(us))
        assert tails.rank_sum_both_exact(u, n1, n2) == pytest.approx(expected, abs=1e-12)


def test_normal_quantile_column(spark):
    ps = [1e-300, 1e-12, 0.001, 0.07, 0.3, 0.5, 0.9, 0.99999]
    df = spark.createDataFrame([(p,) for p in ps], "p double").select(normal.normal_quantile(F.col("p")).alias("z"))
    for p, row in zip(ps, df.collect()):
        assert row["z"] == pytest.approx(NormalDist().inv_cdf(p), rel=1e-13, abs=1e-15)


def test_mid_ranks(spark, skewed):
    values, df = skewed
    expected = pooled(values).groupby("v").r.first()
    got = {r["value"]: r["mid_rank"] for r in ranking.mid_ranks(df, "v").collect()}
    assert got == pytest.approx(expected.to_dict())


def test_quantiles_match_linear_interpolation(spark, skewed):
    values, df = skewed
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    names = [f"q{i}" for i in range(len(shares))]
    ranked = ranking.rank_table(ranking.frequency(df, "v", ["g"]), ["g"])
    for row in ranking.quantiles(ranked, shares, names, ["g"]).collect():
        assert [row[n] for n in names] == pytest.approx(list(np.quantile(values[row["g"]], shares)))


def test_summary_ignores_missing_values_and_large_offsets(spark):
    offset = 1e9
    values = [offset + x for x in (1.0, 2.0, 4.0)]
    df = spark.createDataFrame([("a", v) for v in values] + [("a", None), ("a", float("nan")), (None, 5.0)], "g string, v double")
    row = describe.summary(df, "v", ["g"]).collect()
    assert len(row) == 1
    assert (row[0]["n"], row[0]["median"]) == (3, offset + 2)
    assert row[0]["mean"] == pytest.approx(np.mean(values)) and row[0]["std"] == pytest.approx(np.std([1.0, 2.0, 4.0], ddof=1))


def test_reserved_group_names_are_refused(spark):
    with pytest.raises(ValueError, match="'n'"):
        describe.describe_by(frame(spark, {"a": [1.0]}).withColumnRenamed("g", "n"), "v", "n")


def test_single_value_has_no_spread(spark):
    row = describe.summary(frame(spark, {"a": [3.0]}), "v", ["g"]).collect()[0]
    assert (row["n"], row["mean"], row["std"], row["median"]) == (1, 3.0, None, 3.0)


def test_histogram_against_numpy(spark):
    rng = np.random.default_rng(1)
    for values in (rng.normal(size=500), rng.integers(1, 11, 300).astype(float), np.arange(0, 2.1, 0.1), np.full(7, 3.0)):
        rows = describe.histogram(frame(spark, {"a": values}), "v").orderBy("bin").collect()
        counts, edges = np.histogram(values, 20)
        assert [r["rows"] for r in rows] == list(counts)
        assert [r["lower"] for r in rows] == pytest.approx(list(edges[:-1])) and rows[-1]["upper"] == pytest.approx(edges[-1])


def test_boxplot(spark):
    values = {"a": [1, 2, 3, 4, 5, 6, 7, 30.0], "b": [5.0, 5.0, 5.0]}
    rows = {r["g"]: r for r in describe.boxplot(frame(spark, values), "v", "g").collect()}
    assert (rows["a"]["whisker_low"], rows["a"]["whisker_high"], rows["a"]["outliers"]) == (1.0, 7.0, 1)
    assert (rows["b"]["whisker_low"], rows["b"]["whisker_high"], rows["b"]["outliers"]) == (5.0, 5.0, 0)


def test_kruskal_against_brute_force(spark, skewed):
    values, df = skewed
    row = sig.kruskal_wallis(df, "v", "g", ABC).collect()[0]
    h = brute_h(pooled(values))
    assert row["statistic"] == pytest.approx(h, rel=1e-10) and row["p_value"] == pytest.approx(math.exp(-h / 2), rel=1e-9)
    counted = sig.count_values(df, "v", "g", ABC)
    again = sig.kruskal_wallis(counted, "value", "g", ABC, weight="n").collect()[0]
    assert again == row


def test_rank_tests_do_not_change_under_monotone_maps(spark, skewed):
    _, df = skewed
    mapped = df.withColumn("v", F.exp(F.col("v") / 3))
    assert sig.kruskal_wallis(mapped, "v", "g", ABC).collect()[0]["statistic"] == pytest.approx(
        sig.kruskal_wallis(df, "v", "g", ABC).collect()[0]["statistic"], rel=1e-12
    )


def test_two_group_identities(spark, skewed):
    values, df = skewed
    h = sig.kruskal_wallis(df, "v", "g", ("a", "b")).collect()[0]["statistic"]
    z = sig.dunn_posthoc(df, "v", "g", ("a", "b")).collect()[0]["z"]
    assert z * z == pytest.approx(h, rel=1e-10)
    forth = sig.mann_whitney_u(df, "v", "g", "a", "b").collect()[0]
    back = sig.mann_whitney_u(df, "v", "g", "b", "a").collect()[0]
    assert forth["statistic"] + back["statistic"] == len(values["a"]) * len(values["b"])
    assert forth["p_value"] == pytest.approx(back["p_value"], rel=1e-12)
    f = sig.anova_oneway(df, "v", "g", ("a", "b")).collect()[0]["statistic"]
    t = sig.ttest_ind(df, "v", "g", "a", "b", equal_variance=True).collect()[0]["statistic"]
    assert t * t == pytest.approx(f, rel=1e-10)


def test_mann_whitney_published_setting():
    """The published comparison: U, group sizes and p, with the tie term that the p implies."""
    n1, n2, u = 4042, 2676, 5678009.0
    n = n1 + n2
    plain = math.sqrt(n1 * n2 / 12 * (n + 1))
    z = (u - n1 * n2 / 2 - 0.5) / plain
    assert round(z, 3) == 3.467 and round(2 * tails.normal_upper(z), 4) == 0.0005


def test_mann_whitney_exact_for_small_groups_without_ties(spark):
    row = sig.mann_whitney_u(frame(spark, {"a": [1.1, 2.2, 3.3], "b": [4.4, 5.5, 6.6, 7.7]}), "v", "g", "a", "b").collect()[0]
    assert (row["method"], row["statistic"]) == ("exact", 0.0)
    assert row["p_value"] == pytest.approx(2 / 35)
    tied = sig.mann_whitney_u(frame(spark, {"a": [1, 2, 3], "b": [3, 5, 6, 7]}), "v", "g", "a", "b").collect()[0]
    assert tied["method"] == "asymptotic"


def test_dunn_matrix_is_symmetric_with_unit_diagonal(spark, skewed):
    _, df = skewed
    pairs = sig.dunn_posthoc(df, "v", "g", ABC)
    for r in pairs.collect():
        assert r["p_adjusted"] >= min(1.0, 2 * tails.normal_upper(r["z"])) - 1e-12
    rows = sig.symmetric_matrix(pairs, ABC).orderBy("position").collect()
    assert [r["label"] for r in rows] == list(ABC)
    for i, a in enumerate(ABC):
        assert rows[i][a] == 1.0
        for j, b in enumerate(ABC):
            assert rows[i][b] == rows[j][a]


def test_levene_against_brute_force(spark, skewed):
    values, df = skewed
    z = {g: np.abs(np.array(v) - np.median(v)) for g, v in values.items()}
    n, k = sum(map(len, z.values())), len(z)
    grand = np.concatenate(list(z.values())).mean()
    between = sum(len(v) * (v.mean() - grand) ** 2 for v in z.values()) / (k - 1)
    within = sum(((v - v.mean()) ** 2).sum() for v in z.values()) / (n - k)
    row = sig.levene(df, "v", "g", ABC).collect()[0]
    assert row["statistic"] == pytest.approx(between / within, rel=1e-9)
    assert row["p_value"] == pytest.approx(tails.f_upper(between / within, k - 1, n - k), rel=1e-9)


def test_welch_and_student_variants(spark, skewed):
    values, df = skewed
    a, b = np.array(values["a"]), np.array(values["b"])
    welch = sig.ttest_ind(df, "v", "g", "a", "b").collect()[0]
    va, vb = a.var(ddof=1) / len(a), b.var(ddof=1) / len(b)
    assert welch["statistic"] == pytest.approx((a.mean() - b.mean()) / math.sqrt(va + vb))
    assert welch["df"] == pytest.approx((va + vb) ** 2 / (va**2 / (len(a) - 1) + vb**2 / (len(b) - 1)))
    counted = sig.ttest_ind(sig.count_values(df, "v", "g", ABC), "value", "g", "a", "b", weight="n").collect()[0]
    assert counted["statistic"] == pytest.approx(welch["statistic"]) and counted["variant"] == "welch"


def test_tukey_two_groups_equal_the_t_test(spark, skewed):
    _, df = skewed
    pair = sig.tukey_hsd(df, "v", "g", ("a", "b")).collect()[0]
    t = sig.ttest_ind(df, "v", "g", "a", "b", equal_variance=True).collect()[0]
    assert pair["p_adj"] == pytest.approx(t["p_value"], abs=1e-6)
    assert pair["lower"] < pair["meandiff"] < pair["upper"] and pair["reject"] == (pair["p_adj"] < 0.05)


def brute_w(values):
    x = np.sort(np.array(values, float))
    n = len(x)
    m = np.array([royston.rank_score(i, n) for i in range(1, n + 1)])
    mm = (m**2).sum()
    if n == 3:
        a = np.array([-math.sqrt(0.5), 0, math.sqrt(0.5)])
    else:
        root = 1 / math.sqrt(n)
        w1 = royston.polynomial(royston.LAST_WEIGHT, root) + m[-1] / math.sqrt(mm)
        if n > 5:
            w2 = royston.polynomial(royston.NEXT_WEIGHT, root) + m[-2] / math.sqrt(mm)
            f = math.sqrt((mm - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * w1**2 - 2 * w2**2))
            a = m / f
            a[[0, 1, -2, -1]] = -w1, -w2, w2, w1
        else:
            f = math.sqrt((mm - 2 * m[-1] ** 2) / (1 - 2 * w1**2))
            a = m / f
            a[[0, -1]] = -w1, w1
    return (a @ x) ** 2 / ((x - x.mean()) ** 2).sum()


def test_shapiro_against_all_ranks(spark):
    rng = np.random.default_rng(3)
    values = {
        "n3": [1.0, 2.0, 4.0],
        "n4": [1.0, 2.0, 4.0, 4.5],
        "n5": [1.0, 2.0, 4.0, 4.5, 9.0],
        "n9": rng.normal(size=9),
        "n64": rng.normal(size=64),
        "n70": rng.normal(size=70),
        "ties": rng.integers(1, 11, 2000),
        "hot": np.concatenate([np.full(900, 8.0), rng.normal(6, 2, 1500)]),
        "flat": [2.0] * 6,
        "two": [1.0, 2.0],
    }
    rows = {r["g"]: r for r in sig.shapiro_wilk(frame(spark, values), "v", "g", list(values)).collect()}
    for g, v in values.items():
        if g in ("flat", "two"):
            assert rows[g]["w"] is None and rows[g]["p_value"] is None and rows[g]["normal"] == "No"
        else:
            assert rows[g]["w"] == pytest.approx(brute_w(v), rel=1e-9), g
            assert rows[g]["n"] == len(v)


def test_shapiro_published_example():
    """Eleven weights of men, the example of the original paper: W = 0.79, p below 0.01."""
    weights = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    w = brute_w(weights)
    assert w == pytest.approx(0.79, abs=0.005) and royston.w_upper(w, 11) == pytest.approx(0.0067, abs=0.0005)


def test_shapiro_false_positive_rate():
    rng = np.random.default_rng(11)
    for n in (8, 50, 500):
        hits = sum(royston.w_upper(brute_w(rng.normal(size=n)), n) < 0.05 for _ in range(200))
        assert 2 <= hits <= 22


def test_degenerate_groups(spark):
    flat = frame(spark, {"a": [5.0] * 4, "b": [5.0] * 6})
    assert sig.kruskal_wallis(flat, "v", "g", ("a", "b")).collect()[0]["statistic"] is None
    assert sig.anova_oneway(flat, "v", "g", ("a", "b")).collect()[0]["p_value"] is None
    assert sig.mann_whitney_u(flat, "v", "g", "a", "b").collect()[0]["z"] is None
    assert comparison.levels_of_size(flat, "v", "g", ("a", "b", "c")) == ["b"]


def test_decision_uses_exact_p_and_gate_the_rounded_one(spark):
    test = spark.createDataFrame([(1.0, 0.049996)], "statistic double, p_value double")
    main = comparison._main_row(test, "PB1", "Kruskal-Wallis", "H", 0.05, 4)
    assert main.collect()[0]["decision"] == "Reject H₀ (p < 0.05)"
    assert not comparison.gate_open(main)


def test_comparison_branches(spark):
    rng = np.random.default_rng(2)
    normal_groups = frame(spark, {g: rng.normal(m, 1, 60) for g, m in (("a", 0), ("b", 2), ("c", 0))})
    out = comparison.compare_groups(normal_groups, "v", "g", ABC, "P")
    assert out.all_normal and out.posthoc_kind == "tukey"
    assert out.main.collect()[0]["test"] == "One-Way ANOVA"
    assert {(r["group1"], r["group2"]) for r in out.posthoc.where("reject").collect()} == {("a", "b"), ("b", "c")}
    ranks = frame(spark, {"a": [1, 1, 1, 2, 9] * 12, "b": [8, 9, 9, 9, 10] * 12, "c": [1, 1, 2, 1, 9] * 12})
    out = comparison.compare_groups(ranks, "v", "g", ABC, "P")
    assert not out.all_normal and out.posthoc_kind == "dunn" and out.posthoc.count() == 3
    two = comparison.problem_origin(normal_groups, "v", "g", ("a", "b"))
    assert two.main.collect()[0]["test"] == "Welch's t-test" and two.posthoc is None


def test_problem_stars_leaves_other_stars_out_of_the_main_test(spark):
    rng = np.random.default_rng(4)
    rows = [(s, float(x)) for s, m in ((2, 9), (3, 0), (4, 3), (5, 6)) for x in rng.normal(m, 1, 40)]
    df = spark.createDataFrame(rows, "hotel_stars int, rating_score double")
    out = comparison.problem_stars(df)
    assert out.posthoc_kind == "tukey"
    assert {r["group1"] for r in out.posthoc.collect()} == {2, 3, 4}  # every star value is compared
    only = comparison.problem_stars(df.where("hotel_stars > 2"))
    assert only.main.collect()[0]["statistic"] == pytest.approx(out.main.collect()[0]["statistic"])


def test_many_groups_of_tukey(spark):
    """All 44,850 pairs of 300 groups: the quantile once, the pairs in many tasks."""
    rng = np.random.default_rng(4)
    rows = [(f"g{g:03}", float(x)) for g in range(300) for x in rng.normal(g % 3 * 0.5, 1.0, 20)]
    df = spark.createDataFrame(rows, "g string, v double").cache()
    start = time.perf_counter()
    pairs = sig.tukey_hsd(df, "v", "g").toPandas()
    assert time.perf_counter() - start < 60
    assert len(pairs) == 300 * 299 // 2 and (pairs.group1 < pairs.group2).all()
    half = (pairs.upper - pairs.lower) / 2
    assert np.allclose(half, half.iloc[0])  # equal sizes
    at_limit = tails.studentized_range_upper(half.iloc[0] / (pairs.meandiff.abs() / sig_q(df, pairs)).iloc[0], 300, 5700)
    assert at_limit == pytest.approx(0.05, abs=1e-6)
    plan = sig.tukey_hsd(df, "v", "g")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def sig_q(df, pairs):
    found = sig.tukey_statistics(df, "v", "g", None).toPandas().set_index(["group1", "group2"])["q"]
    return found.loc[list(zip(pairs.group1, pairs.group2))].reset_index(drop=True)


def test_tails_of_many_numbers():
    x = np.concatenate([np.linspace(-12, 12, 4001), [0.0, 50.0, -50.0]])
    assert np.allclose(tails.normal_upper_each(x), [tails.normal_upper(v) for v in np.clip(x, -40, 40)], rtol=1e-8, atol=1e-15)


def test_cube_gives_the_numbers_of_the_rows(spark):
    rng = np.random.default_rng(6)
    rows = [(["a", "b", None][int(rng.integers(3))], int(rng.integers(2)), [float(rng.integers(5)), None, float("nan")][int(rng.integers(9)) // 7]) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, h int, v double")
    cube = ranking.score_cube(df, "v", ["g", "h"])
    for plain, counted in (
        (describe.describe_by(df, "v", "g"), describe.describe_by(cube, "value", "g", weight="n")),
        (describe.describe_overall(df, "v"), describe.describe_overall(cube, "value", weight="n")),
        (describe.histogram(df, "v", 4), describe.histogram(cube, "value", 4, weight="n")),
        (describe.boxplot(df, "v", "h"), describe.boxplot(cube, "value", "h", weight="n")),
        (describe.descriptive_report(df, "v", {"G": "g", "H": "h"}), describe.descriptive_report(cube, "value", {"G": "g", "H": "h"}, weight="n")),
    ):
        assert sorted(map(str, plain.collect())) == sorted(map(str, counted.collect()))
    assert comparison.levels_of_size(cube, "value", "g", ["b", "a", "c"], weight="n") == ["b", "a"]
    with pytest.raises(ValueError, match="rename"):
        ranking.score_cube(df.withColumnRenamed("g", "n"), "v", ["n"])
