"""Nuisance models: boosted trees, Newton fits, least squares and p-values against plain versions."""

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from hearthlift import schemas as S
from hearthlift.functions.student import incomplete_beta, log_gamma, two_sided_p
from hearthlift.operators import boosting as B
from hearthlift.operators import estimation as E
from hearthlift.operators import newton as N
from hearthlift.operators.least_squares import solved
from hearthlift.operators.ranking import area_under_curve
from hearthlift.sources.staging import stage
from tests.test_estimation import CONFIG, CONFOUNDED, generated

LEARNER = E.Learner("trees", tree_iterations=13, tree_depth=3)


@pytest.fixture(scope="module")
def households(spark):
    states = F.concat(F.lit("s"), F.pmod(F.xxhash64("addressLink"), F.lit(40)))
    return stage(generated(spark, 400, 5, CONFOUNDED).withColumn("state_label", states), "households")


@pytest.fixture(scope="module")
def binned(households):
    return B.binned_rows(E.design_matrix(households, LEARNER, CONFIG, E.TOTAL_OUTCOME), LEARNER, CONFIG)


@pytest.fixture(scope="module")
def trees(binned):
    return B.boosted_trees(*binned)


def nodes(trees):
    return [B.tree_rows(e, own) for e, own in enumerate(trees)]


def test_trees_from_passes_equal_those_from_tasks(binned, trees, monkeypatch):
    monkeypatch.setattr(B, "SMALL_TABLE", 0)
    table, settings = binned
    assert settings.nominal and settings.bins > 40
    assert nodes(B.boosted_trees(table.repartition(5), settings)) == nodes(trees)


def test_edges_are_exact_quantiles_of_a_table_beyond_the_sketch(spark):
    n, bins, top = 30_000, 32, 1.7e308
    spread = F.xxhash64("id") / F.lit(1e9)
    ends = F.when(F.col("id") < 2_000, -top).when(F.col("id") > n - 2_000, top).otherwise(spread)
    columns = [spread, F.col("id") % 7, F.floor(F.sqrt(F.col("id"))), ends, F.exp(F.col("id") / 50)]
    table = spark.range(0, n, 1, 12).select(F.array(*[c.cast("double") for c in columns]).alias("features"))
    names = [f"v{j}" for j in range(len(columns))]
    numbers = stage(table.select(*[F.col("features")[j].alias(c) for j, c in enumerate(names)]), "numbers")
    design = VectorAssembler(inputCols=names, outputCol="features").transform(
        numbers.withColumns({S.HOUSEHOLD: F.col("v0").cast("string"), B.LABEL: F.lit(1.0), "treatment": F.lit(1), "fold": F.lit(0)})
    ).drop(*names)
    values = np.array([tuple(r) for r in numbers.collect()])
    ordered = np.sort(values, axis=0)
    exact = [np.unique([ordered[math.ceil(k * n / bins) - 1, j] for k in range(1, bins)]) for j in range(len(names))]
    want = {v[0]: [int((e < x).sum()) for e, x in zip(exact, v, strict=True)] for v in values.tolist()}
    for parts in (1, 12):
        binned, settings = B.binned_rows(design.repartition(parts), LEARNER, CONFIG)
        assert settings.bins == bins
        found = {float(r[S.HOUSEHOLD]): np.frombuffer(r["bins"], "<u2").tolist() for r in binned.select(S.HOUSEHOLD, "bins").collect()}
        assert found == want


def test_a_folds_rows_have_no_part_in_its_models(binned, trees):
    table, settings = binned
    moved = table.withColumns({B.LABEL: F.when(F.col("fold") == 2, 900 - F.col(B.LABEL)).otherwise(F.col(B.LABEL)),
                               "treatment": F.when(F.col("fold") == 2, 1 - F.col("treatment")).otherwise(F.col("treatment"))})
    for (_, fold), own, other in zip(settings.ensembles, nodes(trees), nodes(B.boosted_trees(moved, settings)), strict=True):
        assert (own == other) == (fold == 2)


def test_rows_that_are_not_drawn_have_no_part_in_a_tree(binned, trees):
    table, settings = binned
    never = table.withColumn("unseen", ~F.exists("drawn", lambda d: d))
    assert table.agg(F.avg(F.aggregate("drawn", F.lit(0), lambda n, d: n + d.cast("int")))).first()[0] == pytest.approx(0.8 * 13, rel=0.05)
    assert never.where("unseen").count() == 0
    one = replace(settings, iterations=1)
    short = table.withColumn("drawn", F.slice("drawn", 1, 1))
    moved = short.withColumn(B.LABEL, F.when(F.col("drawn")[0], F.col(B.LABEL)).otherwise(F.lit(0.0)))
    assert nodes(B.boosted_trees(moved, one)) == nodes(B.boosted_trees(short, one)) == [
        [r for r in own if r[1] == 0] for own in nodes(trees)
    ]


def plain_tree(bins, target, nominal, depth, node=1):
    """Best splits by trying every one."""
    out = {node: (len(target), None, round(float(target.mean()), 9))}
    best = (0.0, None)
    before = target.sum() ** 2 / len(target)
    for j in range(bins.shape[1]):
        order = sorted(set(bins[:, j].tolist()), key=lambda b: (target[bins[:, j] == b].mean() if j in nominal else 0, b))
        for k in range(1, len(order)):
            left = np.isin(bins[:, j], order[:k])
            gain = target[left].sum() ** 2 / left.sum() + target[~left].sum() ** 2 / (~left).sum() - before
            if gain > best[0] + 1e-9 * before:
                best = (gain, (j, left))
    if depth and best[1]:
        j, left = best[1]
        out[node] = (len(target), j, out[node][2])
        out |= plain_tree(bins[left], target[left], nominal, depth - 1, 2 * node)
        out |= plain_tree(bins[~left], target[~left], nominal, depth - 1, 2 * node + 1)
    return out


def test_later_trees_fit_the_residuals(binned, trees):
    table, settings = binned
    rows = B.Rows.of(table.toArrow(), settings)
    for e, (target, fold) in list(enumerate(settings.ensembles))[:4]:
        own = B.Rows.of(table.toArrow(), settings)
        own.add(e, trees[e][:5], 0, settings)
        residuals = own.residuals(e, 5, settings) / settings.scale(target, 5)
        use = (rows.fold != fold) & rows.drawn[:, 5]
        want = plain_tree(rows.bins[use], residuals[use], settings.nominal, settings.depth)
        found = {r[2]: (r[6], r[3] if r[3] >= 0 else None, round(r[5], 9)) for r in B.tree_rows(e, trees[e]) if r[1] == 5}
        assert found.keys() == want.keys()
        for k in want:
            assert found[k][0] == want[k][0] and found[k][1] == want[k][1] and found[k][2] == pytest.approx(want[k][2], abs=1e-6)


def test_boosting_lowers_the_loss_out_of_fold(spark):
    df = generated(spark, 4000, 5, CONFOUNDED)
    predicted = E.cross_fit(E.design_matrix(df, E.Learner("trees", tree_iterations=20), CONFIG, E.TOTAL_OUTCOME), E.Learner("trees", tree_iterations=20), CONFIG)
    row = E.fit_statistics(predicted).first()
    # The noise leaves 0.88 at best.
    assert row.outcome_r2 > 0.8 and E.treatment_auc(predicted).first()[0] > 0.55
    assert predicted.where("t_score NOT BETWEEN 0 AND 1 OR y_hat IS NULL").count() == 0


def test_logistic_fit_equals_the_librarys(spark):
    df = generated(spark, 2000, 5, CONFOUNDED)
    columns = list(E.LINEAR_NUMERIC[:1]) + ["baseline_12m_orders", "baseline_60d_revenue", "recent_60d_order_share"]
    df = df.withColumn("pre_campaign_total_order_value", F.col("baseline_12m_revenue_sum"))
    rows = VectorAssembler(inputCols=columns, outputCol="v").transform(df).select("treatment", "v", F.pmod("id", F.lit(5)).cast("int").alias("fold"))
    table = stage(rows.select("treatment", "fold", vector_to_array("v").alias("features")), "fit-rows")
    problems = [N.Problem(N.LOGISTIC, "treatment", fold, 0.1) for fold in (None, 3)]
    for problem, found in zip(problems, N.solve(table, problems, 4), strict=True):
        own = rows if problem.fold is None else rows.where(F.col("fold") != problem.fold)
        model = LogisticRegression(featuresCol="v", labelCol="treatment", regParam=0.1, tol=1e-12, maxIter=500).fit(own)
        assert found.slopes == pytest.approx(list(model.coefficients), rel=1e-5, abs=1e-9)
        assert found.intercept == pytest.approx(model.intercept, rel=1e-5)
        assert found.gradient < N.GRADIENT and found.steps < 10


def huber_rows(seed, n=600):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.normal(3, 50, n), np.full(n, 7.0), rng.integers(0, 2, n)])
    y = 4 + 2 * x[:, 0] - 0.1 * x[:, 1] + 3 * x[:, 3] + rng.standard_t(2, n)
    return x, y


def test_huber_fit_solves_its_equations_and_resists_outliers(spark):
    x, y = huber_rows(1)
    y[:20] += 1e4
    frame = spark.createDataFrame([(a.tolist(), float(b), k % 3) for k, (a, b) in enumerate(zip(x, y, strict=True))], "features array<double>, y double, fold int")
    (found,) = N.solve(stage(frame, "huber"), [N.Problem(N.HUBER, "y")], 4)
    z = (y - x @ found.slopes - found.intercept) / found.scale
    limited = np.clip(z, -1.35, 1.35)
    assert np.abs(x.T @ limited / len(y) / np.abs(x).max(axis=0)).max() < 1e-7
    assert abs((limited**2).mean() - 1) < 1e-7
    assert found.slopes[[0, 1, 3]] == pytest.approx([2, -0.1, 3], abs=0.4) and found.slopes[2] == 0


def test_huber_fit_of_labels_that_mostly_agree(spark):
    x, _ = huber_rows(2, 200)
    rows = [(a.tolist(), 0.0 if k % 10 else 50.0 + k) for k, a in enumerate(x)]
    frame = stage(spark.createDataFrame(rows, "features array<double>, y double").withColumn("fold", F.lit(0)), "huber")
    (found,) = N.solve(frame, [N.Problem(N.HUBER, "y")], 4)
    assert np.isfinite(found.slopes).all() and found.scale > 0
    assert np.abs(x @ found.slopes + found.intercept).max() < 1
    constant, empty = (frame.withColumn("y", F.lit(3.0)), frame.where("false"))
    assert N.solve(constant, [N.Problem(N.HUBER, "y")], 4)[0].intercept == pytest.approx(3)
    assert N.solve(empty, [N.Problem(N.HUBER, "y")], 4)[0].rows == 0


def test_features_that_follow_from_others(spark):
    x, y = huber_rows(3, 300)
    x[:, 2] = 2 * x[:, 0] - 5
    frame = spark.createDataFrame([(a.tolist(), float(b), int(b > 4)) for a, b in zip(x, y, strict=True)], "features array<double>, y double, t int")
    for found in N.solve(stage(frame.withColumn("fold", F.lit(0)), "twins"), [N.Problem(N.HUBER, "y"), N.Problem(N.LOGISTIC, "t", ridge=0.1)], 4):
        assert found.gradient < 1e-6
    assert found.beta[0] == pytest.approx(found.beta[2])


def t_tail(t, nu):
    """By Simpson's rule on the density."""
    u = np.linspace(0, 1, 200_001)[1:-1]  # from |t| on, by x = |t| + u / (1 - u)
    x = abs(t) + u / (1 - u)
    logs = math.lgamma((nu + 1) / 2) - math.lgamma(nu / 2) - 0.5 * math.log(nu * math.pi) - (nu + 1) / 2 * np.log1p(x * x / nu)
    return 2 * np.exp(logs - 2 * np.log1p(-u)).sum() * (u[1] - u[0])


def test_p_values(spark):
    cases = [(0.0, 5), (0.01, 3.0), (-0.7, 1), (1.0, 2), (1.96, 10), (-2.5, 97), (0.006, 15_000), (4.2, 31), (1.1, 10_000_000), (3.0, 4)]
    frame = spark.createDataFrame([(float(t), float(n)) for t, n in cases], "t double, nu double")
    found = [r[0] for r in frame.select(two_sided_p(F.col("t"), F.col("nu"))).collect()]
    for (t, nu), p in zip(cases, found, strict=True):
        assert p == pytest.approx(t_tail(t, nu), rel=1e-4, abs=1e-7)
    assert found[0] == 1.0
    odd = spark.createDataFrame([(None, 3.0), (1.0, 0.0), (1.0, None)], "t double, nu double")
    assert [r[0] for r in odd.select(two_sided_p(F.col("t"), F.col("nu"))).collect()] == [None] * 3


def test_log_gamma_and_incomplete_beta(spark):
    values = [0.5, 1.0, 1.5, 7.25, 50.0, 1e5, 5e7]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in frame.select(log_gamma(F.col("x"))).collect()] == pytest.approx([math.lgamma(v) for v in values], rel=1e-13, abs=1e-13)
    # I_x(a, 1) = x ** a and I_x(1, b) = 1 - (1 - x) ** b
    row = frame.limit(1).select(incomplete_beta(F.lit(3.0), F.lit(1.0), F.lit(0.3)), incomplete_beta(F.lit(1.0), F.lit(4.0), F.lit(0.9))).first()
    assert tuple(row) == pytest.approx((0.3**3, 1 - 0.1**4), rel=1e-12)


def test_solved_drops_what_follows_from_earlier_columns():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(50, 3))
    x[:, 2] = x[:, 0] - 2 * x[:, 1] + 1
    y = x @ [1, 2, 0] + 5
    full = np.column_stack([x, y])
    products = np.cov(full.T, bias=True) * len(y)
    slopes, errors, degrees = solved(products, 50)
    assert slopes == pytest.approx([1, 2, 0]) and np.isnan(errors).all() and degrees == 46


@pytest.mark.parametrize("slices", [1, 7, 4096])
def test_area_under_curve(spark, monkeypatch, slices):
    from hearthlift.operators import ranking

    monkeypatch.setattr(ranking, "SCORE_SLICES", slices)
    rng = np.random.default_rng(6)
    score, label = np.round(rng.random(700) ** 3, 2), rng.integers(0, 2, 700)
    frame = spark.createDataFrame([(float(s), int(t)) for s, t in zip(score, label, strict=True)] + [(None, 1)], "s double, t int").repartition(5)
    one, other = score[label == 1][:, None], score[label == 0][None, :]
    want = ((one > other) + 0.5 * (one == other)).mean()
    assert area_under_curve(frame, "t", "s").first()[0] == pytest.approx(want, abs=1e-12)
    assert area_under_curve(frame.where("t = 1"), "t", "s").first()[0] is None
    assert area_under_curve(frame.where("s = 0"), "t", "s").first()[0] == 0.5
    assert area_under_curve(frame.where("false"), "t", "s").first()[0] is None
