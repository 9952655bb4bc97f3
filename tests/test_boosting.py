"""Boosted trees on tables: against a brute-force tree, planted missing values, three classes, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickweave.operators import boosting, evaluate, models
from tickweave.operators.boosting import Boosted, best_cut


@pytest.fixture(scope="module")
def planted(spark):
    """The target is high where x is missing or over 60, and turns with the class of z."""
    rows = spark.range(3000, numPartitions=6).select(F.col("id"), (F.abs(F.hash("id")) % 100).cast("double").alias("v"), (F.abs(F.hash(F.lit(7), "id")) % 4).cast("double").alias("z"))
    rows = rows.withColumn("x", F.when(F.col("id") % 5 > 0, F.col("v")))
    high = F.col("x").isNull() | (F.col("x") > 60)
    return rows.select("id", "x", "z", F.when(high, F.when(F.col("z") < 2, 5.0).otherwise(3.0)).otherwise(1.0).alias("target"))


def brute(x, y, least, ridge):
    """Best single cut over all values and both sides for missing values: (gain, feature, side means)."""
    best = (0.0, None, None)
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f][np.isfinite(x[:, f])]):
            for side in (False, True):
                left = np.where(np.isnan(x[:, f]), side, x[:, f] <= cut)
                if least <= left.sum() <= len(y) - least:
                    part = lambda m: y[m].sum() ** 2 / (m.sum() + ridge)
                    gain = part(left) + part(~left) - part(np.ones(len(y), bool))
                    if gain > best[0] + 1e-9:
                        best = (gain, f, (y[left].mean(), y[~left].mean()))
    return best


def test_first_cut_equals_brute_force(spark, planted):
    model, _ = models.train_regressor(planted, ["x", "z"], depth=1, rate=1.0, rounds=1, bins=255)
    got = planted.toPandas()
    gain, f, sides = brute(got[["x", "z"]].to_numpy(float), got["target"].to_numpy() - got["target"].mean(), 20, 0.0)
    tree = model.rounds[0][0]
    assert tree.feature[0] == f and tree.missing_left[0] == (not tree.cut[0] < 255 or sides[0] > sides[1])
    assert np.allclose(tree.value[1:3] * model.scale, sides, atol=1e-4)


def test_trees_do_not_depend_on_partitions(planted):
    kinds = [boosting.fit(planted.repartition(n), ["x", "z"], depth=3, rounds=2, rate=0.5).to_json() for n in (1, 7)]
    assert kinds[0] == kinds[1]


def test_missing_values_beat_zeros(planted):
    """One cut: missing values go with the high ones, which zeros, below the cut, cannot."""
    errors = []
    plain = planted.withColumn("target", F.when(F.col("target") > 2, 4.0).otherwise(1.0))
    for rows in (plain, plain.fillna(0.0, subset=["x"])):
        model, _ = models.train_regressor(rows, ["x"], depth=1, rounds=1, rate=1.0)
        errors.append(models.predict(model, {}, rows).agg(F.avg(F.abs(F.col("prediction") - F.col("target")))).first()[0])
    assert errors[0] < 0.6 * errors[1], errors


def test_three_classes_in_one_model(planted):
    rows = planted.withColumn("target", F.col("target").cast("int"))
    model, _ = models.train_classifier(rows, ["x", "z"], depth=2, rounds=12, rate=0.5)
    assert model.classes == [1.0, 3.0, 5.0] and all(len(trees) == 3 for trees in model.rounds)
    assert len(model.rounds) > boosting.REFRESH  # margins were written anew on the way
    got = models.predict(model, {}, rows).filter("prediction = target").count()
    assert got == rows.count()
    again = Boosted.from_json(model.to_json())
    assert models.predict(again, {}, rows).filter("prediction = target").count() == got


def test_odd_rows(spark):
    nothing = float("nan")
    rows = spark.createDataFrame([(1.0, 2.0, 3.0, "a")] * 30 + [(nothing, float("inf"), 9.0, "b")] * 30 + [(None, 2.0, None, "c")], "x double, flat double, target double, prediction string")
    model, _ = models.train_regressor(rows, ["x", "flat"], depth=2, rounds=3, rate=1.0)
    got = {r["target"]: r["prediction"] for r in models.predict(model, {}, rows.drop("prediction")).collect()}
    assert abs(got[3.0] - 3.0) < 1e-4 and abs(got[9.0] - 9.0) < 1e-4 and abs(got[None] - 9.0) < 1e-4
    assert models.predict(model, {}, rows.limit(0)).count() == 0
    assert models.predict(model, {}, rows.drop("x", "flat")).select("prediction").distinct().count() == 1
    constant, _ = models.train_classifier(rows.withColumn("target", F.lit(2)), ["x"], depth=1, rounds=2)
    assert {r[0] for r in models.predict(constant, {}, rows).select("prediction").collect()} == {2.0}
    with pytest.raises(ValueError):
        models.train_regressor(rows.withColumn("target", F.lit(None).cast("double")), ["x"])


def test_cut_gives_missing_values_the_better_side():
    sums = np.zeros((4, 3), np.int64)
    sums[0], sums[1], sums[3] = (-40 * boosting.UNIT, 40 * boosting.UNIT, 40), (40 * boosting.UNIT, 40 * boosting.UNIT, 40), (30 * boosting.UNIT, 30 * boosting.UNIT, 30)
    assert best_cut(sums, 20, 0.0)[1:3] == (0, False)
    sums[3, 0] *= -1
    assert best_cut(sums, 20, 0.0)[1:3] == (0, True)
    sums[3] = 0
    assert best_cut(sums, 50, 0.0)[0] == -1.0
