"""The median counted out of the bits of doubles, against sorting."""

import numpy as np
import pytest

from tickweave.operators.evaluate import exact_median

RNG = np.random.default_rng(3)


@pytest.mark.parametrize("values", [
    [1.5], [2.0, 1.0], [-1.0, -2.0, -3.0, -4.0], [0.0, -0.0, 1e-300, -1e-300], [1e300, -1e300, 5e-324], [3.0] * 9 + [4.0] * 9, [None, 2.0, None, 8.0],
    RNG.normal(0, 1, 1001).tolist(), RNG.normal(0, 1, 1000).round(1).tolist(), (10.0 ** RNG.uniform(-200, 200, 500)).tolist(),
])
def test_median(spark, values):
    got = exact_median(spark.createDataFrame([(v,) for v in values], "x double"), "x")
    assert got == np.median([v for v in values if v is not None])


def test_median_of_nothing(spark):
    assert exact_median(spark.createDataFrame([], "x double"), "x") is None
