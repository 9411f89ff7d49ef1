import random
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
from pyspark.sql import functions as F

from sievework.functions.rounding import round_array_style, round_half_even, to_fixed


def values():
    rng = random.Random(3)
    ties = [n / 40 for n in range(0, 4001)] + [n / 400 for n in range(0, 4001)]
    near = [np.nextafter(v, side) for v in ties for side in (0.0, 1e9)]
    shares = [rng.randint(0, 10**6) / rng.randint(1, 10**6) * 100 for _ in range(5000)]
    return [float(v) for v in ties + list(near) + shares + [2.675, 1.005, 0.0, 100.0, 8.005]]


def test_rounding_agrees_with_python_arrays_and_to_fixed(spark):
    v = F.col("v")
    rows = (
        spark.createDataFrame([(x,) for x in values()], "v double")
        .select(
            v,
            round_half_even(v, 1).alias("r1"),
            round_half_even(v, 2).alias("r2"),
            round_array_style(v, 2).alias("a2"),
            to_fixed(v, 1).alias("f1"),
        )
        .collect()
    )
    for r in rows:
        assert r["r1"] == round(r["v"], 1), r
        assert r["r2"] == round(r["v"], 2), r
        assert r["a2"] == float(np.round(r["v"], 2)), r
        # Decimal holds the exact binary value.
        assert r["f1"] == str(Decimal(r["v"]).quantize(Decimal("0.1"), rounding=ROUND_HALF_UP)), r
