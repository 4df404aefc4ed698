import math

import pytest
from pyspark.sql import functions as F

from tracewright.functions import geometry as G
from tracewright.operators.actions import delta_action


def value(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


def q(*xs):
    return F.array(*(F.lit(float(x)) for x in xs))


H = math.sqrt(0.5)


@pytest.mark.parametrize("scale", [1.0, 2.0])
def test_quarter_turn(spark, scale):
    r = value(spark, G.relative_rotvec(q(0, 0, 0, scale), q(0, 0, H * scale, H * scale)))
    assert r == pytest.approx([0, 0, math.pi / 2], abs=1e-12)


def test_shorter_way_round(spark):
    assert value(spark, G.rotvec_of(q(0, 0, -H, -H))) == pytest.approx([0, 0, math.pi / 2], abs=1e-12)


def test_round_trip_of_rotation_vectors(spark):
    for r in ([0.3, -0.2, 0.5], [0.0, 0.0, 0.0], [1e-14, 0, 0], [0, 3.0, 0]):
        assert value(spark, G.rotvec_of(G.unit_quaternion(G.quaternion_of(q(*r))))) == pytest.approx(r, abs=1e-12)


def test_zero_quaternion_is_null(spark):
    assert value(spark, G.unit_quaternion(q(0, 0, 0, 0))) is None


def test_delta_action(spark):
    one = q(0, 0, 0, 1)
    same = delta_action(q(1, 2, 3), one, F.lit(None).cast("double"), q(1, 2, 3), one, F.lit(0.2))
    assert value(spark, same) == pytest.approx([0.0] * 7)
    moved = delta_action(q(0, 0, 0), one, F.lit(0.2), q(0.25, 0, 0), one, F.lit(0.4))
    assert value(spark, moved) == pytest.approx([0.25, 0, 0, 0, 0, 0, 0.2])
