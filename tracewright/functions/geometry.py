"""Quaternions (x, y, z, w) and rotation vectors as column expressions on arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rotations smaller than this take the first-order form.
SMALL = 1e-12


def at(v: Column, i: int) -> Column:
    return F.get(v, F.lit(i))


def vec(*xs: Column) -> Column:
    return F.array(*xs)


def norm(v: Column) -> Column:
    """Euclidean length of an array; null for null."""
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))


def scaled(v: Column, f: Column | float) -> Column:
    return F.transform(v, lambda x: x * f)


def minus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def unit_quaternion(q: Column) -> Column:
    """q over its length; null where the length is 0 or not finite."""
    n = norm(q)
    return F.when((n > 0) & (n < float("inf")), F.transform(q, lambda x: x / n))


def conjugate(q: Column) -> Column:
    return vec(-at(q, 0), -at(q, 1), -at(q, 2), at(q, 3))


def multiply(p: Column, q: Column) -> Column:
    """Hamilton product."""
    px, py, pz, pw = (at(p, i) for i in range(4))
    qx, qy, qz, qw = (at(q, i) for i in range(4))
    return vec(
        pw * qx + px * qw + py * qz - pz * qy,
        pw * qy + py * qw + pz * qx - px * qz,
        pw * qz + pz * qw + px * qy - py * qx,
        pw * qw - px * qx - py * qy - pz * qz,
    )


def rotvec_of(q: Column) -> Column:
    """Rotation vector of a unit quaternion, by the shorter way round."""
    sign = F.when(at(q, 3) < 0, -1.0).otherwise(1.0)
    n = norm(F.slice(q, 1, 3))
    f = F.when(n < SMALL, 2.0).otherwise(2 * F.atan2(n, at(q, 3) * sign) / n) * sign
    return scaled(F.slice(q, 1, 3), f)


def quaternion_of(r: Column) -> Column:
    """Quaternion of a rotation vector; of unit length but for the tiniest rotations."""
    t = norm(r)
    f = F.when(t < SMALL, 0.5).otherwise(F.sin(t / 2) / t)
    return vec(at(r, 0) * f, at(r, 1) * f, at(r, 2) * f, F.when(t < SMALL, 1.0).otherwise(F.cos(t / 2)))


def relative_rotvec(q0: Column, q1: Column) -> Column:
    """Rotation from q0 to q1 in the frame of q0."""
    return rotvec_of(multiply(conjugate(unit_quaternion(q0)), unit_quaternion(q1)))
