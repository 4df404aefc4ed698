"""Fixed-length vectors: layouts, checks, slices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewright.functions.geometry import norm
from tracewright.functions.stamps import finite, finite_vector

# --- fixed values: widths and layouts of the vectors (first place, length; from 1) -----
STATE_DIM, ACTION_DIM, JOINTS, WRENCH_DIM = 25, 7, 6, 6
STATE_LAYOUT = {"position": (1, 3), "rotation": (4, 3), "gripper": (7, 1), "wrench": (8, 6), "joint_position": (14, 6), "joint_velocity": (20, 6)}
ACTION_LAYOUT = {"translation": (1, 3), "rotation": (4, 3), "gripper": (7, 1)}
PROFILES = {"compact_13d": 13, "full_25d": 25}
WRENCH_ORDER = ("tcp_wrench", "measured_tcp_wrench", "external_tcp_force", "raw_force_torque")
ZERO, MOTION = 1e-12, 1e-12


def part(v: Column, layout: dict, name: str) -> Column:
    return F.slice(v, *layout[name])


def profile_slice(state: Column, profile: str) -> Column:
    """The first components of a full state that a profile exports."""
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}; known: {sorted(PROFILES)}")
    return F.slice(state, 1, PROFILES[profile])


def is_zero(v: Column) -> Column:
    return F.forall(v, lambda x: F.abs(x) <= ZERO)


def moves(v: Column) -> Column:
    return norm(v) > MOTION


def first_valid(columns: list[str], n: int) -> tuple[Column, Column]:
    """The first column holding n finite numbers, and its name; null where none does."""
    valid = [(c, finite_vector(F.col(c), n)) for c in columns]
    return F.coalesce(*(F.when(ok, F.col(c)) for c, ok in valid)), F.coalesce(*(F.when(ok, F.lit(c)) for c, ok in valid))


def unique(v: Column) -> Column:
    return F.size(F.array_distinct(v)) == F.size(v)


def max_abs(v: Column) -> Column:
    return F.array_max(F.transform(v, lambda x: F.abs(x)))


__all__ = ["finite", "finite_vector", "norm"]
