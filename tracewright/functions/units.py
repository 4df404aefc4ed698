"""Unit names, their factors to the common units, and how texts state them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: unit spellings (lower case) and factors to the common unit ---------
ANGLE = {
    "rad": 1.0, "radian": 1.0, "radians": 1.0,
    "deg": 0.017453292519943295, "degree": 0.017453292519943295, "degrees": 0.017453292519943295, "°": 0.017453292519943295,
    "mrad": 0.001, "milliradian": 0.001, "milliradians": 0.001,
}
ANGLE_RATE = {
    "rad/s": 1.0, "rad/sec": 1.0, "rad_per_s": 1.0, "rad s^-1": 1.0, "radian/s": 1.0, "radians/s": 1.0,
    "radians_per_second": 1.0, "radians per second": 1.0,
    "deg/s": 0.017453292519943295, "deg/sec": 0.017453292519943295, "deg_per_s": 0.017453292519943295,
    "degree/s": 0.017453292519943295, "degrees/s": 0.017453292519943295, "degrees_per_second": 0.017453292519943295,
    "degrees per second": 0.017453292519943295, "deg s^-1": 0.017453292519943295, "°/s": 0.017453292519943295,
    "mrad/s": 0.001, "mrad_per_s": 0.001, "milliradians per second": 0.001, "milliradians_per_second": 0.001,
    "rpm": 0.10471975511965977, "rev/min": 0.10471975511965977,
}
FORCE = {
    "n": 1.0, "newton": 1.0, "newtons": 1.0,
    "mn": 0.001, "millinewton": 0.001, "millinewtons": 0.001,
    "kn": 1000.0, "kilonewton": 1000.0,
    "kgf": 9.80665, "kp": 9.80665, "kilogram-force": 9.80665, "kilopond": 9.80665,
    "lbf": 4.4482216152605, "pound-force": 4.4482216152605, "pounds-force": 4.4482216152605,
}
TORQUE = {
    "nm": 1.0, "n*m": 1.0, "n.m": 1.0, "newton_meter": 1.0, "newton-meter": 1.0, "newton meter": 1.0,
    "mnm": 0.001, "mn*m": 0.001, "mn.m": 0.001, "milli-newton-meter": 0.001,
    "ncm": 0.01, "n*cm": 0.01, "n.cm": 0.01,
    "kgf*cm": 0.0980665, "kgf.cm": 0.0980665, "kgfcm": 0.0980665, "kgf*m": 9.80665, "kgf.m": 9.80665,
    "in-lbf": 0.1129848290276167, "lbf*in": 0.1129848290276167, "lbf.in": 0.1129848290276167,
    "ft-lbf": 1.3558179483314004, "lbf*ft": 1.3558179483314004,
}
LENGTH = {
    "m": 1.0, "metre": 1.0, "metres": 1.0, "meter": 1.0, "meters": 1.0,
    "mm": 0.001, "millimetre": 0.001, "millimetres": 0.001, "millimeter": 0.001, "millimeters": 0.001,
    "cm": 0.01, "centimetre": 0.01, "centimetres": 0.01, "centimeter": 0.01, "centimeters": 0.01,
    "in": 0.0254, "inch": 0.0254, "inches": 0.0254, '"': 0.0254,
}
#: Keys of unit objects by quantity, the first that is there holds.
UNIT_KEYS = {
    "angle": ("joint_position", "position"),
    "angle_rate": ("joint_velocity", "velocity"),
    "force": ("force",),
    "torque": ("torque",),
}
# --- end of the fixed values ----------------------------------------------------------

TABLES = {"angle": ANGLE, "angle_rate": ANGLE_RATE, "force": FORCE, "torque": TORQUE, "length": LENGTH}
_META = set(".^$*+?()[]{}|\\/-")


def _quote(s: str) -> str:
    return "".join("\\" + ch if ch in _META else ch for ch in s)


def _pattern(kind: str) -> str:
    """The first spelling of a unit of this kind that stands free in a text: no letter,
    digit or unit sign before or after it, and (for angles) no rate made of it."""
    names = "|".join(_quote(u) for u in sorted(TABLES[kind], key=lambda u: (-len(u), u)))
    after = r"(?![\w*/^°]|[.\-](?=\w)| per | s\^)" if kind in ("angle", "force") else r"(?![\w*/^°]|[.\-](?=\w))"
    return rf"(?i)(?<![\w*/.^\-])({names}){after}"


def factor_of(name: Column, kind: str) -> Column:
    """Factor from a unit's spelling to the common unit; null for an unknown name."""
    m = F.expr("map(" + ", ".join(f"'{k}', {v!r}D" for k, v in TABLES[kind].items()) + ")")
    return F.try_element_at(m, F.lower(F.trim(name)))


def stated_factor(text: Column, kind: str) -> Column:
    """Factor that a statement gives for a kind of quantity: a JSON object by its keys,
    any other text by its first free-standing unit of that kind; null if it gives none."""
    by_key = F.coalesce(*(factor_of(F.get_json_object(text, f"$.{k}"), kind) for k in UNIT_KEYS[kind]))
    free = factor_of(F.nullif(F.regexp_extract(text, _pattern(kind), 1), F.lit("")), kind)
    return F.when(text.isNull(), None).when(F.ltrim(text).startswith("{"), by_key).otherwise(free)


def stated_length_factor(text: Column) -> Column:
    """Factor of a length unit that a remark names as the unit of the values ("in mm",
    "widths: cm", "logged as inch"); a length that is itself a figure says nothing."""
    names = "|".join(_quote(u) for u in sorted(LENGTH, key=lambda u: (-len(u), u)))
    return factor_of(F.nullif(F.regexp_extract(text, rf"(?i)(?:\bin|:|\bas)\s+({names})(?!\w)", 1), F.lit("")), "length")


def commanded_length_unit(text: Column) -> Column:
    """Factor of the unit after the first figure of a command, such as 12.5 mm."""
    names = "|".join(_quote(u) for u in sorted(LENGTH, key=lambda u: (-len(u), u)))
    return factor_of(F.nullif(F.regexp_extract(text, rf"(?i)[0-9]\s*({names})(?!\w)", 1), F.lit("")), "length")
