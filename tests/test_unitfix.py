import pytest
from pyspark.sql import functions as F

from tests.helpers import clashing
from tracewright.functions.units import TABLES, stated_factor, stated_length_factor
from tracewright.operators import unitfix

STATEMENTS = [
    ('{"force": " n", "torque": "N.m"}', 1.0, 1.0),
    ('{"tcp_position": "mm", "force": "lbf", "torque": "in-lbf"}', 4.4482216152605, 0.1129848290276167),
    ("F [millinewton] T [mNm]", 0.001, 0.001),
    ("force n / torque newton_meter", 1.0, 1.0),
    ("kgf and kgf.cm", 9.80665, 0.0980665),
    ("N and Nm", 1.0, 1.0),
    ("Forces newton, moments Ncm, see the amplifier sheet.", 1.0, 0.01),
    ("Wrench channel written in kp and kgf*cm; overload trip at 150 N.", 9.80665, 0.0980665),
    ("Amplifier set to pound-force for forces and in-lbf for moments.", 4.4482216152605, 0.1129848290276167),
    ("pound-force and lbf*in", 4.4482216152605, 0.1129848290276167),
    ("mN and milli-newton-meter", 0.001, 0.001),
    ("no remarks", None, None),
    ("checked against the pendant", None, None),
    ("{broken", None, None),
    ("", None, None),
    (None, None, None),
]
DEG = 0.017453292519943295
RATES = [
    ('{"joint_position": "°", "joint_velocity": "DEG/SEC"}', DEG, DEG),
    ('{"position": " rad ", "velocity": "rev/min"}', 1.0, 0.10471975511965977),
    ("pos in mrad, vel in milliradians per second", 0.001, 0.001),
    ("position=Deg velocity=rad s^-1", DEG, 1.0),
    ("°; °/s", DEG, DEG),
    ("radian; rad_per_s", 1.0, 1.0),
    ("Driver publishes angles in RAD and rates in radians_per_second; joint soft limit is 170 deg/s.", 1.0, 1.0),
    ("After the firmware swap the topic carries ° for angles, degrees_per_second for rates.", DEG, DEG),
    ("Angles deg, speeds rad s^-1, compared with the pendant on the bench.", DEG, 1.0),
]


@pytest.mark.parametrize("cases, kinds", [(STATEMENTS, ("force", "torque")), (RATES, ("angle", "angle_rate"))])
def test_statements(spark, cases, kinds):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i long, u string")
    got = df.select("i", *(stated_factor(F.col("u"), k).alias(k) for k in kinds)).orderBy("i").collect()
    for r, c in zip(got, cases):
        assert (r[1], r[2]) == c[1:], c


def test_every_spelling_alone(spark):
    for kind in ("angle", "angle_rate", "force", "torque"):
        df = spark.createDataFrame(list(TABLES[kind].items()), "u string, f double")
        bad = df.where(~stated_factor(F.col("u"), kind).eqNullSafe(F.col("f"))).collect()
        assert not bad, bad


def test_length_remarks(spark):
    cases = [("Opening is in in in spite of the field name.", 0.0254), ("finger opening logged as MM", 0.001), ("widths: \"", 0.0254), ("widths: cm", 0.01), ("jaw stroke 110 mm, placeholder driver", None), ("checked against the pendant", None)]
    df = spark.createDataFrame(cases, "n string, f double")
    assert df.where(~stated_length_factor(F.col("n")).eqNullSafe(F.col("f"))).count() == 0


J = "joint_row_id long, episode_id string, position array<double>, velocity array<double>, units string"
R = "state_row_id long, episode_id string, tcp_wrench array<double>, units string"
G = "gripper_row_id long, episode_id string, gripper_width_m double, gripper_command string"
SI = "entry_id long, episode_id string, stream_name string, units string, notes string"


def test_record_before_entry_before_notes(spark):
    v = [1.0] * 6
    si = [
        (1, "a", "joint_states", '{"position": "deg", "velocity": "rad/s"}', "Angles mrad, speeds mrad/s, compared."),
        (2, "b", "joint_states", None, "Angles mrad, speeds rad/s, compared with it."),
        (3, "a", "robot_state_rt", '{"force": "kgf"}', None),
    ]
    j = [(1, "a", v, v, None), (2, "a", v, v, "rad; rpm"), (3, "b", v, None, None), (4, "b", v[:2], [float("nan")] * 6, "rad; deg/s"), (5, "c", v, v, None), (6, None, v, v, "deg; rad/s"), (7, "a", None, None, "deg; deg/s")]
    r = [(1, "a", v, None), (2, "a", v, '{"torque": "Ncm"}'), (3, "z", v, "N and Nm"), (4, "a", v, "N and Nm"), (5, "a", None, None)]
    args = [clashing(spark.createDataFrame(x, s)) for x, s in ((j, J), (r, R), ([], G), (si, SI))]
    got = {tuple(x) for x in unitfix.found(*args).collect()}
    assert got == {
        ("joint_states.position", 1), ("joint_states.velocity", 2), ("joint_states.position", 3), ("joint_states.velocity", 4), ("joint_states.position", 6),
        ("robot_state_rt.tcp_wrench", 1), ("robot_state_rt.tcp_wrench", 2),
    }
    c = {x["joint_row_id"]: x for x in unitfix.convert_joints(args[0], args[3]).collect()}
    assert c[1]["position"][0] == pytest.approx(DEG) and c[2]["velocity"][0] == pytest.approx(0.10471975511965977)


def test_gripper_units_by_posterior(spark):
    rows, i = [], 0
    scale = {"m1": 1.0, "m2": 1.0, "mm": 1000.0, "cm": 100.0, "in": 1 / 0.0254, "m3": 1.0, "m4": 1.0}
    cmd = {"cm": "move 3.2 cm", "in": "close to 1.1 in", "m1": "open 32 mm slow"}
    for e, s in scale.items():
        for k in range(30):
            i += 1
            rows.append((i, e, (0.02 + 0.002 * k) * s, cmd.get(e)))
    rows += [(900, "mm", None, None), (901, "mm", float("nan"), None), (902, None, 0.05, None)]
    g = spark.createDataFrame(rows, G)
    si = spark.createDataFrame([(1, "m4", "gripper_state", None, "jaw stroke 110 mm, placeholder driver")], SI)
    u = {r["episode_id"]: r for r in unitfix.gripper_units(g, si).collect()}
    assert {e: u[e]["factor"] for e in scale} == {e: pytest.approx(1 / s) for e, s in scale.items()}
    w = unitfix.convert_gripper(g, si).where("gripper_width_m is not null and not isnan(gripper_width_m)").agg(F.min("gripper_width_m"), F.max("gripper_width_m")).first()
    assert 0.006 <= w[0] and w[1] <= 0.11
    none = spark.createDataFrame([], J), spark.createDataFrame([], R)
    got = {r["row_id"] for r in unitfix.found(*none, g, si).collect()}
    assert 901 in got and 900 not in got and 902 not in got


def test_empty(spark):
    assert unitfix.found(*(spark.createDataFrame([], s) for s in (J, R, G, SI))).count() == 0


def test_mixture_flags_uncertain_sources(spark):
    lev = spark.createDataFrame([(float(x),) for x in (-2.9, -3.0, -3.1, -2.8, 3.9, 4.0, 1.2)], "level double")
    m = unitfix.log_level_mixture(lev, [0.001, 0.01, 0.0254, 1.0], lev.where("level < 0"))
    post = [r["post"] for r in unitfix.with_posterior(lev, m).collect()]
    assert post[0].index(max(post[0])) == 3 and post[5].index(max(post[5])) == 0


def test_suspicion_of_unstated_sources(spark):
    """Sources on the common scale, one a thousand times larger, one that states its unit."""
    import random

    r = random.Random(1)
    vec = lambda f: [f * r.uniform(5, 15) for _ in range(6)]
    robot = [(e * 100 + i, f"e{e}", vec(1000.0 if e in (7, 8) else 1.0), '{"force": "mN", "torque": "mNm"}' if e == 8 else None) for e in range(20) for i in range(30)]
    df = spark.createDataFrame(robot, "state_row_id long, episode_id string, tcp_wrench array<double>, units string")
    j = spark.createDataFrame([], "joint_row_id long, episode_id string, position array<double>, velocity array<double>, units string")
    si = spark.createDataFrame([], "entry_id long, episode_id string, stream_name string, units string, notes string")
    rows = {(x["field_name"][-6:], x["episode_id"]): x for x in unitfix.suspicion(clashing(j), clashing(df), si).collect()}
    assert ("torque", "e8") not in rows and ("torque", "e3") in rows and len(rows) == 2 * 19
    assert rows["torque", "e7"]["suspect"] and rows[" force", "e7"]["suspect"] and not rows[" force", "e3"]["suspect"]
    assert rows["torque", "e7"]["likeliest_factor"] == 0.001 and rows[" force", "e3"]["likeliest_factor"] == 1.0
    assert unitfix.suspicion(j, df.where("false"), si).count() == 0
