"""From recorded streams to processed episodes: stated units, states, actions, frames.

A record's unit object overlays its stream entry's, key by key. A state is position (m),
rotation vector (rad, as recorded: never brought below half a turn), gripper, wrench, joint
positions (rad) and velocities (rad/s). What cannot be built is null, and ``error`` says what
was missing first, so a bad record stops no other. Everything is an equi-join on (episode,
index); nothing is gathered.

Defined results: a unit that is stated but unknown is an error, an unstated one takes the
default the caller gives (none by default); of several rows of one record index the smallest
row id holds; an empty table gives an empty result; extra columns are unread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.geometry import rotvec_of, unit_quaternion, vec
from tracewright.functions.labels import unit_label
from tracewright.functions.stamps import finite, finite_vector, stamp_seconds
from tracewright.functions.vectors import STATE_DIM, WRENCH_ORDER, first_valid
from tracewright.operators import actions, align

# --- fixed values: spellings of units in unit objects -----------------------------------
MILLIMETRES = ["mm", "millimeter", "millimeters"]
METRES = ["m", "meter", "meters"]
DEGREES = ["deg", "degree", "degrees"]
RADIANS = ["rad", "radian", "radians"]
DEGREE_RATES = ["deg/s", "deg_per_s", "degree/s", "degrees/s", "degrees_per_second"]
RADIAN_RATES = ["rad/s", "rad_per_s", "radian/s", "radians/s", "radians_per_second"]
#: What an unstated unit means in recordings that say they are synthetic.
SYNTHETIC_UNITS = {"tcp_position": "mm", "tcp_orientation": "deg", "joint_position": "deg", "joint_velocity": "deg/s"}
KEYS = {"tcp_position": ("tcp_position",), "tcp_orientation": ("tcp_orientation",), "joint_position": ("joint_position", "position"), "joint_velocity": ("joint_velocity", "velocity")}
CONVENTION_UNITS = {"rotation_vector_degrees": "deg", "rotation_vector_radians": "rad"}
# --- end of the fixed values ------------------------------------------------------------
QUANTITIES = tuple(KEYS)


def stated_unit(units: Column, key: str) -> Column:
    """The label a unit object gives for a key; null if it is no object or does not say."""
    return F.when(F.ltrim(units).startswith("{"), F.nullif(unit_label(F.get_json_object(units, f"$.{key}")), F.lit("")))


def merged_unit(record: Column, entry: Column, quantity: str, default: str | None = None) -> Column:
    """The unit of a quantity: per key the record's label goes before its entry's, and the
    quantity's keys are asked one after the other."""
    said = [s for k in KEYS[quantity] for s in (stated_unit(record, k), stated_unit(entry, k))]
    return F.coalesce(*said, F.lit(default).cast("string"))


def entry_units(streams_index: DataFrame, stream: str) -> DataFrame:
    """(episode_id, entry_units): the unit object of the stream's entry of smallest id."""
    s = streams_index.where((F.col("stream_name") == stream) & F.col("episode_id").isNotNull() & F.ltrim("units").startswith("{"))
    return s.groupBy("episode_id").agg(F.min_by("units", "entry_id").alias("entry_units"))


def to_metres(v: Column, unit: Column) -> Column:
    return F.when(unit.isin(MILLIMETRES), F.transform(v, lambda x: x / F.lit(1000.0))).when(unit.isin(METRES), v)


def to_radians(v: Column, unit: Column) -> Column:
    return F.when(unit.isin(DEGREES + DEGREE_RATES), F.transform(v, lambda x: F.radians(x))).when(unit.isin(RADIANS + RADIAN_RATES), v)


def orientation_unit(convention: Column, synthetic: Column) -> Column:
    """The unit that the stated convention implies; null where it is none that is supported."""
    by = F.coalesce(*(F.when(convention == c, F.lit(u)) for c, u in CONVENTION_UNITS.items()))
    return F.when(synthetic, "deg").otherwise(by)


def convention_error(convention: Column) -> Column:
    """Null for a supported convention, else why it is refused."""
    return (
        F.when(convention.isin(list(CONVENTION_UNITS)), None)
        .when(convention.isNull(), "orientation convention is not stated")
        .when(F.lower(convention).contains("euler") | F.lower(convention).contains("zyz"), "native Euler angles are recognised and refused")
        .otherwise("orientation convention is unknown")
    )


def with_entry(records: DataFrame, streams_index: DataFrame, stream: str) -> DataFrame:
    e = entry_units(streams_index, stream).withColumnRenamed("episode_id", "__ep")
    return records.drop("entry_units", "__ep").join(e, F.col("episode_id") == F.col("__ep"), "left").drop("__ep")


def poses(robot_state: DataFrame, streams_index: DataFrame, defaults: dict[str, str] | None = None) -> DataFrame:
    """(episode_id, record_index, state_row_id, position, rotation, error): of each record
    index its first row's pose in m and rad by the units it states."""
    d = defaults or {}
    key = ["episode_id", "record_index"]
    one = align.first_by_index(robot_state.where(F.col("record_index").isNotNull()).select(*key, "state_row_id", "actual_tcp_position", "units"), key, "state_row_id")
    r = with_entry(one, streams_index, "robot_state_rt")
    u = {q: merged_unit(F.col("units"), F.col("entry_units"), q, d.get(q)) for q in ("tcp_position", "tcp_orientation")}
    v = F.col("actual_tcp_position")
    ok = finite_vector(v, 6)
    p = F.when(ok, to_metres(F.slice(v, 1, 3), u["tcp_position"]))
    a = F.when(ok, to_radians(F.slice(v, 4, 3), u["tcp_orientation"]))
    error = F.when(~F.coalesce(ok, F.lit(False)), "tcp position is not 6 finite numbers").when(p.isNull(), "tcp_position unit is missing or unknown").when(a.isNull(), "tcp_orientation unit is missing or unknown")
    return r.select(*key, "state_row_id", p.alias("position"), a.alias("rotation"), error.alias("error"))


def gripper_value(position: Column, width: Column) -> Column:
    return F.coalesce(F.when(finite(position), position), F.when(finite(width), width))


def states(robot_state: DataFrame, joint_states: DataFrame, gripper_state: DataFrame | None, streams_index: DataFrame, defaults: dict[str, str] | None = None) -> DataFrame:
    """(episode_id, record_index, position, rotation, gripper, model_state, wrench_source,
    joint_source, error) of every record index of the robot's timeline.

    Wrench: the first valid of four vectors, record by record. Joints: the robot's own vectors
    where the table has them and they are valid, else those of joint_states at the same index,
    position and velocity each for itself. Without a gripper stream the gripper is 0."""
    d = defaults or {}
    key = ["episode_id", "record_index"]
    own = [c for c in ("actual_joint_position", "actual_joint_velocity") if c in robot_state.columns]
    cols = [*WRENCH_ORDER, "units", *own]
    r = align.first_by_index(robot_state.where(F.col("record_index").isNotNull()).select(*key, "state_row_id", *cols), key, "state_row_id")
    r = with_entry(r, streams_index, "robot_state_rt").withColumnRenamed("units", "r_units").withColumnRenamed("entry_units", "r_entry")
    j = align.first_by_index(joint_states.select(*key, "joint_row_id", F.col("position").alias("j_position"), F.col("velocity").alias("j_velocity"), F.col("units").alias("units")), key, "joint_row_id")
    j = with_entry(j, streams_index, "joint_states").withColumnRenamed("units", "j_units").withColumnRenamed("entry_units", "j_entry")
    x = poses(robot_state, streams_index, d).drop("state_row_id").join(r, key).join(j, key, "left")
    if gripper_state is not None:
        g = align.first_by_index(gripper_state.select(*key, "gripper_row_id", gripper_value(F.col("gripper_position"), F.col("gripper_width_m")).alias("gripper"), F.lit(True).alias("held")), key, "gripper_row_id")
        x = x.join(g, key, "left")
        grip = F.when(F.col("held"), F.col("gripper")).otherwise(0.0)
    else:
        grip = F.lit(0.0)

    def joints(quantity: str, mine: str, theirs: str) -> tuple[Column, Column, Column]:
        from_joint = F.when(finite_vector(F.col(theirs), 6), to_radians(F.col(theirs), merged_unit(F.col("j_units"), F.col("j_entry"), quantity, d.get(quantity))))
        has = F.coalesce(finite_vector(F.col(theirs), 6), F.lit(False))
        if mine not in own:
            return from_joint, F.when(has, f"joint_states.{theirs[2:]}"), has
        valid = F.coalesce(finite_vector(F.col(mine), 6), F.lit(False))
        robot = to_radians(F.col(mine), merged_unit(F.col("r_units"), F.col("r_entry"), quantity, d.get(quantity)))
        return F.when(valid, robot).otherwise(from_joint), F.when(valid, f"robot_state_rt.{mine}").when(has, f"joint_states.{theirs[2:]}"), valid | has

    wrench, source = first_valid(list(WRENCH_ORDER), 6)
    jp, jp_from, jp_any = joints("joint_position", "actual_joint_position", "j_position")
    jv, jv_from, jv_any = joints("joint_velocity", "actual_joint_velocity", "j_velocity")
    x = x.select(
        *key, "position", "rotation", "error", grip.alias("gripper"), wrench.alias("wrench"), source.alias("wrench_source"), jp.alias("jp"), jv.alias("jv"),
        jp_any.alias("jp_any"), jv_any.alias("jv_any"), F.concat_ws("; ", jp_from, jv_from).alias("joint_source"),
    )
    error = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("gripper").isNull(), "gripper holds no finite value")
        .when(F.col("wrench").isNull(), "no wrench source holds 6 finite numbers")
        .when(~F.col("jp_any"), "joint position is not 6 finite numbers")
        .when(F.col("jp").isNull(), "joint_position unit is missing or unknown")
        .when(~F.col("jv_any"), "joint velocity is not 6 finite numbers")
        .when(F.col("jv").isNull(), "joint_velocity unit is missing or unknown")
    )
    return x.withColumn("error", error).select(
        *key, "position", "rotation", "gripper",
        F.when(F.col("error").isNull(), F.concat("position", "rotation", F.array("gripper"), "wrench", "jp", "jv")).alias("model_state"), "wrench_source", "joint_source", "error",
    )


def index_sets(primary: DataFrame, others: dict[str, DataFrame]) -> DataFrame:
    """(episode_id, stream, n_common, n_missing, n_extra, first_missing, first_extra, aligned):
    the record indexes of every stream of an episode held against the primary ones, all
    streams in one pass; the proof an N-way join needs. A stream without a record in an
    episode has no row."""
    key = ["episode_id", "record_index"]
    own = None
    for name, df in others.items():
        part = df.where(F.col("record_index").isNotNull()).select("episode_id", F.lit(name).alias("stream"), "record_index") if "stream_name" not in df.columns else df.where(F.col("record_index").isNotNull()).select("episode_id", F.col("stream_name").alias("stream"), "record_index")
        own = part if own is None else own.unionByName(part)
    own = own.distinct()
    base = primary.where(F.col("record_index").isNotNull()).select(*key).distinct()
    # an episode has a handful of streams: every primary index once for each of them
    want = base.join(own.select("episode_id", "stream").distinct(), "episode_id").withColumn("in_a", F.lit(1))
    j = want.join(own.withColumn("in_b", F.lit(1)), ["episode_id", "stream", "record_index"], "full_outer")
    group = ["episode_id", "stream"]
    counts = j.groupBy(*group).agg(
        F.count(F.when(F.col("in_a").isNotNull() & F.col("in_b").isNotNull(), 1)).alias("n_common"),
        F.count(F.when(F.col("in_b").isNull(), 1)).alias("n_missing"), F.count(F.when(F.col("in_a").isNull(), 1)).alias("n_extra"),
    )
    missing = align.first_few(j.where("in_b is null"), group, "record_index").withColumnRenamed("first", "first_missing")
    extra = align.first_few(j.where("in_a is null"), group, "record_index").withColumnRenamed("first", "first_extra")
    return counts.join(missing, group, "left").join(extra, group, "left").withColumn("aligned", (F.col("n_missing") == 0) & (F.col("n_extra") == 0))


def processed_frames(robot_state: DataFrame, joint_states: DataFrame, gripper_state: DataFrame | None, cameras: DataFrame, streams_index: DataFrame, views: DataFrame, defaults: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(frames, refused): the processed frames of the episodes that can be converted, and why
    the others cannot.

    ``views``: episode_id, view, stream_name of the selected cameras. An episode is converted if
    all its streams have the robot's indexes, these run from 0 without a hole, every state can be
    built, both views have a camera, and its stamps (or else its monotonic stamps) increase."""
    key = ["episode_id", "record_index"]
    s = states(robot_state, joint_states, gripper_state, streams_index, defaults)
    others = {"joint_states": joint_states.select(*key), "cameras": cameras.select(*key, "stream_name")}
    if gripper_state is not None:
        others["gripper_state"] = gripper_state.select(*key)
    sets = index_sets(robot_state, others)
    reasons = [
        sets.where("not aligned").groupBy("episode_id").agg(F.concat(F.min("stream"), F.lit(": record indexes differ from the robot's")).alias("reason")),
        align.contiguity(robot_state.select(*key).distinct(), "episode_id", "record_index").where("not contiguous").select("episode_id", F.lit("record indexes do not run from 0 without a hole").alias("reason")),
        s.where("error is not null").groupBy("episode_id").agg(F.min_by("error", "record_index").alias("reason")),
        robot_state.select("episode_id").distinct().join(views.where("stream_name is not null").groupBy("episode_id").agg(F.countDistinct("view").alias("n")), "episode_id", "left")
        .where("coalesce(n, 0) < 2").select("episode_id", F.lit("a view has no camera stream").alias("reason")),
    ]
    stamps = align.first_by_index(robot_state.select(*key, "state_row_id", stamp_seconds(F.col("source_stamp")).alias("t"), F.col("monotonic_stamp").alias("m")), key, "state_row_id")
    times = actions.relative_time(stamps, "episode_id", "record_index", "t", "m").select(*key, "rel")
    reasons.append(times.where("rel is null").select("episode_id").distinct().select("episode_id", F.lit("stamps do not increase").alias("reason")))
    refused = None
    for i, r in enumerate(reasons):
        r = r.withColumn("rank", F.lit(i))
        refused = r if refused is None else refused.unionByName(r)
    refused = refused.groupBy("episode_id").agg(F.min_by("reason", "rank").alias("reason"))
    good = s.join(refused.select("episode_id"), "episode_id", "left_anti").join(times, key)
    path = align.first_by_index(cameras.select(*key, "stream_name", "camera_row_id", "image_path"), [*key, "stream_name"], "camera_row_id")
    seen = path.join(views.select("episode_id", "view", "stream_name"), ["episode_id", "stream_name"])
    both = seen.groupBy(*key).agg(*(F.min(F.when(F.col("view") == v, F.col("image_path"))).alias(f"{v}_rgb_path") for v in ("external", "tcp")))
    act = actions.measured_actions(good.select(*key, "position", "rotation", "gripper"), "episode_id", "record_index").select(*key, F.col("action").alias("measured_action"), F.col("terminal").alias("action_is_terminal_padding"))
    frames = good.join(both, key, "left").join(act, key).select(
        "episode_id", F.col("record_index").alias("frame_index"), F.col("rel").alias("timestamp"), "external_rgb_path", "tcp_rgb_path", "model_state", "measured_action", "action_is_terminal_padding"
    )
    return frames, refused


def plain_frames(tcp: DataFrame, joints: DataFrame, wrench: DataFrame) -> DataFrame:
    """Processed frames of plain recordings, whose three tables (key ``path`` of the episode and
    ``row`` in the file) are matched by place: rows are zipped, stamps of the second and third
    ignored. Orientation comes as a quaternion and is turned into a rotation vector. Episodes
    whose tables differ in length are left out (``unequal_rows`` lists them)."""
    key = ["episode_id", "row"]
    q = vec(*(F.col(c) for c in ("qx", "qy", "qz", "qw")))
    t = tcp.withColumn("__q", unit_quaternion(q)).select(*key, "timestamp", vec(F.col("x"), F.col("y"), F.col("z")).alias("position"), rotvec_of(F.col("__q")).alias("rotation"), (F.coalesce(F.col("gripper_pos"), F.lit(0.0)) if "gripper_pos" in tcp.columns else F.lit(0.0)).alias("gripper"))
    j = joints.select(*key, vec(*(F.col(f"joint_pos_{i}") for i in range(6))).alias("jp"), vec(*(F.col(f"joint_vel_{i}") for i in range(6))).alias("jv"))
    w = wrench.select(*key, vec(*(F.col(c) for c in ("fx", "fy", "fz", "tx", "ty", "tz"))).alias("wrench"))
    bad = unequal_rows(tcp, joints, wrench).select("episode_id")
    x = t.join(j, key).join(w, key).join(bad, "episode_id", "left_anti")
    x = x.withColumn("model_state", F.concat("position", "rotation", F.array("gripper"), "wrench", "jp", "jv"))
    act = actions.measured_actions(x.select(*key, "position", "rotation", "gripper"), "episode_id", "row").select(*key, F.col("action").alias("measured_action"), F.col("terminal").alias("action_is_terminal_padding"))
    ok = finite_vector(F.col("model_state"), STATE_DIM)
    return x.join(act, key).select("episode_id", F.col("row").alias("frame_index"), "timestamp", F.when(ok, F.col("model_state")).alias("model_state"), "measured_action", "action_is_terminal_padding")


def unequal_rows(tcp: DataFrame, joints: DataFrame, wrench: DataFrame) -> DataFrame:
    """(episode_id, tcp, joints, wrench): row counts of the episodes where they differ."""
    parts = None
    for name, df in (("tcp", tcp), ("joints", joints), ("wrench", wrench)):
        p = df.select("episode_id", F.lit(name).alias("name"))
        parts = p if parts is None else parts.unionByName(p)
    n = parts.groupBy("episode_id").agg(*(F.count(F.when(F.col("name") == k, 1)).alias(k) for k in ("tcp", "joints", "wrench")))
    return n.where("tcp <> joints or tcp <> wrench")
