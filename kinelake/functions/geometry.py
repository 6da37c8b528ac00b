"""Column builders over flat position vectors: 17 points, x at even and y at odd places (34 doubles)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIZE = 34
#: Fixed: places in the flat vector (x; y follows) of the 17-point order.
SHOULDERS, HIPS, KNEES, ANKLES = (10, 12), (22, 24), (26, 28), (30, 32)


def flat_positions(points: Column) -> Column:
    """First 17 points' x, y as 34 doubles; zeros where there are fewer than 17 or none."""
    flat = F.flatten(F.transform(F.slice(points, 1, 17), lambda k: F.array(k["x"].cast("double"), k["y"].cast("double"))))
    return F.when(F.coalesce(F.size(points), F.lit(0)) >= 17, flat).otherwise(F.array_repeat(F.lit(0.0), SIZE))


def _centre(p: Column, pair: tuple[int, int], axis: int) -> Column:
    return (p[pair[0] + axis] + p[pair[1] + axis]) / 2


def hip_centre(p: Column, axis: int) -> Column:
    return _centre(p, HIPS, axis)


def shoulder_centre(p: Column, axis: int) -> Column:
    return _centre(p, SHOULDERS, axis)


def spine_vector(p: Column) -> tuple[Column, Column]:
    return tuple(shoulder_centre(p, a) - hip_centre(p, a) for a in (0, 1))


def leg_vector(p: Column) -> tuple[Column, Column]:
    return tuple((p[KNEES[0] + a] - p[ANKLES[0] + a] + (p[KNEES[1] + a] - p[ANKLES[1] + a])) / 2 for a in (0, 1))


def angle_between(v: tuple[Column, Column], w: tuple[Column, Column]) -> Column:
    """Radians; 0 where either has no length."""
    norms = F.sqrt(v[0] * v[0] + v[1] * v[1]) * F.sqrt(w[0] * w[0] + w[1] * w[1])
    cosine = F.try_divide(v[0] * w[0] + v[1] * w[1], norms)
    return F.when(norms > 0, F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))).otherwise(0.0)


def spine_leg_angle(p: Column) -> Column:
    return angle_between(spine_vector(p), leg_vector(p))


def body_orientation(p: Column) -> Column:
    return angle_between(spine_vector(p), (F.lit(0.0), F.lit(-1.0)))


def by_axis(p: Column, of_x, of_y) -> Column:
    """Each value through the function of its axis."""
    return F.transform(p, lambda v, i: F.when(i % 2 == 0, of_x(v)).otherwise(of_y(v)))


def relative_positions(p: Column) -> Column:
    return by_axis(p, lambda v: v - hip_centre(p, 0), lambda v: v - hip_centre(p, 1))


def axis_values(p: Column, axis: int) -> Column:
    return F.filter(p, lambda v, i: i % 2 == axis)


def axis_sum(p: Column, axis: int) -> Column:
    return F.aggregate(axis_values(p, axis), F.lit(0.0), lambda s, v: s + v)


def is_visible(p: Column) -> Column:
    return (axis_sum(p, 0) > 0) | (axis_sum(p, 1) > 0)


def no_person(p: Column) -> Column:
    """All x are 0."""
    return F.forall(axis_values(p, 0), lambda v: v == 0)


def divisor(extent: Column) -> Column:
    return F.when(extent > 0, extent).otherwise(1.0)


def box_norm(p: Column, left: Column, top: Column, width: Column, height: Column, clip: bool) -> Column:
    """Positions within a box, as shares of its sides; ``clip`` keeps them in 0..1."""
    cut = (lambda v: F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))) if clip else (lambda v: v)
    return by_axis(p, lambda v: cut((v - left) / divisor(width)), lambda v: cut((v - top) / divisor(height)))


def screen_norm(p: Column, width: float = 1920.0, height: float = 1080.0) -> Column:
    return by_axis(p, lambda v: v / width, lambda v: v / height)
