"""Planar and quaternion geometry as column expressions. Quaternions are structs x, y, z, w."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

CELL_EPS = 1e-12


def wrap_angle(a: Column) -> Column:
    """Into [-pi, pi)."""
    return F.pmod(a + math.pi, F.lit(2 * math.pi)) - math.pi


def clip_speed(x: Column, y: Column, most: float) -> tuple[Column, Column]:
    """A planar velocity no faster than ``most``, direction kept."""
    speed = F.hypot(x, y)
    scale = F.when(speed > most, F.lit(most) / speed).otherwise(1.0)
    return x * scale, y * scale


def quaternion(x: Column, y: Column, z: Column, w: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"), w.alias("w"))


def from_yaw(yaw: Column) -> Column:
    """Turn about the vertical axis y."""
    return quaternion(F.lit(0.0), F.sin(yaw / 2), F.lit(0.0), F.cos(yaw / 2))


def product(a: Column, b: Column) -> Column:
    ax, ay, az, aw, bx, by, bz, bw = (q[n] for q in (a, b) for n in "xyzw")
    return quaternion(aw * bx + ax * bw + ay * bz - az * by, aw * by - ax * bz + ay * bw + az * bx, aw * bz + ax * by - ay * bx + az * bw, aw * bw - ax * bx - ay * by - az * bz)


def conjugate(q: Column) -> Column:
    return quaternion(-q["x"], -q["y"], -q["z"], q["w"])


def rotate(q: Column, x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """A vector turned by a unit quaternion: v + 2 w (u x v) + 2 u x (u x v)."""
    cross = lambda a, b: (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])
    u, v = (q["x"], q["y"], q["z"]), (x, y, z)
    first = cross(u, v)
    second = cross(u, first)
    return tuple(v[i] + first[i] * q["w"] * 2 + second[i] * 2 for i in range(3))


def angle_between_quaternions(a: Column, b: Column) -> Column:
    d = product(a, conjugate(b))
    return F.atan2(F.sqrt(d["x"] * d["x"] + d["y"] * d["y"] + d["z"] * d["z"]), F.abs(d["w"])) * 2


def yaw_of(q: Column) -> Column:
    """Heading: where the forward axis -z points in the plane."""
    x, _, z = rotate(q, F.lit(0.0), F.lit(0.0), F.lit(-1.0))
    return F.atan2(-x, -z)


def angle_between(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Angle of two planar vectors, exact for small ones too, where a cosine is not; zero if one is none."""
    n = F.hypot(ax, ay) * F.hypot(bx, by)
    return F.when(n > 0, F.abs(F.atan2(ax * by - ay * bx, ax * bx + ay * by))).otherwise(0.0)


def to_frame(px: Column, pz: Column, ox: Column, oz: Column, yaw: Column) -> tuple[Column, Column]:
    """A point in the frame of an origin that looks along ``yaw``."""
    dx, dz = px - ox, pz - oz
    return dx * F.cos(yaw) + dz * F.sin(yaw), dz * F.cos(yaw) - dx * F.sin(yaw)


def polar(x: Column, y: Column) -> tuple[Column, Column]:
    return F.hypot(x, y), F.atan2(y, x)


def grid_cell(x: Column, low: float, size: float) -> Column:
    """Cell number, cut toward zero."""
    return ((x - low) / size).cast("int")


def grid_point(cell: Column, low: float, size: float) -> Column:
    return cell * size + low


def in_triangle(px: Column, py: Column, a: tuple, b: tuple, c: tuple) -> Column:
    """Inside or on the edge of a triangle of plain points.

    An edge's linear form is compared at the point and at its corner, without a difference to the corner, which would
    be rounded: (0.9, 0.1) is on the edge from (1, 0) to (0, 1).
    """
    pairs = [(a, b), (b, c), (c, a)]
    form = lambda x, y, p, q: x * (q[1] - p[1]) - y * (q[0] - p[0])
    s = [(form(px, py, p, q), F.lit(float(form(p[0], p[1], p, q)))) for p, q in pairs]
    neg = reduce(or_, (at < on for at, on in s))
    pos = reduce(or_, (at > on for at, on in s))
    return ~(neg & pos)


def solve2(a: Column, b: Column, c: Column, d: Column, e: Column, f: Column) -> tuple[Column, Column]:
    """x, y of [[a, b], [c, d]] [x, y] = [e, f]; the least-norm solution of a singular system."""
    det = a * d - b * c
    regular = F.abs(det) > CELL_EPS
    # rank one at most: the pseudo-inverse is the transpose over the squared norm
    norm = a * a + b * b + c * c + d * d
    share = F.when(norm > 0, F.lit(1.0) / norm).otherwise(0.0)
    return F.when(regular, (e * d - b * f) / det).otherwise((a * e + c * f) * share), F.when(regular, (a * f - e * c) / det).otherwise((b * e + d * f) * share)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _length(x: Column, z: Column) -> Column:
    return F.sqrt(x * x + z * z)


def nearest_on_path(points: Column, x: Column, z: Column, ahead: Column) -> Column:
    """On a polyline (array of x, z): nearest segment and point, what remains, and the point ``ahead`` along it.

    struct(segment, distance, remaining, x, z). The first of equally near segments counts, by distances that are roots of
    sums of squares; a path of one point is that point, an empty one the position itself.
    """
    kind = "struct<x:double,z:double,left:double,length:double,px:double,pz:double>"
    out = "struct<segment:int,distance:double,remaining:double,x:double,z:double>"

    def project(i: Column, p: Column, q: Column) -> Column:
        def place(d: Column) -> Column:
            n = d["x"] * d["x"] + d["z"] * d["z"]
            along = ((x - p["x"]) * d["x"] + (z - p["z"]) * d["z"]) / F.nullif(n, F.lit(0.0))
            t = F.when(n < 1e-12, 0.0).otherwise(F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0)))
            return bound(t, lambda t: F.struct((p["x"] + t * d["x"]).alias("x"), (p["z"] + t * d["z"]).alias("z")))

        step = F.struct((q["x"] - p["x"]).alias("x"), (q["z"] - p["z"]).alias("z"))
        return bound(bound(step, place), lambda c: F.struct(_length(x - c["x"], z - c["z"]).alias("distance"), i.alias("segment"), c["x"].alias("x"), c["z"].alias("z")))

    def walk(acc: Column, p: Column) -> Column:
        def move(d: Column) -> Column:
            t = F.when(d > 1e-9, F.least(acc["left"] / d, F.lit(1.0))).otherwise(F.when(acc["left"] > 0, 1.0).otherwise(0.0))
            return bound(t, lambda t: F.struct((acc["x"] + (p["x"] - acc["px"]) * t).alias("x"), (acc["z"] + (p["z"] - acc["pz"]) * t).alias("z"), F.greatest(acc["left"] - d, F.lit(0.0)).alias("left"), (acc["length"] + d).alias("length"), p["x"].alias("px"), p["z"].alias("pz")).cast(kind))

        return bound(_length(p["x"] - acc["px"], p["z"] - acc["pz"]), move)

    def along(pts: Column) -> Column:
        n = F.size(pts)
        nearest = F.array_min(F.transform(F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))), lambda i: bound(F.struct(F.get(pts, i).alias("p"), F.get(pts, i + 1).alias("q")), lambda s: project(i, s["p"], s["q"]))))

        def from_there(best: Column) -> Column:
            start = F.struct(best["x"].alias("x"), best["z"].alias("z"), F.greatest(ahead, F.lit(0.0)).alias("left"), F.lit(0.0).alias("length"), best["x"].alias("px"), best["z"].alias("pz")).cast(kind)
            end = F.aggregate(F.slice(pts, best["segment"] + 2, n), start, walk)
            return bound(end, lambda e: F.struct(best["segment"].alias("segment"), best["distance"].alias("distance"), e["length"].alias("remaining"), e["x"].alias("x"), e["z"].alias("z")).cast(out))

        only = F.get(pts, F.lit(0))
        one = F.struct(F.lit(0).alias("segment"), _length(only["x"] - x, only["z"] - z).alias("distance"), _length(only["x"] - x, only["z"] - z).alias("remaining"), only["x"].alias("x"), only["z"].alias("z"))
        none = F.struct(F.lit(0).alias("segment"), F.lit(0.0).alias("distance"), F.lit(0.0).alias("remaining"), x.alias("x"), z.alias("z"))
        return F.when(n >= 2, bound(nearest, from_there)).when(n == 1, one.cast(out)).otherwise(none.cast(out))

    return bound(points, along)


def relative_pose(ref: Column, rx: Column, ry: Column, rz: Column, target: Column, tx: Column, ty: Column, tz: Column) -> tuple[Column, tuple[Column, Column, Column]]:
    """A pose as seen from another: rotation and position in the frame of the unit quaternion ``ref`` at (rx, ry, rz)."""
    back = conjugate(ref)
    return product(back, target), rotate(back, tx - rx, ty - ry, tz - rz)


def triangle_point(a: tuple, b: tuple, c: tuple, u: Column, v: Column) -> tuple[Column, ...]:
    """The point of a triangle that two numbers of [0, 1) pick; pairs that point outside are turned back inside."""
    out = u + v >= 1
    s, t = F.when(out, 1 - u).otherwise(u), F.when(out, 1 - v).otherwise(v)
    return tuple(p + s * (q - p) + t * (r - p) for p, q, r in zip(a, b, c, strict=True))


def metres_per_pixel(low: tuple, high: tuple, pixels: int) -> Column:
    """Size of a map's pixel: the shorter side of the ground (x, z) in ``pixels``."""
    return F.least(*(F.abs(b - a) / pixels for a, b in zip(low, high, strict=True)))


def attraction(d: Column, amplitude: float) -> Column:
    """Weight of a potential field at a distance."""
    return F.exp(-(d * d) / 3.0) * amplitude


def between_vectors(a: tuple[Column, Column, Column], b: tuple[Column, Column, Column], eps: float = 1e-8) -> Column:
    """The shortest turn from one direction to another; null if one of them has no length.

    Opposite directions have no single shortest turn: the axis is then at right angles to the first
    and to the coordinate axis along which it is least.
    """
    length = lambda v: F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2])
    cross = lambda u, v: (u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0])
    la, lb = length(a), length(b)
    u, v = tuple(x / F.nullif(la, F.lit(0.0)) for x in a), tuple(x / F.nullif(lb, F.lit(0.0)) for x in b)
    c = F.greatest(u[0] * v[0] + u[1] * v[1] + u[2] * v[2], F.lit(-1.0))
    straight, s = cross(u, v), F.sqrt((c + 1) * 2)
    turned = quaternion(straight[0] / s, straight[1] / s, straight[2] / s, s / 2)
    ax, ay, az = (F.abs(x) for x in u)
    unit = [F.when((ax <= ay) & (ax <= az), w[0]).when(ay <= az, w[1]).otherwise(w[2]) for w in ((1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 1.0))]
    side = cross(u, unit)
    half, n = F.sqrt((1 - c) / 2), length(side)
    back = quaternion(side[0] / n * half, side[1] / n * half, side[2] / n * half, F.sqrt((c + 1) / 2))
    return F.when(la.isNull() | lb.isNull() | (la == 0) | (lb == 0), F.lit(None)).when(c < -1 + eps, back).otherwise(turned)


def bin_place(value: Column, low: float, high: float, bins: int) -> tuple[Column, Column, Column]:
    """Between which of ``bins`` points from ``low`` to ``high`` a value lies, and how far along; values outside are moved to the ends."""
    at = (F.least(F.greatest(value, F.lit(low)), F.lit(high)) - low) / (high - low) * (bins - 1)
    return F.floor(at).cast("int"), F.ceil(at).cast("int"), at - F.floor(at)


def trilinear(grid: Column, sides: tuple[int, int, int], places: list[tuple[Column, Column, Column]]) -> Column:
    """The value between the eight points around a place of a grid, an array with the last side running fastest."""
    total = F.lit(0.0)
    for corner in range(8):
        index, weight = F.lit(0), F.lit(1.0)
        for axis, (lower, upper, share) in enumerate(places):
            up = corner >> axis & 1
            index = index * sides[axis] + (upper if up else lower)
            weight = weight * (share if up else 1 - share)
        total = total + weight * F.get(grid, index)
    return total


def search_place(ascending: Column, value: Column) -> Column:
    """Where halving an ascending array ends: at an item equal to the value, if it meets one, else at the first larger one, the last place at most.

    Each step halves what is left, so an array of n items takes about log2(n) steps; null for an empty array.
    """
    n = F.size(ascending)
    steps = F.sequence(F.lit(1), F.ceil(F.log2(n + F.lit(1))).cast("int"))
    start = F.struct(F.lit(0).alias("left"), (n - 1).alias("right"), F.lit(-1).alias("met"))

    def halve(at: Column, _: Column) -> Column:
        mid = F.floor((at["left"] + at["right"]) / 2).cast("int")
        item, on = F.get(ascending, mid), (at["met"] < 0) & (at["left"] <= at["right"])
        left = F.when(on & (item < value), mid + 1).otherwise(at["left"])
        right = F.when(on & (item > value), mid - 1).otherwise(at["right"])
        return F.struct(left.alias("left"), right.alias("right"), F.when(on & (item == value), mid).otherwise(at["met"]).alias("met"))

    ended = F.aggregate(steps, start, halve, lambda at: F.when(at["met"] >= 0, at["met"]).otherwise(F.least(at["left"], n - 1)))
    return F.when(n > 0, ended)
