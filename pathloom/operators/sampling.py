"""Rejection sampling of episodes: a table function that draws candidates for each scene until enough are taken."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

DRAWN = "scene string, number long, target long, attempts long, drawn long, start_x double, start_z double, goal_x double, goal_z double, distance double"


def draws(*parts: object) -> list[float]:
    """Four numbers in [0, 1) from the hash of ``parts``, the same in any process and engine."""
    h = hashlib.md5("/".join(map(str, parts)).encode()).hexdigest()
    return [int(h[8 * i : 8 * i + 8], 16) / (1 << 32) for i in range(4)]


def fits(dy: float, walked: float, straight: float, radius: float, u: float, near: float, far: float) -> bool:
    """Start and goal on one floor, a walk within bounds, not almost straight (by chance), and a large enough island: ``datasets.compatible`` for one candidate."""
    if abs(dy) > 0.5 or not math.isfinite(walked) or not near <= walked <= far or radius < 1.5:
        return False
    ratio = walked / straight
    return not (ratio < 1.1 and u > 20 * (ratio - 0.98) * (ratio - 0.98))


def sampled_episodes(scenes: DataFrame, n: int, seed: str, near: float = 1.0, far: float = 30.0, retries: int = 10, most_targets: int = 1000) -> DataFrame:
    """``n`` episodes for each row of ``scenes(scene, side, floors)``, numbered in the order they are taken.

    A goal is drawn in the scene's square, on one of its floors and on an island; if the island is too small the next goal
    is drawn, else up to ``retries`` starts, until one fits. A scene gives fewer than ``n`` if ``most_targets`` goals are not
    enough. ``attempts`` are the starts drawn for the goal, ``drawn`` those of the scene so far. A walk is as long as
    its two legs along the axes; other scenes' walks need a function of their own here.

    Scenes are the partitions of the function's table argument, so they are spread over the cluster; each draws on its own.
    """

    class Sampler:
        def eval(self, row: Row) -> Iterator[tuple]:
            scene, side, floors = row["scene"], float(row["side"]), int(row["floors"])
            taken = drawn = 0
            for target in range(most_targets):
                if taken == n:
                    return
                gx, gz, floor, island = draws(seed, scene, target, "goal")
                gx, gz, gy = gx * side, gz * side, math.floor(floor * floors) * 3.0
                if island * 10 < 1.5:
                    continue
                for attempt in range(1, retries + 1):
                    drawn += 1
                    sx, sz, floor, u = draws(seed, scene, target, attempt)
                    sx, sz, sy = sx * side, sz * side, math.floor(floor * floors) * 3.0
                    walked = abs(sx - gx) + abs(sz - gz)
                    straight = math.sqrt((sx - gx) * (sx - gx) + (sz - gz) * (sz - gz))
                    if fits(sy - gy, walked, straight, island * 10, u, near, far):
                        yield scene, taken, target, attempt, drawn, sx, sz, gx, gz, walked
                        taken += 1
                        break

    return F.udtf(Sampler, returnType=DRAWN)(scenes.select("scene", "side", "floors").asTable().partitionBy("scene"))
