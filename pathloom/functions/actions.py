"""Velocity commands: between physical units and the range -1 to 1, and within the limits of the axes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

LEAST_SPEED = 1e-6


@dataclass(frozen=True)
class ActionLimits:
    """Full speeds forward, sideways and turning, and whether the base may drive back."""

    forward: float = 1.0
    lateral: float = 1.0
    turn: float = 1.0
    allow_back: bool = True


def _unit(x: Column) -> Column:
    return F.greatest(F.least(x, F.lit(1.0)), F.lit(-1.0))


def _ahead(x: Column, limits: ActionLimits) -> Column:
    return x if limits.allow_back else F.greatest(x, F.lit(0.0))


def physical(forward: Column, lateral: Column, turn: Column, limits: ActionLimits = ActionLimits()) -> tuple[Column, Column, Column]:
    """Normalised commands in m/s and rad/s."""
    return _ahead(_unit(forward) * limits.forward, limits), _unit(lateral) * limits.lateral, _unit(turn) * limits.turn


def normalized(forward: Column, lateral: Column, turn: Column, limits: ActionLimits = ActionLimits()) -> tuple[Column, Column, Column]:
    """Physical speeds as shares of the full ones, cut to -1 to 1."""
    part = lambda x, full: _unit(x / max(full, LEAST_SPEED))
    return _ahead(part(forward, limits.forward), limits), part(lateral, limits.lateral), part(turn, limits.turn)


def within_axes(forward: Column, lateral: Column, limits: ActionLimits = ActionLimits()) -> tuple[Column, Column]:
    """The velocity in its direction, as long as both axes allow."""
    scale = F.greatest(F.lit(1.0), F.abs(forward) / max(limits.forward, LEAST_SPEED), F.abs(lateral) / max(limits.lateral, LEAST_SPEED))
    return forward / scale, lateral / scale
