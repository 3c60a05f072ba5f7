"""Whole runs, composed of the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from gridclime.functions.lineage import SPOT, materialize, together, with_spot
from gridclime.operators.clean import clean, clip_physical
from gridclime.operators.features import add_features
from gridclime.operators.normalize import add_aliases, fill_from_mean, rename_codes
from gridclime.operators.rollup import normals
from gridclime.registry import DAILY_KEY, PLACE


def cleaned(raw: DataFrame, scope: str = "table", order_by: Sequence[str] = ()) -> DataFrame:
    """Raw daily rows, normalized and cleaned.

    Aliases are copies, and all of cleaning but the physical limits treats each
    column on its own whatever its name. So raw columns are cleaned once and
    copied after that, with the limits of every name applied last.
    """
    return _cleaned(raw, scope, order_by).drop(SPOT)


def _cleaned(raw: DataFrame, scope: str, order_by: Sequence[str]) -> DataFrame:
    """The same; with ``scope='place'`` rows of a place lie together by ``SPOT`` before they are copied."""
    named = rename_codes(raw)
    if scope == "place":
        key = (SPOT, *DAILY_KEY)
        values = clean(with_spot(named, PLACE), scope=scope, order_by=order_by, ranges={}, key=key, place=(SPOT,))
        values = together(values, [SPOT]).sortWithinPartitions(SPOT)
    else:
        values = clean(named, scope=scope, order_by=order_by, ranges={})
    return clip_physical(fill_from_mean(add_aliases(values)))


def _featured(raw: DataFrame, scope: str, order_by: Sequence[str]) -> DataFrame:
    place = (SPOT,) if scope == "place" else PLACE
    return add_features(_cleaned(raw, scope, order_by), scope=scope, place=place)


def daily_features(raw: DataFrame, scope: str = "table", order_by: Sequence[str] = ()) -> DataFrame:
    """Raw daily rows, normalized, cleaned and with features."""
    return _featured(raw, scope, order_by).drop(SPOT)


def place_normals(
    raw: DataFrame, scope: str = "table", order_by: Sequence[str] = ()
) -> DataFrame:
    """Raw daily rows to one row of long-term figures per place.

    With ``scope='place'`` no figure of a place depends on any other place, as
    needed when new places are described for assignment.
    """
    place = (SPOT, *PLACE) if scope == "place" else PLACE
    return normals(_featured(raw, scope, order_by), refeature=True, scope=scope, place=place).drop(SPOT)


def stage_daily(raw: DataFrame, scope: str = "table") -> DataFrame:
    """Daily features as a stage table, to share between several rollups."""
    return materialize(daily_features(raw, scope))
