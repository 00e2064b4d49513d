"""Scheduled flights joined with the latest tracking state.

``latest`` always has one row per flight. Which join Spark runs is left to its
size check: a small ``latest`` is broadcast and the history is not shuffled at
all, a large one gets a sort-merge join. The check needs the real size, so
callers settle ``latest`` in storage first. In the sort-merge case only the flights
that may have a state are shuffled, as far as the history is much larger than
``latest`` (see ``sieve``). A flight id that dominates the history is split by adaptive
execution there; ``heavy`` does the same by salting for sessions without it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators import buckets, sieve
from skyledger.operators.skew import (
    HeavyKeys,
    aqe_splits_skew,
    broadcast_by_size,
    heavy_keys,
    replicate,
    scatter,
    size_of,
)
from skyledger.schemas import TRACKING_KEY
from skyledger.sources.tables import settle

FLIGHT = "id_vuelo"
_SALT, _SALT_R = "_salt", "_salt_r"


def skew_plan(history: DataFrame, latest: DataFrame) -> HeavyKeys | None:
    """Heavy flight ids when the history will be shuffled and nothing else would
    split them, else None. The history is scanned for them in that case only."""
    if aqe_splits_skew(history.sparkSession) or broadcast_by_size(latest):
        return None
    return heavy_keys(history, FLIGHT)


def _join(history: DataFrame, latest: DataFrame, how: str, heavy: HeavyKeys | None) -> DataFrame:
    if not heavy:
        return history.join(latest, history[FLIGHT] == latest[TRACKING_KEY], how)
    left = scatter(history, FLIGHT, heavy, _SALT)
    # Salt is for a shuffled join; copies of the states are not to be broadcast.
    right = replicate(latest, TRACKING_KEY, heavy, _SALT_R).hint("merge")
    same = (left[FLIGHT] == right[TRACKING_KEY]) & (left[_SALT] == right[_SALT_R])
    return left.join(right, same, how).drop(_SALT, _SALT_R)


def sifted(
    flights: DataFrame, keys: DataFrame, key: str = TRACKING_KEY
) -> tuple[DataFrame, DataFrame | None]:
    """The flights that may be among the keys, and those that are not where it pays to
    tell them apart: where the keys are not broadcast, but are few beside the flights."""
    if broadcast_by_size(keys) or not sieve.pays(flights.sparkSession, size_of(flights), size_of(keys)):
        return flights, None
    return sieve.sift(flights, FLIGHT, keys, key)


def flights_with_state(
    history: DataFrame, latest: DataFrame, heavy: HeavyKeys | None = None
) -> DataFrame:
    """Every historical flight, with its latest state where there is one."""
    asked, rest = sifted(buckets.without(history), latest)
    joined = _join(asked, latest, "left", heavy).drop(TRACKING_KEY)
    return joined if rest is None else joined.unionByName(rest, allowMissingColumns=True)


def flights_without(flights: DataFrame, keys: DataFrame, key: str = TRACKING_KEY) -> DataFrame:
    """The flights that are not among the keys."""
    asked, rest = sifted(flights, keys, key)
    gone = keys.select(F.col(key).alias("_id"))
    left = asked.join(gone, F.col(FLIGHT) == F.col("_id"), "left_anti")
    return left if rest is None else left.unionByName(rest)


def touched_flights(
    history: DataFrame, latest: DataFrame, heavy: HeavyKeys | None = None
) -> DataFrame:
    """The historical flights that have a state, with it. Of a history that is stored in
    parts by flight, only the parts that hold them are read."""
    history = buckets.without(buckets.holding(history, latest, TRACKING_KEY))
    return _join(sifted(history, latest)[0], latest, "inner", heavy)


def active_with_history(
    history: DataFrame,
    latest: DataFrame,
    heavy: HeavyKeys | None = None,
    staging: str | None = None,
) -> DataFrame:
    """Every tracked flight, with each of its historical rows where there are any;
    a flight without history keeps its id.

    Written as an inner join plus the tracked flights without history. A left
    join from ``latest`` would have to shuffle the whole history (its right
    side) and could not split a heavy flight there; the inner join can
    broadcast ``latest`` and can split either side.

    Of a history that is stored in parts by flight, only the parts that hold tracked
    flights are read. With ``staging`` the matched rows are settled there and say which flights
    have history, so the history is scanned once. Without it, a second scan
    reads the id column only, reduced to distinct ids in each task; a ``latest``
    small enough to broadcast is moved below that by the optimizer.
    """
    matched = touched_flights(history, latest, heavy)
    if staging:
        matched = settle(matched, staging)
        known = matched.select(FLIGHT).distinct()
    else:
        ids = latest.select(F.col(TRACKING_KEY).alias("_id"))
        known = (
            history.select(FLIGHT)
            .distinct()
            .join(ids, F.col(FLIGHT) == F.col("_id"), "left_semi")
        )
    unmatched = latest.join(known, F.col(TRACKING_KEY) == F.col(FLIGHT), "left_anti")
    return matched.drop(TRACKING_KEY).unionByName(
        unmatched.withColumnRenamed(TRACKING_KEY, FLIGHT), allowMissingColumns=True
    )
