"""Weather classes, hours, temperatures and colour bands."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from obsflow.constants import (
    COLOUR_BANDS, DEFAULT_COLOUR, KELVIN_OFFSET, MERGED_CLASSES, SECONDS_PER_DAY,
    SERVING_HOUR_OFFSET,
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def merge_weather(weather) -> Column:
    """Fold rare classes into Fog and Rain; any other class stays as it is."""
    weather = _col(weather)
    merged = None
    for target, members in MERGED_CLASSES.items():
        hit = weather.isin(*members)
        merged = F.when(hit, target) if merged is None else merged.when(hit, target)
    return merged.otherwise(weather)


def hour_of_epoch(ts, offset: float = SERVING_HOUR_OFFSET, wrap: bool = False) -> Column:
    """Hour of day (double) of epoch seconds, plus ``offset``.

    Unwrapped, offset 2 gives 2..25, which is what live scoring uses; ``wrap`` folds into 0..23.
    """
    seconds = F.pmod(_col(ts), F.lit(float(SECONDS_PER_DAY)))
    hour = F.floor(seconds / 3600.0).cast("double") + F.lit(float(offset))
    return F.pmod(hour, F.lit(24.0)) if wrap else hour


def utc_hour(ts) -> Column:
    """Hour 0..23 of epoch seconds in UTC, whatever the session time zone."""
    return hour_of_epoch(ts, offset=0).cast("int")


def event_time(ts) -> Column:
    return F.timestamp_seconds(_col(ts))


def kelvin_to_celsius(kelvin) -> Column:
    return _col(kelvin) - F.lit(KELVIN_OFFSET)


def temp_band(weather, celsius) -> Column:
    """Colour of a class at a temperature; half-open bands, white for unknown classes."""
    weather, celsius = _col(weather), _col(celsius)
    usable = celsius.isNotNull() & ~F.isnan(celsius)
    colour = None
    for name, bands in COLOUR_BANDS.items():
        inner = None
        for limit, shade in bands:
            if limit is None:
                inner = inner.otherwise(shade)
            elif inner is None:
                inner = F.when(celsius < limit, shade)
            else:
                inner = inner.when(celsius < limit, shade)
        hit = (weather == name) & usable
        colour = F.when(hit, inner) if colour is None else colour.when(hit, inner)
    return colour.otherwise(DEFAULT_COLOUR)


def epoch_day_offset(as_of, days) -> Column:
    """Epoch seconds ``days`` whole days before ``as_of`` (epoch seconds)."""
    return _col(as_of) - _col(days) * F.lit(SECONDS_PER_DAY)
