"""Explicit schemas; nothing in the package infers one.

Payload schemas name only the fields that are used, so JSON parsing skips the rest.
"""

from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)


def _struct(**fields):
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


_S, _D, _I, _L = StringType(), DoubleType(), IntegerType(), LongType()

#: Observation as published: ``ts`` is epoch seconds.
OBS_RAW = _struct(
    name=_S, ts=_D, lon=_D, lat=_D, temp=_D, tempfelt=_D, pressure=_D, humidity=_D, weather=_S,
)
#: Observation as archived and scored: ``hour`` in place of ``ts``.
OBS = _struct(
    name=_S, hour=_D, lon=_D, lat=_D, temp=_D, tempfelt=_D, pressure=_D, humidity=_D, weather=_S,
)
FORECAST = _struct(lon=_D, lat=_D, cweather=_S, fweather=_S, ctemp=_D, ftemp=_D)
TRAIN = _struct(
    lon=_D, lat=_D, temp=_D, tempfelt=_D, pressure=_D, humidity=_D, weather=_S, hour=_I,
    weather_forecast=_S, temp_forecast=_D,
)
CATALOGUE = _struct(id=_L, country=_S)

_CONDITIONS = ArrayType(_struct(main=_S))

#: Current observations of several stations, one list element each.
GROUP = _struct(
    list=ArrayType(_struct(
        coord=_struct(lon=_D, lat=_D),
        weather=_CONDITIONS,
        main=_struct(
            temp=_D, feels_like=_D, temp_min=_D, temp_max=_D, pressure=_D, humidity=_D,
        ),
        dt=_D, id=_L, name=_S,
    )),
)
#: One page of hourly history of one station; the station is named by the document's file.
HISTORY = _struct(
    lon=_D, lat=_D,
    hourly=ArrayType(_struct(
        dt=_D, temp=_D, feels_like=_D, pressure=_D, humidity=_D, weather=_CONDITIONS,
    )),
)

OBS_RAW_COLUMNS = tuple(OBS_RAW.fieldNames())
OBS_COLUMNS = tuple(OBS.fieldNames())
FORECAST_COLUMNS = tuple(FORECAST.fieldNames())
TRAIN_COLUMNS = tuple(TRAIN.fieldNames())
