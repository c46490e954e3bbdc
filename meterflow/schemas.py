"""Record layouts shared by the stream, the hourly store and the points."""

from pyspark.sql import types as T

_WINDOW = T.StructType([
    T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()),
])

#: One meter report as it arrives: ``timestamp`` is in epoch seconds.
READING = T.StructType([
    T.StructField("meterID", T.LongType()),
    T.StructField("cityID", T.LongType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("activeDelta", T.DoubleType()),
])

CITY = T.StructType([
    T.StructField("cityID", T.LongType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("cityName", T.StringType()),
])

HOURLY_MESSAGE = T.StructType([
    T.StructField("meterID", T.LongType()),
    T.StructField("cityID", T.LongType()),
    T.StructField("aggregatedActiveDelta", T.DoubleType()),
    T.StructField("unix_window", _WINDOW),
])

CITY_MESSAGE = T.StructType([
    T.StructField("cityID", T.LongType()),
    T.StructField("cityName", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("unix_window", _WINDOW),
    T.StructField("aggregatedActiveDelta", T.DoubleType()),
])

COUNTRY_MESSAGE = T.StructType([
    T.StructField("unix_window", _WINDOW),
    T.StructField("aggregatedActiveDelta", T.DoubleType()),
])

#: The last three columns are directory columns. Naming their types here keeps
#: partition discovery from narrowing ``cityID`` to int.
HOURLY_STORE = T.StructType([
    T.StructField("meterID", T.LongType()),
    T.StructField("unix_window", _WINDOW),
    T.StructField("aggregatedActiveDelta", T.DoubleType()),
    T.StructField("date", T.TimestampType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("cityID", T.LongType()),
])

POINT = T.StructType([
    T.StructField("measurement", T.StringType()),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("fields", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("time", T.TimestampType()),
])

BAND = T.StructType([
    T.StructField("from_hour", T.IntegerType()),
    T.StructField("to_hour", T.IntegerType()),
    T.StructField("min_delta", T.DoubleType()),
    T.StructField("max_delta", T.DoubleType()),
])

#: Name of the summed column in every aggregate.
TOTAL = "aggregatedActiveDelta"
