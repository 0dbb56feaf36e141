"""Declared schemas of the landed race tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


PARTITION = "year int, round int"

# Column names as delivered by the timing feed.
LAPS = ("Driver string, DriverNumber string, LapNumber int, LapTime_seconds double, Sector1Time_seconds double, "
        "Sector2Time_seconds double, Sector3Time_seconds double, Compound string, TyreLife double, FreshTyre boolean, "
        "IsAccurate boolean, PitInTime_seconds double, PitOutTime_seconds double, Stint int, Team string, "
        "TrackStatus string, Position int")
TELEMETRY = ("Time_seconds double, Speed double, RPM double, Throttle double, Brake double, nGear int, DRS int, "
             "Distance double")
RACE_CONTROL = "Time_seconds double, Category string, Message string, Lap int"
WEATHER = ("Time_seconds double, AirTemp double, TrackTemp double, Rainfall boolean, WindSpeed double, Humidity double, "
           "Pressure double")
RESULTS = ("DriverNumber string, Abbreviation string, FullName string, TeamName string, Position double, "
           "GridPosition double, Points double, Status string, ClassifiedPosition string")
EVENT_INFO = "event_name string, location string, country string"
CALENDAR = ("RoundNumber int, EventName string, Country string, Location string, EventFormat string, "
            "EventDate timestamp, Session5DateUtc timestamp")

TABLES = {"laps": LAPS, "race_control": RACE_CONTROL, "weather": WEATHER, "results": RESULTS, "event_info": EVENT_INFO}
DURATIONS = ["LapTime", "Sector1Time", "Sector2Time", "Sector3Time", "PitInTime", "PitOutTime"]


def table_schema(name: str) -> T.StructType:
    """Schema of a landed table with its partition columns."""
    if name == "telemetry":
        return _schema(f"{TELEMETRY}, {PARTITION}, Driver string")
    if name == "calendar":
        return _schema(f"{CALENDAR}, year int")
    return _schema(f"{TABLES[name]}, {PARTITION}")


def names(text: str) -> list[str]:
    return [f.name for f in _schema(text).fields]
