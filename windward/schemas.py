"""Column contracts: layer schemas, header maps and the required-column check."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Statistics tag -> our column name. Any of them may stand in a racer or in a segment.
STAT_TAGS = {
    "Seriale": "serial_no",
    "Nome": "athlete_name",
    "TotTempPerc": "total_time_s",
    "TotLungLato": "total_length_m",
    "TotDistPerc": "total_dist_m",
    "PosPartenza": "start_position",
    "TotDistRealeSuIdeale": "total_efficiency_pct",
    "TopSpeed": "max_speed_kn",
    "TopVMG": "max_vmg",
    "TopVMC": "max_vmc",
    "AvgVMG": "avg_vmg",
    "AvgVMC": "avg_vmc",
    "AvgSpeed": "avg_speed_kn",
    "SegNum": "segment_no",
    "CrtRaceSegSX": "port_pct",
    "CrtRaceSegDX": "starboard_pct",
    "TimeSecPercorsi": "segment_time_s",
    "SegDistRealePercorsa": "segment_dist_m",
    "LungLato": "segment_length_m",
    "DirLato": "heading_deg",
    "PercEffettivo": "segment_efficiency_pct",
    "StartSeg": "segment_start_clock",
    "EndSeg": "segment_end_clock",
    "SegEnteredRank": "rank_entry",
    "SegExitRank": "rank_exit_scraped",
}

RACE_COLUMNS = ["race_id", "event_name", "event_location", "course", "race_date", "wind_dir_site"]
FIRST_COLUMNS = RACE_COLUMNS + ["athlete_name", "serial_no"]
BRONZE_COLUMNS = FIRST_COLUMNS + [c for c in STAT_TAGS.values() if c not in FIRST_COLUMNS]
BRONZE_SEGMENT = T.StructType([T.StructField(c, T.StringType()) for c in BRONZE_COLUMNS])

# Numeric columns of the typed layer; everything lands as text.
DOUBLE_COLUMNS = [
    "wind_dir_site", "total_time_s", "total_length_m", "total_dist_m", "total_efficiency_pct",
    "max_speed_kn", "max_vmg", "max_vmc", "avg_vmg", "avg_vmc", "avg_speed_kn",
    "port_pct", "starboard_pct", "segment_time_s", "segment_dist_m", "segment_length_m",
    "heading_deg", "segment_efficiency_pct",
]
INT_COLUMNS = ["start_position", "segment_no", "rank_entry", "rank_exit_scraped"]

# Spreadsheet header -> our column name, so that exported tables load as they are.
SHEET_HEADERS = {
    "ID_course": "race_id",
    "Nom de l'événement": "event_name",
    "Lieu de l'événement": "event_location",
    "Course": "course",
    "Date de la course": "race_date",
    "Nom complet": "athlete_name",
    "Numéro de série": "serial_no",
    "Temps total parcouru (s)": "total_time_s",
    "Longueur totale du parcours (m)": "total_length_m",
    "Distance totale réelle parcourue (m)": "total_dist_m",
    "Position de départ": "start_position",
    "Efficacité totale (Distance réelle/idéale) (%)": "total_efficiency_pct",
    "Numéro de segment": "segment_no",
    "Vitesse maximale (noeuds)": "max_speed_kn",
    "VMG maximale": "max_vmg",
    "VMC maximale": "max_vmc",
    "VMG moyenne": "avg_vmg",
    "VMC moyenne": "avg_vmc",
    "Vitesse moyenne (noeuds)": "avg_speed_kn",
    "Bâbord (%)": "port_pct",
    "Tribord (%)": "starboard_pct",
    "Temps du segment (s)": "segment_time_s",
    "Distance réelle parcourue segment (m)": "segment_dist_m",
    "Longueur du segment (m)": "segment_length_m",
    "Cap magnétique (deg)": "heading_deg",
    "Efficacité du segment (%)": "segment_efficiency_pct",
    "Début du segment (timestamp)": "segment_start_clock",
    "Fin du segment (timestamp)": "segment_end_clock",
    "Classement entrée de segment": "rank_entry",
    "Classement sortie de segment": "rank_exit_scraped",
    "Sexe": "sex",
    "Catégorie d'âge": "age_class",
    "Allure": "point_of_sail",
    "Wind to speed ratio": "speed_wind_ratio",
    "Vitesse moyenne du segment (noeuds)": "segment_speed_kn",
    "VMC du segment (noeuds)": "segment_vmc_kn",
    "VMC moyenne du parcours (noeuds)": "course_vmc_kn",
    "Vitesse moyenne du parcours (noeuds)": "course_speed_kn",
    "Classement sur le segment": "rank_segment",
    "Classement fin de segment": "rank_segment_end",
    "Temperature (°C)": "temperature_c",
    "Pressure (hPa)": "pressure_hpa",
    "Humidity (%)": "humidity_pct",
    "Wind Speed (kts)": "wind_speed_kn",
    "Wind Direction (deg)": "wind_dir_weather",
    "Rain (mm)": "rain_mm",
    "Day": "day",
    "Month": "month",
    "Year": "year",
    "Time": "time",
    "City": "city",
    "Latitude": "latitude",
    "Longitude": "longitude",
}

WEATHER_HOURLY = T.StructType([
    T.StructField("day", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("time", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("temperature_c", T.DoubleType()),
    T.StructField("pressure_hpa", T.IntegerType()),
    T.StructField("humidity_pct", T.IntegerType()),
    T.StructField("wind_speed_kn", T.DoubleType()),
    T.StructField("wind_dir_weather", T.DoubleType()),
    T.StructField("rain_mm", T.DoubleType()),
])
WEATHER_KEY = ["day", "month", "year", "time", "city"]

# The processed layer in its order, for sources that name columns by position.
PROCESSED_COLUMNS = [
    "race_id", "event_name", "event_location", "course", "race_date", "wind_dir_site",
    "athlete_name", "serial_no", "total_time_s", "total_length_m", "total_dist_m",
    "total_efficiency_pct", "segment_no", "port_pct", "starboard_pct", "segment_time_s",
    "segment_dist_m", "segment_length_m", "heading_deg", "segment_efficiency_pct",
    "segment_start_clock", "segment_end_clock", "rank_entry", "sex", "age_class",
    "race_year", "race_month", "race_day", "segment_start", "segment_end", "segment_date",
    "segment_mid_clock", "segment_speed_kn", "segment_vmc_kn", "mid_seconds",
    "day", "month", "year", "time", "city", "latitude", "longitude", "temperature_c",
    "pressure_hpa", "humidity_pct", "wind_speed_kn", "wind_dir_weather", "rain_mm",
    "time_seconds", "course_vmc_kn", "course_speed_kn", "course_diff_m", "segment_diff_m",
    "point_of_sail", "speed_wind_ratio", "rank_segment", "rank_segment_end",
]


class MissingColumns(ValueError):
    """A table lacks columns the next step reads."""


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Fail at plan time, before any data is read, if a column is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns {missing}; present: {df.columns}")
    return df
