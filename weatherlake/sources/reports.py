"""Text forms of the results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherlake.functions.numbers import fixed_text, number_text
from weatherlake.functions.text import fill

# Wording of the monthly report.
REPORT_TITLE = "RAPPORT MÉTÉOROLOGIQUE MENSUEL - {month}"
REPORT_RULE = "=" * 50
REPORT_BLOCK = (
    "Ville: {city}\n"
    "  Température moyenne: {avg_temp}°C\n"
    "  Température min/max: {min_temp}°C / {max_temp}°C\n"
    "  Humidité moyenne: {avg_humidity}%\n"
    "  Précipitations totales: {precipitation} mm\n"
    "  Vitesse moyenne du vent: {avg_windspeed} km/h\n"
)
# Wording of the notification.
NOTIFICATION = (
    "Rapport météo du {now} :\n"
    "Température moyenne : {avg_temp}°C\n"
    "Température minimale : {min_temp}°C\n"
    "Température maximale : {max_temp}°C"
)
NO_DATA = "Aucune donnée météo disponible"
NOTIFICATION_TIME = "dd/MM/yyyy HH:mm"


def _number(name: str) -> Column:
    return F.coalesce(number_text(F.col(name)), F.lit("nan"))


def monthly_text(report: DataFrame) -> DataFrame:
    """City and the block of text on it."""
    numbers = ["avg_temp", "min_temp", "max_temp", "avg_humidity", "precipitation", "avg_windspeed"]
    block = fill(REPORT_BLOCK, city=F.col("city"), **{name: _number(name) for name in numbers})
    return report.select("city", block.alias("block"))


def monthly_text_lines(report: DataFrame, month: str) -> DataFrame:
    """The whole report: title first, then the blocks in city order."""
    title = REPORT_TITLE.format(month=month.replace("-", "")) + "\n" + REPORT_RULE + "\n"
    header = report.sparkSession.range(1).select(F.lit(0).alias("part"), F.lit("").alias("city"), F.lit(title).alias("block"))
    blocks = monthly_text(report).select(F.lit(1).alias("part"), "city", "block")
    return header.unionByName(blocks).orderBy("part", "city").select("block")


def notification_text(summary: DataFrame, now: Column) -> DataFrame:
    """The one-row temperature summary as a message, or the notice that there is no data."""
    numbers = {name: fixed_text(F.col(name)) for name in ("avg_temp", "min_temp", "max_temp")}
    text = fill(NOTIFICATION, now=F.date_format(now, NOTIFICATION_TIME), **numbers)
    return summary.select(F.coalesce(text, F.lit(NO_DATA)).alias("message"))
