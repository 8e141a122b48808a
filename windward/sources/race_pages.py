"""Saved race pages: links to races, and the event data a page script holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windward.functions import text

# How a race is linked in a saved page, and the script call with its data.
RACE_LINK = r"https://[\w.]+/ViewRecordedRace2018\.aspx\?idgara=[0-9]+&amp;token=[A-Za-z0-9_]+"
SCRIPT_MARKER = "dataLayer.push"
SCRIPT_OBJECT = r"(?s)dataLayer\.push\((\{.*?\})\);"
SCRIPT_KEYS = {"eventName": "event_name", "race": "course", "raceDate": "race_date"}
MISSING = "N/A"


def read_saved_pages(spark: SparkSession, folder: str, pattern: str = "*.html") -> DataFrame:
    """Each saved page as one row (path, html). A file that cannot be read is an error, not a gap."""
    return (
        spark.read.option("wholetext", True)
        .option("pathGlobFilter", pattern)
        .text(folder)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))
    )


def extract_links(pages: DataFrame, html: str = "html", pattern: str = RACE_LINK, group: int = 0) -> DataFrame:
    """Distinct links of all pages, sorted, with '&amp;' undone."""
    found = F.explode(F.regexp_extract_all(html, F.lit(pattern), F.lit(group)))
    return (
        pages.select(found.alias("url"))
        .select(F.replace("url", F.lit("&amp;"), F.lit("&")).alias("url"))
        .distinct().orderBy("url")
    )


def race_requests(links: DataFrame, url: str = "url") -> DataFrame:
    """Race id (the whole query text), number and token of each link.

    ``ok`` is false where number or token is absent: such races count as failed.
    """
    u = F.col(url)
    return links.select(
        url,
        text.query_string(u).alias("race_id"),
        text.query_param(u, "idgara").alias("race_no"),
        text.query_param(u, "token").alias("token"),
    ).withColumn("ok", F.col("race_no").isNotNull() & F.col("token").isNotNull())


def script_object(html: Column) -> Column:
    """The object passed in the first script that holds the marker, or null."""
    scripts = F.regexp_extract_all(html, F.lit(r"(?is)<script\b[^>]*>(.*?)</script>"), F.lit(1))
    first = F.get(F.filter(scripts, lambda s: s.contains(SCRIPT_MARKER)), F.lit(0))
    return text.blank_to_null(F.regexp_extract(first, SCRIPT_OBJECT, 1))


def page_info(pages: DataFrame, html: str = "html") -> DataFrame:
    """Event name, race and date of each page; what is absent or unreadable is 'N/A'."""
    fields = ", ".join(f"{k} string" for k in SCRIPT_KEYS)
    data = F.from_json(F.translate(script_object(F.col(html)), "'", '"'), fields)
    parsed = pages.withColumn("_data", data)
    return parsed.withColumns({
        ours: F.coalesce(F.col(f"_data.{key}"), F.lit(MISSING)) for key, ours in SCRIPT_KEYS.items()
    }).drop("_data")
