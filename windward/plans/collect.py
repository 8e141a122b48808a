"""From landed pages and documents to bronze races, with a log of what happened to each race."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windward.functions import text
from windward.operators.lookup import lookup_join
from windward.operators.profile import attach_location
from windward.schemas import RACE_COLUMNS
from windward.session import stage
from windward.sources import race_pages, race_xml
from windward.sources.tables import typed_segments


def _links(requests: DataFrame) -> DataFrame:
    """(race_id, link, ok), one row per link; requests with neither id nor link all stay."""
    rows = requests.select("race_id", (F.col("url") if "url" in requests.columns else F.lit(None).cast("string")).alias("link"), "ok")
    named = rows.where("race_id is not null or link is not null").groupBy("race_id", "link").agg(F.bool_or("ok").alias("ok"))
    return named.unionByName(rows.where("race_id is null and link is null"))


def assemble_races(
    requests: DataFrame, pages: DataFrame, documents: DataFrame, known: DataFrame | None = None,
    places: DataFrame | None = None,
) -> DataFrame:
    """Every requested link with its race's page data, its racers and its status.

    ``requests``: race_id, ok (number and token are there), url if there is one; ``pages``: race_id, html,
    wind; ``documents``: race_id, xml, landed if there is one; ``known``: race_id of races the table holds;
    ``places``: event_name, lat, lon. A link requested twice counts once; a race with several links is taken by
    the first that is ok. Of several documents of a race the one landed last counts (then the
    greater text), of several pages the greater. Statuses: 'known', 'no token', 'no page', 'no document', 'no event',
    the reasons of ``race_xml.rejected_races``, 'repeated' (another link has the race) and 'new'. Only documents
    that may become new are read, once each. The result is written first: log and segments both read it.
    """
    asked = _links(requests)
    first = asked.where("ok and race_id is not null").groupBy("race_id").agg(F.min("link").alias("_first"), F.lit(True).alias("_any"))
    page = race_pages.page_info(pages.where("race_id is not null").groupBy("race_id").agg(F.max(F.struct("html", "wind")).alias("p")).select("race_id", "p.*"))
    landed = F.col("landed") if "landed" in documents.columns else F.lit(None)
    document = documents.where("race_id is not null").groupBy("race_id").agg(F.max_by("xml", F.struct(landed, F.col("xml"))).alias("xml"))
    page = page.select("race_id", "event_name", "course", "race_date", text.wind_text(F.col("wind")).alias("wind_dir_site"))
    out = lookup_join(asked, page.withColumn("_page", F.lit(True)), ["race_id"])
    out = lookup_join(out, first, ["race_id"])
    seen = asked.select("race_id").limit(0) if known is None else known.select("race_id").where("race_id is not null").distinct()
    out = lookup_join(out, seen.withColumn("_known", F.lit(True)), ["race_id"])
    if places is not None:
        out = attach_location(out, places)
        located = F.concat_ws(", ", F.col("lat").cast("string"), F.col("lon").cast("string"))
        out = out.withColumn("event_location", F.when(F.col("lat").isNotNull(), located))
    else:
        out = out.withColumn("event_location", F.lit(None).cast("string"))
    out = lookup_join(out, document, ["race_id"])
    status = (
        F.when(F.col("_known"), "known")
        .when(~F.coalesce("ok", F.lit(False)), "no token")
        .when(F.col("_page").isNull(), "no page")
        .when(F.col("xml").isNull(), "no document")
        .when(F.col("event_name") == race_pages.MISSING, "no event")
        .when(F.col("_any") & ~F.col("link").eqNullSafe(F.col("_first")), "repeated")
    )
    out = out.withColumn("status", status)
    out = out.withColumn("xml", F.when(F.col("status").isNull(), F.col("xml")))
    scanned = race_xml.scan_documents(out, keep=[*RACE_COLUMNS, "link", "status"])
    return stage(scanned.withColumn("status", F.coalesce("status", "reason", F.lit("new"))).drop("reason"), "races")


def ingest_log(races: DataFrame) -> DataFrame:
    """One row per requested link: its race, its status and whether it counts as success. Known and repeated ones do.

    A repeated link shares its race's fate, whose first link has a row of its own.
    """
    return races.select("race_id", "link", "status", F.col("status").isin("known", "new", "repeated").alias("ok"))


def bronze_segments(races: DataFrame, zone: str = "UTC") -> DataFrame:
    """The segments of the new races, typed and written once."""
    fresh = races.where("status = 'new'").withColumn("reason", F.lit(None).cast("string"))
    return stage(typed_segments(race_xml.segment_rows(fresh, zone)), "bronze")
