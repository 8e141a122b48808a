"""Text columns: names, course labels, coordinates, links. All built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that decide sex, age class and excluded runs.
SEX_PATTERN = "Men|Women"
U17_PATTERN = r"U\s*17|Under\s*17|JUNIOR"
U19_PATTERN = r"U\s*19|Under\s*19|YOUTH"
BOARD_PATTERN = "IQfoil"
EXCLUDED_RUN_PATTERN = "abandon|recall"

# What a strip removes: Unicode white space and the four separator controls.
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _EDGE_SPACE, "")


def clean_name(c: Column) -> Column:
    """Trim first, then turn apostrophes into spaces; inner spaces stay as they are."""
    return F.replace(strip(c), F.lit("'"), F.lit(" "))


def first_token(c: Column) -> Column:
    return blank_to_null(F.split(strip(c), r"\s+", 2)[0])


def extract_sex(c: Column, whole_words: bool = False) -> Column:
    """'Men' or 'Women' found in the text, else null. By default also inside words."""
    pattern = rf"\b({SEX_PATTERN})\b" if whole_words else f"({SEX_PATTERN})"
    return F.initcap(blank_to_null(F.regexp_extract(c, "(?i)" + pattern, 1)))


def age_class(c: Column) -> Column:
    """U19 wins over U17 when a text names both."""
    return F.when(c.rlike(f"(?i){U19_PATTERN}"), "U19").when(c.rlike(f"(?i){U17_PATTERN}"), "U17")


def clean_course(c: Column) -> Column:
    tokens = "|".join([U17_PATTERN, U19_PATTERN, SEX_PATTERN, BOARD_PATTERN])
    bare = F.regexp_replace(c, f"(?i)({tokens})", "")
    return strip(F.regexp_replace(bare, r"(?U)\s+", " "))


def wind_text(c: Column) -> Column:
    """Direction text of the race page without its label and degree sign."""
    return strip(F.regexp_replace(c, "Wind|°", ""))


def decimal_comma(c: Column, strict: bool = True) -> Column:
    """'12,5' as 12.5. Strict raises on other text, lenient gives null."""
    point = F.replace(c.cast("string"), F.lit(","), F.lit("."))
    return point.cast("double") if strict else number_or_null(point)


def number_or_null(c: Column) -> Column:
    """A double, or null for text that is no number; NaN counts as missing."""
    return F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))


def coordinate(c: Column, part: int, digits: int = 4) -> Column:
    """Latitude (part 0) or longitude (part 1) of 'lat, lon', rounded, or null."""
    return F.round(number_or_null(F.split_part(c, F.lit(", "), F.lit(part + 1))), digits)


def coordinate_key(c: Column) -> Column:
    """Exact key form of a rounded coordinate."""
    return c.try_cast("decimal(9,4)")


def location_label(lat: Column, lon: Column) -> Column:
    """Display label only; joins use coordinate keys."""
    return F.concat(
        F.lit("Location ("), lat.cast("string"), F.lit(", "), lon.cast("string"), F.lit(")")
    )


def query_string(url: Column) -> Column:
    return blank_to_null(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1))


def query_param(url: Column, name: str) -> Column:
    """First non-blank value of a query parameter, decoded; null when absent."""
    raw = blank_to_null(F.regexp_extract(query_string(url), rf"(?:^|&){name}=([^&]+)", 1))
    return F.coalesce(F.try_url_decode(raw), raw)


def session_prefix(url: Column) -> Column:
    """The '(S(...))' path part of a cookieless session, or an empty text."""
    return F.regexp_extract(url, r"(\(S\(.*?\)\))", 1)


def stats_url(url: Column, race_no: Column, token: Column, host: str, service: str) -> Column:
    """Address of a race's statistics, in the session of the page it came from."""
    return F.concat(
        F.lit(f"https://{host}/"), session_prefix(url),
        F.lit(f"/{service}/getStatistiche?idgara="), race_no, F.lit("&token="), token,
    )
