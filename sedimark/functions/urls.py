"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sedimark.functions.text import SPACE

# Portal hosts that are no organisation's own, the id pattern of sitemap entries, the URL pattern.
PORTALS = ("theprotocol.it", "www.theprotocol.it", "justjoin.it", "www.justjoin.it")
SITEMAP_ID = "(?i)(01000000-[0-9a-f-]{20,})"
URL = f"(?i)https?://[^{SPACE}\"'<>]+"


def canonical_url(url: Column) -> Column:
    """Without query and fragment."""
    return F.regexp_replace(url, "[?#].*$", "")


def last_segment(url: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(canonical_url(url), "/+$", ""), "/"), -1)


def sitemap_id(url: Column) -> Column:
    found = F.regexp_extract(url, SITEMAP_ID, 1)
    return F.when(found != "", found)


def host(url: Column) -> Column:
    """Lower-cased host: what follows '//', less user, port and brackets."""
    place = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)
    name = F.regexp_replace(place, "^.*@", "")
    name = F.when(name.startswith("["), F.regexp_extract(name, r"^\[([^\]]*)\]", 1)).otherwise(F.regexp_replace(name, ":.*$", ""))
    return F.lower(name)


def domain(url: Column) -> Column:
    """The host without outer dots and a leading 'www.'; null if empty or a portal's."""
    name = F.regexp_replace(host(url), r"^\.+|\.+$", "")
    return F.when((name != "") & ~name.isin(*PORTALS), F.regexp_replace(name, r"^www\.", ""))


def find_urls(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(URL), 0)
