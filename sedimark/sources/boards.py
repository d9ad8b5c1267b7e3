"""The sources known by name: where they list postings, and how their pages are fetched."""

from __future__ import annotations

import urllib.error
import urllib.request
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin
from xml.etree import ElementTree

from sedimark.operators.runs import StatusError
from sedimark.sources.adapters import ADAPTERS, Fetched, SourceAdapter
from sedimark.sources.details import PROFILES, _plain_url
from sedimark.sources.listings import ANCHOR_DETAIL, LAST_PAGE, SITEMAP_DETAIL

# The public pages that list the sources' postings.
SITEMAP = "https://static.theprotocol.it/sitemaps/CurrentOffers/SiteMapJobOffers1.xml"
LISTING = "https://justjoin.it/job-offers/all-locations"
HEADERS = {"User-Agent": "sedimark", "Accept-Language": "pl,en;q=0.8"}


def fetch_url(url: str, timeout: float = 30) -> Fetched:
    """A page over HTTP; an answer that is no success is a StatusError."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=HEADERS), timeout=timeout) as answer:
            charset = answer.headers.get_content_charset() or "utf-8"
            return Fetched(answer.read().decode(charset, "replace"), answer.geturl(), answer.status, answer.headers.get("Content-Type"))
    except urllib.error.HTTPError as error:
        raise StatusError(str(error), error.code) from error
    except urllib.error.URLError as error:
        raise ConnectionError(str(error.reason)) from error


class WebAdapter(SourceAdapter):
    """A source whose pages are fetched over HTTP; ids come from the URLs, by the source's profile."""

    def fetch(self, url: str) -> Fetched:
        return fetch_url(url)

    def links(self, body: str, base_url: str) -> Iterator[str]:
        raise NotImplementedError

    def parse_listing(self, body: str, base_url: str) -> list[tuple[str, str]]:
        """(source_posting_id, url): of one id the last URL, in the place of the first."""
        refs: dict[str, str] = {}
        for url in map(_plain_url, self.links(body, base_url)):
            if id_ := PROFILES[self.code].id_of(url):
                refs[id_] = url
        return list(refs.items())


class SitemapAdapter(WebAdapter):
    code = "theprotocol"

    def listing_urls(self) -> Iterator[str]:
        yield SITEMAP

    def links(self, body: str, base_url: str) -> Iterator[str]:
        for node in ElementTree.fromstring(body).iter():
            if node.tag.rpartition("}")[2] == "loc" and node.text and SITEMAP_DETAIL in node.text:
                yield node.text.strip()


class _Anchors(HTMLParser):
    def __init__(self, body: str):
        super().__init__()
        self.found: list[str] = []
        self.feed(body)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "a":
            self.found += [v for k, v in attrs if k == "href" and v]


class ListingAdapter(WebAdapter):
    code = "justjoinit"

    def listing_urls(self) -> Iterator[str]:
        for page in range(1, LAST_PAGE + 1):
            yield LISTING if page == 1 else f"{LISTING}?page={page}"

    def links(self, body: str, base_url: str) -> Iterator[str]:
        return (urljoin(base_url, href) for href in _Anchors(body).found if ANCHOR_DETAIL in href)


for _adapter in (SitemapAdapter(), ListingAdapter()):
    ADAPTERS.setdefault(_adapter.code, _adapter)
