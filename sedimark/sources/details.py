"""Posting pages: title, company, structured data and content sections, by a tolerant HTML reader."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimark.functions.urls import SITEMAP_ID

# What marks a company's name, headings that are no company, headings of content sections, the parts of
# structured data that a revision depends on, and the mark of machine-written summaries.
COMPANY_MARKS = (("data-test", "text-offerEmployer"), ("data-testid", "company-name"), ("class", "company-name"))
NO_COMPANY = ("job description", "tech stack", "requirements", "responsibilities", "nice to have", "benefits", "about the company", "o firmie")
SECTIONS = ("job description", "responsibilities", "requirements", "nice to have", "tech stack", "benefits", "about the company", "about us")
STABLE_KEYS = (
    "title", "description", "qualifications", "skills", "responsibilities", "employmentType", "jobLocationType", "applicantLocationRequirements",
    "jobLocation", "baseSalary", "hiringOrganization", "industry", "experienceRequirements", "educationRequirements",
)
MACHINE_WRITTEN = re.compile("wygenerowane przez AI|generated by AI", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


def norm(text: str | None) -> str:
    return " ".join((text or "").split())


def _objects(text: str) -> list[dict]:
    try:
        value = json.loads(text)
    except ValueError:
        return []
    top = [x for x in (value if isinstance(value, list) else [value]) if isinstance(x, dict)]
    inner = [x["@graph"] if isinstance(x.get("@graph"), list) else [] for x in top]
    return [y for x, graph in zip(top, inner) for y in (x, *(g for g in graph if isinstance(g, dict)))]


def _sorted(skills: list[dict[str, str]]) -> list[dict[str, str]]:
    return sorted(skills, key=lambda s: (norm(s["skill"]).casefold(), norm(s["level"]).casefold()))


def _json(value) -> str:  # noqa: ANN001
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def _plain_url(url: str) -> str:
    return re.sub("[?#].*", "", url, flags=re.S)


def _sitemap_id(url: str) -> str | None:
    found = re.search(SITEMAP_ID, url)
    return found and found[1]


def _last_segment(url: str) -> str | None:
    return _plain_url(url).rstrip("/").rpartition("/")[2]


@dataclass(frozen=True)
class Profile:
    """What differs between sources: marks of the company, the posting's id in its URL, errors, what a revision hashes, and extras."""

    marks: tuple[tuple[str, str], ...] = COMPANY_MARKS
    id_of: Callable[[str], str | None] | None = None
    drift: str = "PARSER_DRIFT: h1 missing"
    no_id: str = "PARSER_DRIFT: source id missing"
    #: Whether a revision is recognised by its semantic content; if not, by the whole body.
    semantic: bool = True
    extras: Callable[[Page, str], dict] = lambda page, body: {"skill_expectations": page.skills(), "platform_ai_summary_present": bool(MACHINE_WRITTEN.search(body))}


#: The sources known by name. Any other source is read by the general profile.
GENERAL = Profile()
PROFILES = {
    "theprotocol": Profile(
        id_of=_sitemap_id, drift="PARSER_DRIFT: TheProtocol h1 missing", no_id="TheProtocol source ID missing", semantic=False,
        extras=lambda page, body: {"platform_ai_summary_present": bool(MACHINE_WRITTEN.search(body))},
    ),
    "justjoinit": Profile(marks=COMPANY_MARKS[1:], id_of=_last_segment, drift="PARSER_DRIFT: JJIT h1 missing", extras=lambda page, body: {"skill_expectations": page.skills()}),
}


@dataclass
class Node:
    """An element: its tag, attributes and text pieces, in document order."""

    tag: str
    attributes: dict[str, str]
    pieces: list[str] = field(default_factory=list)

    @property
    def text(self) -> str:
        return norm(" ".join(p.strip() for p in self.pieces))


class Page(HTMLParser):
    """All elements of a page in order of their start tags; each knows the text inside it."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes: list[Node] = []
        self.texts: list[str] = []
        self._open: list[Node] = []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.nodes.append(node)
        if tag not in VOID:
            self._open.append(node)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self._open) - 1, -1, -1):
            if self._open[k].tag == tag:
                del self._open[k:]
                return

    def handle_data(self, data: str) -> None:
        for node in self._open:
            node.pieces.append(data)
        if data.strip() and not (self._open and self._open[-1].tag in ("script", "style")):
            self.texts.append(data.strip())

    def company(self, after: int, marks: tuple[tuple[str, str], ...] = COMPANY_MARKS) -> str | None:
        for name, value in marks:
            for n in self.nodes:
                held = n.attributes.get(name, "")
                if (value in held.split() if name == "class" else held == value) and n.text:
                    return n.text
        for n in self.nodes[after + 1 :]:
            if n.tag in ("h2", "h3") and n.text and n.text.casefold() not in NO_COMPANY and len(n.text) <= 160:
                return n.text
        return None

    def sections(self) -> dict[str, list[str]]:
        """Texts under each known heading up to the next heading; of equal headings the last counts."""
        out: dict[str, list[str]] = {}
        now: list[str] | None = None
        for n in self.nodes:
            if n.tag in ("h2", "h3"):
                name, now = n.text.casefold(), None
                if name in SECTIONS:
                    now = out[name] = []
            elif now is not None and n.tag in ("p", "li", "h4") and n.text and n.text not in now:
                now.append(n.text)
        return out

    def structured(self) -> list[dict]:
        """Every object of the page's structured data: those of each script, and those of their graphs right after them."""
        found: list[dict] = []
        for n in self.nodes:
            if n.tag == "script" and n.attributes.get("type") == "application/ld+json":
                found += _objects("".join(n.pieces))
        return found

    def posting_data(self) -> dict:
        """The first JobPosting of the structured data, its stable parts only."""
        own = next((x for x in self.structured() if x.get("@type") == "JobPosting"), {})
        return {k: own[k] for k in STABLE_KEYS if k in own}

    def skills(self) -> list[dict[str, str]]:
        found = [{"skill": n.attributes["data-skill"], "level": n.attributes["data-level"]} for n in self.nodes if "data-skill" in n.attributes and "data-level" in n.attributes]
        return found


_FIELDS = ("posting_id", "title", "company", "body", "projection", "specific", "machine_written", "error")


def parse_posting(html: str | None, url: str | None = None, source: str | None = None) -> dict:
    """The fields of a posting's page by its source's profile; a page without <h1>, or a URL without an id, is an error.

    projection: the semantic content as JSON, null for sources whose revisions hash the body. specific: JSON of what
    only this source has, which never takes part in a hash.
    """
    page, profile = Page(html or ""), PROFILES.get(source, GENERAL)
    title = next((k for k, n in enumerate(page.nodes) if n.tag == "h1"), None)
    id_ = profile.id_of(url or "") if profile.id_of else None
    error = profile.drift if title is None else profile.no_id if profile.id_of and not id_ else None
    if error:
        return dict.fromkeys(_FIELDS) | {"error": error}
    body = "\n".join(page.texts)
    projection = {"jobposting_json_ld": page.posting_data(), "stable_sections": page.sections(), "skill_expectations": _sorted(page.skills())} if profile.semantic else None
    return {
        "posting_id": id_, "title": page.nodes[title].text, "company": page.company(title, profile.marks), "body": body, "projection": projection and _json(projection),
        "specific": _json(profile.extras(page, body)), "machine_written": bool(MACHINE_WRITTEN.search(body)), "error": None,
    }


def plain_h1(html: Column) -> Column:
    """The first <h1> without attributes by pattern, empty if none: tags go, of character references only ``&amp;`` is decoded. The tolerant reader decodes all, and those that lack their semicolon."""
    found = F.regexp_replace(F.regexp_extract(html, "(?s)<h1>(.*?)</h1>", 1), "<[^>]*>", "")
    return F.trim(F.replace(found, F.lit("&amp;"), F.lit("&")))


#: Bytes of HTML, and rows, that are read at once; a page larger than that is read alone.
PIECE_BYTES, PIECE_ROWS = 1 << 20, 1000


def pieces(batch: pa.RecordBatch, html: str) -> Iterator[pa.RecordBatch]:
    """All rows of a batch in order, few at a time, so that what readers hold doesn't grow with Spark's batches."""
    start = held = 0
    for k, n in enumerate(pc.binary_length(batch.column(html)).to_pylist()):
        if k > start and (held + (n or 0) > PIECE_BYTES or k - start == PIECE_ROWS):
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += n or 0
    if start < batch.num_rows:
        yield batch.slice(start)


PARSED = "posting_id string, title string, company string, body string, projection string, specific string, machine_written boolean, error string"


def parse_postings(pages: DataFrame, key: str, html: str = "html", url: str | None = None, source: str | None = None) -> DataFrame:
    """(key, posting_id, title, company, body, projection, specific, machine_written, error): pages that don't parse are rows with an error."""
    kind = pages.schema[key].dataType.simpleString()
    names = [key, html, *(c for c in (url, source) if c)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for whole in batches for x in pieces(whole, html)):
            nothing = [None] * batch.num_rows
            of = lambda c: batch.column(c).to_pylist() if c else nothing  # noqa: B023, E731
            rows = [parse_posting(*row) for row in zip(of(html), of(url), of(source))]
            columns = [pa.array([r[f] for r in rows], pa.bool_() if f == "machine_written" else pa.string()) for f in _FIELDS]
            yield pa.RecordBatch.from_arrays([batch.column(key), *columns], [key, *_FIELDS])

    return pages.select(*names).mapInArrow(run, f"{key} {kind}, {PARSED}")


def parsed_anchors(pages: DataFrame, base: str = "url", html: str = "html") -> DataFrame:
    """(base, pos, href) of every anchor, by the tolerant reader instead of a pattern."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for whole in batches for x in pieces(whole, html)):
            rows = []
            for u, h in zip(batch.column(base).to_pylist(), batch.column(html).to_pylist()):
                rows += [(u, k, n.attributes["href"]) for k, n in enumerate(x for x in Page(h or "").nodes if x.tag == "a" and "href" in x.attributes)]
            columns = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.string()))], [base, "pos", "href"])

    return pages.select(base, html).mapInArrow(run, f"{base} string, pos int, href string")
