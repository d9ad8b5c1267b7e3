"""API payloads: offers of search results and postings of detail results, as VARIANT expressions."""

from __future__ import annotations

import itertools
import json
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimark.functions.text import norm_text

# The endpoint, its tools, and how many offers a search page holds at most.
ENDPOINT, SEARCH, DETAILS, PAGE_SIZE = "https://grus-api.theprotocol.it/mcp", "search_job_offers", "get_job_offer_details", 50
# Alternative names of the same fields in payloads, first usable one wins.
OFFER_LISTS = ("offers", "items", "results", "jobOffers")
OFFER_ID, GROUP_ID = ("offerId", "id"), ("groupId",)
DETAIL_URL, SEARCH_URL = ("offerUrl", "url"), ("url", "offerUrl")
DETAIL_TITLE, SEARCH_TITLE = ("title", "jobTitle"), ("title",)
DETAIL_COMPANY, SEARCH_COMPANY = ("company", "employer", "hiringOrganization"), ("company", "employer", "employerName", "companyName")
COMPANY_NAME = ("name", "employerName", "label")


def pick(value: Column, *names: str) -> Column:
    """The first of the named fields that is neither missing, null, an empty string nor an empty list, as a VARIANT."""
    found = [F.try_variant_get(value, f"$.{n}", "variant") for n in names]
    usable = [F.when(~F.coalesce(F.to_json(f), F.lit("null")).isin("null", '""', "[]"), f) for f in found]
    return F.coalesce(*usable) if len(usable) > 1 else usable[0]


def text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def payload(structured: Column, fallback: Column) -> Column:
    """The structured result if it is an object, else the text if that is one, else an empty object."""
    is_object = lambda v: F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    first, second = F.try_parse_json(structured), F.try_parse_json(fallback)
    return F.when(is_object(first), first).when(is_object(second), second).otherwise(F.parse_json(F.lit("{}")))


def offers(value: Column) -> Column:
    """The objects of the first list of offers, looked for under any depth of 'data' too."""
    first = lambda v: F.coalesce(*[F.try_variant_get(v, f"$.{n}", "array<variant>") for n in OFFER_LISTS])
    inner = lambda v: F.try_variant_get(v, "$.data", "variant")
    onward = lambda v: first(v).isNull() & F.coalesce(F.schema_of_variant(inner(v)).startswith("OBJECT"), F.lit(False))
    # no path goes down more often than the JSON names 'data'
    most = F.array_repeat(F.lit(0), F.coalesce(F.regexp_count(F.to_json(value), F.lit('"data"')), F.lit(0)))
    found = first(F.reduce(most, value, lambda v, _: F.when(onward(v), inner(v)).otherwise(v)))
    return F.filter(F.coalesce(found, F.array().cast("array<variant>")), lambda v: F.schema_of_variant(v).startswith("OBJECT"))


def company(value: Column) -> Column:
    """A name as it stands, or the name inside an object; else null."""
    kind = F.schema_of_variant(value)
    inner = norm_text(text(pick(value, *COMPANY_NAME)))
    return F.when(kind == "STRING", norm_text(text(value))).when(kind.startswith("OBJECT") & (inner != ""), inner)


def postings(rows: DataFrame, search: str = "search", details: str = "details") -> DataFrame:
    """(source_posting_id, group_id, url, title, company, body, error) of pairs of search and detail objects (VARIANT columns).

    Details come first, the search row fills gaps; the id falls back to the group's. Without id or title the row is
    contract drift and carries an error.
    """
    s, d = F.col(search), F.col(details)
    blank = lambda c: F.coalesce(text(c), F.lit(""))
    group = blank(pick(s, *GROUP_ID))
    offer = blank(pick(s, *OFFER_ID))
    id_ = F.when(offer != "", offer).otherwise(group)
    title = norm_text(F.coalesce(text(pick(d, *DETAIL_TITLE)), text(pick(s, *SEARCH_TITLE))))
    url = F.coalesce(text(pick(d, *DETAIL_URL)), text(pick(s, *SEARCH_URL)), F.lit(""))
    name = company(pick(d, *DETAIL_COMPANY))
    name = F.coalesce(F.when(name != "", name), company(pick(s, *SEARCH_COMPANY)))
    error = F.when((id_ == "") | (title == ""), "CONTRACT_DRIFT: id or title missing")
    return rows.withColumns({"source_posting_id": id_, "group_id": group, "url": url, "title": title, "company": name, "body": F.to_json(d), "error": error})


def with_details(search: DataFrame, details: DataFrame, key: str = "group_id") -> DataFrame:
    """Search rows with their details, by key and not by position; rows without a key are left out."""
    return search.where(F.coalesce(F.col(key), F.lit("")) != "").join(details, key)


#: Calls a tool of an API by name with arguments, and gives its result as JSON text.
Call = Callable[[str, dict], str]


def http_call(endpoint: str = ENDPOINT, timeout: float = 30) -> Call:
    """Tool calls as JSON-RPC over HTTP, in a session of the server where it gives one; results of either kind as one object."""
    session: dict[str, str] = {}
    numbers = itertools.count(1)

    def send(method: str, params: dict, answered: bool = True) -> dict:
        body = {"jsonrpc": "2.0", "method": method, "params": params} | ({"id": next(numbers)} if answered else {})
        headers = {"Content-Type": "application/json", "Accept": "application/json, text/event-stream"} | session
        with urllib.request.urlopen(urllib.request.Request(endpoint, json.dumps(body).encode(), headers), timeout=timeout) as answer:
            if answer.headers.get("Mcp-Session-Id"):
                session["Mcp-Session-Id"] = answer.headers["Mcp-Session-Id"]
            text_ = answer.read().decode()
        lines = [x[5:] for x in text_.splitlines() if x.startswith("data:")] or [text_]
        return json.loads(lines[-1]) if lines[-1].strip() else {}

    def call(tool: str, arguments: dict) -> str:
        if not session:
            session["MCP-Protocol-Version"] = "2025-03-26"
            send("initialize", {"protocolVersion": "2025-03-26", "capabilities": {}, "clientInfo": {"name": "sedimark", "version": "1"}})
            send("notifications/initialized", {}, answered=False)
        result = send("tools/call", {"name": tool, "arguments": arguments}).get("result", {})
        texts = [c["text"] for c in result.get("content") or [] if isinstance(c, dict) and c.get("text")]
        return json.dumps({"structured": result.get("structuredContent"), "texts": texts}, ensure_ascii=False)

    return call


def result(answer: Column) -> Column:
    """The object of a call's answer: the structured one, else the first text that is one, else an empty object."""
    texts = F.coalesce(F.from_json(F.get_json_object(answer, "$.texts"), "array<string>"), F.array().cast("array<string>"))
    whole = F.filter(texts, lambda t: F.coalesce(F.schema_of_variant(F.try_parse_json(t)).startswith("OBJECT"), F.lit(False)))
    return payload(F.get_json_object(answer, "$.structured"), F.try_element_at(whole, F.lit(1)))


def search(spark: SparkSession, call: Call, limit: int = PAGE_SIZE) -> DataFrame:
    """(pos, group_id, search): the first ``limit`` offers of the first result page that name a group."""
    answer = spark.createDataFrame([(call(SEARCH, {"pageSize": min(limit, PAGE_SIZE), "pageNumber": 1}),)], "answer string")
    rows = answer.select(F.posexplode(offers(result(F.col("answer")))).alias("pos", "search")).where(F.col("pos") < limit)
    return rows.withColumn("group_id", text(pick(F.col("search"), "groupId", "groupID"))).where(F.coalesce("group_id", F.lit("")) != "").select("pos", "group_id", "search")


def detailed(rows: DataFrame, make_call: Callable[[], Call]) -> DataFrame:
    """``rows`` (group_id and others) with the details of each group, fetched where the rows are; write them before using them twice."""
    kind = "group_id string, answer string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = None
        for batch in batches:
            call = call or make_call()
            ids = batch.column("group_id").to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array([call(DETAILS, {"groupId": i}) for i in ids], pa.string())], ["group_id", "answer"])

    found = rows.select("group_id").distinct().mapInArrow(run, kind)
    return rows.join(found.select("group_id", result(F.col("answer")).alias("details")), "group_id")


def landed(rows: DataFrame, source: str) -> DataFrame:
    """Pairs of search and details as pages for an ingest pass: the body holds both; offers without id or title keep the group's id."""
    parsed = postings(rows)
    body = F.concat(F.lit('{"details":'), F.to_json("details"), F.lit(',"search":'), F.to_json("search"), F.lit("}"))
    id_ = F.when(F.col("source_posting_id") != "", F.col("source_posting_id")).otherwise(F.col("group_id"))
    url = F.when(F.col("url") != "", F.col("url")).otherwise(F.concat(F.lit(f"api://{source}/"), id_))
    return parsed.select(F.lit(source).alias("source_code"), id_.alias("source_posting_id"), url.alias("url"), body.alias("html"), F.lit(200).alias("http_status"), F.lit("application/json; transport=api").alias("content_type"))
