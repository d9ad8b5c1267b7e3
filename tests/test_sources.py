import http.server
import json
import sys
import threading

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sedimark.operators import orgs, quality, runs
from sedimark.sources import adapters, api, boards, details, files, listings

PAGE = """<html><head><script type="application/ld+json">{"@graph": [{"@type": "Other"}, {"@type": "JobPosting", "title": "T", "datePosted": "2020", "skills": ["a"]}]}</script></head><body>
<h1> Data   Engineer </h1><h2>Benefits</h2><p>x</p><h3>ACME Sp. z o.o.</h3><div data-skill="Zeta" data-level="1"></div><div data-skill="alpha" data-level="2"></div>
<h2>Requirements</h2><ul><li>One</li><li>Two</li><li>One</li></ul><h2>Requirements</h2><p>Last <b>wins</b></p><a href="/job-offer/q?x=1">a</a><a href='/job-offer/q'>b</a></body></html>"""


def test_detail_page(spark):
    got = details.parse_posting(PAGE)
    projection = json.loads(got["projection"])
    assert (got["title"], got["company"], got["error"]) == ("Data Engineer", "ACME Sp. z o.o.", None)
    assert projection["jobposting_json_ld"] == {"title": "T", "skills": ["a"]}
    assert projection["stable_sections"] == {"benefits": ["x"], "requirements": ["Last wins"]}
    assert [s["skill"] for s in projection["skill_expectations"]] == ["alpha", "Zeta"]
    chrome = details.parse_posting(PAGE.replace("</body>", "<footer>new chrome</footer></body>"))
    assert chrome["projection"] == got["projection"] and chrome["body"] != got["body"]
    assert details.parse_posting(PAGE.replace("Last", "Lost"))["projection"] != got["projection"]
    rows = details.parse_postings(spark.createDataFrame([(1, PAGE), (2, "<p>no</p>"), (3, None)], "id int, html string"), "id").orderBy("id").collect()
    assert [bool(r.error) for r in rows] == [False, True, True]


def test_listings(spark):
    pages = spark.createDataFrame([("https://s.example/list/all?p=1", PAGE)], "url string, html string")
    assert [tuple(r)[1:] for r in listings.anchor_refs(pages).collect()] == [("q", "https://s.example/job-offer/q")]
    assert details.parsed_anchors(pages).count() == listings.anchors(pages).count() == 2
    xml = '<urlset xmlns="x"><url><loc> https://p.example/szczegoly/praca/a,oferta,01000000-2f10-afe4-f1b5-08df23ba5ced?s=1 </loc></url><url><loc>https://p.example/other</loc></url></urlset>'
    got = listings.sitemap_refs(spark.createDataFrame([("m", xml)], "page string, body string")).collect()
    assert [(r.source_posting_id, r.url) for r in got] == [("01000000-2f10-afe4-f1b5-08df23ba5ced", "https://p.example/szczegoly/praca/a,oferta,01000000-2f10-afe4-f1b5-08df23ba5ced")]
    urls = {"b": "https://h/x/b", "/r": "https://h/r", "//o/p": "https://o/p", "http://z/": "http://z/", "?q": "https://h/x/y?q", "./d": "https://h/x/d"}
    df = spark.createDataFrame(list(urls.items()), "href string, want string").select(listings.joined_url(F.lit("https://h/x/y?z"), F.col("href")).alias("got"), "want")
    assert all(r.got == r.want for r in df.collect())
    refs = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "a"), (2, 2, "c")], "page int, pos int, source_posting_id string")
    assert [r.source_posting_id for r in listings.discover(refs, ["page", "pos"], 2).orderBy("page", "pos").collect()] == ["a", "b"]


def test_plain_h1_decodes_no_more_than_its_sql(spark, tmp_path):
    from sedimark.plans import catalogue

    pages = ["<h1> a &amp;&amp</h1>", "<h1>key = &quot;1&quot; <b>x</b>\n&amp;amp;</h1>", "<h1 class='x'>y</h1>", "<h1></h1><h1>z</h1>", "<h1>open", "", None]
    spark.createDataFrame([(k, "u", h) for k, h in enumerate(pages)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = [tuple(r) for r in catalogue.pages_h1_text(spark, str(tmp_path)).orderBy("page_id").collect()]
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == sorted(con.sql(catalogue.ORACLE["pages_h1_text"]).fetchall())
    assert [t for _, t in got] == ["a &&amp", "key = &quot;1&quot; x\n&amp;", "", "", "", "", None]


def test_pages_are_read_few_at_a_time(monkeypatch):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([{"k": k, "html": h} for k, h in enumerate(["a" * 50, None, "b" * 60, "c" * 500, "", *["d"] * 30])], pa.schema([("k", pa.int64()), ("html", pa.string())]))
    monkeypatch.setattr(details, "PIECE_BYTES", 100)
    monkeypatch.setattr(details, "PIECE_ROWS", 20)
    got = list(details.pieces(batch, "html"))
    assert [x.num_rows for x in got] == [2, 1, 1, 20, 11] and pa.Table.from_batches(got).to_pylist() == batch.to_pylist()
    assert list(details.pieces(batch.slice(0, 0), "html")) == []


def test_posting_pages_use_all_cores(spark, tmp_path):
    from sedimark.plans import source_queries

    rows = spark.range(2000).selectExpr("id p_partkey", "'n' p_name", "'Brand#1' p_brand", "'T' p_type", "1 p_size")
    rows.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    sizes = source_queries.posting_pages(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 2 * spark.sparkContext.defaultParallelism and max(r["count"] for r in sizes) < 300


def test_pages_of_one_url_keep_their_own_links(spark):
    rows = [(1, "https://s.example/l", '<a href="/job-offer/q?a=1"><a href="/job-offer/q?a=2">'), (2, "https://s.example/l", '<a href="/job-offer/q"><a href="/job-offer/r">'), (3, "https://s.example/l", "")]
    got = listings.anchor_refs(spark.createDataFrame(rows, "page_id long, url string, html string"), key="page_id").collect()
    assert sorted(map(tuple, got)) == [(k, i, f"https://s.example/job-offer/{i}") for k, i in ((1, "q"), (2, "q"), (2, "r"))]


def test_api_payloads(spark):
    search = [
        {"offerId": "o1", "groupId": "g1", "title": " A  b ", "employer": "E"}, {"id": 7, "groupId": "g2", "title": "", "companyName": "N"}, {"groupId": "g3", "title": "t", "company": ""}, {"title": "t"},
    ]
    found = [{"title": "", "jobTitle": "J", "company": {"name": "", "label": " L "}, "url": "u"}, {"title": "T2", "company": []}, {}, {}]
    rows = spark.createDataFrame([(k, json.dumps(s), json.dumps(d)) for k, (s, d) in enumerate(zip(search, found))], "k int, s string, d string")
    got = api.postings(rows.select("k", F.parse_json("s").alias("search"), F.parse_json("d").alias("details"))).orderBy("k").select("source_posting_id", "title", "company", "url", "error").collect()
    assert [tuple(r)[:4] for r in got[:3]] == [("o1", "J", "L", "u"), ("7", "T2", "N", ""), ("g3", "t", None, "")]
    assert [bool(r.error) for r in got] == [False, False, False, True]
    nested = spark.createDataFrame([('{"data": {"data": {"items": [{"a": 1}, 3, {"b": 2}]}}}', "x"), ("[1]", '{"offers": [{"c": 1}]}'), (None, "bad")], "a string, b string")
    sizes = nested.select(F.size(api.offers(api.payload(F.col("a"), F.col("b")))).alias("n")).collect()
    assert [r.n for r in sizes] == [2, 1, 0]


def test_offers_under_any_depth_of_data(spark):
    rows = [('{"data": ' * n + '{"data": [1], "items": [{"a": 1}]}' + "}" * n, n) for n in (0, 3, 4, 5, 40)] + [('{"data": {"data": [{"items": [{}]}]}}', -1), ('{"data": null}', -2)]
    got = spark.createDataFrame(rows, "s string, n int").select("n", F.size(api.offers(F.parse_json("s"))).alias("size")).collect()
    assert {r.n: r["size"] for r in got} == {0: 1, 3: 1, 4: 1, 5: 1, 40: 1, -1: 0, -2: 0}


def test_json_walk_and_url_evidence(spark):
    payload = {"details": {"companyUrl": "https://example.com", "description": "See https://random.example/blog", "list": [1, {"x": None}, []]}, "hiringOrganization": {"u": "https://www.hire.example/a"}}
    leaves = orgs.json_leaves(spark.createDataFrame([(1, json.dumps(payload)), (2, "{bad")], "id int, j string"), "id", "j")
    assert {r.path for r in leaves.collect()} == {"source_projection." + p for p in ("details.companyUrl", "details.description", "details.list[0]", "details.list[1].x", "hiringOrganization.u")}
    got = {(r.evidence_type, r.domain, r.strength) for r in orgs.url_evidence(leaves, "id").collect()}
    assert got == {("EXPLICIT_ORGANIZATION_URL", "example.com", "STRONG"), ("HIRING_ORGANIZATION_URL", "hire.example", "STRONG")}


def test_json_walk_has_no_caps(spark):
    many = spark.range(550_000).select("id", F.lit('{"k": 1}').alias("j"))
    assert orgs.json_leaves(many, "id", "j").count() == 550_000
    deep = spark.createDataFrame([(1, '{"a":[' * 60 + '"x"' + "]}" * 60)], "id int, j string")
    assert [(r.path, r.value) for r in orgs.json_leaves(deep, "id", "j").collect()] == [("source_projection" + ".a[0]" * 60, "x")]


def test_manifest_and_migrations(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text(json.dumps({"sources": {"web": [{"source": "web", "source_posting_id": "1", "url": "u"}]}}))
    assert [r.source_posting_id for r in files.manifest(spark, str(path)).collect()] == ["1"]
    assert files.manifest(spark, None).count() == 0
    (tmp_path / "2.sql").write_text("b")
    (tmp_path / "1.sql").write_text("a")
    found = files.migrations(str(tmp_path))
    assert files.pending_migrations(found, dict(found[:1])) == ["2.sql"]
    with pytest.raises(ValueError):
        files.pending_migrations(found, {"1.sql": "other"})


class _Pages(adapters.SourceAdapter):
    code = "pages"

    def listing_urls(self):
        yield from ("1", "2", "3", "4")

    def fetch(self, url):
        return {"1": "a b", "2": "b c", "3": "c", "4": "d"}[url]

    def parse_listing(self, body, base_url):
        return [(x, f"u/{x}") for x in body.split()]


def test_adapter_source(spark):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    assert [i for i, _ in _Pages().discover(10)] == ["a", "b", "c"] and len(_Pages().discover(2)) == 2
    adapters.register(spark, _Pages())
    assert sorted(r.source_posting_id for r in spark.read.format("listing_pages").option("limit", 2).load().collect()) == ["a", "b"]


def test_attempts_are_rows():
    left, waits = [503, 429, None], []

    def flaky():
        if status := left.pop(0):
            raise runs.StatusError("busy", status)
        return "body"

    got = list(runs.attempts(flaky, runs.Backoff(3, 0.25), waits.append))
    assert [(a.attempt_no, a.outcome, a.failure_type) for a in got] == [(1, runs.AGAIN, "HTTP_503"), (2, runs.AGAIN, "HTTP_429"), (3, runs.SUCCESS, None)]
    assert got[-1].value == "body" and waits == [0.25, 0.5]

    def failing(error):
        def call():
            raise error

        return [(a.outcome, a.failure_type) for a in runs.attempts(call, runs.Backoff(2), waits.append)]

    assert failing(runs.StatusError("gone", 404)) == [(runs.FINAL, "HTTP_404")]
    assert failing(ValueError("drift")) == [(runs.FINAL, "ValueError")]
    assert failing(TimeoutError()) == [(runs.AGAIN, "TimeoutError"), (runs.FINAL, "TimeoutError")]


def test_items(spark):
    item = "run_id string, source_code string, source_posting_id string, status string, t int"
    events = spark.createDataFrame([("r", "s", "1", "PROCESSING", 1), ("r", "s", "1", "SUCCEEDED", 2), ("r", "s", "2", "FAILED", 3), ("r", "s", "3", "PROCESSING", 1)], item)
    assert {(r.source_posting_id, r.status) for r in runs.item_status(events, "t").collect()} == {("1", "SUCCEEDED"), ("3", "PROCESSING")}
    wanted = events.select(*runs.ITEM).distinct()
    assert {r.source_posting_id for r in runs.claimable(wanted, events).collect()} == {"2", "3"}
    assert runs.replay(wanted, events).where("action = 'REPLAY_SKIPPED'").count() == 1


def test_gate_verdict(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "id int, s string")
    result = quality.Gate().unique(rows, "id", "id").enum(rows, "s", ["a"]).no_nulls(rows, "s set", "s").count(rows, "rows", ">=", 3).covers("covers", rows, rows.limit(1)).result()
    got = {r.check_name: (r.actual, r.ok) for r in result.collect()}
    assert got == {"id": (1, False), "s in its values": (1, False), "s set": (1, False), "rows": (3, True), "covers": (2, True)}
    assert quality.verdict(result).first()["pass"] is False and len(quality.verdict(result).first().failures) == 3


class _Server(http.server.BaseHTTPRequestHandler):
    seen: list = []

    def log_message(self, *args):
        pass

    def _answer(self, status, body, kind, **headers):
        self.send_response(status)
        for name, value in {"Content-Type": kind, **headers}.items():
            self.send_header(name.replace("_", "-"), value)
        self.end_headers()
        self.wfile.write(body.encode())

    def do_GET(self):
        self._answer(503 if self.path == "/busy" else 200, "<h1>é</h1>", "text/html; charset=utf-8")

    def do_POST(self):
        asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        self.seen.append((asked["method"], self.headers.get("Mcp-Session-Id")))
        if asked["method"] == "initialize":
            self._answer(200, json.dumps({"id": asked["id"], "result": {}}), "application/json", Mcp_Session_Id="s1")
        elif "id" not in asked:
            self._answer(202, "", "application/json")
        else:
            result = {"content": [{"type": "text", "text": json.dumps(asked["params"])}]}
            self._answer(200, f"event: message\ndata: {json.dumps({'id': asked['id'], 'result': result})}\n\n", "text/event-stream")


def test_pages_and_tool_calls_over_http():
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), _Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    try:
        page = boards.fetch_url(f"{base}/x")
        assert (page.body, page.url, page.status) == ("<h1>é</h1>", f"{base}/x", 200)
        assert [a.failure_type for a in runs.attempts(lambda: boards.fetch_url(f"{base}/busy"), runs.Backoff(2), lambda s: None)] == ["HTTP_503", "HTTP_503"]
        assert [a.outcome for a in runs.attempts(lambda: boards.fetch_url("http://127.0.0.1:9/"), runs.Backoff(2), lambda s: None)] == [runs.AGAIN, runs.FINAL]
        call = api.http_call(f"{base}/mcp")
        for _ in range(2):
            got = json.loads(call("tool", {"a": 1}))
            assert got["structured"] is None and json.loads(got["texts"][0]) == {"name": "tool", "arguments": {"a": 1}}
        assert _Server.seen == [("initialize", None), ("notifications/initialized", "s1"), ("tools/call", "s1"), ("tools/call", "s1")]
    finally:
        server.shutdown()


def test_known_boards_list_their_postings():
    sitemap, listing = boards.SitemapAdapter(), boards.ListingAdapter()
    xml = '<urlset xmlns="x"><url><loc> https://p.example/szczegoly/praca/a,01000000-2f10-afe4-f1b5-08df23ba5ced?s=1 </loc></url><url><loc>https://p.example/other</loc></url></urlset>'
    assert sitemap.parse_listing(xml, "") == [("01000000-2f10-afe4-f1b5-08df23ba5ced", "https://p.example/szczegoly/praca/a,01000000-2f10-afe4-f1b5-08df23ba5ced")]
    html = '<a href="/job-offer/a?x=1">1</a><a href="/other">2</a><a href="/job-offer/b/#y">3</a><a href="https://o.example/job-offer/a">4</a>'
    assert listing.parse_listing(html, "https://s.example/") == [("a", "https://o.example/job-offer/a"), ("b", "https://s.example/job-offer/b/")]
    assert len(list(listing.listing_urls())) == 30 and {"theprotocol", "justjoinit"} <= set(adapters.ADAPTERS)
