import json
import sys

import pytest
from pyspark import cloudpickle

from sedimark import batch, cli, schemas
from sedimark.operators import runs, store
from sedimark.sources import adapters, api


def test_commands(spark, tmp_path, capsys):
    (tmp_path / "jobs").mkdir()
    (tmp_path / "jobs" / "a.json").write_text(json.dumps({"id": "1", "role": "R", "company": "C", "technologies": [{"name": "T"}], "processes": [], "keywords": ["k"], "graph_edges": []}))
    assert cli.main(["build-graph", "--jobs", str(tmp_path / "jobs"), "--out", str(tmp_path / "graph")]) == 0
    assert "- T: 1" in capsys.readouterr().out
    assert spark.read.json(str(tmp_path / "graph/nodes")).count() == 2
    spark.createDataFrame([("s", "1", 1, "a"), ("s", "1", 2, "a")], "source_code string, source_posting_id string, seq int, hash string").write.parquet(str(tmp_path / "obs"))
    assert cli.main(["ledger", "--observations", str(tmp_path / "obs"), "--out", str(tmp_path / "led"), "--run-id", "r"]) == 0
    assert json.loads(capsys.readouterr().out) == {"OBSERVED": 1, "UNCHANGED": 1}
    t = tmp_path / "tables"
    spark.createDataFrame([("s",)], "source_code string").write.parquet(str(t / "job_posting"))
    spark.createDataFrame([("UNCHANGED",)], "state string").write.parquet(str(t / "posting_lifecycle_observation"))
    spark.createDataFrame([(1,)], "id int").write.parquet(str(t / "job_posting_revision"))
    args = ["verify", "--gate", "crawl", "--tables", str(t), "--sources", "s", "--expected"]
    assert cli.main([*args, "1"]) == 0 and cli.main([*args, "2"]) == 1
    assert cli.main(["query", "--name", "offer_count", "--tables", "/root/testdata/sf0.001", "--out", str(tmp_path / "q")]) == 0
    spark.createDataFrame([(1, 9, '{"website": "https://a.example"}')], "id int, organization_id int, payload string").write.parquet(str(tmp_path / "pay"))
    assert cli.main(["enrich", "--payloads", str(tmp_path / "pay"), "--out", str(tmp_path / "ev")]) == 0
    assert spark.read.parquet(str(tmp_path / "ev/domains")).first().domain == "a.example"
    rows = [(1, "a", "x y", "o", 1, ["d"]), (2, "b", "x y", "o", 1, ["d"])]
    spark.createDataFrame(rows, "id int, source string, title string, org_mention string, organization_id int, domains array<string>").write.parquet(str(tmp_path / "post"))
    assert cli.main(["er-eval", "--postings", str(tmp_path / "post"), "--out", str(tmp_path / "corpus")]) == 0


def test_enrich_reads_both_projections(spark, tmp_path):
    rows = [(1, 9, '{"website": "https://a.example"}', '{"website": "https://a.example", "companyUrl": "https://b.example/x"}'), (2, 8, None, '{"homepage": "https://c.example"}')]
    for name in ("payload", "source_projection_json"):
        spark.createDataFrame(rows, f"id int, organization_id int, {name} string, normalized_projection_json string").write.parquet(str(tmp_path / name))
        assert cli.main(["enrich", "--payloads", str(tmp_path / name), "--out", str(tmp_path / "ev")]) == 0
        got = {(r.id, r.path, r.url) for r in spark.read.parquet(str(tmp_path / "ev/evidence")).collect()}
        assert got == {(1, "normalized_projection.website", "https://a.example"), (1, "normalized_projection.companyUrl", "https://b.example/x"), (2, "normalized_projection.homepage", "https://c.example")}
        assert {(r.organization_id, r.domain) for r in spark.read.parquet(str(tmp_path / "ev/domains")).collect()} == {(9, "a.example"), (9, "b.example"), (8, "c.example")}


PAGES = {
    f"https://{code}.example/job-offer/{k}": f"""<h1>{title}</h1><h2 data-testid="company-name">{company}</h2><h2>Requirements</h2><p>Item {k}</p>
    <script type="application/ld+json">{{"@type": "JobPosting", "hiringOrganization": {{"sameAs": "https://www.org{k % 3}.example/"}}}}</script>"""
    for code in ("left", "right") for k, title in enumerate(["Senior Data Engineer", "Data Analyst", "Platform Engineer", "QA Lead"]) for company in [f"Org {k % 3}"]
}


class _Site(adapters.SourceAdapter):
    def __init__(self, code, broken=()):
        self.code, self.broken = code, broken

    def listing_urls(self):
        yield f"https://{self.code}.example/all"

    def parse_listing(self, body, base_url):
        return [(u.rpartition("/")[2], u) for u in body.split()]

    def fetch(self, url):
        if url.endswith("/all"):
            return "\n".join(u for u in PAGES if u.startswith(f"https://{self.code}."))
        if url in self.broken:
            raise runs.StatusError("gone", 410)
        return PAGES[url]


def test_the_commands_chain_from_pages_to_the_gates(spark, tmp_path, capsys, monkeypatch):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    for code in ("left", "right"):
        monkeypatch.setitem(adapters.ADAPTERS, code, _Site(code))
    t = str(tmp_path / "t")
    with pytest.raises(ValueError, match="migrate first"):
        cli.main(["batch", "--tables", t, "--sources", "left,right"])
    assert cli.main(["migrate", "--tables", t]) == 0 and capsys.readouterr().out.split() == list(schemas.MIGRATIONS)
    assert cli.main(["migrate", "--tables", t]) == 0 and capsys.readouterr().out == ""
    args = ["batch", "--tables", t, "--sources", "left,right", "--delay", "0"]
    assert cli.main([*args, "--run-id", "one", "--manifest-out", str(tmp_path / "m.json"), "--report", str(tmp_path / "r" / "one.json")]) == 0
    report = json.loads((tmp_path / "r" / "one.json").read_text())
    assert [(s["source"], s["discovered"], s["states"]) for s in report["sources"]] == [("left", 4, {"OBSERVED": 4}), ("right", 4, {"OBSERVED": 4})]
    assert report["new_match_candidates"] == 4 and report["database"]["by_source"] == {"left": 4, "right": 4}
    assert {r["source_posting_id"] for r in json.loads((tmp_path / "m.json").read_text())["sources"]["left"]} == {"0", "1", "2", "3"}
    assert cli.main([*args, "--run-id", "two", "--manifest-in", str(tmp_path / "m.json")]) == 0
    capsys.readouterr()
    gate = ["verify", "--tables", t, "--sources", "left,right", "--expected"]
    assert cli.main([*gate, "4", "--gate", "crawl"]) == 0 and cli.main([*gate, "4", "--gate", "production", "--report", str(tmp_path / "p.json")]) == 0
    assert json.loads((tmp_path / "p.json").read_text())["failures"] == [] and cli.main([*gate, "5", "--gate", "production"]) == 1
    capsys.readouterr()
    for _ in range(2):  # a second pass adds nothing
        assert cli.main(["enrich", "--tables", t]) == 0
        assert json.loads(capsys.readouterr().out) == {"mentions": 8, "mention_evidence": 8, "url_evidence": 8, "domain_candidates": 8, "verified_domains": 0}
    made = []
    for _ in range(2):
        assert cli.main(["er-eval", "--tables", t, "--out", str(tmp_path / "corpus"), "--summary", str(tmp_path / "s.json")]) == 0
        made.append(json.loads((tmp_path / "s.json").read_text()))
    assert made[0]["created_now"] == made[0]["review_pairs_selected"] > 3 and made[1]["created_now"] == 0
    assert made[0]["strata"]["same_org_exact_title"] == 4 and made[0]["labels"] == {"UNRESOLVED": made[0]["review_pairs_selected"]}
    rows = spark.read.json(str(tmp_path / "corpus")).collect()
    assert len(rows) == made[0]["review_pairs_selected"] and {r.a.source for r in rows} == {"left"}
    assert {e.type for r in rows if r.stratum == "same_org_exact_title" for e in r.evidence} == {"SHARED_EXPLICIT_ORGANIZATION_DOMAIN"}
    assert cli.main([*gate, "8", "--gate", "org-er"]) == 0
    state = store.Store(spark, t).state()
    assert all(r.ok for r in schemas.constraint_gate(state).collect())


def test_a_change_a_lost_page_and_a_broken_run(spark, tmp_path, monkeypatch):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    held = store.Store(spark, str(tmp_path))
    store.migrate(held)
    lost = "https://left.example/job-offer/1"
    monkeypatch.setitem(adapters.ADAPTERS, "left", _Site("left"))
    batch.run(held, "one", ["left"], 3, delay=0)
    monkeypatch.setitem(adapters.ADAPTERS, "left", _Site("left", (lost,)))
    monkeypatch.setitem(PAGES, "https://left.example/job-offer/0", PAGES["https://left.example/job-offer/0"].replace("Item 0", "Item zero"))
    report, _ = batch.run(held, "two", ["left"], 3, delay=0)
    own = report["sources"][0]
    assert own["states"] == {"CHANGED": 1, "UNCHANGED": 1, "ERROR": 1} and own["errors"] == [{"id": "1", "error": "HTTP_410: gone"}]
    assert [c["changed_fields"] for c in own["changes"]] == [["semantic_content"]] and "Item zero" in own["changes"][0]["change_preview"]["semantic_content"]["after"]
    monkeypatch.setitem(adapters.ADAPTERS, "left", _Site("left"))
    report, _ = batch.run(held, "two", ["left"], 3, delay=0)  # again: only what failed is done
    assert report["sources"][0]["states"] == {"CHANGED": 1, "UNCHANGED": 2, "REPLAY_SKIPPED": 2}
    state = held.state()
    assert sorted((r.run_id, r.source_posting_id, r.attempt_no, r.outcome) for r in state["ingestion_attempt"].where("run_id = 'two'").collect()) == [("two", "0", 1, "SUCCESS"), ("two", "1", 1, "TERMINAL_FAILURE"), ("two", "1", 2, "SUCCESS"), ("two", "2", 1, "SUCCESS")]
    assert {r.id: r.status for r in state["ingestion_run"].collect()} == {"one": "COMPLETED", "two": "COMPLETED"}
    monkeypatch.setitem(adapters.ADAPTERS, "left", None)
    with pytest.raises(AttributeError):
        batch.run(held, "three", ["left"], 3, delay=0)
    ended = held.state()["ingestion_run"].where("id = 'three'").first()
    assert ended.status == "FAILED" and "AttributeError" in ended.summary_json


def test_api_results_are_ingested_as_pages(spark, tmp_path):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    held = store.Store(spark, str(tmp_path))
    store.migrate(held)
    report, pinned = batch.run(held, "one", ["board"], 2, delay=0, calls={"board": lambda: _answer})
    assert report["sources"][0]["states"] == {"OBSERVED": 2} and [r["groupId"] for r in pinned["sources"]["board"]] == ["g1", "g2"]
    (tmp_path / "m.json").write_text(json.dumps(pinned))
    report, _ = batch.run(held, "two", ["board"], 2, delay=0, manifest_in=str(tmp_path / "m.json"), calls={"board": lambda: _answer})
    assert report["sources"][0]["states"] == {"UNCHANGED": 2}
    rows = {r.title_source: json.loads(r.source_projection_json) for r in held.state()["job_posting_revision"].collect()}
    assert rows["Title g1"]["groupId"] == "g1" and rows["Title g1"]["details"]["title"] == "Title g1" and rows["Title g2"]["search"]["offerId"] == "o2"


def _answer(tool, arguments):
    if tool == api.SEARCH:
        offers = [{"offerId": "o1", "groupId": "g1"}, {"offerId": "o2", "groupId": "g2"}, {"offerId": "o3", "groupId": "g3"}]
        return json.dumps({"structured": None, "texts": ["[not an object]", json.dumps({"data": {"items": offers}})]})
    return json.dumps({"structured": {"title": f"Title {arguments['groupId']}", "company": {"name": "Org"}, "url": f"https://b.example/{arguments['groupId']}?x"}, "texts": []})
