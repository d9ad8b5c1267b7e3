from pyspark.sql import functions as F

from sedimark import schemas
from sedimark.operators import er, ingest, quality, store


def _pages(spark, change=()):
    rows = []
    for s in ("a", "b"):
        for k in range(6):
            body = change.get((s, k), "text") if change else "text"
            html = "<p>no title</p>" if body is None else f"<h1>Job {k}</h1><h2>Org {k % 3} {'Ltd.' if s == 'b' else ''}</h2><h2>Requirements</h2><p>{body}</p>"
            rows.append((s, str(k), f"https://{s}.example/job/{k}?x", html))
    return spark.createDataFrame(rows, "source_code string, source_posting_id string, url string, html string")


def test_two_passes_meet_the_production_gate(spark):
    now = F.lit("2026-01-01").cast("timestamp")
    one = ingest.ingest(store.empty(spark), _pages(spark), "r1", now)
    two = ingest.ingest(one, _pages(spark), "r2", now)
    two["match_candidate"] = schemas.empty(spark, "match_candidate")
    gate = quality.production_gate(two, ["a", "b"], 6)
    assert quality.verdict(gate).first().failures == []
    assert quality.verdict(quality.crawl_gate(two["job_posting"], two["posting_lifecycle_observation"], two["job_posting_revision"], ["a", "b"], 6)).first()["pass"]
    assert all(r.ok for r in schemas.constraint_gate(two).collect())
    schemas.assert_tables(two, list(schemas.TABLES))
    n = {r.table: r.n for r in store.counts(two).collect()}
    assert (n["raw_observation"], n["organization_mention"], n["organization"], n["organization_candidate"]) == (24, 12, 6, 12)
    again = ingest.ingest(two, _pages(spark), "r2", now)  # replay: all succeeded items are skipped
    assert again["raw_observation"].count() == 24 and again["ingestion_attempt"].count() == 24
    assert ingest.manifest(two, "r1").count() == 12


def test_change_revert_and_drift(spark):
    now, state = F.lit("2026-01-01").cast("timestamp"), store.empty(spark)
    for k, change in enumerate([{}, {("a", 0): "new", ("b", 1): None}, {("a", 1): "other"}]):
        state = ingest.ingest(state, _pages(spark, change), f"r{k}", now)
    report = ingest.run_report(state, "r1")
    assert {(r.source_code, r.state): r.n for r in report["states"].collect()} == {("a", "UNCHANGED"): 5, ("a", "CHANGED"): 1, ("b", "UNCHANGED"): 5}
    assert [r.error_message.split(":")[0] for r in report["errors"].collect()] == ["PARSER_DRIFT"]
    assert [(r.source_posting_id, r.revision_no) for r in report["changes"].collect()] == [("0", 2)]
    last = ingest.run_report(state, "r2")  # posting a/0 went back to its old text
    assert [(r.source_posting_id, r.error_message.split(":")[0]) for r in last["errors"].collect()] == [("0", "REVERTED_CONTENT")]
    assert {r.id: r.status for r in state["ingestion_run"].collect()} == {"r0": "COMPLETED", "r1": "PARTIAL", "r2": "PARTIAL"}
    assert all(r.ok for r in schemas.constraint_gate(state).collect())
    postings = state["job_posting"].join(state["job_posting_revision"].select(F.col("id").alias("current_revision_id"), "title_source"), "current_revision_id")
    pairs = er.candidate_pairs(postings.select("id", F.col("source_code").alias("source"), F.col("title_source").alias("title"), F.lit("").alias("org_mention"), F.lit(None).cast("long").alias("organization_id"), F.lit(None).cast("array<string>").alias("domains")))
    assert pairs.where("sim = 1").count() == 36  # every title is 'Job <digit>', and a lone digit is no token
