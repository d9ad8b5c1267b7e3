"""A batch run over a store: discover or pinned references, fetch, ingest, matches, report and manifest."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimark.operators import ingest, runs, store
from sedimark.operators.scratch import cut
from sedimark.operators.store import Store, Tables
from sedimark.sources import adapters, api, files

REF = "source_code string, source_posting_id string, url string"


def references(spark: SparkSession, adapter: adapters.SourceAdapter, limit: int, pinned: DataFrame) -> DataFrame:
    """What a run is to process of a source: the references that a manifest pins, else what the source lists."""
    own = pinned.where(F.col("source") == adapter.code)
    if own.isEmpty():
        return spark.createDataFrame([(adapter.code, i, u) for i, u in adapter.discover(limit)], REF)
    return own.select(F.col("source").alias("source_code"), "source_posting_id", "url")


def api_pages(spark: SparkSession, source: str, make_call, limit: int, pinned: DataFrame) -> DataFrame:  # noqa: ANN001
    """API results of a source as pages: of the groups that a manifest pins, with its search rows, else of a search."""
    own = pinned.where((F.col("source") == source) & F.col("groupId").isNotNull())
    if own.isEmpty():
        rows = api.search(spark, make_call(), limit)
    else:
        rows = own.select(F.col("groupId").alias("group_id"), F.coalesce(F.try_parse_json("search"), F.try_parse_json(F.to_json(F.struct("groupId", F.col("source_posting_id").alias("offerId"))))).alias("search"))
    return api.landed(cut(api.detailed(rows, make_call)), source)


def source_reports(state: Tables, run_id: str, discovered: dict[str, int]) -> list[dict]:
    """One report a source: how many postings it referred to, their states, the first changes and the first errors."""
    rows = ingest.run_report(state, run_id)
    states = {(r["source_code"], r["state"]): r["n"] for r in rows["states"].collect()}
    items = {(r["source_code"], r["status"]): r["n"] for r in state["ingestion_item"].where(F.col("run_id") == run_id).groupBy("source_code", "status").agg(F.count("*").alias("n")).collect()}
    changes = [r.asDict(True) for r in rows["changes"].collect()]
    errors = [r.asDict() for r in rows["errors"].collect()]
    out = []
    for code, n in discovered.items():
        own = {s: k for (c, s), k in states.items() if c == code}
        if failed := items.get((code, "FAILED"), 0):
            own["ERROR"] = failed
        out.append({
            "source": code, "transport": ingest.VERSIONS["transport"], "discovered": n, "states": own,
            "changes": [{"source_posting_id": c["source_posting_id"], "changed_fields": c["changed_fields"], "change_preview": {p["field"]: {"before": p["before"], "after": p["after"]} for p in c["change_preview"]}} for c in changes if c["source_code"] == code],
            "errors": [{"id": e["source_posting_id"], "error": e["error_message"]} for e in errors if e["source_code"] == code],
        })
    return out


def manifest_document(state: Tables, run_id: str) -> dict:
    """The postings of a run by source, as a later run can pin them; API postings with their group and search row."""
    found = ingest.manifest(state, run_id).alias("m").join(state["job_posting"].alias("p"), (F.col("m.source") == F.col("p.source_code")) & (F.col("m.source_posting_id") == F.col("p.source_posting_id")))
    specific = state["job_posting_revision"].select(F.col("id").alias("current_revision_id"), F.try_parse_json("source_projection_json").alias("v"))
    rows = found.join(specific, "current_revision_id", "left").select(
        "m.source", "m.source_posting_id", "m.url", F.try_variant_get("v", "$.groupId", "string").alias("groupId"), F.to_json(F.try_variant_get("v", "$.search", "variant")).alias("search"),
    )
    out: dict[str, list] = {}
    for r in rows.orderBy("source", "source_posting_id").toLocalIterator():
        out.setdefault(r["source"], []).append({k: v for k, v in r.asDict().items() if v is not None})
    return {"sources": out}


def run(
    held: Store, run_id: str, sources: list[str], limit: int = 50, trigger: str = "manual", delay: float = 0.2, manifest_in: str | None = None, calls: dict | None = None
) -> tuple[dict, dict]:
    """A whole run: (report, manifest). calls: for sources that are read by API, what makes a Call; others go through their adapters.

    The run is a STARTED row from the beginning; if it breaks off, the row becomes FAILED with the error, and what was
    archived stays.
    """
    spark, now = held.spark, F.current_timestamp()
    pinned = files.manifest(spark, manifest_in)
    state = held.state()
    held.save(ingest.begin_run(state, spark, run_id, now, trigger, ",".join(sources)))
    report: dict = {"run_id": run_id, "sources": []}
    try:
        discovered, skipped = {}, {}
        for code in sources:
            state = held.state()
            if calls and code in calls:
                pages, tried = api_pages(spark, code, calls[code], limit, pinned), None
                wanted = pages.select(*ingest.POSTING)
            else:
                wanted = cut(references(spark, adapters.ADAPTERS[code], limit, pinned))
                todo = runs.claimable(wanted.withColumn("run_id", F.lit(run_id)), state["ingestion_item"])
                tried = cut(adapters.fetched(todo, adapters.ADAPTERS[code].fetch, pause=delay))
                pages = tried.where(F.col("outcome") == runs.SUCCESS).select(*ingest.POSTING, F.col("requested_url").alias("url"), F.col("body").alias("html"), "final_url", "http_status", "content_type")
            done = state["ingestion_item"].where((F.col("run_id") == run_id) & (F.col("status") == "SUCCEEDED")).select(*ingest.POSTING)
            discovered[code], skipped[code] = wanted.count(), wanted.join(done, ingest.POSTING, "left_semi").count()
            held.save(ingest.ingest_changes(state, pages, run_id, now, tried))
        matched = ingest.match_changes(held.state())
        held.save(matched)
        state = held.state()
        report["sources"] = source_reports(state, run_id, discovered)
        for own in report["sources"]:
            if skipped[own["source"]]:
                own["states"]["REPLAY_SKIPPED"] = skipped[own["source"]]
        report |= {"new_match_candidates": matched["match_candidate"].count(), "database": store.summary(state)}
        errors = sum(len(s["errors"]) for s in report["sources"])
        held.save(ingest.finish_run(state, run_id, now, "PARTIAL" if errors else "COMPLETED", json.dumps(report, ensure_ascii=False)))
    except Exception as error:
        report["fatal_error"] = f"{type(error).__name__}: {error}"
        held.save(ingest.finish_run(held.state(), run_id, now, "FAILED", json.dumps(report, ensure_ascii=False)))
        raise
    return report, manifest_document(held.state(), run_id)
