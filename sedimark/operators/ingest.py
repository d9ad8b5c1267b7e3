"""One pass over landed pages as one plan: raw archive, parsing, ledger, mentions, organisations, items and attempts.

State is a set of tables (schemas.py); a pass reads it and gives the rows that it adds or changes, which the store
(store.py) appends. Raw evidence is archived before parsing, so it survives parser drift; a page that doesn't parse, or
whose content goes back to an old revision, is a failed item with a terminal attempt. Items that have succeeded in the
same run are skipped. A run is a row from its start on: one that breaks off stays STARTED or becomes FAILED.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimark import schemas
from sedimark.functions import hashing, text, urls
from sedimark.operators import er, ledger, orgs, runs, store
from sedimark.operators.scratch import cut
from sedimark.operators.store import Tables
from sedimark.sources import api, details

# Versions that rows are stamped with.
VERSIONS = {"parser": "sedimark-parser-2", "normalizer": "sedimark-normalizer-2", "transport": "landed-1", "resolver": "org-seed-1", "matcher": "exact-title-org-1"}
POSTING = ["source_code", "source_posting_id"]
#: Landed pages: html holds the body, of whatever type. Further columns (final_url, http_status, content_type) are kept.
PAGE = "source_code string, source_posting_id string, url string, html string"


def _like(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    """``rows`` with exactly the declared columns of a table; those it lacks are null."""
    want = schemas.empty(spark, name).schema
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in want.fields])


class _Pass:
    """A state and what a pass has added to it so far."""

    def __init__(self, spark: SparkSession, state: Tables):
        self.spark, self.state, self.changes = spark, dict(state), {}

    def put(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows with ids that are new or replace others of the same key."""
        new = cut(_like(self.spark, name, rows))
        self.changes[name] = store.applied({name: self.changes[name]}, {name: new})[name] if name in self.changes else new
        self.state = store.applied(self.state, {name: new})
        return new

    def add(self, name: str, rows: DataFrame, order: list[Column]) -> DataFrame:
        """Appends rows with new ids and returns them."""
        return self.put(name, ledger.assign_ids(self.state[name], rows.drop("id"), order))


def begin_run(state: Tables, spark: SparkSession, run_id: str, now: Column, trigger: str = "MANUAL", scope: str = "landed pages") -> Tables:
    """The row of a run that starts; a run that is known already keeps its own."""
    row = spark.range(1).select(
        F.lit(run_id).alias("id"), F.lit(trigger).alias("trigger_kind"), F.lit("STARTED").alias("status"), F.lit(scope).alias("source_scope"),
        F.lit(VERSIONS["parser"]).alias("parser_bundle_version"), F.lit(VERSIONS["normalizer"]).alias("normalizer_version"), now.alias("started_at"),
    )
    return {"ingestion_run": _like(spark, "ingestion_run", row.join(state["ingestion_run"].select("id"), "id", "left_anti"))}


def finish_run(state: Tables, run_id: str, now: Column, status: str, summary_json: str) -> Tables:
    """A run's row with its end."""
    ended = state["ingestion_run"].where(F.col("id") == run_id)
    return {"ingestion_run": ended.withColumns({"status": F.lit(status), "finished_at": now, "summary_json": F.lit(summary_json)})}


def parsed_pages(seen: DataFrame) -> DataFrame:
    """(raw_observation_id, title, company, body, projection, specific, error) of archived bodies: pages by their source's
    profile, JSON objects with ``search`` and ``details`` as API results."""
    is_api = F.coalesce(F.col("content_type").startswith("application/json"), F.lit(False))
    columns = ["raw_observation_id", "title", "company", "body", "projection", "specific", "error"]
    pages = details.parse_postings(seen.where(~is_api), "raw_observation_id", "html", "url", "source_code").select(columns)
    both = seen.where(is_api).withColumn("v", F.try_parse_json("html"))
    pair = both.select("raw_observation_id", *[F.coalesce(F.try_variant_get("v", f"$.{c}", "variant"), F.parse_json(F.lit("{}"))).alias(c) for c in ("search", "details")])
    found = api.postings(pair)
    specific = F.concat(F.lit('{"details":'), F.to_json("details"), F.lit(',"groupId":'), F.to_json(F.to_variant_object(F.array("group_id"))), F.lit(',"search":'), F.to_json("search"), F.lit(',"transport":"api"}'))
    found = found.withColumns({"projection": F.lit(None).cast("string"), "specific": F.regexp_replace(specific, r'"groupId":\[(.*?)\],"search"', '"groupId":$1,"search"')})
    return pages.unionByName(found.select(columns))


def ingest_changes(state: Tables, pages: DataFrame, run_id: str, now: Column, tried: DataFrame | None = None) -> Tables:
    """What a run over ``pages`` adds and changes. tried: attempts (the posting's keys, requested_url, attempt_no, outcome,
    failure_type, http_status, error_message) that led to the pages, or failed; without them each page is one attempt."""
    spark = pages.sparkSession
    own, item = _Pass(spark, state), [F.asc("source_code"), F.asc("source_posting_id")]
    wanted = pages.dropDuplicates(POSTING).withColumn("run_id", F.lit(run_id))
    for name, kind in (("final_url", "string"), ("http_status", "int"), ("content_type", "string")):
        if name not in wanted.columns:
            wanted = wanted.withColumn(name, F.lit(None).cast(kind))
    todo = cut(runs.claimable(wanted, state["ingestion_item"]))

    digest = hashing.payload_hash(F.col("html"))
    raw = todo.select(
        *POSTING, "run_id", F.col("url").alias("requested_url"), F.coalesce("final_url", "url").alias("final_url"), "http_status", "content_type", now.alias("fetched_at"), digest.alias("payload_sha256"), F.col("html").alias("payload_text"),
        F.lit(VERSIONS["parser"]).alias("parser_version"), F.lit(VERSIONS["transport"]).alias("transport_version"), hashing.archive_key(F.col("source_code"), F.col("source_posting_id"), digest).alias("archive_key"),
    )
    keys = ["run_id", *POSTING, "payload_sha256"]
    new = own.add("raw_observation", ledger.append_new(state["raw_observation"], raw, keys), item)
    # a payload that this run has archived before is not archived again, but read again
    raw = new.unionByName(state["raw_observation"].join(raw.select(*keys), keys, "left_semi"))

    seen = cut(raw.select(F.col("id").alias("raw_observation_id"), *POSTING, F.col("final_url").alias("url"), "content_type", F.col("payload_text").alias("html")))
    parsed = seen.drop("html", "content_type").join(parsed_pages(seen), "raw_observation_id")
    projection = hashing.projection_json(F.col("title"), F.col("company"), F.col("body"), F.col("projection"))
    parsed = cut(parsed.withColumns({"normalized_projection_json": projection, "hash": F.sha2(projection, 256)}))
    good = parsed.where("error IS NULL")

    # earlier accepted revisions stand for earlier observations
    old = state["job_posting_revision"].join(state["job_posting"].select(F.col("id").alias("job_posting_id"), *POSTING, "current_revision_id"), "job_posting_id")
    old = old.select(*POSTING, F.col("normalized_content_hash").alias("hash"), F.col("revision_no").cast("long").alias("seq"), F.lit(None).cast("long").alias("raw_observation_id"))
    old = old.join(good.select(*POSTING).distinct(), POSTING, "left_semi")
    both = old.unionByName(good.select(*POSTING, "hash", (F.col("raw_observation_id") + (1 << 40)).alias("seq"), "raw_observation_id"))
    states = cut(ledger.lifecycle(both, POSTING).where("raw_observation_id IS NOT NULL").select("raw_observation_id", "state", "revision_no"))
    good = good.join(states, "raw_observation_id")
    kept = good.where("state <> 'REJECTED'")

    known = state["job_posting"].select(*POSTING)
    fresh = kept.select(*POSTING, urls.canonical_url(F.col("url")).alias("canonical_source_url"), now.alias("first_observed_at"), now.alias("last_observed_at")).join(known, POSTING, "left_anti")
    own.add("job_posting", fresh, item)
    postings = own.state["job_posting"].select(F.col("id").alias("job_posting_id"), *POSTING)
    kept = cut(kept.join(postings, POSTING))

    revised = kept.where("state <> 'UNCHANGED'").select(
        "job_posting_id", F.col("revision_no").cast("int").alias("revision_no"), now.alias("observed_at"), F.col("hash").alias("normalized_content_hash"), F.col("title").alias("title_source"),
        F.col("specific").alias("source_projection_json"), "normalized_projection_json", "raw_observation_id", F.lit(VERSIONS["parser"]).alias("parser_version"), F.lit(VERSIONS["normalizer"]).alias("normalizer_version"),
    )
    revised = own.add("job_posting_revision", revised, [F.asc("job_posting_id")])
    own.add("posting_lifecycle_observation", kept.select("job_posting_id", "raw_observation_id", "state", now.alias("observed_at")), [F.asc("raw_observation_id")])

    current = revised.select("job_posting_id", F.col("id").alias("_now"))
    touched = kept.groupBy("job_posting_id").agg(F.max_by(urls.canonical_url(F.col("url")), "raw_observation_id").alias("_url"))
    p = own.state["job_posting"].withColumnRenamed("id", "job_posting_id").join(touched, "job_posting_id").join(current, "job_posting_id", "left")
    p = p.withColumns({"current_revision_id": F.coalesce("_now", "current_revision_id"), "last_observed_at": now, "canonical_source_url": F.col("_url")})
    own.put("job_posting", p.withColumnRenamed("job_posting_id", "id"))

    mentions = revised.join(parsed.select("raw_observation_id", "company"), "raw_observation_id").where("company <> ''")
    mentions = mentions.select(F.col("id").alias("job_posting_revision_id"), F.col("company").alias("mention_text"), text.norm_key(F.col("company")).alias("normalized_mention"))
    mentions = own.add("organization_mention", mentions, [F.asc("job_posting_revision_id")])
    seeds = orgs.seed(mentions, "id").join(state["organization"].select("normalized_name"), "normalized_name", "left_anti")
    first = mentions.groupBy(F.col("normalized_mention").alias("normalized_name")).agg(F.min("id").alias("_first"))
    own.add("organization", seeds.join(first, "normalized_name"), [F.asc("_first")])
    named = orgs.candidates(mentions.withColumnRenamed("id", "organization_mention_id")).join(own.state["organization"].select(F.col("id").alias("organization_id"), "normalized_name"), "normalized_name")
    named = named.withColumns({"resolver_version": F.lit(VERSIONS["resolver"]), "evidence_json": F.lit('{"epistemic_class": "HYPOTHESIS", "identity_asserted": false, "reason": "exact normalized source mention only"}')})
    own.add("organization_candidate", named, [F.asc("organization_mention_id")])
    roles = named.select("organization_id", "job_posting_revision_id").distinct().withColumns({"role": F.lit("ADVERTISER"), "epistemic_class": F.lit("FACT"), "confidence_band": F.lit("MEDIUM")})
    own.add("organization_participation", roles, [F.asc("organization_id"), F.asc("job_posting_revision_id")])

    outcome = parsed.join(states, "raw_observation_id", "left").join(postings, POSTING, "left")
    error = F.coalesce("error", F.when(F.col("state") == "REJECTED", "REVERTED_CONTENT: an older revision came back"))
    failed = error.isNotNull()
    ended = cut(outcome.select(*POSTING, "raw_observation_id", "job_posting_id", F.col("url").alias("requested_url"), ledger.preview(error, 2000).alias("error_message"), failed.alias("failed")))
    stamped = ended.withColumns({"run_id": F.lit(run_id), "started_at": now, "finished_at": now})
    if tried is not None:  # postings that no attempt could fetch are failed items too
        lost = tried.where(F.col("outcome") == runs.FINAL).groupBy(*POSTING).agg(F.max_by("requested_url", "attempt_no").alias("requested_url"), F.max_by(F.concat_ws(": ", "failure_type", "error_message"), "attempt_no").alias("error_message"))
        lost = lost.withColumns({"failed": F.lit(True), "run_id": F.lit(run_id), "started_at": now, "finished_at": now})
        stamped = cut(stamped.unionByName(lost, allowMissingColumns=True))
    known = state["ingestion_item"].select(F.col("id").alias("_id"), *runs.ITEM)
    status = stamped.withColumn("status", F.when(F.col("failed"), "FAILED").otherwise("SUCCEEDED")).join(known, list(runs.ITEM), "left")
    own.put("ingestion_item", status.where("_id IS NOT NULL").withColumn("id", F.col("_id")))
    own.add("ingestion_item", status.where("_id IS NULL"), item)

    before = state["ingestion_attempt"].groupBy(*runs.ITEM).agg(F.max("attempt_no").alias("_last"))
    parsing = F.when(F.col("failed"), runs.FINAL).otherwise(runs.SUCCESS)
    if tried is None:
        tries = stamped.withColumns({"_no": F.lit(1), "outcome": parsing, "failure_type": F.when(F.col("failed"), F.substring_index("error_message", ":", 1))})
    else:  # the attempt that fetched a page which then didn't parse has failed for good
        ends = stamped.select(*POSTING, F.col("failed").alias("_failed"), F.col("error_message").alias("_error"))
        tries = tried.withColumnRenamed("attempt_no", "_no").join(ends, POSTING, "left")
        bad = (F.col("outcome") == runs.SUCCESS) & F.coalesce("_failed", F.lit(False))
        tries = tries.withColumns({"failure_type": F.when(bad, F.substring_index("_error", ":", 1)).otherwise(F.col("failure_type")), "error_message": ledger.preview(F.when(bad, F.col("_error")).otherwise(F.col("error_message")), 2000)})
        tries = tries.withColumns({"outcome": F.when(bad, runs.FINAL).otherwise(F.col("outcome")), "run_id": F.lit(run_id), "started_at": now, "finished_at": now})
    tries = tries.join(before, list(runs.ITEM), "left").withColumn("attempt_no", F.coalesce("_last", F.lit(0)) + F.col("_no"))
    own.add("ingestion_attempt", tries, [*item, F.asc("attempt_no")])
    return own.changes


def ingest(state: Tables, pages: DataFrame, run_id: str, now: Column, trigger: str = "MANUAL", tried: DataFrame | None = None) -> Tables:
    """The state after a whole run over ``pages`` (source_code, source_posting_id, url, html)."""
    spark = pages.sparkSession
    state = store.applied(state, begin_run(state, spark, run_id, now, trigger))
    changes = ingest_changes(state, pages, run_id, now, tried)
    after = store.applied(state, changes)
    n = {r["state"]: r["n"] for r in changes["posting_lifecycle_observation"].groupBy("state").agg(F.count("*").alias("n")).collect()}
    errors = changes["ingestion_item"].where("status = 'FAILED'").count()
    n |= {"ERROR": errors, "REPLAY_SKIPPED": pages.select(*POSTING).distinct().count() - changes["ingestion_item"].count()}
    summary = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in sorted(n.items())]))
    ended = finish_run(after, run_id, now, "PARTIAL" if errors else "COMPLETED", spark.range(1).select(summary).first()[0])
    return store.applied(after, {"ingestion_run": cut(ended["ingestion_run"])})


def match_changes(state: Tables) -> Tables:
    """New match candidates of the current revisions: hypotheses on equal titles and mentions across sources."""
    current = state["job_posting"].join(state["job_posting_revision"].select(F.col("id").alias("current_revision_id"), "normalized_projection_json"), "current_revision_id")
    of = lambda c: text.norm_key(F.get_json_object("normalized_projection_json", f"$.{c}"))
    found = er.exact_matches(current.select("id", F.col("source_code").alias("source"), of("title").alias("title_key"), of("company_mention").alias("company_key")))
    reason = '{"epistemic_class": "HYPOTHESIS", "evidence": ["same normalized title", "same normalized organization mention"], "identity_asserted": false}'
    rows = found.select(F.col("a_id").alias("posting_a_id"), F.col("b_id").alias("posting_b_id"), F.lit(reason).alias("reason_json"), F.lit("OPEN").alias("status"), F.lit(VERSIONS["matcher"]).alias("candidate_generator_version"))
    keys = ["posting_a_id", "posting_b_id"]
    own = _Pass(found.sparkSession, state)
    own.add("match_candidate", ledger.append_new(state["match_candidate"], rows, keys), [F.asc(k) for k in keys])
    return own.changes


_PARTS = ("title", "company_mention", "body_text", "semantic_content")


def run_report(state: Tables, run_id: str, most_changes: int = 25, most_errors: int = 20) -> dict[str, DataFrame]:
    """States by source, the first changes, with the parts that differ, and the first errors of a run; the lists have the report's limits."""
    raw = state["raw_observation"].where(F.col("run_id") == run_id).select(F.col("id").alias("raw_observation_id"), *POSTING)
    seen = state["posting_lifecycle_observation"].join(raw, "raw_observation_id")
    errors = state["ingestion_item"].where((F.col("run_id") == run_id) & (F.col("status") == "FAILED")).select("id", *POSTING, "error_message")
    revisions = state["job_posting_revision"].withColumn("before", F.lag("normalized_projection_json").over(Window.partitionBy("job_posting_id").orderBy("revision_no")))
    changed = seen.where("state = 'CHANGED'").join(revisions.select("raw_observation_id", "revision_no", "before", F.col("normalized_projection_json").alias("after")), "raw_observation_id")
    part = lambda c: {p: F.get_json_object(c, f"$.{p}") for p in _PARTS}
    fields = ledger.changed_fields(part("before"), part("after"))
    changed = changed.select("raw_observation_id", *POSTING, "revision_no", fields.alias("changed_fields"), "before", "after")
    previews = [F.struct(F.lit(p).alias("field"), ledger.preview(F.get_json_object("before", f"$.{p}")).alias("before"), ledger.preview(F.get_json_object("after", f"$.{p}")).alias("after")) for p in sorted(_PARTS)]
    changed = changed.withColumn("change_preview", F.filter(F.array(*previews), lambda x: F.array_contains("changed_fields", x["field"]))).drop("before", "after")
    return {"states": runs.source_report(seen), "changes": changed.orderBy("raw_observation_id").limit(most_changes), "errors": errors.orderBy("id").limit(most_errors)}


def manifest(state: Tables, run_id: str) -> DataFrame:
    """(source, source_posting_id, url) of a run's items: the identities that a recrawl pins."""
    items = state["ingestion_item"].where(F.col("run_id") == run_id).select(*POSTING)
    found = items.join(state["job_posting"].select(*POSTING, "canonical_source_url"), POSTING)
    return found.select(F.col("source_code").alias("source"), "source_posting_id", F.col("canonical_source_url").alias("url"))
