"""Evidence about organisations and review pairs, as passes over the current revisions of a state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimark.functions import hashing
from sedimark.operators import er, ledger, orgs
from sedimark.operators.ingest import VERSIONS, _Pass
from sedimark.operators.scratch import cut
from sedimark.operators.store import Tables

_KEYS = ["organization_mention_id", "evidence_type", "_value_key", "resolver_version"]


def current_mentions(state: Tables) -> DataFrame:
    """Mentions of the current revisions, with their posting and, where there is one, their candidate."""
    revisions = state["job_posting_revision"].select(F.col("id").alias("revision_id"), "source_projection_json", "normalized_projection_json")
    postings = state["job_posting"].select("source_code", "source_posting_id", F.col("current_revision_id").alias("revision_id"))
    mentions = state["organization_mention"].select(F.col("id").alias("organization_mention_id"), F.col("job_posting_revision_id").alias("revision_id"), "mention_text")
    candidates = state["organization_candidate"].select("organization_mention_id", "organization_id")
    return mentions.join(postings, "revision_id").join(revisions, "revision_id").join(candidates, "organization_mention_id", "left")


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_value_key", hashing.evidence_key(F.col("value_json")))


def enrich_changes(state: Tables, now: Column) -> Tables:
    """New evidence and domain candidates: every mention is weak evidence, organisation URLs in either projection are
    stronger. A fact that the state holds for a mention, type, value and resolver version is not added again."""
    rows = cut(current_mentions(state))
    own = _Pass(rows.sparkSession, state)
    provenance = [F.col("source_code").alias("source"), "source_posting_id", "revision_id"]
    shared = {"resolver_version": F.lit(VERSIONS["resolver"]), "epistemic_class": F.lit("FACT"), "direction": F.lit("SUPPORTS_IDENTITY"), "created_at": now}

    plain = orgs.mention_evidence(rows).withColumns(shared | {
        "value_json": F.to_json(F.struct(F.col("mention_text").alias("mention"))), "provenance_json": F.to_json(F.struct(*provenance, F.lit("organization_mention").alias("field"))),
    })
    leaves = None
    for root in ("source_projection", "normalized_projection"):
        found = orgs.json_leaves(rows.dropDuplicates(["organization_mention_id"]), "organization_mention_id", f"{root}_json", root)
        leaves = found if leaves is None else leaves.unionByName(found)
    found = orgs.url_evidence(leaves, "organization_mention_id").join(rows.drop("source_projection_json", "normalized_projection_json"), "organization_mention_id")
    found = found.withColumns(shared | {
        "value_json": F.to_json(F.struct("url", "domain"), {"ignoreNullFields": "false"}), "provenance_json": F.to_json(F.struct(*provenance, F.col("path").alias("source_path"))),
    })

    held = ["organization_mention_id", "organization_id", "evidence_type", "direction", "strength", "epistemic_class", "value_json", "provenance_json", "resolver_version", "created_at"]
    both = _keyed(plain.select(*held).unionByName(found.select(*held)))
    new = ledger.append_new(_keyed(state["organization_evidence"]), both, _KEYS)
    own.add("organization_evidence", new, [F.asc(k) for k in _KEYS[:3]])

    evidence = own.state["organization_evidence"].select(F.col("id").alias("evidence_id"), "organization_id", "evidence_type", "strength", F.get_json_object("value_json", "$.domain").alias("domain"))
    evidence = evidence.where(F.col("domain").isNotNull() & F.col("organization_id").isNotNull() & (F.col("evidence_type") != "SOURCE_ORGANIZATION_MENTION"))
    band = F.when(F.col("strength") == "STRONG", "HIGH").otherwise("MEDIUM")
    domains = evidence.withColumns({"status": F.lit("CANDIDATE"), "confidence_band": band, "resolver_version": F.lit(VERSIONS["resolver"]), "created_at": now})
    keys = ["organization_id", "domain", "evidence_id"]
    own.add("organization_domain_candidate", ledger.append_new(state["organization_domain_candidate"], domains, keys), [F.asc(k) for k in keys])
    return own.changes


def enrichment_report(state: Tables) -> dict:
    """Sizes after an enrichment pass."""
    plain = F.col("evidence_type") == "SOURCE_ORGANIZATION_MENTION"
    evidence, domains = state["organization_evidence"], state["organization_domain_candidate"]
    counted = orgs.enrichment_summary(evidence.where(plain), evidence.where(~plain), domains).first().asDict()
    return {"mentions": current_mentions(state).count()} | counted


def state_postings(state: Tables) -> DataFrame:
    """The current postings as er.candidate_pairs() takes them: with mention, candidate and the candidate's domains."""
    revisions = state["job_posting_revision"].select(F.col("id").alias("current_revision_id"), F.coalesce("title_source", F.get_json_object("normalized_projection_json", "$.title"), F.lit("")).alias("title"))
    mentions = current_mentions(state).select(F.col("revision_id").alias("current_revision_id"), "organization_mention_id", "organization_id")
    names = state["organization_mention"].select(F.col("id").alias("organization_mention_id"), F.col("normalized_mention").alias("org_mention"))
    rows = state["job_posting"].join(revisions, "current_revision_id").join(mentions.join(names, "organization_mention_id"), "current_revision_id", "left")
    rows = rows.join(orgs.domain_sets(state["organization_domain_candidate"], "organization_id"), "organization_id", "left")
    return rows.select("id", F.col("source_code").alias("source"), "source_posting_id", F.col("canonical_source_url").alias("url"), "title", "org_mention", "organization_id", "domains")


_FEATURES = (
    "title_jaccard", "same_org_mention", "same_org_name_signature", "org_signature_a", "org_signature_b", "same_org_candidate", "shared_explicit_domain",
    "same_seniority_signal", "seniority_conflict", "title_a", "title_b", "source_a", "source_b", "org_a", "org_b",
)


def pair_changes(state: Tables, now: Column, limit: int = 200) -> tuple[Tables, dict]:
    """New review pairs of this generator, and the counts of the pass."""
    postings = cut(state_postings(state))
    kinds = er.classes(postings)
    counted = cut(er.levels(er.class_pairs(kinds)))
    chosen = cut(er.with_features(er.review_selection(er.leading_pairs(postings, limit, kinds, counted), limit), postings))
    own = _Pass(postings.sparkSession, state)
    rows = chosen.select(
        F.col("a_id").alias("posting_a_id"), F.col("b_id").alias("posting_b_id"), "stratum", F.to_json(F.struct(*_FEATURES)).alias("features_json"), F.to_json("evidence").alias("evidence_json"),
        "proposed_label", "label_basis", "review_status", "generator_version", "rank", now.alias("created_at"),
    )
    keys = ["posting_a_id", "posting_b_id", "generator_version"]
    new = own.add("er_eval_pair", ledger.append_new(state["er_eval_pair"], rows, keys), [F.asc("rank")])
    return own.changes, {"generator_version": er.GENERATOR_VERSION, "postings_considered": postings.count(), "candidate_pairs_generated": er.total_pairs(counted), "created_now": new.count()}


def pair_corpus(state: Tables) -> DataFrame:
    """The review corpus of this generator: one row a pair, with features, evidence and the identity of both postings, by id."""
    end = lambda side: state["job_posting"].select(F.col("id").alias(f"posting_{side}_id"), F.struct(F.col("source_code").alias("source"), "source_posting_id", F.col("canonical_source_url").alias("url")).alias(side))
    pairs = state["er_eval_pair"].where(F.col("generator_version") == er.GENERATOR_VERSION).join(end("a"), "posting_a_id").join(end("b"), "posting_b_id")
    return pairs.select(F.col("id").alias("pair_id"), "stratum", F.col("proposed_label").alias("label"), "label_basis", F.parse_json("features_json").alias("features"), F.parse_json("evidence_json").alias("evidence"), "a", "b")


def pair_report(corpus: DataFrame) -> dict:
    """Counts of the corpus by label and stratum."""
    grouped = lambda c: {r[0]: r[1] for r in corpus.groupBy(c).count().orderBy(c).collect()}
    is_ = lambda label, basis: F.count_if((F.col("label") == label) & (F.col("label_basis") == basis))
    n = corpus.agg(
        F.count("*").alias("review_pairs_selected"), is_("SAME_OPPORTUNITY", "AUTO_DECISIVE").alias("auto_same_count"),
        is_("DISTINCT_OPPORTUNITY", "AUTO_COUNTER").alias("auto_distinct_count"), F.count_if(F.col("label") == "UNRESOLVED").alias("unresolved_count"),
    )
    return n.first().asDict() | {"labels": grouped("label"), "strata": grouped("stratum")}
