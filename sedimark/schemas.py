"""The tables of the pipeline: columns, keys, enumerations and references, as declarations that gates can check."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from sedimark.operators.quality import Gate

# The enumerations of the data model.
LIFECYCLE = ["OBSERVED", "CHANGED", "UNCHANGED", "SOURCE_EXPIRED", "SOURCE_REMOVED", "FETCH_FAILED", "PARSER_DRIFT"]
RUN_STATUS = ["STARTED", "COMPLETED", "FAILED", "PARTIAL"]
ITEM_STATUS = ["PROCESSING", "SUCCEEDED", "FAILED"]
OUTCOME = ["SUCCESS", "RETRYABLE_FAILURE", "TERMINAL_FAILURE"]
LABEL = ["SAME_OPPORTUNITY", "DISTINCT_OPPORTUNITY", "UNRESOLVED"]
LABEL_BASIS = ["AUTO_DECISIVE", "AUTO_COUNTER", "HUMAN", "PENDING"]
STRENGTH = ["DECISIVE", "STRONG", "MEDIUM", "WEAK"]
EPISTEMIC = ["FACT", "INFERENCE", "HYPOTHESIS", "DECISION"]


@dataclass
class Table:
    columns: str
    keys: list[list[str]] = field(default_factory=list)
    enums: dict[str, list[str]] = field(default_factory=dict)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    ordered: tuple[str, str] | None = None


TABLES = {
    "raw_observation": Table(
        "id long, source_code string, requested_url string, final_url string, fetched_at timestamp, http_status int, content_type string, payload_sha256 string, payload_text string, run_id string, source_posting_id string, parser_version string, transport_version string, archive_key string",
        [["id"], ["run_id", "source_code", "source_posting_id", "payload_sha256"]], {}, {"run_id": ("ingestion_run", "id")},
    ),
    "job_posting": Table("id long, source_code string, source_posting_id string, canonical_source_url string, first_observed_at timestamp, last_observed_at timestamp, current_revision_id long", [["id"], ["source_code", "source_posting_id"]], {}, {"current_revision_id": ("job_posting_revision", "id")}),
    "job_posting_revision": Table(
        "id long, job_posting_id long, revision_no int, observed_at timestamp, normalized_content_hash string, title_source string, source_projection_json string, normalized_projection_json string, raw_observation_id long, parser_version string, normalizer_version string",
        [["id"], ["job_posting_id", "revision_no"], ["job_posting_id", "normalized_content_hash"]], {}, {"job_posting_id": ("job_posting", "id"), "raw_observation_id": ("raw_observation", "id")},
    ),
    "posting_lifecycle_observation": Table("id long, job_posting_id long, raw_observation_id long, state string, observed_at timestamp", [["id"]], {"state": LIFECYCLE}, {"job_posting_id": ("job_posting", "id"), "raw_observation_id": ("raw_observation", "id")}),
    "organization_mention": Table("id long, job_posting_revision_id long, mention_text string, normalized_mention string", [["id"]], {}, {"job_posting_revision_id": ("job_posting_revision", "id")}),
    "organization": Table("id long, canonical_name string, normalized_name string, status string", [["id"], ["normalized_name"]], {"status": ["CANDIDATE", "VERIFIED", "REJECTED"]}),
    "organization_candidate": Table(
        "id long, organization_mention_id long, organization_id long, confidence_band string, status string, evidence_json string, resolver_version string",
        [["id"], ["organization_mention_id", "organization_id"]], {}, {"organization_mention_id": ("organization_mention", "id"), "organization_id": ("organization", "id")},
    ),
    "organization_participation": Table(
        "id long, organization_id long, job_posting_revision_id long, role string, epistemic_class string, confidence_band string",
        [["id"], ["organization_id", "job_posting_revision_id", "role"]], {"epistemic_class": EPISTEMIC}, {"organization_id": ("organization", "id"), "job_posting_revision_id": ("job_posting_revision", "id")},
    ),
    "match_candidate": Table("id long, posting_a_id long, posting_b_id long, reason_json string, status string, candidate_generator_version string", [["id"], ["posting_a_id", "posting_b_id"]], {}, {"posting_a_id": ("job_posting", "id"), "posting_b_id": ("job_posting", "id")}, ("posting_a_id", "posting_b_id")),
    "ingestion_run": Table("id string, trigger_kind string, status string, source_scope string, parser_bundle_version string, normalizer_version string, started_at timestamp, finished_at timestamp, summary_json string", [["id"]], {"status": RUN_STATUS}),
    "ingestion_item": Table(
        "id long, run_id string, source_code string, source_posting_id string, status string, raw_observation_id long, job_posting_id long, error_message string, started_at timestamp, finished_at timestamp",
        [["id"], ["run_id", "source_code", "source_posting_id"]], {"status": ITEM_STATUS}, {"run_id": ("ingestion_run", "id"), "raw_observation_id": ("raw_observation", "id"), "job_posting_id": ("job_posting", "id")},
    ),
    "ingestion_attempt": Table(
        "id long, run_id string, source_code string, source_posting_id string, requested_url string, attempt_no int, outcome string, failure_type string, http_status int, error_message string, started_at timestamp, finished_at timestamp",
        [["id"], ["run_id", "source_code", "source_posting_id", "attempt_no"]], {"outcome": OUTCOME}, {"run_id": ("ingestion_run", "id")},
    ),
    "organization_evidence": Table(
        "id long, organization_mention_id long, organization_id long, evidence_type string, direction string, strength string, epistemic_class string, value_json string, provenance_json string, resolver_version string, created_at timestamp",
        [["id"], ["organization_mention_id", "evidence_type", "value_json", "resolver_version"]], {"strength": STRENGTH, "epistemic_class": EPISTEMIC}, {"organization_mention_id": ("organization_mention", "id"), "organization_id": ("organization", "id")},
    ),
    "organization_domain_candidate": Table(
        "id long, organization_id long, domain string, status string, confidence_band string, evidence_id long, resolver_version string, created_at timestamp",
        [["id"], ["organization_id", "domain", "evidence_id"]], {"status": ["CANDIDATE", "VERIFIED", "REJECTED"]}, {"organization_id": ("organization", "id"), "evidence_id": ("organization_evidence", "id")},
    ),
    "er_eval_pair": Table(
        "id long, posting_a_id long, posting_b_id long, stratum string, features_json string, evidence_json string, proposed_label string, label_basis string, review_status string, generator_version string, created_at timestamp",
        [["id"], ["posting_a_id", "posting_b_id", "generator_version"]], {"proposed_label": LABEL, "label_basis": LABEL_BASIS}, {"posting_a_id": ("job_posting", "id"), "posting_b_id": ("job_posting", "id")}, ("posting_a_id", "posting_b_id"),
    ),
    "schema_migration": Table("version string, checksum string, applied_at timestamp", [["version"]]),
}


#: The tables in the order in which they came to be.
MIGRATIONS = {
    "0001_ingestion": ["schema_migration", "raw_observation", "job_posting", "job_posting_revision", "posting_lifecycle_observation", "organization_mention", "organization", "organization_candidate", "organization_participation", "match_candidate"],
    "0002_runs": ["ingestion_run", "ingestion_item", "ingestion_attempt"],
    "0003_evidence_and_pairs": ["organization_evidence", "organization_domain_candidate", "er_eval_pair"],
}


def migration_checksum(version: str) -> str:
    """Of the declarations of a migration's tables: a later change of one shows."""
    return hashlib.sha256("\n".join(f"{name}: {TABLES[name].columns}" for name in MIGRATIONS[version]).encode()).hexdigest()


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name].columns)


def constraint_gate(tables: dict[str, DataFrame]) -> DataFrame:
    """Every declared key, enumeration, order and reference of the given tables as checks; references to tables not given are left out."""
    gate = Gate()
    for name, df in tables.items():
        t = TABLES[name]
        for keys in t.keys:
            known = df.where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
            gate.unique(known, f"{name}: unique {', '.join(keys)}", *keys)
        for column, values in t.enums.items():
            gate.count(df, f"{name}: {column} in its values", "=", 0, df[column].isNotNull() & ~df[column].isin(*values))
        if t.ordered:
            a, b = t.ordered
            gate.count(df, f"{name}: {a} < {b}", "=", 0, df[a] >= df[b])
        for column, (target, key) in t.references.items():
            if target in tables:
                gate.references(df, f"{name}: {column} in {target}", column, tables[target], key)
    return gate.result()


def assert_tables(tables: dict[str, DataFrame], needed: list[str]) -> None:
    """Fails if a needed table is absent or lacks a declared column."""
    for name in needed:
        if name not in tables:
            raise ValueError(f"table {name} is missing; migrate first")
        want = {c.strip().split(" ")[0] for c in TABLES[name].columns.split(",")}
        if lost := want - set(tables[name].columns):
            raise ValueError(f"table {name} lacks {sorted(lost)}")
