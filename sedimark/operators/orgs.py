"""Organisations: seeding from mentions, and evidence from URLs in payloads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimark.functions.text import casefold, norm_key, norm_text
from sedimark.functions.urls import domain, find_urls
from sedimark.operators.scratch import cut

# Parts of payload paths that mark an organisation's own URL, and its profile at the source.
OWN_URL_PATHS = ("website", "webSite", "companyUrl", "employerUrl", "corporateUrl", "careersUrl", "careerUrl", "homepage", "sameAs")
PROFILE_PATHS = ("profileUrl", "companyProfile", "employerProfile")
HIRING_PATH = "hiringorganization"
#: So many levels of a JSON walk are read as one plan; more are written together first.
UNITED = 32


def seed(mentions: DataFrame, order: str) -> DataFrame:
    """(normalized_name, canonical_name, status): one organisation for each mention key; the first mention names it."""
    rows = mentions.where(norm_key(F.col("mention_text")) != "").withColumn("normalized_name", norm_key(F.col("mention_text")))
    return rows.groupBy("normalized_name").agg(F.min_by("mention_text", order).alias("canonical_name")).withColumn("status", F.lit("CANDIDATE"))


def candidates(mentions: DataFrame) -> DataFrame:
    """Each mention's candidate: a hypothesis of low confidence, never a merge."""
    named = mentions.withColumn("normalized_name", norm_key(F.col("mention_text"))).where("normalized_name <> ''")
    return named.withColumns({"confidence_band": F.lit("LOW"), "status": F.lit("CANDIDATE"), "epistemic_class": F.lit("HYPOTHESIS")})


def participations(mentions: DataFrame, revision: str) -> DataFrame:
    """(normalized_name, revision, role, epistemic_class, confidence_band), once for each organisation, revision and role."""
    named = candidates(mentions).select("normalized_name", revision).distinct()
    return named.withColumns({"role": F.lit("ADVERTISER"), "epistemic_class": F.lit("FACT"), "confidence_band": F.lit("MEDIUM")})


def json_leaves(payloads: DataFrame, key: str, json: str, root: str = "source_projection") -> DataFrame:
    """(key, path, value): the leaves of JSON payloads depth first, as dotted and indexed paths; value is null unless a string.

    Bad JSON has no leaves, empty containers neither. The walk goes level by level over durable tables until no container
    is left, so neither rows nor levels are capped; jobs run while the result is made, two for each level. Spark's parser
    takes JSON of at most 1,000 levels as good.
    """
    kind = F.schema_of_variant("v")
    deep = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    level = payloads.select(F.col(key).alias("k"), F.lit(root).alias("path"), F.try_parse_json(F.col(json).cast("string")).alias("v")).where("v IS NOT NULL")
    found: list[DataFrame] = []
    while True:
        level = cut(level.withColumn("deep", deep))
        found.append(level.where("NOT deep").select(F.col("k").alias(key), "path", F.when(kind == "STRING", F.try_variant_get("v", "$", "string")).alias("value")))
        containers = level.where("deep").select("k", F.col("path").alias("above"), F.col("v").alias("inside"))
        if containers.isEmpty():
            return reduce(DataFrame.unionAll, found)
        if len(found) == UNITED:
            found = [cut(reduce(DataFrame.unionAll, found))]
        each = containers.lateralJoin(payloads.sparkSession.tvf.variant_explode(F.col("inside").outer()))
        step = F.when(F.col("key").isNull(), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]"))).otherwise(F.concat(F.lit("."), F.col("key")))
        level = each.select("k", F.concat("above", step).alias("path"), F.col("value").alias("v"))


def url_kind(path: Column) -> Column:
    """What kind of organisation URL a payload path holds, null if none; parents' names count."""
    low = casefold(path)
    any_of = lambda names: F.greatest(*[low.contains(n.casefold()) for n in names])
    return (
        F.when(any_of(OWN_URL_PATHS), "EXPLICIT_ORGANIZATION_URL")
        .when(any_of(PROFILE_PATHS), "SOURCE_ORGANIZATION_PROFILE_URL")
        .when(low.contains(HIRING_PATH), "HIRING_ORGANIZATION_URL")
    )


def strength(kind: Column) -> Column:
    return F.when(kind.isin("EXPLICIT_ORGANIZATION_URL", "HIRING_ORGANIZATION_URL"), "STRONG").otherwise("MEDIUM")


def url_evidence(leaves: DataFrame, key: str) -> DataFrame:
    """(key, evidence_type, url, path, strength, domain): organisation URLs of payload leaves; the first path names each.

    Of several paths with one URL the least path is kept, so the result doesn't depend on order.
    """
    found = leaves.where("value IS NOT NULL").select(key, "path", url_kind(F.col("path")).alias("evidence_type"), F.explode(find_urls(F.col("value"))).alias("url"))
    found = found.where("evidence_type IS NOT NULL").groupBy(key, "evidence_type", "url").agg(F.min("path").alias("path"))
    return found.withColumns({"strength": strength(F.col("evidence_type")), "domain": domain(F.col("url"))})


def mention_evidence(mentions: DataFrame) -> DataFrame:
    """Every mention is weak evidence of its organisation, as a fact of the source."""
    return mentions.withColumns({"evidence_type": F.lit("SOURCE_ORGANIZATION_MENTION"), "direction": F.lit("SUPPORTS_IDENTITY"), "strength": F.lit("WEAK"), "epistemic_class": F.lit("FACT"), "value": norm_text(F.col("mention_text"))})


def domain_candidates(evidence: DataFrame, organization: str) -> DataFrame:
    """(organization, domain, status, confidence_band) of URL evidence with a domain."""
    band = F.max(F.when(F.col("strength") == "STRONG", 2).otherwise(1))
    out = evidence.where(F.col("domain").isNotNull() & F.col(organization).isNotNull()).groupBy(organization, "domain").agg(band.alias("_band"))
    return out.select(organization, "domain", F.lit("CANDIDATE").alias("status"), F.when(F.col("_band") == 2, "HIGH").otherwise("MEDIUM").alias("confidence_band"))


def domain_sets(domains: DataFrame, organization: str) -> DataFrame:
    """(organization, domains): the sets of candidate or verified domains."""
    return domains.where(F.col("status").isin("CANDIDATE", "VERIFIED")).groupBy(organization).agg(F.array_sort(F.collect_set("domain")).alias("domains"))


def enrichment_summary(mention_rows: DataFrame, url_rows: DataFrame, domains: DataFrame) -> DataFrame:
    """One row of counts of an enrichment pass."""
    out = mention_rows.agg(F.count("*").alias("mention_evidence")).crossJoin(url_rows.agg(F.count("*").alias("url_evidence")))
    both = domains.agg(F.count("*").alias("domain_candidates"), F.count_if(F.col("status") == "VERIFIED").alias("verified_domains"))
    return out.crossJoin(both)  # of one row each
