"""Command line: python -m sedimark.cli COMMAND ...; every command reads and writes folders that Spark can reach."""

from __future__ import annotations

import argparse
import json
import sys
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimark import batch, schemas
from sedimark.operators import enrichment, er, graph, ledger, orgs, quality, sinks, store
from sedimark.operators.scratch import cut
from sedimark.sources import api, boards, files


def _write(path: str | None, value: dict) -> None:
    """A report: printed, and written where a path is given."""
    text = json.dumps(value, ensure_ascii=False, indent=2, default=str)
    print(text)
    if path:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        Path(path).write_text(text + "\n", encoding="utf-8")


def build_graph(spark: SparkSession, args: argparse.Namespace) -> int:
    """Job documents to nodes, edges and the frequency report."""
    docs = files.job_documents(spark, args.jobs)
    edges = graph.edges(docs)
    sinks.write_nodes(graph.nodes(docs, edges), f"{args.out}/nodes")
    sinks.write_edges(edges, f"{args.out}/edges")
    terms = {}
    for title, column in (("Technologies", F.col("technologies.name")), ("Processes", F.col("processes")), ("Keywords", F.col("keywords"))):
        each = docs.select("ordinal", F.posexplode(column).alias("pos", "term"))
        terms[title] = graph.ranked_terms(each, "term", ["ordinal", "pos"])
    print(sinks.snapshot_markdown(docs.count(), terms), end="")
    return 0


def run_ledger(spark: SparkSession, args: argparse.Namespace) -> int:
    """Observations (Parquet with the posting keys, seq and hash) to states, appended by run."""
    rows = spark.read.parquet(args.observations)
    keys = args.keys.split(",")
    states = ledger.lifecycle(rows, keys, revert_policy=args.revert_policy)
    states.withColumn("run_id", F.lit(args.run_id)).write.mode("append").partitionBy("run_id").parquet(args.out)
    print(json.dumps({r["state"]: r["n"] for r in states.groupBy("state").agg(F.count("*").alias("n")).collect()}))
    return 0


def migrate(spark: SparkSession, args: argparse.Namespace) -> int:
    """Creates what a folder of tables lacks, and prints the versions applied."""
    for version in store.migrate(store.Store(spark, args.tables)):
        print(version)
    return 0


def run_batch(spark: SparkSession, args: argparse.Namespace) -> int:
    """Discovers, fetches and ingests postings of the named sources into a folder of tables."""
    calls = {code: api.http_call for code in filter(None, args.api.split(","))}
    run_id = args.run_id or str(uuid.uuid4())
    report, pinned = batch.run(store.Store(spark, args.tables), run_id, args.sources.split(","), args.limit_per_source, args.trigger_kind, args.delay, args.manifest_in, calls)
    if args.manifest_out:
        Path(args.manifest_out).parent.mkdir(parents=True, exist_ok=True)
        Path(args.manifest_out).write_text(json.dumps(pinned, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
    _write(args.report, report)
    return 0


def _enrich_tables(spark: SparkSession, args: argparse.Namespace) -> int:
    held = store.Store(spark, args.tables)
    held.save(enrichment.enrich_changes(held.state(), F.current_timestamp()))
    _write(args.report, enrichment.enrichment_report(held.state()))
    return 0


def enrich(spark: SparkSession, args: argparse.Namespace) -> int:
    """A folder of tables: evidence and domain candidates of its current revisions, added to it.

    Or payloads (id, organization_id, payload, normalized_projection_json where there is one) to URL evidence and domain
    candidates. The payload may also be named source_projection_json, as in the revisions.
    """
    if args.tables:
        return _enrich_tables(spark, args)
    rows = spark.read.parquet(args.payloads)
    leaves = orgs.json_leaves(rows, "id", "payload" if "payload" in rows.columns else "source_projection_json")
    if "normalized_projection_json" in rows.columns:
        leaves = leaves.unionAll(orgs.json_leaves(rows, "id", "normalized_projection_json", "normalized_projection"))
    found = orgs.url_evidence(leaves, "id").join(rows.select("id", "organization_id"), "id")
    found.write.mode("overwrite").parquet(f"{args.out}/evidence")
    orgs.domain_candidates(found, "organization_id").write.mode("overwrite").parquet(f"{args.out}/domains")
    return 0


def _pairs_of_tables(spark: SparkSession, args: argparse.Namespace) -> int:
    held = store.Store(spark, args.tables)
    changes, counts = enrichment.pair_changes(held.state(), F.current_timestamp(), args.limit_pairs)
    held.save(changes)
    corpus = enrichment.pair_corpus(held.state())
    corpus.orderBy("pair_id").write.mode("overwrite").json(args.out)
    _write(args.summary, counts | enrichment.pair_report(corpus))
    return 0


def er_eval(spark: SparkSession, args: argparse.Namespace) -> int:
    """A folder of tables: new review pairs, added to it, the whole corpus and its summary. Or a table of postings to both."""
    if args.tables:
        return _pairs_of_tables(spark, args)
    postings = spark.read.parquet(args.postings)
    kinds = er.classes(postings)
    counted = cut(er.levels(er.class_pairs(kinds)))
    chosen = er.with_features(er.review_selection(er.leading_pairs(postings, args.limit_pairs, kinds, counted), args.limit_pairs), postings)
    sinks.write_corpus(chosen, args.out)
    print(json.dumps(er.summary(counted, chosen, postings).first().asDict()))
    return 0


def _report(result: DataFrame, report: str | None, summary: dict) -> int:
    rows = [r.asDict() for r in result.collect()]
    failures = [f"{r['check_name']}: expected {r['op']} {r['expected']}, got {r['actual']}" for r in rows if not r["ok"]]
    _write(report, {"pass": not failures, "failures": failures, "summary": summary, "checks": rows})
    return 1 if failures else 0


def verify(spark: SparkSession, args: argparse.Namespace) -> int:
    """The crawl, production or organisation gate over a folder of tables; exit code 1 on failure."""
    held = store.Store(spark, args.tables)
    t, sources = held.table, args.sources.split(",")
    whole = store.summary(held.state()) if not held.missing() else {}
    if args.gate == "crawl":
        return _report(quality.crawl_gate(t("job_posting"), t("posting_lifecycle_observation"), t("job_posting_revision"), sources, args.expected), args.report, whole)
    if args.gate == "production":
        names = ("job_posting", "job_posting_revision", "raw_observation", "ingestion_run", "ingestion_item", "posting_lifecycle_observation", "organization_candidate", "match_candidate")
        return _report(quality.production_gate({n: t(n) for n in names}, sources, args.expected), args.report, whole | {"migrations": len(schemas.MIGRATIONS) if whole else 0})
    pairs = t("er_eval_pair")
    pairs = pairs.withColumnsRenamed({"posting_a_id": "a_id", "posting_b_id": "b_id"})
    evidence = t("organization_evidence")
    label = lambda name, basis: pairs.where((F.col("proposed_label") == name) & (F.col("label_basis") == basis)).count()
    extra = {"organization_evidence": evidence.count(), "er_eval_pairs": pairs.count(), "auto_same": label("SAME_OPPORTUNITY", "AUTO_DECISIVE"), "auto_distinct": label("DISTINCT_OPPORTUNITY", "AUTO_COUNTER"), "unresolved": pairs.where("proposed_label = 'UNRESOLVED'").count()}
    return _report(quality.org_er_gate(t("job_posting"), t("organization_mention"), evidence, pairs, args.expected), args.report, whole | extra)


def query(spark: SparkSession, args: argparse.Namespace) -> int:
    """One registered query over a folder of benchmark tables."""
    from sedimark.plans import catalogue

    catalogue.QUERIES[args.name](spark, args.tables).write.mode("overwrite").parquet(args.out)
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sedimark", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, run, /, **options) -> None:  # noqa: ANN001
        p = sub.add_parser(name, help=run.__doc__)
        p.set_defaults(run=run)
        for option, kind in options.items():
            p.add_argument("--" + option.replace("_", "-"), **kind)

    need = {"required": True}
    command("build-graph", build_graph, jobs=need, out=need)
    command("ledger", run_ledger, observations=need, out=need, run_id=need, keys={"default": "source_code,source_posting_id"}, revert_policy={"default": "reject", "choices": ["reject", "new_revision"]})
    command("migrate", migrate, tables=need)
    command(
        "batch", run_batch, tables=need, sources={"default": ",".join(sorted(boards.ADAPTERS, reverse=True))}, api={"default": "", "help": "sources that are read by API"}, run_id={"default": None}, trigger_kind={"default": "manual"},
        limit_per_source={"type": int, "default": 50}, delay={"type": float, "default": 0.2}, manifest_in={"default": None}, manifest_out={"default": None}, report={"default": None},
    )
    command("enrich", enrich, tables={"default": None}, payloads={"default": None}, out={"default": None}, report={"default": None})
    command("er-eval", er_eval, tables={"default": None}, postings={"default": None}, out=need, limit_pairs={"type": int, "default": 200}, summary={"default": None})
    command("verify", verify, gate={"required": True, "choices": ["crawl", "production", "org-er"]}, tables=need, sources=need, expected={"type": int, "required": True}, report={"default": None})
    command("query", query, name=need, tables=need, out=need)
    return top


def main(argv: list[str]) -> int:
    args = parser().parse_args(argv)
    return args.run(SparkSession.builder.appName("sedimark").getOrCreate(), args)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
