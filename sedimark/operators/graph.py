"""Property graph and term frequencies of analysed documents.

Input: documents (id, role, company, technologies array<struct<name>>, processes array<string>, keywords array<string>,
graph_edges array<struct<from, relation, to>>, ordinal). The ordinal gives the order of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimark.operators.scratch import global_rank


def term_counts(terms: DataFrame, name: str, order: list[str]) -> DataFrame:
    """(name, count, first): occurrences of each term and its first place (a struct of ``order``)."""
    return terms.groupBy(F.col(name).alias("name")).agg(F.count("*").alias("count"), F.min(F.struct(*order)).alias("first"))


def ranked_terms(terms: DataFrame, name: str, order: list[str]) -> DataFrame:
    """(rank, name, count): most frequent first, ties in the order of first encounter."""
    return global_rank(term_counts(terms, name, order), [F.desc("count"), F.asc("first")]).select("rank", "name", "count")


def edges(docs: DataFrame) -> DataFrame:
    """(from, relation, to, ordinal, section, pos): mentions of technologies, of processes, then explicit edges; repeats stay."""
    offer = F.concat(F.lit("OFFER:"), F.col("id"))

    def mention(array: Column, kind: str, section: int) -> DataFrame:
        found = docs.select("ordinal", offer.alias("from"), F.posexplode(array).alias("pos", "name"))
        return found.select("from", F.lit("OFFER_MENTIONS_NODE").alias("relation"), F.concat(F.lit(kind + ":"), "name").alias("to"), "ordinal", F.lit(section).alias("section"), "pos")

    explicit = docs.select("ordinal", F.posexplode("graph_edges").alias("pos", "e")).select("e.from", "e.relation", "e.to", "ordinal", F.lit(2).alias("section"), "pos")
    return mention(F.col("technologies.name"), "TECHNOLOGY", 0).unionByName(mention(F.col("processes"), "PROCESS", 1)).unionByName(explicit)


def node_type(node: Column) -> Column:
    """What stands before the first colon, CONCEPT where there is none."""
    return F.when(F.instr(node, ":") > 0, F.substring_index(node, ":", 1)).otherwise("CONCEPT")


def node_label(node: Column) -> Column:
    return F.when(F.instr(node, ":") > 0, F.substr(node, F.instr(node, ":") + F.lit(1))).otherwise(node)


def offer_nodes(docs: DataFrame) -> DataFrame:
    """(id, type, label, company): one node for each document id, the last document wins."""
    last = docs.groupBy("id").agg(F.max_by(F.struct("role", "company"), "ordinal").alias("last"))
    return last.select(F.concat(F.lit("OFFER:"), "id").alias("id"), F.lit("OFFER").alias("type"), F.col("last.role").alias("label"), F.col("last.company").alias("company"))


def nodes(docs: DataFrame, all_edges: DataFrame | None = None) -> DataFrame:
    """(id, type, label, company): nodes of documents and of all edge ends; a document's own node wins.

    A node that is no document's depends on its id alone, so distinct ids are enough.
    """
    all_edges = edges(docs) if all_edges is None else all_edges
    offers = offer_nodes(docs)
    ends = all_edges.select(F.explode(F.array("from", "to")).alias("id")).distinct()
    ends = ends.join(offers.select("id"), "id", "left_anti")
    return offers.unionByName(ends.select("id", node_type(F.col("id")).alias("type"), node_label(F.col("id")).alias("label"), F.lit(None).cast("string").alias("company")))


def first_seen(docs: DataFrame) -> DataFrame:
    """(id, first): where each node first occurs in reading order, documents before their mentions."""
    place = F.struct("ordinal", "section", "pos", "end")
    ends = edges(docs).select(F.posexplode(F.array("from", "to")).alias("end", "id"), "ordinal", "section", "pos")
    own = docs.select(F.concat(F.lit("OFFER:"), "id").alias("id"), "ordinal", F.lit(-1).alias("section"), F.lit(0).alias("pos"), F.lit(0).alias("end"))
    return own.unionByName(ends.select("id", "ordinal", "section", "pos", "end")).groupBy("id").agg(F.min(place).alias("first"))
