"""Writers of graphs, reports and corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimark.operators import graph


def write_nodes(nodes: DataFrame, path: str) -> None:
    """JSON lines ordered by id, over as many files as partitions: their names follow the order."""
    nodes.orderBy("id").write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def write_edges(edges: DataFrame, path: str) -> None:
    """JSON lines in the order of generation, repeats included."""
    edges.orderBy("ordinal", "section", "pos").select("from", "relation", "to").write.mode("overwrite").json(path)


def graph_document(docs: DataFrame) -> DataFrame:
    """One row with the whole graph, nodes in first-seen order: for graphs that fit one record."""
    edges = graph.edges(docs)
    nodes = graph.nodes(docs, edges).join(graph.first_seen(docs), "id")
    n = nodes.agg(F.array_sort(F.collect_list(F.struct("first", F.struct("id", "type", "label", "company").alias("node")))).alias("n")).select(F.transform("n", lambda x: x["node"]).alias("nodes"))
    e = edges.agg(F.array_sort(F.collect_list(F.struct("ordinal", "section", "pos", F.struct("from", "relation", "to").alias("edge")))).alias("e")).select(F.transform("e", lambda x: x["edge"]).alias("edges"))
    return n.crossJoin(e)  # of one row each


def snapshot_markdown(offers: int, terms: dict[str, DataFrame], most: int | None = None) -> str:
    """The report as text; ``terms``: title -> (rank, name, count). ``most`` limits each list."""
    lines = ["# Market snapshot", "", f"Analyzed offers: **{offers}**"]
    for title, ranked in terms.items():
        ranked = ranked.orderBy("rank")
        rows = (ranked.limit(most) if most else ranked).toLocalIterator()
        lines += ["", f"## {title}", *(f"- {r['name']}: {r['count']}" for r in rows)]
    return "\n".join(lines) + "\n"


def write_corpus(pairs: DataFrame, path: str) -> None:
    """Review pairs as JSON lines in the order of their ids."""
    pairs.orderBy("a_id", "b_id").write.mode("overwrite").json(path)


def write_ledger(df: DataFrame, path: str, *partitions: str) -> None:
    """Appends to a ledger of Parquet files, partitioned for pruning."""
    df.write.mode("append").partitionBy(*partitions).parquet(path)
