import json
from collections import Counter

from sedimark.operators import graph, sinks
from sedimark.sources import files


def _jobs(tmp_path):
    base = {"published_at": "x", "source": {"url": "u"}, "responsibilities": [], "keywords": ["k", "a", "k"], "processes": ["P"], "company": "C"}
    docs = [
        base | {"id": "1", "role": "First", "technologies": [{"name": "T:x", "category": "c", "importance": "core"}, {"name": "U"}, {"name": "T:x"}], "graph_edges": [{"from": "ROLE:a:b", "relation": "R", "to": "plain"}]},
        base | {"id": "2", "role": "Second", "technologies": [], "graph_edges": [{"from": ":x", "relation": "R", "to": "OFFER:9"}, {"from": "TECHNOLOGY:U", "relation": "R", "to": "OFFER:1"}]},
        base | {"id": "1", "role": "Last", "company": "D", "technologies": [{"name": "U"}], "graph_edges": []},
    ]
    for k, d in enumerate(docs):
        (tmp_path / f"{k}.json").write_text(json.dumps(d, indent=1))
    return str(tmp_path), docs


def test_graph_of_job_documents(spark, tmp_path):
    path, docs = _jobs(tmp_path)
    jobs = files.job_documents(spark, path)
    nodes, edges = {}, []
    for d in docs:  # a plain model of the rules
        nodes["OFFER:" + d["id"]] = ("OFFER", d["role"], d["company"])
        own = [("OFFER:" + d["id"], "OFFER_MENTIONS_NODE", "TECHNOLOGY:" + t["name"]) for t in d["technologies"]]
        own += [("OFFER:" + d["id"], "OFFER_MENTIONS_NODE", "PROCESS:" + p) for p in d["processes"]] + [(e["from"], e["relation"], e["to"]) for e in d["graph_edges"]]
        edges += own
        for a, _, b in own:
            for n in (a, b):
                kind, colon, label = n.partition(":")
                nodes.setdefault(n, (kind, label, None) if colon else ("CONCEPT", n, None))
    got = graph.edges(jobs)
    assert [tuple(r) for r in got.orderBy("ordinal", "section", "pos").select("from", "relation", "to").collect()] == edges
    assert {r.id: (r.type, r.label, r.company) for r in graph.nodes(jobs).collect()} == nodes
    whole = sinks.graph_document(jobs).first()
    assert [n.id for n in whole.nodes] == list(nodes)
    assert [(e["from"], e.relation, e.to) for e in whole.edges] == edges
    sinks.write_nodes(graph.nodes(jobs), str(tmp_path / "out"))
    assert [r.id for r in spark.read.json(str(tmp_path / "out")).orderBy("id").collect()] == sorted(nodes)
    sinks.write_edges(got, str(tmp_path / "edges"))
    assert spark.read.json(str(tmp_path / "edges")).count() == len(edges)


def test_ranked_terms_and_report(spark, tmp_path):
    rows = [(k, t) for k, t in enumerate("b a c a b d".split())]
    got = graph.ranked_terms(spark.createDataFrame(rows, "pos int, t string"), "t", ["pos"])
    want = [(k + 1, n, c) for k, (n, c) in enumerate(Counter(t for _, t in rows).most_common())]
    assert [tuple(r) for r in got.orderBy("rank").collect()] == want
    assert sinks.snapshot_markdown(3, {"Technologies": got}, 2) == "# Market snapshot\n\nAnalyzed offers: **3**\n\n## Technologies\n- b: 2\n- a: 2\n"
