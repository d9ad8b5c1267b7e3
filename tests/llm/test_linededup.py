import hashlib
import random
import re

from sedimark.llm import linededup


def slow(rows, min_chars=20, min_docs=3):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    low = lambda i: -(2**63) if i is None else i
    held = {}
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                held.setdefault(k, set()).add(low(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(held.get(key(x), ())) >= min_docs and low(i) < max(held[key(x)]))]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def test_matches_brute_force(spark):
    pick = random.Random(1)
    lines = ["Ünder the käfig of many wordß", "  UNDER the bridge of many words", "short", "", "\r", "x" * 20, "ä" * 19, "  nbsp is not stripped here at all", "long " * 500]
    rows = [(pick.randrange(40), "\n".join(pick.choice(lines) if pick.random() < 0.7 else str(pick.random()) * 3 for _ in range(pick.randrange(1, 9)))) for _ in range(80)]
    rows += [(None, lines[0]), (500, None), (501, ""), (502, lines[0]), (503, "\n\n"), (502, lines[0])]
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, key string, n int")
    for batches, fan in ((4, 2), (1, 2), (7, 3)):
        got = linededup.digests(linededup.dedup_lines(df, batches=batches, fan=fan)).collect()
        assert sorted([tuple(r) for r in got], key=str) == slow(rows)
    assert linededup.dedup_lines(df.limit(0)).count() == 0


def test_rows_that_share_an_id_are_one_document_as_in_the_sql(spark):
    import duckdb
    import pandas as pd

    line, other = "a line of more than twenty letters", "another line of many letters, too"
    rows = [(1, line), (1, line), (2, line + "\n" + other), (None, other), (None, other), (3, other), (4, "x\n" + other), (4, other + "\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in linededup.digests(linededup.dedup_lines(df)).collect()), key=str)
    assert got == slow(rows) and sum(r[2] for r in got) == 4
    base = duckdb.connect()
    base.register("documents", pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], "Int64"), "text": [r[1] for r in rows]}))
    assert got == sorted(base.execute(linededup.ORACLE).fetchall(), key=str)


def test_a_very_long_text_and_columns_named_like_the_results(spark):
    line = "one of a great many lines that stand in one text"
    rows = [(k, "\n".join([line, str(k)] * (200_000 if k == 1 else 1)), k, -k) for k in (1, 2, 3)]
    got = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id int, text string, n_lines int, n_dropped int")).collect()
    assert [(r.n_lines, r.n_dropped) for r in sorted(got)] == [(400_000, 200_000), (2, 1), (2, 0)]


def test_runs_are_read_as_they_lie(spark):
    runs = linededup.LineRuns(spark, 3)
    for i in (2, 1):
        runs.add(spark.range(50).selectExpr(f"{i} AS doc_id", "encode(cast(id AS string), 'utf-8') AS key"))
    plan = runs.runs()[0].join(runs.runs()[1].withColumnRenamed("n", "m").hint("merge"), "key", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    merged = runs._merged(runs.runs())
    assert "Exchange" not in merged._jdf.queryExecution().executedPlan().toString()
    assert merged.where("n = 2 AND top = 2").count() == 50
    runs.drop()


def test_runs_are_compacted_by_level(spark):
    runs = linededup.LineRuns(spark, 2)
    for i in range(5):
        runs.add(spark.createDataFrame([(10 - i, bytes([k])) for k in range(i, i + 3)], "doc_id long, key binary"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    got = {r.key[0]: (r.n, r.top) for r in runs.entries().collect()}
    assert got == {0: (1, 10), 1: (2, 10), 2: (3, 10), 3: (3, 9), 4: (3, 8), 5: (2, 7), 6: (1, 6)}
