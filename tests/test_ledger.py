import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sedimark.operators import ledger
from sedimark.streaming import ledger_stream


def simulate(hashes):
    seen, current, out = {}, None, []
    for h in hashes:
        if h == current:
            out.append(("UNCHANGED", seen[h]))
        elif h in seen:
            out.append(("REJECTED", seen[current]))
        else:
            seen[h] = len(seen) + 1
            current = h
            out.append(("OBSERVED" if len(seen) == 1 else "CHANGED", seen[h]))
    return [(s, max(seen[h] for h in hashes[: k + 1])) for k, (s, _) in enumerate(out)]


def test_known_sequence(spark):
    rows = [("p", k, h) for k, h in enumerate("AABBACB")]
    got = ledger.lifecycle(spark.createDataFrame(rows, "posting string, seq int, hash string"), ["posting"]).orderBy("seq").collect()
    assert [r.state for r in got] == ["OBSERVED", "UNCHANGED", "CHANGED", "UNCHANGED", "REJECTED", "CHANGED", "REJECTED"]
    assert [r.revision_no for r in got] == [1, 1, 2, 2, 2, 3, 3]
    again = ledger.lifecycle(spark.createDataFrame(rows, "posting string, seq int, hash string"), ["posting"], revert_policy="new_revision").orderBy("seq").collect()
    assert [r.revision_no for r in again] == [1, 1, 2, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        ledger.lifecycle(spark.createDataFrame(rows, "posting string, seq int, hash string"), ["posting"], revert_policy="x")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text("ABCD", min_size=1, max_size=9), min_size=1, max_size=30))
def test_equals_sequential_model(spark, sequences):
    rows = [(p, k, h) for p, hashes in enumerate(sequences) for k, h in enumerate(hashes)]
    got = ledger.lifecycle(spark.createDataFrame(rows, "posting int, seq int, hash string"), ["posting"]).orderBy("posting", "seq").collect()
    assert [(r.state, r.revision_no) for r in got] == [x for hashes in sequences for x in simulate(hashes)]


def test_append_latest_and_ids(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id long, k string")
    new = spark.createDataFrame([("b",), ("c",), ("d",), ("c",)], "k string")
    added = ledger.append_new(old, new, ["k"])
    assert sorted(r.k for r in added.collect()) == ["c", "d"]
    assert sorted((r.id, r.k) for r in ledger.assign_ids(old, added, [F.asc("k")]).collect()) == [(3, "c"), (4, "d")]
    events = spark.createDataFrame([("x", 1, "S"), ("x", 3, None), ("x", 2, "F"), ("y", 1, "S")], "k string, t int, s string")
    assert sorted((r.k, r.t, r.s) for r in ledger.latest(events, ["k"], "t").collect()) == [("x", 3, None), ("y", 1, "S")]


def test_stream_gives_the_batch_ledger(spark, tmp_path):
    pick = random.Random(4)
    rows = [(pick.randrange(5), k, pick.choice("ABC")) for k in range(60)]
    schema = "posting long, seq long, hash string"
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for k in range(3):
        spark.createDataFrame(rows[20 * k : 20 * k + 20], schema).coalesce(1).write.mode("append").parquet(source)
        ledger_stream.start(spark.readStream.schema(schema).parquet(source), out, str(tmp_path / "check"), ["posting"]).awaitTermination()
    want = ledger.lifecycle(spark.createDataFrame(rows, schema), ["posting"]).select("seq", "state", "revision_no").collect()
    assert sorted(map(tuple, spark.read.parquet(out).select("seq", "state", "revision_no").collect())) == sorted(map(tuple, want))
