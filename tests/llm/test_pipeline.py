import hashlib

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from sedimark.llm import quality
from test_linededup import slow as slow_lines
from test_simhash import alike, slow_components, slow_sketch
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    raw = spark.read.parquet(f"{SF}/documents.parquet").collect()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    extra = [(90_000 + r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in raw[:25]] + [(None, None, None, None, None), (91_000, "", "en", "s", 0)]
    docs = spark.createDataFrame([*map(tuple, raw), *extra], "doc_id long, text string, lang string, source string, n_chars long").withColumn("kept", F.lit(7))
    stages = dict(corpus_pipeline.STAGES)

    scores = {hashlib.sha256((d.text or "").encode()).digest(): r.predicted for d, r in zip(docs.collect(), quality.classify(docs, labels).collect())}
    one = stages["quality_classifier"](spark, docs, SF)
    rows = [tuple(r) for r in one.collect()]
    key = lambda r: str(r[0])
    assert sorted(rows, key=key) == sorted([tuple(r) for r in docs.collect() if scores[hashlib.sha256((r.text or "").encode()).digest()]], key=key)

    two = stages["line_dedup"](spark, one, SF)
    assert two.columns == docs.columns
    lines = [tuple(r) for r in two.collect()]
    want = {(i, k) for i, _, _, k in slow_lines([r[:2] for r in rows])}
    assert {(r[0], hashlib.sha256(r[1].encode()).hexdigest()) for r in lines} == want
    assert all(r[4] == len(r[1]) and r[5] == 7 for r in lines)

    three = stages["simhash_near_dedup"](spark, two, SF)
    ids = [(-1 if r[0] is None else r[0], slow_sketch(r[1])) for r in lines]
    top = slow_components(ids, alike)
    kept = [tuple(r) for r in three.collect()]
    assert sorted(kept, key=key) == sorted([r for r in lines if top[-1 if r[0] is None else r[0]] == (-1 if r[0] is None else r[0])], key=key)

    four = stages["suffix_array_dedup"](spark, three, SF)
    assert four.columns == docs.columns
    last = [tuple(r) for r in four.collect()]
    first = {}
    for r in kept:
        b, i = r[1].encode(), -1 if r[0] is None else r[0]
        for k in range(len(b) - 49):
            first[b[k : k + 50]] = min(first.get(b[k : k + 50], i), i)
    out = []
    for r in kept:
        b, i = r[1].encode(), -1 if r[0] is None else r[0]
        gone = set()
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < i:
                gone.update(range(k, k + 50))
        text = bytes(x for k, x in enumerate(b) if k not in gone).decode("utf-8", "ignore")
        out.append((r[0], text, r[2], r[3], len(text), 7))
    assert sorted(last, key=key) == sorted(out, key=key)

    five = stages["vector_packing"](spark, four, SF)
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = {r[0]: len(lib.encode(r[1], add_special_tokens=False).ids) + 1 for r in last}
    got = {}
    for r in five.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == tokens


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_empty_tables_missing_labels_and_a_very_long_text(spark, tmp_path, monkeypatch):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    none = f"{tmp_path}/none"
    base.limit(0).write.parquet(f"{none}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(f"{none}/labels.parquet")
    assert corpus_pipeline.run(spark, none).count() == 0
    some = f"{tmp_path}/some"
    long = " ".join(f"word{k}" for k in range(200_000))
    rows = [(1, "a few words here", "en", "s", 16), (2, None, None, None, None), (None, long, "en", "s", len(long)), (3, long + " end", "en", "s", len(long) + 4)]
    spark.createDataFrame(rows, base.schema).coalesce(2).write.parquet(f"{some}/documents.parquet")
    spark.createDataFrame([(1, None, 0), (None, 1, 0), (2, 5, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{some}/labels.parquet")
    got = corpus_pipeline.run(spark, some).collect()
    # without usable labels all stay (score 0.5); the long text's near copy goes
    assert {r.doc_id for r in got} == {None, 1, 2}
    assert sum(r.length for r in got if r.doc_id == 2) == 1
