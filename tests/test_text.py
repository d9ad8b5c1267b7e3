import re
import sys
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sedimark.functions import hashing, text, urls


def _column(spark, values, f):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, s string").select("i", f(F.col("s")).alias("r")).collect()
    return [r.r for r in sorted(rows, key=lambda r: r.i)]


def test_norm_and_fold_agree_with_python_on_every_letter(spark):
    letters = [chr(c) for c in range(1, 0x2FFF) if not 0xD800 <= c < 0xE000]
    values = [f"a{c}b" for c in letters] + ["\U00010400x", " ACME  Sp. z o.o. ", "  Straße ", None, "ΣΑΣ", "İI"]
    norm = [re.sub(r"\s+", " ", (v or "").strip()) for v in values]
    assert _column(spark, values, text.norm_text) == norm
    got = _column(spark, values, text.norm_key)
    wrong = [(v, g) for v, g, n in zip(values, got, norm) if g != n.casefold()]
    assert not wrong


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=40))
def test_norm_key_of_any_text(spark, values):
    values = [v.replace("\0", "") for v in values]
    values = [v for v in values if all(ord(c) < 0x10000 and not 0xD800 <= ord(c) < 0xE000 for c in v)]
    if values:
        assert _column(spark, values, text.norm_key) == [re.sub(r"\s+", " ", v.strip()).casefold() for v in values]


def test_tokens_and_signatures(spark):
    tokens = {"C++ / C# .NET Dev": ["c++", "c#", ".net", "dev"], "Młodszy Inżynier": ["odszy", "in", "ynier"], "a b c": [], None: [], "Senior Senior dev": ["senior", "dev"]}
    assert _column(spark, list(tokens), text.title_tokens) == list(tokens.values())
    names = {"Ness Solution sp. z o.o.": "ness solution", "Ness Solution": "ness solution", "ACME S.A.": "acme", "X Ltd.": "x", "Żabka Sp. k.": "żabka", "Müller Limited": "m ller", "Spółka": "spółka", None: ""}
    assert _column(spark, list(names), text.org_signature) == list(names.values())


def test_jaccard_and_rounding(spark):
    rows = spark.createDataFrame([([], [], 1), ([], ["x"], 2), (["a", "b", "c"], ["a", "b"], 3)], "a array<string>, b array<string>, i int")
    assert [r.j for r in rows.select("i", text.jaccard(F.col("a"), F.col("b")).alias("j")).orderBy("i").collect()] == [1.0, 0.0, 2 / 3]
    ratios = [(a, b) for b in range(1, 70) for a in range(b + 1)]
    got = spark.createDataFrame(ratios, "a int, b int").select("a", "b", F.bround(F.col("a") / F.col("b"), 4).alias("r")).collect()
    assert all(r.r == round(r.a / r.b, 4) or abs(Fraction(r.a, r.b) - Fraction(str(r.r))) * 20000 == 1 for r in got)


def test_urls(spark):
    cases = {
        "https://justjoin.it/x": None, "https://theprotocol.it/a": None, "https://careers.example.com/jobs/1": "careers.example.com", "https://WWW.Example.com/a": "example.com",
        "http://ex.com.": "ex.com", "https://exa_mple.com/x": "exa_mple.com", "https://u:p@Host.example:81/x?y": "host.example", "no url": None, "https://[::1]:80/": "::1", "https://a b.example/": "a b.example",
    }
    assert _column(spark, list(cases), urls.domain) == list(cases.values())
    assert _column(spark, ["https://a/b/c/?q#f", "https://a/b#x?y"], urls.canonical_url) == ["https://a/b/c/", "https://a/b"]
    assert _column(spark, ["https://a/b/c/?q", "https://a/b//"], urls.last_segment) == ["c", "b"]
    assert _column(spark, ['see HTTP://x.y/z, and <https://q"', None], urls.find_urls) == [["HTTP://x.y/z,", "https://q"], []]
    assert _column(spark, ["/x,oferta,01000000-2F10-afe4-f1b5-08df23ba5ced", "/x"], urls.sitemap_id) == ["01000000-2F10-afe4-f1b5-08df23ba5ced", None]


def test_content_hash_ignores_extras_and_uses_semantic_content(spark):
    rows = spark.createDataFrame([(" T ", "C", "body one", None), ("T", "C  ", "body  one", None), ("T", "C", "other", '{"a":1}'), ("T", "C", "chrome", '{"a":1}'), ("T", "C", "x", '{"a":2}')], "t string, c string, b string, s string")
    got = [r.h for r in rows.select(hashing.content_hash(F.col("t"), F.col("c"), F.col("b"), F.col("s")).alias("h")).collect()]
    assert got[0] == got[1] and got[2] == got[3] and len(set(got)) == 3
    assert sys.version_info >= (3, 11)


def test_latin_texts_fold_as_python_folds(spark):
    rows = [(c, f"A{chr(c)}b{chr(c)}") for c in range(0x250) if not 0xD800 <= c < 0xE000] + [(10_000, "Straße ÀÉÎ ŁÓDŹ"), (10_001, "ΑΣ ß Ǆ"), (10_002, ""), (10_003, None)]
    got = {r.n: r.f for r in spark.createDataFrame(rows, "n int, s string").select("n", text.casefold(F.col("s")).alias("f")).collect()}
    assert got == {n: s if s is None else s.casefold() for n, s in rows}
