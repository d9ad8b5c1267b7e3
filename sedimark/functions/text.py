"""Text normalisation and name features as column expressions."""

from __future__ import annotations

import sys
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that normalisation collapses, the seniority words, the legal forms that a name's
# signature leaves out (in this order), and the letters a signature keeps.
SPACE = "\\s\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SENIORITY = ("junior", "mid", "middle", "senior", "lead", "staff", "principal", "intern", "trainee")
LEGAL_FORMS = (
    r"\bspółka z ograniczoną odpowiedzialnością\b",
    r"\bsp\.?\s*z\.?\s*o\.?\s*o\.?\b",
    r"\bspółka komandytowa\b",
    r"\bsp\.?\s*k\.?\b",
    r"\bs\.?\s*a\.?\b",
    r"\bltd\.?\b",
    r"\blimited\b",
)
SIGNATURE_LETTERS = "a-z0-9ąćęłńóśźż"
TOKEN = "[a-zA-Z0-9+#.]+"


@lru_cache(1)
def fold_tables() -> tuple[str, str, dict[str, str]]:
    """Letters that case folding replaces one by one, what they become, and the folds of several letters."""
    one, long = {}, {}
    for c in map(chr, range(sys.maxunicode + 1)):
        if (fold := c.casefold()) != c:
            (one if len(fold) == 1 else long)[c] = fold
    return "".join(one), "".join(one.values()), long


def norm_text(s: Column) -> Column:
    """Null as empty, runs of Unicode white space as one space, ends trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(s, F.lit("")), f"[{SPACE}]+", " "))


def near_class(letters: dict[str, str]) -> str:
    """A pattern of a few ranges that hold all the letters: a class of many single ones is slow to test."""
    ranges: list[list[str]] = []
    for c in sorted(letters):
        if ranges and ord(c) - ord(ranges[-1][1]) <= 64:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "[" + "".join(f"{a}-{b}" for a, b in ranges) + "]"


#: Texts of these letters fold as they are lower-cased, but for sharp s: Latin without the letters that fold otherwise.
_LATIN = "\\A[\\x00-\\xb4\\xb6-\\u012f\\u0131-\\u0148\\u014a-\\u017e]*\\z"


def casefold(s: Column) -> Column:
    """Full case folding, by Python's tables and not the JVM's, which may know other letters.

    Latin texts are lower-cased. In others most letters become one other; sharp s is replaced in place; the few others
    that fold to several are looked up letter by letter, and only in texts that have one.
    """
    before, after, long = fold_tables()
    sharp = {c: f for c, f in long.items() if f == "ss"}
    rest = {c: f for c, f in long.items() if c not in sharp}
    table = F.create_map(*[F.lit(x) for pair in rest.items() for x in pair])

    def letters(x: Column) -> Column:
        each = F.transform(F.split(x, ""), lambda c: F.coalesce(F.element_at(table, c), c))
        return F.when(x.rlike(near_class(rest)), F.array_join(each, "")).otherwise(x)

    def folded(x: Column) -> Column:
        out = F.translate(x, before, after)
        for c, f in sharp.items():
            out = F.replace(out, F.lit(c), F.lit(f))
        whole = F.transform(F.array(out), letters)[0]  # so that the folded text is computed once
        return F.when(x.rlike(_LATIN), F.replace(F.lower(x), F.lit("ß"), F.lit("ss"))).otherwise(whole)

    return F.transform(F.array(s), folded)[0]


def norm_key(s: Column) -> Column:
    return casefold(norm_text(s))


def title_tokens(title: Column) -> Column:
    """Distinct lower-cased runs of ASCII letters, digits, '+', '#' and '.', of two characters or more."""
    found = F.regexp_extract_all(F.coalesce(title, F.lit("")), F.lit(TOKEN), 0)
    return F.array_distinct(F.transform(F.filter(found, lambda x: F.length(x) > 1), F.lower))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all tokens; 1 if both sets are empty. Takes sets (arrays without repeats)."""
    shared = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(shared / (F.size(a) + F.size(b) - shared))


def seniority(tokens: Column) -> Column:
    return F.array_sort(F.array_intersect(tokens, F.array(*map(F.lit, SENIORITY))))


def org_signature(name: Column) -> Column:
    """A name's key without punctuation, foreign letters and legal forms."""
    out = F.regexp_replace(norm_key(name), f"[^{SIGNATURE_LETTERS}]+", " ")
    for form in LEGAL_FORMS:
        out = F.regexp_replace(out, "(?iU)" + form, " ")
    return F.trim(F.regexp_replace(out, " +", " "))
