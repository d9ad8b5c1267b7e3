"""Canonical JSON and content digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sedimark.functions.text import norm_text


def canonical_json(**fields: Column) -> Column:
    """Compact JSON of the fields in the order of their names, nulls kept."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def payload_hash(body: Column) -> Column:
    return F.sha2(F.coalesce(body, F.lit("")), 256)


def evidence_key(value_json: Column) -> Column:
    """What makes a fact of a mention unique: the MD5 of its value as JSON text."""
    return F.md5(value_json)


def projection_json(title: Column, company: Column, body: Column, semantic: Column | None = None) -> Column:
    """The normalised projection: title and company, and the semantic content (JSON), or else the whole body."""
    plain = canonical_json(title=norm_text(title), company_mention=norm_text(company), body_text=norm_text(body))
    if semantic is None:
        return plain
    first, last = canonical_json(company_mention=norm_text(company)), canonical_json(title=norm_text(title))
    rich = F.concat(F.left(first, F.length(first) - 1), F.lit(',"semantic_content":'), semantic, F.lit(","), F.substring(last, 2, 1 << 30))
    return F.when(semantic.isNotNull(), rich).otherwise(plain)


def content_hash(title: Column, company: Column, body: Column, semantic: Column | None = None) -> Column:
    """What a revision is recognised by; source-specific extras never take part."""
    return F.sha2(projection_json(title, company, body, semantic), 256)


def archive_key(source: Column, posting: Column, digest: Column) -> Column:
    return F.concat_ws("/", source, posting, digest)
