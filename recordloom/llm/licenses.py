"""Licence scan by canonical digests: a whole text, put in canonical form, is looked up among known licences.

Canonical form: case, copyright lines, punctuation and spellings that count as equal are made alike.
The same form of every line is looked up too, so that notices inside longer
texts are told. All of it is column expressions; the known digests are a constant, tiny table.
"""

from __future__ import annotations

import functools
import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .known_licenses import FULL_TEXTS, LICENSES, SPELLINGS

COPYRIGHT = r"[^a-z0-9\n]*(?:copyright[ \t]*(?:\(c\)|©|[0-9]{4})|\(c\)[ \t]*[0-9]{4}|©|all rights reserved)[^\n]*"
PUNCTUATION = r"[\x00-\x2F\x3A-\x60\x7B-\x7F\u2010-\u2015\u2018-\u201F\u2022\u00A0\u00AB\u00B7\u00BB]+"


def canonical(text: Column) -> Column:
    """A text in canonical form; null counts as empty."""
    out = F.regexp_replace(F.concat(F.lit("\n"), F.lower(F.coalesce(text, F.lit("")))), r"\n" + COPYRIGHT, F.lit("\n"))
    out = F.trim(F.regexp_replace(out, PUNCTUATION, F.lit(" ")))
    for spelling, other in SPELLINGS:
        out = F.replace(out, F.lit(spelling), F.lit(other))
    return out


def plain_canonical(text: str | None) -> str:
    """The same in plain Python, for the constant table."""
    out = re.sub(PUNCTUATION, " ", re.sub(r"\n" + COPYRIGHT, "\n", "\n" + (text or "").lower())).strip(" ")
    return functools.reduce(lambda s, pair: s.replace(*pair), SPELLINGS, out)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


@functools.cache
def known() -> dict[str, str]:
    """Canonical digest to licence id."""
    return {hashlib.sha256(plain_canonical(text).encode()).hexdigest(): name for name, text in LICENSES}


@functools.cache
def openings() -> str:
    """What a lower-case line that has a known canonical form must start with.

    Spellings share their first three characters with what they count as, so those of a form are those of its line.
    """
    starts = sorted({plain_canonical(text)[:3] for _, text in LICENSES})
    return f"^(?:{PUNCTUATION})?(?:{'|'.join(x.replace(' ', PUNCTUATION) for x in starts)})"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: (id_col, canonical_sha256, license_id, notices, n_notices).

    license_id: the known licence that the entire text is, else null. notices: licence ids of its lines,
    distinct and sorted, joined by commas, null if there are none; n_notices counts the lines. A null text
    counts as empty, whose digest no licence has; texts and lines of any length are read whole; no two
    licences share a digest, so nothing ties. Null ids and repeated rows are scanned like others; an empty
    table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    digests = spark.createDataFrame(sorted((known() | {d: name for name, d in FULL_TEXTS}).items()), "canonical_sha256 string, license_id string")
    lookup = F.create_map(*(F.lit(x) for pair in sorted(known().items()) for x in pair))
    lines = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), lambda x: F.lower(x).rlike(openings()))
    found = F.filter(F.transform(lines, lambda x: F.try_element_at(lookup, digest(x))), lambda x: x.isNotNull())
    rows = docs.select(F.col(id_col), digest(F.col(text_col)).alias("canonical_sha256"), found.alias("__found"))
    rows = rows.join(F.broadcast(digests), "canonical_sha256", "left")
    notices = F.array_join(F.array_sort(F.array_distinct("__found")), ",")
    return rows.select(id_col, "canonical_sha256", "license_id", F.when(F.size("__found") > 0, notices).alias("notices"), F.size("__found").cast("long").alias("n_notices"))


def sql() -> str:
    """The same over ``documents`` in DuckDB's SQL."""

    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def form(x: str) -> str:
        spaces = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F\\x{2010}-\\x{2015}\\x{2018}-\\x{201F}\\x{2022}\\x{A0}\\x{AB}\\x{B7}\\x{BB}]+"
        out = f"trim(regexp_replace(regexp_replace(chr(10) || lower(coalesce({x}, '')), {text(chr(92) + 'n' + COPYRIGHT)}, chr(10), 'g'), {text(spaces)}, ' ', 'g'), ' ')"
        for spelling, other in SPELLINGS:
            out = f"replace({out}, {text(spelling)}, {text(other)})"
        return f"sha256({out})"

    values = lambda table: ", ".join(f"({text(d)}, {text(n)})" for d, n in sorted(table.items()))
    return f"""
WITH known(canonical_sha256, license_id) AS (VALUES {values(known())}),
entire(canonical_sha256, license_id) AS (VALUES {values(known() | {d: name for name, d in FULL_TEXTS})}),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
notices AS (
  SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices, count(*) AS n_notices
  FROM (SELECT doc_id, {form("line")} AS canonical_sha256 FROM lines) JOIN known USING (canonical_sha256) GROUP BY doc_id
)
SELECT d.doc_id, d.canonical_sha256, k.license_id, n.notices, CAST(coalesce(n.n_notices, 0) AS BIGINT) AS n_notices
FROM (SELECT doc_id, {form("text")} AS canonical_sha256 FROM documents) d
LEFT JOIN entire k USING (canonical_sha256) LEFT JOIN notices n USING (doc_id)
"""
