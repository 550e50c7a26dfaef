"""Checks of generated queries: read-only, and complete about provenance."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

# Words that write, as whole words in any case.
WRITES = re.compile(r"\b(insert|update|replace|remove|upsert|truncate)\b", re.I)
#: SQL statements that change something.
_COMMANDS = re.compile(r"^\s*(create|drop|alter|delete|merge|load|set|use|refresh|cache|uncache|analyze|grant|revoke)\b", re.I)
#: Functions of these names read; they are followed by a bracket.
_READS = re.compile(r"\b(replace|insert)\s*\(", re.I)


def writes(sql: str) -> str:
    """The word by which a query writes, '' if it reads.

    Words are taken whole, so ``ATLUNARORBITINSERTION`` passes; literals, quoted names and
    comments are not looked at, nor are the string functions that share a name.
    """
    text = re.sub(r"'(?:[^'\\]|\\.)*'|`[^`]*`|--[^\n]*|/\*.*?\*/", " ", sql, flags=re.S)
    text = _READS.sub(" ", text)
    found = WRITES.search(text) or _COMMANDS.search(text)
    return found.group(1).upper() if found else ""


def is_query(spark: SparkSession, sql: str) -> bool:
    """Whether the parsed statement is a query: neither a command nor a statement that writes is its root."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    load = spark._jvm.java.lang.Class.forName
    package = "org.apache.spark.sql.catalyst.plans.logical."
    return not any(load(package + c).isInstance(plan) for c in ("Command", "ParsedStatement"))


def provenance_gap(sql: str | None) -> str:
    """What a query over a population leaves out, '' if nothing.

    A population is a set of entities picked by type or model and then aggregated. It means what
    files declare, so ``source_file`` has to be tested, and ``stated`` where relations are counted.
    """
    if not sql or not re.search(r"\b(from|join)\s+entities\b", sql, re.I):
        return ""
    where = " ".join(re.findall(r"\b(?:where|and|or|on)\b[^\n]*", sql, re.I))
    picks = re.search(r"\bentity_type\s*(=|<=>|\bin\b)|array_contains\s*\(\s*[\w.]*models\b", where, re.I)
    if not picks or not re.search(r"\bgroup\s+by\b|\b(count|count_if|sum|size)\s*\(", sql, re.I):
        return ""
    missing = []
    if "source_file" not in sql:
        missing.append("keep entities with source_file IS NOT NULL, so that only what files declare is counted")
    if re.search(r"\brelationship_type\s*(=|<=>|\bin\b)", sql, re.I) and "stated" not in sql:
        missing.append("keep relations with stated, so that only what files state counts")
    return "The query aggregates a population without its provenance: " + "; ".join(missing) + "." if missing else ""
