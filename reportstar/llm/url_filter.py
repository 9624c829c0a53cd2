"""URL filters: host-suffix and path-prefix expressions against a table of rules.

A URL is cut into host (after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased) and path (from
there up to ``?``, ``#`` or the end). A rule ``(host, path, action)`` fits its host and all subdomains, if the path of the
URL starts with the rule's. Each URL is expanded into expressions: a suffix of its host and a prefix of its path. Just
the shapes that occur among the rules are made: labels of the host, slashes of the path, and characters behind the last
slash, cut down to a power of two, so that there are few shapes whatever the number of rules. Expressions meet rules
on the first ``PREFIX`` digits of their SHA-256; then the full digest and the rule's whole path are compared.

Of the rules that fit, the longest (host and path together) wins; of equal ones the one with the longer host, then ``block``. Where no rule
fits, the verdict is ``allow``: this is a list of exceptions, not of permitted sites.

Defined cases: a URL that is NULL or has no ``://`` has an empty host and path, and an empty host meets only rules for an
empty host. Empty labels and ports are part of the host as they stand. Rules with a NULL in any column are no rules;
repeated rules count once. Repeated URLs get the same verdict each. An empty table gives an empty one; without
rules every verdict is ``allow``. Other columns pass through; a column that has the name of a result is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportstar.llm.common import free_name, with_row_key
from reportstar.operators.lookup import BROADCAST_BYTES, BROADCAST_ROWS, stage_measured

#: Hexadecimal digits of a digest that take part in the join.
PREFIX = 8
DEFAULT = "allow"
RESULTS = ("host", "path", "rule", "verdict")

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and nothing else."""
    return F.translate(text, _UPPER, _UPPER.lower())


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL, both empty where it is NULL or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _upto_slash(path: Column, slashes: Column) -> Column:
    """The path up to and with its ``slashes``-th slash."""
    head = F.call_function("substring_index", path, F.lit("/"), slashes)
    return F.when(slashes > 0, F.concat(head, F.lit("/"))).otherwise(F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    # Neither host nor path of a URL holds a question mark.
    return F.sha2(F.concat(host, F.lit("?"), path), 256)


def _expression(host: Column, path: Column, shape: Column) -> Column:
    """Digest of the expression of that shape, NULL where the URL is too short for it."""
    suffix = F.call_function("substring_index", host, F.lit("."), -shape["labels"])
    head = _upto_slash(path, shape["slashes"])
    chars = F.length(head) + shape["more"]
    long_enough = (_count(host, ".") + 1 >= shape["labels"]) & (_count(path, "/") >= shape["slashes"]) & (F.length(path) >= chars)
    return F.when(long_enough, _digest(suffix, F.substr(path, F.lit(1), chars)))


def prepare_rules(rules: DataFrame) -> DataFrame:
    """Distinct rules with their shape, the digest of their expression and its first digits."""
    rules = rules.select(lower(F.col("host")).alias("host"), "path", "action").dropna().distinct()
    slashes = _count(F.col("path"), "/")
    behind = F.length("path") - F.length(_upto_slash(F.col("path"), slashes))
    more = F.when(behind > 0, F.pow(F.lit(2), F.floor(F.log2(behind)))).otherwise(0).cast("int")
    shape = F.struct((_count(F.col("host"), ".") + 1).alias("labels"), slashes.alias("slashes"), more.alias("more"))
    rules = rules.withColumn("shape", shape)
    chars = F.length(_upto_slash(F.col("path"), slashes)) + F.col("shape.more")
    rules = rules.withColumn("digest", _digest(F.col("host"), F.substr("path", F.lit(1), chars)))
    return rules.withColumn("start", F.left("digest", F.lit(PREFIX)))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``; the number of rows stays.

    ``pages`` must be a scan or a staged table; leave wide columns out, since its rows are shuffled once.
    The rules are stored and measured. Up to ``max_rows`` and ``max_bytes`` they are broadcast; beyond, expressions and rules are
    shuffled by the first digits, and adaptive execution splits an expression that very many URLs have. An expression
    travels with the row's number and the path only; the best rule of a URL is reduced before its shuffle.
    """
    row, other = free_name(pages, "url_row"), free_name(pages, "url_best_row")
    stored, n, size = stage_measured(prepare_rules(rules), "url_rules")
    # Bounded by how rules are written (labels x slashes x powers of two), not by their number.
    shapes = [r["shape"] for r in stored.select("shape").distinct().collect()]
    host, path = host_and_path(F.col(f"`{url}`").cast("string"))
    keep = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in RESULTS]
    keyed = with_row_key(pages, row).select(*keep, row, host.alias("host"), path.alias("path"))
    if not shapes:
        return keyed.drop(row).withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(DEFAULT)})
    known = F.array(*(F.struct(*(F.lit(v).cast("int").alias(k) for k, v in s.asDict().items())) for s in shapes))
    made = F.explode(F.transform(known, lambda s: _expression(F.col("host"), F.col("path"), s)))
    made = keyed.select(F.col(row).alias(other), "path", made.alias("digest")).filter("digest is not null")
    lookup = stored.select(*(F.col(c).alias(f"rule_{c}") for c in ("host", "path", "action", "digest", "start")))
    if n <= max_rows and size <= max_bytes:
        lookup = F.broadcast(lookup)
    met = made.join(lookup, F.left("digest", F.lit(PREFIX)) == F.col("rule_start"))
    met = met.filter((F.col("digest") == F.col("rule_digest")) & F.startswith("path", F.col("rule_path")))
    rank = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("chars"), F.length("rule_host").alias("host_chars"),
        F.col("rule_action").alias("action"), F.concat("rule_host", "rule_path").alias("rule"),
    )
    best = met.groupBy(other).agg(F.max(rank).alias("best"))
    judged = keyed.join(best, F.col(row) == F.col(other), "left")
    verdict = F.coalesce("best.action", F.lit(DEFAULT))
    return judged.select(*keep, "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"))
