"""URL filtering by host-suffix and path-prefix expressions.

A URL is expanded into the expressions of its host and all parent domains with each of its path's prefixes
that end in ``/`` (and the empty one). A rule is filed under the expression of its host and its path up to
the last ``/``. Expressions and rules meet by an equi-join on a short prefix of their SHA-256 digests;
the full digest and the rest of the rule's path then confirm the match, and the longest rule wins (ties:
``block`` before ``allow``). Without a matching rule the verdict is ``allow``.

Only distinct (host, path) pairs are expanded, so a hot URL is judged once; expressions deeper than the
deepest rule are not made, as they cannot match. Rules are broadcast only when a count and their longest text
prove them small; otherwise both sides are dealt out by the hash prefix and a salt, rules once a salt.

Defined results: null URLs and URLs without ``://`` have empty host and path; nulls and repeats in the rules are
ignored; repeated rows are judged as rows of their own; only the named columns and ``keep`` are returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of the digest that rules and expressions are joined on.
PREFIX_DIGITS = 8
#: Rules up to this many characters in all are broadcast.
BROADCAST_CHARS = 8_000_000
SALTS = 32
DEFAULT = "allow"
#: The fixed rules of the registered query: (verdict, host, path).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a URL."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, F.lit("://"))
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), tail


def expression(host: Column, folder: Column) -> Column:
    """Digest of a host and a path prefix; the zero byte occurs in neither."""
    return F.sha2(F.concat(host, F.lit("\x00"), folder), 256)


def folder_of(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)^.*/", 0)


def expand(urls: DataFrame, most_labels: int, most_folders: int) -> DataFrame:
    """``urls(host, path)`` -> a row for each expression, with at most so many labels and slashes."""
    labels = F.split("host", r"\.", -1)
    hosts = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most_labels))), lambda i: F.array_join(F.slice(labels, -i, i), "."))
    parts = F.split("path", "/", -1)
    folders = F.transform(
        F.sequence(F.lit(0), F.least(F.size(parts) - 1, F.lit(most_folders))), lambda i: F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.when(i > 0, F.lit("/")).otherwise(F.lit("")))
    )
    rows = urls.select("host", "path", F.explode(hosts).alias("suffix"), folders.alias("folders"))
    rows = rows.select("host", "path", "suffix", F.explode("folders").alias("folder"))
    return rows.select("host", "path", expression(F.col("suffix"), F.col("folder")).alias("digest"))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict[, keep...]); ``rules(verdict, host, path)``."""
    rules = rules.dropna(subset=["verdict", "host", "path"]).dropDuplicates(["verdict", "host", "path"])
    folder = folder_of(F.col("path"))
    rules = rules.select(
        F.col("verdict"),
        F.concat("host", "path").alias("rule"),
        F.col("path").alias("rule_path"),
        expression(F.col("host"), folder).alias("rule_digest"),
        F.size(F.split("host", r"\.", -1)).alias("labels"),
        (F.size(F.split(folder, "/", -1)) - 1).alias("folders"),
    )
    shape = rules.agg(F.max("labels"), F.max("folders"), F.count(F.lit(1)), F.max(F.length("rule"))).first()
    host, path = host_path(F.col(url_col))
    pages = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), *keep)
    urls = pages.select("host", "path").distinct()
    made = expand(urls, shape[0] or 0, shape[1] or 0) if shape[2] else urls.where("false").withColumn("digest", F.lit(""))
    made = made.withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))
    rules = rules.withColumn("short", F.substring("rule_digest", 1, PREFIX_DIGITS))
    if shape[2] * ((shape[3] or 0) + 200) <= BROADCAST_CHARS:
        met = made.join(F.broadcast(rules), "short")
    else:
        salted = rules.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = made.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int")).join(salted, ["short", "salt"])
    met = met.where((F.col("digest") == F.col("rule_digest")) & F.expr("startswith(path, rule_path)"))
    won = met.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), F.col("verdict"), F.col("rule"))).alias("won"))
    won = won.select("host", "path", F.col("won.rule").alias("rule"), F.col("won.verdict").alias("verdict"))
    out = pages.join(won, ["host", "path"], "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(DEFAULT)).alias("verdict"), *keep)
