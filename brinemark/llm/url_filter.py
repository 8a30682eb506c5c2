"""Allow and block lists over URLs, by host-suffix and path-prefix expressions.

Each URL is expanded into the strings host suffix + folder prefix; their SHA-256
prefixes meet the rules' in an equi-join, the full digests confirm, and of the
rules that fit the longest wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brinemark.llm.columns import ascii_lower, packed, quoted

PREFIX_HEX = 8
OUTPUT = ("host", "path", "rule", "verdict")


def host_of(url) -> Column:
    """A-Z lower-cased text after the first ``://`` up to ``/``, ``?``, ``#`` or the end; else empty."""
    url = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1))


def path_of(url) -> Column:
    """Text after the host up to ``?``, ``#`` or the end; else empty."""
    url = F.coalesce(url, F.lit(""))
    return F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def folder_of(path) -> Column:
    """``path`` up to its last slash."""
    return F.regexp_extract(path, r"^(?s:.*)/", 0)


def _digest(text) -> Column:
    return F.sha2(text, 256)


def expressions(host, path, max_labels: int, max_slashes: int) -> Column:
    """Every host suffix of up to ``max_labels`` labels with every folder prefix of up to ``max_slashes`` slashes.

    The limits are those of the rule set, so no expression that a rule can have is left out.
    """
    labels, parts = F.split(host, r"\."), F.split(path, "/")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max_labels))),
        lambda k: F.array_join(F.slice(labels, -k, k), "."))
    folders = F.transform(
        F.sequence(F.lit(0), F.least(F.size(parts) - 1, F.lit(max_slashes))),
        lambda k: F.when(k == 0, "").otherwise(F.concat(F.array_join(F.slice(parts, 1, k), "/"), F.lit("/"))))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(folders, lambda f: F.concat(s, f))))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, the ``rule`` that decides (host + path, else NULL) and the ``verdict``.

    ``rules``: host, path, verdict. A rule fits a URL whose host is the rule's or a
    subdomain of it and whose path starts with the rule's. Of several the longest
    string wins, then the longer host, then ``block``. Where none fits the verdict
    is ``default``. Rules with a NULL host, path or verdict are void; repeated ones count once.

    A NULL URL, or one without ``://``, has an empty host and path and fits no rule.
    Every input row gives one row; input columns named like an output column are replaced.

    URLs are judged once per distinct (host, path), so that a hot host is merged
    before the shuffle; the join back is a plain left join, which AQE splits.
    """
    known = rules.where(
        F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull() & (F.col("host") != "")
    ).select(ascii_lower("host").alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict")).distinct()
    bounds = known.agg(
        F.max(F.size(F.split("r_host", r"\."))).alias("labels"), F.max(F.size(F.split("r_path", "/")) - 1).alias("slashes"),
    ).first()
    keyed = known.withColumn("r_digest", _digest(F.concat("r_host", folder_of(F.col("r_path")))))
    keyed = keyed.withColumn("r_prefix", F.substring("r_digest", 1, PREFIX_HEX))

    rows = pages.select(packed(pages, OUTPUT), host_of(quoted(url)).alias("host"), path_of(quoted(url)).alias("path"))
    judged = pages.select(host_of(quoted(url)).alias("t_host"), path_of(quoted(url)).alias("t_path")).distinct()
    tried = judged.select(
        "t_host", "t_path",
        F.explode(expressions(F.col("t_host"), F.col("t_path"), bounds["labels"] or 1, bounds["slashes"] or 0)).alias("t_text"))
    tried = tried.withColumn("t_digest", _digest(F.col("t_text")))
    fits = tried.join(keyed, F.substring(tried["t_digest"], 1, PREFIX_HEX) == keyed["r_prefix"]).where(
        (F.col("t_digest") == F.col("r_digest")) & F.startswith("t_path", "r_path"))
    rule = F.concat("r_host", "r_path")
    best = fits.groupBy("t_host", "t_path").agg(F.max(F.struct(
        F.char_length(rule).alias("length"), F.char_length("r_host").alias("host_length"),
        F.col("r_verdict").alias("verdict"), rule.alias("rule"))).alias("best"))
    return rows.join(best, (rows["host"] == best["t_host"]) & (rows["path"] == best["t_path"]), "left").select(
        "row_.*", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
