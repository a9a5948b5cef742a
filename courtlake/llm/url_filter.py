"""Allow and block rules for urls: a trie over reversed host labels and path segments, longest match wins."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtlake.llm.common import lower_ascii

#: Rules that the broadcast trie may hold; larger rule tables are joined by key instead.
MAX_TRIE_RULES = 200_000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class Trie:
    """Hosts by labels from the right, then paths by whole segments; an unfinished last segment is a prefix."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root: dict = {}
        for host, path, verdict in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            *whole, rest = path.split("/")
            node = node.setdefault("/", {})
            for segment in whole:
                node = node.setdefault(segment, {})
            ends = node.setdefault("/", {})  # a segment holds no slash, so this key is free
            if ends.get(rest, (0, "allow"))[1] == "allow":
                ends[rest] = (host + path, verdict)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """Rule and verdict of the longest match: most host labels, then longest path; block wins over an equal allow."""
        node, hosts = self.root, []
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if "/" in node:
                hosts.append(node["/"])
        segments = path.split("/")
        for node in reversed(hosts):
            best = None
            for k in range(len(segments)):
                ends = node.get("/")
                if ends:
                    fits = [rest for rest in ends if segments[k].startswith(rest) or not rest]
                    if fits:
                        best = ends[max(fits, key=len)]
                node = node.get(segments[k]) if k < len(segments) - 1 else None
                if node is None:
                    break
            if best:
                return best
        return None


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", max_trie_rules: int = MAX_TRIE_RULES) -> DataFrame:
    """One row per row: the id, host, path, rule (host and path of the winner, else null), verdict.

    `rules` has host, path, verdict ('allow' or 'block'); rows with a null are left out.  A rule fits its host and all
    subdomains if the url's path starts with the rule's path.  Most host labels win, then the longest path, then block.
    A url that is null or has no ``://`` has an empty host and path and gets `default`, as does one without a rule.
    Repeated rows are judged alike; an empty table gives no rows; other columns are ignored.
    """
    known = rules.select(lower_ascii(F.col("host")).alias("host"), "path", "verdict").dropna().distinct()
    urls = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    if known.limit(max_trie_rules + 1).count() <= max_trie_rules:
        trie = pages.sparkSession.sparkContext.broadcast(Trie(sorted(tuple(r) for r in known.collect())))

        @F.pandas_udf("rule string, verdict string")
        def find(host: pd.Series, path: pd.Series) -> pd.DataFrame:
            found = [trie.value.find(h, p) or (None, default) for h, p in zip(host, path, strict=True)]
            return pd.DataFrame(found, columns=["rule", "verdict"])

        judged = urls.withColumn("f", find("host", "path"))
        return judged.select(id_col, "host", "path", "f.rule", "f.verdict")
    return _by_join(urls, known, id_col, default)


def _by_join(urls: DataFrame, known: DataFrame, id_col: str, default: str) -> DataFrame:
    """The same verdicts for rule tables without a bound: distinct urls meet the rules by host suffix and folder."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    parts = F.split("path", "/")
    folders = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    places = urls.select("host", "path").distinct()
    keys = places.select("host", "path", F.explode(suffixes).alias("suffix"), folders.alias("folders")).select("host", "path", "suffix", F.explode("folders").alias("folder"))
    keyed = known.select(F.col("host").alias("suffix"), F.regexp_extract("path", "^(?s)(.*)/[^/]*$", 1).alias("folder"), F.col("path").alias("own"), "verdict")
    fits = keys.join(keyed, ["suffix", "folder"]).filter(F.col("path").startswith(F.col("own")))
    rank = F.struct(F.size(F.split("suffix", r"\.")), F.length("own"), F.when(F.col("verdict") == "block", 1).otherwise(0))
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct(F.concat("suffix", "own").alias("rule"), "verdict"), rank).alias("f"))
    joined = urls.join(best, ["host", "path"], "left")
    return joined.select(id_col, "host", "path", "f.rule", F.coalesce("f.verdict", F.lit(default)).alias("verdict"))
