"""URL filter: allow and block entries in a trie over reversed host labels and
path segments; the longest entry that fits decides.

An entry is ``(action, host, path)``.  It fits its host and every subdomain
whose url path starts with the entry's path.  Among fitting entries the one
with most host labels wins, then the longest path, then ``block``.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odgraph.llm.common import valid_text

ALLOW, BLOCK = "allow", "block"
#: Largest entry list that is sent to every worker.
MAX_RULES = 1_000_000
_UPPER = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url; both empty for null and for
    strings without ``://``."""
    if url is None:
        return "", ""
    at = url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    end = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    rest = rest[:end]
    slash = rest.find("/")
    if slash < 0:
        return rest.translate(_UPPER), ""
    return rest[:slash].translate(_UPPER), rest[slash:]


class RuleTrie:
    """Host labels from the right lead to a node; its paths form a second trie
    of whole segments whose nodes hold the entries that end there, keyed by
    the begun segment a url must continue with."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        rules = list(rules)
        if len(rules) > MAX_RULES:
            raise ValueError(f"{len(rules)} url rules; at most {MAX_RULES} are sent to workers")
        self.root: dict = {}
        for action, host, path in sorted(rules):
            node = self.root
            for label in reversed(host.translate(_UPPER).split(".")):
                node = node.setdefault(("label", label), {})
            *whole, begun = path.split("/")
            node = node.setdefault("paths", {})
            for segment in whole:
                node = node.setdefault(("segment", segment), {})
            node.setdefault("ends", {})[begun] = (host + path, action)
            node["longest"] = max(node.get("longest", 0), len(begun))

    @staticmethod
    def _path(node: dict, path: str):
        best = None
        segments = path.split("/")
        for i, segment in enumerate(segments):
            ends = node.get("ends")
            if ends:
                # the longest beginning of the segment among the entries, by lookups
                for size in range(min(len(segment), node["longest"]), -1, -1):
                    if segment[:size] in ends:
                        best = ends[segment[:size]]
                        break
            if i == len(segments) - 1:
                break
            node = node.get(("segment", segment))
            if node is None:
                break
        return best

    def match(self, host: str, path: str):
        """(rule, action) of the longest entry that fits, or ``None``."""
        best, node = None, self.root
        for label in reversed(host.split(".")):
            node = node.get(("label", label))
            if node is None:
                break
            if "paths" in node:
                best = self._path(node["paths"], path) or best
        return best


def url_verdict(spark: SparkSession, url: Column, rules: Iterable[tuple[str, str, str]], default: str = ALLOW) -> Column:
    """Struct ``(host, path, rule, verdict)`` of a url column.

    Without a fitting entry ``rule`` is null and ``verdict`` is ``default``.
    Null urls and urls without ``://`` have an empty host and path, which no
    entry fits.  Bytes that are not UTF-8 are U+FFFD.  The trie is broadcast; its size is bounded by ``MAX_RULES``.
    """
    trie = spark.sparkContext.broadcast(RuleTrie(rules))

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judge(urls: pd.Series) -> pd.DataFrame:
        match = trie.value.match
        rows = []
        for u in urls:
            host, path = split_url(u)
            rule, action = match(host, path) or (None, default)
            rows.append((host, path, rule, action))
        return pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"], dtype=object)

    return judge(valid_text(url))


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]], id_col: str = "page_id",
               url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """``(id, host, path, rule, verdict)`` for every row, repeated rows and
    null ids included; other columns are not read."""
    judged = pages.select(F.col(id_col), url_verdict(pages.sparkSession, F.col(url_col), rules, default).alias("j"))
    return judged.select(id_col, "j.host", "j.path", "j.rule", "j.verdict")


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]], url_col: str = "url",
                default: str = ALLOW) -> DataFrame:
    """The rows of ``pages`` whose verdict is ``allow``, null urls and repeated rows
    like any other; an empty table gives an empty result."""
    return pages.where(url_verdict(pages.sparkSession, F.col(url_col), rules, default)["verdict"] == ALLOW)
