"""URL filters: a broadcast trie over reversed host labels and path segments.

A rule is a host and a path. It fits its host and all subdomains, if the url's path starts with the
rule's path; the most specific of the fitting rules (most host labels, then longest path) gives the
verdict, and between an allow and a block entry of the very same host and path, allow wins. Where no
rule fits, the method's verdict is `default`.

The trie's nodes are dictionaries: host labels from the top domain down, and below each host the rule
paths by segment. A rule's last part may end within a segment; of a node's ends, those of each length that
occurs are looked up at once, so that a url costs no more with many rules on its host. The trie's size is that
of the rule list, at most `max_rules` entries; a larger list raises.

Edge cases: a null url or one without `://` has an empty host and path and no rule can fit it; an empty
table gives no rows; repeated rows each get a verdict; very long urls take time in proportion to their
length; further columns, whatever their names, pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.tables import free_name, table

#: The contract's rules: (verdict, host, path).
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
_UPPER = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): the host after the first :// with A-Z lower-cased, and the path up to ? or #."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    ends = [i for c in "/?#" if (i := rest.find(c)) >= 0]
    end = min(ends, default=len(rest))
    host, path = rest[:end].translate(_UPPER), rest[end:]
    for c in "?#":
        path = path.partition(c)[0]
    return host, path


class RuleTrie:
    """Rules by reversed host labels, then by path segments. The last part of a rule's path may end within a segment."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        self.root: dict = {}
        for verdict, host, path in rules:
            node = self.root
            for label in reversed(host.translate(_UPPER).split(".") if host else []):
                node = node.setdefault("hosts", {}).setdefault(label, {})
            node = node.setdefault("paths", {})
            *whole, rest = path.split("/")
            for segment in whole:
                node = node.setdefault("segments", {}).setdefault(segment, {})
            ends = node.setdefault("ends", {})
            if ends.get(rest, ("", ""))[1] != "allow":
                ends[rest] = (host.translate(_UPPER) + path, verdict)
                node.setdefault("lengths", set()).add(len(rest))

    def fit(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the most specific rule that fits."""
        best = self._path(self.root.get("paths"), path)
        node = self.root
        for label in reversed(host.split(".") if host else []):
            node = node.get("hosts", {}).get(label)
            if node is None:
                break
            best = self._path(node.get("paths"), path) or best
        return best

    @staticmethod
    def _path(node: dict | None, path: str) -> tuple[str, str] | None:
        best, segments = None, path.split("/")
        for k, segment in enumerate(segments):
            if node is None:
                break
            fitting = [n for n in node.get("lengths", ()) if n <= len(segment) and segment[:n] in node["ends"]]
            if fitting:
                best = node["ends"][segment[: max(fitting)]]
            node = node.get("segments", {}).get(segment) if k < len(segments) - 1 else None
        return best


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], *, url: str = "url", default: str = "allow", max_rules: int = 1_000_000) -> DataFrame:
    """The rows of pages with host, path, rule (null where none fits) and verdict; columns of these names, in whatever case, are replaced."""
    if len(rules) > max_rules:
        raise ValueError(f"{len(rules)} rules; the trie is broadcast and takes {max_rules} at most")
    trie = pages.sparkSession.sparkContext.broadcast(RuleTrie(rules))

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judged(urls):
        import pandas as pd

        rows = []
        for x in urls:
            host, path = split_url(x)
            rule, verdict = (trie.value.fit(host, path) if host or path else None) or (None, default)
            rows.append((host, path, rule, verdict))
        return pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"])

    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    name = free_name(pages, "judged")
    found = pages.select(*kept, judged(F.col(url)).alias(name))
    return found.select(*kept, f"{name}.*")


def op8_url_filters(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), RULES).select("page_id", "host", "path", "rule", "verdict")


ORACLE = r"""
WITH r(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM a),
f AS (SELECT p.page_id, r.verdict, r.host || r.path AS rule, row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host) DESC, length(r.path) DESC) AS k
      FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM p LEFT JOIN f ON p.page_id = f.page_id AND f.k = 1
"""
