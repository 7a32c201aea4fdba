"""URL filters: a trie over reversed host labels and path segments.

Rules are (verdict, host, path). A rule fits its host and all its subdomains if the url's path starts
with the rule's path. Of the rules that fit, the one with the longest host wins, then the one with the
longest path, then a block over an allow. The trie is compiled once and sent to every task; a rule list
beyond MAX_RULE_BYTES is refused, as it is meant to fit into each task.

Defined results: a null url and one without `://` have an empty host and path; a url that no rule fits
gets the default verdict and a null rule; repeated rows are judged alike; extra columns are not read;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULE_BYTES = 256 << 20
DEFAULT = "allow"

#: The rules of the query, in the order given.
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)


class PathNode:
    """Whole segments below, and the rules whose last, open segment begins here."""

    __slots__ = ("children", "ends")

    def __init__(self) -> None:
        self.children: dict[str, PathNode] = {}
        self.ends: list[tuple[str, str, str]] = []


class HostNode:
    __slots__ = ("children", "paths")

    def __init__(self) -> None:
        self.children: dict[str, HostNode] = {}
        self.paths: PathNode | None = None


class UrlTrie:
    """Longest-match lookup of a verdict by host and path."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root = HostNode()
        size = 0
        for verdict, host, path in rules:
            size += len(host) + len(path) + 64
            if size > MAX_RULE_BYTES:
                raise ValueError(f"rules of more than {MAX_RULE_BYTES} bytes; deal them by host instead")
            node = self.root
            for label in reversed(host.split(".")):
                node = node.children.setdefault(label, HostNode())
            node.paths = node.paths or PathNode()
            *whole, last = path.split("/")
            at = node.paths
            for segment in whole:
                at = at.children.setdefault(segment, PathNode())
            at.ends.append((last, host + path, verdict))
        self._sort(self.root)

    def _sort(self, root: HostNode) -> None:
        hosts, paths = [root], []
        while hosts:
            node = hosts.pop()
            hosts.extend(node.children.values())
            if node.paths:
                paths.append(node.paths)
        while paths:
            at = paths.pop()
            paths.extend(at.children.values())
            at.ends.sort(key=lambda e: (-len(e[0]), e[2] != "block"))

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits."""
        node, depths = self.root, []
        for label in reversed(host.split(".")):
            node = node.children.get(label)
            if node is None:
                break
            if node.paths:
                depths.append(node.paths)
        segments = path.split("/")
        for start in reversed(depths):
            at, best = start, None
            for segment in segments:
                best = next(((rule, verdict) for last, rule, verdict in at.ends if segment.startswith(last)), best)
                at = at.children.get(segment)
                if at is None:
                    break
            if best:
                return best
        return None


def url_host(url: Column) -> Column:
    """What follows the first :// up to / ? # or the end, with A-Z lower-cased."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def url_verdicts(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, id_col: str = "page_id",
                 url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """Per row: id, host, path, rule (null: none fits), verdict."""
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            found = [trie.value.match(h, p) for h, p in zip(hosts, paths, strict=True)]
            yield pa.record_batch({
                "_id": batch.column("_id"), "host": batch.column("host"), "path": batch.column("path"),
                "rule": pa.array([f and f[0] for f in found], pa.string()),
                "verdict": pa.array([f[1] if f else default for f in found], pa.string())})

    rows = pages.select(F.col(id_col).alias("_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, host string, path string, rule string, verdict string").withColumnRenamed("_id", id_col)
