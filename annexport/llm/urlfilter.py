"""URL filters: a trie over reversed host labels and path segments, with longest-match precedence.

A rule (host, path, verdict) fits a URL if the URL's host is the rule's or below it and the URL's
path begins with the rule's. Hosts are walked label by label from the right; at each label that ends
a rule's host, a second trie is walked over whole path segments, and the rest of a rule's path
behind its last slash is compared with the begin of the next segment. The longest rule wins: by
host labels, then by path length; block wins between two rules that are otherwise equal.

Rules are cut into blocks of at most ``BLOCK`` bytes; each block's trie is broadcast and applied in
turn, and the longer of two matches is kept, so any number of rules works with a bounded trie.

Edge cases: a URL that is NULL or has no ``://`` has an empty host and path and no rule. Empty
labels and segments count as such. A URL without a rule has the default verdict. Without rules all have it.
Repeated rows get equal results. Extra columns pass through; a column named like the result is replaced.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annexport.llm.common import blocks

BLOCK = 16 << 20
ALLOW, BLOCKED = "allow", "block"
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

Rule = tuple[str, str, str]  # host, path, verdict


@dataclass
class PathNode:
    """Children by whole segment; rules that end here, by what they want of the next segment."""

    children: dict[str, PathNode] = field(default_factory=dict)
    ends: dict[str, Rule] = field(default_factory=dict)


@dataclass
class HostNode:
    children: dict[str, HostNode] = field(default_factory=dict)
    paths: PathNode | None = None


def build(rules: Iterable[Rule]) -> HostNode:
    root = HostNode()
    for host, path, verdict in rules:
        node = root
        for label in reversed(host.split(".")):
            node = node.children.setdefault(label, HostNode())
        node.paths = node.paths or PathNode()
        at = node.paths
        *whole, tail = path.split("/")
        for segment in whole:
            at = at.children.setdefault(segment, PathNode())
        if tail not in at.ends or verdict == BLOCKED:
            at.ends[tail] = (host, path, verdict)
    return root


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): from behind the first ``://``; the query and the fragment are cut off."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    cut = min((i for c in "?#" if (i := rest.find(c)) >= 0), default=len(rest))
    rest = rest[:cut]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


def match(root: HostNode, host: str, path: str) -> Rule | None:
    """The longest rule that fits."""
    best, node = None, root
    segments = path.split("/")
    for label in reversed(host.split(".")):
        node = node.children.get(label)
        if node is None:
            break
        at, found = node.paths, None
        for segment in segments:
            if at is None:
                break
            for tail, rule in at.ends.items():
                if segment.startswith(tail) and (found is None or len(rule[1]) > len(found[1])):
                    found = rule
            at = at.children.get(segment)
        best = found or best  # more labels are longer
    return best


def longer(a: Rule | None, b: Rule | None) -> Rule | None:
    if a is None or b is None:
        return a or b
    size = lambda r: (r[0].count("."), len(r[1]), r[2] == BLOCKED)
    return max(a, b, key=size)


RESULT = "struct<host:string,path:string,rule_host:string,rule_path:string,verdict:string>"
_KIND = pa.struct([(n, pa.string()) for n in ("host", "path", "rule_host", "rule_path", "verdict")])


def judged(
    pages: DataFrame, rules: Iterable[Rule], url: str = "url", default: str = ALLOW,
    into: str = "judged", block: int = BLOCK,
) -> DataFrame:
    """``pages`` with a struct ``into``: host, path, the rule's host and path (or NULL), verdict."""
    rows = pages.withColumn(into, F.lit(None).cast(RESULT))
    for part in [*blocks(iter(rules), lambda r: len(r[0]) + len(r[1]) + 64, block)] or [[]]:
        rows = _judge(rows, part, url, default, into)
    return rows


def _judge(rows: DataFrame, rules: list[Rule], url: str, default: str, into: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(rules)

    @F.arrow_udf(RESULT)
    def of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        root = build(shared.value)
        for urls, before in batches:
            out = []
            for u, old in zip(urls.to_pylist(), before.to_pylist()):
                host, path = split_url(u)
                earlier = (old["rule_host"], old["rule_path"], old["verdict"]) if old and old["rule_host"] is not None else None
                rule = longer(match(root, host, path), earlier)
                out.append({
                    "host": host, "path": path, "rule_host": rule and rule[0], "rule_path": rule and rule[1],
                    "verdict": rule[2] if rule else default,
                })
            yield pa.array(out, _KIND)

    return rows.withColumn(into, of(F.col(url), F.col(into)))
