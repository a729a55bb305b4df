"""Allow and block lists of addresses as one trie over reversed host labels and path segments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsight.llm.batches import map_batches, required

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The trie is broadcast: more rules than this are refused.
MAX_RULES = 1_000_000


@dataclass(frozen=True)
class Rule:
    """``host/path`` and what it says; it covers the host, its subdomains and all paths that begin alike."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0].translate(str.maketrans(UPPER, LOWER))

    @property
    def path(self) -> str:
        slash, rest = self.text.partition("/")[1:]
        return slash + rest


def segments(path: str) -> list[str]:
    """``/en/a`` as ``/``, ``en/``, ``a``."""
    parts = path.split("/")
    return [part + "/" for part in parts[:-1]] + ([parts[-1]] if parts[-1] else [])


class Trie:
    """Rules by reversed host labels and then by path segments.

    A node is ``[children by label, path node]``; a path node is ``[children by segment, rule,
    rules that end within a segment]``.
    """

    def __init__(self, rules: list[Rule]):
        if len(rules) > MAX_RULES:
            raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are broadcast")
        self.root: list = [{}, None]
        # of two rules for one place the blocking one stays, whatever their order
        for rule in sorted(rules, key=lambda rule: (rule.verdict == BLOCK, rule.text)):
            node = self.root
            for label in reversed(rule.host.split(".") if rule.host else []):
                node = node[0].setdefault(label, [{}, None])
            node[1] = node[1] or [{}, None, {}]
            place, parts = node[1], segments(rule.path)
            for part in parts:
                if part.endswith("/"):
                    place = place[0].setdefault(part, [{}, None, {}])
            if parts and not parts[-1].endswith("/"):
                place[2][parts[-1]] = rule
            else:
                place[1] = rule

    def longest(self, host: str, path: str) -> Rule | None:
        """The rule with the most host labels that fits, and of these the one with the longest path."""
        node, found, parts = self.root, None, segments(path)
        places = [node[1]] if node[1] else []
        for label in reversed(host.split(".") if host else []):
            node = node[0].get(label)
            if node is None:
                break
            if node[1]:
                places.append(node[1])
        for place in reversed(places):
            found = self.deepest(place, parts)
            if found:
                return found
        return None

    @staticmethod
    def deepest(place: list, parts: list[str]) -> Rule | None:
        found = place[1]
        for part in [*parts, ""]:
            ends = {len(tail) for tail in place[2]} if len(place[2]) <= len(part) else range(1, len(part) + 1)
            tail = next((part[:end] for end in sorted(ends, reverse=True) if part[:end] in place[2]), None)
            if tail is not None:
                found = place[2][tail]
            place = place[0].get(part)
            if place is None:
                return found
            found = place[1] or found
        return found


def address(url):
    """Host and path of an address as columns; both empty without ``://``."""
    start = F.locate("://", url)
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER), F.coalesce(path, F.lit(""))


def judge_urls(pages: DataFrame, rules: list[Rule], *, page_id: str = "page_id", url: str = "url", default: str = ALLOW) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row; the trie is broadcast and nothing is shuffled.

    The longest rule wins: the one with the most host labels, then the longest path; of an allow and a
    block entry for the same place the block entry. Where none fits, ``rule`` is null and ``default``
    holds, so for a null url or one without ``://`` too. A null page_id stays null; repeated rows each
    have their row; an empty table gives an empty result; other columns are ignored.
    """
    shared = pages.sparkSession.sparkContext.broadcast(Trie(rules))

    def convert(columns):
        ids, hosts, paths = columns
        found = [shared.value.longest(host, path) for host, path in zip(hosts, paths)]
        return {
            "page_id": ids, "host": hosts, "path": paths,
            "rule": [rule.text if rule else None for rule in found],
            "verdict": [rule.verdict if rule else default for rule in found],
        }

    chosen = required(pages, page_id, url)
    host, path = address(chosen[url])
    ddl = "page_id bigint, host string, path string, rule string, verdict string"
    return map_batches(chosen.select(chosen[page_id].cast("bigint"), host.alias("host"), path.alias("path")), ddl, convert)
