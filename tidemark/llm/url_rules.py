"""Allow and block rules for urls, by a trie.

A rule is a host and the beginning of a path, with a verdict. The trie's upper
levels are host labels from the right (``com``, then ``example``), and below
each host hang the path's segments; the last, perhaps unfinished segment of a
rule is kept by its length. A url walks its labels down from the root, so it
meets the rules of its host and of every domain above it, and walks its segments
below each of them. The longest fitting rule decides; where rules fit with equal
lengths the longer host, and then the block entry, has precedence. (The length
is that of host and path together, in code points.)

The trie is built on the driver, where the rules are, and broadcast. Rules that
make more than ``TRIE_BYTES`` are cut into several tries, each within that
bound, and the urls pass them one after the other through a written table, each
pass keeping the longest rule so far. Pages are only streamed: no url is
shuffled, so a frequent host costs what its rows cost.

Defined results: the host is what follows the first ``://`` up to ``/``, ``?``,
``#`` or the end, with A-Z lowered; the path follows up to ``?``, ``#`` or the
end. A null url and one without ``://`` have an empty host and path. Where no
rule fits, the rule is null and the verdict is ``default``. A rule with an empty
host fits every host. Repeated rows are repeated; other columns are ignored.
"""
from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..plans.sinks import drop_path
from ..session import scratch_path
from .textcols import limit_batches

ALLOW, BLOCK = "allow", "block"
#: Size of the rules in one trie, as they are written (host, path, verdict).
TRIE_BYTES = 16 << 20
_LOWER = {i: i + 32 for i in range(65, 91)}
_HOST_ENDS = re.compile("[/?#]")
_PATH_ENDS = re.compile("[?#]")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    def __post_init__(self):
        if self.verdict not in (ALLOW, BLOCK):
            raise ValueError(f"a rule's verdict is {ALLOW} or {BLOCK}, not {self.verdict!r}")
        object.__setattr__(self, "host", self.host.translate(_LOWER))

    @property
    def rank(self) -> tuple[int, int, bool]:
        return len(self.host) + len(self.path), len(self.host), self.verdict == BLOCK


def parse_rule(text: str, verdict: str) -> Rule:
    """The rule written as host and path in one, like ``example.com/en/``."""
    cut = text.find("/")
    return Rule(text, "", verdict) if cut < 0 else Rule(text[:cut], text[cut:], verdict)


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) of a url."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    end = _HOST_ENDS.search(url, at + 3)
    if end is None:
        return url[at + 3:].translate(_LOWER), ""
    stop = _PATH_ENDS.search(url, end.start())
    return url[at + 3:end.start()].translate(_LOWER), url[end.start():stop.start() if stop else len(url)]


class Node:
    """A host label or a path segment: what follows it, and rules that end in it."""

    __slots__ = ("labels", "segments", "tails", "lengths")

    def __init__(self):
        self.labels: dict[str, Node] = {}
        self.segments: dict[str, Node] = {}
        self.tails: dict[str, Rule] = {}
        self.lengths: tuple[int, ...] = ()


def build(rules: Iterable[Rule]) -> Node:
    root = Node()
    for rule in rules:
        node = root
        for label in reversed(rule.host.split(".")) if rule.host else ():
            node = node.labels.setdefault(label, Node())
        *whole, tail = rule.path.split("/")
        for segment in whole:
            node = node.segments.setdefault(segment, Node())
        held = node.tails.get(tail)
        if held is None or rule.rank > held.rank:
            node.tails[tail] = rule
            node.lengths = tuple(sorted({len(t) for t in node.tails}, reverse=True))
    return root


def longest(root: Node, host: str, path: str) -> Rule | None:
    """The rule of the trie that decides for a url."""
    parts = path.split("/")
    best = None

    def below(node: Node) -> None:
        nonlocal best
        for i, part in enumerate(parts):
            for length in node.lengths:
                rule = node.tails.get(part[:length])
                if rule is not None and len(part) >= length:
                    if best is None or rule.rank > best.rank:
                        best = rule
                    break
            node = node.segments.get(part) if i + 1 < len(parts) else None
            if node is None:
                return

    node = root
    below(node)
    for label in reversed(host.split(".")):
        node = node.labels.get(label)
        if node is None:
            break
        below(node)
    return best


def shares(rules: Iterable[Rule], limit: int) -> list[list[Rule]]:
    """The rules in runs of at most ``limit`` bytes (one rule at least)."""
    out, size = [[]], 0
    for rule in rules:
        mine = len(rule.host.encode()) + len(rule.path.encode()) + len(rule.verdict)
        if out[-1] and size + mine > limit:
            out.append([])
            size = 0
        out[-1].append(rule)
        size += mine
    return out


_JUDGED = "page_id long, url string, host string, path string, rule string, verdict string, rank array<int>"


def _one_pass(found: DataFrame, rules: list[Rule], default: str) -> DataFrame:
    """``found`` with the longest rule of these and of the passes before."""
    spark = found.sparkSession
    trie = spark.sparkContext.broadcast(pickle.dumps(build(rules)))
    schema = spark.createDataFrame([], _JUDGED).schema
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = pickle.loads(trie.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = []
            for page, url, rule, verdict, rank in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "rule", "verdict", "rank"))):
                host, path = split_url(url)
                mine = longest(root, host, path)
                if mine is not None and (rank is None or list(mine.rank) > rank):
                    rule, verdict, rank = mine.host + mine.path, mine.verdict, list(map(int, mine.rank))
                rows.append((page, url, host, path, rule, verdict or default, rank))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], schema.names)

    return found.select("page_id", "url", "rule", "verdict", "rank").mapInArrow(run, schema)


def judge(pages: DataFrame, rules: Iterable[Rule], default: str = ALLOW, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` (page_id, url)."""
    spark = pages.sparkSession
    limit_batches(spark, 4096)
    found = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.lit(None).cast("string").alias("rule"),
                         F.lit(None).cast("string").alias("verdict"), F.lit(None).cast("array<int>").alias("rank"))
    before = None
    for i, part in enumerate(parts := shares(rules, trie_bytes)):
        found = _one_pass(found, part, default)
        if i + 1 < len(parts):
            path = scratch_path(spark, "url-rules")
            found.write.parquet(path)
            found = spark.read.parquet(path)
            if before:
                drop_path(spark, before)
            before = path
    return found.select("page_id", "host", "path", "rule", "verdict")
