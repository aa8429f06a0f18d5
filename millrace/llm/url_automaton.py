"""URL filter rules as one bit-parallel wildcard automaton.

Every rule is a glob over the canonical URL (a dot, the lower-case host, the
path). All globs are packed side by side into Shift-And masks of as many
64-bit words as they need; one step per byte of the URL advances all rules at
once: ``state = (state << 1) & moves[byte] | state & loops[byte]``. The URLs
of an Arrow batch step together, longest first, so a URL leaves when it ends.

``*`` stands for bytes other than ``/``, ``**`` for any bytes, ``?`` for one
byte other than ``/``. The first rule in order of priority decides; plain
host-and-path rules go by length, longest first, before glob rules.

Defined results: a null URL, or one without ``://``, has an empty host and
path and gets the default verdict unless a glob takes the lone dot; an empty
table gives an empty result; repeated rows are judged each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    name: str | None  # as reported; None for a glob rule
    glob: str


def site_rule(verdict: str, rule: str) -> Rule:
    """``host/path``: the host and all its subdomains, paths that start so."""
    literal = "".join(f"\\{c}" if c in "*?\\" else c for c in rule)
    return Rule(verdict, rule, f"*.{literal}**")


def ordered(sites: list[Rule], globs: list[Rule]) -> list[Rule]:
    return [*sorted(sites, key=lambda r: (-len(r.name or ""), r.name)), *globs]


class Automaton:
    """The masks of all rules."""

    def __init__(self, rules: list[Rule]) -> None:
        moves: list[np.ndarray] = []  # for each bit: the bytes that lead to it
        loops: list[np.ndarray] = []  # for each bit: the bytes that stay on it
        first, last = [], []
        every, inner = np.ones(256, bool), np.ones(256, bool)
        inner[ord("/")] = False
        for rule in rules:
            first.append(len(moves))
            moves.append(np.zeros(256, bool))
            loops.append(np.zeros(256, bool))
            data, at = rule.glob.encode(), 0
            while at < len(data):
                if data[at : at + 2] == b"**":
                    loops[-1] = every
                    at += 2
                    continue
                if data[at : at + 1] == b"*":
                    loops[-1] = loops[-1] | inner
                    at += 1
                    continue
                if data[at : at + 1] == b"?":
                    step = inner
                else:
                    at += data[at : at + 1] == b"\\"
                    step = np.zeros(256, bool)
                    step[data[at]] = True
                moves.append(step)
                loops.append(np.zeros(256, bool))
                at += 1
            last.append(len(moves) - 1)
        self.words = -(-len(moves) // 64)
        self.moves, self.loops = self.pack(moves), self.pack(loops)
        self.start = np.zeros(self.words, np.uint64)
        for bit in first:
            self.start[bit // 64] |= np.uint64(1 << bit % 64)
        self.last = np.array(last)

    def pack(self, bits: list[np.ndarray]) -> np.ndarray:
        masks = np.zeros((256, self.words), np.uint64)
        for i, allowed in enumerate(bits):
            masks[allowed, i // 64] |= np.uint64(1 << i % 64)
        return masks

    def run(self, urls: list[bytes]) -> np.ndarray:
        """For each URL and rule whether the rule takes the whole URL."""
        lengths = np.array([len(u) for u in urls])
        order = np.argsort(-lengths, kind="stable")
        data = np.frombuffer(b"".join(urls), np.uint8)
        begins = (np.cumsum(lengths) - lengths)[order]
        state = np.tile(self.start, (len(urls), 1))
        active = len(urls)
        ends = lengths[order]
        for at in range(int(ends[0]) if len(urls) else 0):
            active = int(np.searchsorted(-ends, -at, side="left"))  # those longer than ``at``
            byte = data[begins[:active] + at]
            old = state[:active]
            shifted = old << np.uint64(1)
            shifted[:, 1:] |= old[:, :-1] >> np.uint64(63)
            state[:active] = shifted & self.moves[byte] | old & self.loops[byte]
        taken = state[:, self.last // 64] >> (self.last % 64).astype(np.uint64) & np.uint64(1)
        out = np.empty(taken.shape, bool)
        out[order] = taken.astype(bool)
        return out


def host_of(url: Column) -> Column:
    """What is between the first ``://`` and the next ``/``, ``?``, ``#`` or end, A-Z in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def judge(pages: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """``key``, host, path, rule, glob_rule and verdict of every row; ``rules`` in order of priority, one at least."""
    if not rules:
        raise ValueError("no rules")
    machine = Automaton(rules)
    parts = pages.select(key, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            taken = machine.run([f".{h}{p}".encode() for h, p in zip(hosts, paths)])
            best = [rules[i] if some else None for i, some in zip(taken.argmax(1), taken.any(1))]
            yield pa.RecordBatch.from_pydict({
                key: batch.column(0), "host": batch.column(1), "path": batch.column(2),
                "rule": pa.array([r.name if r else None for r in best], pa.string()),
                "glob_rule": pa.array([r.glob if r else None for r in best], pa.string()),
                "verdict": pa.array([r.verdict if r else default for r in best], pa.string()),
            })

    kind = parts.schema[key].dataType.simpleString()
    return parts.mapInArrow(run, f"`{key}` {kind}, host string, path string, rule string, glob_rule string, verdict string")
