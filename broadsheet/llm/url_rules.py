"""URL rules as one bit-parallel wildcard automaton.

Every rule is a glob over the canonical url `.host/path`: `*` stands for characters other than `/`, `**` for any, `?` for
one other than `/`. All globs are packed into the bits of one multiword Shift-And mask. A step over one character moves
every state of every glob at once: states whose next character fits go on, states before a wildcard stay. The words of a
batch's urls are one matrix, so a step also advances all of them together. Urls are judged where they are read; there is
no shuffle, and tasks carry only the masks of the rules.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEP_ROWS = 2_048  # urls advanced together


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased. Path: from there up to `?`, `#` or the
    end. Both are empty for a null url or one without `://`."""
    rest = F.regexp_extract(F.col(url), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


@dataclass(frozen=True)
class Rule:
    """`glob` over `.host/path`; among fitting rules the highest rank decides, and the first of equal ranks."""

    name: str | None
    glob: str
    verdict: str
    rank: int


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits the host and all its subdomains where the url's path starts with the rule's; the longest rule wins, and any
    of these before a plain glob."""
    return Rule(host + path, f"*.{_literal(host)}{_literal(path)}**", verdict, 1_000_000 + len(host) + len(path))


def glob_rule(glob: str, verdict: str) -> Rule:
    return Rule(None, glob, verdict, len(glob.replace("*", "")))


def _literal(text: str) -> str:
    return "".join("\\" + c if c in "*?\\" else c for c in text)


class Automaton:
    """Shift-And over bytes: `go[c]` are the states that a byte c may enter from the one before, `stay[c]` those that a
    wildcard holds on c. The first bit of every glob is set at the start and entered by no byte."""

    def __init__(self, rules: list[Rule]):
        self.rules = sorted(rules, key=lambda r: -r.rank)
        steps: list[list] = []  # of all globs: None for a start, else ("c", byte) or ("?",)
        loops: list[str] = []  # by state: "", "*" or "**"
        self.start_bits, self.final_bits = [], []
        for rule in self.rules:
            self.start_bits.append(len(steps))
            steps.append(None)
            loops.append("")
            raw, k = rule.glob.encode(), 0
            while k < len(raw):
                c = raw[k:k + 1]
                if c == b"*":
                    wide = raw[k:k + 2] == b"**"
                    loops[-1] = "**" if wide or loops[-1] == "**" else "*"
                    k += 1 + wide
                    continue
                if c == b"\\" and k + 1 < len(raw):
                    k += 1
                    c = raw[k:k + 1]
                    steps.append(("c", c[0]))
                else:
                    steps.append(("?",) if c == b"?" else ("c", c[0]))
                loops.append("")
                k += 1
            self.final_bits.append(len(steps) - 1)
        self.width = max(1, -(-len(steps) // 64))
        self.go, self.stay = np.zeros((256, self.width), np.uint64), np.zeros((256, self.width), np.uint64)
        self.begin = np.zeros(self.width, np.uint64)
        for bit in self.start_bits:
            self.begin[bit // 64] |= np.uint64(1 << bit % 64)
        for bit, (step, loop) in enumerate(zip(steps, loops)):
            one = np.uint64(1 << bit % 64)
            if step is not None:
                fits = [step[1]] if step[0] == "c" else [c for c in range(256) if c != 47]
                self.go[fits, bit // 64] |= one
            if loop:
                self.stay[[c for c in range(256) if loop == "**" or c != 47], bit // 64] |= one

    def best(self, urls: list[str]) -> np.ndarray:
        """For each url the place of the fitting rule of the highest rank, or -1."""
        out = np.full(len(urls), -1)
        raw = [u.encode() for u in urls]
        lengths = np.array([len(r) for r in raw])
        order = np.argsort(lengths, kind="stable")  # urls of one step are about equally long
        for at in range(0, len(order), STEP_ROWS):
            rows = order[at:at + STEP_ROWS]
            out[rows] = self._best([raw[k] for k in rows], lengths[rows])
        return out

    def _best(self, raw: list[bytes], lengths: np.ndarray) -> np.ndarray:
        last = int(lengths[-1])
        text = np.frombuffer(b"".join(r.ljust(last, b"\0") for r in raw), np.uint8).reshape(len(raw), last)
        state = np.broadcast_to(self.begin, (len(raw), self.width)).copy()
        final = np.zeros_like(state)
        final[lengths == 0] = state[lengths == 0]
        first = 0
        for k in range(last):
            while lengths[first] <= k:
                first += 1
            here = state[first:]
            c = text[first:, k]
            moved = here << np.uint64(1)
            if self.width > 1:
                moved[:, 1:] |= here[:, :-1] >> np.uint64(63)
            state[first:] = (moved & self.go[c]) | (here & self.stay[c])
            ended = first + np.flatnonzero(lengths[first:] == k + 1)
            final[ended] = state[ended]
        out = np.full(len(raw), -1)
        for place in range(len(self.rules) - 1, -1, -1):
            bit = self.final_bits[place]
            out[final[:, bit // 64] >> np.uint64(bit % 64) & np.uint64(1) == 1] = place
        return out


def judge(urls: DataFrame, rules: list[Rule], default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) of every row: the rule's name (null where a plain glob or the default decides).

    Null urls and urls without `://` have an empty host and path; null and repeated ids keep their rows."""
    host, path = host_and_path(url_col)
    automaton = Automaton(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls = [f".{h}{p}" for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            found = automaton.best(urls)
            fitting = [automaton.rules[k] if k >= 0 else None for k in found.tolist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([r.name if r else None for r in fitting], pa.string()),
                 pa.array([r.verdict if r else default for r in fitting], pa.string())], ["id", "host", "path", "rule", "verdict"])

    given = urls.select(F.col(id_col).cast("long").alias("id"), host.alias("host"), path.alias("path"))
    return given.mapInArrow(run, "id long, host string, path string, rule string, verdict string").withColumnRenamed("id", id_col)
