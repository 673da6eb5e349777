"""Secret scans with one automaton for all rules.

All rules are compiled into one deterministic automaton (see ``automaton``); every text is
read once, whatever the number of rules. Where a match of a rule ends, its start is found by
reading back with the rule's reversed automaton and its full length by reading on, so that the
spans are the leftmost, longest, non-overlapping ones of each rule. Rules may ask for a least
length of the match or of its value; matches that fail are dropped, and hide what lies inside
them as a finished match does.

NULL texts count as empty and give no spans. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import automaton as fa
from .common import pieces, raw_bytes, texts


@dataclass(frozen=True)
class Rule:
    """``value`` is the pattern's last group, which a match ends with, if ``least`` is for it."""

    kind: str
    pattern: str
    flags: str = ""
    least: int = 0
    value: bytes | None = None


# The base rules in their order.
VALUE = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
BASE = [
    Rule(
        "assign",
        "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        "i",
        12,
        VALUE,
    ),
    Rule("access", "AKIA[A-Z0-9]+", least=18),
    Rule("hex", "[0-9a-f]{16,}"),
]
# Headers of private keys, a public format.
MORE = [Rule("pem", "-----BEGIN ((RSA|EC|DSA|OPENSSH|ENCRYPTED) )?PRIVATE KEY-----")]
RULES = [*BASE, *MORE]


class Scanner:
    """Spans of all rules in byte strings."""

    def __init__(self, rules: list[Rule] = RULES):
        self.rules = rules

    @cached_property
    def combined(self) -> fa.Automaton:
        return fa.compile_rules([(r.pattern, r.flags) for r in self.rules])

    @cached_property
    def single(self) -> list[tuple[fa.Automaton, fa.Automaton]]:
        """Per rule: its matches read forward from their start, and backward from their end."""
        return [
            (
                fa.compile_rules([(r.pattern, r.flags)], anchored=True),
                fa.compile_rules([(r.pattern, r.flags)], anchored=True, backward=True),
            )
            for r in self.rules
        ]

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(row, rule, start, end) in bytes of the row, for rows laid one after the other."""
        # One more byte after each row that leads to the start, so that no match crosses rows.
        breaks = np.flatnonzero(self.combined.resets)
        if not len(breaks):
            raise ValueError("the rules leave no byte that ends every match")
        rows = len(offsets) - 1
        padded = np.insert(data, offsets[1:], np.uint8(breaks[0]))
        begins = offsets + np.arange(rows + 1)
        places, bits = fa.scan(self.combined, padded)
        if not len(places):
            return
        # Places ascend, so those of a row lie together.
        row_of = np.searchsorted(begins, places, side="right") - 1
        cuts = np.flatnonzero(np.append(True, row_of[1:] != row_of[:-1])).tolist()
        for first, stop in zip(cuts, [*cuts[1:], len(places)]):
            row = row_of[first]
            here, kinds = places[first:stop] - begins[row] + 1, bits[first:stop]
            text = data[offsets[row] : offsets[row + 1]].tobytes()
            for k, rule in enumerate(self.rules):
                ends = here[kinds >> k & 1 == 1]
                for start, end in self._matches(k, rule, text, ends):
                    yield int(row), k, start, end

    def _matches(self, k: int, rule: Rule, text: bytes, ends: np.ndarray) -> Iterator[tuple[int, int]]:
        forward, backward = self.single[k]
        done = 0
        at = 0
        while at < len(ends):
            end = int(ends[at])
            # The leftmost start of a match that ends here and begins after the last match.
            start = self._start(backward, text, end, done)
            if start < 0:
                at += 1
                continue
            stop = fa.longest(forward, text, start)
            if self._kept(rule, text[start:stop]):
                yield start, stop
            done = stop
            at = int(np.searchsorted(ends, stop, side="right"))

    @staticmethod
    def _start(backward: fa.Automaton, text: bytes, end: int, least: int) -> int:
        found = fa.longest(backward, text[least:end][::-1], 0)
        return end - found if found >= 0 else -1

    @staticmethod
    def _kept(rule: Rule, match: bytes) -> bool:
        if not rule.least:
            return True
        if rule.value is None:
            return len(match) >= rule.least
        return len(_value(match, rule.value)) >= rule.least


def _value(match: bytes, allowed: bytes) -> bytes:
    """The last group: what follows the first separator, its blanks and its quote."""
    rest = match[min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0) + 1 :].lstrip(b" ")
    return rest if rest[:1] in allowed else rest[1:]


def find_secrets(docs: DataFrame, rules: list[Rule] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``key``, and ``spans``, an array of (kind, start, end)
    ordered by start, then by the rules' order. One pass without a shuffle."""
    source = texts(docs, key, text)
    kind = source.schema[key].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for piece in pieces(batches, text):
            data, offsets = raw_bytes(piece.column(text))
            found: list[list] = [[] for _ in range(piece.num_rows)]
            for row, k, start, end in scanner.spans(data, offsets):
                found[row].append((start, k, end))
            for row, spans in enumerate(found):
                if spans:
                    # Continuation bytes do not start a code point.
                    own = data[offsets[row] : offsets[row + 1]]
                    points = np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])
                    found[row] = [
                        {"kind": rules[k].kind, "start": int(points[s]), "end": int(points[e])}
                        for s, k, e in sorted(spans)
                    ]
            yield pa.RecordBatch.from_arrays(
                [piece.column(key), pa.array(found, pa.list_(span))], [key, "spans"]
            )

    schema = f"{key} {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>"
    return source.mapInArrow(run, schema)


def redact(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with every span of every rule replaced by the kinds in it, as in ``[hex]``;
    spans that touch or overlap are replaced together. A NULL text stays NULL."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            # Beside the columns, which go by their places, the text without NULLs.
            scanned = pc.fill_null(batch.column(place), "")
            whole = pa.RecordBatch.from_arrays([*batch.columns, scanned], [*map(str, range(batch.num_columns)), "scanned"])
            for piece in pieces([whole], "scanned"):
                data, offsets = raw_bytes(piece.column("scanned"))
                found: dict[int, list] = {}
                for row, k, start, end in scanner.spans(data, offsets):
                    found.setdefault(row, []).append((start, end, rules[k].kind))
                columns = piece.columns[:-1]
                if found:
                    changed = columns[place].to_pylist()
                    for row, spans in found.items():
                        changed[row] = _without(data[offsets[row] : offsets[row + 1]].tobytes(), spans)
                    columns[place] = pa.array(changed, columns[place].type)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def _without(text: bytes, spans: list[tuple[int, int, str]]) -> str:
    merged: list[list] = []
    for start, end, kind in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
            merged[-1][2].append(kind)
        else:
            merged.append([start, end, [kind]])
    out, at = [], 0
    for start, end, kinds in merged:
        out += [text[at:start], f"[{'+'.join(dict.fromkeys(kinds))}]".encode()]
        at = end
    return b"".join([*out, text[at:]]).decode()
