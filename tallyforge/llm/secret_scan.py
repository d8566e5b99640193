"""Secrets in texts, found by one deterministic automaton that holds the rules of every kind.

The rules are compiled once (``automaton``): a minimal automaton reads the bytes of many texts from
their ends in one pass for all rules, and its states tell at which bytes a match of which rule begins.
From the first such byte of a rule a second automaton, also of all rules, finds the longest match;
bytes inside it begin no other match of that rule.  So the matches of a rule are leftmost, longest and
do not overlap; those of different rules may.  A match that does not fit the rule's stricter pattern is
dropped after it has taken its bytes.

Spans are in code points, the end exclusive.  Defined results: a null or empty text has no spans; texts
of any length are scanned whole; each row gives one row, repeated and null keys included; an empty table
gives no rows; other columns are ignored, whatever their names.  Spans are ordered by start, then by the
order of the rules.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm.automaton import Automaton, compile_patterns
from tallyforge.llm.common import need, text_rounds

SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
)


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` are spans of ``kind`` if they match ``strict`` too, where one is given."""

    kind: str
    pattern: str
    strict: str | None = None


_ASSIGNED = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]"""
RULES = [
    Rule("assign", _ASSIGNED + "+", _ASSIGNED + "{6,}"),
    Rule("access", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),  # the same as runs of any length of which short ones are dropped
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("private_key", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
]
#: Codes whose states are held at a time.
CODES_AT_ONCE = 1 << 22
#: The kinds that every scan of the query must have.
BASE = ("assign", "access", "hex")


@dataclass(frozen=True)
class Scanner:
    """The two automata of a list of rules."""

    kinds: list[str]
    begins: Automaton
    matches: Automaton
    strict: list[int]

    @classmethod
    def of(cls, rules: list[Rule]) -> Scanner:
        patterns = [r.pattern for r in rules]
        strict, strictly = [], []
        for number, rule in enumerate(rules):
            strict.append(1 << (len(rules) + len(strictly) if rule.strict else number))
            strictly += [rule.strict] if rule.strict else []
        return cls(
            [r.kind for r in rules],
            compile_patterns(patterns, anchored=False, backwards=True),
            compile_patterns(patterns + strictly),
            strict,
        )

    def found(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, start, rule, end) of every span in texts that lie one behind the other, in bytes, in order."""
        texts = np.arange(len(offsets) - 1)
        # One end-of-text code behind each text keeps matches apart.
        codes = np.insert(self.begins.code[data], offsets[1:], self.begins.codes - 1)
        # From the end, some codes at a time, so that a text of any length takes little beside its bytes.
        found, state = [], None
        for high in range(len(codes), 0, -CODES_AT_ONCE):
            low = max(0, high - CODES_AT_ONCE)
            states = self.begins.along(codes[low:high][::-1], state)
            state, told = int(states[-1]), self.begins.output[states[::-1]]
            held = np.flatnonzero(told)
            found.append((held + low, told[held]))
        at, told = map(np.concatenate, zip(*found[::-1])) if found else (np.zeros(0, np.int64),) * 2
        if not len(at):
            return
        ends = offsets[1:] + texts
        owner = np.searchsorted(ends, at)
        text, held, free = -1, b"", []
        for place, which, rules in zip(at.tolist(), owner.tolist(), told.tolist()):
            if which != text:
                text, free = which, [0] * len(self.kinds)
                held = data[offsets[which] : offsets[which + 1]].tobytes()
            start = place - which - int(offsets[which])
            while rules:
                bit = rules & -rules
                rule = bit.bit_length() - 1
                rules ^= bit
                if start >= free[rule]:
                    free[rule], output = self.matches.longest(held, start, bit)
                    if output & self.strict[rule]:
                        yield which, start, rule, free[rule]

    def scan(self, column: pa.Array) -> pa.Array:
        """The spans of each text of a column."""
        counts, kinds, bounds = np.zeros(len(column), np.int64), [], []
        for first, end, data, offsets in text_rounds(column):
            spans = list(self.found(data, offsets))
            if not spans:
                continue
            # Code points before each byte: bytes that continue none.
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            which, starts, rules, ends = map(np.array, zip(*spans))
            np.add.at(counts, first + which, 1)
            begin = offsets[which]
            bounds.append(np.stack([points[begin + starts], points[begin + ends]]) - points[begin])
            kinds += [self.kinds[r] for r in rules.tolist()]
        bounds = np.concatenate(bounds, axis=1) if bounds else np.zeros((2, 0), np.int64)
        spans = pa.StructArray.from_arrays(
            [pa.array(kinds, pa.string()), pa.array(bounds[0], pa.int64()), pa.array(bounds[1], pa.int64())], ["kind", "start", "end"]
        )
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), spans)


def find_secrets(docs: DataFrame, rules: list[Rule] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans): every row with its spans, each a struct of kind, start and end."""
    scanner = Scanner.of(rules)

    def scan(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), scanner.scan(batch.column(1))], names=["key", "spans"])

    rows = need(docs, key, text).toDF("key", "text")
    found = rows.mapInArrow(scan, T.StructType([T.StructField("key", rows.schema["key"].dataType), T.StructField("spans", SPANS)]))
    return found.withColumnRenamed("key", key)


def of_kinds(kinds: tuple[str, ...], spans: str = "spans") -> Column:
    """The spans of the given kinds, in the same order."""
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def listed(spans: Column | str) -> Column:
    """Spans as text, ``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
