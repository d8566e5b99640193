"""URL filters: a bit-parallel wildcard automaton over canonical URLs.

Every glob rule becomes a run of bits in one multiword Shift-And mask: one bit for each literal
byte, and a bit that keeps itself for a ``*``.  A batch of URLs is run through the automaton in
lockstep, one byte of every URL per step, so that all rules are matched at once and the cost does
not depend on how many of them fit.

A canonical URL is the lower-cased host (A-Z only), its labels untouched, followed by the path;
query and fragment are cut off.  A null URL, or one without ``://``, has an empty host and path.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import need, schema

A_TO_Z, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, below a path prefix."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> tuple[str, str]:
        return f"{self.host}{self.path}*", f"*.{self.host}{self.path}*"


class Automaton:
    """All globs in one mask of 64-bit words; ``*`` stands for any bytes, all else for itself.

    A ``*`` needs no bit of its own: the bit before it, once set, stays set.  A leading ``*`` stands
    for the front of a host: the bit behind it is offered at each step up to the first ``/``, the
    first bit of another glob at the first step only.
    """

    def __init__(self, globs: list[str]):
        first, loose, stays, final, letters = [], [], [], [], []
        self.pattern_of_bit: dict[int, int] = {}
        for number, glob in enumerate(globs):
            parts = glob.encode()
            opened = len(letters)
            for byte in parts:
                if byte == ord("*"):
                    if len(letters) > opened:
                        stays.append(len(letters) - 1)
                    continue
                letters.append(byte)
            if len(letters) == opened:
                raise ValueError("a rule needs at least one literal byte")
            (loose if parts[:1] == b"*" else first).append(opened)
            final.append(len(letters) - 1)
            self.pattern_of_bit[len(letters) - 1] = number
        self.words = (len(letters) + 63) // 64
        self.first, self.loose, self.stays, self.final = map(self._mask, (first, loose, stays, final))
        # A bit that ends a rule must not run on into the first bit of the next one.
        self.starts = self._mask(first + loose)
        self.of_byte = np.stack(
            [self._mask([i for i, x in enumerate(letters) if x == byte]) for byte in range(256)]
        )

    def _mask(self, bits: list[int]) -> np.ndarray:
        mask = np.zeros(self.words, np.uint64)
        for bit in bits:
            mask[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)
        return mask

    def matches(self, urls: list[bytes]) -> np.ndarray:
        """For each URL the state after its last byte, reduced to the bits that end a rule."""
        state = np.zeros((len(urls), self.words), np.uint64)
        lengths = np.array([len(u) for u in urls], np.int64)
        order = np.argsort(-lengths, kind="stable")
        longest = int(lengths.max(initial=0))
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(urls) else lengths
        data = np.frombuffer(b"".join(urls), np.uint8)
        alive = np.searchsorted(-lengths[order], -np.arange(1, longest + 1), side="right")
        in_host = np.ones(len(urls), bool)
        one, top, none = np.uint64(1), np.uint64(63), np.uint64(0)
        for step in range(longest):
            rows = order[: alive[step]]
            old = state[rows]
            moved = old << one
            moved[:, 1:] |= old[:, :-1] >> top
            moved &= ~self.starts
            moved |= np.where(in_host[rows, None], self.loose, none)
            if step == 0:
                moved |= self.first
            byte = data[starts[rows] + step]
            state[rows] = (moved & self.of_byte[byte]) | (old & self.stays)
            in_host[rows] &= byte != ord("/")
        return state & self.final

    def patterns(self, ended: np.ndarray) -> list[list[int]]:
        """The numbers of the globs whose final bits are set, for each row."""
        found: list[list[int]] = [[] for _ in range(len(ended))]
        for bit, number in self.pattern_of_bit.items():
            for row in np.flatnonzero(ended[:, bit // 64] >> np.uint64(bit % 64) & np.uint64(1)):
                found[row].append(number)
        return found


def host_of(url: str) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, A_TO_Z, SMALL), F.lit(""))


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(pages: DataFrame, rules: list[Rule], otherwise: str = "allow", key: str = "page_id") -> DataFrame:
    """One row per page: its key, host, path, the rule that holds and the verdict.

    The longest rule that fits wins, of equal ones the first given.  A page that no rule fits gets
    ``otherwise`` and a null rule; so does a null or unreadable URL.  Repeated rows each get a row;
    an empty table gives an empty result; other columns are not looked at.  One narrow pass, no
    shuffle, and no memory beyond a batch.
    """
    automaton = Automaton([glob for rule in rules for glob in rule.globs()])
    kind = pages.schema[key].dataType.simpleString()

    def judge(batches):
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            ended = automaton.matches([(h + p).encode() for h, p in zip(hosts, paths)])
            won: list[Rule | None] = []
            for numbers in automaton.patterns(ended):
                fitting = [rules[n // 2] for n in sorted(numbers)]
                won.append(max(fitting, key=lambda r: len(r.name), default=None))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.array([r and r.name for r in won], pa.string()),
                    pa.array([r.verdict if r else otherwise for r in won], pa.string()),
                ],
                names=[key, "host", "path", "rule", "verdict"],
            )

    urls = need(pages, key, "url").select(
        F.col(key), host_of("url").alias("host"), path_of("url").alias("path")
    )
    return urls.mapInArrow(judge, schema(f"`{key}` {kind}, host string, path string, rule string, verdict string"))
