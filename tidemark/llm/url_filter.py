"""URL rules as one bit-parallel wildcard automaton.

Globs are compiled into the masks of a Shift-And automaton whose states are
packed into 64-bit words, and all patterns advance together over the bytes of
each canonical URL (host + path). ``*`` is any run without ``/``, ``**`` any
run, ``?`` one byte that is no ``/``.

Defined results: a URL that is NULL or has no ``://`` has an empty host and
path, matches no host rule and gets the default verdict; an empty table gives
an empty result; repeated rows are judged one by one; all columns of the input
but those added are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STEP_ROWS = 8192
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    """``host`` and its subdomains, for paths that begin with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> tuple[str, ...]:
        return (f"{self.host}{self.path}**", f"*.{self.host}{self.path}**")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lowered."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class ShiftAnd:
    """Masks of all patterns, one bit per pattern position and a start bit each."""

    def __init__(self, globs: list[str]):
        steps: list[tuple[str | None, str]] = []  # per state: the byte that enters it (None: start), its loop
        self.accept: list[int] = []
        starts: list[int] = []
        for glob in globs:
            starts.append(len(steps))
            steps.append((None, ""))
            raw = glob.encode()
            i = 0
            while i < len(raw):
                c = raw[i : i + 1].decode("latin-1")
                if c == "*":
                    wide = raw[i : i + 2] == b"**"
                    enter, loop = steps[-1]
                    steps[-1] = (enter, "any" if wide or loop == "any" else "part")
                    i += 2 if wide else 1
                    continue
                steps.append((c, ""))
                i += 1
            self.accept.append(len(steps) - 1)
        self.words = max(1, -(-len(steps) // 64))
        self.enter = np.zeros((256, self.words), np.uint64)
        self.loop = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        every, part = np.ones(256, bool), np.ones(256, bool)
        part[ord("/")] = False
        for i, (enter, loop) in enumerate(steps):
            word, bit = i // 64, np.uint64(1 << (i % 64))
            if enter is None:
                self.start[word] |= bit
            elif enter == "?":
                self.enter[part, word] |= bit
            else:
                self.enter[ord(enter), word] |= bit
            if loop:
                self.loop[every if loop == "any" else part, word] |= bit

    def run(self, urls: list[bytes]) -> np.ndarray:
        """A row of booleans per URL: which patterns match it as a whole.

        URLs are sorted by length and leave the simulation as they end.
        """
        sizes = np.fromiter(map(len, urls), np.int64, len(urls))
        order = np.argsort(-sizes, kind="stable")
        flat = np.frombuffer(b"".join(urls), np.uint8)
        begin = (np.cumsum(sizes) - sizes)[order]
        lengths = sizes[order]
        state = np.tile(self.start, (len(urls), 1))
        alive = len(urls)
        for at in range(int(lengths[0]) if len(urls) else 0):
            while alive and lengths[alive - 1] <= at:
                alive -= 1
            byte = flat[begin[:alive] + at]
            now = state[:alive]
            shifted = now << np.uint64(1)
            shifted[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:alive] = (shifted & self.enter[byte]) | (now & self.loop[byte])
        accept = np.array(self.accept)
        hit = (state[:, accept // 64] >> (accept % 64).astype(np.uint64)) & np.uint64(1)
        out = np.empty(hit.shape, bool)
        out[order] = hit.astype(bool)
        return out


def judge_urls(df: DataFrame, url: str, rules: list[UrlRule], default: str = "allow") -> DataFrame:
    """Add host, path, rule (the longest that fits, else NULL) and verdict."""
    for name in ("host", "path", "rule", "verdict"):
        df = df.drop(name) if name != url else df
    ordered = sorted(rules, key=lambda r: -len(r.name))
    globs = [g for r in ordered for g in r.globs()]
    owner = [i for i, r in enumerate(ordered) for _ in r.globs()]
    names, verdicts = [r.name for r in ordered], [r.verdict for r in ordered]
    ready = df.withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    schema = T.StructType([*ready.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = ShiftAnd(globs)
        first = np.array([owner.index(i) for i in range(len(ordered))], np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, STEP_ROWS):
                batch = whole.slice(at, STEP_ROWS)
                hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
                hit = machine.run([(h + p).encode() for h, p in zip(hosts, paths)])
                if ordered:
                    fits = np.logical_or.reduceat(hit, first, axis=1)
                    best = np.where(fits.any(axis=1), fits.argmax(axis=1), -1)
                else:
                    best = np.full(len(hosts), -1)
                rule = pa.array([names[i] if i >= 0 else None for i in best], pa.string())
                verdict = pa.array([verdicts[i] if i >= 0 else default for i in best], pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, rule, verdict], names=[*batch.schema.names, "rule", "verdict"])

    return ready.mapInArrow(judge, schema)
