"""Operator 6, secret scans: fixed patterns and Shannon entropy over sliding windows."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from cardmill.llm.common import free, ship

# The base patterns and the least length of what they must find.
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "entropy")

# The candidate strings of the entropy scan, and for each character class the least bits a character in a window.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
CLASSES: tuple[tuple[str, re.Pattern, float], ...] = (
    ("hex", re.compile(r"[0-9a-fA-F]+"), 3.0),
    ("alphanumeric", re.compile(r"[0-9A-Za-z]+"), 3.6),
    ("base64", re.compile(r"[0-9A-Za-z+/_=-]+"), 3.8),
)
# A piece of a longer string that is a word with a short number, as in paths and names.
WORD = re.compile(r"[A-Za-z]+[0-9]{0,4}")
# Strings that look random but are none: words, numbers, dashed words and numbers, UUIDs, paths, rulers, samples.
ALLOWED: tuple[re.Pattern, ...] = (
    re.compile(r"[-_/+=]*[A-Za-z]+(?:[-_/+=]+[A-Za-z]+)*[-_/+=]*"),
    re.compile(r"[0-9+/_=-]+"),
    re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
    re.compile(r"[-_=+/]*(?:[A-Za-z]+[0-9]{0,4}[-_/+=]+)+[A-Za-z]*[0-9]{0,4}"),
    re.compile(r".*(?:EXAMPLE|example|placeholder|xxxxxx|XXXXXX).*"),
)

_TERM = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def entropy_runs(text: str, least: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """The ranges that windows with at least ``least`` bits a character cover, merged.

    Counts change by one character in and one out at each step, so a string costs its length.
    """
    if len(text) < window:
        return []
    counts: dict[str, int] = defaultdict(int)
    term = _TERM if window == WINDOW else [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    limit = window * (math.log2(window) - least) + 1e-9  # the most that the sum of c log c may be
    total, runs = 0.0, []
    for i, ch in enumerate(text):
        c = counts[ch]
        counts[ch] = c + 1
        total += term[c + 1] - term[c]
        if i >= window:
            old = text[i - window]
            c = counts[old]
            counts[old] = c - 1
            total += term[c - 1] - term[c]
        if i >= window - 1 and total <= limit:
            start = i - window + 1
            if runs and runs[-1][1] >= start:
                runs[-1] = (runs[-1][0], i + 1)
            else:
                runs.append((start, i + 1))
    return runs


def entropy_spans(text: str, allowed: Sequence[re.Pattern] = ALLOWED) -> Iterator[tuple[int, int]]:
    """Ranges of high entropy in candidate strings, merged.

    Each longest run of a character class in a candidate is scanned with the bits of its class, so that a key behind
    a prefix is measured as the key alone is. A run that an allow-list pattern matches in full is left out, as is
    a word with a short number inside a longer string; the rest of its candidate is not excused by it, nor it by that.
    """
    for found in CANDIDATE.finditer(text):
        string, seen, ranges = found.group(), set(), []
        for _, chars, least in CLASSES:
            for run in chars.finditer(string):
                if run.end() - run.start() < WINDOW or run.span() in seen:
                    continue
                seen.add(run.span())
                piece = run.group()
                word = len(piece) < len(string) and WORD.fullmatch(piece)
                if word or any(p.fullmatch(piece) for p in allowed):
                    continue
                ranges += [(run.start() + s, run.start() + e) for s, e in entropy_runs(piece, least)]
        merged: list[tuple[int, int]] = []
        for start, end in sorted(ranges):
            if merged and merged[-1][1] >= start:
                merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
            else:
                merged.append((start, end))
        for start, end in merged:
            yield found.start() + start, found.start() + end


_KEYWORDS = ("passw", "secret", "token", "api")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order of start and kind."""
    spans = []
    lower = text.lower()
    if any(k in lower for k in _KEYWORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(1)) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def scan(text: str | None) -> list[tuple[int, int, int]]:
    """All (start, kind, end) of a text: base spans and the entropy spans, in order of start, kind and end."""
    if not text:
        return []
    return sorted(base_spans(text) + [(s, 3, e) for s, e in entropy_spans(text)])


SPAN = StructType(
    [StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())]
)


def find_secrets(docs: DataFrame, text_col: str = "text", spans_col: str = "secret_spans") -> DataFrame:
    """Adds the array of (kind, start, end) found in the whole text, in code points with ``end`` exclusive.

    Kinds are assign, access, hex and entropy, ordered by start and then in this order; spans of different kinds
    may overlap. Null and empty texts have an empty array. Other columns pass through, and an input column named
    like the result is replaced. One row needs no other, so tasks keep only the batch they read.
    """
    docs = free(docs, spans_col)
    ship(docs.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            found = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scan(t)] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, kind)], [*batch.schema.names, spans_col]
            )

    return docs.mapInArrow(batches, StructType([*docs.schema.fields, StructField(spans_col, ArrayType(SPAN))]))
