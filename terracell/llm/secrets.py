"""Secret scans with one combined deterministic automaton (see automaton)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracell.llm.automaton import Automaton, Rule

_NAME = r"(?i:password|passwd|secret|token|api_?key)"
_ASSIGN = _NAME + r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]"""
#: Base rules in the order of the contract, then those that this scan adds.
BASE = [
    Rule("assign", _ASSIGN + "{6,}", consumes=_ASSIGN + "+"),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
]
ADDED = [
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("pem", "-----BEGIN [A-Z]*\\x20?[A-Z]*\\x20?PRIVATE KEY-----"),
]
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A string column's bytes and each row's start and stop; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw, bounds[:-1].copy(), bounds[1:].copy()


def _listed(spans, names: list[str]) -> str:
    return ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)


def secret_spans(df: DataFrame, rules: list[Rule] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of df: doc_id, counts of the base kinds, base_sha256, spans.

    A null text counts as empty and has no spans. Offsets are code points, end
    exclusive. Whole texts are scanned; a partition holds one Arrow batch at a
    time. No shuffle. Other columns are ignored; repeated rows give repeated
    results; an empty table gives an empty one.
    """
    rules = BASE + (ADDED if rules is None else rules)
    machine = Automaton(rules)  # compiled once, on the driver: arrays of a size that only the rules decide
    names, base = [r.kind for r in rules], len(BASE)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts, stops = text_bytes(batch.column(1))
            found = machine.spans(data, starts, stops)
            none = hashlib.sha256(b"").hexdigest()
            counts = np.zeros((len(starts), base), dtype=np.int64)
            digests, listed = [none] * len(starts), [""] * len(starts)
            for t, spans in found.items():
                points = np.cumsum((data[starts[t] : stops[t]] & 0xC0) != 0x80)
                points = np.concatenate(([0], points))
                spans = [(int(points[a]), k, int(points[b])) for a, k, b in spans]
                own = [s for s in spans if s[1] < base]
                for _, k, _ in own:
                    counts[t, k] += 1
                digests[t] = hashlib.sha256(_listed(own, names).encode()).hexdigest()
                listed[t] = _listed(spans, names)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(counts[:, k]) for k in range(base)), pa.array(digests, pa.string()), pa.array(listed, pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(scan, SCHEMA)
