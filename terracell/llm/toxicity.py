"""Toxicity by multiple-instance learning: a text is toxic if one of its sentences is.

Labels are known for documents only. Each sentence gets a probability from the
patterns (pieces of words, with word borders) that it holds; a document's is
the noisy-or of its sentences. Pattern weights are fitted through that
noisy-or from document labels, and the same sentence scores then say where the
offence is. A sentence without any pattern adds nothing, so length alone never
raises a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracell.llm.shared import lean, release, slices

#: The fit's bound: so many labelled documents of each class at most, the first by hash of their id, of at most so many characters.
TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_CHARS = 2_000, 4_000, 20_000
#: Length of word pieces and, at most, of word beginnings, borders included; patterns kept, at most.
PIECE, STEM = 5, 10
PATTERNS = 4_096
#: Log-odds of a sentence before any pattern speaks.
BIAS = -4.0
STEPS, RATE, SHRINK = 1000, 0.2, 1e-3
THRESHOLD = 0.7

_SENTENCE = re.compile(r"[^.!?\n]+")
_GAP = re.compile(r"[\W_]+")


def _plain(text: str) -> str:
    """Lower-case words, one space around each."""
    return f" {_GAP.sub(' ', text.lower()).strip()} "


def _pieces(text: str) -> set[str]:
    """Every word with its borders, its stems and its pieces."""
    found = set()
    for word in set(_plain(text).split()):
        framed = f" {word} "
        found.add(framed[:32])
        found.update(framed[i : i + PIECE] for i in range(len(framed) - PIECE + 1))
        found.update(framed[:i] for i in range(4, min(len(framed), STEM) + 1))
    return found


def _chosen(texts: list[str], labels: np.ndarray) -> list[str]:
    """Patterns that toxic texts hold far more often than chance allows, given how many were tried (a G test)."""
    counts = [Counter(), Counter()]
    for text, label in zip(texts, labels, strict=True):
        counts[label].update(_pieces(text))
    toxic, clean = int(labels.sum()), int(len(labels) - labels.sum())
    if not toxic or not clean:
        return []
    least = 2 * np.log(max(2, len(counts[1]))) + 10
    ranked = []
    for piece, a in counts[1].items():
        c = counts[0][piece]
        if a < 3 or a * clean <= 4 * c * toxic:
            continue
        p, share = toxic / (toxic + clean), a / (a + c)
        g = 2 * (a * np.log(share / p) + (c * np.log((1 - share) / (1 - p)) if c else 0.0))
        if g >= least:
            ranked.append((-g, piece))
    return [piece for _, piece in sorted(ranked)[:PATTERNS]]


@dataclass
class Model:
    patterns: list[str]
    weights: np.ndarray

    def __post_init__(self):
        self._ready()

    def _ready(self):
        self.automaton = ahocorasick.Automaton()
        for k, p in enumerate(self.patterns):
            self.automaton.add_word(p, k)
        if self.patterns:
            self.automaton.make_automaton()

    def __getstate__(self):
        return self.patterns, self.weights

    def __setstate__(self, state):
        self.patterns, self.weights = state
        self._ready()

    def hits(self, sentence: str) -> set[int]:
        return {k for _, k in self.automaton.iter(_plain(sentence))} if self.patterns else set()

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The text's probability, and (start, end, probability) of each sentence that holds a pattern."""
        if not self.patterns or next(self.automaton.iter(_plain(text)), None) is None:
            return 0.0, []
        clean, found = 0.0, []
        for m in _SENTENCE.finditer(text):
            hit = self.hits(m[0])
            if hit:
                z = BIAS + float(self.weights[sorted(hit)].sum())
                rest = np.logaddexp(0, BIAS) - np.logaddexp(0, z)  # log(1 - q)
                clean += rest
                found.append((m.start(), m.end(), float(-np.expm1(rest))))
        return float(-np.expm1(clean)), found


def fit(texts: list[str], labels: list[int]) -> Model:
    """Weights (not negative) by gradient descent on the noisy-or's log loss; deterministic."""
    y = np.array(labels, dtype=np.int64)
    model = Model(_chosen(texts, y), np.zeros(0))
    if not model.patterns:
        return model
    rows, columns, owner = [], [], []
    for d, text in enumerate(texts):
        for m in _SENTENCE.finditer(text):
            hit = model.hits(m[0])
            if hit:
                rows += [len(owner)] * len(hit)
                columns += sorted(hit)
                owner.append(d)
    rows, columns, owner = np.array(rows), np.array(columns), np.array(owner)
    w = np.ones(len(model.patterns))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        z = BIAS + np.bincount(rows, w[columns], len(owner))
        rest = np.logaddexp(0, BIAS) - np.logaddexp(0, z)
        total = np.minimum(np.bincount(owner, rest, len(y)), -1e-9)
        slope = np.where(y == 1, np.exp(total) / -np.expm1(total), -1.0)  # of the loss by log(1 - score)
        by_z = slope[owner] * -1 / (1 + np.exp(-z))
        g = np.bincount(columns, by_z[rows], len(w)) / len(y) + SHRINK * w / len(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = np.maximum(0.0, w - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8))
    model.weights = w
    return model


def held_out(key: str) -> Column:
    """Whether a document's label must not be learnt from: crc32 of its id as text, modulo 3, is 1; false for a null id."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model from labelled documents that are not held out.

    The sample is bounded (TRAIN_*): ids are chosen from the labels alone, by
    hash, and only their texts are fetched. Null ids, labels and texts and
    texts over TRAIN_CHARS characters are left out of the fit; an id's repeated
    label is the larger, of its repeated texts the least counts. Without both
    classes the model scores 0 everywhere.
    """
    usable = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(key)).select(F.col(key).alias("__id"), F.col(label).cast("int").alias("__label"))
    usable = usable.groupBy("__id").agg(F.max("__label").alias("__label"))
    first = F.xxhash64("__id")
    chosen = [usable.filter(F.col("__label") == k).orderBy(first, "__id").limit(most).toPandas() for k, most in ((0, TRAIN_CLEAN), (1, TRAIN_TOXIC))]
    known = {int(i): k for k, part in enumerate(chosen) for i in part["__id"]}
    if not known:
        return Model([], np.zeros(0))
    ids = docs.sparkSession.createDataFrame([(i,) for i in known], "__id long")
    rows = docs.join(F.broadcast(ids), F.col(key) == F.col("__id"), "left_semi").filter(F.char_length(text) <= TRAIN_CHARS)
    # A repeated id is one document, the least of its texts; so at most TRAIN_* rows come here.
    rows = rows.groupBy(F.col(key).alias("__key")).agg(F.min(text).alias("__text"))
    rows = sorted((int(r[0]), r[1]) for r in rows.collect())
    model = fit([t for _, t in rows], [known[i] for i, _ in rows])
    del rows
    release()
    return model


def score_documents(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of df: doc_id, held_out, score, predicted, offending.

    offending lists the sentences (start and end in code points, score) that
    hold a pattern. Null and empty texts score 0; repeated rows give repeated
    results and an empty table none. Whole texts are read; nothing is shuffled;
    other columns are ignored.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in slices(batches, 2):
            found = [model.score(t) for t in batch.column(2).fill_null("").to_pylist()]
            scores = pa.array([s for s, _ in found], pa.float64())
            where = pa.array([[{"start": a, "end": b, "score": p} for a, b, p in places] for _, places in found], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), scores, where], names=["doc_id", "held_out", "score", "offending"])

    rows = df.select(F.col(key).cast("long").alias("doc_id"), held_out(key).alias("held_out"), F.col(text).cast("string").alias("text"))
    rows = rows.mapInArrow(lean(scored), "doc_id long, held_out boolean, score double, offending array<struct<start:int,end:int,score:double>>")
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "offending")


def clean_rows(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """df without the rows whose text the model rejects; columns unchanged, nothing shuffled."""

    at = df.columns.index(text)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            yield batch.filter(pa.array([model.score(t)[0] < THRESHOLD for t in batch.column(at).fill_null("").to_pylist()], pa.bool_()))

    return df.mapInArrow(lean(kept), df.schema)
