"""URL filters: rules first, then segmented host words and path tokens under multinomial naive Bayes.

Hosts concatenate words. A unigram model of words (counted over all pages)
splits each host label by Viterbi into its likeliest words. Pages that a rule
decides are the training set: tokens are counted by verdict over all of them,
and naive Bayes judges the pages that no rule fits.

No word or token is left out for being rare. A label is split once, in a block
of labels, with the counts of those words that are substrings of the block's
labels: no other word can change a split. Evidence of tokens ships to tasks
while there are few; beyond that tokens are joined to it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracell.llm.shared import discard, small, written

#: (verdict, host and path): a rule fits its host and all subdomains, where the path starts with the rule's.
RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]
#: Labels that are split together, about; tokens whose evidence ships to tasks, at most.
BLOCK_LABELS, HELD_TOKENS = 20_000, 100_000
LONGEST_WORD = 24
_LETTERS = re.compile(r"[^\W\d_]+|\d+")
_TAG = re.compile(r"<[^>]*>")


def parts(url: str | None) -> tuple[str, str]:
    """(host, path): both empty without ``://``; A-Z of the host become a-z."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    cut = re.search(r"[/?#]", rest)
    host, rest = (rest[: cut.start()], rest[cut.start() :]) if cut else (rest, "")
    host = re.sub(r"[A-Z]", lambda m: m[0].lower(), host)
    return host, re.split(r"[?#]", rest, maxsplit=1)[0]


def ruling(host: str, path: str, rules=tuple(RULES)) -> tuple[str, str] | None:
    """(verdict, rule) of the longest rule that fits, or None."""
    best = None
    for verdict, rule in rules:
        own, slash, start = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith(slash + start) and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return best


class Segmenter:
    """Viterbi over unigram log-probabilities; an unknown word costs more the longer it is."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        """total: of all words, where counts has only those that can occur."""
        total = max(1, sum(counts.values()) if total is None else total)
        self.costs = {w: math.log(total) - math.log(c) for w, c in counts.items()}
        self.unknown = math.log(total) + math.log(10)
        self.split = lru_cache(maxsize=100_000)(self._split)

    def __getstate__(self):
        return self.costs, self.unknown

    def __setstate__(self, state):
        self.costs, self.unknown = state
        self.split = lru_cache(maxsize=100_000)(self._split)

    def _split(self, name: str) -> tuple[str, ...]:
        best = [0.0] + [math.inf] * len(name)
        back = [0] * (len(name) + 1)
        for end in range(1, len(name) + 1):
            for start in range(max(0, end - LONGEST_WORD), end):
                word = name[start:end]
                cost = best[start] + self.costs.get(word, self.unknown + 2.3 * len(word))
                if cost < best[end]:
                    best[end], back[end] = cost, start
        words, end = [], len(name)
        while end:
            words.append(name[back[end] : end])
            end = back[end]
        return tuple(reversed(words))


def labels(host: str) -> list[str]:
    return [label for label in re.split(r"[^\w]+", host) if label]


def tokens(words: list[str], path: str) -> list[str]:
    """Words of the host's labels and tokens of the path; numbers in paths count by length."""
    return [f"h:{w}" for w in words] + [f"p:#{len(t)}" if t.isdigit() else f"p:{t.lower()}" for t in _LETTERS.findall(path)]


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter[str] = Counter()
        for html in batch.column(0):
            if html.is_valid:
                counts.update(w.lower() for w in re.findall(r"[^\W\d_]+", _TAG.sub(" ", html.as_py())) if len(w) <= LONGEST_WORD)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def word_counts(pages: DataFrame, html: str = "html") -> DataFrame:
    """(word, n) of all words of all pages, as a written table."""
    return written(pages.select(F.col(html).cast("string").alias("html")).mapInArrow(_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "url-words")


def _substrings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each label the substrings that a word may be, once for each block and batch."""
    for batch in batches:
        found: set[tuple[int, str]] = set()
        for block, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for run in re.findall(r"[^\W\d_]+", label):
                found.update((block, run[a:b]) for a in range(len(run)) for b in range(a + 1, min(len(run), a + LONGEST_WORD) + 1))
        listed = sorted(found)
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in listed], pa.int32()), pa.array([x[1] for x in listed], pa.string())], names=["block", "word"])


def split_labels(named: DataFrame, counts: DataFrame, block_labels: int = BLOCK_LABELS) -> DataFrame:
    """(label, words) of every distinct label; named and counts are written tables."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-named.count() // block_labels))
    named = named.select(F.pmod(F.xxhash64("label"), F.lit(blocks)).cast("int").alias("block"), "label")
    candidates = written(named.mapInArrow(_substrings, "block int, word string").distinct(), "url-candidates")
    known = counts.join(small(candidates), "word").select("block", "word", "n")

    def split(own: pa.Table, words: pa.Table) -> pa.Table:
        segmenter = Segmenter(dict(zip(words.column("word").to_pylist(), words.column("n").to_pylist(), strict=True)), total)
        listed = own.column("label").to_pylist()
        return pa.table({"label": pa.array(listed, pa.string()), "words": pa.array([list(segmenter.split(x)) for x in listed], pa.list_(pa.string()))})

    cut = named.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(split, "label string, words array<string>")
    cut = written(cut, "url-labels")
    discard(candidates)
    return cut


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([labels(h) for h in batch.column(0).to_pylist()], pa.list_(pa.string()))], names=["host", "labels"])


def host_words(rows: DataFrame, counts: DataFrame, block_labels: int = BLOCK_LABELS) -> DataFrame:
    """(host, words) of every distinct host that has labels, as a written table."""
    hosts = written(rows.select("host").distinct().mapInArrow(_labelled, "host string, labels array<string>"), "url-hosts")
    named = written(hosts.select(F.explode("labels").alias("label")).distinct(), "url-named")
    cut = split_labels(named, counts, block_labels)
    joined = hosts.select("host", F.posexplode("labels").alias("place", "label")).join(small(cut), "label")
    words = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("place", "words"))), lambda x: x["words"]))
    found = written(joined.groupBy("host").agg(words.alias("words")), "url-host-words")
    discard(hosts, named, cut)
    return found


def evidence(allow: int, block: int, totals: tuple[int, int]) -> float:
    """Log-odds of block by a token, with Laplace smoothing; totals count tokens and distinct tokens by verdict."""
    return math.log((block + 1) / max(1, totals[1])) - math.log((allow + 1) / max(1, totals[0]))


def learn(rows: DataFrame) -> tuple[float, DataFrame]:
    """(log-odds of block before any token, (token, evidence) of all tokens): counted over all rows that a rule decides."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for verdict, words, path in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                for t in ["", *tokens(words, path)]:  # the empty token counts pages
                    counts.setdefault(t, [0, 0])[verdict == "block"] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([c[0] for c in counts.values()], pa.int64()), pa.array([c[1] for c in counts.values()], pa.int64())], names=["token", "allow", "block"])

    ruled = rows.filter(F.col("rule").isNotNull()).select("ruled", "words", "path")
    counts = written(ruled.mapInArrow(count, "token string, allow long, block long").groupBy("token").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")), "url-tokens")
    named = counts.filter("token <> ''")
    allow, block, distinct = named.agg(F.coalesce(F.sum("allow"), F.lit(0)), F.coalesce(F.sum("block"), F.lit(0)), F.count("*")).first()
    totals = allow + distinct, block + distinct
    pages = counts.filter("token = ''").first()
    prior = math.log((pages.block + 1) / (pages.allow + 1)) if pages else 0.0

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [evidence(a, b, totals) for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.float64())], names=["token", "evidence"])

    known = written(named.mapInArrow(weigh, "token string, evidence double"), "url-evidence")
    discard(counts)
    return prior, known


OUT = "page_id long, host string, path string, rule string, verdict string, block_odds double, words string"


def judge(rows: DataFrame, prior: float, known: DataFrame, held: int = HELD_TOKENS) -> DataFrame:
    """One row per row of rows: page_id, host, path, rule, verdict, block_odds, words. Unknown tokens say nothing.

    Repeated rows give repeated results, an empty table none.

    With more than held tokens each row's tokens are joined to their evidence;
    sums are exactly rounded, so both ways give the same odds.
    """
    own = {r["token"]: r["evidence"] for r in known.collect()} if known.count() <= held else None

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page_id, host, path, rule, ruled, words = (batch.column(k) for k in ("page_id", "host", "path", "rule", "ruled", "words"))
            words = words.to_pylist()
            if own is not None:
                found = [[own[t] for t in tokens(w, p) if t in own] for w, p in zip(words, path.to_pylist(), strict=True)]
            else:
                found = batch.column("found").to_pylist()
            odds = [math.fsum([prior, *(f or [])]) for f in found]
            verdict = [r or ("block" if o > 0 else "allow") for r, o in zip(ruled.to_pylist(), odds, strict=True)]
            columns = [page_id, host, path, rule, pa.array(verdict, pa.string()), pa.array(odds, pa.float64()), pa.array([" ".join(w) for w in words], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "host", "path", "rule", "verdict", "block_odds", "words"])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(r, t) for r, w, p in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True) for t in tokens(w, p)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in pairs], pa.int64()), pa.array([x[1] for x in pairs], pa.string())], names=["row", "token"])

    if own is None:
        joined = rows.select("row", "words", "path").mapInArrow(listed, "row long, token string").join(small(known), "token")
        rows = rows.join(joined.groupBy("row").agg(F.collect_list("evidence").alias("found")), "row", "left")
    return rows.mapInArrow(decide, OUT)


def filter_urls(pages: DataFrame, rules=tuple(RULES), key: str = "page_id", url: str = "url", held: int = HELD_TOKENS, block_labels: int = BLOCK_LABELS) -> DataFrame:
    """The whole method on a table of pages (page_id, url, html); other columns are ignored.

    A null url, or one without ``://``, has an empty host and path, fits no
    rule and gets the prior's verdict. rule is null where the model decides.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [parts(u) for u in batch.column(2).to_pylist()]
            ruled = [ruling(h, p, rules) or (None, None) for h, p in own]
            columns = [*zip(*own, strict=True), [r[1] for r in ruled], [r[0] for r in ruled]] if own else [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(list(c), pa.string()) for c in columns)], names=["row", "page_id", "host", "path", "rule", "ruled"])

    asked = pages.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"))
    rows = written(asked.mapInArrow(read, "row long, page_id long, host string, path string, rule string, ruled string"), "url-rows")
    counts = word_counts(pages)
    words = host_words(rows, counts, block_labels)
    discard(counts)
    rows = rows.join(small(words), "host", "left").withColumn("words", F.coalesce("words", F.array().cast("array<string>")))
    return judge(rows, *learn(rows), held)
