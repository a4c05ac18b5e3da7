"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary resolves a pre-token that
is itself a token. Tier two: a pre-token that is not goes through a heap over
linked bytes, which merges the pair of lowest rank, leftmost first, until no
pair is in the vocabulary. The ranks are read on the driver, by path, and ship
as arrays of the vocabulary's size.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracell.llm.shared import lean, slices

#: Keys in a bucket of the perfect hash, on average.
LOAD = 4
#: Pre-tokens whose ids a worker remembers in a generation; beyond that the generation before is forgotten.
MEMO = 100_000
#: The first links of short pre-tokens.
NEXT, LAST = list(range(1, 257)), list(range(-1, 255))


class PerfectHash:
    """Minimal perfect hash by hash and displace: n keys, n slots, one displacement per bucket.

    Buckets are placed from the largest on; a bucket with one key stores its
    slot itself, as -1 - slot, so the last free slots need no search.
    """

    def __init__(self, keys: list[bytes]):
        self.n, self.buckets = len(keys), max(1, len(keys) // LOAD)
        self.shift = [0] * self.buckets
        self.slots: list[bytes | None] = [None] * self.n
        self.values = [-1] * self.n
        groups: dict[int, list[int]] = {}
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        for i, h in enumerate(hashes):
            groups.setdefault(h % self.buckets, []).append(i)
        free = [True] * self.n
        rest = 0
        for b, members in sorted(groups.items(), key=lambda g: -len(g[1])):
            d = 0
            if len(members) == 1:
                while not free[rest]:
                    rest += 1
                d = -1 - rest
            while True:
                spots = [self._slot(hashes[i], d) for i in members]
                if len(set(spots)) == len(spots) and all(free[s] for s in spots):
                    break
                d += 1
            self.shift[b] = d
            for i, s in zip(members, spots, strict=True):
                free[s], self.slots[s], self.values[s] = False, keys[i], i

    def _slot(self, h: int, d: int) -> int:
        if d < 0:
            return -1 - d
        return (((h ^ d * 0x9E3779B97F4A7C15) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF) >> 32) % self.n

    def get(self, key: bytes) -> int:
        """The key's number, or -1: one probe, one comparison."""
        h = xxhash.xxh3_64_intdigest(key)
        s = self._slot(h, self.shift[h % self.buckets])
        return self.values[s] if self.slots[s] == key else -1


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    with open(path, "rb") as f:
        return [(base64.b64decode(a), int(b)) for a, b in map(bytes.split, f)]


class Codec:
    """Encoder and decoder for one vocabulary and one pre-token pattern."""

    def __init__(self, ranks: list[tuple[bytes, int]], pattern: str):
        self.ids = [i for _, i in ranks]
        self.hash = PerfectHash([t for t, _ in ranks])
        self.pieces = {i: t for t, i in ranks}
        by_piece = dict(ranks)
        self.single = [by_piece[bytes([b])] for b in range(256)]
        self.first = [by_piece.get(bytes([a, b])) for a in range(256) for b in range(256)]
        self.table = pa.array([self.pieces.get(i) for i in range(max(self.ids) + 1)], pa.binary())
        # By left id, right id: the token of every way to cut a token into two tokens.
        none: dict[int, int] = {}
        self.pairs = [none] * (max(self.ids) + 1)
        for t, i in ranks:
            for c in range(1, len(t)):
                left, right = by_piece.get(t[:c]), by_piece.get(t[c:])
                if left is not None and right is not None:
                    if self.pairs[left] is none:
                        self.pairs[left] = {}
                    self.pairs[left][right] = i
        # The vocabularies' own library takes white space as Unicode's White_Space property.
        self.pattern = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self._ready()

    def _ready(self) -> None:
        self.split = regex.compile(self.pattern).findall
        self.units = regex.compile(r"\p{White_Space}*\P{White_Space}+|\p{White_Space}+").findall
        self.memo: dict[str, tuple[int, ...]] = {}  # ids by pre-token
        self.older: dict[str, tuple[int, ...]] = {}  # the memo before this one

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("split", "units", "memo", "older")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._ready()

    def rank(self, piece: bytes) -> int:
        """Tier one: the id of a piece that is a token, or -1."""
        at = self.hash.get(piece)
        return -1 if at < 0 else self.ids[at]

    def merged(self, piece: bytes) -> list[int]:
        """Tier two: ids of a pre-token that is no token.

        Bytes are linked both ways; a heap holds (rank, place) of pairs that
        make a token, as one number. A popped pair is valid if its left part
        still makes that rank with the part after it.
        """
        n = len(piece)
        bits = n.bit_length()
        place = (1 << bits) - 1
        pairs, push, pop = self.pairs, heapq.heappush, heapq.heappop
        single, first = self.single, self.first
        ids = [single[b] for b in piece]
        rank = [first[a << 8 | b] for a, b in zip(piece, piece[1:])]
        rank.append(None)
        after, before = (NEXT[:n], LAST[:n]) if n <= len(NEXT) else (list(range(1, n + 1)), list(range(-1, n - 1)))
        heap = [r << bits | i for i, r in enumerate(rank) if r is not None]
        heapq.heapify(heap)
        while heap:
            top = pop(heap)
            r, i = top >> bits, top & place
            if rank[i] != r:
                continue
            j = after[i]
            ids[i], ids[j], rank[j] = r, -1, None
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                made = rank[i] = pairs[r].get(ids[j])
                if made is not None:
                    push(heap, made << bits | i)
            else:
                rank[i] = None
            k = before[i]
            if k >= 0:
                made = rank[k] = pairs[ids[k]].get(r)
                if made is not None:
                    push(heap, made << bits | k)
        return [x for x in ids if x >= 0]

    def word(self, piece: str) -> tuple[int, ...]:
        """ids of one pre-token."""
        known = self.memo.get(piece)
        if known is None:
            known = self.older.get(piece)
            if known is None:
                raw = piece.encode()
                r = self.rank(raw)
                known = (r,) if r >= 0 else tuple(self.merged(raw))
            self.memo[piece] = known
        return known

    def unit(self, text: str) -> tuple[int, ...]:
        """ids of a text, each match of the pattern by itself."""
        body = text[1:] if text[0] == " " else text
        if body.isalpha() and (body.isascii() or max(body) < "\u0250"):  # one run of Latin letters: the pattern would match all of it
            return self.word(text)
        if len(body) > 1 and body[-1] in ",." and body[:-1].isalpha() and (body.isascii() or max(body) < "\u0250"):
            return self.word(text[:-1]) + self.word(body[-1])
        return tuple(chain.from_iterable(map(self.word, self.split(text))))

    def known(self, units: list[str]) -> list[tuple[int, ...]]:
        """ids of each unit; pre-tokens met lately are remembered, in two generations."""
        if len(self.memo) > MEMO:
            self.memo, self.older = {}, self.memo
        unit, memo = self.unit, self.memo
        return [memo.get(u) or (unit(u) if u else ()) for u in units]

    def encode(self, text: str) -> list[int]:
        """ids of a whole text.

        A pre-token never goes on from a character that is not white space to
        one that is, so texts are cut before white space into units that are
        looked up whole. Where no two spaces meet, cutting before each space
        suffices.
        """
        if "  " in text:
            units = self.units(text)
        else:
            first, *rest = text.split(" ")
            units = [first, *[" " + u for u in rest]]
        return list(chain.from_iterable(self.known(units)))

    def encode_column(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of all texts without nulls: text i has ids[offsets[i] : offsets[i + 1]].

        Arrow cuts the texts at spaces and numbers the distinct units, so only
        those are looked up. Texts in which two spaces meet go one by one.
        """
        apart = pc.match_substring(texts, "  ")
        odd = np.flatnonzero(apart.to_numpy(zero_copy_only=False))
        cut = pc.split_pattern(pc.if_else(apart, "", texts) if len(odd) else texts, " ")
        starts = cut.offsets.to_numpy()
        units = cut.values.slice(starts[0], starts[-1] - starts[0]).dictionary_encode()
        starts = starts - starts[0]
        code = units.indices.to_numpy().copy()
        distinct = len(units.dictionary)
        firsts = units.dictionary.take(units.indices.take(pa.array(starts[:-1])))  # a text's first unit has no space before it
        table = self.known(pc.binary_join_element_wise("", units.dictionary, " ").to_pylist()) + self.known(firsts.to_pylist())
        code[starts[:-1]] = distinct + np.arange(len(texts))
        for i in odd.tolist():
            table[distinct + i] = tuple(self.encode(texts[i].as_py()))
        ends = np.cumsum(np.fromiter(map(len, table), np.int32, len(table)), dtype=np.int32)
        flat = np.fromiter(chain.from_iterable(table), np.int32, int(ends[-1]) if len(ends) else 0)
        laid = pa.ListArray.from_arrays(pa.array(np.concatenate((np.zeros(1, np.int32), ends))), pa.array(flat)).take(pa.array(code))
        return laid.offsets.to_numpy()[starts], laid.values.to_numpy()

    def decode_column(self, offsets: np.ndarray, ids: np.ndarray) -> pa.BinaryArray:
        """The bytes of each text, from encode_column's form."""
        taken = self.table.take(pa.array(ids))
        _, ends, data = taken.buffers()
        places = np.frombuffer(ends, np.int32)[taken.offset : taken.offset + len(taken) + 1]
        return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(places[offsets].tobytes()), data])

    def decode(self, ids) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


def encode_documents(df: DataFrame, codec: Codec, key: str = "doc_id", text: str = "text", decode: bool = False) -> DataFrame:
    """(doc_id, token_ids array<int>) for each row of df, in whole texts; null and empty texts have no ids.

    With decode=True the ids are decoded again in the same task, into a column
    ``decoded``, which spares a second worker and a second trip of all ids.
    One narrow pass without a shuffle; repeated rows give repeated results and
    other columns are ignored.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            offsets, ids = codec.encode_column(batch.column(1).fill_null(""))
            columns = {"doc_id": batch.column(0), "token_ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))}
            if decode:
                columns["decoded"] = codec.decode_column(offsets, ids)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    rows = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(lean(encode), "doc_id long, token_ids array<int>" + ", decoded binary" * decode)


def decode_documents(df: DataFrame, codec: Codec) -> DataFrame:
    """(doc_id, token_ids, decoded binary) from (doc_id, token_ids); null ids decode to no bytes."""
    pieces = codec.pieces  # all that decoding needs

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1)
            decoded = [b"".join(map(pieces.__getitem__, x.values.to_numpy().tolist())) if x.is_valid else b"" for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(decoded, pa.binary())], names=["doc_id", "token_ids", "decoded"])

    return df.select("doc_id", "token_ids").mapInArrow(lean(decode), "doc_id long, token_ids array<int>, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """The contract's columns, from the operator's ids and bytes."""
    listed = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
