"""Byte-level BPE with a rank queue of hierarchical bitmaps.

Each match of the splitting pattern is encoded on its own.  Its bytes form a linked list; the left position of every
neighbouring pair that has a rank lies in the bucket of that rank, and three levels of 64-bit words say which buckets
hold something.  Finding the first set bit gives the next rank; an entry whose pair has changed meanwhile is skipped;
within a rank the leftmost position goes first.

A long pre-token has a queue of its own, so n bytes take O(n log n).  The many short ones of a batch share one queue:
the bucket that comes next hands over the leftmost position of each pre-token in it, and these are merged together.
Pre-tokens do not touch each other, so the order among them is free.

Null and empty texts have no ids.  Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from heapq import heappop, heappush
from itertools import count, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.llm.common import added, by_size, giving_back, grown

LONG = 200  # bytes from which a pre-token is merged by itself
CACHE = 400_000  # pre-tokens whose ids a task remembers


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of byte strings from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class RankQueue:
    """Buckets by rank, found through three levels of bitmaps."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list] = {}
        self.low = [0] * (ranks // 64 + 1)
        self.mid = [0] * (ranks // 4096 + 1)
        self.high = [0] * (ranks // 262144 + 1)

    def bucket(self, rank: int) -> list:
        """The bucket of a rank, to put an entry into."""
        found = self.buckets.get(rank)
        if found is None:
            found = self.buckets[rank] = []
            self.low[rank >> 6] |= 1 << (rank & 63)
            self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
            self.high[rank >> 18] |= 1 << (rank >> 12 & 63)
        return found

    def first(self) -> int:
        """The smallest rank with a bucket, or -1."""
        for top, word in enumerate(self.high):
            if word:
                m = top << 6 | (word & -word).bit_length() - 1
                word = self.mid[m]
                n = m << 6 | (word & -word).bit_length() - 1
                word = self.low[n]
                return n << 6 | (word & -word).bit_length() - 1
        return -1

    def drop(self, rank: int) -> list:
        """Takes out a bucket."""
        n, m, top = rank >> 6, rank >> 12, rank >> 18
        self.low[n] &= ~(1 << (rank & 63))
        if not self.low[n]:
            self.mid[m] &= ~(1 << (n & 63))
            if not self.mid[m]:
                self.high[top] &= ~(1 << (m & 63))
        return self.buckets.pop(rank)


def ragged(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The slices of ``flat`` one after the other."""
    end = np.cumsum(length)
    if not len(end):
        return flat[:0]
    return flat[np.arange(end[-1]) + np.repeat(start - (end - length), length)]


class Merges:
    """A rank table with the rank of every pair of ids whose bytes together have one."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values(), default=0) + 1
        words = {v: k for k, v in ranks.items()}
        ordered = [words.get(i, b"") for i in range(self.size)]
        self.bytes = np.frombuffer(b"".join(ordered), np.uint8)
        self.length = np.array([len(w) for w in ordered], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.byte = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
        left, right, to = [], [], []
        for word, rank in ranks.items():
            for i in range(1, len(word)):
                a, b = ranks.get(word[:i]), ranks.get(word[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    to.append(rank)
        key = np.array(left, np.int64) * self.size + np.array(right, np.int64)
        order = np.argsort(key)
        self.keys, self.to = np.append(key[order], np.iinfo(np.int64).max), np.append(np.array(to, np.int64)[order], -1)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, -1 where there is none."""
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.to[at], -1)


def merge_long(piece: bytes, merges: Merges) -> list[int]:
    """Ids of one pre-token, by a queue of its own; a bucket is a heap of positions."""
    ranks, n = merges.ranks, len(piece)
    queue = RankQueue(merges.size)
    part: list[bytes | None] = [piece[i:i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pair = [-1] * n  # rank of the pair that begins here, as it is now

    def rate(i, k):
        rank = ranks.get(part[i] + part[k], -1)
        if rank >= 0 and pair[i] != rank:
            heappush(queue.bucket(rank), i)
        pair[i] = rank

    for i in range(n - 1):
        rate(i, i + 1)
    while (rank := queue.first()) >= 0:
        bucket = queue.buckets[rank]
        i = heappop(bucket)
        if not bucket:
            queue.drop(rank)
        if pair[i] != rank:
            continue  # stale
        j = after[i]
        part[i] += part[j]
        part[j], pair[j], pair[i] = None, -1, -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rate(i, k)
        if before[i] >= 0:
            rate(before[i], i)
    return [ranks[p] for p in part if p is not None]


def merge_short(some: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many pre-tokens, one after the other, and where each begins; a bucket is a list of arrays of positions."""
    lengths = np.array([len(p) for p in some], np.int64)
    starts = np.cumsum(lengths) - lengths
    ids = merges.byte[np.frombuffer(b"".join(some), np.uint8)]
    n = len(ids)
    owner = np.repeat(np.arange(len(some)), lengths)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[starts + lengths - 1] = -1
    before[starts] = -1
    rank = np.full(n, -1, np.int64)  # of the pair that begins here, as it is now
    inner = np.flatnonzero(after >= 0)
    rank[inner] = merges.pair(ids[inner], ids[inner + 1])
    queue = RankQueue(merges.size)

    def put(places: np.ndarray):
        own = rank[places]
        order = np.argsort(own, kind="stable")
        own, places = own[order], places[order]
        cuts = np.flatnonzero(own[1:] != own[:-1]) + 1
        edges = [0, *cuts.tolist(), len(own)]
        for a, b, r in zip(edges, edges[1:], own[[0, *cuts]].tolist()):
            if r >= 0:
                queue.bucket(r).append(places[a:b])

    if len(inner):
        put(inner)
    while (now := queue.first()) >= 0:
        entries = queue.drop(now)
        i = entries[0] if len(entries) == 1 else np.concatenate(entries)
        i = i[rank[i] == now]  # without stale ones
        if len(entries) > 1:
            i = np.unique(i)
        if not len(i):
            continue
        who = owner[i]
        first = np.empty(len(i), bool)
        first[0] = True
        np.not_equal(who[1:], who[:-1], out=first[1:])
        if not first.all():
            queue.bucket(now).append(i[~first])
            i = i[first]
        j = after[i]
        k = after[j]
        ids[i], ids[j] = now, -1
        after[i], rank[j], rank[i] = k, -1, -1
        has = k >= 0
        front, back = i[has], k[has]
        before[back] = front
        h = before[i]
        on = h >= 0
        left, right = np.concatenate([front, h[on]]), np.concatenate([back, i[on]])
        if len(left):
            new = merges.pair(ids[left], ids[right])
            changed = rank[left] != new
            rank[left] = new
            changed &= new >= 0
            if changed.any():
                put(left[changed])
    kept = ids >= 0
    ends = np.add.reduceat(kept, starts) if len(some) else np.empty(0, np.int64)
    return ids[kept], np.cumsum(ends) - ends


class Encoder:
    """Encodes and decodes whole texts by a rank table."""

    def __init__(self, merges: Merges, pattern: str):
        self.merges = merges
        self.split = regex.compile(pattern).findall
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = defaultdict(count().__next__)  # of pre-tokens, in the order they were met
        self.start, self.length = np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat = np.empty(0, np.int64)

    def _learn(self, new: list[bytes]) -> None:
        """Ids of the pre-tokens that came since the last call."""
        ranks = self.merges.ranks
        out: list = [None] * len(new)
        short = []
        for i, piece in enumerate(new):
            whole = ranks.get(piece)
            if whole is not None:
                out[i] = (whole,)
            elif len(piece) >= LONG:
                out[i] = merge_long(piece, self.merges)
            else:
                short.append(i)
        lengths = np.array([0 if x is None else len(x) for x in out], np.int64)
        ids, begin = merge_short([new[i] for i in short], self.merges)
        lengths[short] = np.diff(np.append(begin, len(ids)))
        start = np.cumsum(lengths) - lengths
        flat = np.empty(int(lengths.sum()), np.int64)
        is_short = np.zeros(len(new), bool)
        is_short[short] = True
        flat[np.repeat(is_short, lengths)] = ids
        rest = [x for x in out if x is not None]
        if rest:
            flat[np.repeat(~is_short, lengths)] = np.concatenate([np.asarray(x, np.int64) for x in rest])
        self.start = np.concatenate([self.start, start + len(self.flat)])
        self.length = np.concatenate([self.length, lengths])
        self.flat = np.concatenate([self.flat, flat])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.numbers) > CACHE:
            self.forget()
        number, split = self.numbers.__getitem__, self.split
        known, found = len(self.numbers), []
        for text in texts:
            parts = split(text or "")
            found.append(np.fromiter(map(number, parts), np.int32, len(parts)))
        if len(self.numbers) > known:
            self._learn([p.encode() for p in islice(self.numbers, known, None)])
        return [ragged(self.flat, self.start[own], self.length[own]).astype("<u4") for own in found]

    def decode(self, ids: np.ndarray) -> bytes:
        merges = self.merges
        return ragged(merges.bytes, merges.begin[ids], merges.length[ids]).tobytes()


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Adds to every row ``n_tokens``, ``ids`` and, read back from the ids, ``decoded``; columns of these names give way.

    ``ids`` holds little-endian unsigned 32-bit integers, as shards of training tokens do; both are binary.  The rank
    table, whose size is that of the vocabulary, is read by the driver and sent to the tasks.
    """
    tables = docs.sparkSession.sparkContext.broadcast(vars(Merges(read_ranks(ranks_path))))
    base, schema = added(docs, ("n_tokens", T.LongType()), ("ids", T.BinaryType()), ("decoded", T.BinaryType()))

    def run(batches):
        merges = Merges({})
        vars(merges).update(tables.value)
        encoder = Encoder(merges, pattern)
        for batch in by_size(batches, limit=12_000_000):  # the more pre-tokens, the fewer rounds of the shared queue
            ids = encoder.encode(batch["text"].to_pylist())
            yield grown(batch, [pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary()),
                                pa.array([encoder.decode(x) for x in ids], pa.binary())], ["n_tokens", "ids", "decoded"])

    return base.mapInArrow(giving_back(run), schema)


def digests(encoded: DataFrame) -> DataFrame:
    """Token count and SHA-256 of ids and decoded bytes, by document."""
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
