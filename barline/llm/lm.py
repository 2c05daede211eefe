"""LM scoring by online logistic context mixing over bits, with a smoothed word distribution beside it.

A text is its words, lower-cased in A-Z, and one end.  Frequent words have a Huffman code of their own; others are an
escape symbol followed by the Huffman codes of their bytes and a blank.  For every bit of these codes several predictors
look up, by a hash of a context (the preceding one, two and four bytes of the word; the whole word so far) and the bit's
place in its code, how often it was 1 in the learned words; one more learns by the last of these contexts from the text
itself as it goes.  Their logits are added with weights that a gate selects by the kind of symbol and by how well the
bytes so far are known; the sum is refined by an adaptive scale; all are updated after every ``GROUP`` bits with what
these were.  The bits' costs add up to the log-probability of the text by mixing alone.

Contexts of bits end at word borders, so the tables are sums over distinct words times their counts: a word count by
Spark, then sums of arrays of fixed size.  Across word borders every pair of neighbouring words is counted, in a stored
table that grows with the learned texts (``pair_counts``): keys of 64 bits, dealt by themselves into buckets.  Texts are
scored in batches; the distinct pairs of a batch go to the buckets, and their counts come back in the same order.  A word then has the
share that it has after the word before, but for the mass of new pairs, which is given out by mixing; that mass is the
share of pairs seen once, by how often the word before was seen.  Words past those with codes have their own counts in
that table, so how often they were seen tells even where their bytes meet in the tables of fixed size.  Where rows are learned and scored
at once, each pair of a batch goes to its bucket once, to be counted and asked for.  The score is that of an even mixture of both models, the
one with pairs and the one without, so a text is never charged more than a bit for the worse one.  Mixing is sequential in a text but runs over many texts at once; it starts
afresh every ``SPAN`` bits, so long texts are cut into lanes too and are scored whole.  Weights start from the mean of those
that mixing ends with in the lanes of all learned texts.

The word distribution needs the count of every word.  Those of the ``HEAD`` most frequent words go to the tasks with their
codes; other words meet their counts in a join.  Null texts are empty: they have the end only.  Repeated rows are scored each.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import defaultdict
from itertools import accumulate, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.common import by_size, giving_back, pieces, store

HEAD = 1 << 18  # most frequent words, which have codes of their own and whose counts tasks hold
SPAN = 8192  # bits after which mixing starts afresh
GROUP = 16  # bits between updates
RATE = 0.02  # of the weights
MAP_RATE = 0.02  # of the refining scale
OWN = 1 << 12  # slots of the table that a lane learns itself
OWN_RATE = 0.6
LANES = 512  # mixed at a time
DELTA = 0.1  # added to the counts of both bits
SLOTS = (1 << 16, 1 << 19, 1 << 21, 1 << 22)  # of the tables: one, two and four bytes, whole word so far
PARTS = 16  # tasks that sum up tables
_K = len(SLOTS)
_BASE = np.cumsum([0, *SLOTS])
_CHUNK = 1 << 17  # slots of a piece of a table that is summed by itself
SEEN = (5,)  # how often the whole word so far has to be seen for the next gate
_GATES = 2 + len(SEEN)  # the first is for the symbols of words
PAIRS = 1 << 21  # words of the learned texts for each bucket of pairs
BATCH = 2_000_000  # bytes of text scored together
_BINS = 64  # of words before, by how often they were seen: 0 without a code; the last one is for words by themselves
_WORDS = 20_000  # words whose bytes are counted at a time
_PART = 2000  # words whose bits are laid out at a time
_LAID = 1_000_000  # bits that are added to tables at a time
_ROOM = 1 << 20  # bits of other words that have room beside those of words with codes
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SIGN = np.int32(-1 << 31)  # of a 32-bit float
_GATE = OWN.bit_length() - 1  # place of the gate in a bit's mark
_FLUSH = 400_000  # distinct words that a task counts before it hands them over


# --- words ----------------------------------------------------------------------------------------

def words_of(text: str | None) -> list[bytes]:
    """The words of a text and its end."""
    words = (text or "").encode().lower().split()
    words.append(b"\n")
    return words


def raw(words) -> list[bytes]:
    """The bytes of each word; an array of objects is made at once, a list of Arrow values one by one."""
    return words.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def split(texts) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts in a row, without ends; words per text), as ``words_of`` has them."""
    given = texts if isinstance(texts, pa.Array) else texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else pa.array(texts, pa.string())
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(given, "")))  # which gives empty words beside outer blanks
    found = lists.flatten()
    real = pc.greater(pc.binary_length(found), 0)
    upto = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    at = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
    return found.filter(real), np.diff(upto[at])


def _count(batches):
    def summed(parts):
        return pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

    held, rows = [], 0
    for batch in by_size(batches):
        if not batch.num_rows:
            continue
        found, n = split(batch["text"])
        counted = found.value_counts()
        held.append(pa.table({"word": pa.concat_arrays([counted.field("values"), pa.array(["\n"])]),
                              "n": pa.concat_arrays([counted.field("counts"), pa.array([len(n)])])}))
        rows += held[-1].num_rows
        if rows > 2 * _FLUSH:
            held = [summed(held)]
            rows = held[0].num_rows
            if rows > _FLUSH:
                yield from held[0].to_batches()
                held, rows = [], 0
    if held:
        yield from summed(held).to_batches()


def vocabulary(docs: DataFrame) -> DataFrame:
    """Stores (word, n) over all given texts."""
    counted = docs.select("text").mapInArrow(giving_back(_count), "word string, n long")
    return store(counted.groupBy("word").agg(F.sum("n").alias("n")), "vocabulary", release=True)


def most_frequent(words: DataFrame, limit: int, least: int = 1) -> dict[bytes, int]:
    """Counts of the words seen at least ``least`` times, and so often that at most ``limit`` of them are."""
    sizes = words.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n"))  # a row for each count that occurs
    total, floor = 0, None
    for n, more in zip(*(c.to_pylist() for c in sizes.toArrow().columns)):
        total += more
        if total > limit or n < least:
            break
        floor = n
    if floor is None:
        return {}
    found = words.where(F.col("n") >= floor).toArrow()
    return {w.encode(): n for w, n in zip(found["word"].to_pylist(), found["n"].to_pylist())}


# --- bits -----------------------------------------------------------------------------------------

def huffman(weights: list[int]) -> list[tuple[int, int]]:
    """Code (bits, length) of each symbol, the root's bit lowest; equal weights are merged in order."""
    n = len(weights)
    heap = [(w + 1, i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    above: list = [None] * (2 * n - 1)
    for node in range(n, 2 * n - 1):
        for bit in (0, 1):
            weight, child = heapq.heappop(heap)
            above[child] = (node, bit)
            if bit:
                heapq.heappush(heap, (weight + other, node))
            other = weight
    code: list = [(0, 0)] * (2 * n - 1)
    for i in range(2 * n - 3, -1, -1):
        node, bit = above[i]
        bits, length = code[node]
        code[i] = (bits | bit << length, length + 1)
    return code[:n]


def alphabetic(weights: list[int]) -> list[tuple[int, int]]:
    """Code (bits, length) of each symbol, the root's bit lowest, in the order of the symbols: every range of them is
    split where its halves weigh nearly the same, so neighbours share their first bits."""
    ends = list(accumulate(w + 1 for w in weights))
    code: list = [(0, 0)] * len(weights)
    todo = [(0, len(weights), 0, 0)]
    while todo:
        low, high, bits, length = todo.pop()
        if high - low == 1:
            code[low] = (bits, length)
            continue
        both = (ends[low - 1] if low else 0) + ends[high - 1]
        cut = bisect_left(ends, both / 2, low, high - 1)
        cut = min(max(cut + (2 * ends[cut] <= both), low + 1), high - 1)
        todo += [(low, cut, bits, length + 1), (cut, high, bits | 1 << length, length + 1)]
    return code


def symbols(words: list[bytes], codes: dict) -> np.ndarray:
    """The number of each word's own code, -1 if it has none.  What takes them as ``symbol`` looks none up itself."""
    return np.fromiter(map(codes["words"].get, words, repeat(-1)), np.int64, len(words))


def _spelled(words: list[bytes], codes: dict, number: np.ndarray):
    """Symbols of the words one after the other: (contexts of every table, bits of the code, whether it is a byte), the
    first symbol of each word, and for each bit its symbol, its value and the hash of its place in the code.

    A frequent word is one symbol of its own code.  Other words are the symbol that stands for all of them, then their
    bytes and a blank.
    """
    spelled = [b"" if i >= 0 else w + b" " for w, i in zip(words, number.tolist())]
    sizes = np.array([len(w) for w in spelled], np.int64) + 1  # symbols
    start = np.cumsum(sizes) - sizes
    n = int(sizes.sum())
    is_byte = np.ones(n, bool)
    is_byte[start] = False
    byte = np.zeros(n, np.uint8)
    byte[is_byte] = np.frombuffer(b"".join(spelled), np.uint8)
    own = np.arange(n) - np.repeat(start, sizes)  # place in the word; 0 is the word's symbol
    before = np.zeros((5, n), np.uint64)  # the byte k places before, from 1; 0 outside the word
    for k in range(1, 5):
        before[k, k:] = np.where(own[k:] > k, byte[:-k].astype(np.uint64) + np.uint64(1), 0)
    one = before[1]
    two = one | before[2] << np.uint64(9)
    four = two | before[3] << np.uint64(18) | before[4] << np.uint64(27)
    prefix = np.zeros(n, np.uint64)
    state = np.ones(len(words), np.uint64)
    order = np.argsort(-sizes, kind="stable")
    longest, descending = int(sizes.max()), -sizes[order]
    for place in range(1, longest):  # all words that reach this place
        at = order[:np.searchsorted(descending, -place, "left")]
        here = start[at] + place
        prefix[here] = state[at]
        state[at] = (state[at] + byte[here] + np.uint64(1)) * _MIX
        state[at] ^= state[at] >> np.uint64(29)
    value, length = codes["byte_bits"][byte], codes["byte_lengths"][byte]
    value[start], length[start] = codes["word_bits"][number], codes["word_lengths"][number]  # -1 is the last one
    first = np.cumsum(length) - length
    of = np.repeat(np.arange(n), length)
    shift = (np.arange(len(of)) - first.take(of)).astype(np.uint64)
    value = value.take(of)
    bit = (value >> shift & np.uint64(1)).astype(np.int8)
    node = np.uint64(1) << shift
    node |= value & (node - np.uint64(1))  # the bits so far, after a 1
    node *= np.uint64(0xD6E8FEB86659FD93)
    return (one, two, four, prefix), length, is_byte, start, of, bit, node


def _slots(k: int, context: np.ndarray, of: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Slots in table ``k`` of the bits of symbols with these contexts."""
    x = ((context + np.uint64(1)) * np.uint64(0xFF51AFD7ED558CCD)).take(of)
    x ^= node
    x ^= x >> np.uint64(32)
    x *= _MIX
    x >>= np.uint64(64 - int(SLOTS[k]).bit_length() + 1)
    return x.astype(np.int32) + np.int32(_BASE[k])


def expand(words: list[bytes], codes: dict):
    """Bits of the words one after the other: (slot of every table, bit, whether it tells the word), and for each word
    its first bit and length."""
    contexts, length, is_byte, start, of, bit, node = _spelled(words, codes, symbols(words, codes))
    slots = np.empty((_K, len(bit)), np.int32)
    for k, context in enumerate(contexts):
        slots[k] = _slots(k, context, of, node)
    word_bits = np.add.reduceat(length, start)
    return slots, bit, ~is_byte.take(of), np.cumsum(word_bits) - word_bits, word_bits


def codes_of(words: DataFrame, frequent: int) -> dict:
    """Codes of the ``frequent`` most frequent words, and of the bytes of the others.  Bounded by that number."""
    top = most_frequent(words, frequent, 3)  # rarer ones tell what new words are like
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    counts = dict.fromkeys(range(256), 0)

    def count_bytes(batches):
        total = np.zeros(256, np.int64)
        for batch in pieces(batches, _WORDS):
            spelled = [w + b" " for w in raw(batch["word"])]
            weight = np.repeat(batch["n"].to_numpy(), [len(w) for w in spelled])
            total += np.bincount(np.frombuffer(b"".join(spelled), np.uint8), weight, 256).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total)], names=["byte", "n"])

    counts |= dict(map(tuple, words.mapInArrow(giving_back(count_bytes), "byte long, n long").groupBy("byte").agg(F.sum("n")).collect()))
    return make_codes(top, total, [counts[i] for i in range(256)])


def make_codes(top: dict[bytes, int], total: int, byte_counts: list[int]) -> dict:
    top = dict(sorted(top.items()))
    by_word = alphabetic([*top.values(), total - sum(top.values())])  # the last one stands for other words
    by_byte = huffman(byte_counts)

    def split(code):
        return np.array([c[0] for c in code], np.uint64), np.array([c[1] for c in code], np.int64)

    words, bytes_ = split(by_word), split(by_byte)
    return {"words": {w: i for i, w in enumerate(top)}, "counts": np.array(list(top.values()), np.int64), "word_bits": words[0], "word_lengths": words[1],
            "byte_bits": bytes_[0], "byte_lengths": bytes_[1]}


def tables(vocabulary: DataFrame, codes: dict) -> tuple[np.ndarray, np.ndarray]:
    """For every slot the logit of a 1, and for slots of the last table the gate, from the bits of all words.

    A task sums its words to arrays of fixed size, and there are at most ``PARTS`` of them whatever the number of words.
    """
    last = int(_BASE[_K - 1])

    def add(batches):
        total = np.zeros((2, int(_BASE[-1])), np.float32)
        held, bits = [], 0

        def put():
            nonlocal bits
            weight = np.concatenate([w for _, w in held])
            for k in range(_K):
                low, size = int(_BASE[k]), SLOTS[k]
                both = np.bincount(np.concatenate([slots[k] for slots, _ in held]) - 2 * low, weight, 2 * size).reshape(-1, 2)
                total[1, low:low + size] += both[:, 1]
                both[:, 0] += both[:, 1]
                total[0, low:low + size] += both[:, 0]
            held.clear()
            bits = 0

        for batch in pieces(batches, _PART):
            if not batch.num_rows:
                continue
            slots, bit, _, _, length = expand(raw(batch["word"]), codes)
            held.append((2 * slots + bit, np.repeat(batch["n"].to_numpy(), length).astype(np.float64)))
            bits += len(bit)
            if bits > _LAID:
                put()
        if held:
            put()
        for at in range(0, total.shape[1], _CHUNK):
            yield pa.RecordBatch.from_arrays(
                [pa.array([at // _CHUNK], pa.int64()), pa.array([total[:, at:at + _CHUNK].tobytes()], pa.binary())], names=["chunk", "sums"])

    def together(chunk: pa.Table) -> pa.Table:
        n, ones = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in chunk["sums"]).reshape(2, -1)
        logit = np.log((ones + DELTA) / (n - ones + DELTA)).astype(np.float16)
        gate = (1 + np.searchsorted(SEEN, n, "right")).astype(np.uint8)
        return pa.table({"chunk": chunk["chunk"].slice(0, 1), "logits": pa.array([logit.tobytes()], pa.binary()), "gates": pa.array([gate.tobytes()], pa.binary())})

    summed = store(vocabulary.coalesce(PARTS).mapInArrow(giving_back(add), "chunk long, sums binary").groupBy("chunk").applyInArrow(
        together, "chunk long, logits binary, gates binary"), "tables", release=True)
    rows = sorted(summed.collect())  # of fixed size
    if not rows:
        return np.zeros(int(_BASE[-1]), np.float16), np.ones(SLOTS[-1], np.uint8)
    return (np.concatenate([np.frombuffer(r["logits"], np.float16) for r in rows]),
            np.concatenate([np.frombuffer(r["gates"], np.uint8) for r in rows])[last:])


# --- pairs of words -------------------------------------------------------------------------------

def numbered(texts: list) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct words, word numbers of all texts in a row, words per text)."""
    found, n = split(texts)
    coded = found.dictionary_encode()
    distinct = [*raw(coded.dictionary), b"\n"]
    n_words = n + 1
    flat = np.full(int(n_words.sum()), len(distinct) - 1, np.int32)
    inner = np.ones(len(flat), bool)
    inner[np.cumsum(n_words) - 1] = False  # ends
    flat[inner] = coded.indices.to_numpy()
    return distinct, flat, n_words


def _key(before, word: np.ndarray) -> np.ndarray:
    x = (before * np.uint64(0x9E3779B97F4A7C15) + word) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    return x ^ x >> np.uint64(29)


def pair_keys(distinct: list[bytes], flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word before every word, the key of both, and the key of each distinct word by itself.

    Every text ends with its end, which is therefore the word before the first.
    """
    own = pd.util.hash_array(np.array(distinct, object), categorize=False)
    before = np.roll(flat, 1)
    return before, _key(own[before], own[flat]), _key(np.uint64(0), own)


def _dealt(keys: np.ndarray, buckets: int):
    """(bucket, places of its keys) for every bucket that has any."""
    bucket = (keys >> np.uint64(20)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    at = np.flatnonzero(np.diff(bucket[order], prepend=np.uint64(buckets)))
    return zip(bucket[order[at]].astype(np.int64).tolist(), np.split(order, at[1:])) if len(keys) else ()


_PAIRS = "bucket long, batch long, first long, texts long, keys binary, counts binary, bins binary"


def pair_rows(batched: DataFrame, model: dict) -> DataFrame:
    """(bucket, batch, first, texts, keys, counts, bins): of these texts of a batch, the distinct keys of a bucket, which are
    their pairs of neighbouring words and their words without a code; how often the learned ones among them hold each; and
    the bins of the words before.  Counts and bins are null where no text is learned, as without a column ``learned``."""
    given, buckets, told = model["shared"], model["buckets"], "learned" in batched.columns

    def ask(batches):
        codes = given.value["codes"]
        level = np.append(1 + np.floor(np.log2(codes["counts"])), 0).astype(np.int8)
        for batch, first, texts, learned in gathered(batches):
            distinct, flat, n_words = numbered(texts)
            symbol = symbols(distinct, codes)
            before, pair, alone = pair_keys(distinct, flat)
            rest = np.flatnonzero(symbol < 0)
            keys = np.concatenate([pair, alone[rest]])
            order = np.argsort(keys)
            at = np.flatnonzero(np.diff(keys[order], prepend=~keys[order[:1]]))
            keys = keys[order[at]]
            n = bins = None
            if any(learned):
                weight = np.repeat(np.array(learned, np.int64), n_words)
                n = np.concatenate([weight, np.bincount(flat, weight, len(distinct))[rest].astype(np.int64)])
                n = np.add.reduceat(n[order], at)
                n = n.astype(np.min_scalar_type(n.max()))
                bins = np.concatenate([level[symbol[before]], np.full(len(rest), _BINS - 1, np.int8)])[order[at]]
            for bucket, at in _dealt(keys, buckets):
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([x], pa.int64()) for x in (bucket, batch, first, len(texts))), *(pa.array([None if x is None else x[at].tobytes()], pa.binary()) for x in (keys, n, bins))],
                    names=["bucket", "batch", "first", "texts", "keys", "counts", "bins"])

    return batched.select("batch", "row", "text", *(["learned"] if told else [])).mapInArrow(giving_back(ask), _PAIRS)


def _narrow(held: bytes, size: int) -> np.ndarray:
    return np.frombuffer(held, f"u{len(held) // size}")


def counted(rows: DataFrame) -> DataFrame:
    """(batch, first, texts, bucket, counts, seen, once): how often what these texts of a batch ask of a bucket was learned
    in all rows, 0 if never; and in a row of each bucket without a batch, for each bin the number of words in it and of
    those whose key was seen once.

    The counts are in the order of the keys, which the batch can make again, and as narrow as the largest of them.
    """
    def look(asked: pa.Table) -> pa.Table:
        every = [np.frombuffer(x.as_py(), np.uint64) for x in asked["keys"]]
        learned = [(keys, _narrow(n.as_py(), len(keys)), np.frombuffer(bins.as_py(), np.int8)) for keys, n, bins in zip(every, asked["counts"], asked["bins"]) if n.is_valid]
        known, n, seen, once = np.empty(0, np.uint64), np.zeros(0, np.int64), np.zeros(_BINS, np.int64), np.zeros(_BINS, np.int64)
        if learned:
            known, n, bins = (np.concatenate(x) for x in zip(*learned))
            del learned
            order = np.argsort(known)
            known = known[order]
            first = np.flatnonzero(np.diff(known, prepend=~known[:1]))
            bins, n, known = bins[order[first]], np.add.reduceat(n[order], first, dtype=np.int64), known[first]
            del order
            seen, once = np.bincount(bins, n, _BINS).astype(np.int64), np.bincount(bins[n == 1], minlength=_BINS)
        known, n = np.append(known, np.uint64(2**64 - 1)), np.append(n, 0)
        out = [[None] * 3 + [asked["bucket"][0].as_py(), None, seen.tolist(), once.tolist()]]
        for b, f, t, bucket, keys in zip(*(asked[c].to_pylist() for c in ("batch", "first", "texts", "bucket")), every):
            if b is not None:
                at = np.searchsorted(known, keys)
                found = np.where(known[at] == keys, n[at], 0)
                out.append([b, f, t, bucket, found.astype(np.min_scalar_type(found.max())).tobytes(), None, None])
        kinds = [pa.int64()] * 4 + [pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.Table.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=["batch", "first", "texts", "bucket", "counts", "seen", "once"])

    return rows.groupBy("bucket").applyInArrow(look, "batch long, first long, texts long, bucket long, counts binary, seen array<long>, once array<long>")


def novelty(found: DataFrame) -> np.ndarray:
    """For each bin the number of words in it and of those whose key was seen once."""
    return np.array(found.where("batch IS NULL").agg(*(F.coalesce(F.sum(F.col(c)[i]), F.lit(0)) for c in ("seen", "once") for i in range(_BINS))).first(), np.int64).reshape(2, _BINS)


def wanted(distinct: list[bytes], flat: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """The keys that a batch of texts asks for, ascending: its pairs, and its words without a code."""
    _, pair, alone = pair_keys(distinct, flat)
    keys = np.sort(np.concatenate([pair, alone[symbol < 0]]))
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])]


def gathered(batches):
    """(batch, place of the first, texts, whether each is learned) of texts of one batch that follow each other."""
    batch, first, texts, learned = -1, 0, [], []
    for rows in pieces(batches):
        flags = rows["learned"].to_pylist() if "learned" in rows.schema.names else [False] * rows.num_rows
        for b, row, text, flag in zip(*(rows[c].to_pylist() for c in ("batch", "row", "text")), flags):
            if b != batch or row != first + len(texts):
                if texts:
                    yield batch, first, texts, learned
                batch, first, texts, learned = b, row, [], []
            texts.append(text)
            learned.append(flag)
    if texts:
        yield batch, first, texts, learned


def answers(batched: DataFrame, model: dict) -> DataFrame:
    """(batch, first, texts, bucket, counts) of texts in batches, from what was learned before; see ``counted``."""
    return counted(pair_rows(batched, model).unionByName(model["pairs"])).where("batch IS NOT NULL").drop("seen", "once")


def answered(texts: list, distinct: list[bytes], flat: np.ndarray, found: pa.Table, words: dict, buckets: int,
             symbol: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The keys that a batch asked for, ascending, and their counts, from all its answers."""
    parts: dict = defaultdict(dict)
    for first, size, bucket, counts in zip(*(found[c].to_pylist() for c in ("first", "texts", "bucket", "counts"))):
        parts[first, size][bucket] = counts
    held = []
    for (first, size), given in parts.items():
        whole = size >= len(texts)
        own = (distinct, flat) if whole else numbered(texts[first:first + size])[:2]
        keys = wanted(*own, symbol if whole and symbol is not None else symbols(own[0], {"words": words}))
        n = np.zeros(len(keys), np.int64)
        for bucket, at in _dealt(keys, buckets):
            n[at] = _narrow(given[bucket], len(at))
        held.append((keys, n))
    keys, n = held[0] if len(held) == 1 else (np.concatenate(x) for x in zip(*held))
    order = np.argsort(keys, kind="stable")
    return keys[order], n[order]


def with_pairs(distinct, flat, symbol_cost, spelled_cost, held: tuple[np.ndarray, np.ndarray], model: dict, symbol: np.ndarray | None = None) -> np.ndarray:
    """Natural log-probability of every word after the word before it, where mixing gives out the mass of new pairs.

    Words without a code have their shares of all such words, as counted, but for the mass of new ones, which is given
    out by the bytes that spell them.  ``held`` has keys, sorted, and their counts.
    """
    codes = model["codes"]
    symbol = symbols(distinct, codes) if symbol is None else symbol
    known, n = held
    known, n = np.append(known, np.uint64(2**64 - 1)), np.append(n, 0)

    def lookup(keys):
        order = np.argsort(keys)  # ascending ones are found faster, near each other
        keys = keys[order]
        at = np.searchsorted(known, keys)
        counts = np.empty(len(keys), n.dtype)
        counts[order] = np.where(known[at] == keys, n[at], 0)
        return counts

    before, pair, alone = pair_keys(distinct, flat)
    coded = symbol >= 0
    rest = np.zeros(len(distinct), n.dtype)
    rest[~coded] = lookup(alone[~coded])  # no keys of words with a code are asked for
    seen = np.where(coded, np.append(codes["counts"], 0)[symbol], rest)[before]
    level = np.append(1 + np.floor(np.log2(codes["counts"])), 0).astype(np.int64)[symbol][before]
    total, once = model["novel"]
    new = (once + 1) / (total + 2)
    spells, share = new[-1], (1 - new[-1]) * rest / max(int(total[-1]), 1)
    new = np.where(seen > 0, new[level], 1.0)
    with np.errstate(divide="ignore"):
        at = np.flatnonzero(~coded[flat])
        spelled = np.zeros(len(flat))
        spelled[at] = np.logaddexp(np.log(share)[flat[at]], (np.log(spells) if total[-1] else 0.0) - spelled_cost[at])
        return np.logaddexp(np.log((1 - new) * lookup(pair) / np.maximum(seen, 1)), np.log(new) - symbol_cost + spelled)


# --- mixing ---------------------------------------------------------------------------------------

def start_weights() -> np.ndarray:
    weights = np.repeat(np.float32([[0.1, 0.2, 0.4, 0.6, 0.2]]), _GATES, axis=0)
    weights[0] = [0, 0, 0, 0.9, 0.5]
    return weights


def _laid(words: list[bytes], number: np.ndarray, model: dict):
    """For each bit of the words one after the other: in 64 bits the logit of the last table and the mark, which has the
    bit's slot in the lane's own table, the gate, and as its sign whether it is 0; the logits of all tables, if any word has
    bytes, which are read for bits of bytes only; and each word's length.

    Logits are signed by the bit.  Symbols of words have no bytes before, and so only the logit of the last table; the
    word before has its say in ``with_pairs``.
    """
    logits = model["logits"]
    packed, others, lengths = ([np.empty(0, kind)] for kind in (np.int64, np.float32, np.int64))
    others[0].shape = 0, _K
    for at in range(0, len(words), _PART):
        contexts, length, is_byte, start, of, bit, node = _spelled(words[at:at + _PART], model["codes"], number[at:at + _PART])
        last = _slots(_K - 1, contexts[-1], of, node)
        sign = bit.astype(np.float32) * 2 - 1
        both = np.empty((len(bit), 2), np.int32)
        mark = (last & (OWN - 1)) | (bit.astype(np.int32) - 1 & _SIGN)
        np.multiply(logits.take(last), sign, out=both[:, 1].view(np.float32))
        if is_byte.any():
            inner = is_byte.take(of).astype(np.int32) << _GATE
            mark |= inner * model["gates"].take(last - np.int32(_BASE[_K - 1])) if "gates" in model else inner
            some = np.empty((len(bit), _K), np.float32)
            for k in range(_K - 1):
                np.multiply(logits.take(_slots(k, contexts[k], of, node)), sign, out=some[:, k])
            some[:, -1] = both[:, 1].view(np.float32)
            others.append(some)
        both[:, 0] = mark
        packed.append(both.view(np.int64).ravel())
        lengths.append(np.add.reduceat(length, start))
    return tuple(np.concatenate(x) for x in (packed, others, lengths))


def laid(words: list[bytes], number: np.ndarray, model: dict):
    """(bits in 64 bits each, how many of them are of words with codes, for the others their logits in all tables), and
    each word's first bit and length.

    The first ``GROUP`` bits are those that are read behind a text's end.  Words with codes are laid out once by a process
    and stay with the codes that it holds; the others follow them in the same array.
    """
    codes = model["codes"]
    if "laid" not in codes or codes["laid"][0] is not model["logits"]:  # they belong to these logits
        every, lengths = list(codes["words"]), np.append(codes["word_lengths"][:-1], 0)  # the last one is for the others
        first = np.cumsum(lengths) - lengths + GROUP
        held = np.zeros(int(first[-1]) + _ROOM, np.int64)
        for at in range(0, len(every), _PART):
            packed = _laid(every[at:at + _PART], np.arange(at, min(at + _PART, len(every))), model)[0]
            held[first[at]:first[at] + len(packed)] = packed
        codes["laid"] = model["logits"], held, first, lengths
    _, held, first, lengths = codes["laid"]
    coded = int(first[-1])
    start, length = first[number], lengths[number]
    rest = np.flatnonzero(number < 0)
    packed, others, length[rest] = _laid([words[i] for i in rest.tolist()], number[rest], model)
    start[rest] = np.cumsum(length[rest]) - length[rest] + coded
    if len(held) < coded + len(packed):
        held = np.concatenate([held[:coded], np.empty(len(packed) + _ROOM, np.int64)])
        codes["laid"] = model["logits"], held, first, lengths
    held[coded:coded + len(packed)] = packed
    return (held, coded, others), start, length


def mix(given: tuple, bits: np.ndarray, begin: np.ndarray, lengths: np.ndarray, weights: np.ndarray, costs: np.ndarray | None):
    """The sum over lanes of the weights that they end with; ``costs``, if wanted, gets the bits' costs.

    ``given`` has the distinct bits (``laid``).  ``bits`` names those of all texts, and has ``GROUP`` in a row; a lane begins
    with the row ``begin``, and ``lengths``, in bits, descend.  What a lane reads beyond its length does not count.
    """
    packed, coded, others = given
    others = others.view(np.complex128).ravel()  # a row of 16 bytes as one value, which NumPy copies at once
    lanes, one = len(begin), np.float32(1)
    weights = weights.astype(np.float32)
    by_table, by_own = np.full((lanes, 1), weights[0, -2]), np.full((lanes, 1), weights[0, -1])  # of the first gate
    rest = np.repeat(weights[1:], lanes, axis=0)  # of the other gates
    own = np.zeros(lanes * OWN, np.float32)
    row = np.arange(lanes)[:, None] * OWN
    scale = np.ones((lanes, 1), np.float32)
    steps = -(-lengths // GROUP)
    for step in range(int(steps[0])):
        live, after = np.searchsorted(-steps, (-step, -step - 1), "left").tolist()
        rows = begin[:live] + step
        at = bits.take(rows, axis=0)
        both = packed.take(at).view(np.int32).reshape(live, GROUP, 2)
        mark, logit = both[..., 0].copy(), both[..., 1].view(np.float32).copy()
        sign = mark & _SIGN
        slot = row[:live] + (mark & (OWN - 1))
        learned = (own.take(slot).view(np.int32) ^ sign).view(np.float32)
        x = logit * by_table[:live]
        x += learned * by_own[:live]
        gate = (mark.ravel() >> _GATE) & 7
        byte = np.flatnonzero(gate != 0)
        if len(byte):
            key = (gate.take(byte) - 1) * np.int64(lanes) + byte // GROUP
            some = np.empty((len(byte), _K + 1), np.float32)
            some[:, :_K] = others.take(at.ravel().take(byte) - coded).view(np.float32).reshape(-1, _K)
            some[:, -1] = learned.ravel().take(byte)
            x.ravel()[byte] = np.einsum("ik,ik->i", some, rest.take(key, axis=0))
        np.minimum(x, 12, out=x)
        np.maximum(x, -12, out=x)
        miss = np.exp(x)
        miss += one
        np.divide(np.float32(RATE), miss, out=miss)  # of what was not given to the bit that came
        if after < live:
            real = np.arange(GROUP) < (lengths[after:live] - step * GROUP)[:, None]  # of lanes that end here
            miss[after:] *= real
        if costs is not None:
            cost = np.exp(-x * scale[:live])
            spent = np.log1p(cost)
            if after < live:
                spent[after:] *= real
            costs[rows] = spent
            cost /= cost + one
            scale[:live, 0] += np.float32(MAP_RATE / GROUP) * np.einsum("lb,lb->l", cost, x)
        if len(byte):
            missed = miss.ravel().take(byte)
            some *= missed[:, None]
            rest += np.bincount((key[:, None] * (_K + 1) + np.arange(_K + 1)).ravel(), some.ravel(), rest.size).reshape(rest.shape)
            miss.ravel()[byte] = 0
        by_table[:live, 0] += np.einsum("lb,lb->l", miss, logit)
        by_own[:live, 0] += np.einsum("lb,lb->l", miss, learned)
        more = np.exp(learned)
        more += one
        np.divide(np.float32(OWN_RATE), more, out=more)
        more += learned
        own[slot] = (more.view(np.int32) ^ sign).view(np.float32)
    ends = np.empty((_GATES, _K + 1))
    ends[0] = weights[0].astype(np.float64) * lanes  # the first gate's bits have no other inputs
    ends[0, -2:] = by_table.sum(dtype=np.float64), by_own.sum(dtype=np.float64)
    ends[1:] = rest.reshape(_GATES - 1, lanes, _K + 1).sum(1, dtype=np.float64)
    return ends


def score_texts(texts, model: dict, numbers: tuple | None = None, cost: bool = True, symbol: np.ndarray | None = None):
    """(distinct words, word numbers of all texts in a row, words per text, log10-probabilities by mixing, sums over
    lanes of the weights at the end and behind them the number of lanes, costs of the words' symbols, costs of the bytes
    that spell them).  Without ``cost`` only the weights are found, and what costs is None."""
    distinct, flat, n_words = numbers or numbered(texts)
    symbol = symbols(distinct, model["codes"]) if symbol is None else symbol
    given, start, length = laid(distinct, symbol, model)
    last = np.cumsum(n_words)
    reach = length[flat]
    text_bits = np.add.reduceat(reach, last - n_words)
    rows = -(-text_bits // GROUP)
    behind = np.insert(reach, last, rows * GROUP - text_bits)  # every text fills up its last row
    where = np.insert(start[flat], last, 0)
    first = np.cumsum(behind) - behind
    bits = np.arange(int(rows.sum()) * GROUP, dtype=np.int32)
    bits += np.repeat((where - first).astype(np.int32), behind)
    bits = bits.reshape(-1, GROUP)
    first_row = np.cumsum(rows) - rows
    lanes_of = -(-text_bits // SPAN)
    owner = np.repeat(np.arange(len(n_words)), lanes_of)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(lanes_of) - lanes_of, lanes_of)
    begin = first_row[owner] + nth * (SPAN // GROUP)
    size = np.minimum(SPAN, text_bits[owner] - nth * SPAN)
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    ends, costs = np.zeros((_GATES, _K + 1)), np.zeros((len(bits) + 1, GROUP), np.float32) if cost else None
    for some in range(0, len(order), LANES):
        ends += mix(given, bits, begin[some:some + LANES], size[some:some + LANES], model["weights"], costs)
    ends = np.append(ends, len(order))
    if not cost:
        return distinct, flat, n_words, None, ends, None, None
    begins = np.delete(first, last + np.arange(len(last)))
    told = begins + model["codes"]["word_lengths"][symbol][flat]  # where the symbol ends
    parts = np.add.reduceat(costs.ravel(), np.stack([begins, told], axis=1).ravel()).reshape(-1, 2).astype(np.float64)
    parts[told == begins, 0] = 0  # ``reduceat`` has no empty sums
    parts[told == begins + reach, 1] = 0
    total = -np.add.reduceat(parts.sum(1), last - n_words)
    return distinct, flat, n_words, total / np.log(10), ends, parts[:, 0], parts[:, 1]


# --- the operator ---------------------------------------------------------------------------------

def warmed(docs: DataFrame, model: dict) -> np.ndarray:
    """The mean, over the lanes of all given texts, of the weights that mixing ends with."""
    given, weights = model["shared"], model["weights"]

    def warm(batches):
        ends = np.zeros(_GATES * (_K + 1) + 1)
        for batch in by_size(batches, limit=BATCH):
            if batch.num_rows:
                ends += score_texts(batch["text"], given.value | {"weights": weights}, cost=False)[4]
        yield pa.RecordBatch.from_arrays([pa.array([ends.tolist()])], names=["ends"])

    summed = docs.select("text").mapInArrow(giving_back(warm), "ends array<double>").agg(*(F.sum(F.col("ends")[i]) for i in range(_GATES * (_K + 1) + 1))).first()
    *ends, lanes = summed
    return (np.array(ends) / lanes).reshape(_GATES, _K + 1).astype(np.float32) if lanes else model["weights"]


def batches_of(docs: DataFrame, *more: str) -> DataFrame:
    """Stores (batch, row, doc_id, text) and ``more``: the rows in batches of about ``BATCH`` bytes of text."""
    def deal(batches):
        first = TaskContext.get().partitionId() << 32
        for i, batch in enumerate(by_size(batches, limit=BATCH)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(batch.num_rows, first + i)), pa.array(np.arange(batch.num_rows)), *(batch[c] for c in columns)], names=["batch", "row", *columns])

    columns = ["doc_id", "text", *more]
    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in columns]
    return store(docs.select(*columns).mapInArrow(giving_back(deal), f"batch long, row long, {', '.join(kinds)}"), "batched")


def _learned(learned: DataFrame) -> dict:
    words = vocabulary(learned)
    total = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens = int(total["n"] or 0)
    codes = codes_of(words, HEAD)
    logits, gates = tables(words, codes)
    model = {"codes": codes, "logits": logits, "gates": gates}
    model["shared"] = learned.sparkSession.sparkContext.broadcast(model)
    model |= {"weights": start_weights(), "words": words, "tokens": tokens, "distinct": int(total["v"]), "buckets": 1 + tokens // PAIRS}
    model["weights"] = warmed(learned.where("text IS NOT NULL"), model)
    return model


def learn(docs: DataFrame, train: Column) -> dict:
    """What scoring needs of the rows where ``train`` holds: counts of words and pairs as stored tables, code, logits, gates
    and weights."""
    learned = batches_of(docs.where(train))
    model = _learned(learned)
    pairs = pair_rows(learned.withColumn("learned", F.lit(True)), model).withColumn("batch", F.lit(None).cast("long"))
    return model | {"pairs": store(pairs, "pairs")}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """Adds n_tokens, n_known, train_tokens, base_score, score and bits_per_byte to every (stored) row's doc_id."""
    batched = batches_of(docs)
    return _scored(batched, pair_rows(batched, model).unionByName(model["pairs"]), model)


def learn_and_score(docs: DataFrame, train: Column) -> DataFrame:
    """``score(docs, learn(docs, train))``, where every pair of words goes to its bucket once, to be counted and asked for."""
    batched = batches_of(docs.withColumn("learned", F.coalesce(train, F.lit(False))), "learned")
    model = _learned(batched.where("learned"))
    return _scored(batched, pair_rows(batched, model), model)


def _scored(batched: DataFrame, pairs: DataFrame, model: dict) -> DataFrame:
    given, weights, buckets, words, n, v = (model[c] for c in ("shared", "weights", "buckets", "words", "tokens", "distinct"))
    whole = n + 0.1 * (v + 1)
    kind = batched.schema["doc_id"].dataType.simpleString()
    found = store(counted(pairs), "counted", release=True)
    novel = novelty(found)

    def run(batch: pa.Table, found: pa.Table) -> pa.Table:
        codes = given.value["codes"]
        counts = np.append(codes["counts"], 0)  # the last one is for words without a code
        batch = batch.sort_by("row")
        texts = batch["text"].combine_chunks()
        numbers = numbered(texts)
        number = symbols(numbers[0], codes)
        distinct, flat, n_words, mixed, _, symbol, spelled = score_texts(texts, given.value | {"weights": weights}, numbers, symbol=number)
        held = answered(texts, distinct, flat, found, codes["words"], buckets, number)
        start = np.cumsum(n_words) - n_words
        paired = np.add.reduceat(with_pairs(distinct, flat, symbol, spelled, held, {"codes": codes, "novel": novel}, number), start)
        total = (np.logaddexp(mixed * np.log(10), paired) - np.log(2)) / np.log(10)
        seen = counts[number]
        cost = np.where(seen > 0, np.log10((seen + 0.1) / whole), 0.0)
        in_head = seen[flat] > 0
        rest = flat[~in_head]
        names = pa.array(distinct, pa.binary()).cast(pa.string()).take(pa.array(rest))
        rare = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(~in_head)])[np.append(start, len(flat))], pa.int32()), names)
        size = np.add.reduceat(np.array([len(w) + (w != b"\n") for w in distinct], np.int64)[flat], start)
        return pa.table([
            batch["doc_id"], pa.array(n_words), pa.array(np.add.reduceat(in_head.astype(np.int64), start)),
            pa.array(np.add.reduceat(cost[flat], start)), pa.array(total), pa.array(-total * np.log2(10) / size), rare],
            names=["doc_id", "n_tokens", "head_known", "head_score", "score", "bits_per_byte", "rest"])

    scored = store(batched.select("batch", "row", "doc_id", "text").groupBy("batch").cogroup(found.where("batch IS NOT NULL").drop("seen", "once").groupBy("batch")).applyInArrow(
        run, f"doc_id {kind}, n_tokens long, head_known long, head_score double, score double, bits_per_byte double, rest array<string>"
    ).withColumn("rid", F.monotonically_increasing_id()), "scored", release=True)
    rare = scored.select("rid", F.explode("rest").alias("word"))
    counts = rare.join(words, "word", "left").groupBy("rid").agg(
        F.count("n").alias("known"), F.sum(F.log10((F.coalesce("n", F.lit(0)) + 0.1) / whole)).alias("cost"))
    return scored.join(counts, "rid", "left").select(
        "doc_id", "n_tokens", (F.col("head_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("head_score") + F.coalesce("cost", F.lit(0.0))).alias("base_score"), "score", "bits_per_byte")
