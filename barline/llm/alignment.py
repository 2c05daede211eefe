"""Cross-tokenizer alignment by inverted pair bitmaps.

Two tokenizers cut the same bytes (a blank and the text).  Offsets where tokens of both end cut them into groups; every
token of A in a group is linked to every token of B in it.  Documents are dealt into blocks, and in a block every linked pair
of ids has a bitmap of its documents, compressed as in roaring bitmaps: the positions as 16-bit integers, or bits where
these take less.  How often a document links the pair stands in multiplicity planes: plane k holds the documents where bit k
of the links beyond the first is set.  Blocks share no documents, so the popcount of the OR of a pair's bitmaps is the sum
of their popcounts: that is how many documents hold the pair.  The postings then carry the scores back: a pair's count, and
whether it is the highest of its A id, are added up at the positions of its bitmaps and planes.

Texts are encoded in pieces that begin at white space, each different piece once in a while.  That gives the ids of the
whole text where no token of B goes over such a place and A's splitting pattern never does; at which white space this
holds is read off B's vocabulary, and where it holds nowhere, the text is one piece.

Texts that are null or empty, and those whose tokens do not spell the blank and the text, have no tokens: zeros and ''.
Every row is a document, also rows that share a doc_id.  Links in a group are counted by different ids with their numbers,
so a long group without a common offset costs its different ids, not the product of its tokens.  Very long texts are blocks
of their own.  No rows give no rows; columns besides doc_id and text are not looked at.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from collections import defaultdict
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.llm.bpe import ragged
from barline.llm.common import bound_batches, by_size, pieces, store

BLOCK_BYTES = 5_000_000  # of the texts of a block, about
BLOCK_ROWS = 1 << 16  # what positions of 16 bits reach
CACHE = 400_000  # pieces that a task remembers
WIDE = 64  # tokens of A times tokens of B from which a group is counted by different ids
_PLANE = T.StructType([T.StructField("bit", T.IntegerType()), T.StructField("docs", T.BinaryType())])
_PLANE_ARROW = pa.struct([("bit", pa.int32()), ("docs", pa.binary())])
#: White space beyond what a piece may begin with: a place after one of these is no beginning.
_OTHER_SPACE = r"\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff"


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and where texts may be cut."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        with open(a_path, encoding="utf-8") as file:
            described = json.load(file)
        vocabulary = dict(described["model"]["vocab"])
        back = byte_level()
        self.a_bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        b, ids = self.b, range(self.b.get_piece_size())
        written = [b.id_to_piece(i) for i in ids]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(written)]
        self.a_length, self.b_length = (np.array([len(w) for w in words], np.int64) for words in (self.a_bytes, self.b_bytes))
        self.blank = b.piece_to_id("▁")
        self.pattern = self._pattern([p.replace("▁", " ") for i, p in enumerate(written) if not (b.is_byte(i) or b.is_control(i) or b.is_unknown(i))])

    @staticmethod
    def _pattern(written: list[str]) -> re.Pattern:
        """What a piece of a text is: white space, then what follows up to white space."""
        inner = {p[k] for p in written for k in range(1, len(p)) if p[k].isspace() and not p[k - 1].isspace()}
        later = {p[k] for p in written for k in range(1, len(p))}
        safe = "".join(c for c in " \t\n\x0b\x0c" if c not in inner and (c == " " or c not in later))
        if " " not in safe:
            return re.compile(r".+", re.S)
        one = f"[{safe}]+[^{safe}]*"
        return re.compile(f"{one}(?:(?<=[{_OTHER_SPACE}]){one})*", re.S)

    def encode(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of pieces, the first blank of which B adds by itself; what it adds before another space is dropped."""
        a = [e.ids for e in self.a.encode_batch_fast(parts, add_special_tokens=False)]
        b = self.b.encode([p[1:] if p[0] == " " else p for p in parts], num_threads=1)
        for i, part in enumerate(parts):
            if part == " ":
                b[i] = [self.blank]
            elif part[0] != " " and b[i][:1] == [self.blank]:
                b[i] = b[i][1:]
        return a, b


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The lists one after the other, and their lengths."""
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())), n


def linked(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair, times) of the links between tokens of the same group; a pair may come several times.

    Groups are numbered from 0 without a gap in both; a pair is the A id shifted by 32, and the B id.
    """
    n_a, n_b = np.bincount(a_group), np.bincount(b_group)
    if not len(n_a):
        return (np.empty(0, np.int64),) * 3
    a_first, b_first = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    wide = n_a * n_b >= WIDE
    of = np.flatnonzero(~wide[a_group])  # tokens of A, each beside the tokens of B of its group
    each = n_b[a_group[of]]
    groups = [np.repeat(a_group[of], each)]
    pairs = [np.repeat(a[of], each) << 32 | ragged(b, b_first[a_group[of]], each)]
    times = [np.ones(len(pairs[0]), np.int64)]
    for g in np.flatnonzero(wide).tolist():
        x, m = np.unique(a[a_first[g]:a_first[g] + n_a[g]], return_counts=True)
        y, n = np.unique(b[b_first[g]:b_first[g] + n_b[g]], return_counts=True)
        pairs.append((x[:, None] << 32 | y).ravel())
        times.append((m[:, None] * n).ravel())
        groups.append(np.full(len(pairs[-1]), g))
    return np.concatenate(groups), np.concatenate(pairs), np.concatenate(times)


class Aligner:
    """Groups and links of pieces, remembered by piece."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.forget()

    def forget(self):
        self.numbers = defaultdict(count().__next__)
        self.sums = np.zeros((0, 5), np.int64)  # spells the piece, tokens of A, of B, groups, links
        self.written: list[str] = []
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pair, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, parts: list[str]):
        known = self.tokenizers
        right = np.ones(len(parts), bool)
        sides = list(zip(known.encode(parts), (known.a_bytes, known.b_bytes), (known.a_length, known.b_length)))
        spelt = [part.encode() for part in parts]
        sizes = np.fromiter(map(len, spelt), np.int64, len(spelt))
        for ids, words, lengths in sides:
            flat, n = _flat(ids)
            end = np.cumsum(np.append(0, lengths[flat]))
            cut = np.cumsum(np.append(0, n))
            if not (np.array_equal(np.diff(end[cut]), sizes) and b"".join([words[i] for i in flat.tolist()]) == b"".join(spelt)):
                right &= np.array([b"".join([words[i] for i in own]) == part for own, part in zip(ids, spelt)], bool)
        (a, n_a, a_end), (b, n_b, b_end) = (
            (flat, n, np.cumsum(lengths[flat])) for ids, _, lengths in sides
            for flat, n in [_flat(ids if right.all() else [x if ok else [] for x, ok in zip(ids, right.tolist())])])
        common = np.intersect1d(a_end, b_end)
        a_group, b_group = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
        a_cut, b_cut = (np.concatenate([[0], np.cumsum(np.bincount(g))]).tolist() if len(g) else [0] for g in (a_group, b_group))
        in_a, in_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        groups = [f"{','.join(in_a[i:j])}|{','.join(in_b[k:m])}" for i, j, k, m in zip(a_cut, a_cut[1:], b_cut, b_cut[1:])]
        owner = np.repeat(np.arange(len(parts)), n_a)[np.array(a_cut[:-1], np.int64)] if len(groups) else np.zeros(0, np.int64)
        n_groups = np.bincount(owner, minlength=len(parts))
        cut = np.concatenate([[0], np.cumsum(n_groups)]).tolist()
        self.written += [";".join(groups[i:j]) for i, j in zip(cut, cut[1:])]
        group, pair, times = linked(a, b, a_group, b_group)
        of = owner[group]
        order = np.argsort(of, kind="stable")
        length = np.bincount(of, minlength=len(parts))
        n_links = np.zeros(len(parts), np.int64)
        np.add.at(n_links, of, times)
        self.start = np.concatenate([self.start, len(self.pair) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.pair, self.times = np.concatenate([self.pair, pair[order]]), np.concatenate([self.times, times[order]])
        self.sums = np.concatenate([self.sums, np.stack([right, n_a, n_b, n_groups, n_links], 1)])

    def block(self, texts: list[str | None]):
        """By text: tokens of A, of B, groups and links, and the digest of the groups; then (pair, position, times) of all
        links, in the order of pair and position, each once."""
        if len(self.numbers) > CACHE:
            self.forget()
        number, find = self.numbers.__getitem__, self.tokenizers.pattern.findall
        known, found = len(self.numbers), []
        for text in texts:
            parts = find(" " + text) if text else []
            found.append(np.fromiter(map(number, parts), np.int64, len(parts)))
        if len(self.numbers) > known:
            fresh = islice(self.numbers, known, None)
            while some := list(islice(fresh, 20_000)):
                self._learn(some)
        found = [x if self.sums[x, 0].all() else x[:0] for x in found]
        sums = np.array([self.sums[x, 1:].sum(0) for x in found], np.int64).reshape(len(found), 4)
        digests = [hashlib.sha256(";".join([self.written[i] for i in x.tolist()]).encode()).hexdigest() if len(x) else "" for x in found]
        at = np.repeat(np.arange(len(found)), [len(x) for x in found])
        part = np.concatenate([*found, np.zeros(0, np.int64)])
        if len(part):  # a piece once for each text, with how often it comes
            key, often = np.unique(at << 32 | part, return_counts=True)
            at, part = key >> 32, key & (1 << 32) - 1
        else:
            often = part
        length = self.length[part]
        pair, times = ragged(self.pair, self.start[part], length), ragged(self.times, self.start[part], length) * np.repeat(often, length)
        names, pair = np.unique(pair, return_inverse=True)
        key = pair * len(found) + np.repeat(at, length)
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        times = np.add.reduceat(times[order], first) if len(first) else times
        return sums, digests, names[key[first] // max(len(found), 1)], key[first] % max(len(found), 1), times


def bitmaps(key: np.ndarray, at: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The different keys, how many positions each has, and these as bitmaps of ``span`` bits; sorted by key and position."""
    first = np.flatnonzero(np.diff(key, prepend=-1))
    n = np.diff(np.append(first, len(key)))
    whole = -(-span // 16) * 2  # bytes of plain bits
    sparse = n * 2 < whole
    size = np.where(sparse, n * 2, whole)
    offset = np.cumsum(size) - size
    out = np.zeros(int(size.sum()) // 2, np.uint16)
    short = np.repeat(sparse, n)
    place = np.repeat(offset // 2 - first, n) + np.arange(len(key))
    out[place[short]] = at[short]
    for i in np.flatnonzero(~sparse).tolist():
        bits = np.zeros(whole * 8, np.uint8)
        bits[at[first[i]:first[i] + n[i]]] = 1
        out[offset[i] // 2:(offset[i] + whole) // 2] = np.packbits(bits).view(np.uint16)
    ends = np.append(offset, size.sum()).astype(np.int32)
    return key[first], n, pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(out)])


def positions(docs: pa.Array, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, position) of all bits set in bitmaps of ``span`` bits; the inverse of ``bitmaps``."""
    whole = -(-span // 16) * 2
    ends = np.frombuffer(docs.buffers()[1], np.int32, len(docs) + 1, docs.offset * 4)
    size = np.diff(ends)
    data = np.frombuffer(docs.buffers()[2], np.uint8)[ends[0]:ends[-1]] if len(docs) and ends[-1] > ends[0] else np.zeros(0, np.uint8)
    sparse = size < whole
    short = data[np.repeat(sparse, size)].view(np.uint16)
    rows, at = [np.repeat(np.flatnonzero(sparse), size[sparse] // 2)], [short.astype(np.int64)]
    if not sparse.all():
        row, bit = np.nonzero(np.unpackbits(data[np.repeat(~sparse, size)].reshape(-1, whole), axis=1))
        rows.append(np.flatnonzero(~sparse)[row])
        at.append(bit)
    return np.concatenate(rows), np.concatenate(at)


def _planes(pair: np.ndarray, at: np.ndarray, times: np.ndarray, names: np.ndarray, span: int) -> pa.Array:
    """For each of ``names`` the multiplicity planes of its links beyond the first, as a list of (bit, bitmap)."""
    more = times - 1
    keys, spots = [np.zeros(0, np.int64)], [at[:0]]
    number = np.searchsorted(names, pair)
    for bit in range(int(more.max(initial=0)).bit_length()):
        on = np.flatnonzero(more >> bit & 1)
        keys.append(number[on] << 6 | bit)
        spots.append(at[on])
    key, spot = np.concatenate(keys), np.concatenate(spots)
    order = np.lexsort((spot, key))
    found, _, docs = bitmaps(key[order], spot[order], span)
    ends = np.searchsorted(found >> 6, np.arange(len(names) + 1)).astype(np.int32)
    planes = pa.StructArray.from_arrays([pa.array(found & 63, pa.int32()), docs], fields=list(_PLANE_ARROW))
    return pa.ListArray.from_arrays(pa.array(ends), planes)


def postings(docs: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, DataFrame]:
    """Stores both tables of one pass over the texts.

    By document: block, at, doc_id, n_a, n_b, n_groups, n_links, groups_sha256.  By block and pair: block, span (documents of
    the block), pair, n_docs, docs and planes.
    """
    kind = docs.schema["doc_id"].dataType
    sums = ["n_a", "n_b", "n_groups", "n_links"]
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("span", T.IntegerType()), T.StructField("at", T.IntegerType()), T.StructField("doc_id", kind),
        *(T.StructField(n, T.LongType()) for n in sums), T.StructField("groups_sha256", T.StringType()),
        T.StructField("pair", T.LongType()), T.StructField("n_docs", T.IntegerType()), T.StructField("docs", T.BinaryType()),
        T.StructField("planes", T.ArrayType(_PLANE))])
    bound_batches(docs.sparkSession)

    def run(batches):
        gc.disable()  # pieces are millions of small lists without cycles, and looking for cycles took a quarter of the time
        try:
            yield from aligned(batches)
        finally:
            gc.enable()

    def aligned(batches):
        aligner, number, names = Aligner(Tokenizers(a_path, b_path)), count(), schema.fieldNames()

        def rows(n: int, **columns):
            kinds = {"block": pa.int64(), "span": pa.int32(), "at": pa.int32(), "groups_sha256": pa.string(), "pair": pa.int64(),
                     "n_docs": pa.int32(), "docs": pa.binary(), "planes": pa.list_(_PLANE_ARROW)} | dict.fromkeys(sums, pa.int64())
            whole = {c: columns.get(c) for c in names}
            return pa.RecordBatch.from_arrays([
                x if isinstance(x, pa.Array) else pa.nulls(n, kinds.get(c, id_kind)) if x is None else pa.array(x, kinds[c])
                for c, x in whole.items()], names=names)

        for batch in pieces(by_size(batches, limit=BLOCK_BYTES), BLOCK_ROWS):
            block, span, id_kind = TaskContext.get().partitionId() << 32 | next(number), batch.num_rows, batch["doc_id"].type
            found, digests, pair, at, times = aligner.block(batch["text"].to_pylist())
            yield rows(span, block=np.full(span, block), span=np.full(span, span), at=np.arange(span), doc_id=batch["doc_id"],
                       groups_sha256=digests, **{c: found[:, i] for i, c in enumerate(sums)})
            held, n, bits = bitmaps(pair, at, span)
            planes = _planes(pair, at, times, held, span)
            part = rows(len(held), block=np.full(len(held), block), span=np.full(len(held), span), pair=held, n_docs=n, docs=bits, planes=planes)
            yield from pieces([part], 20_000)

    whole = store(docs.select("doc_id", "text").mapInArrow(run, schema), "alignment")
    by_document = whole.where("pair IS NULL").select("block", "at", "doc_id", *sums, "groups_sha256")
    return by_document, whole.where("pair IS NOT NULL").select("block", "span", "pair", "n_docs", "docs", "planes")


def scores(posted: DataFrame) -> DataFrame:
    """(pair, count, best): the documents that hold a pair linked, and whether no pair of the same A id has more.

    The highest counts are a row for each id of A's vocabulary, and are broadcast.
    """
    counts = posted.groupBy("pair").agg(F.sum("n_docs").alias("count"))
    of = F.shiftright("pair", 32)
    most = counts.groupBy(of.alias("of")).agg(F.max("count").alias("most"))
    return counts.join(F.broadcast(most), of == F.col("of")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def returned(posted: DataFrame, scored: DataFrame) -> DataFrame:
    """(block, at, n_best, count_sum): the scores of the pairs, added up where their bitmaps and planes have bits."""

    def totals(batches):
        block, held = None, None
        for batch in batches:
            marks = batch["block"].to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(marks)]
            for i, j in zip(edges, edges[1:]):
                if i == j:
                    continue
                if marks[i] != block:
                    if held is not None:
                        yield given(block, held)
                    block, held = int(marks[i]), np.zeros((batch["span"][i].as_py(), 2), np.int64)
                part, span = batch.slice(i, j - i), len(held)
                score = np.stack([part["best"].cast(pa.int64()).to_numpy(), part["count"].to_numpy()], 1)
                row, at = positions(part["docs"], span)
                np.add.at(held, at, score[row])
                planes = part["planes"].flatten()
                own = np.repeat(np.arange(j - i), np.diff(part["planes"].offsets.to_numpy()))
                bit, docs = planes.flatten()
                row, at = positions(docs, span)
                np.add.at(held, at, score[own[row]] << bit.to_numpy().astype(np.int64)[row][:, None])
        if held is not None:
            yield given(block, held)

    def given(block, held):
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(held), block)), pa.array(np.arange(len(held), dtype=np.int32)), pa.array(held[:, 0]), pa.array(held[:, 1])],
            names=["block", "at", "n_best", "count_sum"])

    sent = posted.drop("n_docs").join(scored, "pair").drop("pair").repartition("block").sortWithinPartitions("block")
    return sent.mapInArrow(totals, "block long, at int, n_best long, count_sum long")


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    ``n_best`` counts the links whose pair is held by the most documents among the pairs of its A id, ties included;
    ``count_sum`` adds up, over the links, how many documents hold the pair.
    """
    by_document, posted = postings(docs, a_path, b_path)
    back = returned(posted, scores(posted))
    return by_document.join(back, ["block", "at"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
