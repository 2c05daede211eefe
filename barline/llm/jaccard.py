"""N-gram Jaccard join: documents whose sets of five-word shingles are similar to 0.8 or more.

Copies (equal texts) become one node.  MinHash values of a node are cut into bands; nodes that agree on a whole band meet
in a bucket.  ``BANDS`` bands of ``ROWS`` values miss a pair at 0.8 with probability 7e-6, more similar ones far less often.
Buckets are cut into tiles of at most two times ``TILE`` nodes, whatever their size.  A pair is looked at in the tile of
its first common band only: its MinHash values are compared a few at a time, and the pair is dropped as soon as the
posterior probability that its similarity reaches the threshold, under a uniform prior, is below ``TOLERANCE``.  The rest
are verified by their shingle sets.  Tiles return a row per node, with the number of its links and an edge to the
smallest node it is connected to, so results grow with the nodes and not with the pairs.

Words are what white space separates, as they stand; a text of one to four words has one shingle, all its words.  Texts
that are null or without words are similar to nothing and are groups of their own.  Shingles are compared by 64-bit hashes.
Rows that share a doc_id are linked as if similar, since the id stands for the document; null ids take part by row.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.llm.common import added, giving_back, grown, masked, pieces, store
from barline.llm.components import components

WORDS = 5  # of a shingle
THRESHOLD = 0.8
BANDS, ROWS = 30, 5
TOLERANCE = 1e-6
TILE = 512
_HASHES = BANDS * ROWS
_STEP = 30  # MinHash values compared at a time


def _factors(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(20))
    return rng.integers(0, 2**32, n, dtype=np.uint32) | np.uint32(1), rng.integers(0, 2**32, n, dtype=np.uint32)


def shingles(text: str | None) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles of a text, ascending."""
    words = (text or "").encode().split()
    code = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    if not width:
        return code
    mixed = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        mixed = (mixed ^ code[k:k + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def minhashes(codes: np.ndarray, factor: np.ndarray, flip: np.ndarray) -> np.ndarray:
    """MinHash values of a set, in slices so that a long text needs no more memory."""
    low = (codes >> np.uint64(16)).astype(np.uint32)
    least = np.full(len(factor), 2**32 - 1, np.uint32)
    for at in range(0, len(low), 4096):
        np.minimum(least, ((low[at:at + 4096, None] ^ flip) * factor).min(0), out=least)
    return least


def least_matches(step: int = _STEP, hashes: int = _HASHES, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For every number of compared values, the fewest matches with which a pair goes on.

    With m of n matches and a uniform prior, the similarity is at least t with the probability that a binomial
    variable of n + 1 trials and chance t is at most m.
    """
    found = []
    for n in range(step, hashes + 1, step):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        found.append(m)
    return found


def sketch(docs: DataFrame) -> DataFrame:
    """Stores the rows with ``rid``, ``digest`` (null without words), ``n_shingles``, ``bands`` and ``values``."""
    base = docs.withColumns({"rid": F.monotonically_increasing_id(), "digest": F.md5("text")})
    fields = [("n_shingles", T.LongType()), ("bands", T.ArrayType(T.LongType())), ("minima", T.BinaryType())]
    base, schema = added(base, *fields)

    def run(batches):
        factor, flip = _factors(_HASHES)
        for batch in pieces(batches):
            sizes, bands, minima = [], [], []
            for text in batch["text"].to_pylist():
                codes = shingles(text)
                least = minhashes(codes, factor, flip)
                sizes.append(len(codes))
                bands.append([xxhash.xxh3_64_intdigest(row.tobytes(), b) - 2**63 for b, row in enumerate(least.reshape(BANDS, ROWS))] if len(codes) else None)
                minima.append((least >> np.uint32(16)).astype(np.uint16).tobytes() if len(codes) else None)
            yield grown(batch, [pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(minima, pa.binary())],
                        [n for n, _ in fields])

    whole = base.mapInArrow(giving_back(run), schema)
    return store(whole.withColumn("digest", F.when(F.col("n_shingles") > 0, F.col("digest"))), "sketches")


_TILE = ["key", "i", "j"]


def _runs(batches, columns):
    """Tables of the rows of one tile, from batches sorted by tile."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows])
        marks = np.stack([rows[c].to_numpy() for c in _TILE])
        cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1
        edges = [0, *cuts.tolist()]
        for a, b in zip(edges, edges[1:]):
            yield rows.slice(a, b - a)
        held = rows.slice(edges[-1])
    if held is not None:
        yield held


def _partners(part: np.ndarray, i: int, j: int, a: int) -> np.ndarray:
    """Rows of the tile that row ``a`` is paired with here."""
    if i == j:
        return np.arange(a + 1, len(part))
    return np.flatnonzero(part == j) if part[a] == i else np.empty(0, np.int64)


def _prune(batches):
    need = least_matches()
    for rows in _runs(batches, None):
        n = rows.num_rows
        i, j, band = (rows[c][0].as_py() for c in ("i", "j", "band"))
        node, part, size = (rows[c].to_numpy() for c in ("node", "part", "n_shingles"))
        bands = rows["bands"].combine_chunks().flatten().to_numpy().reshape(n, BANDS)
        minima = np.frombuffer(b"".join(rows["minima"].to_pylist()), np.uint16).reshape(n, _HASHES)
        lists: list[list[int]] = [[] for _ in range(n)]
        seen = np.zeros(n, bool)
        for a in range(n):
            b = _partners(part, i, j, a)
            b = b[np.minimum(size[b], size[a]) >= THRESHOLD * np.maximum(size[b], size[a])]
            b = b[(bands[b] == bands[a]).argmax(1) == band] if len(b) else b
            matches = np.zeros(len(b), np.int64)
            for at, least in zip(range(0, _HASHES, _STEP), need):
                if not len(b):
                    break
                matches += (minima[b, at:at + _STEP] == minima[a, at:at + _STEP]).sum(1)
                on = matches >= least
                b, matches = b[on], matches[on]
            if len(b):
                lists[a] = node[b].tolist()
                seen[a] = True
                seen[b] = True
        if seen.any():
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows["key"][0].as_py()] * len(at)), pa.array([i] * len(at)), pa.array([j] * len(at)),
                 pa.array(node[at]), pa.array([lists[x] for x in at], pa.list_(pa.int64()))],
                names=[*_TILE, "node", "others"])


def _verify(batches):
    for rows in _runs(batches, None):
        nodes = rows["node"].to_pylist()
        sets = dict(zip(nodes, (np.frombuffer(s, np.uint64) for s in rows["codes"].to_pylist())))
        copies = dict(zip(nodes, rows["copies"].to_pylist()))
        texts, links, root = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), {x: x for x in nodes}

        def top(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for a, others in zip(nodes, rows["others"].to_pylist()):
            one = sets[a]
            for b in others:
                two = sets[b]
                both = np.concatenate([one, two])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                if common >= THRESHOLD * (len(both) - common):
                    for x, y in ((a, b), (b, a)):
                        texts[x] += 1
                        links[x] += copies[y]
                    u, v = top(a), top(b)
                    root[max(u, v)] = min(u, v)
        linked = [x for x in nodes if texts[x]]
        if linked:
            yield pa.RecordBatch.from_arrays(
                [pa.array(linked), pa.array([texts[x] for x in linked]), pa.array([links[x] for x in linked]),
                 pa.array([top(x) for x in linked])], names=["node", "texts", "links", "to"])


def _codes(batches):
    for batch in pieces(batches):
        yield pa.RecordBatch.from_arrays(
            [batch["node"], batch["copies"], pa.array([shingles(t).tobytes() for t in batch["text"].to_pylist()], pa.binary())],
            names=["node", "copies", "codes"])


def links(sketched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of stored sketches: (digest, node, copies) of every text with words, and (node, texts, links, to) by tile and node.

    ``texts`` counts the other texts that a node is linked to in a tile, ``links`` the documents that have these texts.
    """
    texts = store(sketched.where("digest IS NOT NULL").groupBy("digest").agg(F.min("rid").alias("node"), F.count("*").alias("copies")), "texts")
    nodes = sketched.join(texts.select("node", "copies"), sketched["rid"] == F.col("node"))
    signs = nodes.select("node", "n_shingles", "bands", "minima")
    entries = signs.select("node", F.posexplode("bands").alias("band", "sign")).select("node", "band", F.xxhash64("band", "sign").alias("key"))
    shared = entries.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    cut = F.ceil(F.col("m") / TILE).cast("int")
    member = entries.join(shared, "key").withColumn("cut", cut).withColumn("part", F.pmod(F.xxhash64("node"), "cut").cast("int"))
    tiles = member.select("node", "band", "key", "part", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)).alias("other")).select(
        "key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "node", "band", "part")
    dealt = tiles.join(signs, "node").repartition(*_TILE).sortWithinPartitions(*_TILE, "node")
    left = store(dealt.mapInArrow(giving_back(_prune), "key long, i long, j long, node long, others array<long>"), "candidates")
    needed = nodes.select("node", "copies", "text").join(left.select("node").distinct(), "node", "left_semi")
    sets = needed.mapInArrow(giving_back(_codes), "node long, copies long, codes binary")
    exact = left.join(sets, "node").repartition(*_TILE).sortWithinPartitions(*_TILE, "node")
    return texts, store(exact.mapInArrow(giving_back(_verify), "node long, texts long, links long, to long"), "links")


def classes(sketched: DataFrame) -> DataFrame:
    """(rid, node, class_row, n_copies, n_texts, n_links) of every sketched row.

    ``class_row`` is the smallest rid of the component; ``n_links`` counts the other documents that are similar, copies
    included, ``n_texts`` the other texts.
    """
    texts, found = links(sketched)
    same = sketched.where("doc_id IS NOT NULL AND digest IS NOT NULL").join(texts, "digest").groupBy("doc_id").agg(
        F.min("node").alias("b"), F.max("node").alias("a")).where("a <> b")  # an id with several texts
    by_id = sketched.join(texts, "digest").join(same.select("doc_id", "b"), "doc_id").select(F.col("node").alias("a"), "b")
    roots = store(components(found.select(F.col("node").alias("a"), F.col("to").alias("b")).union(by_id)), "roots")
    counts = found.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("links").alias("links"))
    by_text = texts.join(counts, "node", "left").join(roots.withColumnRenamed("id", "node"), "node", "left").select(
        "digest", "node", F.coalesce("root", "node").alias("class_row"), "copies",
        F.coalesce("texts", F.lit(0)).alias("n_texts"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return sketched.select("rid", "doc_id", "digest").join(by_text, "digest", "left").select(
        "rid", "doc_id", F.coalesce("node", "rid").alias("node"), F.coalesce("class_row", "rid").alias("class_row"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"), F.coalesce("n_texts", F.lit(0)).alias("n_texts"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"))


def joined(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of the class), n_copies, n_texts and n_links of every row."""
    rows = store(classes(sketch(docs.select("doc_id", "text"))), "classes")
    named = rows.groupBy("class_row").agg(F.min("doc_id").alias("class_id"))
    return rows.join(named, "class_row").select("doc_id", "class_id", "n_copies", "n_texts", "n_links")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one document, that of the smallest doc_id, of each class."""
    wide, back = masked(docs, "doc_id")
    whole = sketch(wide)
    rows = classes(whole)
    chosen = rows.groupBy("class_row").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("x")).select(F.col("x.rid").alias("rid"))
    return back(whole.join(chosen, "rid", "left_semi"))
