"""Cross-tokenizer alignment against whole texts encoded by the libraries and plain loops."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from barline.llm import alignment, queries

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return alignment.Tokenizers(A, B)


def plain_groups(both, text):
    """The groups of a text, from both encodings of all of it."""
    if not text:
        return []
    whole = (" " + text).encode()
    sides = []
    for ids, words in ((both.a.encode(" " + text, add_special_tokens=False).ids, both.a_bytes), (both.b.encode(text), both.b_bytes)):
        if b"".join(words[i] for i in ids) != whole:
            return []
        ends, at = [], 0
        for i in ids:
            at += len(words[i])
            ends.append(at)
        sides.append((ids, ends))
    common = sorted(set(sides[0][1]) & set(sides[1][1]))
    out, last = [], 0
    for cut in common:
        out.append(tuple([i for i, e in zip(ids, ends) if last < e <= cut] for ids, ends in sides))
        last = cut
    return out


def plain(both, rows):
    found = [(i, plain_groups(both, t)) for i, t in rows]
    links = [Counter((a, b) for x, y in groups for a in x for b in y) for _, groups in found]
    holds = Counter(p for own in links for p in own)
    most = defaultdict(int)
    for (a, _), n in holds.items():
        most[a] = max(most[a], n)
    out = []
    for (i, groups), own in zip(found, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(own.values()),
                    sum(n for p, n in own.items() if holds[p] == most[p[0]]), sum(n * holds[p] for p, n in own.items()),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


HARD = [
    None, "", " ", "  ", "\n", "\n\n", " a", "a ", "a  ", "a  b", "a\nb", "a \n b", "a\n  b", "a\t\tb\x0bc\x0cd", "a\r\nb", "a\r b", "a \r\n  b", "\r", ";\r\n}\r",
    "a\x1cb \x1c c\x1c d", "a\xa0 b\xa0\xa0  c", "a　 b", "  x  y", "▁", "a▁b", "x ▁ y", "end.Begin,now;so:what?!.. x. .y 3.a a.3 \xe9.z \u0416.x ).,", "café naïve 你好 \U0001f600\U0001f468‍\U0001f469",
    "<|endoftext|> <s></s> <unk> <0x0A> <pad>", "don't we'll I'M", "1234567890 3.14", "\x00 a\x00b", "zero​width﻿ join", "é ́x", "?!?! ... --- ===\n===", "İıßﬁ",
    "word " * 300, "你" * 500, "ab" * 3000, " " * 700 + "x", "\n" * 90, "q" * 4000, "aaaa aaaa\naaaa " * 40,
]


def test_documents_equal_plain_loops(spark, both):
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "\r", "\t", "the", "ing", "é", "你", ".", "'s", "\xa0", "　", "\U0001f600", "12", "<s>", "A", "\x1c", "_", "́", "\x85", " ", "\x0b"]
    rows = list(enumerate(HARD)) + [(100 + k, "".join(rng.choice(parts) for _ in range(rng.randint(1, 40)))) for k in range(1500)]
    rows += [(7, "the same again"), (7, "the same again"), (None, "no id"), (None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("Block", "AT", "pair", "N_A", "docs")}).repartition(3)
    got = alignment.align(table, A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(both, rows)
    assert alignment.align(table.limit(0), A, B).count() == 0


def test_query_equals_plain_loops(spark, both):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op11_token_alignment(spark, SF).collect()), key=str) == plain(both, rows)


def test_wide_groups_count_by_different_ids():
    rng = np.random.default_rng(1)
    n_a, n_b = [3, 40, 1, 200], [2, 30, 1, 90]
    a, b = rng.integers(0, 6, sum(n_a)), rng.integers(0, 5, sum(n_b))
    a_group, b_group = np.repeat(np.arange(4), n_a), np.repeat(np.arange(4), n_b)
    want = Counter((int(g), int(x) << 32 | int(y)) for x, g in zip(a, a_group) for y, h in zip(b, b_group) if g == h)
    got = Counter()
    for g, p, n in zip(*alignment.linked(a, b, a_group, b_group)):
        got[int(g), int(p)] += int(n)
    assert got == want


@pytest.mark.parametrize("span", [1, 7, 16, 300, 65536])
def test_bitmaps_give_their_positions_back(span):
    rng = np.random.default_rng(span)
    sets = {k: np.sort(rng.choice(span, rng.integers(1, span + 1) if k % 3 else min(span, 3), replace=False)) for k in range(12)}
    key, at = np.repeat(list(sets), [len(s) for s in sets.values()]), np.concatenate(list(sets.values()))
    found, n, docs = alignment.bitmaps(key, at, span)
    assert found.tolist() == list(sets) and n.tolist() == [len(s) for s in sets.values()]
    assert max(map(len, docs.to_pylist())) <= -(-span // 16) * 2
    row, back = alignment.positions(pa.concat_arrays([docs, docs]).slice(3, 15), span)
    got = defaultdict(set)
    for r, p in zip(row.tolist(), back.tolist()):
        got[r].add(p)
    assert all(got[r] == set(sets[(r + 3) % 12].tolist()) for r in range(15))
