"""Language ID, quality rules, BPE, toxicity and LM scoring against plain Python, and their edge cases."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from barline.llm import bpe, language, lm, quality, toxicity
from barline.llm.common import fold

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, source string"
LONG = "lorem ipsum dolor sit amet " * 40_000


def docs(spark, rows):
    return spark.createDataFrame([(*r, None, None)[:4] if len(r) < 4 else r for r in rows], DOCS)


# --- byte-level BPE -------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Merges(bpe.read_ranks(RANKS)), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_bpe_equals_the_library_on_random_texts(encoder, library):
    rng = random.Random(3)
    texts = ["".join(rng.choice("aaab \n\t\x1c\x85 é漢ß'sS12٣²Ⅷ_​🙂́") for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == library.encode_ordinary(text)
        assert encoder.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 20_000, " " * 9_000, "ab" * 9_000, "abcabcab" * 2_000, "<|endoftext|>", "it's we'll"])
def test_bpe_of_long_pre_tokens(encoder, library, text):
    assert encoder.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_long_and_short_pre_tokens_merge_alike(encoder):
    rng = random.Random(4)
    pieces = ["".join(rng.choice("thernigao") for _ in range(rng.randint(2, 40))).encode() for _ in range(500)]
    ids, start = bpe.merge_short(pieces, encoder.merges)
    ends = [*start[1:].tolist(), len(ids)]
    for piece, a, b in zip(pieces, start.tolist(), ends):
        assert ids[a:b].tolist() == bpe.merge_long(piece, encoder.merges)


def test_bpe_query_digests(spark, library):
    rows = [(1, "The naïve café\n\n  it's"), (2, None), (3, ""), (3, ""), (None, LONG)]
    table = docs(spark, rows).withColumn("IDS", F.lit("clash"))
    encoded = bpe.encode(table, RANKS, public_tokenizers.PATTERN)
    got = Counter(map(tuple, bpe.digests(encoded).collect()))
    want = Counter()
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        want[(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())] += 1
    assert got == want
    assert bpe.encode(table.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


# --- language ID ----------------------------------------------------------------------------------

def plain_ngrams(text):
    found = Counter()
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        padded = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                gram = padded[i:i + n]
                if gram != " ":
                    found[gram] += 1
    return found


def test_ngrams_equal_a_plain_count():
    for text in ("Über die Brücke, 12 Mal!", "a", "a b a", "x" * 5):
        codes, counts = language.ngrams(text)
        got = {}
        for code, count in zip(codes.tolist(), counts.tolist()):
            letters = [code >> 42 & 0x1FFFFF, code >> 21 & 0x1FFFFF, code & 0x1FFFFF]
            got["".join(chr(x) for x in letters if x)] = count
        want = plain_ngrams(text)
        for gram in want:  # blanks between words are shared, so border n-grams count alike
            assert got[gram] == want[gram], gram
        assert set(got) == set(want)


def test_language_of_edge_cases(spark):
    rows = [(1, "the cat and the dog and the bird", "en", "a"), (2, "der hund und die katze und der vogel", "de", "a"),
            (3, None, "en", None), (4, "", "de", None), (5, "12 34 !!", None, None), (6, "the dog", None, None),
            (6, "the dog", None, None), (7, LONG, "xx", None)]
    table = docs(spark, rows).withColumn("Score", F.lit("clash"))
    got = {(r["doc_id"], r["lang_pred"]) for r in language.learned(table, F.lit(True)).collect()}
    assert got == {(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "en"), (7, "xx")}
    untaught = language.learned(table, F.lit(False)).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in untaught] == [("und", 0.0)]
    assert language.learned(table.limit(0), F.lit(True)).count() == 0


def test_equal_distances_go_to_the_first_language():
    predict = language.predictor([("b", 97, 1), ("a", 97, 1)])
    assert predict("a")[0] == "a"


def test_held_out_accuracy(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = fold(F.col("doc_id"), 4) == 2
    found = language.learned(table, ~held).where(held)
    assert found.where("lang = lang_pred").count() >= 0.97 * found.count()


# --- quality rules --------------------------------------------------------------------------------

def plain_repeats(words, window=8):
    seen = Counter(tuple(words[i:i + window]) for i in range(len(words) - window + 1))
    inside = set()
    for i in range(len(words) - window + 1):
        if seen[tuple(words[i:i + window])] > 1:
            inside |= set(range(i, i + window))
    return len(inside)


def test_repeated_words_equal_a_plain_count():
    rng = random.Random(5)
    for _ in range(300):
        words = [rng.choice("ab") for _ in range(rng.randint(0, 60))]
        assert quality.repeated_words(words) == plain_repeats(words)


def test_counts():
    text = "Ab c#\n\n x é \nAb c#\n \t\n$"
    assert quality.counts(text)[:5] == (7, 11, 3, 1, 0)
    assert quality.counts(None)[:5] == (0, 0, 0, 0, 0) == quality.counts("")[:5]


def words(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "one", "two", "three", "of", "the"]) + rng.choice(["", "s", "er"]) for _ in range(n))


def test_judge_keeps_clean_texts_and_drops_outliers(spark):
    rng = random.Random(6)
    rows = [(i, words(rng, rng.randint(40, 300)), "en", "a" if i % 3 else "b") for i in range(300)]
    rows += [(1000 + i, " ".join(w + "###$$$" for w in words(rng, 100).split()), "en", "a") for i in range(5)]
    rows += [(2000, None, None, None), (2001, "", "en", "a"), (2002, LONG, "en", "zz"), (3, rows[3][1], "en", "b")]
    table = docs(spark, rows).withColumn("KEPT", F.lit("clash"))
    found = quality.judge(quality.measure(table)).select("doc_id", "base_failed", "kept").collect()
    assert len(found) == len(rows)
    kept = {r["doc_id"] for r in found if r["kept"]}
    assert kept == set(range(300))
    assert {r["doc_id"] for r in found if r["base_failed"]} == {2000, 2001, 2002}
    assert quality.judge(quality.measure(table.limit(0))).count() == 0


def test_judge_drops_menus_and_repeated_lines(spark):
    rng = random.Random(12)
    stems = [a + b for a in ("ka", "lo", "mi", "ren", "su", "ta", "ve", "dor") for b in ("ba", "li", "mon", "re", "sti", "tu", "nar")]

    def line(n):
        return " ".join(rng.choice(stems) + rng.choice(["", "s", "er"]) for _ in range(n)).capitalize() + "."

    rows = [(i, "\n".join(line(rng.randint(8, 16)) for _ in range(rng.randint(5, 30))), "en", "a") for i in range(400)]
    rows += [(1000 + i, " | ".join(line(2)[:-1] for _ in range(rng.randint(30, 60))), "en", "a") for i in range(10)]
    for i in range(10):
        lines = [line(12) for _ in range(24)]
        again = line(5)  # shorter than a window, so the base rules let it pass
        rows.append((2000 + i, "\n".join(x for k, one in enumerate(lines) for x in ([one, again] if k % 2 else [one])), "en", "a"))
    found = {r["doc_id"]: r for r in quality.judge(quality.measure(docs(spark, rows))).collect()}
    assert not any(r["base_failed"] for r in found.values())
    assert sum(found[i]["kept"] for i in range(400)) >= 398
    assert [i for i, r in found.items() if i >= 1000 and r["kept"]] == []


def test_small_groups_are_judged_by_the_base_rules_alone(spark):
    found = quality.judge(quality.measure(docs(spark, [(1, words(random.Random(1), 50), "en", "a")]))).collect()
    assert [(r["kept"], r["distance"]) for r in found] == [(True, None)]


def test_the_estimate_equals_plain_concentration_steps():
    """The histogram steps find the centre that exact steps find, on data with a fifth of outliers."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, quality._D))
    x[:100] += 12
    mean, inverse = quality._invert(np.median(x, 0), np.eye(quality._D))
    for _ in range(quality.STEPS):
        full = np.zeros((quality._D, quality._D))
        for p, (i, j) in zip(inverse, quality._PAIRS):
            full[i, j] = full[j, i] = p
        away = x - np.array(mean)
        near = np.argsort((away @ full * away).sum(1))[: int(quality.SHARE * len(x))]
        mean, inverse = quality._invert(x[near].mean(0), np.cov(x[near].T, bias=True))
    assert np.abs(np.array(mean)).max() < 0.3


# --- toxicity -------------------------------------------------------------------------------------

def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_the_automaton_finds_what_the_distance_says():
    rng = random.Random(7)
    terms = {"".join(rng.choice("abc") for _ in range(rng.randint(2, 7))): rng.random() for _ in range(40)}
    matcher = toxicity.Matcher(terms)
    for _ in range(5000):
        word = "".join(rng.choice("abcx") for _ in range(rng.randint(1, 8)))
        fits = [(edits(word, t), -w, t) for t, w in terms.items()]
        fits = [f for f in fits if f[0] <= (toxicity.EDITS if len(f[2]) >= toxicity.LONG else 0)]
        best = min(fits, default=None)
        assert matcher.find(word) == ((best[2], best[0]) if best else None)


def test_quotation_lowers_findings():
    matcher = toxicity.Matcher({"scoundrel": 3.0})
    plain, quoted = matcher.features("you scoundrel you are here now"), matcher.features('she called him a "scoundrel" now')
    assert plain[0] > quoted[0] > 0 and plain[2] == 0 < quoted[2]
    assert matcher.features("you sc0undrel")[1] > 0


def test_held_out_toxicity_and_edge_cases(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        bad = i % 5 == 0
        text = words(rng, 60).split()
        for _ in range(4 * bad):
            text.insert(rng.randrange(len(text)), rng.choice(["grobian", "lumpkin", "dastard"]))
        rows.append((i, " ".join(text)))
        labels += [(i, int(bad))] * (1 + i % 2)
    labels += [(None, 1), (5, None), (9999, 1)]
    rows += [(500, None), (501, ""), (502, LONG), (503, "you gr0bian and lumpkln dastarrd grobiam"), (None, "grobian " * 9), (7, rows[7][1])]
    table = docs(spark, rows).withColumn("SCORE", F.lit("clash"))
    model = toxicity.learn(table.select("doc_id", "text"), spark.createDataFrame(labels, "doc_id long, toxic int"), F.col("doc_id") % 2 == 0)
    found = toxicity.score(table, model).select("doc_id", "score").collect()
    assert len(found) == len(rows)
    flagged = Counter(r["doc_id"] for r in found if r["score"] >= 0.7)
    assert set(flagged) == {i for i in range(0, 400, 5)} | {503, None}
    assert all(0 <= r["score"] <= 1 for r in found)
    empty = toxicity.learn(table.select("doc_id", "text").limit(0), spark.createDataFrame([], "doc_id long, toxic int"), F.lit(True))
    assert toxicity.score(table.limit(0), empty).count() == 0


# --- LM scoring -----------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def small():
    rng = random.Random(9)
    learned = [words(rng, 40) for _ in range(80)]
    count = Counter(w for t in learned for w in lm.words_of(t))
    spelled = [0] * 256
    for w, n in count.items():
        for b in w + b" ":
            spelled[b] += n
    codes = lm.make_codes(dict(count.most_common(12)), sum(count.values()), spelled)
    return codes, count


def test_codes_tell_words_apart(small):
    codes, _ = small
    for bits, lengths in ((codes["word_bits"], codes["word_lengths"]), (codes["byte_bits"], codes["byte_lengths"])):
        spelled = [format(int(b), f"0{n}b")[::-1] for b, n in zip(bits, lengths)]
        assert len(set(spelled)) == len(spelled)
        assert not any(a != b and b.startswith(a) for a in spelled[:60] for b in spelled)
        assert math.isclose(sum(2.0 ** -len(s) for s in spelled), 1.0)


def test_probabilities_of_all_next_words_add_up(small):
    """The first word of a text is one of the coded words, or the symbol of all others."""
    codes, count = small
    slots, bit, _, start, length = lm.expand(list(count), codes)
    size = int(lm._BASE[-1])
    weight = np.repeat([float(n) for n in count.values()], length)
    n, ones = (sum(np.bincount(slots[k], w, size) for k in range(lm._K)) for w in (weight, weight * bit))
    model = {"codes": codes, "logits": np.log((ones + lm.DELTA) / (n - ones + lm.DELTA)).astype(np.float16), "weights": lm.start_weights()}
    whole = 0.0
    logit = model["logits"]
    for word in [*codes["words"], b"neverseen"]:
        slots, bit, tells, _, _ = lm.expand([word], codes)
        p = 1.0
        for at in np.flatnonzero(tells):
            x = float(logit[slots[-1][at]]) * 0.9  # what mixing gives before anything was learned in the text
            p *= 1 / (1 + math.exp(-x if bit[at] else x))
        whole += p
    assert abs(whole - 1) < 1e-3
    total = lm.score_texts(["alpha beta", "alpha beta", None, ""], model)[3]
    assert total[0] == pytest.approx(total[1]) and total[2] == total[3] < 0


def test_base_counts_and_edge_cases(spark):
    rng = random.Random(10)
    rows = [(i, words(rng, rng.randint(1, 60)).title()) for i in range(120)] + [(200, None), (201, ""), (None, "Alpha unseenword"), (3, "x"), (202, LONG)]
    table = docs(spark, rows).withColumn("score", F.lit("clash"))
    train = fold(F.col("doc_id"), 10) != 0
    found = lm.score(table, lm.learn(table, train)).collect()
    taught = [t for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 10]
    count = Counter(w for t in taught for w in lm.words_of(t))
    n, v = sum(count.values()), len(count)
    want = Counter()
    for i, text in rows:
        own = lm.words_of(text)
        want[(i, len(own), sum(w in count for w in own), n, round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), 4))] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in found) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in found)


def test_an_empty_corpus_still_scores(spark):
    table = docs(spark, [(1, "some text"), (2, None)])
    found = {r["doc_id"]: r for r in lm.score(table, lm.learn(table, F.lit(False))).collect()}
    assert found[1]["n_tokens"] == 3 and found[1]["n_known"] == 0 and found[1]["score"] < 0
    assert lm.score(table.limit(0), lm.learn(table, F.lit(True))).count() == 0


def test_the_order_of_known_words_counts(spark):
    """Neighbours that were learned make a text likelier than the same words in another order."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)]
    follower = {w: rng.sample(vocabulary, 2) for w in vocabulary}

    def chain(n):
        out = [rng.choice(vocabulary)]
        while len(out) < n:
            out.append(rng.choice(follower[out[-1]]))
        return out

    rows = [(i, " ".join(chain(60))) for i in range(300)]
    natural = [chain(60) for _ in range(20)]
    rows += [(1000 + i, " ".join(t)) for i, t in enumerate(natural)] + [(2000 + i, " ".join(rng.sample(t, len(t)))) for i, t in enumerate(natural)]
    table = docs(spark, rows)
    score = {r["doc_id"]: r["score"] for r in lm.score(table, lm.learn(table, F.col("doc_id") < 1000)).collect()}
    assert all(score[1000 + i] > score[2000 + i] + 20 for i in range(20))


def test_starting_weights_come_from_all_learned_texts(spark):
    """However many they are; every lane counts once."""
    rng = random.Random(12)
    rows = [(i, words(rng, rng.randint(1, 30)) + f" own{i}" * rng.randint(0, 9)) for i in range(2300)] + [(3000, None)]
    table = docs(spark, rows).repartition(5)
    model = lm.learn(table, F.lit(True))
    texts = [t for _, t in rows if t is not None]
    *ends, lanes = lm.score_texts(texts, model | {"weights": lm.start_weights()})[4]
    assert lanes == len(texts)
    assert np.allclose(model["weights"].ravel(), np.array(ends) / lanes, rtol=1e-5, atol=1e-6)


def test_pairs_are_answered_however_a_batch_is_read(spark, monkeypatch):
    """Texts of a batch that are read apart ask apart; each pair has the count that it was learned with, 0 if it was not."""
    monkeypatch.setattr(lm, "PAIRS", 40)  # several buckets
    rng = random.Random(13)
    taught = [words(rng, 12) for _ in range(60)]
    asked = [*taught[:9], "never seen before", "", None]
    model = lm.learn(docs(spark, list(enumerate(taught))), F.lit(True))
    batched = docs(spark, list(enumerate(asked))).select(F.lit(7).cast("long").alias("batch"), F.col("doc_id").cast("long").alias("row"), "text")
    found = lm.answers(batched.repartition(4), model).toArrow()
    assert len(set(found["bucket"].to_pylist())) > 1 and len(set(found["first"].to_pylist())) > 1
    distinct, flat, _ = lm.numbered(asked)
    keys, n = lm.answered(asked, distinct, flat, found, model["codes"]["words"], model["buckets"])
    given, learned = dict(zip(keys.tolist(), n.tolist())), Counter()
    for text in taught:
        own = lm.words_of(text)
        learned.update(zip([b"\n", *own], own))
    before, pair, _ = lm.pair_keys(distinct, flat)
    assert [given[k] for k in pair.tolist()] == [learned[distinct[b], distinct[w]] for b, w in zip(before.tolist(), flat.tolist())]


def test_words_without_a_code_have_their_counted_share(small):
    """However dear their bytes are in tables of fixed size."""
    codes, _ = small
    distinct, flat, _ = lm.numbered(["rareword"])
    _, _, alone = lm.pair_keys(distinct, flat)
    novel = np.zeros((2, lm._BINS), np.int64)
    novel[:, -1] = 1000, 98
    held = (alone[[distinct.index(b"rareword")]], np.array([500]))
    cost = lm.with_pairs(distinct, flat, np.array([1.0, 1.0]), np.array([900.0, 0.0]), held, {"codes": codes, "novel": novel})
    assert cost[0] == pytest.approx(-1 + math.log(0.5 * (1 - 99 / 1002)))


def test_words_of_a_batch_are_looked_up_once(small, monkeypatch):
    """What scores a batch takes the numbers of its words, and gives each word the share that a plain loop gives it."""
    codes, count = small
    size = int(lm._BASE[-1])
    model = {"codes": codes, "logits": np.random.default_rng(16).normal(0, 2, size).astype(np.float16), "weights": lm.start_weights()}
    texts = pa.array([" ".join(w.decode() for w in [*count][:20]) + " unseen one unseen", "", None, "alpha unseen"])
    distinct, flat, n_words = numbers = lm.numbered(texts)
    number = lm.symbols(distinct, codes)
    assert (number < 0).any() and (number >= 0).any()
    plain = lm.score_texts(texts, model)
    before, pair, alone = lm.pair_keys(distinct, flat)
    keys = lm.wanted(distinct, flat, number)
    counts = (keys % np.uint64(3)).astype(np.int64)
    found = pa.table([pa.array(x) for x in zip(*((0, len(texts), b, counts[at].astype(np.uint8).tobytes()) for b, at in lm._dealt(keys, 5)))],
                     names=["first", "texts", "bucket", "counts"])
    monkeypatch.setattr(lm, "symbols", None)  # nobody looks them up again
    scored = lm.score_texts(texts, model, numbers, symbol=number)
    assert all(np.array_equal(a, b) for a, b in zip(plain[3:], scored[3:]))
    held = lm.answered(texts, distinct, flat, found, codes["words"], 5, number)
    assert np.array_equal(held[0], keys) and np.array_equal(held[1], counts)
    novel = np.zeros((2, lm._BINS), np.int64)
    novel[0], novel[1] = np.arange(lm._BINS) + 50, np.arange(lm._BINS)
    got = lm.with_pairs(distinct, flat, scored[5], scored[6], held, {"codes": codes, "novel": novel}, number)
    known, new = dict(zip(keys.tolist(), counts.tolist())), (novel[1] + 1) / (novel[0] + 2)
    for i, (b, w) in enumerate(zip(before.tolist(), flat.tolist())):
        seen = int(codes["counts"][number[b]]) if number[b] >= 0 else known[int(alone[b])]
        fresh = new[1 + int(math.log2(seen)) if number[b] >= 0 else 0] if seen else 1.0
        p = math.exp(-scored[5][i])
        if number[w] < 0:
            p *= (1 - new[-1]) * known[int(alone[w])] / int(novel[0, -1]) + new[-1] * math.exp(-scored[6][i])
        assert got[i] == pytest.approx(math.log((1 - fresh) * known[int(pair[i])] / max(seen, 1) + fresh * p), rel=1e-9)


def test_words_are_split_as_bytes_are():
    texts = [" \x0b a\x1cB\u0085 c\u00a0 \u00c9x\t\t", "", None, "\n \r\f", "A a \x00A", "one"]
    distinct, flat, n_words = lm.numbered(texts)
    assert [distinct[i] for i in flat] == [w for t in texts for w in lm.words_of(t)]
    assert n_words.tolist() == [len(lm.words_of(t)) for t in texts] and len(set(distinct)) == len(distinct)
    found = Counter()
    for batch in lm._count([pa.record_batch([pa.array(texts)], names=["text"])]):
        found.update(dict(zip(batch["word"].to_pylist(), batch["n"].to_pylist())))
    assert found == Counter(w.decode() for t in texts for w in lm.words_of(t))


def test_mixing_equals_a_plain_loop_over_bits(small, monkeypatch):
    """Several lanes a text, lanes of unequal length mixed in several blocks, words with and without codes."""
    monkeypatch.setattr(lm, "SPAN", 64)
    monkeypatch.setattr(lm, "LANES", 3)
    codes, count = small
    rng = np.random.default_rng(14)
    size = int(lm._BASE[-1])
    model = {"codes": codes, "logits": rng.normal(0, 2, size).astype(np.float16), "gates": rng.integers(1, lm._GATES, lm.SLOTS[-1]).astype(np.uint8),
             "weights": lm.start_weights()}
    texts = ["alpha beta gamma " + " ".join(list(count)[5][:4].decode() + str(i) for i in range(7)), "", None, "x", " ".join(w.decode() for w in [*count][:30])]
    distinct, flat, n_words, mixed, ends, by_symbol, by_bytes = lm.score_texts(texts, model)
    at, lanes, summed = 0, 0, np.zeros((lm._GATES, lm._K + 1))
    for text, n, found in zip(texts, n_words, mixed):
        bits = []
        for word in lm.words_of(text):
            slots, bit, tells, _, _ = lm.expand([word], codes)
            bits += [(s, b, t) for s, b, t in zip(slots.T, bit, tells)]
        total = 0.0
        for begin in range(0, len(bits), lm.SPAN):
            lane = bits[begin:begin + lm.SPAN]
            lanes += 1
            w, own, scale = lm.start_weights().astype(float), {}, 1.0
            for group in (lane[i:i + lm.GROUP] for i in range(0, len(lane), lm.GROUP)):
                change, told, step = np.zeros_like(w), dict(own), 0.0
                for s, b, t in group:
                    sign, slot = 2 * int(b) - 1, int(s[-1]) & (lm.OWN - 1)
                    gate = 0 if t else int(model["gates"][s[-1] - lm._BASE[-2]])
                    logit = np.array([*(0.0 if t and k < lm._K - 1 else float(model["logits"][s[k]]) for k in range(lm._K)), own.get(slot, 0.0)]) * sign
                    x = float(np.clip(w[gate] @ logit, -12, 12))
                    cost = math.exp(-x * scale)
                    total += math.log1p(cost)
                    change[gate] += lm.RATE / (1 + math.exp(x)) * logit
                    step += lm.MAP_RATE / lm.GROUP * cost / (1 + cost) * x
                    told[slot] = own.get(slot, 0.0) + lm.OWN_RATE * sign / (1 + math.exp(logit[-1]))
                w, own, scale = w + change, told, scale + step
            summed += w
        assert found == pytest.approx(-total / math.log(10), rel=1e-4)
        assert (by_symbol + by_bytes)[at:at + n].sum() == pytest.approx(total, rel=1e-4)
        at += n
    assert ends[-1] == lanes > len(texts)
    other = model | {"logits": -model["logits"]}  # the same codes with other logits
    assert not np.allclose(lm.score_texts(texts, other)[3], mixed)
    assert np.allclose(ends[:-1].reshape(summed.shape), summed, rtol=1e-4, atol=1e-4)


def test_pairs_go_to_their_buckets_once(spark, monkeypatch):
    """Learning and scoring at once gives what one after the other gives, and sends every key of a batch once."""
    monkeypatch.setattr(lm, "PAIRS", 400)  # several buckets
    rng = random.Random(15)
    rows = [(i, words(rng, rng.randint(0, 30)) + f" own{i % 50}") for i in range(200)] + [(300, None), (None, "alpha beta"), (301, ""), (3, "again"), (3, "again")]
    table, train = docs(spark, rows).repartition(3), F.col("doc_id") % 3 != 0
    columns = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]

    def plain(df):
        return Counter(tuple(round(v, 3) if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect())

    model = lm.learn(table, train)
    assert model["buckets"] > 1
    assert plain(lm.learn_and_score(table, train)) == plain(lm.score(table, model))
    batched = lm.batches_of(table.withColumn("learned", F.coalesce(train, F.lit(False))), "learned")
    want = Counter()
    for batch, texts in batched.groupBy("batch").agg(F.collect_list(F.coalesce("text", F.lit("")))).collect():
        pairs = {p for t in texts for p in zip([b"\n", *lm.words_of(t)], lm.words_of(t))}
        alone = {w for t in texts for w in lm.words_of(t)} - set(model["codes"]["words"])
        want[batch] += len(pairs) + len(alone)
    sent = Counter()
    for r in lm.pair_rows(batched, model).collect():
        sent[r["batch"]] += len(r["keys"]) // 8
    assert sent == want
