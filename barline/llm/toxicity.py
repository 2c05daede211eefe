"""Toxicity: Levenshtein automata of learned terms, intersected with their trie, and the context of what they find.

The lexicon is learned: words that are far more frequent in toxic than in other learned texts.  Its terms form a trie; a
word runs through the trie and the Levenshtein automata of all terms at once, as sets of (trie node, edits so far), and
is found if it is within ``EDITS`` of a term of ``LONG`` letters or more, or equal to a shorter one.  The sets are states of
one automaton, built as words need them; most words die after a few letters.  Words that occur in learned clean texts
and differ from every term are words of their own and no misspellings.

A finding counts by its term's weight.  Its window of ``WINDOW`` words tells quotation (quotation marks around it, or
words of reporting) from abuse; findings are summed, misspelled and quoted ones counting less and once more apart.  A
logistic regression, drawn to plausible weights, turns these sums and how dense they are into the score.

About ``SAMPLE`` labelled texts, chosen by a hash of doc_id, teach: two thirds the lexicon, the others the regression,
so that the regression sees the lexicon on texts that did not make it.  Equal texts teach once.  Labels of one document
count as the worst; null labels teach nothing.  Null and empty texts have no findings.  Without any label the score is low for
all.  Texts are scored whole, row by row, from the text alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.llm.common import added, grown, hash_sample, pieces

SAMPLE = 30_000  # labelled texts that teach
TERMS = 20_000  # size of the lexicon, by evidence
EDITS = 1
LONG = 4  # letters of a term from which misspellings count
WINDOW = 8  # words on either side
REPORTING = frozenset("said says quote quoted quotes called calls word words term wrote writes meaning means slur sagte genannt dit appelé dijo llamado".split())
_QUOTES = "\"“”„«»‘’'`"
_EDGE = regex.compile(r"^[^\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}]+$")
_FEATURES = 4
BENT, QUOTED = 0.8, 0.25  # what a misspelled and a quoted finding count beside a direct one
_PRIOR = np.array([-3.5, 2.0, 0.0, 0.0, 0.5])  # intercept, all findings, misspelled ones, quoted ones, density
_DRAW = 0.5  # how strongly the regression is drawn to it
_STATES = 200_000  # transitions that a task remembers


def words_of(text: str | None) -> list[str]:
    """Words in lower case without punctuation at their edges; what is only punctuation becomes empty."""
    return [_EDGE.sub("", w) if not w.isalnum() else w for w in (text or "").lower().split()]


class Matcher:
    """The trie of the terms and the automaton over it."""

    def __init__(self, terms: dict[str, float], clean=frozenset()):
        self.weights, self.clean = terms, clean
        self.child: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.allowed = [0]  # edits that some term below admits
        for term in sorted(terms):
            edits, node = EDITS if len(term) >= LONG else 0, 0
            self.allowed[0] = max(self.allowed[0], edits)
            for letter in term:
                if letter not in self.child[node]:
                    self.child[node][letter] = len(self.child)
                    self.child.append({})
                    self.term.append(None)
                    self.allowed.append(0)
                node = self.child[node][letter]
                self.allowed[node] = max(self.allowed[node], edits)
            self.term[node] = term
        self.letters = {letter for c in self.child for letter in c}
        self.start = self._closed({0: 0})
        self.next: dict = {}
        self.found: dict = {}

    def _closed(self, state: dict[int, int]) -> tuple:
        """Adds what is reached by leaving out letters of terms."""
        todo = list(state.items())
        while todo:
            node, edits = todo.pop()
            for child in self.child[node].values():
                if edits < self.allowed[child] and edits + 1 < state.get(child, EDITS + 1):
                    state[child] = edits + 1
                    todo.append((child, edits + 1))
        return tuple(sorted(state.items()))

    def _step(self, state: tuple, letter: str) -> tuple:
        out: dict[int, int] = {}

        def put(node, edits):
            if edits <= self.allowed[node] and edits < out.get(node, EDITS + 1):
                out[node] = edits

        for node, edits in state:
            for own, child in self.child[node].items():
                put(child, edits + (own != letter))
            put(node, edits + 1)
        return self._closed(out)

    def find(self, word: str) -> tuple[str, int] | None:
        """The nearest term, its weight deciding between equally near ones, and the edits; None if there is none."""
        state, known, letters = self.start, self.next, self.letters
        for letter in word:
            key = (state, letter if letter in letters else "")
            after = known.get(key)
            if after is None:
                if len(known) > _STATES:
                    known.clear()
                after = known[key] = self._step(state, key[1])
            state = after
            if not state:
                return None
        best = None
        for node, edits in state:
            term = self.term[node]
            if term is not None and edits <= (EDITS if len(term) >= LONG else 0):
                rank = (edits, -self.weights[term], term)
                if best is None or rank < best:
                    best = rank
        if best is None or best[0] and word in self.clean:
            return None
        return best[2], best[0]

    def features(self, text: str | None) -> tuple[float, ...]:
        """Logarithms of summed weights: all findings, misspelled ones, quoted ones, and all per hundred words."""
        known, direct, bent, quoted = self.found, 0.0, 0.0, 0.0
        words = (text or "").lower().split()
        for i, chunk in enumerate(words):
            hit = known.get(chunk, 0)
            if hit == 0:
                if len(known) > _STATES:
                    known.clear()
                word = _EDGE.sub("", chunk)
                hit = known[chunk] = self.find(word) if word else None
            if hit is None:
                continue
            term, edits = hit
            weight = self.weights[term]
            if _reported(words, i):
                quoted += weight
            elif edits:
                bent += weight
            else:
                direct += weight
        whole = direct + BENT * bent + QUOTED * quoted
        return tuple(float(np.log1p(x)) for x in (whole, bent, quoted, 100 * whole / max(len(words), 1)))


def _reported(words: list[str], i: int) -> bool:
    """Whether the word stands in quotation marks or near words of reporting."""
    before, after = words[max(0, i - WINDOW):i], words[i + 1:i + 1 + WINDOW]
    if any(w.strip(".,;:!?") in REPORTING for w in before):
        return True
    opened = words[i][0] in _QUOTES or any(w[0] in _QUOTES for w in before[::-1])
    closed = words[i].rstrip(".,;:!?")[-1:] in tuple(_QUOTES) or any(w.rstrip(".,;:!?")[-1:] in tuple(_QUOTES) for w in after)
    return opened and closed


def _distinct(batches):
    for batch in pieces(batches):
        words, bad = [], []
        for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
            own = sorted({w for w in words_of(text) if w})
            words += own
            bad += [toxic] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(bad, pa.int64())], names=["word", "toxic"])


def teaching(docs: DataFrame, labels: DataFrame, train: Column, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic, part): the labelled texts that teach, about ``sample`` of them, once each; part 2 is for the regression.

    The labels that are chosen are a table of about that many rows, which goes to the documents; texts are not shuffled.
    """
    usable = labels.where(train & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").cast("long").alias("toxic"))
    chosen = hash_sample(usable, usable.count(), sample, "doc_id")
    found = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    once = found.groupBy("text").agg(F.max("toxic").alias("toxic"))
    return once.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(3)))


def lexicon(taught: DataFrame) -> tuple[dict[str, float], frozenset]:
    """Terms with their weights, and the words near terms that clean texts use."""
    made = taught.where("part <> 2")
    sums = made.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("bad")).first()
    n, bad = sums["n"], sums["bad"]
    counts = made.mapInArrow(_distinct, "word string, toxic long").groupBy("word").agg(F.count("*").alias("n"), F.sum("toxic").alias("bad"))
    cells = [F.col("bad") + 0.5, bad - F.col("bad") + 0.5, F.col("n") - F.col("bad") + 0.5, n - bad - (F.col("n") - F.col("bad")) + 0.5]
    odds = F.log(cells[0] / cells[1]) - F.log(cells[2] / cells[3])
    doubt = F.sqrt(sum((1 / c for c in cells[1:]), 1 / cells[0]))
    terms = counts.where(F.col("bad") >= max(3, 0.005 * bad)).withColumn("weight", odds - 1.64 * doubt).where("weight > 1.5")
    rows = terms.orderBy(F.desc("weight"), "word").limit(TERMS).select("word", "weight").collect()
    found = {r["word"]: float(r["weight"]) for r in rows}

    def near(batches):
        matcher = Matcher(found)
        for batch in batches:
            words = [w for w in batch["word"].to_pylist() if w not in found and matcher.find(w)]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string())], names=["word"])

    clean = counts.where("n - bad >= 2 AND bad * 4 <= n").select("word").mapInArrow(near, "word string").collect()
    return found, frozenset(r["word"] for r in clean)


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method, drawn to the prior weights."""
    x = np.column_stack([np.ones(len(x)), x])
    w = _PRIOR.copy()
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - _DRAW * (w - _PRIOR)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + _DRAW * np.eye(len(w)), gradient)
        w = w + np.clip(step, -2, 2)
    return w


def learn(docs: DataFrame, labels: DataFrame, train: Column) -> dict:
    """Lexicon, clean words near it, and weights of the regression."""
    taught = teaching(docs, labels, train)
    terms, clean = lexicon(taught)

    def run(batches):
        matcher = Matcher(terms, clean)
        for batch in pieces(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([list(matcher.features(t)) for t in batch["text"].to_pylist()], pa.list_(pa.float64())), batch["toxic"]], names=["x", "toxic"])

    rows = taught.where("part = 2").mapInArrow(run, "x array<double>, toxic long").collect()  # at most a part of the sample
    x = np.array([r["x"] for r in rows]).reshape(-1, _FEATURES)
    return {"terms": terms, "clean": clean, "weights": _fit(x, np.array([r["toxic"] for r in rows], float))}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """Adds ``score`` and ``findings`` (all, misspelled, quoted, density) to every row; columns of these names give way."""
    base, schema = added(docs, ("score", T.DoubleType()), ("findings", T.ArrayType(T.DoubleType())))

    def run(batches):
        matcher, w = Matcher(model["terms"], model["clean"]), model["weights"]
        for batch in pieces(batches):
            x = np.array([matcher.features(t) for t in batch["text"].to_pylist()]).reshape(-1, _FEATURES)
            p = 1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -30, 30)))
            yield grown(batch, [pa.array(p), pa.array(list(x), pa.list_(pa.float64()))], ["score", "findings"])

    return base.mapInArrow(run, schema)
