"""Toxicity by Levenshtein automata over a lexicon trie, with context windows that tell quotation from abuse."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import crc_mod, cut, table, with_results

#: Bounds of what is learned from: toxic and other rows.
TOXIC_ROWS, CLEAN_ROWS = 4000, 8000
#: Words on either side of a term that its context score looks at.
CONTEXT = 8
#: States of the automaton that a worker keeps before it begins anew.
STATES = 200_000
TOKEN = re.compile(r'[^\W_]+|["“”«»„]')
#: Scripts that are written without spaces: their terms may begin at any letter of a run.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
#: Letters of the longest beginning of a word that is learned besides the whole word, and of one in unspaced scripts.
LONGEST, LONGEST_UNSPACED = 12, 6
MARKS = set('"“”«»„')
# Words that report speech, and words that address somebody, in the languages at hand.
REPORTED = frozenset("said says wrote quoted called quote dit écrit cite sagte schrieb zitat dijo escribió cita".split())
ADDRESS = frozenset("you your youre du dich dein ihr tu toi te vous votre usted ustedes tú".split())


def tokens_of(text: str | None) -> list[str]:
    """Words and quotation marks of a whole text, lower-cased. A run of an unspaced script gives what follows each letter."""
    found = TOKEN.findall((text or "").lower())
    if not UNSPACED.search(text or ""):
        return found
    out = []
    for w in found:
        out += [w[i : i + LONGEST] for i in range(len(w))] if UNSPACED.search(w) else [w]
    return out


def beginnings(w: str) -> set[str]:
    """What may be learned of a word: its beginnings, and itself."""
    if UNSPACED.match(w):
        return {w[:k] for k in range(1, min(LONGEST_UNSPACED, len(w)) + 1)}
    return {w, *(w[:k] for k in range(3, min(LONGEST, len(w)) + 1))}


class Automaton:
    """All words that begin, up to one edit, with a term: the trie of the terms and the Levenshtein automaton walked
    together. Its states are sets of (trie node, edits), made when a word first needs them. Terms of fewer than five
    letters allow no edit; those of fewer than three are whole words, but in unspaced scripts."""

    def __init__(self, terms: list[str]) -> None:
        self.child: list[dict[str, int]] = [{}]
        self.term, self.edits = [-1], [0]
        for k, t in enumerate(terms):
            node = 0
            for c in t:
                node = self.child[node].setdefault(c, len(self.child))
                if node == len(self.term):
                    self.child.append({})
                    self.term.append(-1)
                    self.edits.append(0)
                self.edits[node] = max(self.edits[node], int(len(t) >= 5))
            self.term[node] = k
        self.lengths = [len(t) for t in terms]
        self.whole = [len(t) < 3 and not UNSPACED.match(t) for t in terms]
        self.number: dict[frozenset, int] = {frozenset(): 0}
        self.sets, self.hits, self.step = [frozenset()], [None], [{}]
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set) -> int:
        todo = list(pairs)
        while todo:  # letters of the term that the word lacks
            node, e = todo.pop()
            for n in self.child[node].values() if e == 0 else ():
                if self.edits[n] and (n, 1) not in pairs:
                    pairs.add((n, 1))
                    todo.append((n, 1))
        pairs = frozenset(p for p in pairs if (p[0], 0) not in pairs or p[1] == 0)
        if pairs not in self.number:
            self.number[pairs] = len(self.sets)
            self.sets.append(pairs)
            self.step.append({})
            found = [(e, k) for n, e in pairs if (k := self.term[n]) >= 0 and e <= int(self.lengths[k] >= 5)]
            self.hits.append(min(found) if found else None)
        return self.number[pairs]

    def _next(self, state: int, c: str) -> int:
        out = set()
        for node, e in self.sets[state]:
            if c in self.child[node]:
                out.add((self.child[node][c], e))
            if e == 0:
                out.update((n, 1) for n in self.child[node].values() if self.edits[n])
                if node == 0 or self.edits[node]:
                    out.add((node, 1))
        return self._state(out) if out else 0

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term) of the nearest term that the word begins with, the first of several."""
        state, best = self.start, None
        for at, c in enumerate(word, 1):
            step = self.step[state]
            if c not in step:
                step[c] = self._next(state, c)
            state = step[c]
            if state == 0:
                break
            if (hit := self.hits[state]) is not None and (best is None or hit < best) and (at == len(word) or not self.whole[hit[1]]):
                best = hit
        return best


@dataclass
class Model:
    terms: list[str]
    worth: list[float]
    vague: list[float]
    weights: np.ndarray = field(default_factory=lambda: np.array([0.0, 0.0, 0.0, 0.0, -np.inf]))
    _known: dict = field(default_factory=dict)
    _automaton: Automaton | None = None

    def __getstate__(self) -> dict:
        return {"terms": self.terms, "worth": self.worth, "vague": self.vague, "weights": self.weights, "_known": {}, "_automaton": None}

    def hits(self, text: str | None) -> tuple[list[str], list[tuple[int, tuple[int, int]]]]:
        """The tokens of a whole text, and of those that are near a term: place, edits and term."""
        tokens, known = tokens_of(text), self._known
        if len(known) > 400_000 or self._automaton is not None and len(self._automaton.sets) > STATES:
            known.clear()
            self._automaton = None
        if self._automaton is None:
            self._automaton = Automaton(self.terms)
        for w in set(tokens).difference(known):
            known[w] = self._automaton.match(w)
        return tokens, [(i, known[w]) for i, w in enumerate(tokens) if known[w] is not None]

    def features(self, text: str | None) -> list[float]:
        """Of a whole text: worth of the terms met, of quoted ones, of the worst in its context, density, 1."""
        tokens, hits = self.hits(text)
        hits = [(i, w) for i, (edits, term) in hits if (w := (self.vague if edits else self.worth)[term]) > 0]
        abuse = quoted = most = 0.0
        marks = [i for i, w in enumerate(tokens) if w in MARKS] if hits else []
        open_marks, at = 0, 0
        for n, (i, worth) in enumerate(hits):
            while at < len(marks) and marks[at] < i:
                open_marks, at = open_marks + 1, at + 1
            near = tokens[max(0, i - CONTEXT) : i + CONTEXT + 1]
            if open_marks % 2 or not REPORTED.isdisjoint(near):
                quoted += worth
                continue
            beside = (n > 0 and i - hits[n - 1][0] <= CONTEXT) + (n + 1 < len(hits) and hits[n + 1][0] - i <= CONTEXT)
            worth *= 1 + 0.25 * beside + 0.5 * (not ADDRESS.isdisjoint(near))
            abuse += worth
            most = max(most, worth)
        return [np.log1p(abuse), np.log1p(quoted), most, np.log1p(100 * abuse / max(20, len(tokens))), 1.0]

    def score(self, texts: list[str | None]) -> np.ndarray:
        """0 to 1, higher if the text is likelier toxic; 0 for all texts if nothing was learned."""
        if self.weights[4] == -np.inf:
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(np.array([self.features(t) for t in texts]).reshape(-1, 5) @ self.weights, -30, 30)))


def lexicon(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> Model:
    """Terms from (beginning of a word, toxic rows, other rows with it): those far likelier in toxic rows, likeliest first.
    A beginning gives way to one letter more if that keeps its rows; a longer one is a term besides a shorter one only if
    it tells clearly more."""
    rated = {term: (t, float(np.log(t / max(1, toxic) * max(1, clean) / (c + 0.5)))) for term, t, c in counts}
    grown = {term[:-1] for term, (t, _) in rated.items() if t >= 0.97 * rated.get(term[:-1], (np.inf, 0))[0]}
    chosen: dict[str, float] = {}
    for term in sorted(rated.keys() - grown, key=lambda x: (len(x), x)):
        odds = min(rated[term][1], 6.0)
        if odds > 2.5 + max([0.0, *(chosen[term[:k]] - 1.8 for k in range(1, len(term)) if term[:k] in chosen)]):
            chosen[term] = odds
    best = sorted(chosen, key=lambda x: (-chosen[x], x))
    return Model(best, [chosen[x] for x in best], [chosen[x] / 2 for x in best])


def regress(x: np.ndarray, y: np.ndarray, share: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps; share: the weight of each row."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (share * (p - y)) + ridge * w
        h = (x * (share * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        w -= (step := np.linalg.solve(h, g))
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", toxic: str = "toxic", toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Model:
    """Learns terms and weights from a sample of the labelled rows, bounded by toxic_rows and clean_rows and chosen by a
    hash of key and text. Null keys and labels are passed over; a key with several labels counts as its highest one; rows
    that agree in key and text count once. All terms of the sample that tell the two kinds apart are learned."""
    own = labels.where(F.col(key).isNotNull() & F.col(toxic).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max(toxic).cast("int").alias("y"))
    own = cut(own, "labels")
    n = {r["y"]: r["count"] for r in own.where("y in (0, 1)").groupBy("y").count().collect()}
    most = {1: toxic_rows, 0: clean_rows}
    share = {y: min(1.0, most[y] / max(1, n.get(y, 0))) for y in most}
    place = F.pmod(F.xxhash64(F.lit("toxicity"), F.col("_key")), F.lit(1 << 40))
    picked = own.where(((F.col("y") == 1) & (place < int(share[1] * (1 << 40)))) | ((F.col("y") == 0) & (place < int(share[0] * (1 << 40)))))
    # at most toxic_rows + clean_rows rows but for chance, so it may be broadcast
    joined = docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(F.broadcast(picked), "_key").select("y", F.xxhash64("_key", "text").alias("h"), "text")
    # a key may have any number of texts; the first bound, a constant, is kept by each task before the exchange
    placed = joined.dropDuplicates(["y", "h"]).withColumn("k", F.row_number().over(W.partitionBy("y").orderBy("h"))).where(F.col("k") <= max(toxic_rows, clean_rows))
    sample = cut(placed.where(F.col("k") <= F.when(F.col("y") == 1, toxic_rows).otherwise(clean_rows)).select("y", "text"), "sample")

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                by[y].update(set().union(*map(beginnings, set(tokens_of(t)) - MARKS)))
            terms = list(by[1])  # what no toxic row has is of no use
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([by[1][t] for t in terms], pa.int64()), pa.array([by[0][t] for t in terms], pa.int64())], ["term", "t", "c"])
            rest = [t for t in by[0] if t not in by[1]]
            yield pa.RecordBatch.from_arrays([pa.array(rest, pa.string()), pa.array([0] * len(rest), pa.int64()), pa.array([by[0][t] for t in rest], pa.int64())], ["term", "t", "c"])

    rows = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    sums = sample.mapInArrow(begin, "term string, t long, c long").groupBy("term").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    # so many toxic rows that chance gives none of ten million terms all of them
    least = max(3, int(np.ceil(np.log(1e7) / np.log(1 + (rows.get(0, 0) + 1) / max(1, rows.get(1, 0))))))
    odds = F.col("t") / max(1, rows.get(1, 0)) > 5 * F.col("c") / max(1, rows.get(0, 0))
    counts = sums.where((F.col("t") >= least) & odds).collect()
    model = lexicon([tuple(r) for r in counts], rows.get(1, 0), rows.get(0, 0))
    if not rows:
        return model
    held = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near, between = [], []
            for t in b.column(1).to_pylist():
                tokens, hits = held.value.hits(t)
                near.append(sorted({term for _, (edits, term) in hits if edits}))
                beside = lambda i, tokens=tokens: zlib.crc32(" ".join([*tokens[max(0, i - 1) : i], "", *tokens[i + 1 : i + 2]]).encode())
                between.append([{"k": term, "c": beside(i)} for i, (edits, term) in hits if not edits])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(near, pa.list_(pa.int64())), pa.array(between, pa.list_(pa.struct({"k": pa.int64(), "c": pa.int64()})))], ["y", "terms", "places"])

    measured = cut(sample.mapInArrow(measure, "y int, terms array<long>, places array<struct<k: long, c: long>>"), "measured")
    # a term that stands between the same words again and again is a piece of a copied passage; if all do, they are all there is
    places = measured.where("y = 1").select(F.explode("places").alias("p")).groupBy("p.k").agg(F.count("*").alias("n"), F.count_distinct("p.c").alias("c"))
    own = [r["k"] for r in places.where(2 * F.col("c") >= F.col("n")).select("k").orderBy("k").collect()] or list(range(len(model.terms)))
    # what a misspelled term tells: as much as half the odds of the term itself, moved by how often rows of both kinds have one
    near = {(r["y"], r["k"]): r["count"] for r in measured.select("y", F.explode("terms").alias("k")).groupBy("y", "k").count().collect()}
    ratio = rows.get(0, 0) / max(1, rows.get(1, 0))
    for k, w in enumerate(model.worth):
        model.vague[k] = float(np.log((near.get((1, k), 0) * ratio + 2 * np.exp(w / 2)) / (near.get((0, k), 0) + 2)))
    model = Model([model.terms[k] for k in own], [model.worth[k] for k in own], [model.vague[k] for k in own])
    held = docs.sparkSession.sparkContext.broadcast(model)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([held.value.features(t) for t in b.column(1).to_pylist()], pa.list_(pa.float64()))], ["y", "x"])

    seen = sorted((r["y"], r["x"]) for r in sample.mapInArrow(weigh, "y int, x array<double>").toArrow().to_pylist())
    y = np.array([s[0] for s in seen], float)
    model.weights = regress(np.array([s[1] for s in seen]), y, np.where(y == 1, 1 / share[1], 1 / share[0]))
    return model


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of docs (all, if None) with score (0 to 1) and predicted (score >= 0.5) for each whole text.

    Null and empty texts meet no term and get the score of such texts; equal texts, and so repeated rows, get equal
    scores; texts of any length are read whole. An added column replaces one of docs with its name. No row moves. With
    nothing learned, all scores are 0, so no text is called toxic.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.drop("predicted")
    scored = with_results(rows, text, keep, "score double", lambda texts: [pa.array(held.value.score(texts.to_pylist()), pa.float64())])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op3_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    model = fit(docs.select("doc_id", "text"), labels.where(~held_out))
    return score(docs, model, keep=["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", "predicted")
