"""Operators 1 and 3: held-out accuracy, what may be learned from, and the automaton against edit distance."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from ledgerleaf.llm import language_id as L, toxicity as X
from ledgerleaf.llm.common import crc_mod

from llm_common import ROWS, awkward, empty

SF = "/root/testdata/sf0.1"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = L.op1_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 2000 and right > 0.99


def test_language_learns_from_text_and_labels_of_its_rows_alone(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    a = L.fit(docs.where(~held_out))
    b = L.fit(docs.withColumn("lang", F.when(~held_out, F.col("lang")).otherwise("zz")).where(~held_out))
    assert np.array_equal(a.vocabulary, b.vocabulary) and np.allclose(a.weights, b.weights)


def test_kernel_regression_is_multiplied_out_rightly():
    texts = ["the cat and the dog", "der hund und die katze", "the red house", "das rote haus", "a dog in the house", "ein hund im haus"] * 3
    labels = ["en", "de", "en", "de", "en", "de"] * 3
    grams = [L.grams(t + str(i)) for i, t in enumerate(texts)]
    kernel = np.array([[len(np.intersect1d(a, b)) / np.sqrt(len(a) * len(b)) for b in grams] for a in grams])
    model = L.train(labels, grams, landmarks=len(texts), ridge=0.5)
    y = np.array([[1.0 if x == lang else -1.0 for lang in model.languages] for x in labels])
    # with all texts as landmarks, Nyström features give kernel ridge regression itself
    want = kernel @ np.linalg.solve(kernel + 0.5 * len(texts) / 2 * np.eye(len(texts)), y)
    assert np.allclose(model.scores(grams)[0], want, atol=1e-3)
    few = L.train(labels, grams, landmarks=4).scores(grams)[0]
    # with fewer, the same regression on the kernel that these four rows span: K[:, S] K[S, S]^+ K[S, :], by eigenvectors
    chosen = [0, 1, 2, 3]
    values, vectors = np.linalg.eigh(kernel[np.ix_(chosen, chosen)])
    phi = kernel[:, chosen] @ vectors / np.sqrt(values)
    low = phi @ phi.T
    assert np.allclose(few, low @ np.linalg.solve(low + L.RIDGE * len(texts) / 2 * np.eye(len(texts)), y), atol=1e-3)
    assert (few.argmax(1) == [model.languages.index(x) for x in labels]).all()


def test_language_of_awkward_rows(spark):
    got = L.predict(awkward(spark), L.fit(awkward(spark)))
    assert got.columns == [c for c in awkward(spark).columns if c not in ("score", "known")] + ["lang_pred", "score", "known"] and got.count() == len(ROWS)
    by = {r["doc_id"]: r for r in got.where("doc_id is not null").collect()}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (3, 4, 5, 6)) and by[9]["lang_pred"] == "de"
    assert L.predict(empty(spark), L.fit(empty(spark))).count() == 0
    assert {r["lang_pred"] for r in L.predict(awkward(spark), L.fit(empty(spark))).collect()} == {"und"}
    assert sorted(r["doc_id"] for r in L.known_language(awkward(spark)).where("doc_id is not null").collect()) == [1, 2, 7, 8, 9, 10, 11, 11]


OTHERS = [
    "Il gatto dorme sul divano mentre il cane gioca nel giardino con i bambini della vicina e la nonna prepara la cena",
    "Zażółć gęślą jaźń, a potem kot śpi na kanapie, gdy pies bawi się w ogrodzie z dziećmi sąsiadki",
    "def main(argv): for x in range(10): print(x); import os, sys; return None if x else self.value",
    "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua",
    "sdkfjh qwpoeiru zxcvnm asldkj qpwoei zmxncb alskdj",
]


def test_language_stage_uses_the_classifier(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    other = spark.createDataFrame([(-1, "привет как дела сегодня у вас всё хорошо"), (-2, "漢字かな交じり文です"), (-3, "12 34"), (-4, None)] + [(-5 - i, t) for i, t in enumerate(OTHERS)], "doc_id long, text string")
    rows = docs.unionByName(other, allowMissingColumns=True)
    kept = L.known_language(rows).select("doc_id").collect()
    assert len(kept) == docs.count() and all(r["doc_id"] >= 0 for r in kept)
    # without labels, texts with letters stay
    bare = L.known_language(other.withColumn("lang", F.lit(None).cast("string")))
    assert sorted(r["doc_id"] for r in bare.collect()) == sorted([-2, -1] + [-5 - i for i in range(len(OTHERS))])


def test_language_of_one_repeated_text_is_learned(spark):
    """A language in which one row has very many copies: its other rows are in the sample like any other's."""
    copies = spark.range(200_000).selectExpr("1L AS doc_id", "'immer der gleiche satz' AS text", "'de' AS lang")
    others = [(i + 10, f"das haus nummer {i} und der garten von dem alten mann", "de") for i in range(40)]
    others += [(i + 100, f"the house number {i} and the garden of the old man", "en") for i in range(400)]
    model = L.fit(copies.union(spark.createDataFrame(others, "doc_id long, text string, lang string")))
    assert model.languages == ["de", "en"]
    assert model.predict(["der garten von dem mann", "the garden of the man"])[0] == ["de", "en"]


def test_language_sample_of_repeated_and_null_ids(spark):
    texts = [("en", f"the house number {i} and the garden of the old man") for i in range(300)] + [("de", f"das haus nummer {i} und der garten von dem alten mann") for i in range(300)]
    docs = spark.createDataFrame([(None if i % 2 else 5, t, lang) for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string")
    model = L.fit(docs, sample_rows=40)
    assert model.languages == ["de", "en"] and model.predict(["the garden", "der garten"])[0] == ["en", "de"]
    many = spark.createDataFrame([(i, f"word{i} text", f"l{i:03d}") for i in range(60)], "doc_id long, text string, lang string")
    assert len(L.fit(many, sample_rows=20).languages) == 20


def test_language_query(spark, sf):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = L.op1_language_id(spark, sf).collect()
    langs = {r["lang"] for r in docs.values()} - {None}
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        assert r["lang_pred"] in langs if any(map(str.isalpha, docs[r["doc_id"]]["text"] or "")) else r["lang_pred"] == "und"


def test_toxicity_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = X.op3_toxicity(spark, SF).join(labels, "doc_id").where("held_out").toPandas()
    yes, no = got[got.toxic == 1].score.to_numpy(), got[got.toxic == 0].score.to_numpy()
    auc = (yes[:, None] > no[None, :]).mean() + 0.5 * (yes[:, None] == no[None, :]).mean()
    assert auc > 0.93 and ((got.predicted == 1) & (got.toxic == 0)).mean() < 0.02


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_automaton_is_edit_distance_of_beginnings():
    rng = random.Random(4)
    terms = ["abcab", "bca", "cabbac", "abcabb"]
    machine = X.Automaton(terms)
    for _ in range(4000):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 9)))
        near = [(min(distance(t, word[:k]) for k in range(len(word) + 1)), i) for i, t in enumerate(terms)]
        ok = [(e, i) for e, i in near if e <= (1 if len(terms[i]) >= 5 else 0)]
        assert machine.match(word) == (min(ok) if ok else None), word


def plain_features(text, model):
    """The features by edit distance, word by word."""
    tokens, hits = X.tokens_of(text), []
    for i, w in enumerate(tokens):
        near = [(min(distance(t, w[:k]) for k in ([len(w)] if len(t) < 3 else range(len(w) + 1))), k) for k, t in enumerate(model.terms)]
        if ok := [(e, k) for e, k in near if e <= int(len(model.terms[k]) >= 5)]:
            e, k = min(ok)
            if (worth := (model.vague if e else model.worth)[k]) > 0:
                hits.append((i, worth))
    abuse = quoted = most = 0.0
    for i, worth in hits:
        near = tokens[max(0, i - 8) : i + 9]
        if sum(w in X.MARKS for w in tokens[:i]) % 2 or X.REPORTED & set(near):
            quoted += worth
            continue
        before, after = [i - j for j, _ in hits if j < i], [j - i for j, _ in hits if j > i]
        worth *= 1 + 0.25 * (bool(before) and min(before) <= 8) + 0.25 * (bool(after) and min(after) <= 8) + 0.5 * bool(X.ADDRESS & set(near))
        abuse, most = abuse + worth, max(most, worth)
    return [np.log1p(abuse), np.log1p(quoted), most, np.log1p(100 * abuse / max(20, len(tokens))), 1.0]


def test_features_and_score_against_a_plain_version():
    rng = random.Random(6)
    model = X.Model(["worthless", "scum", "xy", "idiot"], [5.0, 4.0, 3.0, 2.0], [2.5, 1.0, 1.0, -1.0], np.array([0.7, -0.4, 0.3, 0.2, -2.0]))
    pool = ["worthless", "worthles", "wortless", "worthlessly", "scum", "skum", "scummy", "xy", "xyz", "idiot", "idiiot", "you", "said", "“", "”", '"', "plain", "text", "and", "more"]
    texts = [" ".join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(150)] + [None, ""]
    for t in texts:
        want = plain_features(t, model)
        assert np.allclose(model.features(t), want)
        assert np.isclose(model.score([t])[0], 1 / (1 + np.exp(-np.dot(want, model.weights))))


def test_terms_of_any_number_length_and_script(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9))
    bad, plain = [word() for _ in range(500)] + ["verylongtoxicterm" + "abcdefgh", "qz", "毒語"], [word() for _ in range(500)]
    rows, labels = [], []
    for i in range(3000):
        y = i % 2
        own = rng.choices(plain, k=8) + ([bad[(i // 2 * 12 + k) % len(bad)] for k in range(12)] if y else [])
        rng.shuffle(own)
        rows.append((i, " ".join(own) if "毒語" not in own else " ".join(own).replace("毒語", rng.choice("天地玄黃宇宙洪荒") + "毒語" + rng.choice("日月盈昃辰宿列張"))))
        labels.append((i, y))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = X.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert len(model.terms) > 400
    scores = model.score([f"{rng.choice(plain)} {w}" for w in ("qz", "漢字毒語文", bad[3], bad[500])] + [" ".join(plain[:5]), "qzq"])
    assert (scores[:4] > 0.5).all() and (scores[4:] < 0.5).all()


def test_nothing_learned_calls_no_text_toxic(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = X.score(awkward(spark), X.fit(awkward(spark).select("doc_id", "text"), none)).collect()
    assert {(r["score"], r["predicted"]) for r in rows} == {(0.0, 0)}


def test_a_key_with_many_texts_does_not_widen_the_sample(spark):
    docs = spark.createDataFrame([(1, f"text {i} here") for i in range(500)] + [(2, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    assert isinstance(X.fit(docs, labels, toxic_rows=20, clean_rows=20), X.Model)


def test_the_automaton_of_a_worker_begins_anew_at_its_bound(monkeypatch):
    rng = random.Random(4)
    terms = ["".join(rng.choice("abcdef") for _ in range(7)) for _ in range(30)]
    texts = [" ".join("".join(rng.choice("abcdef") for _ in range(7)) for _ in range(50)) + " " + rng.choice(terms) for _ in range(20)]
    hits = [X.Model(terms, [1.0] * 30, [1.0] * 30).hits(t) for t in texts]
    monkeypatch.setattr(X, "STATES", 20)
    model = X.Model(terms, [1.0] * 30, [1.0] * 30)
    assert [model.hits(t) for t in texts] == hits and len(model._automaton.sets) < 3000


def test_misspelled_and_quoted():
    model = X.Model(["worthless", "scum"], [5.0, 5.0], [2.5, 2.5], np.array([2.0, 0.0, 0.0, 0.0, -3.0]))
    score = lambda t: float(model.score([t])[0])
    assert score("you are worthless") > 0.5 and score("you are worthles and wortless") > 0.5
    assert score("he said the word “worthless” once") < 0.5 and score("plain words") < 0.5 and score(None) == score("")


def test_toxicity_of_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (9, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    model = X.fit(awkward(spark).select("doc_id", "text"), labels)
    got = X.score(awkward(spark), model)
    assert got.count() == len(ROWS) and got.where("score < 0 or score > 1 or score is null").count() == 0
    assert X.score(empty(spark), X.fit(empty(spark).select("doc_id", "text"), labels.where("false"))).count() == 0


def test_names_that_differ_in_case_give_way(spark):
    from ledgerleaf.llm import decontamination as D

    docs = spark.createDataFrame([(1, "the cat", "en", 7)], "doc_id long, text string, lang string, Score int").withColumns({"LANG_PRED": F.lit(1), "N_Words": F.lit(2), "Predicted": F.lit(3)})
    model = L.fit(docs)
    assert L.predict(docs, model).columns == ["doc_id", "text", "lang", "N_Words", "Predicted", "lang_pred", "score", "known"] and L.known_language(docs).columns == docs.columns
    scored = X.score(docs, X.Model([], [], []))
    assert scored.columns == ["doc_id", "text", "lang", "LANG_PRED", "N_Words", "score", "predicted"] and scored.first()["score"] == 0
    found = D.find_items(docs, spark.createDataFrame([("1", "the cat")], "item_id string, text string"))
    assert "N_Words" not in found.columns and found.first()["n_words"] == 2
