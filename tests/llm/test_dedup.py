"""Operators 6, 7 and 10 against plain versions."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from ledgerleaf.llm import near_sets as N, simhash as H
from ledgerleaf.llm.components import components
from ledgerleaf.llm.exact_dedup import exact_dedup
from ledgerleaf.llm.substring_dedup import repeated_words

from llm_common import ROWS, SCHEMA, awkward, empty


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# exact dedup


def plain_exact(rows):
    groups = {}
    for i, (k, t, *_) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), k is None, k or 0, i))
    out = []
    for x, members in groups.items():
        best = min(members)
        for n, null, k, _ in members:
            out.append((None if null else k, None if best[1] else best[2], len(members), hashlib.sha256(x.encode()).hexdigest()))
    return sorted(map(repr, out))


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_groups(spark, bits):
    got = exact_dedup(awkward(spark), hash_bits=bits).collect()
    assert sorted(repr((r["doc_id"], r["keep"], r["group_size"], r["text_sha256"])) for r in got) == plain_exact(ROWS)
    for sha in {r["text_sha256"] for r in got}:
        assert sum(r["kept"] for r in got if r["text_sha256"] == sha) == 1


def test_chunks_with_one_name_are_told_apart(spark):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("abcdefgh 1") for _ in range(3000)), None, None) for i in range(12)] * 2
    docs = spark.createDataFrame(rows, SCHEMA)
    assert {r["group_size"] for r in exact_dedup(docs, hash_bits=2).collect()} == {2}


def test_exact_empty(spark):
    assert exact_dedup(empty(spark)).count() == 0


# substring dedup


def plain_removed(rows, window):
    first, out = {}, []
    docs = sorted(((2**63 - 1 if k is None else k, words(t), i) for i, (k, t, *_) in enumerate(rows)), key=lambda x: x[0])
    for k, w, _ in docs:
        for p in range(len(w) - window + 1):
            x = tuple(w[p : p + window])
            first[x] = min(first.get(x, (k, p)), (k, p))
    for k, w, i in docs:
        gone = {q for p in range(len(w) - window + 1) if first[tuple(w[p : p + window])] < (k, p) for q in range(p, p + window)}
        kept = " ".join(x for q, x in enumerate(w) if q not in gone)
        out.append((rows[i][0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(map(repr, out))


def got_removed(df):
    return sorted(repr((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"])) for r in df.collect())


def test_removed_words(spark):
    assert got_removed(repeated_words(awkward(spark))) == plain_removed(ROWS, 20)


@pytest.mark.parametrize(("window", "seed"), [(20, 10), (20, 5), (8, 2)])
def test_removed_words_of_random_texts(spark, window, seed):
    rng = random.Random(window + seed)
    passages = [[rng.choice("abcdefghij") + str(rng.randint(0, 3)) for _ in range(40)] for _ in range(4)]
    rows = []
    for i in range(60):
        t = []
        for _ in range(rng.randint(0, 5)):
            t += rng.choice(passages)[rng.randint(0, 15) : rng.randint(20, 40)] + [rng.choice("xyz") for _ in range(rng.randint(0, 6))]
        rows.append((i // 2, " ".join(t), None, None))
    rows += [(99, "a " * 100, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got_removed(repeated_words(docs, window=window, seed_words=seed)) == plain_removed(rows, window)


def test_removed_words_in_many_blocks(spark, monkeypatch):
    from ledgerleaf.llm import substring_dedup as S

    monkeypatch.setattr(S, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(S, "CHUNK_BYTES", 300)
    assert got_removed(repeated_words(awkward(spark))) == plain_removed(ROWS, 20)


def test_wholly_equal_rows_are_judged_once(spark, monkeypatch):
    from ledgerleaf.llm import substring_dedup as S

    monkeypatch.setattr(S, "BLOCK_BYTES", 4000)
    text = " ".join(f"r{i}" for i in range(60))
    rows = [(None, text, None, None)] * 300 + [(7, text, None, None)] * 200 + [(3, "x " + text[:150], None, None)] + [(i, f"alone {i}", None, None) for i in range(50)]
    assert got_removed(repeated_words(spark.createDataFrame(rows, SCHEMA).repartition(4))) == plain_removed(rows, 20)


def thue_morse(n, a="a", b="b"):
    return "".join((a, b)[i.bit_count() & 1] for i in range(n))


def test_words_that_polynomials_confuse_are_told_apart(spark):
    from ledgerleaf.llm.near_sets import shingles
    from ledgerleaf.llm.words import word_hashes

    one, two = thue_morse(1024), thue_morse(1024, "b", "a")
    common = " ".join(f"w{i}" for i in range(19))
    rows = [(1, f"{common} {one}", None, None), (2, f"{common} {two}", None, None), (3, f"{one} {common}", None, None), (4, f"{one} {common}", None, None)]
    assert got_removed(repeated_words(spark.createDataFrame(rows, SCHEMA))) == plain_removed(rows, 20)
    a, b = shingles([f"{common} {one}".encode(), f"{common} {two}".encode()])
    assert len(np.intersect1d(a, b)) == 15
    for family in (0, 1):
        h, _ = word_hashes([f"{one} {two} ab ba aab aba baa {one[::-1]}x".encode()], family)
        assert len(set(h.tolist())) == 8
    assert not set(word_hashes([b"one two"], 0)[0].tolist()) & set(word_hashes([b"one two"], 1)[0].tolist())


def test_kept_text_and_empty(spark):
    row = repeated_words(spark.createDataFrame([(1, "a b  c", None, None)], SCHEMA), with_text=True).first()
    assert row["kept_text"] == "a b c"
    assert repeated_words(empty(spark)).count() == 0


# near dedup


def plain_fingerprint(text):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(w)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def check_near(spark, docs, rows):
    got = H.simhash_components(docs).collect()
    prints = [plain_fingerprint(t) for _, t, *_ in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    root = plain_components(range(len(rows)), links)
    least = {}
    for i, (k, *_) in enumerate(rows):
        if k is not None:
            least[root[i]] = min(least.get(root[i], k), k)
    want = sorted(repr((k, prints[i], least.get(root[i]))) for i, (k, *_) in enumerate(rows))
    assert sorted(repr((r["doc_id"], r["fp"] % (1 << 64), r["component"])) for r in got) == want


def test_near_copies(spark):
    check_near(spark, awkward(spark), ROWS)


def test_near_copies_of_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check_near(spark, docs, [tuple(r) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize(("leaf", "large"), [(16, 1 << 16), (4096, 1 << 16), (64, 100)])
def test_trees_lose_no_link(spark, monkeypatch, leaf, large):
    monkeypatch.setattr(H, "LEAF", leaf)
    monkeypatch.setattr(H, "LARGE", large)
    rng = np.random.default_rng(leaf)
    base = rng.integers(0, 2**64, 600, dtype=np.uint64)
    values = [base]
    for _ in range(4):
        flip = np.zeros(len(base), np.uint64)
        for _ in range(rng.integers(0, 5)):
            flip ^= np.uint64(1) << rng.integers(0, 64, len(base)).astype(np.uint64)
        values.append(base ^ flip)
    centre = np.uint64(12345)
    ball = np.array([centre ^ (np.uint64(1) << np.uint64(a)) ^ (np.uint64(1) << np.uint64(b)) for a in range(40) for b in range(a)], np.uint64)
    half = rng.integers(0, 2**32, 700, dtype=np.uint64) | np.uint64(77 << 32)
    half = np.concatenate((half, half ^ np.uint64(5), half << np.uint64(32) | np.uint64(9)))
    fp = np.unique(np.concatenate([*values, ball, half]))
    prints = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long").repartition(3)
    links = H.near_links(prints, len(fp)).collect()
    near = np.argwhere(np.triu(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3, 1))
    at = {int(x): i for i, x in enumerate(fp.view(np.int64))}
    assert plain_components(range(len(fp)), [(at[r["a"]], at[r["b"]]) for r in links]) == plain_components(range(len(fp)), near.tolist())
    assert len(links) < 40 * len(fp)


def test_a_large_leaf_of_equal_halves(monkeypatch):
    rng = np.random.default_rng(1)
    fp = np.unique(rng.integers(0, 1 << 32, 30_000, dtype=np.uint64) | np.uint64(77 << 32))
    got, want = H.Sets(len(fp)), H.Sets(len(fp))
    low = (1 << 32) - 1
    H.link(fp, np.arange(len(fp)), np.zeros(0, np.int64), low << 32, 1, low, 3, got, np.random.default_rng(3))
    for a in range(0, len(fp), 512):
        i, j = np.nonzero(np.bitwise_count(fp[a : a + 512, None] ^ fp[None, :]) <= 3)
        want.join(i + a, j)
    names = [np.unique(x.find(np.arange(len(fp))), return_inverse=True)[1] for x in (got, want)]
    assert np.array_equal(*names)


def test_simhash_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r["fingerprint"] for r in H.op7_simhash(spark, sf).collect()}
    assert got == {r["doc_id"]: f"{plain_fingerprint(r['text']):016x}" for r in rows}


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 200 + i) for i in range(300)] + [(7, 7), (500, 499), (499, 500)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {n: r for n, r in plain_components({x for e in links for x in e}, links).items()}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_one_of_each_group_stays(spark):
    kept = H.near_dedup(awkward(spark))
    rows = [(k, t) for k, t, *_ in ROWS]
    root, _ = plain_near_roots(rows)
    least = {}
    for i, (k, t) in enumerate(rows):
        least[root[i]] = min(least.get(root[i], (True, 0, "")), (k is None, k or 0, t or ""))
    assert sorted(repr((r["doc_id"], r["text"] or "")) for r in kept.collect()) == sorted(repr((None if n else k, t)) for n, k, t in least.values())
    assert kept.columns == awkward(spark).columns
    assert H.near_dedup(empty(spark)).count() == 0


def test_rows_are_kept_by_identity_not_by_key(spark):
    a, b, c, d, e, f = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcdef")
    rows = [(None, a), (5, a), (None, b), (None, b), (9, c), (10, c), (9, d), (11, d), (9, e), (2, e), (None, f), (9, f), (9, f)]
    docs = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    want = sorted(map(repr, [(5, a), (None, b), (9, c), (9, d), (2, e), (9, f)]))
    for n in (1, 3):
        assert sorted(repr((r["doc_id"], r["text"])) for r in H.near_dedup(docs.repartition(n)).collect()) == want


def plain_near_roots(rows):
    def shingles(t):
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    sets = [shingles(t) for _, t in rows]
    near = [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    return plain_components(range(len(rows)), near), near


def planted(seed):
    """Texts with near copies from far over to far below the bound, a chain, and a group around one text."""
    rng = random.Random(seed)
    out = []
    for n in (8, 40, 100, 300):
        for _ in range(6):
            base = [f"q{rng.randint(0, 5000)}" for _ in range(n)]
            out.append(base)
            for share in (0.002, 0.01, 0.02, 0.03, 0.05):
                out.append([w if rng.random() > share else "z" + str(rng.randint(0, 5000)) for w in base])
    chain = [f"c{i}" for i in range(200)]
    for i in range(12):
        out.append(chain := chain[8:] + [f"d{i}x{j}" for j in range(8)])
    hub = [f"h{i}" for i in range(200)]
    for i in range(40):
        at = rng.sample(range(0, 200, 8), 4)
        out.append([f"m{i}x{k}" if k in at else w for k, w in enumerate(hub)])
    out.append(hub)
    rng.shuffle(out)
    return [(i, " ".join(w)) for i, w in enumerate(out)]


@pytest.mark.parametrize(("block", "head"), [(384, 512), (3, 40)])
def test_near_copies_are_found_by_jaccard(spark, monkeypatch, block, head):
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "HEAD", head)
    rows = planted(3)
    root, near = plain_near_roots(rows)
    prints = [plain_fingerprint(t) for _, t in rows]
    assert sum((prints[i] ^ prints[j]).bit_count() > 3 for i, j in near) > 20
    docs = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA).repartition(3)
    assert sorted(r["doc_id"] for r in H.near_dedup(docs).collect()) == sorted(i for i in root if root[i] == i)


def test_near_copies_of_the_table_are_found_by_jaccard(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted(tuple(r) for r in docs.select("doc_id", "text").collect())
    root, _ = plain_near_roots(rows)
    assert sorted(r["doc_id"] for r in H.near_dedup(docs).collect()) == [rows[i][0] for i in root if root[i] == i]


def template_page(i, n_own):
    rng = random.Random(i)
    return " ".join([f"t{k}" for k in range(100)] + [f"u{rng.randrange(10**9)}" for _ in range(n_own)] + [f"t{k}" for k in range(100, 200)])


def test_pages_of_one_template_do_not_meet(spark, monkeypatch):
    """Sets below the bound that share most of what they have: the buckets by rarest shingles hold next to no pairs."""
    monkeypatch.setattr(N, "BLOCK", 20)
    rows = [(i, template_page(i, 34)) for i in range(300)] + [(1000 + i, template_page(i, 34).replace("t7 ", "x7 ")) for i in range(0, 300, 60)]
    sids = [N.shingles([t.encode()])[0] for _, t in rows]
    contents = spark.createDataFrame([(i, x.view(np.int64).tolist()) for i, x in enumerate(sids)], "sid long, s array<long>")
    found = N.prefix_members(contents.selectExpr("sid", "sid AS root"), contents).collect()
    by = {}
    for r in found:
        by.setdefault(r["g"], []).append((r["sid"], r["index"]))
    pairs = {tuple(sorted((a, b))) for x in by.values() for a, i in x for b, j in x if a < b and (i or j)}
    like = lambda a, b: 5 * len(np.intersect1d(sids[a], sids[b])) >= 4 * len(np.union1d(sids[a], sids[b]))
    assert {(60 * k, 300 + k) for k in range(5)} <= pairs and len(pairs) < 1000
    assert all(like(60 * k, 300 + k) for k in range(5)) and not like(0, 1)
    docs = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA).repartition(3)
    assert sorted(r["doc_id"] for r in H.near_dedup(docs).collect()) == list(range(300))


def test_rarest_shingles_miss_no_pair(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 4)
    rng = random.Random(9)
    pool = [rng.randrange(1 << 62) for _ in range(60)]
    sids = []
    for _ in range(40):
        base = rng.sample(pool, rng.randint(1, 40))
        sids += [set(base), set(base[rng.randint(0, 5) :]) | set(rng.sample(pool, rng.randint(0, 3))) or {1}]
    contents = spark.createDataFrame([(i, sorted(x)) for i, x in enumerate(sids)], "sid long, s array<long>")
    by = {}
    for r in N.prefix_members(contents.selectExpr("sid", "sid AS root"), contents).collect():
        by.setdefault(r["g"], []).append((r["sid"], r["index"]))
    pairs = {tuple(sorted((a, b))) for x in by.values() for a, i in x for b, j in x if a < b and (i or j)}
    near = {(i, j) for i in range(80) for j in range(i) if 5 * len(sids[i] & sids[j]) >= 4 * len(sids[i] | sids[j])}
    assert len(near) > 10 and {tuple(sorted(p)) for p in near} <= pairs


def test_both_sides_of_a_components_join_are_exchanged(spark):
    """So that Spark can split the links of a node that has very many: no aggregate is read as it is below the join's sort."""
    from pyspark.sql import functions as F

    from ledgerleaf.llm import components as C

    held, plans = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    whole = C.cut

    def cut(df, name):
        if name in ("large", "stars"):
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return whole(df, name)

    C.cut = cut
    try:
        links = spark.range(300).select(F.col("id").alias("a"), F.lit(1000).cast("long").alias("b"))
        assert {r["root"] for r in components(links, "a", "b").collect()} == {0}
    finally:
        C.cut = whole
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    for plan in plans:
        joined = plan[plan.index("Join Inner") :]
        assert "Aggregate" not in joined and joined.count("Relation") >= 2
