"""Operators 2, 4, 5, 8 and 9 against plain versions, the SQL of all of them, and the pipeline."""

import gzip
import hashlib
import importlib
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerleaf.llm import decontamination as D, license_scan as N, mixing as M, queries, sharding as S, warc as W

from llm_common import LONG, ROWS, awkward, empty


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_gives_the_rows_of_its_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = queries.queries()[name](spark, sf)
    want = con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    assert plain([tuple(r) for r in got.collect()], got.columns) == plain(want.fetchall(), names)


# sharding


@pytest.mark.parametrize("size", [16 << 20, 1000])
def test_shards_are_even_and_whole(spark, size):
    got = S.shuffle_shards(awkward(spark), 5, bucket_bytes=size)
    rows = got.collect()
    counts = Counter(r["_shard"] for r in rows)
    assert max(counts.values()) - min(counts[k] for k in range(5)) <= 1
    for k in counts:
        assert sorted(r["_slot"] for r in rows if r["_shard"] == k) == list(range(counts[k]))
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter(r[:2] for r in ROWS)
    again = S.shuffle_shards(awkward(spark).repartition(3), 5, bucket_bytes=size).collect()
    assert sorted(map(repr, ((r["doc_id"], r["_shard"], r["_slot"]) for r in rows if r["doc_id"] != 11))) == sorted(map(repr, ((r["doc_id"], r["_shard"], r["_slot"]) for r in again if r["doc_id"] != 11)))
    assert got.columns == [*[c for c in awkward(spark).columns if c not in ("_shard", "_slot")], "_shard", "_slot"]


def test_equal_rows_are_spread_over_buckets(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(S, "prefix_sums", lambda counts, *a: seen.append(max(r["_n"] for r in counts.collect())) or prefix_sums(counts, *a))
    prefix_sums = importlib.import_module("ledgerleaf.llm.common").prefix_sums
    same = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    docs = same.union(spark.range(3000).select("id", F.lit("text").alias("text")))
    runs = [S.shuffle_shards(d, 5, bucket_bytes=3600).orderBy("_shard", "_slot").collect() for d in (docs, docs.repartition(7))]
    assert runs[0] == runs[1] and Counter(r["doc_id"] for r in runs[0]) == Counter([None] * 3000 + list(range(3000)))
    assert max(Counter(r["_shard"] for r in runs[0]).values()) == 1200 and max(seen) < 600


def test_shards_of_few_and_no_rows(spark):
    assert S.shuffle_shards(empty(spark), 24).count() == 0
    one = S.shuffle_shards(awkward(spark).limit(3), 24).collect()
    assert sorted(r["_shard"] for r in one) == [0, 1, 2] and {r["_slot"] for r in one} == {0}


def test_order_is_shuffled_and_written(spark, tmp_path):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    rows = S.shuffle_shards(docs, 4).orderBy("_shard", "_slot").collect()
    ids = [r["doc_id"] for r in rows]
    assert sorted(ids) == list(range(2000)) and sum(a < b for a, b in zip(ids, ids[1:], strict=False)) in range(900, 1100)
    S.write_shards(docs, str(tmp_path / "s"), n_shards=4)
    assert spark.read.parquet(str(tmp_path / "s")).groupBy("_shard").count().agg(F.min("count"), F.max("count")).first() == (500, 500)


def test_sharding_query(spark, sf):
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = S.op2_sharding(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(docs[r["doc_id"]]) + 8, zlib.crc32(docs[r["doc_id"]]), "rows", None)
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r["slot"] for r in rows if r["shard"] == k) == list(range(n)) for k, n in counts.items())


# mixing


def plain_targets(sizes, weights=(5, 2, 1), limit=3):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        total = sum(w[s] for s in open_)
        full = {s for s in open_ if left * w[s] / total > limit * sizes[s]}
        if not full:
            return out | {s: left * w[s] / total for s in open_}
        out |= {s: float(limit * sizes[s]) for s in full}
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


def test_targets_are_met(spark):
    got = M.mix_sources(awkward(spark)).select("_in.doc_id", "_in.source", "_size", "_source_size", "_target", "_taken", "_copies").collect()
    sizes = Counter()
    for _, t, _, s in ROWS:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = plain_targets(sizes)
    assert len(got) == len(ROWS)
    for r in got:
        assert r["_source_size"] == sizes[r["source"]] and abs(r["_target"] - want[r["source"]]) < 1e-6 * (1 + want[r["source"]]) and r["_taken"] <= 3 * r["_size"]
    assert M.mixed(awkward(spark)).count() == sum(r["_copies"] for r in got) and M.mixed(awkward(spark)).columns == awkward(spark).columns
    assert M.mix_sources(empty(spark)).count() == 0


def test_taken_words_come_near_the_targets(spark, sf):
    got = M.op5_mixing(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source"), "doc_id")
    for r in got.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.max("size").alias("m")).collect():
        assert abs(r["t"] - r["g"]) <= r["m"]


def plain_mix(rows):
    """Copies of each of the rows (key, text, source), by sorting."""
    sizes, place = Counter(), []
    for i, (k, t, s) in enumerate(rows):
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        sizes[s] += n
        h = hashlib.md5(f"mix:{'' if k is None else k}:{hashlib.md5((t or '').encode()).hexdigest()}".encode()).hexdigest()[:15]
        place.append((int(h, 16), i, n, s))
    want, copies = plain_targets(sizes), [0] * len(rows)
    for s, size in sizes.items():
        base = int(want[s] // size) if size else 0
        left = want[s] - base * size
        for _, i, n, of in sorted(place):
            if of == s:
                take = n <= left or (left > 0 and n - left < left)
                copies[i], left = base + take, (left - n if take else 0 if n else left)
    return copies


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_against_sorting(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, 5, i]), " ".join(["w"] * rng.randint(0, 30)) + str(rng.randint(0, 99)), rng.choice("aabbbcd")) for i in range(150)]
    rows += [(None, "the same " * 4, "d")] * 40
    got = M.mix_sources(spark.createDataFrame([(k, t, None, s) for k, t, s in rows], empty(spark).schema).repartition(3)).select("_in.*", "_copies").collect()
    want = Counter((k, t, s, n) for (k, t, s), n in zip(rows, plain_mix(rows), strict=True))
    assert Counter((r["doc_id"], r["text"], r["source"], r["_copies"]) for r in got) == want


def test_rows_without_ids_come_near_the_targets(spark):
    rows = [(None, " ".join(f"{s}{i}w{j}" for j in range(50)), s) for s in "abc" for i in range(40)] + [(None, "all alike here", "d")] * 1000
    got = M.mix_sources(spark.createDataFrame([(k, t, None, s) for k, t, s in rows], empty(spark).schema).repartition(4)).select("_in.source", "_taken", "_target", "_size").collect()
    for s in "abcd":
        own = [r for r in got if r["source"] == s]
        assert abs(sum(r["_taken"] for r in own) - own[0]["_target"]) <= own[0]["_size"]


def test_reruns_take_the_same_of_rows_that_agree_in_id_and_text(spark):
    """Rows at a threshold that differ only in other columns are chosen by what they hold, not by where they are read."""
    rows = [(7, "all alike here", str(i % 50), "d") for i in range(400)] + [(i, f"one {i} " * 9, None, s) for i, s in enumerate("abc" * 40)]
    docs = spark.createDataFrame(rows, empty(spark).schema)
    runs = [sorted(map(repr, M.mixed(docs.repartition(n, "text", "lang") if n % 2 else docs.repartition(n)).collect())) for n in (1, 3, 4)]
    assert runs[0] == runs[1] == runs[2]
    some = Counter(r["lang"] for r in M.mixed(docs).where("doc_id = 7").collect())
    assert 0 < sum(some.values()) and len(set(some.values())) > 1


# decontamination


def plain_hits(text, items, window=10):
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, found = fold(text), set(), set()
    for i, t in items:
        x = fold(t)
        n = min(window, len(x))
        for j in range(len(x) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p : p + n] == x[j : j + n]:
                    hit.update(range(p, p + n))
                    found.add(str(i)) if i is not None else None
    return len(w), len(hit), sorted(found)


ITEMS = [(1, "on the mat AND the dog-lay, on the rug near the old"), (2, "hund und"), (3, None), (4, "..."), (5, " ".join(LONG.split()[500:520])), (None, "x"), (12, "Hund und"), (7, "ünïcödé")]


@pytest.mark.parametrize(("size", "shard"), [(32 << 20, 8 << 20), (40, 50)])
def test_windows_are_found(spark, monkeypatch, size, shard):
    monkeypatch.setattr(D, "PASS_BYTES", size)
    monkeypatch.setattr(D, "SHARD_BYTES", shard)
    bench = spark.createDataFrame([*ITEMS, *ITEMS], "item_id long, text string")
    got = D.find_items(awkward(spark), bench, keep=["doc_id", "text", "score", "_row"]).collect()
    short = [(i, t if i != 5 else None) for i, t in ITEMS]
    assert len(got) == len(ROWS) and got[0]["score"] == 7 and got[0]["_row"] == 7
    for r in got:
        if r["text"] is None or len(r["text"]) < 1000:
            assert (r["n_words"], r["n_hit"], r["items"]) == plain_hits(r["text"], short), r
        else:
            assert r["items"] == ["5"] and r["n_hit"] == 20 * len({m["doc_word"] for m in r["matches"]}) and {m["n_words"] for m in r["matches"]} == {20}


def test_passes_give_equal_rows(spark, monkeypatch):
    items = [*ITEMS, (20, "sat on the mat and the dog lay on the rug near"), (21, "the mat and the dog lay on the rug near the old red")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(repr, D.find_items(awkward(spark), bench).collect()))
    monkeypatch.setattr(D, "PASS_BYTES", 60)
    assert sorted(map(repr, D.find_items(awkward(spark), bench).collect())) == one
    kept = [r for r in D.find_items(awkward(spark), bench).where("n_hit = 0").select("doc_id", "text").collect()]
    left = D.decontaminated(awkward(spark), bench)
    assert sorted(map(repr, left.select("doc_id", "text").collect())) == sorted(map(repr, kept)) and left.columns == awkward(spark).columns


def test_suffixes_are_sorted_on_past_their_first_words():
    for seed in range(200):
        rng = random.Random(seed)
        items = [(str(i), " ".join(rng.choice("abc") for _ in range(rng.choice([1, 2, 3, 5, 9, 10, 11, 14, 25])))) for i in range(rng.randint(0, 6))]
        q = D.Queries(items, 10)
        q.per = rng.randint(1, 4)
        texts = [" ".join(rng.choice("abcd" if seed % 2 else "ab") for _ in range(rng.choice([0, 1, 3, 12, 40, 80]))) for _ in range(5)]
        assert [r[:3] for r in D.search([t.encode() for t in texts], q)] == [list(plain_hits(t, items)) for t in texts]


def test_runs_are_verbatim_and_cover_what_is_hit():
    for seed in range(100):
        rng = random.Random(seed)
        items = [(str(i), " ".join(rng.choice("abc") for _ in range(rng.choice([2, 5, 10, 12, 30])))) for i in range(5)]
        texts = [" ".join(rng.choice("ab" if seed % 3 else "a") for _ in range(rng.choice([3, 12, 40, 80]))) for _ in range(4)]
        for text, (n_words, n_hit, found, matches, hits) in zip(texts, D.search([t.encode() for t in texts], D.Queries(items, 10)), strict=True):
            w, by = text.split(), {k: t.split() for k, t in items}
            for m in matches:
                x = by[m["item_id"]]
                assert w[m["doc_word"] : m["doc_word"] + m["n_words"]] == x[m["item_word"] : m["item_word"] + m["n_words"]] and len(x[m["item_word"] :]) >= m["n_words"]
            for k in found:
                own = plain_hits(text, [(k, dict(items)[k])])[1]
                assert len({q for m in matches if m["item_id"] == k for q in range(m["doc_word"], m["doc_word"] + m["n_words"])}) == own
            assert n_hit == sum(h["end"] - h["start"] for h in hits) and {m["item_id"] for m in matches} == set(found)


def test_repeated_words_take_time_and_memory_in_proportion():
    import tracemalloc

    q = D.Queries([("1", "la " * 2000), ("2", "la " * 50 + "lu")], 10)
    q.groups()
    tracemalloc.start()
    start = time.time()
    (row,) = D.search([b"la " * 20_000], q)
    took, peak = time.time() - start, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert row[:3] == [20_000, 20_000, ["1", "2"]] and max(m["n_words"] for m in row[3]) == 2000 and len(row[3]) < 1000
    assert took < 3 and peak < 100 << 20


def test_a_large_benchmark_is_small_in_memory():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(20_000)]
    q = D.Queries([(str(i), " ".join(rng.choices(words, k=200))) for i in range(2000)], 10)
    assert q.flat.nbytes < 2 << 20 and len(q.groups()) == 1
    start = time.time()
    D.search([b"some words here"] * 10, q)
    assert time.time() - start < 0.5


def test_clean_documents_stay(spark, sf):
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    kept = {r["doc_id"] for r in D.decontaminated(docs, bench).collect()}
    assert kept == {r["doc_id"] for r in docs.collect() if plain_hits(r["text"], items)[1] == 0} if docs.count() < 50 else 0 < len(kept) < docs.count()
    assert D.decontaminated(empty(spark), bench).count() == 0
    assert D.decontaminated(awkward(spark), bench.limit(0)).count() == len(ROWS)


# license scan


def test_bands_meet_templates():
    assert all(N.collision(n) > 0.9999 for n in range(1, 400))


def test_licenses_in_awkward_rows(spark):
    text = "Some code. LICENSED under the Apache License -- version 2.0! " + "more words here " * 50
    rows = spark.createDataFrame([(50, text, None, None), (51, text.replace("Apache", "Pache"), None, None)], empty(spark).schema)
    got = N.scan(awkward(spark).select("doc_id", "text", "lang", "source").unionByName(rows), N.notices(spark)).collect()
    assert [(r["doc_id"], r["license"], r["containment"]) for r in got] == [(50, "Apache-2.0", 1.0)]
    assert N.scan(empty(spark), N.notices(spark)).count() == 0
    assert N.scan(awkward(spark), N.notices(spark).limit(0)).count() == 0


def test_any_number_of_templates(spark, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(f"t{rng.randint(0, 10**6)}" for _ in range(rng.randint(5, 40))) for _ in range(1500)]
    templates = spark.createDataFrame([(f"L{i}", t) for i, t in enumerate(texts)], "license string, text string")
    rows = [(i, "before it " * 3 + texts[i] + " and after", None, None) for i in range(0, 1500, 100)]
    docs = spark.createDataFrame(rows, empty(spark).schema).unionByName(awkward(spark).select("doc_id", "text", "lang", "source"))
    for size in (2_000_000, 9000):
        monkeypatch.setattr(N, "PASS_SHINGLES", size)
        assert sorted((r["doc_id"], r["license"], r["containment"]) for r in N.scan(docs, templates).collect()) == sorted((i, f"L{i}", 1.0) for i, *_ in rows)


def test_containment_against_all_windows(spark):
    rng = random.Random(9)
    shingles = lambda t: [tuple(t[i : i + 5]) for i in range(len(t) - 4)]
    templates = [[f"x{rng.randint(0, 60)}" for _ in range(n)] for n in (6, 12, 30, 80)]
    rows = []
    for i in range(60):
        t = [w if rng.random() > rng.choice([0, 0, 0.02, 0.1]) else "y" for w in rng.choice(templates)]
        rows.append((i, " ".join([f"z{rng.randint(0, 99)}" for _ in range(rng.randint(0, 9))] + t + ["end"] * rng.randint(0, 9))))
    want = []
    for i, text in rows:
        s = shingles(text.split())
        for k, t in enumerate(templates):
            own = set(shingles(t))
            n, step = len(own), -(-len(own) // 4)
            shares = [len(own & set(s[a : a + n + step - 1])) / n for a in range(0, len(s), step)]
            if hits := [x for x in shares if x >= 0.8]:
                want.append((i, str(k), round(max(hits), 9), len(hits)))
    got = N.scan(spark.createDataFrame([(i, t, None, None) for i, t in rows], empty(spark).schema), spark.createDataFrame([(str(k), " ".join(t)) for k, t in enumerate(templates)], "license string, text string"))
    assert sorted((r["doc_id"], r["license"], round(r["containment"], 9), r["windows"]) for r in got.collect()) == sorted(want)


def test_full_license_texts(spark, tmp_path):
    """Templates of a thousand shingles and more: whole, with a tenth of the words changed, and with a third of them."""
    rng = random.Random(3)
    texts = {f"License-{n}": " ".join(rng.choice(["the", "of", "work", "you", "may"]) if rng.random() < 0.5 else f"w{rng.randint(0, 900)}" for _ in range(n)) for n in (1200, 3000, 5600)}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    rows = []
    for i, (name, text) in enumerate(texts.items()):
        w = text.split()
        for k, every in enumerate((0, 40, 9)):
            rows.append((10 * i + k, "before " * 700 + " ".join("zz" if every and j % every == 0 else x for j, x in enumerate(w)) + " after" * 900, None, None))
    templates = N.templates_of(spark, str(tmp_path))
    assert {(r["license"], r["text"]) for r in templates.collect()} == set(texts.items())
    got = {(r["doc_id"], r["license"]): r["containment"] for r in N.scan(spark.createDataFrame(rows, empty(spark).schema), templates).collect()}
    cut = lambda t: {tuple(x[i : i + 5]) for x in [re.findall(r"\w+", t.lower())] for i in range(len(x) - 4)}
    want = {}
    for k, t, *_ in rows:
        for name, text in texts.items():
            own = cut(text)
            if (share := len(own & cut(t)) / len(own)) >= 0.8:
                want[k, name] = share
    # a text that holds a template holds it in one stretch here, so the best window has as much as the whole document
    assert set(got) == set(want) == {(10 * i + k, name) for i, name in enumerate(texts) for k in (0, 1)}
    assert all(abs(got[x] - want[x]) < 0.01 for x in want)


# WARC


PAGES = [(1, "http://a/1", "<p>x\r\n\r\ny"), (2, "http://a/2", "<p>x\r\n\r\ny"), (3, None, None), (4, "u\r\nv", ""), (5, "u", "WARC/1.1\r\nContent-Length: 9\r\n\r\n" * 5), (6, "u", "ü" * 300_000), (6, "u", "ü" * 300_000), (None, "u", "<p>x\r\n\r\ny"), (None, "u", "alone")]


@pytest.mark.parametrize("size", [48 << 20, 500])
def test_archives_round_trip(spark, monkeypatch, size):
    monkeypatch.setattr(W, "ARCHIVE_BYTES", size)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("record", F.lit(1)).withColumn("sha", F.lit(2))
    got = W.round_trip(pages).collect()
    least = {}
    for k, _, h in PAGES:
        if k is not None:
            least[h or ""] = min(k, least.get(h or "", k))
    want = []
    for k, _, h in PAGES:
        x, first = (h or "").encode(), least.get(h or "")
        want.append((k, len(x), W.digest(x), "response" if k == first else "revisit", None if k == first else first))
    assert sorted(map(repr, (tuple(r)[:5] for r in got))) == sorted(map(repr, want))
    assert W.round_trip(pages.limit(0)).count() == 0


def test_a_record_without_an_index_entry_is_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"<p>{i}") for i in range(5)], "page_id long, url string, html string")
    W.write_monolithic(pages, raw := str(tmp_path / "raw"))
    W.normalise_archives(spark, raw, path := str(tmp_path / "out"))
    index = spark.read.schema(W.ENTRIES).parquet(f"{path}/index").collect()
    less = [(r["archive"], r["entries"][1:]) for r in index]
    spark.createDataFrame(less, W.ENTRIES).write.parquet(f"{tmp_path}/less/index")
    (tmp_path / "out" / "archives").rename(tmp_path / "less" / "archives")
    with pytest.raises(Exception, match="no index entry"):
        W.read_archives(spark, str(tmp_path / "less")).collect()


def test_one_member_per_record_and_offsets(tmp_path):
    raw = [W.record(i, "u", b"p" * i, None) + W.BREAK for i in range(50)]
    whole = W.normalise(gzip.compress(b"".join(raw[:20])) + gzip.compress(b"".join(raw[20:])))
    index = W.offsets(whole + W.END)
    assert [gzip.decompress(whole[e["offset"] : e["offset"] + e["length"]]) for e in index] == raw
    assert gzip.decompress(whole + W.END) == b"".join(raw) and [e["page_id"] for e in index] == list(range(50))


def test_written_archives_are_gzip(spark):
    from ledgerleaf.llm.common import new_dir

    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    W.write_monolithic(pages, raw := new_dir(spark, "t"))
    W.normalise_archives(spark, raw, path := new_dir(spark, "t"))
    for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/archives").collect():
        assert gzip.decompress(bytes(r["content"])).startswith(b"WARC/1.1") and bytes(r["content"]).endswith(W.END)


def test_archives_are_bounded_and_read_at_offsets(spark, monkeypatch):
    from ledgerleaf.llm.common import new_dir

    monkeypatch.setattr(W, "ARCHIVE_BYTES", 20_000)
    rng = random.Random(3)
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>{i} " + "".join(rng.choices("abcdef ", k=rng.randint(0, 3000)))) for i in range(300)], "page_id long, url string, html string")
    W.write_monolithic(pages, raw := new_dir(spark, "t"))
    sizes = [len(gzip.decompress(bytes(r["content"]))) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(raw).collect()]
    assert max(sizes) <= 20_000 and len(sizes) > 15
    W.normalise_archives(spark, raw, path := new_dir(spark, "t"))
    got = W.read_pages(spark, path, pages.where("page_id % 50 = 0")).collect()
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in got} == {k: v for k, v in html.items() if k % 50 == 0}
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in W.read_archives(spark, path).collect()} == html
    assert W.read_pages(spark, path, pages.limit(0)).count() == 0
    with pytest.raises(ValueError):
        W.read_pages(spark, path, pages, most=10)


def test_many_small_records_take_linear_time():
    raw = [W.record(i, "u", b"p" * (i % 50), None) + W.BREAK for i in range(32_000)]
    took = []
    for n in (8000, 32_000):
        start = time.process_time()
        whole = W.normalise(gzip.compress(b"".join(raw[:n])))
        took.append(time.process_time() - start)
    assert took[1] < 8 * took[0] and [r for _, _, r in W.members(whole)] == raw
    for step in (1, 7, 50):
        assert list(W.records(W.inflated(gzip.compress(b"".join(raw[:50])) + W.END, step))) == raw[:50]


# pipeline


def test_pipeline_against_plain_versions(spark, sf):
    from ledgerleaf.llm import language_id as L
    from ledgerleaf.llm.common import crc_mod
    from test_dedup import plain_near_roots

    pipeline = importlib.import_module("corpus_pipeline")
    table = spark.read.parquet(f"{sf}/documents.parquet")
    docs = {r["doc_id"]: (r["text"], r["source"]) for r in table.collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    model = L.fit(table.where(crc_mod(F.col("doc_id"), 4) != 2))
    known, kept = set(model.vocabulary.tolist()), {}
    for k, (t, s) in docs.items():
        g = set(L.grams(t).tolist())
        if g and len(g & known) / len(g) >= (model.sure if model.predict([t])[1][0] < 0.5 else model.least):
            kept[k] = (t, s)
    ids = sorted(kept)
    root, _ = plain_near_roots([(k, kept[k][0]) for k in ids])
    kept = {ids[i]: kept[ids[i]] for i in root if root[i] == i}
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    windows = {tuple(x[j : j + 10]) for _, t in items for x in [fold(t)] for j in range(len(x) - 9)} | {tuple(fold(t)) for _, t in items if 0 < len(fold(t)) < 10}
    lengths = {len(w) for w in windows}
    clean = lambda x: not any(tuple(x[p : p + n]) in windows for n in lengths for p in range(len(x) - n + 1))
    kept = {k: (t, s) for k, (t, s) in kept.items() if clean(fold(t))}
    ids = sorted(kept)
    copies = plain_mix([(k, *kept[k]) for k in ids])
    rows = pipeline.run(spark, sf).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter({k: n for k, n in zip(ids, copies, strict=True) if n})
    assert all(r["text"] == docs[r["doc_id"]][0] and r["source"] == docs[r["doc_id"]][1] for r in rows)
    counts = Counter(r["_shard"] for r in rows)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r["_slot"] for r in rows if r["_shard"] == k) == list(range(n)) for k, n in counts.items())


def _run_pipeline(spark, docs, sf, path):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{path}/benchmark.parquet")
    return importlib.import_module("corpus_pipeline").run(spark, str(path))


def test_pipeline_keeps_texts_without_ids(spark, sf, tmp_path):
    texts = [" ".join(f"{chr(97 + i)}{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(60)) for i in range(12)]
    docs = spark.createDataFrame([(None if i % 2 else 4, t, None, None) for i, t in enumerate(texts)], empty(spark).schema)
    got = _run_pipeline(spark, docs, sf, tmp_path / "a")
    assert {r["text"] for r in got.collect()} == set(texts)


def test_pipeline_of_awkward_and_empty_tables(spark, sf, tmp_path):
    runs = [_run_pipeline(spark, d, sf, tmp_path / n).collect() for n, d in (("a", awkward(spark)), ("b", awkward(spark).repartition(5)))]
    assert sorted(map(repr, runs[0])) == sorted(map(repr, runs[1]))
    assert {r["text"] for r in runs[0]} <= {t for _, t, *_ in ROWS if t} and len(runs[0]) > 4 and runs[0][0]["_kept"] == 7
    assert _run_pipeline(spark, empty(spark), sf, tmp_path / "c").count() == 0
