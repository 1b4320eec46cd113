"""Operators 2, 5, 8, 9 and 10 against SQL or brute force, their edge cases, and the pipeline."""

import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cadastra.llm import components, mixing, ngram_join, queries, resampling, shingles, url_filter, vafile

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _same(spark, key, tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    want = con.execute(queries.SQL[key]).fetchall()
    return sorted(map(repr, want))


def _norm(df, cols):
    return sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())


@pytest.mark.parametrize("key", sorted(queries.SQL))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    res = con.execute(queries.SQL[key])
    cols = [c[0] for c in res.description]
    assert _norm(queries.QUERIES[key](spark, SF), cols) == sorted(map(repr, res.fetchall()))


@pytest.mark.parametrize("key", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_gives_every_row(spark, key):
    table = "pages" if key.startswith("op1_") else "documents"
    ids = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(table[:-1].replace("ument", "") + "_id").collect()}
    got = queries.QUERIES[key](spark, SF)
    assert {r[0] for r in got.select(got.columns[0]).collect()} == ids


# ---- 8

def _family(rnd, n, base):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randint(0, 6)):
            w[rnd.randrange(len(w))] = str(rnd.random())
        out.append(" ".join(w))
    return out


def _brute_components(rows):
    sets = [frozenset(shingles.shingle_set(t).tolist()) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                up[top(i)] = top(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[top(i)] = min(low.get(top(i), d), d)
    return sorted((((d is None, d or 0), len(sets[i]), low.get(top(i)) if sets[i] else d)
                   for i, (d, _) in enumerate(rows)), key=repr)


def _join_rows():
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", "  ", "a b", "A B", "a b c", "x " * 4000]
    base = [rnd.choice(words) for _ in range(120)]
    texts += _family(rnd, 90, base) + [" ".join(base)] * 12
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [passage + " " + " ".join(rnd.choice(words) for _ in range(rnd.randint(3, 60))) for _ in range(60)]
    texts += [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 40))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rnd.shuffle(rows)
    return rows + [rows[5], (None, "a b"), (None, "only here now we are"), (3, "q r s t u v w")]


@pytest.mark.parametrize("small", [False, True])
def test_jaccard_join_against_brute_force(spark, small, monkeypatch):
    if small:  # every path with few rows: salted columns, clusters, many blocks
        monkeypatch.setattr(ngram_join, "PAIR_ROWS", 3)
        monkeypatch.setattr(ngram_join, "SALT_ROWS", 8)
        monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 10)
    rows = _join_rows()
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [((r[0] is None, r[0] or 0), r[1], r[2]) for r in ngram_join.near_duplicates(d).collect()]
    assert sorted(got, key=repr) == _brute_components(rows)


def test_rows_that_share_a_passage_only_are_not_multiplied(spark, monkeypatch):
    """In a crowded table of counts a shared passage stands out from nothing and is in the heads of its rows."""
    fetched = []
    real = ngram_join._texts

    def spy(src, wanted):
        out = real(src, wanted)
        fetched.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "_texts", spy)
    monkeypatch.setattr(ngram_join, "column_counts", lambda scanned: np.ones(1 << ngram_join.COUNT_BITS, np.uint8))
    rnd = random.Random(21)

    def texts(name, k):
        passage = " ".join(f"{name}{i}" for i in range(60))
        return [passage + " " + " ".join(f"w{rnd.randrange(10**6)}" for _ in range(90 + i % 7)) for i in range(k)]

    rows = list(enumerate(texts("p", 50) + texts("q", 10) + texts("r", 3)))  # a group, and columns that yield pairs
    near = [(1000 + i, t) for i, t in enumerate(_family(rnd, 20, [f"v{rnd.randrange(500)}" for _ in range(100)]))]
    for some, most in ((rows, 0), (rows + near, len(near))):
        d = spark.createDataFrame(some, "doc_id long, text string").repartition(3)
        got = [((r[0] is None, r[0] or 0), r[1], r[2]) for r in ngram_join.near_duplicates(d).collect()]
        assert sorted(got, key=repr) == _brute_components(some)
        assert fetched.pop() <= most


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_sketches_rule_out_no_similar_set(percent):
    rng = np.random.default_rng(percent)
    pool, sets = rng.integers(0, 2**63, 30_000).astype(np.uint64), []
    for n in (1, 2, 5, 40, 511, 512, 700, 5000):
        base = rng.choice(pool, n, replace=False)
        for gone in (0, 1, n // 20, n // 9, n // 5, n // 2):
            sets.append(np.unique(np.concatenate([base[gone:], rng.choice(pool, rng.integers(0, gone + 1), replace=False)])))
    sets = [s for s in sets if len(s)]
    sets.append(np.arange(1000, dtype=np.uint64) << np.uint64(20))  # all in one cell
    sets.append(sets[-1][:900])
    cells = [ngram_join.sketch(s) for s in sets]
    held = ngram_join.Sketches([len(s) for s in sets], [c.tobytes() for c in cells], percent)
    far = 0
    for s, c in zip(sets, cells):
        near = set(held.near(len(s), c, np.ones(len(sets), bool)).tolist())
        for j, other in enumerate(sets):
            both = len(np.intersect1d(s, other))
            similar = 100 * both >= percent * (len(s) + len(other) - both)
            assert j in near or not similar
            far += j not in near
    assert far > len(sets) ** 2 // 2
    wide = np.stack([ngram_join.sketch(sets[-3]), ngram_join.sketch(sets[-3][::-1].copy())])
    assert (ngram_join._folded(wide, 64)[0] == np.minimum(np.bincount((sets[-3] % np.uint64(64)).astype(int), minlength=64), 255)).all()


def test_jaccard_join_edges_and_one_of_each(spark):
    empty = spark.createDataFrame([], DOCS)
    assert ngram_join.near_duplicates(empty).count() == 0 and ngram_join.keep_one_of_each(empty).count() == 0
    t = "one two three four five six seven"
    d = spark.createDataFrame([(5, t, "en", "s", 1), (3, t, "en", None, 1), (3, t, "en", None, 1), (7, None, None, None, None),
                               (8, "", "", "", 0), (9, "other words in here now", "en", "s", 1)], DOCS)
    d = d.withColumn("_row", F.lit(1)).withColumn("sig", F.lit(2))
    kept = ngram_join.keep_one_of_each(d)
    assert kept.columns == d.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 7, 8, 9]


def test_connected_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)] + [(1, 1), (None, 2)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r[0]: r[1] for r in components.connected_components(df).collect()}
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    assert got == {x: top(x) for x in up}
    assert components.connected_components(df.limit(0)).count() == 0


# ---- 2

def test_mix_meets_targets_and_handles_odd_rows(spark):
    rnd = random.Random(4)
    rows = [(i, " ".join(["w"] * rnd.randint(0, 40)), "en", rnd.choice(["a", "b", "b", "b", "c", None]), 0) for i in range(800)]
    rows += [(900, None, None, None, None), (None, "x y", None, "a", 3), (1, "x", "en", "d", 1), (1, "x", "en", "d", 1), (2, "", "", "", 0)]
    d = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("x")).withColumn("target", F.lit(0))
    out = mixing.mix(d).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        assert 0 <= r["taken"] <= 3 * r["size"]
        s = by.setdefault(r["source"], [r["source_size"], r["target"], 0, 0])
        s[2] += r["taken"]
        s[3] = max(s[3], r["size"])
    total = sum(s[0] for s in by.values())
    assert math.isclose(sum(s[1] for s in by.values()), total, rel_tol=1e-9)
    for size, target, taken, longest in by.values():
        assert target <= 3 * size + 1e-9 and abs(taken - target) <= longest
    again = {(r["doc_id"], r["size"], r["taken"]) for r in mixing.mix(d.repartition(7)).collect()}
    assert again == {(r["doc_id"], r["size"], r["taken"]) for r in out}
    copies = mixing.apply(d)
    assert copies.columns == d.columns
    assert copies.select(F.sum(mixing.n_words(F.col("text")))).first()[0] == sum(r["taken"] for r in out)
    assert mixing.mix(d.limit(0)).count() == 0 and mixing.apply(d.limit(0)).count() == 0
    blank = d.where("text IS NULL OR text = ''")
    assert {r["taken"] for r in mixing.mix(blank).collect()} == {0}


def test_words_are_counted_without_lists_of_them(spark):
    texts = [None, "", " ", "a", " a", "a ", "\n\ta\x0b b\r\n", "a  b", "\x1c a\u00a0b", "\U0001f600 \U0001f600\U0001f600", "$1 x", "\x00 \x85 é",
             "word " * 5000, "x" * 100_000, " " * 100_000]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select("doc_id", mixing.n_words(F.col("text")).alias("n"))
    assert [r["n"] for r in d.orderBy("doc_id").collect()] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    assert "extract_all" not in d._jdf.queryExecution().optimizedPlan().toString()


def test_mix_prefers_good_documents(spark):
    rows = [(i, "good words only", "en", "a", 0) for i in range(300)] + [(i, "### %% 1 $$ !", "en", "a", 0) for i in range(300, 600)]
    rows += [(i, "w w w w w", "en", "b", 0) for i in range(600, 700)]
    took = {r["doc_id"]: r["taken"] / r["size"] for r in mixing.mix(spark.createDataFrame(rows, DOCS)).collect()}
    assert sum(took[i] for i in range(300)) > sum(took[i] for i in range(300, 600))


# ---- 5

def _brute_top(rows, k=5):
    ok = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in ok:
        if q % 50 == 0:
            best = sorted(((-int(v @ w), c) for c, w in ok if c != q))[:k]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("copies", [0, 40])
def test_top_k_is_exact(spark, copies, monkeypatch):
    monkeypatch.setattr(vafile, "BLOCK_ROWS", 64)
    monkeypatch.setattr(vafile, "QUERY_ROWS", 3)
    rnd = np.random.default_rng(6)
    rows = [(i, rnd.normal(size=16).astype(float).tolist()) for i in range(500)]
    rows += [(500 + i, rows[0][1]) for i in range(copies)]
    rows += [(600, None), (601, []), (602, [1.0] * 15 + [None]), (603, [float("nan")] * 16), (604, [float("inf")] + [0.0] * 15), (None, rows[1][1])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    got = sorted(tuple(r) for r in vafile.top_k(d, F.col("vec_id") % 50 == 0).collect())
    assert got == _brute_top(rows)


def test_top_k_of_few_rows(spark):
    d = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.5]), (50, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in vafile.top_k(d, F.col("vec_id") % 50 == 0).collect()) == _brute_top(
        [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (50, [1.0, 2.0])])
    assert vafile.top_k(d.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert vafile.top_k(d, F.lit(False)).count() == 0


@pytest.mark.parametrize("block", [8, 64, 2048])
def test_top_k_of_repeated_ids_matches_sql(spark, block, monkeypatch):
    monkeypatch.setattr(vafile, "BLOCK_ROWS", block)
    monkeypatch.setattr(vafile, "QUERY_ROWS", 3)
    rnd = np.random.default_rng(9)
    v = [rnd.normal(size=8).tolist() for _ in range(130)]
    rows = [(i, x) for i, x in enumerate(v)]
    best = [10 * x for x in v[0]]
    rows += [(0, best)] * 8 + [(203, best), (204, best)]  # a query's own copies before others of one vector
    rows += [(7, v[50])] * 4 + [(8, [2 * x for x in v[50]])] * 3  # a neighbour that stands several times
    rows += [(100, v[3]), (100, v[4]), (100, v[4])]  # a query id with several vectors
    rows += [(300 + i, best) for i in range(20)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = vafile.top_k(d, F.col("vec_id") % 50 == 0)
    assert _norm(got, ["query_id", "rank", "vec_id", "score"]) == _same(
        spark, "op5_vector_approximation", {"embeddings": d})


# ---- 9

def test_held_out_quality(spark):
    big = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    fitted = labels.where(F.pmod(F.xxhash64("doc_id", F.lit(99)), F.lit(2)) == 0)
    s = resampling.select(docs, fitted)
    held = s.scored.withColumn("selected", s.selected()).join(
        labels.join(fitted, "doc_id", "left_anti"), "doc_id").collect()
    good = [r["selected"] for r in held if r["quality"] == 1]
    bad = [r["selected"] for r in held if r["quality"] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1
    kept = {r[0] for r in resampling.resample(docs, fitted).select("doc_id").collect()}
    assert kept == {r["doc_id"] for r in s.scored.withColumn("selected", s.selected()).where("selected").collect()}


def test_offset_counts_every_held_out_row(spark):
    ids = [r[0] for r in spark.range(40).where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)) != 0).collect()]
    fitted = [r[0] for r in spark.range(40).where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)) == 0).collect()]
    good, bad, names = "plain good words in a row", "### BAD !!! $$ 99", "doc_id long, text string"
    rows = [(i, good) for i in fitted + ids[:1] * 400] + [(i, bad) for i in ids[1:5]]
    labels = spark.createDataFrame([(i, int(i not in ids[1:5])) for i in fitted + ids[:5]], "doc_id long, quality int")
    d = spark.createDataFrame(rows, names).coalesce(1)  # one held-out id fills the first 400 rows
    cap = len(fitted) + 5  # all labels; four times as many rows would hold good ones only
    once = spark.createDataFrame(sorted(set(rows)), names)
    w = resampling.fit(d, labels, max_labels=cap)
    assert w.offset != -0.25
    plain = resampling.Weights(w.log_ratio, 0.0, 0.0)
    held = once.where(F.col("doc_id").isin(ids[:5])).select("doc_id", plain.column(F.col("text")).alias("w")).select("doc_id", "w.*").collect()
    cost = [sum(resampling.FALSE_REJECT_COST * (resampling.PRIOR + r[1] - t * r[2] < 0) if r[0] == ids[0]
                else (resampling.PRIOR + r[1] - t * r[2] >= 0) / 4 for r in held) for t in resampling.OFFSETS]
    assert math.isclose(w.offset, np.median(resampling.OFFSETS[np.array(cost) <= min(cost) + 1e-12]))


def test_fitting_has_one_python_step_a_task(spark, monkeypatch):
    plans = []
    frame = type(spark.range(1))

    def seen(self, *a, do=frame.mapInArrow, **k):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return do(self, *a, **k)

    monkeypatch.setattr(frame, "mapInArrow", seen)
    docs = spark.createDataFrame([(i, "plain good words" if i % 2 else "## 99 !!") for i in range(20)], "doc_id long, text string")
    resampling.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int"))
    assert len(plans) == 2 and not any("EvalPython" in p for p in plans)


def test_resampling_edges(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 0, 0), (None, 1, 0), (3, None, 0), (77, 1, 1)], "doc_id long, quality int, toxic int")
    d = spark.createDataFrame([(1, "some good words", "en", "s", 1), (2, "!!! ### BAD", "en", "s", 1), (3, None, None, None, None), (4, "", "", "", 0),
                               (4, "", "", "", 0), (None, "x", "en", "s", 1)], DOCS).withColumn("sample_key", F.lit(1)).withColumn("w", F.lit(1))
    out = resampling.resample(d, labels)
    assert out.columns == d.columns and {r["doc_id"] for r in out.collect()} >= {3, 4, None}
    assert resampling.resample(d, labels.limit(0)).count() == 6
    assert resampling.resample(d.limit(0), labels).count() == 0


def test_kth_largest(spark):
    rnd = random.Random(8)
    values = [round(rnd.uniform(-1e5, 1e5), 3) for _ in range(3000)] + [5.0] * 50
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 7, 1500, 3050):
        assert abs(resampling.kth_largest(df, "x", k) - sorted(values, reverse=True)[k - 1]) < 1e-6
    assert resampling.kth_largest(df, "x", 0) is None


# ---- 10

def test_url_rules_and_list(spark):
    rows = [(1, "http://a.net/x"), (2, "https://EXAMPLE.net/en/1?x=1#f"), (3, "http://b.example.com/de/"), (4, "http://w.org/fr/2"), (5, None),
            (6, "no scheme"), (7, "http://bad.com/p/?utm_source=a&b=2"), (8, "https://www.bad.com/p?b=2#top"), (9, "http://bad.com/q"),
            (9, "http://bad.com/q"), (10, "http://example.network/"), (11, "://"), (12, "http://notexample.com/de/"), (13, "http://a.net?x=http://y"), (14, "")]
    d = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))
    listed = spark.createDataFrame([("https://bad.com/p?b=2",), (None,), ("",), ("https://bad.com/p?b=2",)], "url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(d, listed, queries.URL_RULES).collect()}
    assert got[1] == ("a.net", "/x", "net/", "block") and got[2] == ("example.net", "/en/1", "example.net/en/", "allow")
    assert got[3] == ("b.example.com", "/de/", "example.com/de/", "block") and got[4] == ("w.org", "/fr/2", "org/fr/", "allow")
    assert got[5] == got[6] == got[11] == got[14] == ("", "", None, "allow")
    assert got[7][3] == got[8][3] == "block" and got[9][3] == "allow" and got[12][2] is None
    assert got[10] == ("example.network", "/", None, "allow") and got[13] == ("a.net", "", None, "allow")
    assert url_filter.judge(d, listed, queries.URL_RULES).count() == len(rows)
    assert url_filter.judge(d, listed.limit(0), []).where("verdict = 'block'").count() == 0
    assert url_filter.judge(d.limit(0), listed, []).count() == 0


def test_bloom_filter_has_no_false_negatives_and_few_positives(spark):
    names = spark.range(2000).select(F.concat(F.lit("h.com/"), "id").alias("name"))
    bloom, blocks = url_filter.bloom_filter(names, "name", 2000)
    probe = spark.range(6000).select(F.concat(F.lit("h.com/"), "id").alias("canonical"), "id")
    p = probe.withColumn("block", url_filter._block(F.col("canonical"), blocks)).join(bloom, "block", "left")
    every = F.lit(True)
    for i, w in enumerate(url_filter._words(url_filter._probe_bits(F.col("canonical")))):
        every = every & (F.coalesce(F.col(f"w{i}"), F.lit(0)).bitwiseAND(w) == w)
    hits = [r[0] for r in p.where(every).select("id").collect()]
    assert set(range(2000)) <= set(hits) and len(hits) < 2000 + 120


def test_the_list_decides_and_the_join_removes_false_positives(spark, monkeypatch):
    """Brute force: the listed canonical URLs as a set; the broadcast and the salted filter give the same rows."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    feed = queries.listed_feed(pages)
    want = {r[0] for r in feed.select(url_filter.canonical(F.col("url"))).collect()}
    plain = {r["page_id"]: r["c"] for r in pages.select("page_id", url_filter.canonical(F.col("url")).alias("c")).collect()}
    got = url_filter.judge(pages, feed, []).collect()
    assert {r["page_id"]: r["listed"] for r in got} == {i: c in want for i, c in plain.items()}
    hosts = {}
    for r in got:
        hosts.setdefault(r["host"], set()).add(r["verdict"])
    assert any(v == {"allow", "block"} for v in hosts.values())  # the host does not give the verdict away
    monkeypatch.setattr(url_filter, "BROADCAST_BLOCKS", 0)
    assert sorted(url_filter.judge(pages, feed, []).collect()) == sorted(got)
    monkeypatch.setattr(url_filter, "BITS_PER_URL", 2)  # a crowded filter lets many absent URLs through
    feed = feed.union(spark.range(3000).select(F.concat(F.lit("http://absent.org/"), F.col("id")))).repartition(3)
    report = url_filter.filter_report(pages, feed).first()
    assert report["n_pages"] == len(got) and report["n_listed"] == sum(r["listed"] for r in got)
    assert report["n_false_positives"] == report["n_possible"] - report["n_listed"] > 0
    assert {r["page_id"]: r["listed"] for r in url_filter.judge(pages, feed, []).collect()} == {r["page_id"]: r["listed"] for r in got}


# ---- the pipeline

def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, now = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, SF).cache()
        assert out.columns == columns
        if name == "near_duplicates":
            want = {c for _, n, c in _brute_components([(r["doc_id"], r["text"]) for r in now.collect()]) if n} | {
                r["doc_id"] for r in now.collect() if not (r["text"] or "").split()}
            assert {r["doc_id"] for r in out.collect()} == want and out.count() == len(want)
        if name == "personal_data":
            assert out.count() == now.count()
            assert not out.where(F.col("text").rlike(r"[a-z]@[a-z0-9]+\.[a-z]")).count()
        now = out
    final = corpus_pipeline.STAGES[-1][1](spark, now, SF)
    assert final.groupBy("doc_id").agg(F.sum("length")).count() == now.select("doc_id").distinct().count()
    assert corpus_pipeline.run(spark, SF).count() == final.count()


def test_pipeline_of_an_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0


def test_one_text_is_fetched_for_each_set_whatever_the_ids(spark, monkeypatch):
    fetched = []
    real = ngram_join._texts

    def spy(src, wanted):
        out = real(src, wanted)
        fetched.append((out.count(), wanted.count()))
        return out

    monkeypatch.setattr(ngram_join, "_texts", spy)
    rnd = random.Random(9)
    base = [f"w{rnd.randrange(500)}" for _ in range(60)]
    texts = _family(rnd, 200, base)
    rows = [(None if i % 2 else 7, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(None, texts[1], "en", "s", 1)] * 50
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, DOCS))
    assert got.count() == 250 and all(a == b for a, b in fetched)
    kept = ngram_join.keep_one_of_each(spark.createDataFrame(rows, DOCS)).count()
    roots = len({ngram_join.set_signature(shingles.shingle_set(t)) for t in texts})
    assert 1 <= kept <= roots


@pytest.mark.parametrize("bound", [0, 500_000])
def test_one_of_each_moves_no_texts_but_repeated_ones(spark, bound, monkeypatch):
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", bound)
    rnd = random.Random(12)
    base = [f"w{rnd.randrange(500)}" for _ in range(60)]
    family = _family(rnd, 40, base)
    rows = [(i, t, "en", "s", i) for i, t in enumerate(family)] + [(4, family[4], "en", "s", 4)] * 2
    rows += [(None, family[1], "en", "s", 1), (0, family[0], "fr", "s", 0), (None, None, None, None, None)]
    rows += [(None, "only rows without id hold these words", "en", "s", i) for i in range(3)]
    d = spark.createDataFrame(rows, DOCS)
    root = {r["doc_id"]: r["component_id"] for r in ngram_join.near_duplicates(d).where("doc_id IS NOT NULL").collect()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = ngram_join.keep_one_of_each(d)
        plan = kept._jdf.queryExecution().sparkPlan().toString()
        got = kept.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(r["doc_id"] for r in got if r["doc_id"] is not None) == sorted(set(root.values()))
    assert sorted(str(r["text"]) for r in got if r["doc_id"] is None) == ["None", "only rows without id hold these words"]
    if bound:  # the lists are small: no join may shuffle the texts
        assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
