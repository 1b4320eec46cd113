"""Operators 11, 12 and 13 against SQL and brute force, and their edge cases."""

import random

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cadastra.llm import collocations, kronecker, queries, suffix_arrays

DOCS = "doc_id long, text string, lang string, extra string"
BENCH = "item_id long, text string, shard long"


def _sql(key, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    return sorted(map(repr, con.execute(queries.SQL[key]).fetchall()))


def _rows(df, key):
    cols = _COLUMNS[key]
    return sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())


_COLUMNS = {
    "op11_suffix_arrays": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op12_count_streams": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
    "op13_kronecker_negatives": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
}


# ---- 11

def test_suffix_array_sorts_all_suffixes():
    rnd = random.Random(5)
    for _ in range(60):
        docs = [[rnd.randrange(3) for _ in range(rnd.randrange(30))] for _ in range(rnd.randrange(1, 5))]
        s = np.array([x for i, d in enumerate(docs) for x in [w + len(docs) for w in d] + [i]], np.int64)
        want = sorted(range(len(s)), key=lambda i: tuple(s[i:]))
        assert suffix_arrays.suffix_array(s).tolist() == want
    long = np.r_[np.full(5000, 1), 0]
    assert suffix_arrays.suffix_array(long).tolist() == list(range(5000, -1, -1))
    assert len(suffix_arrays.suffix_array(np.zeros(0, np.int64))) == 0


def _contaminated_tables(spark):
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "x9"]
    items = [" ".join(rnd.choice(vocabulary) for _ in range(n)) for n in (40, 10, 9, 3, 1, 25, 25)]
    items[6] = items[5]  # equal texts, two items
    bench = [(i, t, i) for i, t in enumerate(items)] + [(90, None, 1), (91, " .,", 1), (3, "other words here", 2), (None, "zz y zz", 0)]
    docs = []
    for i in range(60):
        w = [rnd.choice(vocabulary) for _ in range(rnd.randrange(60))]
        if i % 4 == 0:
            t = rnd.choice(items).split()
            at = rnd.randrange(len(w) + 1)
            w[at:at] = t[: rnd.randrange(1, len(t) + 1)]
        docs.append((i, rnd.choice([" ", ", ", "-"]).join(w).upper(), "en", "a"))
    docs += [(60, None, "en", ""), (61, "", "en", ""), (62, items[0] + "!" + items[0], "en", ""), (62, items[2], "en", ""),
             (None, items[3], "en", ""), (63, (items[1] + " ") * 300, None, ""), (64, "zz, y; ZZ", "en", "")]
    docs += [(100 + i, items[0], "en", "copy") for i in range(30)]
    return spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(bench, BENCH)


@pytest.mark.parametrize("shard_words, pass_words", [(1 << 19, 1 << 21), (200, 120)])
def test_decontamination_matches_sql(spark, monkeypatch, shard_words, pass_words):
    docs, bench = _contaminated_tables(spark)
    monkeypatch.setattr(suffix_arrays, "PASS_WORDS", pass_words)
    got = suffix_arrays.report(docs, bench, shard_words=shard_words)
    assert _rows(got, "op11_suffix_arrays") == _sql("op11_suffix_arrays", documents=docs, benchmark=bench)


def test_longest_matches_against_brute_force(spark):
    docs, bench = _contaminated_tables(spark)
    got = {}
    for r in suffix_arrays.matches(suffix_arrays.build(docs, 300), bench).collect():
        k = (r["item_id"], r["item_at"])
        got[k] = max(got.get(k, 0), r["length"])
    texts = [suffix_arrays.words(r["text"]) for r in docs.collect()]
    want = {}
    for r in bench.collect():
        item = suffix_arrays.words(r["text"])
        need = min(len(item), 10)
        for at in range(len(item) - need + 1 if item else 0):
            best = 0
            for t in texts:
                for p in range(len(t)):
                    n = 0
                    while at + n < len(item) and p + n < len(t) and item[at + n] == t[p + n]:
                        n += 1
                    best = max(best, n)
            if best >= need:
                k = ("" if r["item_id"] is None else str(r["item_id"]), at)
                want[k] = max(want.get(k, 0), best)
    assert got == want


def test_decontaminate_removes_rows_and_keeps_columns(spark):
    docs, bench = _contaminated_tables(spark)
    docs = docs.withColumn("shard", F.lit(1)).withColumn("at", F.lit(2)).withColumn("_row_key", F.lit(3))
    kept = suffix_arrays.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    bad = suffix_arrays.report(docs, bench).where("contaminated").count()
    assert kept.count() == docs.count() - bad and bad > 30


def test_shards_are_written_and_read_one_by_one(spark, monkeypatch):
    names = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"]
    before, real, held = [spark.conf.get(n) for n in names], suffix_arrays.materialize, {}

    def spy(df, *args, **kw):
        held["hits" if "begins" in df.columns else "build" if "suffixes" in df.columns else ""] = [int(spark.conf.get(n)) for n in names]
        return real(df, *args, **kw)

    monkeypatch.setattr(suffix_arrays, "materialize", spy)
    monkeypatch.setattr(suffix_arrays, "GROUP_BYTES", 1 << 12, raising=False)
    rows = [(i, " ".join(f"w{(7 * i + k) % 500}" for k in range(400))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([("a", rows[0][1])], "item_id string, text string")
    shards = suffix_arrays.build(docs, 800)
    parts = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in shards.inputFiles()]
    groups = [m.row_group(i).num_rows for m in parts for i in range(m.num_row_groups)]
    assert sum(groups) == 20 and max(groups) <= 2  # not all shards of a task in one row group
    suffix_arrays.search(shards, bench)
    assert held["build"][0] <= 256 and held["hits"] == [1, 1]
    assert [spark.conf.get(n) for n in names] == before
    assert suffix_arrays.report(docs, bench, shard_words=800).where("contaminated").count() == suffix_arrays.report(
        docs, bench, shard_words=1 << 20).where("contaminated").count() > 0


def test_decontamination_of_empty_tables(spark):
    docs, bench = _contaminated_tables(spark)
    assert suffix_arrays.report(docs.limit(0), bench).collect() == []
    clean = suffix_arrays.report(docs, bench.limit(0))
    assert clean.where("contaminated").count() == 0 and clean.count() == docs.count()
    assert clean.where("items_sha256 <> sha2('', 256) OR n_items <> 0 OR n_hit <> 0").count() == 0


# ---- 12

def _phrase_table(spark):
    rnd = random.Random(3)
    common = ["the", "of", "état", "x", "a.b", "tab\tgap"]
    rows = []
    for i in range(500):
        w = [rnd.choice(common) if rnd.random() < 0.7 else f"r{rnd.randrange(200)}" for _ in range(rnd.randrange(40))]
        sep = rnd.choice([" ", "  ", " \t", "\n", ". ", "\x0b"])
        rows.append((i, sep.join(w), rnd.choice(["en", "fr", None, "und"]), "z"))
    rows += [(1000 + i, "New York city hall is in New York City", "en", "z") for i in range(60)]
    rows += [(2000 + i, "\x01odd \x01odd \x1c\x1d AİB", "en", "z") for i in range(40)]
    rows += [(3000, None, "en", ""), (3001, "", "xx", ""), (3002, "?!", "yy", ""), (3003, "hot pair " * 5000, "hot", "")]
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.mark.parametrize("sizes", [{}, {"range_bytes": 2000, "chunk_words": 300}])
def test_collocations_match_sql(spark, sizes):
    docs = _phrase_table(spark)
    got = collocations.collocations(docs, **sizes)
    want = _sql("op12_count_streams", documents=docs)
    assert _rows(got, "op12_count_streams") == want and len(want) > 40


def test_ranges_and_batches_do_not_change_counts(spark):
    docs = _phrase_table(spark)
    one = collocations.counts(docs, min_count=5)
    many = collocations.counts(docs, min_count=5, range_bytes=500, chunk_words=100)
    assert sorted(map(tuple, (map(str, r) for r in one.collect()))) == sorted(map(tuple, (map(str, r) for r in many.collect())))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        small = _rows(collocations.collocations(docs, min_count=5), "op12_count_streams")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert small == _rows(collocations.collocations(docs, min_count=5), "op12_count_streams")


def test_collocations_of_an_empty_table_and_of_large_counts(spark):
    docs = _phrase_table(spark)
    assert collocations.collocations(docs.limit(0)).collect() == []
    assert collocations.collocations(docs.where("text IS NULL")).collect() == []
    # products beyond 64 bits stay exact
    n = 6 * 10**13
    cols = [np.zeros(3, np.int64), np.array([1, 1, 2]), np.array([0, 2, 0]), np.zeros(3, np.int64), np.zeros(3, np.int64)]
    found = {tuple(x[2]): x[3] for x in collocations.stretches([b"en"], [b"a", b"b"], cols, np.array([1, n, n + 7]), 4, 30)}
    assert found[("a",)] == n + 1 and found[("a", "b")] == n and found[("b",)] == n + 7


# ---- 13

VECTORS = "vec_id long, embedding array<float>, label int, row string"


def _vectors(spark, scale=0.3, dims=8, n=400):
    rnd = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rnd.normal(0, scale, dims)], int(rnd.integers(0, 4)), "x") for i in range(n)]
    rows += [(100, rows[100][1], rows[100][2], "again"), (7, rows[3][1], 2, "again"), (500, rows[1][1], 1, "anchor")]
    rows += [(600 + i, rows[1][1], i % 2, "copies") for i in range(30)]
    rows += [(700, None, 1, ""), (800, [0.1] * dims, None, ""), (900, [float("nan")] + [0.0] * (dims - 1), 1, ""),
             (1000, [None] + [0.0] * (dims - 1), 1, ""), (1100, [float("inf")] + [0.0] * (dims - 1), 1, ""), (None, rows[0][1], 1, "")]
    return spark.createDataFrame(rows, VECTORS).repartition(3)


def _negatives(df):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return kronecker.mine(df, F.col("vec_id") % 100 == 0, moved)


@pytest.mark.parametrize("scale", [0.3, 50000.0])  # the second needs more than 53 bits
def test_hard_negatives_match_sql(spark, scale):
    df = _vectors(spark, scale)
    want = _sql("op13_kronecker_negatives", embeddings=df)
    assert _rows(_negatives(df), "op13_kronecker_negatives") == want and len(want) > 100


def test_hard_negatives_in_small_passes_and_blocks(spark, monkeypatch):
    df = _vectors(spark)
    for name, value in {"BLOCK_ROWS": 16, "PASS_ANCHORS": 2, "ANCHOR_ROWS": 1}.items():
        monkeypatch.setattr(kronecker, name, value)
    assert _rows(_negatives(df), "op13_kronecker_negatives") == _sql("op13_kronecker_negatives", embeddings=df)


def test_hard_negatives_of_nothing(spark):
    df = _vectors(spark)
    assert _negatives(df.limit(0)).collect() == []
    assert _negatives(df.where("vec_id % 100 <> 0")).collect() == []
    alone = df.where("vec_id % 7 <> 0").dropDuplicates(["vec_id"]).withColumn("label", F.col("vec_id").cast("int"))
    assert _negatives(alone).collect() == []  # no positives


@pytest.mark.parametrize("high", [3, 257, 1 << 20, 1 << 40])
def test_packed_products_are_exact(high):
    rnd = np.random.default_rng(1)
    v = rnd.integers(-high + 1, high, (37, 9))
    a = rnd.integers(-high + 1, high, (5, 9))
    p = kronecker.Packing(9, int(min(v.min(), a.min())), int(max(v.max(), a.max())) + 1)
    if high == 1 << 40:
        v, a = v >> 12, a >> 12
    assert (p.scores(a, p.pack(v), v.sum(axis=1)) == a @ v.T).all()
