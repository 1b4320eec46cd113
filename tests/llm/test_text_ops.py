"""Operators 1, 3, 4, 6 and 7 against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from cadastra.llm import packing, page_diff, pii, queries, shingles, sketch, tokens, wavelet

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PATH = tokens.public_path(queries.TOKENIZER)


def _docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


def _read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# ---- 3: personal data

BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def _luhn(digits):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c))
               for i, c in enumerate(reversed(digits))) % 10 == 0


def _ok(kind, s):
    digits = re.sub("[^0-9]", "", s)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in s.split(".")),
            "card": lambda: 12 <= len(digits) <= 19 and _luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()


def brute_base(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(BASE)
             for m in re.finditer(p, text or "", re.A) if _ok(kind, m.group())]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)]


def _awkward(seed, n):
    rnd = random.Random(seed)
    parts = ["4111 1111 1111 1111", "4111-1111-1111-1111", "1.2.3.4", "255.256.1.1", "001.02.3.255", "a@b.c", "x.y@z-a.bc.de",
             "+1 (555) 010-9999", "+44 20.7946.0958", "@", ".", "..", " ", "  ", "-", "--", "+", "0", "12", "7", "é", "\U0001f600", "\n",
             "4539578763621486", "token = \"0123456789abcdef0123\"", "(at)", "a", "b.", "(", ")", "1.1.1.1.1.1.1.1", "5500000000000004"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 40))) for _ in range(n)]


def test_pii_base_spans_match_brute_force(spark):
    texts = _awkward(1, 400) + [None, "", "1" * 30_000, "1 " * 20_000, "a.b" * 20_000, "a@" + "b." * 20_000 + "c", "1." * 20_000,
                                "+1" + " 2" * 20_000, "-" * 20_000 + "@"]
    texts += [r[0] for r in _read(spark, "documents").select("text").collect()]
    rows = {r["doc_id"]: r for r in pii.report(_docs(spark, texts), pii.Scorer()).collect()}
    for i, t in enumerate(texts):
        want = ",".join(brute_base(t))
        got = rows[i]
        assert got["spans"] == want, t
        assert got["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        for k, _ in BASE:
            assert got[f"n_{k}"] == want.count(k + ":")


def test_pii_model_adds_spans_and_keeps_base_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scorer = pii.fit(docs)
    assert scorer.margin and scorer.thresholds
    rows = pii.report(docs, scorer).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    secrets = hits = 0
    for r in rows:
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(brute_base(texts[r["doc_id"]])) <= set(spans)
        starts = [(int(s.split(":")[1]), pii.KINDS.index(s.split(":")[0])) for s in spans]
        assert starts == sorted(starts)
        for m in re.finditer(r'token = "([0-9a-f]{40})"', texts[r["doc_id"]]):
            secrets += 1
            hits += f"secret:{m.start(1)}:{m.end(1)}" in spans
    assert secrets > 3 and hits / secrets > 0.9


def test_pii_rare_kind_is_found_beyond_the_sample(spark):
    rnd = random.Random(3)
    texts = [f"part {rnd.getrandbits(80):020x}a1 of build {rnd.randint(10**7, 10**9)}, mail a{i}@b.org" for i in range(600)]
    keys = {}
    for i in range(0, 600, 30):
        keys[i] = f"{rnd.getrandbits(160):040x}"
        texts[i] = f'set token = "{keys[i]}" here'
    d = _docs(spark, texts)
    for sample in (20, 600):  # the same secrets whether the sample holds some of them or all
        scorer = pii.fit(d, sample_docs=sample)
        assert pii.KINDS.index("secret") in scorer.thresholds
        rows = {r["doc_id"]: r["spans"] for r in pii.report(d, scorer).collect()}
        assert {i for i, x in rows.items() if "secret:" in x} == set(keys), sample


def test_long_candidates_are_found_and_redacted(spark):
    """Tokens, numbers and handles of any length are candidates; a long token named as one is redacted."""
    rnd = random.Random(4)
    # no run of digits long enough to pass as a card, which is a span of its own
    key = lambda n: "".join("a" if i % 8 == 3 else rnd.choice("0123456789abcdef") for i in range(n - 1)) + "7"
    sizes = [40, 255, 256, 257, 320, 5000, 100_000]
    keys = [key(n) for n in sizes]
    texts = [f'set token = "{k}" here' for k in keys]
    texts += ["1234 5678 " * 50 + "12", f"{'a' * 70}.{'b' * 70}@{'c' * 70}" + ".d" * 12, f"{key(600)}"]
    loose = _docs(spark, texts).selectExpr("doc_id", "text AS t").selectExpr(
        "doc_id", f"transform({pii._loose_spans()}, x -> concat(x.kind, ':', x.start, ':', x.stop)) AS s")
    spans = {r["doc_id"]: set(r["s"]) for r in loose.collect()}
    for i, n in enumerate(sizes):
        assert f"4:13:{13 + n}" in spans[i]
    assert "5:0:502" in spans[7] and f"6:0:{len(texts[8])}" in spans[8] and "4:0:600" in spans[9]
    many = [f"part {key(40)} of build {rnd.randint(10**7, 10**9)}" for _ in range(300)]
    many += [f'set token = "{key(rnd.randint(16, 400))}" here' for _ in range(120)]
    d = _docs(spark, texts[: len(sizes)] + many)
    got = {r["doc_id"]: r["text"] for r in pii.redact(d).collect()}
    assert all(got[i] == 'set token = "[SECRET]" here' for i in range(len(sizes)))


def test_long_runs_of_numbers_are_passed_once(spark):
    """A number run of a whole text that ends in a letter has no match, and is not tried again from each group."""
    text = "12 34 " * 100_000 + "5x"
    d = _docs(spark, [text]).selectExpr("doc_id", "text AS t").selectExpr(f"size({pii._loose_spans()}) AS n")
    assert d.first()["n"] == 0


def test_redaction_replaces_spans_and_length(spark):
    d = _docs(spark, ["call +1 (555) 010-9999 or a@b.co, é 1.2.3.4.", None, "", "none"])
    rows = {r["doc_id"]: r for r in pii.redact(d, pii.Scorer()).collect()}
    assert rows[0]["text"] == "call [PHONE] or [EMAIL], é [IP]." and rows[0]["n_chars"] == len(rows[0]["text"])
    assert rows[1]["text"] is None and rows[2]["text"] == "" and rows[3]["text"] == "none"
    assert pii.redact(d.limit(0)).count() == 0
    clash = d.withColumn("t", d.text).withColumn("_base", d.text)
    assert pii.redact(clash, pii.Scorer()).columns == clash.columns


# ---- 4 and 7: tokens

ODD_TEXTS = [None, "", " ", "\n\n", "  two  spaces \n\n x", "it's don't \t tab", "a\x1cb \x1f c", "<|endoftext|> x", "é ü　y z",
             "no-space,here 123abc", "x" * 5000, "\U0001f600 smile ​zero", "a " * 3000, "trailing   "]


def _ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_chunked_encoding_equals_the_library(spark):
    texts = ODD_TEXTS + [r[0] for r in _read(spark, "documents").select("text").collect()]
    got = tokens.encoder(PATH).encode_many(texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == _ids(texts)


def test_wavelet_matrix_queries():
    rnd = np.random.default_rng(3)
    for n, sigma in ((0, 1), (1, 1), (700, 3), (5000, 60_000)):
        ids = rnd.integers(0, sigma, n).astype(np.uint32)
        w = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(ids).to_bytes())
        assert (w.decode() == ids).all()
        for i in range(0, n, 97):
            t = int(ids[i])
            assert w.access(i) == t
            assert w.rank(t, i) == (ids[:i] == t).sum() and w.count(t) == (ids == t).sum()
            where = np.flatnonzero(ids == t)
            assert w.select(t, len(where) // 2) == where[len(where) // 2]
        assert w.count(1 << 30) == 0
    with pytest.raises(IndexError):
        wavelet.WaveletMatrix.build(np.array([1, 2])).select(1, 1)


@pytest.mark.parametrize("shard", [1, 500, 1 << 20])
def test_wavelet_shards_round_trip(spark, shard):
    texts = ODD_TEXTS + [r[0] for r in _read(spark, "documents").select("text").limit(60).collect()]
    docs = _docs(spark, texts).repartition(5)
    rows = {r["doc_id"]: r for r in wavelet.read_shards(
        wavelet.write_shards(docs, PATH, 2, shard_tokens=shard)).collect()}
    start = 0
    for i, ids in enumerate(_ids(texts)):
        ids = ids + [2]
        r = rows[i]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), _crc(ids))
        start += len(ids)
    assert wavelet.read_shards(wavelet.write_shards(docs.limit(0), PATH, 2)).count() == 0


def test_packing_encodes_small_batches_and_hands_memory_back(spark, monkeypatch):
    name, sizes, released = "spark.sql.execution.arrow.maxRecordsPerBatch", [], []
    before = spark.conf.get(name)
    monkeypatch.setattr(packing, "materialize", lambda df, do=packing.materialize: sizes.append(int(spark.conf.get(name))) or do(df))
    assert packing.pack(_docs(spark, ["a b", None]), PATH).count() > 0
    assert 0 < sizes[0] <= 1024 and spark.conf.get(name) == before
    pool = type("Pool", (), {"release_unused": lambda self: released.append(1)})
    monkeypatch.setattr(tokens.pa, "default_memory_pool", pool)
    tokens.encoder(PATH).end_task()
    assert released == [1]


def test_packing_covers_every_token_once(spark):
    texts = ODD_TEXTS + [r[0] for r in _read(spark, "documents").select("text").limit(60).collect()]
    docs = _docs(spark, texts)
    rows = packing.pack(docs.union(docs.limit(3)), PATH).collect()
    by: dict = {}
    for r in packing.pack(docs, PATH).collect():
        assert r["length"] in {1 << i for i in range(12)} and r["offset"] == 0
        assert r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"]
        by.setdefault(r["doc_id"], []).append(r)
    for i, ids in enumerate(_ids(texts)):
        ids = ids + [1]
        at = 0
        for r in sorted(by[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == _crc(ids[at : at + r["length"]])
            at += r["length"]
        assert at == len(ids)
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))
    assert [r["length"] for r in sorted(rows, key=lambda r: r["sequence_id"])] == sorted((r["length"] for r in rows), reverse=True)
    assert packing.pack(docs.limit(0), PATH).count() == 0


# ---- 6: fingerprints

def test_fingerprints_against_brute_force(spark):
    texts = ["", None, "one two", "a b c d e f g h", "a b c d e f g h", " ".join(map(str, range(900))),
             " ".join(map(str, range(100, 1000)))] + [r[0] for r in _read(spark, "documents").select("text").limit(80).collect()]
    rows = {r["doc_id"]: r for r in sketch.against_next(_docs(spark, texts).repartition(7)).collect()}
    assert len(rows) == len(texts)

    def sets(t):
        return set(shingles.shingle_set(t).tolist())

    def jaccard(a, b):
        return len(a & b) / len(a | b) if a | b else 1.0

    off = []
    for i, t in enumerate(texts):
        t, nxt = t or "", texts[(i + 1) % len(texts)] or ""
        change = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        r = rows[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(change.encode()).hexdigest()
        assert r["fingerprint"] == sketch.to_text(sketch.sketch(t))
        assert (sketch.from_text(r["edited_fingerprint"]) == sketch.sketch(change)).all()
        off += [abs(r["near_edited"] - jaccard(sets(t), sets(change))), abs(r["near_next"] - jaccard(sets(t), sets(nxt)))]
    assert max(off) < 0.13 and np.mean(off) < 0.02
    assert rows[3]["near_next"] == 1.0 and rows[3]["fingerprint"] == rows[4]["fingerprint"]
    one = sketch.against_next(_docs(spark, ["a b c d"])).collect()
    assert len(one) == 1 and one[0]["edited_sha256"] == hashlib.sha256(b"a b a b").hexdigest()
    assert sketch.against_next(_docs(spark, []).limit(0)).count() == 0


def test_sketches_merge_and_estimate():
    a, b = (np.unique(shingles.mix64(np.arange(lo, lo + 5000, dtype=np.uint64))) for lo in (0, 2500))
    sa, sb = sketch.bottom_k(a), sketch.bottom_k(b)
    assert (sketch.merge(sa, sb) == sketch.bottom_k(np.union1d(a, b))).all()
    assert abs(sketch.resemblance(sa, sb) - 1 / 3) < 0.1
    assert abs(sketch.containment(sa, sb) - 0.5) < 0.15
    assert abs(sketch.distinct(sa) / 5000 - 1) < 0.2


def test_fingerprints_with_null_and_repeated_ids(spark):
    d = spark.createDataFrame([(None, "x y"), (None, None), (1, "a"), (1, "a"), (1, "b"), (9, "")], "doc_id long, text string")
    assert sketch.against_next(d).count() == 6


# ---- 1: pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><p>Site</p></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="ad">Buy</div>
<article><header><h1>Head &amp; line</h1></header><p><b>One   two
three.<br><p>Next&nbsp;p &lt;x&gt;</p><form><input name=q><p>Form</p></form><aside>Side</aside>
<div class="comments"><p>Reader</p></div></article><div id="cookie-notice">Cookies</div><footer>&copy; F</footer></body></html>"""


def test_main_text_by_markup():
    assert page_diff.main_text(PAGE, set()) == "Head & line\nOne two three.\nNext p <x>"
    assert page_diff.main_text(None, set()) == "" and page_diff.main_text("", set()) == ""
    assert page_diff.main_text("<p>a<p>b <i>c</i>d", set()) == "a\nb cd"
    assert page_diff.main_text("<article><p>cut <b", set()) == "cut"
    assert page_diff.main_text("plain", set()) == "plain"


@pytest.mark.parametrize("page, want", [
    ('<article><p class="notice">Ad<p>Real text<p>More</article>', "Real text\nMore"),
    ('<article><p class="notice">Ad <span class="ad">x<h2>Head</h2>Text<p class="ad">Ad<hr>After</article>', "Head\nText\nAfter"),
    ('<article><ul><li class="ad">Ad<li>One<ul><li>In<li class="ad">Ad</ul>Out<li>Two</ul>End</article>', "One\nIn\nOut\nTwo\nEnd"),
    ('<article><dl><dt class="ad">Ad<dd>One<dt>Two<dd class="ad">Ad<p>Ad</dl>End</article>', "One\nTwo\nEnd"),
    ('<article><table><tr class="ad"><td>Ad<td>Ad<tr><td class="ad">Ad<p>Ad<td>One</table>End</article>', "One\nEnd"),
    ('<article><div class="ad"><p>Ad<p>Ad<ul><li>Ad</ul></div>Text</article>', "Text"),
    ('<article><p>One<table><tr><td><p>Two<td><p class="ad">Ad</table>Three<p>Four</article>', "One\nTwo\nThree\nFour"),
])
def test_omitted_end_tags(page, want):
    assert page_diff.main_text(page, set()) == want


def test_common_lines_are_a_longest_common_subsequence():
    rnd = random.Random(5)
    for _ in range(200):
        a, b = ([rnd.randint(0, 4) for _ in range(rnd.randint(0, 12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        got = page_diff.common(np.array(a, np.int64), np.array(b, np.int64))
        assert len(got) == best[-1][-1] and got == sorted(set(got))
        it = iter(b)
        assert all(any(a[i] == x for x in it) for i in got)


def test_shared_lines_of_the_nearest_page_go(spark):
    def page(*body):
        return "<html><body>" + "".join(f"<div>{x}</div>" for x in body) + "</body></html>"

    rows = [
        (1, "http://h.com/news/1", page("Welcome to the site", "First story.", "All rights reserved")),
        (2, "http://h.com/news/2", page("Welcome to the site", "Second story.", "All rights reserved")),
        (3, "http://other.com/news/1", page("Welcome to the site", "Third story.")),
        (4, "http://copy.com/a", page("Same.")), (5, "http://copy.com/b", page("Same.")),
        (6, None, page("No url.")), (7, "http://h.com/x", None), (2, "http://h.com/news/2", page("Welcome to the site", "Second story.", "All rights reserved")),
    ]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in page_diff.extract(d.repartition(4)).collect())
    assert [(i, t) for i, t, _ in got] == [
        (1, "First story."), (2, "Second story."), (2, "Second story."), (3, "Welcome to the site\nThird story."),
        (4, "Same."), (5, "Same."), (6, "No url."), (7, "")]
    assert all(n == len(t) for _, t, n in got)
    assert page_diff.extract(d.limit(0)).count() == 0


def test_pages_of_the_table(spark):
    import html as H

    pages = {r["page_id"]: r["html"] for r in _read(spark, "pages").collect()}
    for r in page_diff.extract(_read(spark, "pages")).collect():
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r["page_id"]], re.S).group(1)
        want = [" ".join(H.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>|<br>", body)]
        assert r["text"] == "\n".join(x for x in want if x)


def _by_brute_force(rows):
    """Text of every (url, html) with its partners found in one sorted list."""
    def split(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest).group()
        return host.lower(), re.match(r"[^?#]*", rest[len(host):]).group()

    def content(url, page):
        inner = hashlib.sha1((page or "").encode()).hexdigest()
        return hashlib.sha1((inner + ("0" if url is None else "1" + url)).encode()).digest()

    order = sorted({(*split(u), content(u, p)): (u, p) for _, u, p in rows}.items())
    texts = {}
    for i, ((host, path, _), (u, p)) in enumerate(order):
        found = page_diff.lines(p)

        def beside(j):
            if not 0 <= j < len(order) or order[j][0][0] != host:
                return None
            return order[j][0][1], np.array([hash(t) for t, _, _ in page_diff.lines(order[j][1][1])], np.int64)

        own = np.array([hash(t) for t, _, _ in found], np.int64)
        drop = page_diff.shared_lines(path, own, beside(i - 1), beside(i + 1))
        decided = sum(k == page_diff.DOUBTFUL for j, k in enumerate(page_diff.kinds(found)) if j in drop)
        texts[u, p] = page_diff.main_text(p, drop), decided
    return sorted((i, u or "", *texts[u, p]) for i, u, p in rows)


def _plain_pages(n):
    """Pages without an element, role or class name that tells furniture from text."""
    rnd = random.Random(11)
    rows, wanted = [], {}
    for i in range(n):
        site = i % 5
        story = [f"Story {i} line {k} {rnd.random()}." for k in range(rnd.randint(1, 6))]
        body = [f"Site {site}", "Home News Sport", *story, f"Rights of {site}"]
        rows.append((i, f"http://s{site}.org/{rnd.choice(['a', 'b', 'c'])}/{i}", "".join(f"<div class='x{k}'>{b}</div>" for k, b in enumerate(body))))
        wanted[i] = "\n".join(story)
    return rows, wanted


def test_differencing_decides_where_the_markup_says_nothing(spark):
    rows, wanted = _plain_pages(60)
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = page_diff.extract(d.repartition(3)).collect()
    assert {r["page_id"]: r["text"] for r in got} == wanted
    assert all(r["n_decided_lines"] == 3 and page_diff.main_text(rows[r["page_id"]][2], set()) != r["text"] for r in got)


def test_a_near_copy_beside_a_page_keeps_its_text(spark):
    def page(*body):
        return "".join(f"<div>{x}</div>" for x in ("Top", *body, "End"))

    story = [f"Line {i}." for i in range(12)]
    rows = [(1, "http://h.com/n/10", page(*story)), (2, "http://h.com/n/11", page(*story, "Late news.")),
            (3, "http://h.com/n/2", page("Another."))]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in page_diff.extract(d).collect()}
    assert got[2] == "\n".join([*story, "Late news."]) and got[3] == "Another."


@pytest.mark.parametrize("width", [1, 7, 1024])
def test_ranges_and_many_copies_against_brute_force(spark, monkeypatch, width):
    """Ranges of one page, copies beyond a range's rows, a very long page, nulls, clashing names."""
    monkeypatch.setattr(page_diff, "RANGE_ROWS", width)
    rows, _ = _plain_pages(40)
    rows += [(100 + i, rows[3][1], rows[3][2]) for i in range(30)] + [(3, None, "<p>x"), (None, "http://s1.org/a/0", None), (7, "", "")]
    rows += [(500, "http://s2.org/b/1", "".join(f"<p>Line {i}" for i in range(20000)))]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    d = d.selectExpr("*", "1 AS key", "2 AS host", "3 AS path", "4 AS text", "5 AS range", "6 AS whole").repartition(5)
    got = page_diff.extract(d).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r["page_id"], r["url"] or "", r["text"], r["n_decided_lines"]) for r in got), key=key) == sorted(
        _by_brute_force_with_null_ids(rows), key=key)


def _by_brute_force_with_null_ids(rows):
    return [(None if i == -1 else i, *rest) for i, *rest in _by_brute_force([(-1 if i is None else i, u, p) for i, u, p in rows])]


def test_slices_are_bounded_by_texts_and_characters():
    texts = ["a" * 10, None, "", "b" * 500, "c" * 10, "d" * 10, "e"]
    for size, characters in ((2, 100), (3, 20), (100, 10**6), (1, 1)):
        made = list(tokens.slices(texts, size, characters))
        assert [t for _, some in made for t in some] == texts
        assert [at for at, _ in made] == [sum(len(s) for _, s in made[:k]) for k in range(len(made))]
        assert all(len(s) <= size and (len(s) == 1 or sum(len(t or "") for t in s) <= characters) for _, s in made)
    assert list(tokens.slices([])) == []


def test_encoder_matches_the_library_when_its_table_turns_over(monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK_CACHE", 50)
    rng = random.Random(5)
    parts = ["ab", " ", "\n", "  ", ". ", ", ", "\t", "é", "'s", "\x01", "中", "7", "!", "\x1c", "<|endoftext|>", "Zq"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000)]
    enc = tokens.ChunkEncoder(PATH)
    got = [ids for _, some in tokens.slices(texts, 100) for ids in enc.encode_many(some)]
    assert got == enc._ids(texts)
    assert max(len(enc.cache), len(enc.older)) < 50 + 100 * 40


def test_plain_words_go_to_the_model_without_a_search_for_pre_tokens(monkeypatch):
    rnd = random.Random(21)
    letters = "abcXYZ\u00c0\u00d6\u00d8\u00df\u00f6\u00f8\u00ff\u0101\u017f\u01bb\u01c5\u024f"
    words = ["".join(rnd.choices(letters, k=rnd.randint(1, 12))) for _ in range(3000)]
    plain = [" ".join(w + rnd.choice(["", "", "", ".", "$$$", "!!", ",%%%", "-", "`"]) for w in words[i : i + 60])
             for i in range(0, 3000, 60)]
    odd = ["".join(rnd.choices(list("ab\u00d7\u00f7\u0250\u0301\u03b1\u4e00_'`.,19 \n\t\u00a0\u2028\x85\u200b") + ["'s", "'ll ", " \u00e9"], k=40))
           for _ in range(600)]
    enc, sent = tokens.ChunkEncoder(PATH), []
    real = enc._ids
    monkeypatch.setattr(enc, "_ids", lambda texts: sent.extend(texts) or real(texts))
    monkeypatch.setattr(enc, "_ids_joined", lambda pieces: sent.extend(pieces) or real(pieces))
    assert enc.encode_many(plain) == real(plain)
    assert len(sent) < 20  # only the marks after words
    assert enc.encode_many(odd) == real(odd)
