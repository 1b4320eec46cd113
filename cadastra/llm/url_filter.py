"""URL filters: a blocked Bloom filter of listed canonical URLs before an exact hash join.

``listed`` is any table of URLs. Its canonical forms are hashed into a Bloom
filter cut into blocks of 512 bits (one row of eight longs each); a URL sets
``PROBES`` bits of one block, so a lookup reads one row. The filter is a table
that Spark joins by block number: broadcast while its counted blocks are within
``BROADCAST_BLOCKS``, beyond that by a salted join, since a URL that many pages
repeat makes its block hot. Only URLs whose bits are all set go to the
exact join with the list, which removes the false positives, so the verdict
is exact. Pages are passed once; ``possible`` tells what passed the filter.

Canonical form: scheme, user, default port, a leading ``www.``, fragment,
tracking parameters and trailing slashes dropped; host lower-cased; parameters
sorted.

Rules by host and path come first: a rule fits its host and all subdomains
where the path starts with the rule's; the longest fitting rule wins. Where
none fits, the verdict is ``block`` for listed URLs, else ``allow``.

Null url, or one without ``://``: empty host and path, no rule, allow. Repeated
rows, ids and list entries, an empty table and an empty list are fine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.operators.materialize import known_rows, materialize

BITS_PER_URL = 16
PROBES = 6
BLOCK_BITS = 512
#: blocks (of 72 bytes) in a filter that is broadcast: 19 MB, 8 million URLs
BROADCAST_BLOCKS = 1 << 18
#: copies of a larger filter, among which pages are dealt
SALTS = 8
# fixed values: query parameters that only track
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid|mc_cid|mc_eid)(=|$)"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to ``/ ? #`` or the end; then up to ``? #`` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    host, path = split_url(url)
    host = F.regexp_replace(F.regexp_replace(host, r"^[^@]*@", ""), r"^www\.|:(80|443)$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.concat(host, F.regexp_replace(path, r"/+$", ""), tail)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; rules: (host, path, verdict)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), url), F.lit(blocks))


def _probe_bits(url: Column) -> list[Column]:
    """Bit numbers within the block, from 9 bits each of a second hash."""
    h = F.xxhash64(F.lit(2), url)
    return [F.shiftrightunsigned(h, 9 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for i in range(PROBES)]


def _words(bits: list[Column]) -> list[Column]:
    """The eight longs of a block with the given bits set."""
    out = []
    for w in range(BLOCK_BITS // 64):
        word = F.lit(0).cast("long")
        for b in bits:
            one = F.call_function("shiftleft", F.lit(1).cast("long"), b.bitwiseAND(F.lit(63)))
            word = word.bitwiseOR(F.when(F.shiftrightunsigned(b, 6) == w, one).otherwise(F.lit(0).cast("long")))
        out.append(word)
    return out


def bloom_filter(listed: DataFrame, column: str, n_listed: int) -> tuple[DataFrame, int]:
    """(filter table (block, w0..w7), number of blocks) of distinct canonical URLs."""
    blocks = max(1, -(-n_listed * BITS_PER_URL // BLOCK_BITS))
    url = F.col(column)
    bits = listed.select(_block(url, blocks).alias("block"), *[
        w.alias(f"w{i}") for i, w in enumerate(_words(_probe_bits(url)))])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(BLOCK_BITS // 64)]), blocks


def listed_urls(pages: DataFrame, listed: DataFrame, url_col: str = "url") -> DataFrame:
    """The rows of ``pages`` (with a column ``canonical``) plus ``possible`` (passed the filter) and ``listed``."""
    names = materialize(listed.select(canonical(F.col(url_col)).alias("name")).where("name <> ''").distinct())
    bloom, blocks = bloom_filter(names, "name", known_rows(names))
    bloom = bloom.withColumnRenamed("block", "_block")
    p = pages.withColumn("_block", _block(F.col("canonical"), blocks))
    small = blocks <= BROADCAST_BLOCKS
    if small:
        p = p.join(F.broadcast(bloom), "_block", "left")
    else:
        bloom = bloom.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        p = p.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")).join(
            bloom, ["_block", "_salt"], "left")
    every = F.lit(True)
    for i, w in enumerate(_words(_probe_bits(F.col("canonical")))):
        every = every & (F.coalesce(F.col(f"w{i}"), F.lit(0)).bitwiseAND(w) == w)
    p = materialize(p.select(*pages.columns, every.alias("possible")))
    # a URL that is surely not listed gets no partner and need not meet the others of its name
    hit = p.where("possible").join(names.withColumn("_on", F.lit(True)), F.col("canonical") == F.col("name"), "left")
    hit = hit.select(*pages.columns, "possible", F.col("_on").isNotNull().alias("listed"))
    return hit.unionByName(p.where("NOT possible").withColumn("listed", F.lit(False)))


def _parts(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    url = F.col(url_col).cast("string")
    host, path = split_url(url)
    return pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"),
                        F.coalesce(canonical(url), F.lit("")).alias("canonical"))


def filter_report(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row: pages, those that passed the filter, those listed, and false positives that the join removed."""
    p = listed_urls(_parts(pages, id_col, url_col), listed, url_col)
    return p.agg(F.count(F.lit(1)).alias("n_pages"), F.count_if("possible").alias("n_possible"),
                 F.count_if("listed").alias("n_listed"),
                 F.count_if(F.col("possible") & ~F.col("listed")).alias("n_false_positives"))


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]],
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule (null where none fits), verdict, listed of every row."""
    p = listed_urls(_parts(pages, id_col, url_col), listed, url_col)
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    return p.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(
        verdict, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "listed")
