"""Personal data by candidate gradient boosting (DataFrame and SQL functions only).

Generators propose spans with high recall; they may overlap:

- ``email``, ``ip``, ``card``, ``phone``: the base rules. Spans that meet their
  checks are always kept.
- ``secret``: long runs of letters and digits; ``number``: digit groups with
  separators; ``handle``: loose mail addresses (``a (at) b.c``).

Boosted trees score every loose candidate from its format and the text around
it. They are fitted on candidates of a bounded sample of documents
(``SAMPLE_DOCS``) and on up to ``RARE`` more feature patterns of each loose
generator and label from all documents, so that a kind too rare for the sample
is learnt too. A candidate is positive if a strict rule confirms it (a base
rule with its checks, or a secret assigned to a name such as ``token``) and
negative otherwise. A threshold per generator is calibrated for ``PRECISION``
on the loose candidates of all documents; a generator that never gets there
adds nothing.
Added spans that overlap a base span are dropped, and of added spans that
overlap one another the best score stays. The fitted trees become one SQL
expression, so scoring needs no shuffle: everything happens in the row.

Offsets are code points, end exclusive. Patterns use possessive repetition, so
long texts take linear time and no deep recursion. A text with k candidates
costs O(k^2) small steps in its row.

Null or empty text: no spans. Null or repeated ids, extra columns and empty
tables are fine (an empty sample fits no trees and adds no spans).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.operators.materialize import materialize

SAMPLE_DOCS = 4000
RARE = 500  # feature patterns of a generator and label that are fitted beside the sample
PRECISION = 0.95
KINDS = ["email", "ip", "card", "phone", "secret", "number", "handle"]  # order within one start
BASE = KINDS[:4]

# email: a run of local characters starts where the run starts, or where the last match ended
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    # a longest chain of digits with single separators; only chains of 12 to 19 digits can pass
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){11,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    # loose runs of any length: every one starts where a run starts, so a text is passed once; the trees see the length
    "secret": r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{16,}+",
    "number": r"(?<![0-9A-Za-z])(?<![0-9][ ().-]{1,2})[0-9](?:[ ().-]{0,2}+[0-9]){6,}+(?![0-9A-Za-z])",
    "handle": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@| ?[\[(]at[\])] ?)[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
}
# a text without this mark has no match of the pattern
NEEDS = {"email": "contains(t, '@')", "phone": "contains(t, '+')",
         "handle": "(contains(t, '@') OR contains(t, 'at]') OR contains(t, 'at)'))"}

_SPAN = "struct<kind:int,start:int,stop:int,text:string,lhs:string,rhs:string>"
_NONE = f"cast(array() as array<{_SPAN}>)"


def _quote(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _found(kind: str) -> str:
    """SQL: spans of one generator over the column ``t``, with 24 characters before and 8 after."""
    p, k = _quote(PATTERNS[kind]), KINDS.index(kind)
    step = (
        "(acc, i) -> named_struct("
        f"'out', concat(acc.out, array(named_struct('kind', {k}, 'start', acc.at + length(s.gap[i]),"
        " 'stop', acc.at + length(s.gap[i]) + length(s.hit[i]), 'text', s.hit[i],"
        " 'lhs', right(s.gap[i], 24), 'rhs', left(s.gap[i + 1], 8)))),"
        " 'at', acc.at + length(s.gap[i]) + length(s.hit[i]))"
    )
    spans = (
        f"transform(array(named_struct('hit', regexp_extract_all(t, {p}, 0), 'gap', split(t, {p}, -1))),"
        f" s -> if(size(s.hit) = 0, {_NONE}, aggregate(sequence(0, size(s.hit) - 1),"
        f" named_struct('out', {_NONE}, 'at', 0), {step}).out))[0]"
    )
    return f"if({NEEDS[kind]}, {spans}, {_NONE})" if kind in NEEDS else f"if(t rlike '[0-9]', {spans}, {_NONE})"


_DIGITS = "regexp_replace(x.text, '[^0-9]', '')"
_LUHN = (
    f"transform(array({_DIGITS}), d -> if(length(d) = 0, false, aggregate(sequence(1, length(d)), 0, (acc, i) -> acc + "
    "if(i % 2 = 1, cast(substring(d, length(d) - i + 1, 1) as int),"
    " if(cast(substring(d, length(d) - i + 1, 1) as int) > 4, 2 * cast(substring(d, length(d) - i + 1, 1) as int) - 9,"
    " 2 * cast(substring(d, length(d) - i + 1, 1) as int)))) % 10 = 0))[0]"
)
_PARTS_OK = (
    "forall(split(x.text, '[.]'), p -> length(ltrim('0', p)) < 3 OR"
    " (length(ltrim('0', p)) = 3 AND cast(ltrim('0', p) as int) <= 255))"
)
_CHECKS = {
    "email": "true",
    "ip": _PARTS_OK,
    "card": _LUHN,
    "phone": f"length({_DIGITS}) between 9 and 15",
}
_ASSIGNED = r"(?i)(token|secret|passw(or)?d|api.?key|key)\"?\s*[=:]\s*\"?$"

FEATURES = {
    "kind_secret": "cast(x.kind = 4 as double)",
    "kind_number": "cast(x.kind = 5 as double)",
    "kind_handle": "cast(x.kind = 6 as double)",
    "length": "cast(length(x.text) as double)",
    "digits": f"cast(length({_DIGITS}) as double)",
    "letters": "cast(length(regexp_replace(x.text, '[^A-Za-z]', '')) as double)",
    "hex_only": "cast(x.text rlike '^[0-9a-f]+$' as double)",
    "capitals": "cast(length(regexp_replace(x.text, '[^A-Z]', '')) as double)",
    "dots": "cast(length(regexp_replace(x.text, '[^.]', '')) as double)",
    "gaps": "cast(length(regexp_replace(x.text, '[^ ()-]', '')) as double)",
    "at_sign": "cast(contains(x.text, '@') as double)",
    "luhn": f"cast({_LUHN} as double)",
    "plus_before": "cast(x.lhs like '%+' as double)",
    "named_before": "cast(x.lhs rlike '(?i)(token|secret|pass|key|auth)[^a-z]*$' as double)",
    "called_before": "cast(x.lhs rlike '(?i)(tel|phone|fax|mobile|call)[^a-z]*$' as double)",
    "quoted": "cast(x.lhs like '%\"' AND x.rhs like '\"%' as double)",
    "space_around": "cast((x.lhs = '' OR x.lhs like '% ') AND (x.rhs = '' OR x.rhs like ' %') as double)",
}


def _base_spans() -> str:
    return "concat(" + ", ".join(f"filter({_found(k)}, x -> {_CHECKS[k]})" for k in BASE) + ")"


def _loose_spans() -> str:
    return "concat(" + ", ".join(_found(k) for k in KINDS[4:]) + ")"


def _with_spans(d: DataFrame) -> DataFrame:
    """Adds ``_base`` and ``_loose`` to a frame with the text in ``t``."""
    return d.withColumn("_base", F.expr(_base_spans())).withColumn("_loose", F.expr(_loose_spans()))


# ---- fitting ------------------------------------------------------------------------------


def _tree_sql(lines: list[str], names: list[str]) -> str:
    """One regression tree (its printed form) as a CASE expression over the struct ``f``."""
    def node(at: int) -> tuple[str, int]:
        line = lines[at].strip()
        if line.startswith("Predict:"):
            return f"{float(line.split(':')[1])!r}D", at + 1
        i, bound = re.match(r"If \(feature (\d+) <= ([-\d.eE]+)\)", line).groups()
        yes, at = node(at + 1)
        no, at = node(at + 1)  # skips the matching Else
        return f"CASE WHEN f.{names[int(i)]} <= {float(bound)!r}D THEN {yes} ELSE {no} END", at

    return node(0)[0]


@dataclass(frozen=True)
class Scorer:
    """Boosted trees as SQL over the struct ``f`` of features, and thresholds by kind."""

    margin: str | None = None
    thresholds: dict[int, float] = field(default_factory=dict)

    def score(self) -> str:
        named = ", ".join(f"'{n}', {sql}" for n, sql in FEATURES.items())
        return f"transform(array(named_struct({named})), f -> 1D / (1D + exp(-2D * ({self.margin}))))[0]"

    def picked(self) -> str:
        """SQL over ``_loose``: (kind, start, stop, p) of the candidates over their thresholds."""
        if self.margin is None or not self.thresholds:
            return "cast(array() as array<struct<kind:int,start:int,stop:int,p:double>>)"
        over = " OR ".join(f"(y.kind = {k} AND y.p >= {t!r}D)" for k, t in sorted(self.thresholds.items()))
        scored = ("transform(_loose, x -> named_struct('kind', x.kind, 'start', x.start, 'stop', x.stop,"
                  f" 'p', {self.score()}))")
        return f"filter({scored}, y -> {over})"


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, precision: float = PRECISION) -> Scorer:
    """Fit trees on a bounded sample (smallest id hashes, and rare patterns) and thresholds on all documents."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    src = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("t"))
    strict = ("x.kind < 4 OR (x.kind = 4 AND x.lhs rlike " + _quote(_ASSIGNED) + ")"
              " OR exists(_base, b -> b.start = x.start AND b.stop = x.stop)")
    named = ", ".join(f"'{n}', {sql}" for n, sql in FEATURES.items())
    cand = _with_spans(src).select("id", F.explode(F.expr(
        f"transform(concat(_loose, _base), x -> named_struct('kind', x.kind, 'at', x.start,"
        f" 'label', cast({strict} as double), {named}))")).alias("c")).select("id", "c.*")
    # numbers only, one row a candidate of all documents; a third of the ids is not fitted
    cand = materialize(cand.withColumn("held", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(3)) == 0))
    ids = src.where("id IS NOT NULL").select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample_docs)
    ids = materialize(ids)  # at most sample_docs numbers: a proven bound for the broadcast
    names = list(FEATURES)
    fitted = cand.where("NOT held").join(F.broadcast(ids), "id", "left_semi")
    pattern = Window.partitionBy("kind", "label").orderBy(F.xxhash64(*names), *names)
    rare = cand.where("NOT held AND kind >= 4").select("kind", "label", *names).distinct().withColumn(
        "_n", F.row_number().over(pattern)).where(F.col("_n") <= RARE).drop("_n")
    rare = rare.subtract(fitted.select("kind", "label", *names)).withColumns(
        {"id": F.lit(None).cast("long"), "at": F.lit(None).cast("int")})
    cols = ["id", "at", "kind", "label", *names]
    fitted = materialize(fitted.select(cols).unionByName(rare.select(cols)))
    seen = {r[0] for r in fitted.select("label").distinct().collect()}
    if len(seen) < 2:
        return Scorer()
    vec = VectorAssembler(inputCols=names, outputCol="features")
    fitted = fitted.orderBy("id", "at", "kind", *names)
    model = GBTClassifier(labelCol="label", maxIter=8, maxDepth=3, stepSize=0.4, seed=7, maxBins=16).fit(
        vec.transform(fitted).select("features", "label"))
    trees = []
    for weight, tree in zip(model.treeWeights, model.trees):
        lines = [x for x in tree.toDebugString.splitlines()[1:] if x.strip()]
        trees.append(f"{float(weight)!r}D * ({_tree_sql(lines, names)})")
    scorer = Scorer(" + ".join(trees))
    loose = cand.where("kind >= 4").withColumn("f", F.struct(*names)).select(
        "kind", "label", F.expr(f"round(1D / (1D + exp(-2D * ({scorer.margin}))), 6)").alias("p"))
    table = loose.groupBy("kind", "p").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("good"))
    # a tree ensemble has few distinct scores: at most 8 ** trees, in practice some hundred
    counts = table.collect()
    found: dict[int, float] = {}
    for kind in range(4, len(KINDS)):
        n = good = 0.0
        for r in sorted((r for r in counts if r["kind"] == kind), key=lambda r: -r["p"]):
            n, good = n + r["n"], good + r["good"]
            if good / n >= precision:
                found[kind] = r["p"] - 1e-6
    return Scorer(scorer.margin, found)


# ---- finding and redacting ------------------------------------------------------------------


def find(docs: DataFrame, text: Column, scorer: Scorer) -> DataFrame:
    """Adds ``base_spans`` and ``all_spans``: arrays of (start, kind, stop), in order."""
    d = _with_spans(docs.withColumn("t", F.coalesce(text.cast("string"), F.lit(""))))
    d = d.withColumn("_picked", F.expr(scorer.picked()))
    apart = ("filter(_picked, y -> NOT exists(_base, b -> b.start < y.stop AND y.start < b.stop))")
    d = d.withColumn("_apart", F.expr(apart))
    better = ("z.start < y.stop AND y.start < z.stop AND (z.p > y.p OR (z.p = y.p AND"
              " (z.stop - z.start > y.stop - y.start OR (z.stop - z.start = y.stop - y.start AND"
              " (z.start < y.start OR (z.start = y.start AND z.kind < y.kind))))))")
    d = d.withColumn("_added", F.expr(f"filter(_apart, y -> NOT exists(_apart, z -> {better}))"))
    short = "transform({}, x -> named_struct('start', x.start, 'kind', x.kind, 'stop', x.stop))"
    return d.withColumn("base_spans", F.expr(f"array_sort({short.format('_base')})")).withColumn(
        "all_spans", F.expr(f"array_sort(concat({short.format('_base')}, {short.format('_added')}))")).drop(
        "_base", "_loose", "_picked", "_apart", "_added")


def joined(spans: str) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, x -> concat({names}[x.kind], ':', x.start, ':', x.stop)), ',')")


def report(docs: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 and spans of every row."""
    scorer = scorer or fit(docs)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text"))
    d = find(d, F.col("_text"), scorer)
    count = "cast(size(filter(base_spans, x -> x.kind = {})) as bigint)"
    return d.select(
        "doc_id", *[F.expr(count.format(i)).alias(f"n_{k}") for i, k in enumerate(BASE)],
        F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("all_spans").alias("spans"))


def redact(docs: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """``docs`` with every found span replaced by ``[KIND]`` (spans that overlap become one, named by the first).

    Where the table has ``n_chars``, it is the new text's length. A null text stays null.
    """
    scorer = scorer or fit(docs)
    cols = docs.columns
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"))
    d = find(d, F.col("_row.text"), scorer)
    names = "array(" + ", ".join(f"'[{k.upper()}]'" for k in KINDS) + ")"
    made = (
        "transform(array(aggregate(all_spans, named_struct('out', cast(array() as array<string>), 'at', 0),"
        " (acc, x) -> if(x.start < acc.at, named_struct('out', acc.out, 'at', greatest(acc.at, x.stop)),"
        f" named_struct('out', concat(acc.out, array(substring(t, acc.at + 1, x.start - acc.at), {names}[x.kind])),"
        " 'at', x.stop)))), r -> concat(array_join(r.out, ''), substring(t, r.at + 1)))[0]"
    )
    text = F.when(F.col("_row.text").isNull(), F.lit(None).cast("string")).when(
        F.size("all_spans") == 0, F.col("t")).otherwise(F.expr(made))
    d = d.withColumn("_new", text)
    out = []
    for c, kind in docs.dtypes:
        v = F.col("_row").getField(c)
        if c == "text":
            v = F.col("_new")
        elif c == "n_chars":
            v = F.when(F.col("_new").isNull(), v).otherwise(F.length("_new")).cast(kind)
        out.append(v.alias(c))
    return d.select(*out)
