"""Model evaluation and data-split helpers, all relational and distributed.

AUC and average precision aggregate by distinct score first (so ties are one
row), then need running sums in score order: those use the range-partitioned
cumulative sum of ranking.py instead of a single-partition window."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import rnd
from .ranking import global_cumsum, global_row_number
from .selection import medians


def _by_score(df: DataFrame, score: str, label: str) -> DataFrame:
    return df.filter(F.col(score).isNotNull()).groupBy(F.col(score).alias("s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("long").alias("neg"))


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Exact Mann-Whitney AUC, ties counted one half."""
    g = _by_score(df, score, label)
    c = global_cumsum(g, [F.col("s").asc()], {"_cneg": "neg"})
    # negatives strictly below s = running count up to s minus those at s
    part = c.select((F.col("pos") * ((F.col("_cneg") - F.col("neg")) + 0.5 * F.col("neg"))).alias("_u"),
                    "pos", "neg")
    t = part.agg(F.sum("_u").alias("u"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return t.select(rnd(F.try_divide(F.col("u"), F.col("p") * F.col("n")), 6).alias("roc_auc"))


def pr_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Average precision: sum over distinct thresholds of delta-recall x precision."""
    g = _by_score(df, score, label)
    c = global_cumsum(g, [F.col("s").desc()], {"_tp": "pos", "_fp": "neg"})
    precision = F.col("_tp") / (F.col("_tp") + F.col("_fp"))
    r = c.agg(F.sum(F.col("pos") * precision).alias("_s"), F.sum("pos").alias("_P"))
    return r.select(rnd(F.try_divide(F.col("_s"), F.col("_P")), 6).alias("pr_auc"))


def classification_report(df: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    """precision / recall / f1 / support per class plus accuracy, macro and
    weighted averages (0 when undefined)."""
    pred = F.when(F.col(score) >= threshold, 1).otherwise(0)
    c = df.select(F.col(label).cast("int").alias("y"), pred.alias("p")).agg(
        F.count_if((F.col("y") == 1) & (F.col("p") == 1)).alias("tp"),
        F.count_if((F.col("y") == 0) & (F.col("p") == 1)).alias("fp"),
        F.count_if((F.col("y") == 1) & (F.col("p") == 0)).alias("fn"),
        F.count_if((F.col("y") == 0) & (F.col("p") == 0)).alias("tn"))

    def prf(tp, fp, fn):
        p = F.coalesce(F.try_divide(tp.cast("double"), (tp + fp).cast("double")), F.lit(0.0))
        r = F.coalesce(F.try_divide(tp.cast("double"), (tp + fn).cast("double")), F.lit(0.0))
        f = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
        return p, r, f

    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    p1, r1, f1 = prf(tp, fp, fn)
    p0, r0, f0 = prf(tn, fn, fp)
    s1, s0 = tp + fn, tn + fp
    n = (s1 + s0).cast("double")
    rows = [("0", p0, r0, f0, s0), ("1", p1, r1, f1, s1),
            ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1),
            ("weighted avg", (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, s0 + s1),
            ("accuracy", (tp + tn) / n, (tp + tn) / n, (tp + tn) / n, s0 + s1)]
    structs = [F.struct(F.lit(k).alias("class"), rnd(p, 6).alias("precision"), rnd(r, 6).alias("recall"),
                        rnd(f, 6).alias("f1"), s.cast("long").alias("support")) for k, p, r, f, s in rows]
    return c.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


#: Labels whose cuts are looked for, and digests among which the driver looks for one, at most; digits of the digest that a pass tells.
MOST_LABELS, CUT_ROWS, CUT_DIGITS = 32, 20_000, 3


def stratified_split(df: DataFrame, id_col: str, label: str, test_fraction: float = 0.2) -> DataFrame:
    """Deterministic stratified split: within each label, rows ordered by md5(id); the first round(f * n_label) go to test.

    A label's test rows are those up to a certain digest. It is found by counting rows by the first digits of their
    digests, so no row is moved, and each is told by its own id. Where rows of one id lie on both sides of the cut, or
    labels are many, a distributed global rank tells them."""
    digest = F.md5(F.col(id_col).cast("string"))
    known = df.filter(F.col(label).isNotNull())
    cuts = _digest_cuts(known.select(F.col(label).alias("label"), digest.alias("digest")), test_fraction)
    if cuts is None:
        return _ranked_split(df, id_col, label, test_fraction)
    is_test = F.lit(False)
    for value, cut in cuts:
        is_test = is_test | ((F.col(label) == F.lit(value)) & (F.coalesce(digest, F.lit("")) <= cut))  # null ids come first
    return known.select(label, *[c for c in df.columns if c != label], F.when(is_test, "test").otherwise("train").alias("split"))


def _digest_cuts(keys: DataFrame, test_fraction: float) -> list[tuple[object, str]] | None:
    """(label, the greatest digest of its test rows) of labels that have any; or None where digests alone don't tell them."""
    n = F.count(F.lit(1))
    sizes = keys.groupBy("label").agg(F.count_if(F.col("digest").isNull()).alias("nulls"), F.round(F.lit(test_fraction) * n).cast("long").alias("wanted"))
    sizes = sizes.limit(MOST_LABELS + 1).collect()
    if len(sizes) > MOST_LABELS or any(0 < r["wanted"] < r["nulls"] or r["label"] != r["label"] for r in sizes):  # NaN is no key
        return None
    cuts = {r["label"]: "" for r in sizes if 0 < r["wanted"] == r["nulls"]}
    todo = {r["label"]: ("", r["wanted"] - r["nulls"]) for r in sizes if r["wanted"] > r["nulls"]}  # the cut's first digits, and rows up to it that have them
    digits, rows = 0, CUT_ROWS + 1
    while todo:
        digits = 32 if rows <= CUT_ROWS else min(32, digits + CUT_DIGITS)
        within = F.lit(False)
        for value, (head, _) in todo.items():
            within = within | ((F.col("label") == F.lit(value)) & F.col("digest").startswith(head))
        found: dict = {value: [] for value in todo}
        for r in keys.filter(within).groupBy("label", F.substring("digest", 1, digits).alias("head")).agg(n.alias("n")).collect():  # 4096 heads a label, or CUT_ROWS
            found[r["label"]].append((r["head"], r["n"]))
        rows = 0
        for value, (_, wanted) in list(todo.items()):
            for head, count in sorted(found[value]):
                if wanted <= count:
                    break
                wanted -= count
            if wanted == count:
                cuts[value] = head + "g"  # all that begin so: the letter is behind all digits
                del todo[value]
            elif digits == 32:
                return None
            else:
                todo[value], rows = (head, wanted), max(rows, count)
    return list(cuts.items())


def _ranked_split(df: DataFrame, id_col: str, label: str, test_fraction: float) -> DataFrame:
    """The rank within a label is a distributed global rank minus the rows of smaller labels."""
    h = F.md5(F.col(id_col).cast("string"))
    d = df.withColumn("_h", h)
    counts = d.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy(label)  # one row per label value
    counts = counts.withColumn("_before", F.sum("_n").over(w) - F.col("_n"))
    ranked = global_row_number(d, [F.col(label).asc(), F.col("_h").asc(), F.col(id_col).asc()], "_grn")
    ranked = ranked.join(F.broadcast(counts), label)
    rank = F.col("_grn") - F.col("_before")
    is_test = rank <= F.round(F.lit(test_fraction) * F.col("_n"))
    return ranked.withColumn("split", F.when(is_test, "test").otherwise("train")) \
                 .drop("_h", "_n", "_before", "_grn")


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced weights n / (2 * n_class) via the per-class count."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    counts = counts.withColumn(out, F.sum("_nc").over(Window.partitionBy()) / (2.0 * F.col("_nc")))
    return df.join(F.broadcast(counts.select(label, out)), label, "left")  # <= 2 rows


def impute_scale_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: exact median (imputation value), mean and population std."""
    middle = medians(df, cols)  # all columns in the same passes, no column's values in one task
    stats = [F.struct(F.lit(c).alias("column"), rnd(F.lit(middle[c]).cast("double"), 6).alias("median"), rnd(F.avg(c), 6).alias("mean"), rnd(F.stddev_pop(c), 6).alias("std")) for c in cols]
    return df.agg(*[s.alias(f"s{i}") for i, s in enumerate(stats)]).select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(cols))])))


def score_parity(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(rnd(F.max(F.abs(F.col(a) - F.col(b))), 6).alias("max_abs_diff"))
