"""Quality rules: text statistics in Spark expressions and a decision list learned from labelled ones.

The main path is made of DataFrame functions only. Fitting looks at a bounded sample of labelled rows on the driver
and returns an ordered list of threshold conjunctions, which becomes one CASE WHEN expression.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, table

#: Fixed by the contract.
SYMBOLS, MIN_WORDS, MAX_REPEAT_PERCENT = "#*$%&|<>", 50, 50
#: Bound of the labelled sample that the list is learned from.
SAMPLE_ROWS = 6000
MAX_RULES, MAX_CONDITIONS, MIN_PRECISION, MIN_COVER = 12, 4, 0.95, 8
#: Bits of a word position in the packed sort key; the rest is the window's hash.
POSITION_BITS = 27

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_upper", "n_marks", "n_chars_all")


def _words_at(i: Column) -> list[Column]:
    return [F.get("_w", i + k) for k in range(3)]


def _start(key: Column) -> Column:
    return key.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).cast("int")


def _neighbours() -> Column:
    """For each of the sorted packed keys ``_key`` (a window's hash bits above its position) against the one before: 0 if the
    bits differ, 1 if the windows' words are equal, 2 if only the bits are."""
    def told(k: Column, i: Column) -> Column:
        before = F.get("_key", i - 1)
        same = [a == b for a, b in zip(_words_at(_start(before)), _words_at(_start(k)))]
        return F.when((i == 0) | (F.shiftright(before, POSITION_BITS) != F.shiftright(k, POSITION_BITS)), F.lit(0)).when(same[0] & same[1] & same[2], F.lit(1)).otherwise(F.lit(2))

    return F.transform("_key", told)


def _repeated_starts() -> Column:
    """Starts of the 3-word windows that occur twice or more, from ``_w`` (words), ``_key`` and ``_near`` (see above).

    Equal windows are neighbours after the sort of the primitive keys, unless another window has the same bits; then, and
    where positions outgrow their bits, the windows are sorted by their words."""
    equal = F.lit(1)
    fast = F.transform(F.filter("_key", lambda k, i: (F.get("_near", i) == equal) | (F.coalesce(F.get("_near", i + 1), F.lit(0)) == equal)), _start)

    def repeated(z: Column) -> Column:
        def same(x: Column, y: Column) -> Column:
            return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))

        return F.transform(F.filter(z, lambda x, i: same(F.get(z, i - 1), x) | same(x, F.get(z, i + 1))), lambda x: x["at"])

    windows = F.sort_array(F.transform(F.sequence(F.lit(0), F.size("_w") - 3), lambda i: F.struct(*[c.alias(x) for c, x in zip(_words_at(i), "abc")], i.alias("at"))))
    exact = F.get(F.transform(F.array(windows), repeated), F.lit(0))
    unsure = F.array_contains("_near", 2) | (F.size("_w") >= 1 << POSITION_BITS if POSITION_BITS < 31 else F.lit(False))
    return F.sort_array(F.when(unsure, exact).otherwise(fast))


def with_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """(row, the statistics) for each row of ``df``: ``row`` is a struct of all its columns, so that no name can clash.

    Words are runs of other characters than the six ASCII white-space ones. Null text counts as empty: all statistics are 0."""
    ws = r"[ \t\n\x0B\f\r]+"
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("_t"))
    rows = rows.withColumn("_trim", F.btrim("_t", F.lit(WHITE))).withColumn("_w", F.when(F.col("_trim") == "", F.array().cast("array<string>")).otherwise(F.split("_trim", ws, -1)))
    n = F.size("_w")
    low = F.lit((1 << (63 - POSITION_BITS)) - 1)
    keys = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.shiftleft(F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)).bitwiseAND(low), POSITION_BITS).bitwiseOR(i.cast("long"))))
    rows = rows.withColumn("_key", F.sort_array(F.coalesce(keys, F.array().cast("array<bigint>"))))
    rows = rows.withColumn("_near", _neighbours()).withColumn("_at", _repeated_starts()).withColumn("_lines", F.filter(F.split("_t", "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)) != ""))
    gaps = F.aggregate(F.sequence(F.lit(1), F.size("_at") - 1), F.lit(0).cast("long"), lambda s, i: s + F.least(F.lit(3), F.get("_at", i) - F.get("_at", i - 1)))
    repeat = F.when(F.size("_at") == 0, F.lit(0).cast("long")).when(F.size("_at") == 1, F.lit(3).cast("long")).otherwise(gaps + 3)
    length = F.length("_t")
    stats = [
        n.cast("long").alias("n_words"), F.length(F.translate("_t", WHITE, "")).cast("long").alias("word_chars"),
        (length - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"), repeat.alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"), (length - F.length(F.regexp_replace("_t", r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
        (length - F.length(F.translate("_t", "!?", ""))).cast("long").alias("n_marks"), length.cast("long").alias("n_chars_all")]
    # a generator, so that a later filter or projection on the statistics can't be rewritten into many copies of these expressions
    return rows.select("row", F.inline(F.array(F.struct(*stats))))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


#: Features that rules may test: (name, numerator, denominator); a zero denominator gives 0.
RATIOS = (
    ("mean_word", "word_chars", "n_words"), ("symbol_share", "n_symbols", "word_chars"), ("dup_line_share", "n_dup_lines", "n_lines"),
    ("repeat_share", "n_repeat_words", "n_words"), ("upper_share", "n_upper", "word_chars"), ("mark_share", "n_marks", "n_words"), ("line_words", "n_words", "n_lines"),
)
FEATURES = tuple(r[0] for r in RATIOS) + ("n_words", "n_symbols", "n_dup_lines", "n_repeat_words")


def feature(name: str) -> Column:
    for k, a, b in RATIOS:
        if k == name:
            return F.when(F.col(b) == 0, F.lit(0.0)).otherwise(F.col(a) / F.col(b))
    return F.col(name).cast("double")


@dataclass(frozen=True)
class Rule:
    """Reject if all conditions (feature, ">" or "<=", threshold) hold."""

    conditions: tuple[tuple[str, str, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, op, at in self.conditions:
            out = out & (feature(name) > at if op == ">" else feature(name) <= at)
        return out

    def matches(self, row: dict[str, float]) -> bool:
        return all(row[n] > at if op == ">" else row[n] <= at for n, op, at in self.conditions)


def verdict(rules: list[Rule]) -> Column:
    """The ordered list as one expression: the first rule that holds rejects, otherwise the row is kept."""
    out = None
    for r in rules:
        out = F.when(r.column(), F.lit(False)) if out is None else out.when(r.column(), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def _grow(rows: list[dict], bad: list[bool], cuts: dict[str, list[float]]) -> Rule | None:
    """Adds the condition with the most information gain until no good row is covered."""
    live, conditions = list(range(len(rows))), []
    while len(conditions) < MAX_CONDITIONS:
        p, n = sum(bad[i] for i in live), sum(not bad[i] for i in live)
        if not p or not n:
            break
        before, best = math.log2(p / (p + n)), (1e-9, None)
        for name in FEATURES:
            values = sorted((rows[i][name], bad[i]) for i in live)
            k, pp = 0, 0
            for at in cuts[name]:
                while k < len(values) and values[k][0] <= at:
                    pp += values[k][1]
                    k += 1
                for op, q, m in (("<=", pp, k - pp), (">", p - pp, n - (k - pp))):
                    if q and q >= MIN_COVER / 2 and (gain := q * (math.log2(q / (q + m)) - before)) > best[0]:
                        best = (gain, (name, op, at))
        if best[1] is None:
            break
        conditions.append(best[1])
        one = Rule((best[1],))
        live = [i for i in live if one.matches(rows[i])]
    return Rule(tuple(conditions)) if conditions else None


def _prune(rule: Rule, rows: list[dict], bad: list[bool]) -> tuple[Rule, float, int]:
    """The prefix of the conditions with the best (p - n) / (p + n) on held-back rows, its precision there and its cover."""
    best = (-2.0, rule, 0.0, 0)
    for k in range(1, len(rule.conditions) + 1):
        cut = Rule(rule.conditions[:k])
        hit = [bad[i] for i, r in enumerate(rows) if cut.matches(r)]
        p, n = sum(hit), len(hit) - sum(hit)
        worth = (p - n) / (p + n) if hit else -1.0
        if worth > best[0]:
            best = (worth, cut, p / (p + n) if hit else 0.0, p)
    return best[1], best[2], best[3]


def learn_rules(rows: list[dict]) -> list[Rule]:
    """Sequential covering: grow a rule on two thirds of the rows, prune it on the rest, keep it while it is precise there, drop what it covers.

    ``rows`` are feature values with ``bad`` (boolean). Without rows of both kinds the list is empty."""
    rows, rules = list(rows), []
    while len(rules) < MAX_RULES:
        grow = [r for i, r in enumerate(rows) if i % 3]
        held = [r for i, r in enumerate(rows) if not i % 3]
        if not any(r["bad"] for r in grow) or all(r["bad"] for r in grow):
            break
        cuts = {}
        for name in FEATURES:
            values = sorted({r[name] for r in grow})
            picks = sorted({int(i * (len(values) - 2) / 63) for i in range(64)}) if len(values) > 1 else []
            cuts[name] = [(values[i] + values[i + 1]) / 2 for i in picks]
        rule = _grow(grow, [r["bad"] for r in grow], cuts)
        if rule is None:
            break
        rule, precision, cover = _prune(rule, held, [r["bad"] for r in held])
        if precision < MIN_PRECISION or cover < MIN_COVER:
            break
        rules.append(rule)
        rows = [r for r in rows if not rule.matches(r)]
    return rules


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_ROWS) -> list[dict]:
    """At most ``bound`` labelled rows (those with the smallest id hashes) with their features; rows without label or id are left out."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "quality").withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)))
    total = known.count()
    if not total:
        return []
    near = known.filter(F.col("h") < int((1 << 40) * min(1.0, 1.2 * bound / total))).orderBy("h", "doc_id", "quality").limit(bound)
    rows = docs.select("doc_id", "text").join(F.broadcast(near), "doc_id")
    got = with_stats(rows).filter(~base_failed()).select("row.doc_id", (F.col("row.quality") == 0).alias("bad"), "row.h", *[feature(f).alias(f) for f in FEATURES])
    return sorted((r.asDict() for r in got.limit(2 * bound).collect()), key=lambda r: (r["h"], r["doc_id"]))


def fit(docs: DataFrame, labels: DataFrame) -> list[Rule]:
    return learn_rules(labelled_sample(docs, labels))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics of every document, the base check, and the learned list's verdict."""
    docs = table(spark, sf_dir, "documents")
    rules = fit(docs, table(spark, sf_dir, "labels"))
    stats = with_stats(docs.select("doc_id", "text"))
    return stats.select("row.doc_id", *BASE, base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept"))
