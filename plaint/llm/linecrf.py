"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Potentials look at the line, at its neighbours and at the step from one label to the next;
they are fitted by conditional likelihood on a bounded sample of labelled documents, whose lines take the document's
label. Forward-backward gives each line's probability of being good, and the mean of these, weighted by the lines'
lengths, is the document's score.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, small_batches, table, texts_of

#: Fixed by the contract: at this score or above a document counts as good.
GOOD_SCORE = 0.3
#: Bounds of the labelled sample: documents, code points of one, lines of one (longer ones are not learned from).
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_LINES = 6000, 20_000, 400
#: Documents of the rarer label count as if they were so many times as many, at most as many as those of the other.
LIFT = 3.0
#: Classes that each feature is cut into by quantiles of the sample, fitting steps, and the weight of the penalty.
BINS, STEPS, RATE, PENALTY = 8, 200, 0.1, 1e-4

FEATURES = ("length", "upper", "symbols", "marks", "digits", "other", "word_size", "sentences", "commas", "foreign", "long_words", "short_words", "again", "repeats", "stutter", "lone", "lines", "place")
#: Features of the lines before and after that a line sees as well.
NEIGHBOURS = ("upper", "symbols", "marks", "word_size", "again", "repeats", "stutter", "lone")
_LOWER, _UPPER, _DIGIT, _SPACE, _SYMBOL, _MARK, _STOP, _COMMA, _OTHER, _LEAD, _TAIL, _KINDS = range(12)


def _kinds() -> np.ndarray:
    out = np.full(256, _OTHER, np.int64)
    for kind, chars in ((_LOWER, "abcdefghijklmnopqrstuvwxyz"), (_UPPER, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (_DIGIT, "0123456789"), (_SPACE, " \t\n\x0b\x0c\r"),
                        (_SYMBOL, "#*$%&|<>"), (_MARK, "!?"), (_STOP, "."), (_COMMA, ",;:")):
        out[[ord(c) for c in chars]] = kind
    out[0x80:0xC0] = _TAIL
    out[0xC0:] = _LEAD
    return out


_KIND = _kinds()
_POWERS = np.cumprod(np.full(32, 0x9E3779B97F4A7C15, np.uint64))


def _again(key: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(key.size, np.bool_)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, weights, offsets): a row for each line of the texts, its code points (1 at least), and where a text's lines begin.

    Lines end at newlines; a text has one line at least, so an empty one has one without characters."""
    data = "\n".join(texts).encode("utf-8", "surrogatepass") + b"\n"
    a = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(a == 10)
    starts = np.append(0, ends[:-1] + 1)
    n_lines = np.array([t.count("\n") + 1 for t in texts], np.int64)
    offsets = np.concatenate(([0], np.cumsum(n_lines)))
    n, doc = ends.size, np.repeat(np.arange(len(texts)), n_lines)
    line = np.repeat(np.arange(n), ends - starts + 1)
    kind = _KIND[a]
    kinds = np.bincount(line * _KINDS + kind, minlength=n * _KINDS).reshape(n, _KINDS).astype("f8")
    kinds[:, _SPACE] -= 1  # the newline
    chars = kinds.sum(1) - kinds[:, _TAIL]
    inside = chars - kinds[:, _SPACE]
    letters = kinds[:, _LOWER] + kinds[:, _UPPER] + kinds[:, _LEAD]
    # words: their sizes, and hashes of up to 32 bytes
    solid = np.append(False, kind != _SPACE)
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    first, past = edge[::2], edge[1::2]
    again = np.zeros(n)
    repeats, long_words, short_words, stutter, lone = (np.zeros(n) for _ in range(5))
    words = np.zeros(n)
    if first.size:
        size = past - first
        owner = line[first]
        place = np.arange(a.size) - np.repeat(np.append(0, first), np.diff(np.append(np.append(0, first), a.size)))
        value = (a.astype(np.uint64) + np.uint64(1)) * _POWERS[place & 31] * solid[1:]
        word = np.add.reduceat(value, first)
        word = (word ^ (word >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        words = np.bincount(owner, minlength=n).astype("f8")
        long_words = np.bincount(owner, weights=size > 12, minlength=n)
        short_words = np.bincount(owner, weights=size <= 3, minlength=n)
        lone = np.bincount(owner, weights=(size == 1) & np.isin(kind[first], (_SYMBOL, _MARK, _STOP, _COMMA, _OTHER)), minlength=n)
        stutter = np.bincount(owner[1:], weights=(word[1:] == word[:-1]) & (doc[owner[1:]] == doc[owner[:-1]]), minlength=n)
        text = doc[owner].astype(np.uint64) * np.uint64(0x94D049BB133111EB)
        if word.size > 2:
            three = word[:-2] * np.uint64(31) + (word[1:-1] ^ (word[1:-1] >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + (word[2:] >> np.uint64(7)) * np.uint64(0x9E3779B97F4A7C15)
            three = (three ^ (three >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9) + text[:-2]
            within = text[:-2] == text[2:]
            found = _again(three[within])
            repeats = np.bincount(owner[:-2][within], weights=found, minlength=n)
        whole = np.zeros(n, np.uint64)
        heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        rank = (np.arange(owner.size) - np.repeat(heads, np.diff(np.append(heads, owner.size)))).astype(np.uint64)
        whole[owner[heads]] = np.add.reduceat(word * (rank * np.uint64(2) + np.uint64(0xD6E8FEB86659FD93)), heads)
        again = _again((whole ^ (whole >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9) + doc.astype(np.uint64) * np.uint64(0x94D049BB133111EB)) & (words > 0)
    per_char, per_word, per_letter = 1 / np.maximum(inside, 1), 1 / np.maximum(words, 1), 1 / np.maximum(letters, 1)
    rank = np.arange(n) - offsets[doc]
    out = np.stack([
        np.log2(chars + 1), kinds[:, _UPPER] * per_letter, kinds[:, _SYMBOL] * per_char, kinds[:, _MARK] * per_char, kinds[:, _DIGIT] * per_char, kinds[:, _OTHER] * per_char,
        inside * per_word, kinds[:, _STOP] * per_word, kinds[:, _COMMA] * per_word, kinds[:, _LEAD] * per_letter, long_words * per_word, short_words * per_word,
        again.astype("f8"), repeats * per_word, stutter * per_word, lone * per_word, np.log2(n_lines[doc]), np.minimum(rank, 2) + 3.0 * (rank == n_lines[doc] - 1)], 1)
    return out, np.maximum(chars, 1.0), offsets


@dataclass
class Model:
    """Quantile cuts of the features, a weight for each class of each feature (own, before, after), and for each step between labels."""

    cuts: list[np.ndarray]
    own: np.ndarray
    around: np.ndarray
    steps: np.ndarray

    def classes(self, features: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, features[:, i], side="right") for i, c in enumerate(self.cuts)], 1) if len(features) else np.zeros((0, len(self.cuts)), np.int64)


def _columns(classes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions of a line's weights in (own, before, after) laid end to end; the class BINS stands for no such line."""
    near = classes[:, [FEATURES.index(f) for f in NEIGHBOURS]]
    before, after = np.full_like(near, BINS), np.full_like(near, BINS)
    before[1:], after[:-1] = near[:-1], near[1:]
    before[offsets[:-1]] = BINS
    after[offsets[1:] - 1] = BINS
    own = classes + np.arange(len(FEATURES)) * (BINS + 1)
    base = len(FEATURES) * (BINS + 1)
    wide = np.arange(len(NEIGHBOURS)) * (BINS + 1) + base
    return np.concatenate([own, before + wide, after + wide + len(NEIGHBOURS) * (BINS + 1)], 1)


def forward_backward(unary: np.ndarray, offsets: np.ndarray, steps: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(P(line is good), log Z of each text, expected counts of the four steps, summed over the texts by ``weight``).

    ``unary`` is a line's score for good against bad. Texts go in step, so that numpy works on many at a time; both
    passes are normalised at each line, which keeps them in range on texts of any length."""
    sizes = np.diff(offsets)
    weight = np.ones(sizes.size) if weight is None else weight
    order = np.argsort(-sizes, kind="stable")
    begin, sizes = offsets[:-1][order], sizes[order]
    n = unary.size
    top = np.maximum(unary, 0)
    emit = np.stack([np.exp(-top), np.exp(unary - top)], 1)
    move = np.exp(steps - steps.max())
    alpha, scale, beta = np.empty((n, 2)), np.empty(n), np.ones((n, 2))
    active = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if sizes.size else 0), side="left")  # texts with more than t lines
    for t, m in enumerate(active):
        at = begin[:m] + t
        x = emit[at] if t == 0 else (alpha[at - 1] @ move) * emit[at]
        s = x.sum(1)
        alpha[at], scale[at] = x / s[:, None], s
    for t in range(len(active) - 2, -1, -1):
        at = begin[: active[t + 1]] + t
        beta[at] = (emit[at + 1] * beta[at + 1]) @ move.T / scale[at + 1][:, None]
    good = alpha * beta
    good = good[:, 1] / good.sum(1)
    inner = np.ones(n, np.bool_)
    inner[offsets[:-1]] = False
    at = np.flatnonzero(inner)
    pair = alpha[at - 1][:, :, None] * move * (emit[at] * beta[at] / scale[at][:, None])[:, None, :]
    log_z = np.add.reduceat(np.log(scale) + top + steps.max() * inner, offsets[:-1]) if len(offsets) > 1 else np.zeros(0)
    return good, log_z, (pair * np.repeat(weight, np.diff(offsets))[at][:, None, None]).sum(0)


def fit(features: np.ndarray, offsets: np.ndarray, label: np.ndarray) -> Model:
    """Conditional likelihood of the labels (one a text), by gradient steps with running moments."""
    cuts = []
    for i in range(len(FEATURES)):
        q = np.unique(np.quantile(features[:, i], np.arange(1, BINS) / BINS))
        tail = np.unique(np.quantile(features[:, i], [0.9, 0.97]))
        cuts.append(np.unique(np.append(q, tail))[-(BINS - 1):])
    model = Model(cuts, np.zeros((len(FEATURES), BINS + 1)), np.zeros((2, len(NEIGHBOURS), BINS + 1)), np.zeros((2, 2)))
    columns = _columns(model.classes(features), offsets)
    width = model.own.size + model.around.size
    sizes = np.diff(offsets)
    y = np.repeat(label.astype("f8"), sizes)
    n = np.bincount(label, minlength=2)
    weight = np.where(n[label] < n[1 - label], np.minimum(LIFT, n[1 - label] / n[label]), 1.0)
    weight /= weight.sum()
    by_line = np.repeat(weight, sizes)
    seen = np.array([[np.sum(((sizes - 1) * weight)[label == 0]), 0], [0, np.sum(((sizes - 1) * weight)[label == 1])]], "f8")
    theta, m, v = np.zeros(width + 4), np.zeros(width + 4), np.zeros(width + 4)
    for step in range(1, STEPS + 1):
        good, _, pair = forward_backward(theta[columns].sum(1), offsets, theta[-4:].reshape(2, 2), weight)
        gradient = np.empty_like(theta)
        gradient[:width] = np.bincount(columns.ravel(), weights=np.repeat((good - y) * by_line, columns.shape[1]), minlength=width)
        gradient[width:] = (pair - seen).ravel()
        gradient += PENALTY * theta
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient**2
        theta -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(cuts, theta[: model.own.size].reshape(model.own.shape), theta[model.own.size: width].reshape(model.around.shape), theta[-4:].reshape(2, 2))


def line_scores(model: Model, features: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """P(good) of every line."""
    theta = np.concatenate((model.own.ravel(), model.around.ravel()))
    unary = theta[_columns(model.classes(features), offsets)].sum(1)
    return forward_backward(unary, offsets, model.steps)[0]


def document_scores(model: Model | None, texts: list[str]) -> np.ndarray:
    """The lines' P(good), averaged with their lengths as weights; 0.5 without a model."""
    if model is None or not texts:
        return np.full(len(texts), 0.5)
    features, weights, offsets = line_features(texts)
    good = line_scores(model, features, offsets)
    return np.clip(np.add.reduceat(good * weights, offsets[:-1]) / np.add.reduceat(weights, offsets[:-1]), 0.0, 1.0)


def training_rows(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_DOCS) -> DataFrame:
    """(text, quality) of at most ``bound`` labelled documents: those with the smallest id hashes.

    Rows without id, label or text, and with a label other than 0 and 1, are left out; so are texts beyond SAMPLE_CHARS or SAMPLE_LINES."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality").withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)))
    total = known.count()
    near = known.filter(F.col("h") < int((1 << 40) * min(1.0, 2.0 * bound / max(total, 1)))).orderBy("h", "doc_id", "quality").limit(2 * bound)
    rows = docs.select("doc_id", "text").filter((F.length("text") <= SAMPLE_CHARS) & (F.length(F.regexp_replace("text", "[^\n]+", "")) < SAMPLE_LINES))
    return rows.join(F.broadcast(near), "doc_id").orderBy("h", "doc_id", "text", "quality").limit(bound).select("text", "quality")


def learn(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_DOCS) -> Model | None:
    """The model of the sample; None unless it holds rows of both labels. Features come from tasks, numbers of bounded size reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            features, _, offsets = line_features(texts_of(batch))
            lines = [features[a:b].astype("f4").tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary()), batch.column(1).cast(pa.int32())], names=["lines", "quality"])

    rows = small_batches(training_rows(docs, labels, bound)).mapInArrow(run, "lines binary, quality int").toArrow()
    label = rows.column(1).to_numpy()
    if len(set(label.tolist())) < 2:
        return None
    parts = [np.frombuffer(x, "f4").reshape(-1, len(FEATURES)) for x in rows.column(0).to_pylist()]
    return fit(np.concatenate(parts).astype("f8"), np.concatenate(([0], np.cumsum([len(p) for p in parts]))), label)


def score(df: DataFrame, model: Model | None, text: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """(row, score) for each row of ``df``: ``row`` is a struct of its columns (all, or ``keep``), so that no name can clash.

    Null text counts as empty; a text has one line at least, so empty texts get the score of one line without characters.
    Without a model every score is 0.5. Repeated rows get equal scores."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # some hundred numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", 4 << 20):
            got = document_scores(shared.value, texts_of(batch, "_text"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], names=["row", "score"])

    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in keep or df.columns]).alias("row"), F.col(f"`{text}`").cast("string").alias("_text"))
    return small_batches(rows).mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, score double")


def op12_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score; rows whose crc32(doc_id) is a multiple of 5 are never learned from. A null doc_id is not held out."""
    docs = table(spark, sf_dir, "documents")
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    model = learn(docs.filter(rest != 0), table(spark, sf_dir, "labels"))
    got = score(docs.select("doc_id", "text"), model, keep=("doc_id",))
    held = F.coalesce(F.pmod(F.crc32(F.col("row.doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
    return got.select("row.doc_id", held.alias("held_out"), "score", (F.col("score") >= GOOD_SCORE).cast("int").alias("predicted"))
