"""Toxicity: a factorization machine over hashed terms.

``score = sigmoid(w0 + sum w_i + sum_{i<j} <v_i, v_j>)`` over the distinct terms of a text.  The pairwise
part learns interactions (an insult next to a group mention) that additive weights miss.  Terms are the
lower-cased words and their 4- and 5-letter prefixes, hashed to 32 bits; prefixes let inflected forms
share a weight.

Fitting reads at most ``max_rows`` labelled rows of together at most ``max_entries`` terms, chosen by the hash
of the id (the documented bounds of the fitting sample).  Kept are the terms with the highest chi-square in
that sample.  A word that is neutral alone may tell beside another one: what the machine of those terms leaves
unexplained is therefore tested against every pair of the ``frequent`` most frequent terms, and the terms of
pairs that tell join the fit, however neutral they are alone.  Together they are at most ``max_terms``, so the
broadcast model has a fixed largest size (``max_terms * (factors + 1)`` floats).  Terms are counted and chosen by Spark; the driver gets the chosen
terms and two bytes for each that a sampled row holds.  Scoring is one map over all documents and whole
texts: no shuffle, a few megabytes a task whatever the corpus.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stage, text_of

MAX_FIT_ROWS = 12_000
MAX_FIT_ENTRIES = 8_000_000
MAX_TERMS = 1 << 15
# Of these, the most frequent ones whose pairs are tested; fewer rows than MIN_ROWS teach nothing about a term.
FREQUENT_TERMS = 1 << 11
MIN_ROWS = 3
# Chi-square of one degree of freedom at p = 0.001, for single terms, and at 0.001 over all the
# (two million) pairs, for pairs.
MIN_CHI_SQUARE = 10.83
MIN_PAIR_CHI_SQUARE = 38.0
# Largest log loss of the model with pair terms, as a share of that without, at which it is taken.
MIN_GAIN = 0.8
FACTORS = 4
PREFIXES = (4, 5)
# Words whose term rows a worker remembers; a full cache starts afresh.
MAX_CACHED = 200_000

_WORD = re.compile(r"[^\W\d_]+")


def word_terms(word: str) -> list[int]:
    """Hashed terms of a lower-case word: itself and its prefixes."""
    forms = {"w:" + word} | {f"p{n}:" + word[:n] for n in PREFIXES if len(word) >= n}
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) for f in forms]


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


@dataclass(frozen=True)
class Model:
    """``terms`` is sorted; row i of ``weights`` / ``factors`` belongs to ``terms[i]``."""

    terms: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, rows: np.ndarray) -> float:
        if not len(rows):
            return float(self.bias)
        v = self.factors[rows]
        s = v.sum(0)
        return float(self.bias + self.weights[rows].sum() + 0.5 * float(s @ s - (v * v).sum()))


class _Rows(dict):
    """word -> rows of the model its terms hit (most words hit none)."""

    def __init__(self, terms: np.ndarray):
        self.at = {int(t): i for i, t in enumerate(terms)}

    def __missing__(self, word: str) -> tuple:
        if len(self) >= MAX_CACHED:
            self.clear()
        hit = self[word] = tuple(i for t in word_terms(word) if (i := self.at.get(t)) is not None)
        return hit


def _chi_square(with_pos, with_neg, pos, neg):
    """2x2 chi-square of (term present, label) per term; the counts are arrays or columns."""
    n, without_pos, without_neg = pos + neg, pos - with_pos, neg - with_neg
    below = (with_pos + with_neg) * (without_pos + without_neg) * (pos * neg)
    return n * (with_pos * without_neg - with_neg * without_pos) ** 2 / (below + 1e-9)


def term_array(text: str) -> np.ndarray:
    """Sorted distinct hashed terms of a text."""
    return np.unique(np.array([t for w in words_of(text) for t in word_terms(w)], dtype=np.uint32))


def choose_terms(terms: np.ndarray, in_all: np.ndarray, in_pos: np.ndarray, pos: float, neg: float,
                 max_terms: int = MAX_TERMS, frequent: int = FREQUENT_TERMS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(terms, telling, common): sorted terms that tell by themselves (at most ``max_terms - frequent``) or are
    among the ``frequent`` most frequent ones, and a mask for either kind."""
    usable = in_all >= MIN_ROWS
    value = np.where(usable, _chi_square(in_pos, in_all - in_pos, pos, neg), -1.0)
    tells, common = np.zeros(len(terms), bool), np.zeros(len(terms), bool)
    common[np.lexsort((terms, -in_all))[:frequent]] = True
    tells[np.lexsort((terms, -value))[:max_terms - frequent]] = True
    tells &= value >= MIN_CHI_SQUARE
    common &= usable
    at = np.flatnonzero(tells | common)
    at = at[np.argsort(terms[at], kind="stable")]
    return terms[at], tells[at], common[at]


def rows_of(found: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Positions in the sorted ``terms`` of those that occur in ``found``."""
    if not len(terms):
        return np.empty(0, np.uint16)
    at = np.minimum(np.searchsorted(terms, found), len(terms) - 1)
    return at[terms[at] == found].astype(np.uint16)


def fit(texts: list[str], labels: list[int], max_terms: int = MAX_TERMS, frequent: int = FREQUENT_TERMS, **settings) -> Model:
    """The model of a few texts in memory, by the same choice of terms as ``fit_model``."""
    found = [term_array(x) for x in texts]
    y = np.asarray(labels, dtype=np.float64)
    terms, inverse = np.unique(np.concatenate([*found, np.empty(0, np.uint32)]), return_inverse=True)
    in_pos = np.bincount(inverse, weights=np.repeat(y, [len(f) for f in found]), minlength=len(terms))
    in_all = np.bincount(inverse, minlength=len(terms)).astype(float)
    terms, tells, common = choose_terms(terms, in_all, in_pos, float(y.sum()), float(len(y) - y.sum()), max_terms, frequent)
    return fit_found([rows_of(f, terms) for f in found], labels, terms, tells, common, **settings)


def fit_found(found: list[np.ndarray], labels: list[int], terms: np.ndarray, tells: np.ndarray, common: np.ndarray, **settings) -> Model:
    """The model of the telling terms, or, where pairs of common terms tell more, of those and the pairs' terms.

    Copies among the rows make pairs look telling, so the larger model must also foretell every fifth row, fitted
    on the others, with a log loss at least ``1 - MIN_GAIN`` lower.
    """
    def of(mask: np.ndarray) -> list[np.ndarray]:
        place = np.cumsum(mask) - 1
        return [place[f[mask[f]]] for f in found]

    own = of(tells)
    first = fit_rows(own, labels, terms[tells], **settings)
    raw = np.array([first.raw(rows) if len(first.terms) else first.bias for rows in own])
    more = tells.copy()
    more[np.flatnonzero(common)[pair_terms(of(common), np.asarray(labels), raw, int(common.sum()))]] = True
    if (more == tells).all():
        return first
    y, fold = np.asarray(labels), np.arange(len(found)) % 5 == 0
    losses = []
    for mask in (tells, more):
        rows = of(mask)
        model = fit_rows([rows[i] for i in np.flatnonzero(~fold)], y[~fold], terms[mask], **settings)
        z = np.array([model.raw(rows[i]) if len(model.terms) else model.bias for i in np.flatnonzero(fold)])
        losses.append(float(np.logaddexp(0, np.where(y[fold] == 1, -z, z)).mean()))
    return fit_rows(of(more), labels, terms[more], **settings) if losses[1] < MIN_GAIN * losses[0] else first


def pair_terms(found: list[np.ndarray], labels: np.ndarray, raw: np.ndarray, size: int, block: int = 512) -> np.ndarray:
    """Mask of the terms (positions below ``size``) in a pair whose presence tells what ``raw`` leaves unexplained.

    The score test of one more weight for the pair: the squared sum of the residuals over the rows that hold
    both, by the sum of their variances (plus 1, so that a few rows alone do not tell).  Products of
    dense blocks of rows; the two sums take ``8 * size ** 2`` bytes.
    """
    p = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
    residual, variance = (labels - p).astype(np.float32), (p * (1 - p)).astype(np.float32)
    total, spread = np.zeros((size, size), np.float32), np.zeros((size, size), np.float32)
    for at in range(0, len(found), block):
        x = np.zeros((len(found[at:at + block]), size), np.float32)
        for i, rows in enumerate(found[at:at + block]):
            x[i, rows] = 1
        total += (x * residual[at:at + block, None]).T @ x
        spread += (x * variance[at:at + block, None]).T @ x
    np.fill_diagonal(total, 0)
    return (total * total / (spread + 1) >= MIN_PAIR_CHI_SQUARE).any(0)


def fit_rows(found: list[np.ndarray], labels: list[int], terms: np.ndarray, factors: int = FACTORS,
             epochs: int = 12, batch: int = 256, rate: float = 0.05, l2: float = 1e-4, seed: int = 7) -> Model:
    """Adam on the logistic loss over rows of positions in ``terms``; the order and the start are seeded.

    Without both labels or any term the model is its bias alone.
    """
    y = np.asarray(labels, dtype=np.float64)
    pos, neg = float(y.sum()), float(len(y) - y.sum())
    bias = float(np.log((pos + 1) / (neg + 1)))
    if not pos or not neg or not len(terms):
        return Model(np.empty(0, np.uint32), bias, np.empty(0), np.empty((0, factors)))
    rows = np.concatenate(found)
    start = np.concatenate([[0], np.cumsum([len(f) for f in found])])

    rng = np.random.default_rng(seed)
    n_w = len(terms)
    theta = np.concatenate([[bias], np.zeros(n_w), rng.normal(0, 0.01, n_w * factors)])
    m, v, step = np.zeros_like(theta), np.zeros_like(theta), 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            pick = order[at:at + batch]
            idx = np.concatenate([rows[start[d]:start[d + 1]] for d in pick])
            owner = np.repeat(np.arange(len(pick)), start[pick + 1] - start[pick])
            w, fac = theta[1:1 + n_w], theta[1 + n_w:].reshape(n_w, factors)
            vi = fac[idx]
            s = np.stack([np.bincount(owner, weights=vi[:, f], minlength=len(pick)) for f in range(factors)], 1)
            sq = np.bincount(owner, weights=(vi * vi).sum(1), minlength=len(pick))
            z = theta[0] + np.bincount(owner, weights=w[idx], minlength=len(pick)) + 0.5 * ((s * s).sum(1) - sq)
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[pick]) / len(pick)
            g = np.empty_like(theta)
            g[0] = err.sum()
            g[1:1 + n_w] = np.bincount(idx, weights=err[owner], minlength=n_w) + l2 * w
            pull = err[owner, None] * (s[owner] - vi)
            g[1 + n_w:] = np.stack([np.bincount(idx, weights=pull[:, f], minlength=n_w) for f in range(factors)], 1).ravel() + l2 * theta[1 + n_w:]
            step += 1
            m = 0.9 * m + 0.1 * g
            v = 0.999 * v + 0.001 * g * g
            theta = theta - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Model(terms, float(theta[0]), theta[1:1 + n_w], theta[1 + n_w:].reshape(n_w, factors))


def fit_sample(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
               text_col: str = "text", max_rows: int = MAX_FIT_ROWS, max_entries: int = MAX_FIT_ENTRIES) -> DataFrame:
    """(_id, _y, _terms) of at most ``max_rows`` labelled rows outside the held-out fold, in order of the id's hash.

    Rows without id, label or document are no examples; an id labelled twice takes its larger label, one with
    several texts the smallest of their term lists.  Rows after the first ``max_entries`` terms are left out.
    """
    chosen = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
              .filter(F.col("_id").isNotNull() & F.col("_y").isNotNull() & ~held_out("_id"))
              .groupBy("_id").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    # chosen: at most max_rows (id, label) pairs.
    rows = (docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
            .join(F.broadcast(chosen), "_id").select("_id", "_y", "_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            terms = [term_array(t).astype("<u4").tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(terms, pa.binary())], ["_id", "_y", "_terms"])

    kind = rows.schema["_id"].dataType.simpleString()
    one = rows.mapInArrow(run, f"_id {kind}, _y int, _terms binary").groupBy("_id", "_y").agg(F.min("_terms").alias("_terms"))
    found = stage(one.withColumn("_y", F.least(F.greatest("_y", F.lit(0)), F.lit(1))), "toxicity-sample")
    # At most max_rows narrow rows: one window over them.
    upto = F.sum(F.length("_terms") / 4).over(Window.orderBy(F.xxhash64("_id"), "_id"))
    within = found.select("_id", upto.alias("_upto")).filter(F.col("_upto") <= max_entries).select("_id")
    return found.join(F.broadcast(within), "_id", "left_semi")


def held_out(id_col: str):
    """The fold never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_model(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS, max_terms: int = MAX_TERMS,
              frequent: int = FREQUENT_TERMS, **columns) -> Model:
    """Fit on the bounded sample; rows arrive in id order, so a refit gives the same model."""
    sample = fit_sample(docs, labels, max_rows=max_rows, **columns)
    size, pos = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("_y"), F.lit(0))).first()
    terms, tells, common = _chosen(sample, float(pos), float(size - pos), max_terms, frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [rows_of(np.frombuffer(t, "<u4"), terms).astype("<u2").tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(at, pa.binary())], ["_id", "_y", "_rows"])

    kind = sample.schema["_id"].dataType.simpleString()
    rows = sample.mapInArrow(run, f"_id {kind}, _y int, _rows binary").toPandas().sort_values(["_id"])
    return fit_found([np.frombuffer(t, "<u2") for t in rows["_rows"]], rows["_y"].tolist(), terms, tells, common)


def _chosen(sample: DataFrame, pos: float, neg: float, max_terms: int, frequent: int) -> tuple:
    """The terms of ``choose_terms``, counted by Spark; at most ``max_terms + frequent`` come to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(t, "<u4") for t in batch.column(2).to_pylist()]
            y = np.asarray(batch.column(1).to_pylist(), dtype=np.int64)
            terms, inverse = np.unique(np.concatenate([*found, np.empty(0, np.uint32)]), return_inverse=True)
            in_pos = np.bincount(inverse, weights=np.repeat(y, [len(f) for f in found]), minlength=len(terms))
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms.astype(np.int64)), pa.array(np.bincount(inverse, minlength=len(terms)).astype(np.float64)), pa.array(in_pos)],
                ["_term", "_n", "_pos"])

    counts = (sample.mapInArrow(run, "_term bigint, _n double, _pos double").groupBy("_term")
              .agg(F.sum("_n").alias("_n"), F.sum("_pos").alias("_pos")).filter(F.col("_n") >= MIN_ROWS))
    value = _chi_square(F.col("_pos"), F.col("_n") - F.col("_pos"), pos, neg)
    telling = counts.withColumn("_v", value).filter(F.col("_v") >= MIN_CHI_SQUARE).orderBy(F.desc("_v"), "_term").limit(max_terms).drop("_v")
    common = counts.orderBy(F.desc("_n"), "_term").limit(frequent)
    got = telling.union(common).distinct().toPandas().sort_values("_term")
    return choose_terms(got["_term"].to_numpy(np.uint32), got["_n"].to_numpy(float), got["_pos"].to_numpy(float), pos, neg, max_terms, frequent)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, score (0 to 1) of every row's whole text.

    NULL and empty texts, and texts without a known term, get the score of the bias.  Equal texts get
    equal scores; ids, repeated rows and other columns play no part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed largest size, see MAX_TERMS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        known = _Rows(own.terms)
        for batch in slices(batches):
            raw = np.empty(batch.num_rows)
            for i, text in enumerate(batch.column(1).to_pylist()):
                hit = {r for rows in map(known.__getitem__, words_of(text)) if rows for r in rows}
                raw[i] = own.raw(np.fromiter(sorted(hit), dtype=np.int64, count=len(hit)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(raw, -30, 30))))], ["_id", "_score"])

    slim = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    kind = slim.schema["_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"_id {kind}, _score double").select(
        F.col("_id").alias(id_col), F.col("_score").alias("score"))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", max_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """``id_col``, held_out, score, predicted (1 from a score of 0.5) for every row of ``docs``.

    An empty label table (or one label only) gives every text the prior; an empty ``docs`` no rows.
    """
    model = fit_model(docs, labels, max_rows=max_rows, label_col=label_col, id_col=id_col, text_col=text_col)
    return (score_documents(docs, model, id_col, text_col)
            .withColumn("held_out", held_out(id_col))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
            .select(id_col, "held_out", "score", "predicted"))


def keep_clean(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose score is below 0.5, with the columns they came with (a map, no join).

    Rows keep every column, duplicates and NULLs included; column names are free.  A model without terms
    learned nothing about texts: all rows stay.
    """
    if not len(model.terms):
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        known = _Rows(own.terms)
        for batch in slices(batches):
            keep = []
            for text in batch.column(at).to_pylist():
                hit = {r for rows in map(known.__getitem__, words_of(text or "")) if rows for r in rows}
                keep.append(own.raw(np.fromiter(sorted(hit), dtype=np.int64, count=len(hit))) < 0)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
