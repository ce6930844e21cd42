"""Text statistics of every document, and a Gaussian mixture over them that tells prose from lists, tables and junk.

The statistics of each whole text come from one narrow scan. They are standardised by mean and deviation over all documents, a mixture with
full covariances is fitted to all of them by expectation-maximization, and each component is read as prose, list, table or junk by
the share of raters' labels that its documents carry. A document's class is the likeliest over its components' shares.

Scale: an EM step is one pass over a small table of figures; a task sends ``components`` blocks of sums (some 20 kB), which are summed in a second
level before they reach the driver. At most ``MAX_LABELLED`` labelled rows are brought to the driver; they seed the components (the bound is a
parameter of ``fit_mixture``) and name them. Nothing else is sampled.

Defined results: NULL and blank texts are junk by definition and take no part in the fit; a label of another name or a NULL one is ignored;
several labels of one document all count; without any usable label every document with text is prose; a NULL doc_id is kept; repeated rows
are kept; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.text_stats import FEATURES, CommonWords, batch_statistics
from corpusloom.session import materialize

CLASSES = ("prose", "list", "table", "junk")
COMPONENTS = 64
LABELS_PER_COMPONENT = 4
ROWS_PER_DIMENSION = 3  # a component has at least so many rows on average
MAX_LABELLED = 50_000
STEPS = 12
SEED_STEPS = 40
RIDGE = 0.02
CLIP = 6.0
TREE = 16


def document_statistics(documents: DataFrame, common_words: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, blank, one column a statistic) for every document."""
    rows = common_words.where(F.col("word").isNotNull()).select("lang", "word").distinct().collect()  # a fixed list, held as hashes
    by_language: dict[str | None, set[str]] = {}
    for r in rows:
        by_language.setdefault(r.lang, set()).add(r.word)
    common = CommonWords(tuple(frozenset(v) for _, v in sorted(by_language.items(), key=lambda x: str(x[0]))))
    source = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = source.select("key", F.lit(True).alias("blank"), *[F.lit(0.0).alias(f) for f in FEATURES]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if not texts:
                continue
            figures = batch_statistics([t or "" for t in texts], common)
            blank = pa.array([not (t and t.strip()) for t in texts])
            yield pa.RecordBatch.from_arrays([batch.column(0), blank, *[pa.array(c) for c in figures.T]], names=["key", "blank", *FEATURES])

    return source.mapInArrow(run, schema)


@dataclass(frozen=True)
class Mixture:
    """Weights, means and covariances of the components in standardised units, and each component's shares of the classes."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    centres: np.ndarray
    covariances: np.ndarray
    shares: np.ndarray

    def standardise(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -CLIP, CLIP)

    def theta(self) -> np.ndarray:
        """Coefficients of each component's log density over the terms of ``_terms``."""
        out = np.empty((_WIDTH, len(self.weights)))
        for k, (w, c, s) in enumerate(zip(self.weights, self.centres, self.covariances)):
            precision = np.linalg.inv(s)
            out[0, k] = np.log(w) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * c @ precision @ c
            out[1 : 1 + _D, k] = precision @ c
            out[1 + _D :, k] = np.where(_UPPER[0] == _UPPER[1], -0.5, -1.0) * precision[_UPPER]
        return out

    def responsibilities(self, z: np.ndarray) -> np.ndarray:
        """Posterior of each component for each row."""
        return _posterior(_terms(z), self.theta())[0]

    def class_shares(self, x: np.ndarray) -> np.ndarray:
        return self.responsibilities(self.standardise(x)) @ self.shares


def _figures(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FEATURES])


_D = len(FEATURES)
_UPPER = np.triu_indices(_D)
_WIDTH = 1 + _D + len(_UPPER[0])
CHUNK = 4096


def _terms(z: np.ndarray) -> np.ndarray:
    """1, z and the products of z: densities and the sums of a step are both linear in these."""
    return np.concatenate([np.ones((len(z), 1)), z, z[:, _UPPER[0]] * z[:, _UPPER[1]]], axis=1)


def _posterior(terms: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, float]:
    """Posterior of each component for each row, and the rows' total log-likelihood."""
    logs = terms @ theta
    top = logs.max(axis=1, keepdims=True)
    r = np.exp(logs - top)
    total = r.sum(axis=1, keepdims=True)
    return r / total, float((np.log(total) + top).sum())


def _step_sums(z: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """For each component the responsibility-weighted sums of the terms, then the log-likelihood, in one flat array."""
    sums, log = np.zeros((theta.shape[1], _WIDTH)), 0.0
    for at in range(0, len(z), CHUNK):
        terms = _terms(z[at : at + CHUNK])
        r, part = _posterior(terms, theta)
        sums += r.T @ terms
        log += part
    return np.r_[sums.ravel(), log]


def _distributed_sums(figures: DataFrame, model: Mixture, many: bool) -> np.ndarray:
    """``_step_sums`` over all rows: one block of sums a task, summed in a second level where there are many tasks."""
    theta = model.theta()
    size = theta.shape[1] * _WIDTH + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size)
        for batch in batches:
            out += _step_sums(model.standardise(_figures(batch)), theta)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["sums"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                out += np.frombuffer(blob)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["sums"])

    level = figures.mapInArrow(partial, "sums binary")
    if many:
        level = level.repartition(TREE).mapInArrow(total, "sums binary")
    out = np.zeros(size)
    for row in level.collect():  # one block of sums a task, few by the branch above
        out += np.frombuffer(bytes(row[0]))
    return out


def _next(model: Mixture, sums: np.ndarray, least: float) -> Mixture:
    """The mixture of largest likelihood given a step's sums. A component of fewer than ``least`` rows is given up, but never the largest."""
    sums = sums[:-1].reshape(-1, _WIDTH)
    sums = sums[sums[:, 0] >= min(least, sums[:, 0].max())]
    n = sums[:, 0]
    centres = sums[:, 1 : 1 + _D] / n[:, None]
    covariances = np.zeros((len(n), _D, _D))
    covariances[:, _UPPER[0], _UPPER[1]] = covariances[:, _UPPER[1], _UPPER[0]] = sums[:, 1 + _D :] / n[:, None]
    covariances -= centres[:, :, None] * centres[:, None, :]
    covariances += RIDGE * np.eye(_D)
    return Mixture(model.mean, model.scale, n / n.sum(), centres, covariances, np.zeros((len(n), len(CLASSES))))


def _seeds(z: np.ndarray, k: int) -> np.ndarray:
    """Spread-out starting centres (k-means++ with a fixed seed)."""
    rng = np.random.default_rng(7)
    centres = [z[rng.integers(len(z))]]
    gap = ((z - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k and gap.sum() > 0:
        centres.append(z[rng.choice(len(z), p=gap / gap.sum())])
        gap = np.minimum(gap, ((z - centres[-1]) ** 2).sum(axis=1))
    return np.array(centres)


def fit_mixture(figures: DataFrame, labels: DataFrame, components: int = COMPONENTS, steps: int = STEPS, max_labelled: int = MAX_LABELLED) -> Mixture | None:
    """Fit to all rows of ``figures``; None if no row with text carries a usable label. ``labels`` (key, label)."""
    d = len(FEATURES)
    present = figures.where(~F.col("blank"))
    known = labels.where(F.col("label").isin(*CLASSES) & F.col("key").isNotNull()).select("key", "label")
    rows = present.join(known, "key").select("label", *FEATURES).limit(max_labelled).collect()
    if not rows:
        return None
    moments = present.agg(*[F.avg(f) for f in FEATURES], *[F.stddev_pop(f) for f in FEATURES], F.count(F.lit(1))).first()
    mean = np.array(moments[:d])
    scale = np.maximum(np.array(moments[d : 2 * d]), 1e-6)
    x = np.array([r[1:] for r in rows], dtype=float)
    order = np.lexsort(x.T)  # the order of collected rows is not fixed
    x, tags = x[order], np.array([CLASSES.index(r[0]) for r in rows])[order]
    z = np.clip((x - mean) / scale, -CLIP, CLIP)
    k = max(1, min(components, len(z) // LABELS_PER_COMPONENT, moments[2 * d] // (ROWS_PER_DIMENSION * d)))
    centres = _seeds(z, k)
    k = len(centres)
    model = Mixture(mean, scale, np.full(k, 1 / k), centres, np.stack([np.eye(d)] * k), np.zeros((k, len(CLASSES))))
    for _ in range(SEED_STEPS):  # on the labelled rows alone: only where the fit to all rows begins
        model = _next(model, _step_sums(z, model.theta()), min(_D, len(z) / (2 * k)))
    before = -np.inf
    many = len(present.inputFiles()) > 4 * TREE
    for _ in range(steps):
        sums = _distributed_sums(present, model, many)
        model = _next(model, sums, _D)
        rows_seen = float(sums[:-1].reshape(-1, _WIDTH)[:, 0].sum())
        if sums[-1] - before < 1e-3 * rows_seen:
            break
        before = sums[-1]
    r = model.responsibilities(z)
    votes = np.stack([r[tags == c].sum(axis=0) for c in range(len(CLASSES))], axis=1)
    overall = np.bincount(tags, minlength=len(CLASSES)) / len(tags)
    shares = (votes + 0.5 * overall) / (votes.sum(axis=1, keepdims=True) + 0.5)
    return Mixture(model.mean, model.scale, model.weights, model.centres, model.covariances, shares)


def classify(figures: DataFrame, model: Mixture | None) -> DataFrame:
    """Adds ``text_class`` and ``prose_share`` to the figures."""
    schema = figures.select("*", F.lit("").alias("text_class"), F.lit(0.0).alias("prose_share")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blank = batch.column("blank").to_numpy(zero_copy_only=False)
            if model is None:
                shares = np.tile([1.0, 0, 0, 0], (batch.num_rows, 1))
            else:
                shares = np.concatenate([model.class_shares(_figures(batch.slice(at, 8192))) for at in range(0, batch.num_rows, 8192)] or [np.empty((0, 4))])
            prose = np.where(blank, 0.0, shares[:, 0])
            other = 1 + shares[:, 1:].argmax(axis=1) if len(shares) else np.empty(0, int)
            which = np.where(blank, 3, np.where(prose >= 0.5, 0, other))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.array(CLASSES)[which].tolist(), pa.string()), pa.array(prose)], names=[*batch.schema.names, "text_class", "prose_share"])

    return figures.mapInArrow(run, schema)


def text_quality(documents: DataFrame, common_words: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, blank, statistics, text_class, prose_share) of every document."""
    figures = materialize(document_statistics(documents, common_words, key, text), "text-statistics")
    model = fit_mixture(figures, labels.select(F.col(key).alias("key"), "label"))
    return classify(figures, model).withColumnRenamed("key", key)
