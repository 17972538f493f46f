"""Quality score of documents: ridge regression on random Fourier features, calibrated by isotonic regression.

Statistics of the whole text, standardised, pass through cosines with random frequencies: their products approximate a Gaussian kernel.
Each task sums its part of the normal equations, by fold; the driver adds these sums of a fixed size and solves them.
Scores of the folds left out of a fit are calibrated by pooling adjacent violators over 1000 bins.

Only the fit is bounded: ``FIT_ROWS`` labelled rows are taken by a hash of the id when there are more; every text is scored.
Nulls: a null text is an empty one; empty texts are scored like others, as are rows with a null id. Labelled rows without id or label aren't used. With labels of one
kind only, every score is that kind's share; with no labels, as from empty tables, it is 0.5. Folds without labelled rows don't count, so any number of labels will do. Ties and repeated rows:
equal texts have equal scores; rows that repeat an id are learnt from and scored each by their own text. Only the columns in ``keep`` are passed on, so others can't clash; a
text may have any length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlake.llm.common import frugal, run_dir, small_batches, stored

#: Labelled rows that a model is fitted on at most, in expectation.
FIT_ROWS = 50_000
FREQUENCIES = 192
BANDWIDTH = 3.0
RIDGE = 1.0
FOLDS = 4
BINS = 1000
SEED = 20_012
#: Tasks that share the fit, and sums that the driver adds at most.
FIT_TASKS = 12

MARKS = re.compile(r"[^\w\s]")
RUNS = re.compile(r"[^\w\s]{2,}")


def statistics(text: str | None) -> list[float]:
    """What the model knows of a text: sizes, kinds of characters, repetition, shapes of words and lines."""
    text = text or ""
    n = len(text)
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    w, ln = len(words), len(lines)
    many, rows = max(w, 1), max(ln, 1)
    marks, runs = len(MARKS.findall(text)), len(RUNS.findall(text))
    upper = sum(map(str.isupper, words))
    short = sum(len(x) <= 3 for x in words)
    bare = len("".join(words))
    return [
        np.log1p(n), np.log1p(w), np.log1p(ln), bare / many, w / rows, marks / max(n, 1) * 10, runs / many, upper / many, short / many,
        len(set(words)) / many, len(set(lines)) / rows, sum(c in text for c in "|#$%&*{}<>@") / 5, text.count("|") / many, text.count("!") / many,
        sum(map(str.isdigit, text)) / max(n, 1) * 10, sum(x[-1] in ".!?" for x in map(str.strip, lines)) / rows, sum(x[:1].isupper() for x in words) / many, (text.count(".") + text.count(",")) / many,
    ]


def features(docs: DataFrame, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep``, and ``stats``, the statistics of each text."""
    small_batches(docs.sparkSession)
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array([statistics(x.as_py()) for x in b.column(n)], pa.list_(pa.float64()))], [*keep, "stats"])

    return docs.select(*keep, F.col(text_col).alias("_text")).mapInArrow(frugal(run), T.StructType([docs.schema[c] for c in keep] + [T.StructField("stats", T.ArrayType(T.DoubleType(), False), False)]))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    frequency: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    at: np.ndarray
    level: np.ndarray

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([np.cos(z @ self.frequency + self.phase) * np.sqrt(2 / len(self.phase)), np.ones((len(z), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.expand(x) @ self.weights
        # The step function is joined by lines; a thousandth of the raw score keeps the order within a step.
        return np.clip(0.999 * np.interp(raw, self.at, self.level) + 0.001 * np.clip(raw, 0, 1), 0, 1)


def _sums(rows: DataFrame, of) -> dict[int, np.ndarray]:
    """By fold that has rows, the sum over them of ``of(x, y)``, a vector; tasks add their own rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            x, y, fold = np.array(b.column(0).to_pylist(), float), b.column(1).to_numpy().astype(float), b.column(2).to_numpy()
            for k in np.unique(fold):
                sums[int(k)] = sums.get(int(k), 0) + of(x[fold == k], y[fold == k])
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["fold", "part"])

    out: dict[int, np.ndarray] = {}
    for r in rows.select("stats", "label", "fold").mapInArrow(frugal(run), "fold int, part binary").collect():
        out[r["fold"]] = out.get(r["fold"], 0) + np.frombuffer(r["part"])
    return {k: out[k] for k in sorted(out)}


def pool(at: np.ndarray, total: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression: places and levels of the pooled blocks, in order of ``at``."""
    blocks: list[list[float]] = []
    for a, t, w in zip(at, total, weight, strict=True):
        blocks.append([a * w, t, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], last, strict=True)]
    b = np.array(blocks)
    return b[:, 0] / b[:, 2], b[:, 1] / b[:, 2]


def fit(labelled: DataFrame, *, fit_rows: int = FIT_ROWS, frequencies: int = FREQUENCIES) -> Model | float:
    """A model from (id, stats, label); a number where the labels don't tell anything apart."""
    spark = labelled.sparkSession
    n = labelled.count()
    share = min(1.0, fit_rows / max(n, 1))
    key = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1_000_000))
    rows = labelled.filter(key < share * 1_000_000).withColumn("fold", F.pmod(F.hash(F.col("id").cast("string")), F.lit(FOLDS)))
    rows = stored(rows.repartition(FIT_TASKS, "id").select("stats", F.col("label").cast("double").alias("label"), "fold"), f"{run_dir(spark, 'quality')}/fit")
    found = _sums(rows, lambda x, y: np.concatenate([x.sum(0), (x**2).sum(0), [y.sum(), len(y)]]))
    if not found:
        return 0.5
    moments = sum(found.values())
    d = (len(moments) - 2) // 2
    ones, total = moments[-2:]
    if ones in (0, total):
        return float(ones / total)
    mean = moments[:d] / total
    scale = np.sqrt(np.maximum(moments[d : 2 * d] / total - mean**2, 1e-12)) + 1e-6
    rng = np.random.default_rng(SEED)
    size = frequencies + 1
    model = Model(mean, scale, rng.normal(0, 1 / BANDWIDTH, (d, frequencies)), rng.uniform(0, 2 * np.pi, frequencies), np.zeros(size), np.zeros(1), np.zeros(1))

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = model.expand(x)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    def solve(part: np.ndarray) -> np.ndarray:
        return np.linalg.solve(part[: size * size].reshape(size, size) + RIDGE * np.eye(size), part[size * size :])

    parts = _sums(rows, normal)
    whole = sum(parts.values())
    # A fold's scores come from a fit without it; a single fold has none but its own.
    left_out = {k: solve(whole - p) if len(parts) > 1 else solve(whole) for k, p in parts.items()}
    edges = np.linspace(-0.5, 1.5, BINS - 1)

    def binned(k: int):
        def of(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            raw = model.expand(x) @ left_out[k]
            at = np.digitize(raw, edges)
            return np.concatenate([np.bincount(at, v, BINS) for v in (np.ones(len(y)), y, raw)])

        return of

    sums = np.zeros(3 * BINS)
    for k in left_out:
        for found in _sums(rows.filter(F.col("fold") == k), binned(k)).values():
            sums += found
    weight, good, raw = sums.reshape(3, BINS)
    has = weight > 0
    model.weights = solve(whole)
    model.at, model.level = pool(raw[has] / weight[has], good[has], weight[has])
    return model


def predict(rows: DataFrame, model: Model | float, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep`` and ``score``, from rows with ``stats``."""
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column(n).to_pylist(), float)
            score = np.full(len(b), model) if isinstance(model, float) else model.score(x) if len(b) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(score)], [*keep, "score"])

    return rows.select(*keep, "stats").mapInArrow(frugal(run), T.StructType([rows.schema[c] for c in keep] + [T.StructField("score", T.DoubleType(), False)]))
