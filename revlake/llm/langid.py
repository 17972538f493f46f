"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. An n-gram binds the vectors of its letters, each permuted by its place: the product
of the rolled vectors. A text bundles its n-grams: their sum by count. A language's prototype is the bundle of all its texts; a
text gets the language with the largest cosine. Runs of other characters count as one blank, case is ignored, and the text is used whole.

Prototypes: each task bundles what it reads into one vector per language, Spark adds the vectors up. They are a stored table; tasks get a block of
them at a time, so languages may be any number. Nulls: texts that are null or have no letter are ``und`` with score 0 and teach nothing; rows with
a null language teach nothing. With nothing to learn from, as from an empty table, every text is ``und``. Ties go to the first language by name; repeated rows and ids count and are
predicted each by themselves. Only the columns in ``keep`` are passed on, so others can't clash; a text may have any length.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlake.llm.common import frugal, run_dir, small_batches, stored

DIMENSIONS = 1024
GRAM = 3
UNKNOWN = "und"
#: Languages whose prototypes are sent to tasks at a time, of 8 KB each.
BLOCK_LANGUAGES = 1000
#: Vectors of n-grams that a worker keeps, one byte a dimension.
KEPT_GRAMS = 30_000
SEED = 20_011


@cache
def letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def gram_codes(text: str | None) -> np.ndarray:
    """A number for each n-gram of a text, 21 bits a letter, 0 for blanks; none if the text has no letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32).astype(np.int64)
    is_letter = letters()[codes]
    if not is_letter.any():
        return np.zeros(0, np.int64)
    codes = np.concatenate(([0], np.where(is_letter, codes, 0), [0]))
    codes = codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]
    n = len(codes) - GRAM + 1
    return sum((codes[k : k + n] << (21 * (GRAM - 1 - k)) for k in range(GRAM)), np.zeros(n, np.int64))


class Vectors:
    """Vectors of n-grams, made when first asked for."""

    def __init__(self, dimensions: int):
        self.d, self.letter = dimensions, {}
        self.rows: dict[int, int] = {}
        self.matrix = np.zeros((KEPT_GRAMS, dimensions), np.int8)

    def bind(self, code: int) -> np.ndarray:
        out = np.ones(self.d, np.int8)
        for k in range(GRAM):
            c = code >> (21 * k) & 0x1FFFFF
            if c not in self.letter:
                self.letter[c] = np.random.default_rng([SEED, c]).choice(np.array([-1, 1], np.int8), self.d)
            out *= np.roll(self.letter[c], k)
        return out

    def bundle(self, codes: np.ndarray) -> np.ndarray:
        """Sum of the n-grams' vectors."""
        out = np.zeros(self.d)
        grams, counts = np.unique(codes, return_counts=True)
        for at in range(0, len(grams), 4096):
            some = grams[at : at + 4096].tolist()
            if len(self.rows) + len(some) > KEPT_GRAMS:
                self.rows.clear()
            for g in some:
                if g not in self.rows:
                    self.matrix[len(self.rows)] = self.bind(g)
                    self.rows[g] = len(self.rows)
            out += counts[at : at + 4096].astype(np.float32) @ self.matrix[[self.rows[g] for g in some]].astype(np.float32)
        return out


@cache
def vectors(dimensions: int) -> Vectors:
    """One per Python worker."""
    return Vectors(dimensions)


@dataclass
class Prototypes:
    """A stored table (no, lang, v) of unit vectors, languages in order, and how many there are."""

    table: DataFrame | None
    count: int

    def block(self, at: int) -> dict[str, np.ndarray]:
        """The prototypes from number ``at`` on, ``BLOCK_LANGUAGES`` of them."""
        if not self.count:
            return {}
        found = self.table.filter(F.col("no").between(at, at + BLOCK_LANGUAGES - 1)).orderBy("no").collect()
        return {r["lang"]: np.array(r["v"]) / np.linalg.norm(r["v"]) for r in found}


def learn(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS) -> Prototypes:
    """The prototype of each language in ``lang_col``. Languages whose texts have no letter, or bundle to zero, have none."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).filter("lang is not null and text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            by: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                by.setdefault(lang, []).append(gram_codes(text.as_py()))
            for lang, codes in by.items():
                sums[lang] = sums.get(lang, 0) + vectors(dimensions).bundle(np.concatenate(codes))
            if len(sums) > BLOCK_LANGUAGES:
                yield bundles_of(sums)
                sums = {}
        if sums:
            yield bundles_of(sums)
        vectors.cache_clear()

    bundles = rows.mapInArrow(frugal(run), "lang string, bundle array<double>")
    added = bundles.select("lang", F.posexplode("bundle").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    per_lang = added.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")).select("lang", F.col("v.x").alias("v")).filter(F.exists("v", lambda x: x != 0))
    at = run_dir(spark, "languages")
    per_lang = stored(per_lang, f"{at}/bundles")
    numbers = per_lang.select("lang").withColumn("no", F.row_number().over(Window.orderBy("lang")) - 1)
    numbered = stored(per_lang.join(numbers, "lang").select("no", "lang", "v"), f"{at}/prototypes")
    return Prototypes(numbered, numbered.count())


def bundles_of(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([x.tolist() for x in sums.values()], pa.list_(pa.float64()))], ["lang", "bundle"])


def predict(docs: DataFrame, prototypes: Prototypes, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), dimensions: int = DIMENSIONS) -> DataFrame:
    """The columns in ``keep``, ``lang_pred`` and ``score``, the cosine with that language's prototype, at least 0."""
    small_batches(docs.sparkSession)
    n, last = len(keep), max(0, prototypes.count - 1) // BLOCK_LANGUAGES
    kept = [docs.schema[c] for c in keep]
    found = docs.select(*keep, F.col(text_col).alias("_text"), F.lit(None).cast("string").alias("_lang"), F.lit(-2.0).alias("_cosine"))
    at = run_dir(docs.sparkSession, "predicted")
    for k in range(last + 1):
        run, names = _best(prototypes.block(k * BLOCK_LANGUAGES), n, keep, dimensions, k == last)
        schema = T.StructType(kept + ([T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False)] if k == last else [T.StructField("_text", T.StringType()), T.StructField("_lang", T.StringType()), T.StructField("_cosine", T.DoubleType())]))
        found = found.mapInArrow(run, schema)
        if k < last:  # more languages than one block: a pass for each, stored in between
            found = stored(found, f"{at}/{k}")
    return found


def _best(block: dict[str, np.ndarray], n: int, keep: tuple[str, ...], dimensions: int, last: bool):
    """A pass over rows with a text and the best language so far, which compares them with one block of languages."""
    names = list(block)
    table = np.array(list(block.values())) if block else np.zeros((0, dimensions))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            best, scores = [], []
            for text, lang, cosine in zip(b.column(n), b.column(n + 1).to_pylist(), b.column(n + 2).to_pylist(), strict=True):
                codes = gram_codes(text.as_py())
                if len(codes) and names:
                    d = vectors(dimensions).bundle(codes)
                    # A bundle of zeros is as near to all languages: the first.
                    cosines = table @ d / (np.linalg.norm(d) or 1.0)
                    k = int(cosines.argmax())
                    if cosines[k] > cosine:
                        lang, cosine = names[k], float(cosines[k])
                best.append(lang), scores.append(cosine)
            if last:
                yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array([x or UNKNOWN for x in best], pa.string()), pa.array([min(1.0, max(0.0, x)) for x in scores], pa.float64())], [*keep, "lang_pred", "score"])
            else:
                yield pa.RecordBatch.from_arrays([*b.columns[: n + 1], pa.array(best, pa.string()), pa.array(scores, pa.float64())], [*keep, "_text", "_lang", "_cosine"])
        vectors.cache_clear()

    return frugal(run), names
