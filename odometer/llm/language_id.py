"""Language identification by nearest centroid.

Texts become vectors of hashed character n-grams (1 to 3, over letters with one
space between words), weighted by TF-IDF and scaled to length 1.  Each language
has a few centroids, found by spherical k-means on a bounded sample of labelled
rows; a text takes the language of the centroid with the largest cosine.  Texts
whose best cosine is below what nearly all labelled texts of their length reach
are rejected as being in no learned language.

How near a text of some length comes is learned from all labelled rows, read
whole, and, as short texts are rare and far from every centroid, from beginnings
of the sample texts.  A low quantile of each length sets its floor, so that no
single odd or mislabelled row does.

The sample is at most ``SAMPLE`` rows per language, the smallest hashes of
(doc_id, text); repeated rows count once.  Texts are read whole, in training
and in prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odometer.llm.common import arrow_map, fresh, ship, stash

DIMENSIONS = 4096
SAMPLE = 600
CENTROIDS = 4
ROUNDS = 12
#: A text is rejected below this share of the best cosine that all but this
#: quantile of the labelled texts of its length class have.
REJECT_SHARE = 0.9
REJECT_QUANTILE = 0.005
#: Beginnings of sample texts, in characters, that show how near short texts come.
CUTS = tuple(4 << i for i in range(10))
UNKNOWN = "und"
_STRETCH = 1 << 20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def ngram_counts(text: str | None, dimensions: int = DIMENSIONS) -> np.ndarray | None:
    """Hashed n-gram counts of a whole text; None if it has no letter."""
    counts = np.zeros(dimensions, np.int64)
    seen = False
    text = text or ""
    for at in range(0, len(text), _STRETCH):
        # Two characters more on the left, so that no n-gram is lost.
        part = text[max(0, at - 2) : at + _STRETCH].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[codes]
        if not letter.any():
            continue
        seen = True
        kept = letter.copy()
        kept[1:] |= letter[:-1]
        c = np.concatenate([[32], np.where(letter, codes, 32)[kept], [32]]).astype(np.uint64)
        two = c[:-1] * np.uint64(0x9E3779B1) + c[1:] * np.uint64(0x85EBCA6B)
        three = two[:-1] * np.uint64(0xC2B2AE35) + c[2:] * np.uint64(0x27D4EB2F)
        for grams in (c * np.uint64(0x165667B1), two, three):
            mixed = (grams ^ (grams >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
            counts += np.bincount((mixed % np.uint64(dimensions)).astype(np.int64), minlength=dimensions)
    return counts if seen else None


def length_class(total: int) -> int:
    return int(total).bit_length()


@dataclass
class Model:
    """Everything a prediction needs: some hundred KB for each language."""

    languages: list[str]
    centroids: np.ndarray  # one row each, of length 1
    owner: np.ndarray  # index into languages
    idf: np.ndarray
    floor: dict[int, float]  # smallest cosine not rejected, by length class

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language, cosine (0 to 1) and whether the text is rejected.  Texts
        without a letter, and all texts if no language is learned, are ``und``,
        with score 0, and rejected."""
        lang, score, out = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        for at in range(0, len(texts), 256):
            found = [(at + i, c) for i, t in enumerate(texts[at : at + 256]) if (c := ngram_counts(t)) is not None]
            if not found or not self.languages:
                continue
            counts = np.stack([c for _, c in found])
            cosines = self.vectors(counts) @ self.centroids.T
            best = cosines.argmax(axis=1)
            for (row, c), k, s in zip(found, best, cosines.max(axis=1)):
                lang[row] = self.languages[self.owner[k]]
                score[row] = float(min(max(s, 0.0), 1.0))
                cls = min(length_class(c.sum()), max(self.floor, default=0))
                out[row] = bool(s < self.floor.get(cls, 0.0))
        return lang, score, out


def _spherical_kmeans(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Centroids of length 1; starts from the row nearest to the mean and then
    from the row furthest from all chosen, so it is the same on every run."""
    chosen = [int(np.argmax(x @ x.mean(axis=0)))]
    while len(chosen) < min(k, len(x)):
        far = (x @ x[chosen].T).max(axis=1)
        if far.min() > 1 - 1e-9:
            break
        chosen.append(int(far.argmin()))
    c = x[chosen].copy()
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        sums = np.stack([x[own == j].sum(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return c


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(labelled: DataFrame, sample: int = SAMPLE, clusters: int = CENTROIDS, share: float = REJECT_SHARE, quantile: float = REJECT_QUANTILE) -> Model:
    """Fit on ``labelled`` (doc_id, text, lang); rows without language or
    letters teach nothing, and no rows give a model without languages.  Centroids
    come from the sample, floors from all rows."""
    rows = labelled.filter("lang is not null and text is not null").select(
        "lang", F.xxhash64("doc_id", "text").alias("key"), "text"
    )
    # So many rows of each language that some more than ``sample`` are expected.
    # The counts read one narrow column; they are one row per language, as the
    # model is, so they go to every task and no text moves for them.
    sizes = labelled.filter("lang is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    some = rows.join(F.broadcast(sizes), "lang").filter(
        F.pmod("key", F.lit(1 << 40)) < F.lit(float(1 << 40)) * F.least(F.lit(1.0), 1.3 * sample / F.col("n"))
    )
    some = some.groupBy("lang", "key").agg(F.min("text").alias("text"))
    ship(labelled.sparkSession)
    features = "lang string, key long, cut int, place array<int>, n array<int>"

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for g, k, t in zip(frame["lang"], frame["key"], frame["text"]):
                for cut in [0, *(n for n in CUTS if n < len(t))]:
                    c = ngram_counts(t[:cut] if cut else t)
                    if c is not None:
                        out.append((g, k, cut, np.flatnonzero(c).astype(np.int32), c[c > 0].astype(np.int32)))
            yield pd.DataFrame(out, columns=["lang", "key", "cut", "place", "n"])

    order = Window.partitionBy("lang").orderBy("key")  # over the sample only
    drawn = some.mapInPandas(count, features).withColumn("nth", F.dense_rank().over(order)).filter(F.col("nth") <= sample)
    everything = stash(drawn.drop("nth"), "lang-sample")
    drawn = everything.filter("cut = 0")
    total = drawn.count()
    seen = np.zeros(DIMENSIONS)
    # One row per dimension at most.
    for place, n in drawn.select(F.explode("place").alias("place")).groupBy("place").count().collect():
        seen[place] = n
    idf = np.log((1 + total) / (1 + seen)) + 1.0
    bare = Model([], np.zeros((0, DIMENSIONS)), np.zeros(0, int), idf, {})

    def dense(frame: pd.DataFrame) -> np.ndarray:
        x = np.zeros((len(frame), DIMENSIONS))
        for row, (place, n) in enumerate(zip(frame["place"], frame["n"])):
            x[row, place] = n
        return x

    def cluster(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("key")
        found = _spherical_kmeans(bare.vectors(dense(frame)), clusters, ROUNDS)
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "nth": range(len(found)), "centroid": list(found)})

    # ``clusters`` rows per language.
    found = drawn.groupBy("lang").applyInPandas(cluster, "lang string, nth int, centroid array<double>").collect()
    found.sort(key=lambda r: (r["lang"], r["nth"]))
    languages = sorted({r["lang"] for r in found})
    centroids = np.array([r["centroid"] for r in found]).reshape(-1, DIMENSIONS)
    owner = np.array([languages.index(r["lang"]) for r in found], int)
    model = Model(languages, centroids, owner, idf, {})

    def nearness(counts: np.ndarray) -> tuple[list[int], np.ndarray]:
        best = (model.vectors(counts) @ centroids.T).max(axis=1)
        return [length_class(v) for v in counts.sum(axis=1)], best

    def of_beginnings(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            # A few rows at a time: dense vectors are large.
            for at in range(0, len(frame), 256):
                cls, best = nearness(dense(frame[at : at + 256]))
                yield pd.DataFrame({"cls": cls, "best": best})

    def of_texts(batch: pa.RecordBatch) -> pa.RecordBatch:
        cls, best = [], []
        texts = batch.column(0).to_pylist()
        for at in range(0, len(texts), 256):
            counts = [c for t in texts[at : at + 256] if (c := ngram_counts(t)) is not None]
            if counts:
                more, near = nearness(np.stack(counts))
                cls += more
                best += near.tolist()
        return pa.RecordBatch.from_arrays([pa.array(cls, pa.int32()), pa.array(best, pa.float64())], ["cls", "best"])

    if languages:
        shape = "cls int, best double"
        near = arrow_map(rows.select("text"), of_texts, shape, "text")
        near = near.unionByName(everything.filter("cut > 0").mapInPandas(of_beginnings, shape))
        # One row per length class; the sketch of each is of fixed size.
        low = near.groupBy("cls").agg(F.percentile_approx("best", quantile, 10_000).alias("low"))
        model.floor = {r["cls"]: share * r["low"] for r in low.collect()}
    return model


def identify(docs: DataFrame, model: Model, columns: list[str] | None = None) -> DataFrame:
    """All rows of ``docs`` (text), with all columns or those named, and a
    struct ``found`` (lang_pred, score, rejected); see ``Model.predict``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    (found,) = fresh(docs, "found")
    kept = docs.columns if columns is None else columns
    kind = T.StructType.fromDDL("lang_pred string, score double, rejected boolean")
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(found, kind)])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index("text")
        lang, score, out = shared.value.predict(batch.column(at).to_pylist())
        judged = pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score), pa.array(out)], kind.names)
        own = [batch.column(batch.schema.get_field_index(c)) for c in kept]
        return pa.RecordBatch.from_arrays([*own, judged], [*kept, found])

    return arrow_map(docs, run, schema, "text")


def train_on_open_rows(docs: DataFrame) -> Model:
    """The model of the rows that are not held out."""
    return train(docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))


def drop_unidentified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is identified, with all columns."""
    judged = identify(docs, train_on_open_rows(docs))
    found = judged.columns[-1]
    return judged.filter(~F.col(f"{found}.rejected")).drop(found)
