"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed character n-grams (1 to 3 bytes of its letters), weighted by TF-IDF and of unit length. The
IDF comes from all learned texts. A bounded sample of each language is clustered into a few unit centroids, since a
language holds unlike kinds of text. The nearest centroid by cosine gives the language; a text farther from it than
nearly all sample texts of that language is marked as rejected.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlens.llm.common import travels_by_value

travels_by_value(__name__)
SIZE, SAMPLE, CLUSTERS, ROUNDS, REJECTED = 8192, 1500, 4, 12, 0.999
_LETTER = np.full(256, 32, np.uint8)
for _c in (*range(97, 123), *range(128, 256)):
    _LETTER[_c] = _c


def grams(text: str) -> np.ndarray:
    """Log-damped counts of the hashed n-grams of the whole text; what is not a letter counts as one blank."""
    a = _LETTER[np.frombuffer((" " + text.lower() + " ").encode("utf-8", "surrogatepass"), np.uint8)]
    a = a[np.r_[True, (a[1:] != 32) | (a[:-1] != 32)]].astype(np.uint32)
    two = a[:-1] << np.uint32(8) | a[1:]
    three = two[:-1] << np.uint32(8) | a[2:]
    factor, shift = np.uint32(2654435761), np.uint32(32 - 13)
    at = np.concatenate([(x + np.uint32(k << 28)) * factor >> shift for k, x in enumerate((a, two, three))])
    return np.log1p(np.bincount(at, minlength=SIZE)).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def _document_counts(batches):
    seen, n = np.zeros(SIZE, np.int64), 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            seen += grams(text) > 0
            n += 1
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(SIZE + 1)), pa.array(np.append(seen, n))], ["at", "n"])


def _cluster(idf, clusters):
    def run(frame):
        x = unit(np.stack([grams(t) for t in frame.sort_values("text")["text"]]) * idf)
        centres = unit(x.mean(0, keepdims=True))
        while len(centres) < min(clusters, len(x)):  # the text farthest from all so far
            centres = np.vstack([centres, x[(x @ centres.T).max(1).argmin()]])
        for _ in range(ROUNDS):
            own = (x @ centres.T).argmax(1)
            centres = unit(np.stack([x[own == k].mean(0) if (own == k).any() else c for k, c in enumerate(centres)]))
        far = float(np.quantile(1 - (x @ centres.T).max(1), REJECTED))
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "far": far, "centre": [c.astype(np.float32).tolist() for c in centres]})
    return run


def _predict(sent):
    def run(batches):
        idf, langs, centres, far = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(2).to_pylist()
                known = np.array([has_letter(t) for t in texts]) if langs else np.zeros(len(texts), bool)
                lang, score, rejected = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
                if known.any():
                    near = unit(np.stack([grams(t) for t, k in zip(texts, known) if k]) * idf) @ centres.T
                    best = near.argmax(1)
                    score[known] = np.clip(near.max(1), 0, 1)
                    rejected[known] = 1 - near.max(1) > far[best]
                    for i, k in zip(np.flatnonzero(known), best):
                        lang[i] = langs[k]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(lang), pa.array(score), pa.array(rejected)],
                                                 ["doc_id", "held_out", "lang_pred", "score", "rejected"])
    return run


def predict_languages(docs: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang, any others): doc_id,
    held_out, lang_pred, score (cosine with the nearest centroid), rejected.

    Learned are texts with a letter and a non-null lang whose crc32(doc_id)
    modulo 4 is not 2; a null id counts as the empty text. ``sample`` bounds the
    texts of a language that are clustered. A null text, or one without a
    letter, is und, with score 0 and rejected; so is all if nothing is learned.
    """
    spark = docs.sparkSession
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
    learn = docs.where(~held & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", "doc_id")
    counts = np.zeros(SIZE + 1)
    for r in learn.select("text").mapInArrow(_document_counts, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        counts[r["at"]] = r["n"]
    idf = (np.log((1 + counts[-1]) / (1 + counts[:-1])) + 1).astype(np.float32)
    sizes = {r["lang"]: r["count"] for r in learn.groupBy("lang").count().collect()}  # few, like the centroids
    shares = F.lit(0.0)
    for lang, n in sizes.items():
        shares = F.when(F.col("lang") == lang, min(1.0, 0.9 * sample / n)).otherwise(shares)
    # Drawn where the texts are read: only the sample is shuffled, repeated rows of it once.
    drawn = learn.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) <= shares * (1 << 30)).select("lang", "text").distinct()
    found = drawn.groupBy("lang").applyInPandas(_cluster(idf, clusters), "lang string, far double, centre array<float>")
    rows = sorted(found.collect(), key=lambda r: (r["lang"], r["centre"]))
    model = (idf, [r["lang"] for r in rows], np.array([r["centre"] for r in rows], np.float32).reshape(-1, SIZE),
             np.array([r["far"] for r in rows]))
    return docs.select("doc_id", held.alias("held_out"), "text").mapInArrow(
        _predict(spark.sparkContext.broadcast(model)),
        "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
