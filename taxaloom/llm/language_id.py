"""Language identification by nearest clustered centroid.

A text becomes a hashed bag of letter 1-, 2- and 3-grams (lower case, everything but letters is one blank), weighted by
square-root term frequency times inverse document frequency and scaled to length 1. Each language owns several centroids,
found by spherical k-means; a text takes the language of the centroid with the highest cosine, and is rejected when it lies
farther from that centroid than the radius that the centroid has for texts of its length.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from taxaloom.llm.memory import release
from taxaloom.session import cut, free_name

#: Fitted on at most about this many texts a language (the sample is drawn by hash; twice as many is a hard limit).
SAMPLE_PER_LANGUAGE = 400
CLUSTERS = 4
DIM = 8192
#: A text is left out if its cosine is under REJECT_SHARE of the 5 % quantile that beginnings, as long as it, of texts of that
#: language have; one text in HELD_FOR_RADIUS of the sample is kept from the centroids for this. Short texts have few n-grams
#: and so low cosines: the quantiles are taken of beginnings of each of these numbers of characters, the last of whole texts.
REJECT_SHARE, HELD_FOR_RADIUS = 0.65, 4
LENGTHS = (8, 16, 32, 64, 128, 256)
#: Long texts are read in pieces of this many characters, so that memory stays bounded; the whole text counts.
PIECE = 1 << 20


@dataclass
class LanguageModel:
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # (centroids, DIM), rows of length 1
    idf: np.ndarray
    radius: np.ndarray  # (centroids, LENGTHS), greatest accepted 1 - cosine of each centroid


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed 1- to 3-grams; None if there is no letter."""
    if not text:
        return None
    total, found = np.zeros(DIM), False
    for at in range(0, len(text), PIECE):
        codes = np.frombuffer(text[max(0, at - 2) : at + PIECE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[codes]
        if not letter.any():
            continue
        found = True
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # of several blanks the first stays
        c = np.concatenate(([32], np.where(letter, codes, 32)[keep], [32])).astype(np.uint32)
        a = c * np.uint32(0x9E3779B1)
        b = (a[:-1] ^ (c[1:] + np.uint32(0x7F4A7C15))) * np.uint32(0x85EBCA6B)
        t = (b[:-1] ^ (c[2:] + np.uint32(0x165667B1))) * np.uint32(0xC2B2AE35)
        for h in (a, b, t):
            total += np.bincount((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(19), minlength=DIM)
    return total if found else None


def _length(text: str) -> int:
    """The place in LENGTHS of the last that a text reaches; the first for shorter ones."""
    return max(0, int(np.searchsorted(LENGTHS, len(text), "right")) - 1)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Farthest-first seeds, then the usual rounds by cosine; deterministic in the order of x."""
    seeds, best = [0], x @ x[0]
    while len(seeds) < min(k, len(x)):
        far = int(np.argmin(best))
        if best[far] > 1 - 1e-9:
            break
        seeds.append(far)
        best = np.maximum(best, x @ x[far])
    centres = x[seeds]
    for _ in range(rounds):
        own = np.argmax(x @ centres.T, axis=1)
        centres = _unit(np.stack([x[own == j].mean(0) if (own == j).any() else centres[j] for j in range(len(centres))]))
    return centres


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE, clusters: int = CLUSTERS) -> LanguageModel:
    """A model from the rows of ``labelled`` that have a text and a language.

    The sample has the ``per_language`` distinct texts of least hash of each language, or all if they are fewer, so that no language
    with a lettered text is lost, however often its texts repeat; each language's sample is clustered in a task of its own.
    Without labelled rows the model has no centroid, and every text is then ``und``.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.col(text)).alias("h")).where("text is not null and lang is not null").where(F.col("text").rlike(r"\p{L}"))
    # the least hashes of each language: tasks pass on no more than that many each, and texts are read for the chosen alone
    hashes = rows.select("lang", "h").distinct().withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("place") <= per_language)
    ranked = cut(rows.join(F.broadcast(hashes), ["lang", "h"]).dropDuplicates(["lang", "h"]))

    @F.pandas_udf("array<float>")
    def counted(texts: pd.Series) -> pd.Series:
        return pd.Series([None if (c := ngram_counts(t)) is None else c.astype(np.float32) for t in texts])

    kept = ranked.where(F.col("place") % HELD_FOR_RADIUS != 0)
    vectors = cut(kept.repartition(F.col("lang"), F.col("h")).select("lang", "h", counted("text").alias("v")).where("v is not null"))
    seen = vectors.select(F.posexplode("v").alias("i", "c")).where("c > 0").groupBy("i").agg(F.count("*").alias("df")).collect()
    n, idf = vectors.count(), np.ones(DIM)
    idf[:] = np.log1p(n)
    for r in seen:
        idf[r["i"]] = np.log1p(n / r["df"])

    def cluster(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        x = _unit(np.sqrt(np.stack(group.sort_values("h", kind="stable")["v"].to_list()).astype(float)) * idf)
        centres = _spherical_kmeans(x, clusters)
        return pd.DataFrame({"lang": key[0], "c": list(centres.astype(np.float32))})

    found = sorted(vectors.groupBy("lang").applyInPandas(cluster, "lang string, c array<float>").collect(), key=lambda r: (r["lang"], list(r["c"][:8])))
    if not found:
        return LanguageModel([], np.zeros((0, DIM)), idf, np.zeros((0, len(LENGTHS))))
    languages, centroids = [r["lang"] for r in found], np.array([r["c"] for r in found], dtype=np.float32)

    def cosines(batches):
        for batch in batches:
            rows = []
            for name, t in zip(batch["lang"], batch["text"], strict=True):
                own = centroids[[x == name for x in languages]]
                for i in range(_length(t) + 1):
                    if len(own) and (c := ngram_counts(t if i + 1 == len(LENGTHS) else t[: LENGTHS[i]])) is not None:
                        rows.append((name, i, float((own @ _unit((np.sqrt(c) * idf)[None])[0]).max())))
            yield pd.DataFrame(rows, columns=["lang", "i", "cos"])

    # of the texts held back; where a language has too few for any, those in the centroids
    alone = ranked.where(F.col("place") % HELD_FOR_RADIUS == 0).select("lang", "text")
    low: dict[str, dict[int, float]] = {}
    for texts in (alone, ranked.select("lang", "text")):
        for r in texts.mapInPandas(cosines, "lang string, i int, cos double").groupBy("lang", "i").agg(F.percentile("cos", 0.05).alias("low")).collect():
            low.setdefault(r["lang"], {}).setdefault(r["i"], r["low"])
        if set(languages) <= low.keys():
            break
    # a length without texts is judged like the longest one below it that has some, or else the shortest above
    near = lambda of, i: of[max([j for j in of if j <= i], default=min(of))]
    radius = np.array([[1 - REJECT_SHARE * near(low[name], i) for i in range(len(LENGTHS))] for name in languages])
    return LanguageModel(languages, centroids, idf, radius)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (the cosine, 0 to 1) and accepted (within the centroid's radius).

    Null, empty and letterless texts: ``und``, 0, not accepted; so is every text of a model without centroids. Rows are
    judged one by one, so repeated rows agree. A column that already has one of the three names is replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast((model.languages, model.centroids.astype(np.float32), model.idf.astype(np.float32), model.radius))

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def nearest(texts: pd.Series) -> pd.DataFrame:
        languages, centroids, idf, radius = held.value
        out = []
        for at in range(0, len(texts), 256):
            counts = [ngram_counts(t) for t in texts.iloc[at : at + 256]]
            known = [i for i, c in enumerate(counts) if c is not None] if languages else []
            best = [("und", 0.0, False)] * len(counts)
            if known:
                x = _unit(np.sqrt(np.stack([counts[i] for i in known]).astype(np.float32)) * idf)
                cos = x @ centroids.T
                for i, j, s in zip(known, cos.argmax(1), cos.max(1), strict=True):
                    s = float(min(1.0, max(0.0, s)))
                    best[i] = (languages[j], s, bool(1 - s <= radius[j, _length(texts.iloc[at + i])]))
            out += best
        release()
        return pd.DataFrame(out, columns=["lang_pred", "score", "accepted"])

    kept = docs.drop("lang_pred", "score", "accepted")
    near = free_name(kept)
    return kept.withColumn(near, nearest(F.col(text))).select(*[F.col(f"`{c}`") for c in kept.columns], f"{near}.*")


def held_out(doc_id: str = "doc_id"):
    """The fold that takes no part in fitting."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_on_documents(docs: DataFrame) -> LanguageModel:
    return fit(docs.where(~held_out()).select("doc_id", "text", "lang"))


def accepted_only(docs: DataFrame) -> DataFrame:
    """Pipeline stage: documents whose language is recognised, with the columns they had."""
    names = docs.columns
    return predict(docs, fit_on_documents(docs)).where("accepted").select(*names)
