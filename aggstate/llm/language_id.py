"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, every run of characters that are no letters becomes one space, and all 1- to 3-grams are hashed
into ``buckets``.  Spark counts the n-grams of each language; the smoothed log-probability matrix (buckets x languages,
float32, at most ``buckets * MAX_LANGUAGES * 4`` bytes) is broadcast, and batches are scored in numpy as a sparse
product: the rows of the matrix at a batch's buckets, summed by document.

Null text, empty text and text without a letter: ``und`` with score 0.  Ties go to the language first in order.  Repeated
rows are scored each.  Null ids stay null.  An empty training table gives a model without languages, which answers ``und``.
Only the named columns are read, so extra columns of any name don't matter.

A posterior compares the learned languages with each other alone, so it says nothing about a text in none of them.  The
stage therefore asks for the log-likelihood of an n-gram too: a text of ``FLOOR_GRAMS`` n-grams or more goes if its mean
lies ``FLOOR_MARGIN`` below the lowest one among the training texts of its language.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrays_batch, masked, portions, table

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
MAX_LANGUAGES = 512
#: The classifier is fitted on about this many labelled documents of each language, chosen by a hash of their ids.
TRAIN_DOCS = 3000
FLOOR_GRAMS, FLOOR_MARGIN = 30, 1.5
_MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(texts: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams, with their text's number (ascending within each order), and the letters of each text."""
    lows = [t.lower() for t in texts]
    row = np.repeat(np.arange(len(lows), dtype=np.int32), np.fromiter(map(len, lows), np.int64, len(lows)))
    code = np.frombuffer("".join(lows).encode("utf-32-le"), np.uint32)
    letter = _letters()[code]
    n_letters = np.bincount(row[letter], minlength=len(lows))
    keep = letter.copy()
    keep[1:] |= letter[:-1] & (row[1:] == row[:-1])  # the first character after a letter stands for the run
    code, row = np.where(letter, code, 32)[keep].astype(np.uint32), row[keep]
    out, owners, h = [], [], np.zeros(len(code), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        m = len(code) - n + 1
        if m <= 0:
            break
        h = (h[:m] ^ code[n - 1 :]) * np.uint32(_MULTIPLIERS[(n - 1) % 3])
        h ^= h >> np.uint32(15)
        if n in ORDERS:
            whole = row[:m] == row[n - 1 :]
            out.append(((h * np.uint32(0x27D4EB2F)) >> np.uint32(32 - buckets.bit_length() + 1))[whole])
            owners.append(row[:m][whole])
    empty = np.zeros(0, np.int32)
    return np.concatenate(out or [empty]), np.concatenate(owners or [empty]), n_letters


def _portions(texts: list, limit: int = 200_000) -> Iterator[tuple[int, int]]:
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= limit:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def _counting(buckets: int):
    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in (p for b in batches for p in portions(b, "text")):
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for lo, hi in _portions(texts):
                found, owner, _ = grams(texts[lo:hi], buckets)
                names = langs[lo:hi]
                for lang in set(names):
                    own = np.array([x == lang for x in names])
                    totals[lang] = totals.get(lang, 0) + np.bincount(found[own[owner]], minlength=buckets)
        for lang, n in totals.items():
            at = np.flatnonzero(n)
            yield arrays_batch({"lang": pa.array([lang] * len(at), pa.string()), "bucket": at.astype(np.int32), "n": n[at].astype(np.int64)})

    return count


def _sample(df: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int) -> tuple[DataFrame, dict[str, int]]:
    """(lang, text) of about per_language rows of each language, and how many rows each has."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("text is not null and lang is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return rows.select("lang", "text"), sizes
    rates = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, per_language / n))])
    draw = F.pmod(F.xxhash64(F.lit(11), F.col("id"), F.col("lang")), F.lit(1 << 30)) / float(1 << 30)
    return rows.filter(draw < rates[F.col("lang")]).select("lang", "text"), sizes


def train(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", buckets: int = BUCKETS, per_language: int = TRAIN_DOCS, alpha: float = 0.5) -> dict:
    """The model: languages in order, log-probabilities (buckets x languages) and log priors.

    Rows with a null text or language teach nothing.  Of each language about per_language rows are used, chosen by a
    hash of the id at a rate from the language's row count, whatever the input's size.
    """
    sample, sizes = _sample(df, id_col, text_col, lang_col, per_language)
    if not sizes:
        return {"languages": [], "logp": np.zeros((buckets, 0), np.float32), "prior": np.zeros(0)}
    counts = sample.mapInArrow(_counting(buckets), "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sizes)
    place = {x: i for i, x in enumerate(languages)}
    matrix = np.full((buckets, len(languages)), alpha)
    np.add.at(matrix, (counts["bucket"].to_numpy(), counts["lang"].map(place).to_numpy(dtype=np.int64)), counts["n"].to_numpy())
    prior = np.array([sizes[x] for x in languages], float)
    return {"languages": languages, "logp": np.log(matrix / matrix.sum(0)).astype(np.float32), "prior": np.log(prior / prior.sum())}


def floors(df: DataFrame, model: dict, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = TRAIN_DOCS) -> np.ndarray:
    """For each language of the model the mean log-likelihood of an n-gram below which a text is in none of them.

    Asked of the training texts that the model gives their own language; -inf for a language without such a text.
    """
    sample, sizes = _sample(df, id_col, text_col, lang_col, per_language)
    out = np.full(len(model["languages"]), -np.inf)
    if not sizes:
        return out
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        low: dict[str, float] = {}
        for batch in (p for b in batches for p in portions(b, "text")):
            names, _, mean, n = scored(shared.value, batch.column("text").to_pylist())
            for lang, own, m, k in zip(batch.column("lang").to_pylist(), names, mean.tolist(), n.tolist(), strict=True):
                if lang == own and k >= FLOOR_GRAMS:
                    low[lang] = min(low.get(lang, 0.0), m)
        yield arrays_batch({"lang": pa.array(list(low), pa.string()), "mean": pa.array(list(low.values()), pa.float64())})

    for r in sample.mapInArrow(run, "lang string, mean double").groupBy("lang").agg(F.min("mean").alias("mean")).collect():
        out[model["languages"].index(r["lang"])] = r["mean"] - FLOOR_MARGIN
    return out


def scored(model: dict, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language and posterior probability of each text, the mean log-likelihood of its n-grams in that language, and their number."""
    names, logp = model["languages"], model["logp"]
    out, score, mean, size = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    if not names:
        return out, score, mean, size
    for lo, hi in _portions(texts):
        found, owner, letters = grams([t or "" for t in texts[lo:hi]], logp.shape[0])
        total = np.tile(model["prior"], (hi - lo, 1))
        for k in range(len(names)):
            total[:, k] += np.bincount(owner, weights=logp[:, k][found], minlength=hi - lo)
        best = total.argmax(1)
        posterior = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        size[lo:hi] = np.bincount(owner, minlength=hi - lo)
        mean[lo:hi] = (total.max(1) - model["prior"][best]) / np.maximum(size[lo:hi], 1)
        for i in np.flatnonzero(letters).tolist():
            out[lo + i] = names[best[i]]
            score[lo + i] = posterior[i]
    return out, score, mean, size


def score_texts(model: dict, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and posterior probability of each text."""
    return scored(model, texts)[:2]


def identify(df: DataFrame, model: dict, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of id_col, lang_pred, score, and the columns in keep; one for each row of df."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kept = df.select(id_col, *keep, *(() if text_col in keep else (F.col(text_col),)))
    rest = [id_col, *keep]

    def run(batches):
        for batch in (p for b in batches for p in portions(b, text_col)):
            lang, score = score_texts(shared.value, batch.column(text_col).to_pylist())
            yield arrays_batch({c: batch.column(c) for c in rest} | {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(score)})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name in rest)
    return kept.mapInArrow(run, f"{schema}, lang_pred string, score double")


def _held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, by a model of those that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(~_held_out()))
    return identify(docs, model).select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str, *, min_score: float = 0.5) -> DataFrame:
    """Keeps the documents whose language is recognised: those with a letter, a best language of probability min_score, and
    n-grams no rarer in it than its floor allows.  Null and empty texts go, repeated rows share one fate."""
    model = train(docs)
    low = floors(docs, model)
    named, c = masked(docs)
    shared = spark.sparkContext.broadcast((model, low))

    def run(batches):
        for batch in (p for b in batches for p in portions(b, c["text"])):
            model, low = shared.value
            place = {x: i for i, x in enumerate(model["languages"])}
            names, score, mean, n = scored(model, batch.column(c["text"]).to_pylist())
            floor = np.array([low[place[x]] if x in place else 0.0 for x in names])
            known = np.array([x in place for x in names], bool)
            yield batch.filter(pa.array(known & (score >= min_score) & ((n < FLOOR_GRAMS) | (mean >= floor))))

    return named.mapInArrow(run, named.schema).toDF(*docs.columns)


QUERIES = {"op1_language_id": op1_language_id}
