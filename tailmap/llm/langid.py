"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point alone.  An n-gram's vector binds the vectors of its
letters, each rotated by its place, by multiplication; a text's vector bundles (adds) those of all its n-grams, and a
language's prototype bundles those of its documents.  A text gets the language whose prototype has the largest cosine.

An n-gram's vector is made once for each slice of texts and counted as often as it occurs, which gives the same sum as adding
it each time.  A slice has ``PART`` n-grams and ``TEXTS`` texts at most, a longer text goes through several, and vectors are made
in blocks; so memory does not follow the length of a text or the number of its n-grams.  Training adds up one vector for each language in every task and sums these over the tasks, dimension by dimension, so
what reaches the driver is languages x dimensions numbers; more than ``MAX_LANGUAGES`` raises an error.

Training reads ``max_train_docs`` labelled rows at most: those with the smallest hashes of id, text and language, repeated rows
once.  Prediction reads every whole text.

Defined results: a text that is null or has no letter gets ``und`` and score 0; so does every text where nothing was learned;
cosines that are equal to six decimals go to the language that sorts first; a score below ``noise_bound`` says no more than chance, so there
``keep_identified`` knows no language, be the text of one that was never learned or too short to tell; repeated rows and null ids get a row each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

DIMENSIONS, NGRAM, MAX_TRAIN_DOCS, MAX_LANGUAGES = 1024, 3, 20_000, 1000
#: How likely a text that shares no n-gram with any language may pass for one, by the noise of the vectors alone.
CHANCE = 0.001
#: N-grams and texts that are worked on at a time.
PART, TEXTS = 1 << 19, 1000

_LETTERS: dict[str, np.ndarray] = {}
_VECTORS: dict[int, dict[int, np.ndarray]] = {}


def _letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or a space for all that is no letter."""
    if not _LETTERS:
        out = np.full(0x110000, 32, dtype=np.uint32)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                out[c] = ord(low) if len(low) == 1 else c
        _LETTERS["table"] = out
    return _LETTERS["table"]


def letter_vector(code: int, dimensions: int) -> np.ndarray:
    """The random vector of a letter."""
    known = _VECTORS.setdefault(dimensions, {})
    if code not in known:
        if len(known) > 20_000:
            known.clear()
        seed = xxhash.xxh3_64_intdigest(code.to_bytes(4, "little"))
        known[code] = np.random.default_rng(seed).choice(np.array([-1, 1], dtype=np.int8), dimensions)
    return known[code]


def ngram_vectors(keys: np.ndarray, dimensions: int, n: int) -> np.ndarray:
    """Bound vectors (rows of +1 and -1) of n-grams, given as n code points of 21 bits each."""
    parts = [((keys >> (21 * (n - 1 - j))) & 0x1FFFFF).astype(np.int64) for j in range(n)]
    letters = np.unique(np.concatenate(parts)) if len(keys) else np.zeros(0, dtype=np.int64)
    base = np.stack([letter_vector(int(c), dimensions) for c in letters]) if len(letters) else np.zeros((0, dimensions), dtype=np.int8)
    out = np.ones((len(keys), dimensions), dtype=np.int8)
    for j, part in enumerate(parts):
        out *= np.roll(base, n - 1 - j, axis=1)[np.searchsorted(letters, part)]
    return out


def gram_keys(text: str, n: int, chars: int = 1 << 18) -> Iterator[np.ndarray]:
    """The n-grams of a text, as n code points of 21 bits each, in parts of about so many.

    A word is set off by one space, whatever stands between words; a text without a letter has none.
    """
    table, seam, letter_before, begun = _letter_table(), np.zeros(0, dtype=np.int64), False, False
    for at in range(0, len(text) + 1, chars):
        codes = table[np.frombuffer(text[at : at + chars].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        letter = codes != 32
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        if len(keep):
            keep[0] |= letter_before
            letter_before = bool(letter[-1])
        kept = [seam, codes[keep].astype(np.int64)]
        if not begun and letter.any():
            kept.insert(1, np.array([32]))
            begun = True
        if begun and at + chars > len(text):
            kept.append(np.array([32]))
        codes = np.concatenate(kept)
        k = np.zeros(max(0, len(codes) - n + 1), dtype=np.int64)
        for j in range(n):
            k = (k << 21) | codes[j : j + len(k)]
        seam = codes[len(k) :]
        if len(k):
            yield k


def _add(waiting: list[tuple[int, np.ndarray]], sums: np.ndarray, n: int, block: int = 4096) -> None:
    """Add the vectors of these n-grams to the rows of ``sums`` that they belong to."""
    if not waiting:
        return
    codes, distinct = pd.factorize(np.concatenate([k for _, k in waiting]))
    held, end = [], 0
    for i, k in waiting:
        c = np.bincount(codes[end : end + len(k)])
        end += len(k)
        places = np.flatnonzero(c)
        held.append((i, places, c[places].astype(np.float32)))
    for at in range(0, len(distinct), block):
        vectors = ngram_vectors(distinct[at : at + block], sums.shape[1], n)
        for i, places, c in held:
            lo, hi = np.searchsorted(places, (at, at + block))
            if lo < hi:
                # Whole numbers below 2^24: exact.
                sums[i] += c[lo:hi] @ vectors[places[lo:hi] - at].astype(np.float32)


def bundles(texts: list[str], dimensions: int, n: int) -> Iterator[tuple[np.ndarray, int]]:
    """For each text the sum of its n-grams' vectors, and their number."""
    for at in range(0, len(texts), TEXTS):
        some = texts[at : at + TEXTS]
        sums, totals, waiting, size = np.zeros((len(some), dimensions)), [0] * len(some), [], 0
        for i, text in enumerate(some):
            for keys in gram_keys(text, n):
                totals[i] += len(keys)
                waiting.append((i, keys))
                size += len(keys)
                if size >= PART:
                    _add(waiting, sums, n)
                    waiting, size = [], 0
        _add(waiting, sums, n)
        yield from zip(sums, totals, strict=True)


def prototypes(labelled: DataFrame, *, dimensions: int = DIMENSIONS, n: int = NGRAM) -> tuple[list[str], np.ndarray]:
    """Languages in code-point order and their unit prototypes, of rows text, lang (both not null)."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for at in range(0, b.num_rows, TEXTS):
                part = b.slice(at, TEXTS)
                for lang, (v, grams) in zip(part.column(1).to_pylist(), bundles(part.column(0).to_pylist(), dimensions, n), strict=True):
                    # Every document counts alike, however long.
                    sums[lang] = sums.get(lang, 0) + v / max(1, grams)
        for lang, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dimensions), pa.array(np.arange(dimensions), pa.int32()), pa.array(v.astype(np.float64))], names=["lang", "dimension", "value"])

    rows = labelled.select("text", "lang").mapInArrow(bundle, "lang string, dimension int, value double")
    # Whole numbers add up to the same sum in any order of the tasks.
    summed = rows.groupBy("lang", "dimension").agg(F.sum(F.round(F.col("value") * 1e6).cast("long")).alias("value")).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("dimension", "value"))).alias("v"))
    found = sorted((r.lang, [x.value for x in r.v]) for r in summed.limit(MAX_LANGUAGES + 1).collect())
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not found:
        return [], np.zeros((0, dimensions), dtype=np.float32)
    matrix = np.array([v for _, v in found], dtype=np.float64)
    return [lang for lang, _ in found], (matrix / np.maximum(1e-12, np.linalg.norm(matrix, axis=1, keepdims=True))).astype(np.float32)


def sample_of(labelled: DataFrame, max_docs: int) -> DataFrame:
    """``max_docs`` rows at most, chosen by a hash of all columns; of repeated rows one."""
    key = free_name(labelled, "key")
    named = labelled.withColumn(key, F.xxhash64(*labelled.columns, F.lit("lang-sample")))
    last = named.select(key).distinct().orderBy(key).limit(max_docs).agg(F.max(key)).first()[0]
    return named.where(F.col(key) <= F.lit(last)).dropDuplicates([key]).drop(key)


def judge_of(docs: DataFrame, languages: list[str], matrix: np.ndarray, *, n: int = NGRAM):
    """A function of a text column that gives struct<lang_pred, score>."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast((languages, matrix))  # at most MAX_LANGUAGES x dimensions numbers

    @F.pandas_udf("lang_pred string, score double")
    def judge(frames: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        languages, matrix = known.value
        for series in frames:
            preds, scores = [], []
            for v, grams in bundles([t or "" for t in series], matrix.shape[1], n):
                if not grams or not languages:
                    preds.append("und")
                    scores.append(0.0)
                    continue
                cosine = (matrix @ v) / max(1e-12, float(np.linalg.norm(v)))
                best = int(np.argmax(np.round(cosine, 6)))
                preds.append(languages[best])
                scores.append(min(1.0, max(0.0, float(cosine[best]))))
            yield pd.DataFrame({"lang_pred": preds, "score": scores})

    return judge


def predict(docs: DataFrame, languages: list[str], matrix: np.ndarray, *, n: int = NGRAM, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (the cosine, 0 to 1) added; columns of these names are replaced."""
    judge = judge_of(docs, languages, matrix, n=n)
    said = free_name(docs, "said")
    return docs.withColumn(said, judge(F.col(text_col).cast("string"))).withColumns({"lang_pred": F.col(said)["lang_pred"], "score": F.col(said)["score"]}).drop(said)


def held_out(id_col: str = "doc_id", part: int = 1, of: int = 3) -> Column:
    """Whether a document is kept from training: crc32 of its id as text has that remainder."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(of)) == part, F.lit(False))


def training_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, text, lang of the documents that may be learned from: not held out, with text and language."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return rows.where(~held_out()).where("lang is not null and text is not null")


def noise_bound(languages: int, dimensions: int = DIMENSIONS, chance: float = CHANCE) -> float:
    """The cosine that the best of so many languages reaches with that chance where nothing is shared.

    The cosine of unrelated vectors has a standard deviation of 1 / sqrt(dimensions).
    """
    return NormalDist().inv_cdf(1 - chance / languages) / dimensions**0.5


def keep_identified(docs: DataFrame, *, least: float | None = None, max_train_docs: int = MAX_TRAIN_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of ``least`` or more, with all their columns.

    Without ``least`` it is the ``noise_bound`` of the languages that were learned.
    Where nothing can be learned, as no row has a language, every row with a letter stays.
    """
    learned = prototypes(sample_of(training_rows(docs, id_col=id_col, text_col=text_col, lang_col=lang_col), max_train_docs))
    if not learned[0]:
        return docs.where(F.coalesce(F.col(text_col).cast("string").rlike(r"\p{L}"), F.lit(False)))
    least = noise_bound(len(learned[0]), learned[1].shape[1]) if least is None else least
    said = free_name(docs, "judged")
    judged = docs.withColumn(said, judge_of(docs, *learned)(F.col(text_col).cast("string")))
    return judged.where((F.col(said)["lang_pred"] != "und") & (F.col(said)["score"] >= least)).drop(said)


def identify(docs: DataFrame, *, max_train_docs: int = MAX_TRAIN_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learns from documents that are not held out and have a lang."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    languages, matrix = prototypes(sample_of(training_rows(docs, id_col=id_col, text_col=text_col, lang_col=lang_col), max_train_docs))
    return predict(rows.select("doc_id", held_out().alias("held_out"), "text"), languages, matrix).select("doc_id", "held_out", "lang_pred", "score")
