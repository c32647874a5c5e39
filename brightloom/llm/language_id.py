"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting runs in Spark tasks; the log-probability matrix (hash buckets x languages) is the only thing that is
broadcast, and its size depends on the number of languages, not of documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.llm.common import free_name, hash_share, slices, small_batches

UNDETERMINED = "und"
_CHUNK = 1 << 18
_MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917], np.uint32)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    log_prob: np.ndarray  # (buckets + 1, languages); the last row is zero and stands for "no n-gram here"
    log_prior: np.ndarray


_table: list[np.ndarray] = []  # filled once per worker


def _letters() -> np.ndarray:
    """One flag per code point: is it a letter."""
    if not _table:
        _table.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _table[0]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _gram_ids(codes: np.ndarray, room: np.ndarray, buckets: int, orders: int) -> Iterator[np.ndarray]:
    """Bucket of the n-gram that starts at each position, for every order; ``buckets`` where there is none.

    ``room`` is the number of characters left in the position's own text, so no n-gram crosses two texts. Runs
    of other characters count as blanks; n-grams without a letter are left out.
    """
    letter = _letters()[codes]
    c = np.where(letter, codes, np.uint32(32))
    h = np.zeros(len(c), np.uint32)
    any_letter = np.zeros(len(c), bool)
    for n in range(orders):
        m = max(len(c) - n, 0)
        h[:m] = (h[:m] ^ c[n:]) * _MULTIPLIERS[n % 3]
        any_letter[:m] |= letter[n:]
        ids = ((h ^ (h >> np.uint32(15))) * np.uint32(668265263) >> np.uint32(8)) % np.uint32(buckets)
        yield np.where((room > n) & any_letter, ids, buckets)


def _pieces(texts: list[str], orders: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(codes, room, row)`` arrays of at most about ``_CHUNK`` characters; long texts come in overlapping pieces."""
    joined, rows, lengths = [], [], []

    def flush():
        codes = np.concatenate(joined)
        n = np.array(lengths)
        room = np.repeat(np.cumsum(n), n) - np.arange(len(codes))
        return codes, room, np.repeat(np.array(rows), n)

    size = 0
    for row, text in enumerate(texts):
        codes = _codes(text)
        for start in range(0, len(codes), _CHUNK):
            piece = codes[start : start + _CHUNK + orders - 1]
            if size and size + len(piece) > _CHUNK:
                yield flush()
                joined, rows, lengths, size = [], [], [], 0
            joined.append(piece)
            rows.append(row)
            lengths.append(len(piece))
            size += len(piece)
            if start + _CHUNK < len(codes):  # the last characters start the next piece
                c, room, own = flush()
                room = np.where(np.arange(len(c)) < len(c) - (orders - 1), room, 0)
                yield c, room, own
                joined, rows, lengths, size = [], [], [], 0
    if joined:
        yield flush()


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = 4000, buckets: int = 1 << 15, orders: int = 3) -> LanguageModel:
    """Fit on a sample of about ``per_language`` rows of each language, drawn by the hash of ``key`` (all rows where fewer).

    Rows with a null text or language are not used. Without any labelled row the model has no language and
    predicts ``und`` for every text. N-gram counts are summed in tasks and by language and bucket in Spark; the
    driver gets one row per non-empty (language, bucket) cell.
    """
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.expr("count(1) AS n")).collect()}
    if not totals:
        return LanguageModel((), np.zeros((buckets + 1, 0)), np.zeros(0))
    rate = F.lit(1.0)
    for name, n in totals.items():
        if n > per_language:
            rate = F.when(F.col("lang") == name, per_language / n).otherwise(rate)
    sample = rows.filter(hash_share(17, "k") < rate).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            names, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for name in set(names):
                mine = [t for n, t in zip(names, texts) if n == name]
                total = sums.setdefault(name, np.zeros(buckets + 1, np.int64))
                for codes, room, _ in _pieces(mine, orders):
                    for ids in _gram_ids(codes, room, buckets, orders):
                        total += np.bincount(ids, minlength=buckets + 1)
        for name, total in sums.items():
            at = np.flatnonzero(total[:buckets])
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["lang", "bucket", "n"])

    cells = small_batches(sample).mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = tuple(sorted(totals))
    counts = np.ones((buckets, len(languages)))  # add-one smoothing
    column = {name: i for i, name in enumerate(languages)}
    counts[cells.column("bucket").to_numpy(), [column[x] for x in cells.column("lang").to_pylist()]] += cells.column("n").to_numpy()
    log_prob = np.vstack([np.log(counts / counts.sum(0)), np.zeros(len(languages))])
    prior = np.array([min(totals[x], per_language) for x in languages], float)
    return LanguageModel(languages, log_prob, np.log(prior / prior.sum()))


def score_texts(languages: tuple[str, ...], log_prob: np.ndarray, log_prior: np.ndarray, texts: list[str | None], orders: int = 3) -> tuple[list[str], np.ndarray]:
    """Language and posterior of each text: sparse counts times log-probabilities, summed per text."""
    buckets, n_lang = log_prob.shape[0] - 1, len(languages)
    total = np.tile(log_prior, (len(texts), 1))
    has_letter = np.zeros(len(texts), bool)
    for first, run in slices(texts, _CHUNK):
        for codes, room, row in _pieces(run, orders):
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            at = first + row[starts]
            has_letter[at] |= np.logical_or.reduceat(_letters()[codes], starts)
            for ids in _gram_ids(codes, room, buckets, orders):
                for j in range(n_lang):
                    np.add.at(total[:, j], at, np.add.reduceat(log_prob[:, j][ids], starts))
    if not n_lang:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    best = total.argmax(1)
    posterior = 1.0 / np.exp(total - total.max(1, keepdims=True)).sum(1)
    names = [languages[j] if ok else UNDETERMINED for j, ok in zip(best, has_letter)]
    return names, np.where(has_letter, posterior, 0.0)


def language_of(df: DataFrame, model: LanguageModel, text: str = "text") -> Column:
    """Struct column ``(lang_pred, score)`` of a text column.

    ``und`` and 0 where the text is null or has no letter. Ties go to the first language by name.
    """
    held = small_batches(df).sparkSession.sparkContext.broadcast((model.languages, model.log_prob, model.log_prior))

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            names, scores = score_texts(*held.value, [None if t is None or t != t else t for t in s])
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return predict.asNondeterministic()(F.col(text))  # else a filter on it would evaluate it twice


def held_out(key: str = "doc_id") -> Column:
    """Documents that no model learns from: crc32 of the key as text, modulo 4, is 2 (a null key is not held out)."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def identify_languages(docs: DataFrame, **params) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row; learns from rows that are not held out.

    Repeated rows are scored alike; an empty table gives no rows; other columns of ``docs`` are not looked at.
    """
    model = train(docs.filter(~held_out()), **params)
    return docs.select("doc_id", held_out().alias("held_out"), language_of(docs, model).alias("p")).select("doc_id", "held_out", "p.*")


def drop_unidentified(docs: DataFrame, min_score: float = 0.5, **params) -> DataFrame:
    """Rows of ``docs`` whose language is determined with at least ``min_score``; columns unchanged."""
    model = train(docs.filter(~held_out()), **params)
    if not model.languages:  # nothing to learn from: nothing is rejected
        return docs
    cols, name = [F.col(f"`{c}`") for c in docs.columns], free_name(docs, "__language")
    marked = docs.select(*cols, language_of(docs, model).alias(name))
    return marked.filter((F.col(name)["lang_pred"] != UNDETERMINED) & (F.col(name)["score"] >= min_score)).drop(name)
