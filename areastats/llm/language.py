"""Language identification: multinomial naive Bayes over hashed character n-grams."""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from areastats.llm.common import bounded_sample, fold, slices

ORDERS = (2, 3)
BUCKETS = 1 << 15
#: Training documents of each language at most.
SAMPLE = 3000
#: n-grams scored at a time.
BLOCK = 1 << 16
#: Letters and also fractions, Roman and circled numbers, which are none.
LETTER = re.compile(r"[^\W\d_]")


def lettered(text: str) -> bool:
    return any(m[0].isalpha() for m in LETTER.finditer(text))


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of the n-grams of all texts, first n-gram of each text).

    Texts are lower-cased and end with two spaces, so that each holds an n-gram of every order
    and none reaches into the next text.
    """
    padded = [f" {t.lower()}  " for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    firsts = np.cumsum([0, *(len(t) for t in padded[:-1])])
    rolling = codes * np.uint32(0x9E3779B1)
    parts, h = [], rolling
    for n in range(2, max(ORDERS) + 1):
        h = h[:-1] * np.uint32(31) + rolling[n - 1 :]
        if n in ORDERS:
            whole = np.zeros(len(codes), np.int32)
            whole[: len(h)] = (h ^ (h >> np.uint32(15))) % np.uint32(BUCKETS)
            parts.append(whole)
    # the last two places of a text are n-grams that reach over its end: all of them fall on
    # the first bucket, as a constant that tells no language from another
    ends = np.append(firsts[1:], len(codes))
    for whole in parts:
        whole[ends - 1] = 0
        whole[ends - 2] = 0
    return np.stack(parts, axis=1).ravel(), firsts * len(parts)


class NaiveBayes:
    """Log probabilities (bucket, language) and log priors."""

    def __init__(self, languages: list[str], counts: np.ndarray, documents: np.ndarray, smooth: float = 0.1):
        self.languages = languages
        counts = counts.astype(np.float64)
        counts[0] = 0
        self.logp = np.log((counts + smooth) / (counts + smooth).sum(axis=0)).astype(np.float32)
        self.logp[0] = 0
        self.prior = np.log((documents + 1.0) / (documents + 1.0).sum())

    def posterior(self, texts: list[str]) -> np.ndarray:
        """Probability of each language for each text."""
        buckets, firsts = ngrams(texts)
        total = np.zeros((len(texts), len(self.languages))) + self.prior
        for at in range(0, len(buckets), BLOCK):
            part = buckets[at : at + BLOCK]
            low, high = np.searchsorted(firsts, [at, at + len(part) - 1], side="right") - 1
            starts = np.maximum(firsts[low : high + 1] - at, 0)
            total[low : high + 1] += np.add.reduceat(self.logp[part], starts, axis=0, dtype=np.float64)
        total -= total.max(axis=1, keepdims=True)
        odds = np.exp(total)
        return odds / odds.sum(axis=1, keepdims=True)

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """The likeliest language (the first of equals) and its probability; `und` without a letter."""
        if not texts or not self.languages:
            return ["und"] * len(texts), [0.0] * len(texts)
        odds = self.posterior(texts)
        best = odds.argmax(axis=1)
        known = [lettered(t) for t in texts]
        names = [self.languages[b] if k else "und" for b, k in zip(best, known, strict=True)]
        return names, [float(odds[i, b]) if k else 0.0 for i, (b, k) in enumerate(zip(best, known, strict=True))]


def fitted(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int) -> NaiveBayes:
    """Count n-grams by language in up to about `sample` documents each, outside the held-out fold."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where((fold(F.col("doc_id"), 4) != 2) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    known = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}  # one row per language
    languages = sorted(known)
    chosen = bounded_sample(rows, "doc_id", sample, strata="lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part, texts in slices(batch, "text"):
                langs = np.array(part.column("lang").to_pylist(), object)
                for lang in set(langs):
                    own = ngrams([texts[i] for i in np.flatnonzero(langs == lang)])[0]
                    total[lang] = total.get(lang, 0) + np.bincount(own, minlength=BUCKETS)
        for lang, n in total.items():
            some = np.flatnonzero(n)
            columns = [pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(n[some].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    counted = chosen.select("lang", "text").mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n"))
    counts = np.zeros((BUCKETS, len(languages)))
    place = {lang: k for k, lang in enumerate(languages)}
    for lang, bucket, n in counted.collect():  # at most BUCKETS rows per language
        counts[bucket, place[lang]] = n
    return NaiveBayes(languages, counts, np.array([known[lang] for lang in languages], float))


def languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document, from its whole text.

    Learns from documents with a text and a language whose crc32(doc_id) mod 4 is not 2. Null
    texts and texts without a letter get `und` with score 0, and so does everything if
    nothing can be learnt. Repeated rows give repeated results.
    """
    model = fitted(docs, id_col, text_col, lang_col, sample)  # BUCKETS x languages; Spark broadcasts the closure

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                names, scores = model.predict(texts)
                columns = [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), (fold(F.col(id_col), 4) == 2).alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
