"""Periodic runs of words: the lags of earlier occurrences, counted along diagonals."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from areastats.llm.common import slices

#: A run has at least so many words and so many times its period.
LEAST_WORDS, LEAST_PERIODS = 6, 4
RUNS = "array<struct<start:long,length:long,period:long>>"


def lag_ranges(words: int) -> Iterator[tuple[int, int, int]]:
    """(lowest lag, highest lag, words that match at least) up to the lags that `words` words allow.

    A run of period q matches over max(6 - q, 3 q) words at least. A range ends at 1.5 times
    its lowest lag, so what surely matches is at least twice any lag of the range.
    """
    low = 1
    while LEAST_PERIODS * low <= words:
        high = low + low // 2
        yield low, high, max(LEAST_WORDS - low, (LEAST_PERIODS - 1) * low, 2 * high)
        low = high + 1


class Diagonals:
    """Words of several documents as numbers, and the nearest earlier place of every stretch of words.

    Within a range of lags, a word is looked up together with the words that have to match after it.
    Such a stretch is at least twice as long as the lag. If it has occurred at a smaller lag
    too, then by the periodicity lemma both lags are multiples of a smaller period of the whole
    run, so the lag of a run is always that of the nearest earlier occurrence: one look-up
    a word, however often a word or line comes. Stretches are named exactly, two names of half the length
    make one; what occurs once in its document is dropped, so longer stretches only look at repeats.
    """

    def __init__(self, ids: np.ndarray, starts: np.ndarray):
        self.ids, self.starts = ids, starts
        self.ends = np.append(starts[1:], len(ids))
        self.doc = np.repeat(np.arange(len(starts)), self.ends - starts)
        self.size = 1
        self.name = ids + 1
        self.open = np.arange(len(ids))

    def _named(self, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(places, keys, order by key and place, same document and key as the one before)."""
        at = at[at + size <= self.ends[self.doc[at]]]
        first, second = self.name[at], self.name[at + size - self.size]
        both = (first > 0) & (second > 0)
        at, keys = at[both], (first[both].astype(np.int64) << 32) | second[both]
        order = np.argsort(keys, kind="stable")
        k, d = keys[order], self.doc[at[order]]
        return at, keys, order, (k[1:] == k[:-1]) & (d[1:] == d[:-1])

    def _double(self) -> None:
        at, keys, order, same = self._named(self.open, 2 * self.size)
        repeated = np.zeros(len(at), bool)
        repeated[order[1:]] |= same
        repeated[order[:-1]] |= same
        named = np.empty(len(at), np.int64)
        k = keys[order]
        named[order] = np.cumsum(np.append(True, k[1:] != k[:-1])[: len(k)])
        self.open = at[repeated]
        self.name = np.zeros(len(self.ids), np.int64)
        self.name[self.open] = named[repeated]
        self.size *= 2

    def lags(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, lags): `least` words from a place on occurred so far back, and not since."""
        while 2 * self.size <= least and len(self.open):
            self._double()
        at, _, order, same = self._named(self.open, least)
        place = at[order]
        lag = np.zeros(len(at), np.int64)
        lag[order[1:]] = np.where(same, place[1:] - place[:-1], 0)
        return at[lag > 0], lag[lag > 0]

    def match(self, at: int, lag: int, step: int) -> int:
        """How many words from a place on (step 1) or back (step -1) equal the words a lag before them."""
        doc = self.doc[at]
        room = self.ends[doc] - at if step > 0 else at - lag - self.starts[doc] + 1
        done, width = 0, 64
        while done < room:
            width = min(2 * width, int(room) - done)
            here = self.ids[at + done : at + done + width] if step > 0 else self.ids[at - done - width + 1 : at - done + 1]
            low = at - lag + done if step > 0 else at - lag - done - width + 1
            equal = here == self.ids[low : low + width]
            if not equal.all():
                return done + int(np.argmin(equal if step > 0 else equal[::-1]))
            done += width
        return done

    def runs(self) -> list[list[tuple[int, int, int]]]:
        """(start, length, period) of the runs of each document, by start, then period."""
        found: list[set[tuple[int, int, int]]] = [set() for _ in self.starts]
        longest = int((self.ends - self.starts).max(initial=0))
        for low, high, least in lag_ranges(longest):
            if not len(self.open):
                break
            at, lag = self.lags(least)
            fits = (lag >= low) & (lag <= high)
            at, lag = at[fits], lag[fits]
            # a place whose lag is that of the place before it lengthens that diagonal, others open one
            opens = np.append(True, (np.diff(at) != 1) | (np.diff(lag) != 0) | (np.diff(self.doc[at]) != 0))[: len(at)]
            for first, q in zip(at[opens].tolist(), lag[opens].tolist(), strict=True):
                doc = int(self.doc[first])
                back = self.match(first - 1, q, -1) if first - 1 - q >= self.starts[doc] else 0
                length = q + back + self.match(first, q, 1)
                if length >= max(LEAST_WORDS, LEAST_PERIODS * q):
                    found[doc].add((first - back - q - int(self.starts[doc]), length, q))
        return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def runs_of(documents: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each document, given as lists of words."""
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for words in documents for w in words], np.int64)
    filled = [k for k, words in enumerate(documents) if words]
    sizes = [len(documents[k]) for k in filled]
    result: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    if filled:
        for k, runs in zip(filled, Diagonals(ids, np.cumsum([0, *sizes[:-1]])).runs(), strict=True):
            result[k] = runs
    return result


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if runs:
        depth = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            depth[start + period] += 1
            depth[start + length] -= 1
        kept = np.cumsum(depth[:-1]) == 0
        words = [w for w, k in zip(words, kept.tolist(), strict=True) if k]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every document, from its whole text.

    Words are `[^\\x20\\x09-\\x0D]+`. A run is a stretch of consecutive words with smallest period q and
    at least max(6, 4 q) words that no neighbouring word extends; runs come by start, then period.
    `collapsed` keeps the words that no run holds after its first period. Null and empty texts have no
    words and no runs, a null id stays null, repeated rows give repeated results, an empty table
    gives no rows and further columns are ignored. A task holds one slice of texts; its
    work is n log n in the words of a text whatever repeats in it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                words = [t.encode().split() for t in texts]
                runs = runs_of(words)
                columns = [
                    part.column("doc_id"), pa.array([len(w) for w in words], pa.int64()),
                    pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs], pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))),
                    pa.array([collapsed(w, r) for w, r in zip(words, runs, strict=True)], pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def looped(doc_id: Column, text: Column) -> Column:
    """Texts of documents whose crc32(doc_id) ends in 0, with a made period; other texts as they are.

    Of n words, word i >= a becomes word a + (i - a) mod p, where g = crc32 div 10, a = g mod n and
    p = 1 + (n - a) div (3 + g mod 8). A null id leaves the text alone.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.filter(F.split(text, "[ \\x09-\\x0D]+"), lambda w: w != "")

    def repeated(w: Column) -> Column:
        n, g = F.size(w).cast("long"), F.floor(h / 10).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        source = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(w, source(i).cast("int"))), " ")

    made = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise("")), F.lit(0))
    return F.when((h % 10 == 0) & text.isNotNull(), made).otherwise(text)


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_runs, longest run, hashes of all runs and of the kept words) of `periodic_runs`."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed")
    return rows.select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
