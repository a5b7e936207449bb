"""Toxicity: a bidirectional gated recurrent network with attention over word and character inputs.

The network is trained in NumPy on the driver from a bounded sample of labelled documents and
scores every overlapping window of every document inside the tasks. A document's
score is the calibrated score of its worst window.
"""

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from areastats.llm.common import bounded_sample, fold, schema_of, settled_labels, slices, stored

WORD = re.compile(r"[^\W_]+")
#: Words in a window, and from one window to the next.
WINDOW, STEP = 64, 48
#: Labelled documents that training uses at most; words and n-gram buckets with a vector of their own.
SAMPLE, VOCABULARY, BUCKETS = 6000, 20_000, 1 << 14
DIM, HIDDEN, ATTENTION = 8, 8, 8
#: Training steps between looks at the calibration part, each so many documents' windows.
TURNS, BATCH = (10, 20, 40, 80, 150), 256
#: Words whose inputs are made at a time.
PART = 16_384
#: Distinct words whose inputs a task keeps.
LEXICON = 100_000
PAD = 0


def windows(length: int) -> list[int]:
    """First words of the windows that cover so many words; the last one ends with the text."""
    if length <= WINDOW:
        return [0]
    starts = list(range(0, length - WINDOW, STEP))
    return [*starts, length - WINDOW]


def ngram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character 3- and 4-grams of '<word>' for each word: (buckets, first place per word)."""
    text = "".join(f"<<{w}>>" for w in words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    ends = np.cumsum([len(w) + 4 for w in words])
    starts = ends - np.array([len(w) + 4 for w in words])
    h = codes * np.uint64(0x9E3779B97F4A7C15)
    h3 = h[:-2] * np.uint64(31) + h[1:-1] * np.uint64(17) + h[2:]
    h4 = h3[:-1] * np.uint64(131) + h[3:] + np.uint64(7)
    h3, h4 = (h3[: len(h4)] >> np.uint64(40)), (h4 >> np.uint64(40))
    both = np.stack([h3, h4], axis=1).ravel() % np.uint64(BUCKETS)
    # places 1 .. len + 0 of each word are n-grams that lie inside '<word>'
    keep = np.ones(len(h3) + 3, bool)[: len(codes)]
    for k in (1, 2, 3):
        keep[ends - k] = False
    keep[starts] = False
    kept = np.flatnonzero(keep[: len(h3)])
    firsts = np.searchsorted(kept, starts)
    buckets = both.reshape(-1, 2)[kept].ravel().astype(np.int64)
    return buckets, firsts * 2


def softsign(x: np.ndarray) -> np.ndarray:
    """The squashing function of the network; no exponentials, so windows are cheap."""
    return x / (1 + np.abs(x))


def gate_slope(g: np.ndarray) -> np.ndarray:
    """Slope of the gate 0.5 + 0.5 softsign(x), from its value."""
    return 0.5 * (1 - np.abs(2 * g - 1)) ** 2


def row_sums(rows: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Sums of the values of equal rows."""
    return np.stack([np.bincount(rows, weights=v, minlength=count) for v in values.T], axis=1).astype(np.float32)


class Lexicon(dict):
    """Numbers words from 1 in order of appearance."""

    def __missing__(self, word: str) -> int:
        self[word] = own = len(self) + 1
        return own


class Network:
    """Parameters, scoring and training. Directions are the first axis of the recurrent arrays."""

    def __init__(self, vocabulary: dict[str, int], word_prior: np.ndarray, gram_prior: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        small = lambda *shape, by: (rng.standard_normal(shape) / np.sqrt(by)).astype(np.float32)
        self.vocabulary = vocabulary
        words, grams = small(len(word_prior), DIM, by=100), small(BUCKETS, DIM, by=100)
        words[:, 0], grams[:, 0] = word_prior, gram_prior
        words[:2] = 0
        d = 2 * DIM
        self.p = {
            "words": words, "grams": grams,
            "wx": small(2, d, 3 * HIDDEN, by=d), "bx": np.zeros((2, 1, 3 * HIDDEN), np.float32),
            "wh": small(2, HIDDEN, 3 * HIDDEN, by=HIDDEN),
            "wa": small(2 * HIDDEN, ATTENTION, by=2 * HIDDEN), "ba": np.zeros(ATTENTION, np.float32), "va": small(ATTENTION, by=ATTENTION),
            "wo": small(2 * HIDDEN, by=2 * HIDDEN), "bo": np.zeros(1, np.float32),
        }
        self.scale = np.array([1.0, 0.0])
        self.lexicon, self.projected = Lexicon(), None

    # ---- inputs: row 0 is padding --------------------------------------------------------

    def vectors(self, ids: np.ndarray, buckets: np.ndarray, firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Vectors of distinct words: the word's own (or the unknown's) and the mean of its n-grams'."""
        out = np.zeros((len(ids) + 1, 2 * DIM), np.float32)
        if len(ids):
            out[1:, :DIM] = self.p["words"][ids]
            out[1:, DIM:] = np.add.reduceat(self.p["grams"][buckets], firsts, axis=0) / counts[:, None]
        return out

    def inputs(self, words: list[str]) -> np.ndarray:
        """The input table of these words, made some thousand words at a time."""
        parts = [np.zeros((1, 2 * DIM), np.float32)]
        for at in range(0, len(words), PART):
            some = words[at : at + PART]
            buckets, firsts = ngram_buckets(some)
            ids = np.array([self.vocabulary.get(w, 1) for w in some], np.int64)
            parts.append(self.vectors(ids, buckets, firsts, np.diff(np.append(firsts, len(buckets))))[1:])
        return np.concatenate(parts)

    # ---- forward -------------------------------------------------------------------------

    def project(self, table: np.ndarray) -> np.ndarray:
        return table[None] @ self.p["wx"] + self.p["bx"]

    def forward(self, projected: np.ndarray, ids: np.ndarray, keep: bool = False):
        """Logits of windows `ids` (windows, WINDOW) of rows of `projected`; with `keep`, also the states."""
        p, (n, steps) = self.p, ids.shape
        h = np.zeros((2, n, HIDDEN), np.float32)
        states = np.empty((steps + 1, 2, n, HIDDEN), np.float32)
        states[0] = h
        gates = []
        a = np.empty((2, n, 3 * HIDDEN), np.float32)
        for t in range(steps):
            projected[0].take(ids[:, t], axis=0, out=a[0])
            projected[1].take(ids[:, steps - 1 - t], axis=0, out=a[1])
            g = h @ p["wh"]
            rz = 0.5 + 0.5 * softsign(a[..., : 2 * HIDDEN] + g[..., : 2 * HIDDEN])
            r, z, gn = rz[..., :HIDDEN], rz[..., HIDDEN:], g[..., 2 * HIDDEN :]
            c = softsign(a[..., 2 * HIDDEN :] + r * gn)
            h = c + z * (h - c)
            states[t + 1] = h
            if keep:
                gates.append((r, z, gn, c))
        both = np.concatenate([states[1:, 0], states[:0:-1, 1]], axis=-1)  # (steps, n, 2 HIDDEN)
        hidden = softsign(both @ p["wa"] + p["ba"])
        e = np.where(ids.T == PAD, np.float32(-1e9), hidden @ p["va"])
        alpha = np.exp(e - e.max(axis=0))
        alpha /= alpha.sum(axis=0)
        pooled = (alpha[..., None] * both).sum(axis=0)
        logit = pooled @ p["wo"] + p["bo"][0]
        return (logit, (states, gates, both, hidden, alpha, pooled)) if keep else logit

    def gradients(self, table: np.ndarray, ids: np.ndarray, kept: tuple, dlogit: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the dense parameters, and of the rows of the input table."""
        p, (states, gates, both, hidden, alpha, pooled) = self.p, kept
        n, steps = ids.shape
        grad = {"wo": pooled.T @ dlogit, "bo": dlogit.sum(keepdims=True)}
        dpooled = dlogit[:, None] * p["wo"]
        dalpha = np.einsum("tnh,nh->tn", both, dpooled)
        de = alpha * (dalpha - (alpha * dalpha).sum(axis=0))
        dhidden = de[..., None] * p["va"] * (1 - np.abs(hidden)) ** 2
        grad["va"] = (hidden * de[..., None]).sum(axis=(0, 1))
        flat = lambda x: x.reshape(-1, x.shape[-1])
        grad["wa"], grad["ba"] = flat(both).T @ flat(dhidden), dhidden.sum(axis=(0, 1))
        dboth = alpha[..., None] * dpooled + dhidden @ p["wa"].T
        dstate = np.stack([dboth[..., :HIDDEN], dboth[::-1, :, HIDDEN:]], axis=1)  # in each direction's order
        dh = np.zeros((2, n, HIDDEN), np.float32)
        grad["wh"] = np.zeros_like(p["wh"])
        dprojected = np.zeros((2, len(table), 3 * HIDDEN), np.float32)
        da_all = np.empty((steps, 2, n, 3 * HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            dh = dh + dstate[t]
            r, z, gn, c = gates[t]
            dc = dh * (1 - z) * (1 - np.abs(c)) ** 2
            dz = dh * (states[t] - c) * gate_slope(z)
            dr = dc * gn * gate_slope(r)
            da_all[t] = np.concatenate([dr, dz, dc], axis=-1)
            dg = np.concatenate([dr, dz, dc * r], axis=-1)
            grad["wh"] += states[t].transpose(0, 2, 1) @ dg
            dh = dh * z + dg @ p["wh"].transpose(0, 2, 1)
        for k, rows in enumerate((ids.T, ids.T[::-1])):
            dprojected[k] = row_sums(rows.ravel(), flat(da_all[:, k]), len(table))
        grad["wx"] = np.stack([table.T @ dprojected[k] for k in range(2)])
        grad["bx"] = dprojected.sum(axis=1, keepdims=True)
        return grad, sum(dprojected[k] @ p["wx"][k].T for k in range(2))

    # ---- documents -----------------------------------------------------------------------

    def window_logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(logits of all windows, first window of each text)."""
        if len(self.lexicon) > LEXICON:
            self.lexicon, self.projected = Lexicon(), None
        number, known = self.lexicon.__getitem__, len(self.lexicon)
        rows, firsts = [], []
        for text in texts:
            own = np.fromiter(map(number, WORD.findall(text.lower())), np.int32)
            firsts.append(len(rows))
            for s in windows(len(own)):
                part = own[s : s + WINDOW]
                rows.append(part if len(part) == WINDOW else np.pad(part, (0, WINDOW - len(part))))
        new = self.project(self.inputs(list(itertools.islice(self.lexicon, known, None))))
        self.projected = new if self.projected is None else np.concatenate([self.projected, new[:, 1:]], axis=1)
        logits = [self.forward(self.projected, np.stack(rows[at : at + 2048])) for at in range(0, len(rows), 2048)]
        return np.concatenate(logits) if logits else np.zeros(0, np.float32), np.array(firsts, np.int64)

    def scores(self, texts: list[str]) -> np.ndarray:
        """Calibrated score of the worst window of each text; texts without words score as padding."""
        if not texts:
            return np.zeros(0)
        logits, firsts = self.window_logits(texts)
        worst = np.maximum.reduceat(logits, firsts).astype(np.float64)
        return 1 / (1 + np.exp(-(self.scale[0] * worst + self.scale[1])))


class Grams:
    """The n-gram buckets of numbered words."""

    def __init__(self, words: pa.Array):
        parts, lengths = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), PART):
            buckets, firsts = ngram_buckets(words[at : at + PART].to_pylist())
            parts.append(buckets.astype(np.int32))
            lengths.append(np.diff(np.append(firsts, len(buckets))))
        self.buckets, self.lengths = np.concatenate(parts), np.concatenate(lengths)
        self.firsts = np.cumsum(self.lengths) - self.lengths

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(buckets, first place per word, number per word) of these words."""
        lengths = self.lengths[words]
        firsts = np.cumsum(lengths) - lengths
        return self.buckets[np.repeat(self.firsts[words] - firsts, lengths) + np.arange(lengths.sum())], firsts, lengths

    def among(self, *counts: np.ndarray) -> list[np.ndarray]:
        """Sums of the words' counts by bucket, some thousand words at a time."""
        sums = [np.zeros(BUCKETS) for _ in counts]
        for at in range(0, len(self.lengths), PART):
            lengths = self.lengths[at : at + PART]
            own = self.buckets[self.firsts[at] : self.firsts[at] + lengths.sum()]
            for total, c in zip(sums, counts, strict=True):
                total += np.bincount(own, np.repeat(c[at : at + PART], lengths), BUCKETS)
        return sums


def _prior(counts: np.ndarray, positive: np.ndarray, share: float, weight: float = 4.0) -> np.ndarray:
    """Smoothed log odds of the label for documents that hold a feature, against all documents."""
    odds = np.log((positive + weight * share) / (counts - positive + weight * (1 - share)))
    return np.clip(odds - np.log(share / (1 - share)), -3, 3)


def encode(texts: list[str]) -> tuple[list[np.ndarray], list[str]]:
    """(numbers of each text's words, from 1; the words in order of their numbers)."""
    lexicon = Lexicon()
    encoded = [np.fromiter(map(lexicon.__getitem__, WORD.findall(t.lower())), np.int32) for t in texts]
    return encoded, list(lexicon)


def train(encoded: list[np.ndarray], names: list[str] | pa.Array, labels: list[int], seed: int = 5) -> Network:
    """Fit the network on documents (numbered words) of one label each; four fifths train it, the rest calibrate it.

    The words stay an Arrow array, and what has a row for each of them is made part by part: the driver holds little more
    than the windows and the inputs of the words to the two directions.

    Only whole documents are labelled. A positive document teaches the window that scores highest at
    the time (first by the words' log odds); negative ones teach their worst and some other windows.
    Training ends where the loss on the calibration part stops falling; the best parameters stay.
    """
    rng = np.random.default_rng(seed)
    batch, names = BATCH, pa.array(names, pa.string()) if isinstance(names, list) else names
    y = np.array(labels, np.float32)
    share = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
    fit = np.ones(len(y), bool)
    for value in (0, 1):  # a fifth of each label
        own = rng.permutation(np.flatnonzero(y == value))
        fit[own[: len(own) // 5]] = False
    counts, positive = np.zeros(len(names) + 1, np.int64), np.zeros(len(names) + 1, np.int64)
    for i in np.flatnonzero(fit):
        own = np.unique(encoded[i])
        counts[own] += 1
        positive[own] += int(y[i])
    often = np.flatnonzero(counts >= 3)
    often = sorted(zip((-counts[often]).tolist(), names.take(pa.array(often - 1)).to_pylist(), often.tolist(), strict=True))[: VOCABULARY - 2]
    vocabulary = {name: v + 2 for v, (_, name, _) in enumerate(often)}
    common = [k for _, _, k in often]
    word_ids = np.ones(len(names) + 1, np.int64)
    word_ids[common] = np.arange(len(common)) + 2
    word_prior = np.concatenate([np.zeros(2), _prior(counts[common], positive[common], share)]).astype(np.float32)
    grams = Grams(names)
    net = Network(vocabulary, word_prior, _prior(*grams.among(counts[1:], positive[1:]), share).astype(np.float32), seed)
    if not len(names) or y.min() == y.max():
        net.scale = np.array([0.0, float(np.log(share / (1 - share)))])
        return net

    def input_parts() -> Iterator[tuple[slice, np.ndarray]]:
        """Places and inputs of the words; row 0, padding, is left to the caller."""
        for at in range(0, len(names), PART):
            ids = word_ids[at + 1 : at + PART + 1]
            yield slice(at + 1, at + 1 + len(ids)), net.vectors(ids, *grams.of(np.arange(at, at + len(ids))))[1:]

    prior = np.zeros(len(names) + 1, np.float32)
    for place, table in input_parts():
        prior[place] = table[:, 0] + table[:, DIM]
    starts = [windows(len(own)) for own in encoded]
    owner = np.repeat(np.arange(len(encoded)), [len(s) for s in starts])
    rows = np.zeros((len(owner), WINDOW), np.int32)
    for row, (i, s) in zip(rows, ((i, s) for i, own in enumerate(starts) for s in own), strict=True):
        part = encoded[i][s : s + WINDOW]
        row[: len(part)] = part
    in_parts = lambda f: np.concatenate([f(rows[at : at + 1024]) for at in range(0, len(rows), 1024)])
    strength = in_parts(lambda part: np.sort(prior[part], axis=1)[:, -3:].sum(axis=1))
    squares = {k: np.full_like(v, 1e-3) for k, v in net.p.items()}
    judged = ~fit if 0 < y[~fit].sum() < (~fit).sum() else fit
    best, worse = (np.inf, None, None), 0
    for steps in TURNS:
        order = np.lexsort((-strength, owner))
        worst = np.zeros(len(owner), bool)
        worst[order[np.r_[True, owner[order][1:] != owner[order][:-1]]]] = True
        use = fit[owner]
        pos = np.flatnonzero(use & worst & (y[owner] == 1))
        neg = np.flatnonzero(use & (y[owner] == 0) & (worst | (rng.random(len(owner)) < 0.3)))
        for _ in range(steps):
            some = np.concatenate([rng.choice(pos, batch // 3), rng.choice(neg, batch - batch // 3)])
            ids, target = rows[some], y[owner[some]]
            words, inverse = np.unique(ids, return_inverse=True)
            words = words[words > 0]
            local = inverse.reshape(ids.shape) + (0 if (ids == 0).any() else 1)
            own, (buckets, firsts, lengths) = word_ids[words], grams.of(words - 1)
            inputs = net.vectors(own, buckets, firsts, lengths)
            logit, kept = net.forward(net.project(inputs), local, keep=True)
            dlogit = ((1 / (1 + np.exp(-logit)) - target) / len(some)).astype(np.float32)
            grad, dtable = net.gradients(inputs, local, kept, dlogit)
            for k, g in grad.items():
                squares[k] += g * g
                net.p[k] -= 0.08 * g / np.sqrt(squares[k])
            _sparse_step(net.p["words"], squares["words"], own, dtable[1:, :DIM])
            spread = np.repeat(dtable[1:, DIM:] / lengths[:, None], lengths, axis=0)
            _sparse_step(net.p["grams"], squares["grams"], buckets, spread)
        projected = np.repeat(net.project(np.zeros((1, 2 * DIM), np.float32)), len(names) + 1, axis=1)
        for place, table in input_parts():
            projected[:, place] = net.project(table)
        strength = in_parts(lambda part, projected=projected: net.forward(projected, part))
        del projected
        loss = _calibrate(net, strength, owner, y, judged)
        if loss < best[0]:
            best, worse = (loss, {k: v.copy() for k, v in net.p.items()}, net.scale), 0
        elif (worse := worse + 1) == 2:
            break
    net.p, net.scale = best[1], best[2]
    return net


def _sparse_step(values: np.ndarray, squares: np.ndarray, rows: np.ndarray, grads: np.ndarray, rate: float = 0.02) -> None:
    """One Adagrad step of the rows that have gradients."""
    distinct, inverse = np.unique(rows, return_inverse=True)
    g = row_sums(inverse, grads, len(distinct))
    squares[distinct] += g * g
    values[distinct] -= rate * g / np.sqrt(squares[distinct])


def _calibrate(net: Network, logits: np.ndarray, owner: np.ndarray, y: np.ndarray, use: np.ndarray) -> float:
    """Fit the logistic curve from the worst window's logit to the document's label; returns its loss."""
    worst = np.full(len(y), -np.inf)
    np.maximum.at(worst, owner, logits)
    x, t = worst[use], y[use]
    a, b = 1.0, 0.0
    for _ in range(200):
        q = 1 / (1 + np.exp(-(a * x + b)))
        w = q * (1 - q) + 1e-6
        g = np.array([((q - t) * x).sum() + 0.01 * (a - 1), (q - t).sum()])
        h = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum()]])
        step = np.linalg.solve(h + 1e-9 * np.eye(2), g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -2, 2)
    net.scale = np.array([max(a, 0.05), b])
    margin = (net.scale[0] * x + b) * np.where(t > 0, 1, -1)
    return float(np.logaddexp(0, -margin).mean())


def fitted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Network:
    """Train on about `sample` labelled documents (in expectation) outside the held-out fold, chosen by hash.

    Texts stay in the tasks: the driver gets the distinct words of the sample and each document's word
    numbers. Of conflicting labels of an id the largest counts; rows that repeat an id are one
    sample document, that with the largest text hash.
    """
    marked = settled_labels(labels, "toxic")
    marked = bounded_sample(marked.where(fold(F.col("label_id"), 5) != 0), "label_id", sample)
    rows = docs.select(F.col(id_col).cast("long").alias("label_id"), F.col(text_col).alias("text")).dropna()
    chosen = rows.join(F.broadcast(marked), "label_id").groupBy("label_id").agg(F.max_by("text", F.xxhash64("text")).alias("text"), F.max("label").alias("label"))
    chosen = stored(chosen, "toxic_sample")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch, "text"):
                words = {w for t in texts for w in WORD.findall(t.lower())}
                yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string())], ["word"])

    names = chosen.select("text").mapInArrow(distinct, "word string").distinct().toArrow().column("word").combine_chunks()
    names = names.take(pc.sort_indices(names))  # words of the sample, by code points
    shared = docs.sparkSession.sparkContext.broadcast(names)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = {w: k + 1 for k, w in enumerate(shared.value.to_pylist())}.__getitem__
        for batch in batches:
            for part, texts in slices(batch, "text"):
                coded = [np.fromiter(map(of, WORD.findall(t.lower())), np.int32).tobytes() for t in texts]
                yield pa.RecordBatch.from_arrays([part.column("label_id"), pa.array(coded, pa.binary()), part.column("label")], ["label_id", "words", "label"])

    found = sorted(map(tuple, chosen.mapInArrow(number, "label_id long, words binary, label int").collect()))  # `sample` rows
    return train([np.frombuffer(r[1], np.int32) for r in found], names, [r[2] for r in found])


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, sample: int = SAMPLE
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    Scores follow from the text alone: words and their characters in windows of 64 words, every
    48 words, over the whole text. Null and empty texts get the score of an empty window. Documents
    whose crc32(doc_id) mod 5 is 0 are held out of training. Repeated rows give repeated
    results; without any usable label every score is the same constant.
    """
    net = fitted(docs, labels, id_col, text_col, sample)  # a few MB at most; Spark broadcasts the closure

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                columns = [part.column("doc_id"), part.column("held_out"), pa.array(net.scores(texts), pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), (fold(F.col(id_col), 5) == 0).alias("held_out"))
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text", threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """The documents whose score is below the threshold, with all their columns."""
    net = fitted(docs, labels, text_col=text_col, sample=sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, text_col):
                yield part.filter(pa.array(net.scores(texts) < threshold))

    return docs.mapInArrow(run, schema_of(docs))
