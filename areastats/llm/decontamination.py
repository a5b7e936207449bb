"""Benchmark passages in documents: exact pieces by pigeonhole, then Myers' bit-parallel distance.

A text within k edits of a passage that is cut into k + 1 pieces holds one of the pieces
unchanged. All pieces of a block of passages are found in one Aho-Corasick scan of each document;
only the surroundings of a hit are measured. Nothing is shuffled.
"""

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from areastats.llm.common import slices

WORD = re.compile(r"[^\W_]+")


def normal(text: str) -> str:
    """Lower-case words (letters and digits) with single spaces."""
    return " ".join(WORD.findall(text.lower()))


def distances(pattern: str, text: str, anchored: bool = False) -> Iterator[int]:
    """Least edit distance between the pattern and a piece of text that ends here, per position.

    With `anchored`, the piece is all of the text so far.
    """
    if not pattern:
        yield from (i + 1 if anchored else 0 for i in range(len(text)))
        return
    match: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        match[c] |= 1 << i
    full, top = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
    up, down, score = full, 0, len(pattern)
    for c in text:
        eq = match.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        right = down | (full & ~(xh | up))
        left = up & xh
        score += bool(right & top) - bool(left & top)
        right, left = (right << 1 | anchored) & full, (left << 1) & full
        up = left | (full & ~(xv | right))
        down = right & xv
        yield score


def closest(pattern: str, text: str, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the words of text[low:high] nearest to the pattern, within the budget.

    The piece begins and ends with whole words of the text; of equals the first. All ends within the
    budget are tried, and from each all starts.
    """
    ends = [low + i + 1 for i, d in enumerate(distances(pattern, text[low:high])) if d <= budget]
    best = None
    for end in ends:
        if end < len(text) and text[end] != " " or text[end - 1] == " ":
            continue
        first = max(low, end - len(pattern) - budget)
        for i, d in enumerate(distances(pattern[::-1], text[first:end][::-1], anchored=True)):
            start = end - i - 1
            if d <= budget and (start == 0 or text[start - 1] == " ") and text[start] != " " and (best is None or (d, start, end) < best):
                best = (d, start, end)
    return best


class Passages:
    """Passages indexed by their pieces. `items` are (item_id, text)."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        import ahocorasick

        pieces: dict[str, list[tuple[int, int]]] = defaultdict(list)
        self.items = []
        for item_id, text in items:
            pattern = normal(text)
            if not pattern:
                continue
            budget = int(len(pattern) * error_rate)
            own = len(self.items)
            self.items.append((item_id, pattern, budget))
            cuts = [len(pattern) * i // (budget + 1) for i in range(budget + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                pieces[pattern[a:b]].append((own, a))
        self.found = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.found.add_word(piece, (len(piece), places))
        if pieces:
            self.found.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end): the best place of each passage within its budget.

        Places are code points of the text, widened to whole words.
        """
        if not self.items:
            return []
        plain = normal(text)
        windows: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for last, (length, places) in self.found.iter(plain):
            at = last + 1 - length
            for own, offset in places:
                _, pattern, budget = self.items[own]
                windows[own].append((max(0, at - offset - budget), min(len(plain), at - offset + len(pattern) + budget)))
        result = []
        for own, spans in windows.items():
            item_id, pattern, budget = self.items[own]
            best = None
            for a, b in _merged(spans):
                place = closest(pattern, plain, a, b, budget)
                if place is not None and (best is None or place < best):
                    best = place
            if best is not None:
                result.append((item_id, best[0], *_original(text, best[1], best[2])))
        return result


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for a, b in sorted(set(spans)):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _original(text: str, start: int, end: int) -> tuple[int, int]:
    """Places of the normal form as places of the text."""
    at, first, last = 0, None, (0, 0)
    for m in WORD.finditer(text):
        after = at + sum(len(w) for w in WORD.findall(m[0].lower())) + 1
        if first is None and start < after:
            first = m.start()
        if at < end:
            last = m.span()
        at = after
    return first or 0, last[1]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> list[list[tuple[int, str]]]:
    """The passages in blocks of about `block_chars` characters, each small enough to broadcast."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).dropna()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + total // block_chars
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    return [sorted({(r[0], r[1]) for r in items.where(part == b).collect()}) for b in range(blocks)]


def contaminated(
    docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.06,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    block_chars: int = 1_000_000,
) -> DataFrame:
    """(doc_id, item_id, distance, start_char, end_char) of each passage that a document holds.

    Passages and whole documents are compared as lower-case words; up to `error_rate` of a passage's
    characters (rounded down) may be edited, and what matches are whole words of the document. Null texts hold nothing; passages without text or words, or without an id, are left
    out. Repeated documents or ids give repeated rows. One scan of the documents for each block
    of `block_chars` characters of passages.
    """

    def scan(items: list[tuple[int, str]]) -> DataFrame:
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            passages = Passages(sent.value, error_rate)
            for batch in batches:
                for part, texts in slices(batch, "text"):
                    rows = [(d, *m) for d, t in zip(part.column("doc_id").to_pylist(), texts, strict=True) for m in passages.matches(t)]
                    columns = list(zip(*rows, strict=True)) or [[]] * 5
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        return rows_of.mapInArrow(run, ", ".join(f"{n} long" for n in names))

    names = ["doc_id", "item_id", "distance", "start_char", "end_char"]
    rows_of = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = [scan(items) for items in _blocks(benchmark, item_col, item_text_col, block_chars)]
    result = found[0]
    for more in found[1:]:
        result = result.unionAll(more)
    return result


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.06, text_col: str = "text",
    block_chars: int = 1_000_000,
) -> DataFrame:
    """The documents that hold no passage of the benchmark, with all their columns."""
    for items in _blocks(benchmark, "item_id", "text", block_chars):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            passages = Passages(sent.value, error_rate)
            for batch in batches:
                for part, texts in slices(batch, text_col):
                    yield part.filter(pa.array([not passages.matches(t) for t in texts], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
