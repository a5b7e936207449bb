"""Byte-level BPE: encodings of halves joined at their boundary, decodings concatenated up a tree.

A pair of tokens fits if the merges of its bytes give back just this pair. Merges go by rank,
then from the left, wherever they are in a text; so what happens inside two neighbouring tokens
is what happens when they are encoded alone, up to the first merge across their border. Hence a
sequence is the encoding of its bytes if and only if all neighbours fit. Two encodings
can be joined by encoding anew only a window around the border: once the tokens at both ends of the
window fit those outside, nothing outside can change.
"""

import base64
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from areastats.llm.common import slices

#: Bytes encoded directly; longer pieces are halved.
LEAF = 24
#: Above every rank.
FAR = 1 << 62
#: Pieces and pairs remembered by a task before older ones go, and the longest piece that is.
REMEMBERED, REMEMBERED_CHARS = 200_000, 64
#: Tokens concatenated at once at the bottom of a decoding tree.
DECODE_LEAF = 4096
#: Letters and numbers that Unicode has gained after version 16, which the public encoder goes by.
NEWER = (
    r"\u0558\u058B-\u058C\u088F\u0C5C\u0CDC\u208F\u209D-\u209F\uA7CE-\uA7CF\uA7D2\uA7D4\uA7DD\uA7E2\uA7F1\uAB6C-\uAB6D"
    r"\U000107BB-\U000107BF\U00010940-\U00010959\U00010EC5-\U00010EC7\U00010ED9-\U00010EEE\U00011B0A\U00011DB0-\U00011DDB"
    r"\U00011DE0-\U00011DE9\U00011DF1\U0001246F\U00012475-\U0001247F\U00012550-\U00012686\U00016EA0-\U00016EB8\U00016EBB-\U00016ED3"
    r"\U00016FF2-\U00016FF6\U000187F8-\U000187FF\U00018CD6-\U00018CDA\U00018D09-\U00018D20\U00018D80-\U00018DF2\U00018E00-\U00019191"
    r"\U000191A0-\U000191D2\U0001B123-\U0001B128\U0001B168\U0001D6A6\U0001DF1F-\U0001DF24\U0001DF2B-\U0001DF81\U0001DF90-\U0001DF96"
    r"\U0001DFCD-\U0001DFFF\U0001E6C0-\U0001E6DE\U0001E6E0-\U0001E6E2\U0001E6E4-\U0001E6E5\U0001E6E7-\U0001E6ED\U0001E6F0-\U0001E6F4"
    r"\U0001E6FE-\U0001E6FF\U0002B73A-\U0002B73F\U0002B81E\U0002CEA2-\U0002CEAD\U000323B0-\U00033479\U0003D000-\U0003FC3F"
)
#: The first of them; texts below are cut by the plain pattern, which is faster.
BEYOND = re.compile("[\u0558-\U0010ffff]")


class Pieces(dict):
    """Packed ids of pieces of text, encoded when first asked for.

    When REMEMBERED are held they become the older ones, which last as long again; those asked for come back.
    """

    def __init__(self, encoder: "Encoder"):
        super().__init__()
        self.encoder, self.older = encoder, {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            ids = self.encoder.piece(piece.encode())
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed


class Encoder:
    """Encodes and decodes by the ranks of a vocabulary file (base64 token, blank, rank on each line)."""

    def __init__(self, lines: bytes, pattern: str):
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines())}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        self.pattern = regex.compile(pattern)
        self.older = regex.compile(re.sub(r"\\p\{[LN]\}", lambda m: f"[{m[0]}--[{NEWER}]]", pattern), regex.V1)
        self.fitting: dict[tuple[int, int], bool] = {}
        self.packed = Pieces(self)

    def scanned(self, data: bytes) -> list[int]:
        """`merged` of a few bytes: scans for the lowest rank cost less than a heap there."""
        ranks, get = self.ranks, self.ranks.get
        cuts = list(range(len(data) + 1))
        best = [get(data[i : i + 2], FAR) for i in range(len(data) - 1)]  # of each part with the next
        while best and (low := min(best)) < FAR:
            i = best.index(low)
            del cuts[i + 1], best[i]
            if i:
                best[i - 1] = get(data[cuts[i - 1] : cuts[i + 1]], FAR)
            if i < len(best):
                best[i] = get(data[cuts[i] : cuts[i + 2]], FAR)
        return [ranks[data[a:b]] for a, b in zip(cuts, cuts[1:])]

    def merged(self, data: bytes) -> list[int]:
        """Merge neighbours by rank, then from the left, until none is in the vocabulary."""
        ranks, n = self.ranks, len(data)
        if n <= LEAF:
            return self.scanned(data)
        end = list(range(1, n + 1))  # of the part that starts here
        before = list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if j == 0 or j >= n or end[j] != stop:  # one of the two is no part any more, or has grown
                continue
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(data[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (k := before[i]) >= 0 and (r := ranks.get(data[k:stop])) is not None:
                heapq.heappush(heap, (r, k, stop))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[data[i : end[i]]])
            i = end[i]
        return ids

    def fits(self, a: int, b: int) -> bool:
        known = self.fitting.get((a, b))
        if known is None:
            if len(self.fitting) >= REMEMBERED:
                self.fitting.clear()
            known = self.fitting[a, b] = self.merged(self.tokens[a] + self.tokens[b]) == [a, b]
        return known

    def joined(self, a: list[int], b: list[int]) -> list[int]:
        """The encoding of two neighbours from their encodings: windows at the border that grow until they fit."""
        if not a or not b or self.fits(a[-1], b[0]):
            return a + b
        left = right = 1
        while True:
            left, right = min(left, len(a)), min(right, len(b))
            outer, inner = a[: len(a) - left], a[len(a) - left :] + b[:right]
            middle = self.merged(b"".join(map(self.tokens.__getitem__, inner)))
            low = left == len(a) or self.fits(outer[-1], middle[0])
            high = right == len(b) or self.fits(middle[-1], b[right])
            if low and high:
                return outer + middle + b[right:]
            left, right = left if low else 2 * left, right if high else 2 * right

    def tree(self, data: bytes) -> list[int]:
        if len(data) <= LEAF:
            return self.merged(data)
        half = len(data) // 2
        return self.joined(self.tree(data[:half]), self.tree(data[half:]))

    def piece(self, data: bytes) -> list[int]:
        """Ids of one match of the pattern; a match that is a token stays whole."""
        whole = self.ranks.get(data)
        return self.tree(data) if whole is None else [whole]

    def encode(self, text: str) -> bytes:
        """Ids of a text, packed as little-endian unsigned 32-bit integers."""
        pattern = self.pattern if text.isascii() or BEYOND.search(text) is None else self.older
        return b"".join(map(self.packed.__getitem__, pattern.findall(text)))

    def decode(self, packed: bytes) -> bytes | None:
        """Bytes of packed ids; None where an id is not in the vocabulary or the packing is cut off."""
        try:
            return self._concatenated(np.frombuffer(packed, "<u4").tolist())
        except (KeyError, ValueError):
            return None

    def _concatenated(self, ids: list[int]) -> bytes:
        if len(ids) <= DECODE_LEAF:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = len(ids) // 2
        return self._concatenated(ids[:half]) + self._concatenated(ids[half:])


def _vocabulary(df: DataFrame, path: str):
    """The file as a broadcast: executors need no copy of it. Its size is that of a vocabulary, not of the data."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every whole text: ids packed as little-endian unsigned 32-bit integers.

    `path` is a rank file on the driver, `pattern` cuts a text into pieces that are encoded separately.
    Special tokens are ordinary text. Null and empty texts have no ids (empty, not null), a null id of a
    row stays null, repeated rows give repeated results, an empty table gives no rows, further
    columns are ignored. A word of any length takes n log^2 n work at most.
    """
    lines = _vocabulary(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(lines.value, pattern)
        for batch in batches:
            for part, texts in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([encoder.encode(t) for t in texts], pa.binary())], ["doc_id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary")


def decoded(tokens: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, decoded) of packed ids; `decoded` is binary, as ids need not end at whole characters.

    Null ids and ids that the vocabulary lacks decode to null, no ids to empty bytes.
    """
    lines = _vocabulary(tokens, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(lines.value, pattern)
        for batch in batches:
            out = [None if ids is None else encoder.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(out, pa.binary())], ["doc_id", "ids", "decoded"])

    rows = tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, ids binary, decoded binary")


def digest(tokens: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of `decoded`."""
    return tokens.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
