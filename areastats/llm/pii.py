"""Personal data: base patterns, and candidates that boosted trees select. DataFrame functions only.

Everything per document is an expression over its text. The trees are fitted on the counts of
distinct feature vectors over all documents, whose number is bounded by the product of the features'
values (FEATURES), whatever the size of the corpus; they are compiled into column expressions. The
patterns run over each text once: what they find is stored for the counts and for the selection.

The patterns are written so that each scan is linear in the text: repeats are possessive where
nothing after them could match less, and a run of characters is only entered at its start.
"""

import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from areastats.llm.common import fold, fresh, stored

KINDS = ("email", "ip", "card", "phone")
LOCAL, LABEL = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{0,2})"
#: What a text must hold before a pattern is tried.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
#: High-recall generators: spaced, bracketed and spelt-out forms. Their lengths define the shapes: 64 characters before
#: the at sign and 63 in a label are all that mail allows; numbers of persons have at most 25 digits.
GENERATORS = {
    "email": rf"(?i)(?<!{LOCAL}){LOCAL}{{1,64}}+\s?(?:@|[\[(]\s?at\s?[\])]|(?<=\s)at(?=\s))\s?{LABEL}{{1,63}}+(?:\s?(?:\.|[\[(]\s?dot\s?[\])]|(?<=\s)dot(?=\s))\s?{LABEL}{{2,63}}+){{1,4}}+",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}+(?:\s?(?:\[\.\]|\(\.\)|\.)\s?[0-9]{1,3}+){3}+(?![0-9A-Za-z])",
}
_GAP = r"[\x20.\-/]"
_PHONE = rf"[(]?[0-9]{{3}}[)]?{_GAP}{{0,2}}[0-9]{{3}}{_GAP}{{0,2}}[0-9]{{4}}"
#: Shapes of numbers. They are looked for at every start, also inside another candidate, so they overlap.
SHAPES = {
    "run": r"[(]?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,24}+",
    "phone": _PHONE,
    "prefixed": rf"[0-9]{{1,3}}[\x20.\-/]{{0,2}}{_PHONE}",
    "grouped": rf"[0-9]{{2,5}}(?:{_GAP}{{1,2}}[0-9]{{2,4}}){{2,4}}",
    "local": r"[0-9]{3}[\x20.\-][0-9]{4}",
    "card": r"(?:[0-9]{4}(?:[\x20\-]?[0-9]{4}){3}|[0-9]{4}[\x20\-]?[0-9]{6}[\x20\-]?[0-9]{5})",
    "plain": r"[0-9]{7,19}",
}
CUES = (
    r"(?i)(?:phone|tel|call|fax|mobile|contact|mail|write|card|visa|credit|account|address|host|server)\W*$",
    r"(?i)(?:token|key|secret|id|hash|order|isbn|version|page|no)\W*$",
)
#: Number of values of each feature; their product bounds what the driver gets.
FEATURES = {"kind": 4, "digits": 8, "letters": 2, "separators": 6, "groups": 5, "left": 4, "right": 4, "cue": 3, "shape": 7, "luhn": 2, "area": 3}


# ---- spans ------------------------------------------------------------------------------


def _places(text: Column, pattern: str, make) -> Column:
    """`make(match, start, end, gap before, text)` of every match; places in code points.

    The gaps between the matches are what `split` leaves, so lengths add up to places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.arrays_zip(gaps.alias("gap"), found.alias("found"))

    def step(done: Column, pair: Column) -> Column:
        start = done["at"] + F.length(pair["gap"])
        end = start + F.length(pair["found"])
        return F.when(pair["found"].isNull(), done).otherwise(
            F.struct(end.alias("at"), F.concat(done["out"], F.array(F.struct(start.alias("start"), end.alias("end"), pair["gap"].alias("gap"), pair["found"].alias("found")))).alias("out"))
        )

    none = F.array().cast("array<struct<start:int,end:int,gap:string,found:string>>")
    placed = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda done: done["out"])
    return F.when(text.rlike(pattern), F.transform(placed, make))


def _starts(text: Column, pattern: str, make) -> Column:
    """`make` of a match at every place where one starts; matches may overlap.

    The pattern looks ahead, so what `split` leaves lies between the starts. A character in front
    keeps `split` from dropping the empty gap of a match at the very beginning.
    """
    ahead, padded = rf"(?<![0-9A-Za-z])(?=({pattern})(?![0-9A-Za-z]))", F.concat(F.lit("\n"), text)
    pairs = F.arrays_zip(F.split(padded, ahead, -1).alias("gap"), F.regexp_extract_all(padded, F.lit(ahead), F.lit(1)).alias("found"))

    def step(done: Column, pair: Column) -> Column:
        at = done["at"] + F.length(pair["gap"])
        gap = F.when(done["at"] == -1, F.substring(pair["gap"], 2, F.length(pair["gap"]))).otherwise(pair["gap"])
        match = F.struct(at.alias("start"), (at + F.length(pair["found"])).alias("end"), gap.alias("gap"), pair["found"].alias("found"))
        return F.when(pair["found"].isNull(), done).otherwise(F.struct(at.alias("at"), F.concat(done["out"], F.array(match)).alias("out")))

    none = F.array().cast("array<struct<start:int,end:int,gap:string,found:string>>")
    placed = F.aggregate(pairs, F.struct(F.lit(-1).alias("at"), none.alias("out")), step, lambda done: done["out"])
    return F.when(text.rlike(ahead), F.transform(placed, make))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right doubled; the sum of digits ends in 0."""
    def value(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return found.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    digits = _digits(found)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(10, 15)


def _checked(kind: str):
    return lambda m: _valid(kind, m["found"])


def _of_kind(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))


SPAN = "array<struct<start:int,kind:int,end:int>>"


def base_spans(text: Column) -> Column:
    """Sorted (start, kind, end) of the base patterns, leftmost and non-overlapping per kind."""
    none = F.array().cast(SPAN)
    parts = []
    for k, kind in enumerate(KINDS):
        spans = _places(text, BASE[kind], lambda m: m)
        kept = _of_kind(F.filter(spans, _checked(kind)), k)
        holds = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else F.lit(True)
        parts.append(F.coalesce(F.when(holds, kept), none))
    return F.when(text.rlike("[0-9@]"), F.array_sort(F.concat(*parts))).otherwise(none)


def candidates(text: Column) -> Column:
    """(start, kind, end, features...) of the spans that the generators propose; they may overlap."""
    fields = ",".join(f"{name}:int" for name in FEATURES if name != "kind")
    none = F.array().cast(f"array<struct<start:int,kind:int,end:int,{fields}>>")

    def bucket(value: Column, *bounds: int) -> Column:
        return sum(((value >= b).cast("int") for b in bounds), F.lit(0))

    def edge(char: Column) -> Column:
        return F.when(F.coalesce(char, F.lit("")) == "", 0).when(char.rlike(r"[\s]"), 1).when(char.rlike(r"[\p{L}\p{N}]"), 2).otherwise(3)

    def described(kind: int, shape: int = 0):
        def make(m: Column) -> Column:
            found, gap = m["found"], m["gap"]
            all_digits, marks = _digits(found), F.regexp_replace(found, r"[0-9A-Za-z]", "")
            digits = F.length(all_digits)
            before, after = F.substring(gap, -24, 24), F.substring(text, m["end"] + 1, F.lit(1))
            separators = (
                F.when(marks == "", 0).when(marks.rlike(r"^[\x20]+$"), 1).when(marks.rlike("^-+$"), 2)
                .when(marks.rlike(r"^[@.]+$"), 3).when(marks.rlike(r"[(\[]"), 4).otherwise(5)
            )
            return F.struct(
                m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"),
                bucket(digits, 1, 7, 10, 12, 14, 16, 17).alias("digits"), found.rlike("[A-Za-z]").cast("int").alias("letters"),
                separators.alias("separators"), bucket(F.size(F.split(found, r"[^0-9A-Za-z]+")), 2, 3, 4, 5).alias("groups"),
                edge(F.substring(gap, -1, 1)).alias("left"), edge(after).alias("right"),
                F.when(before.rlike(CUES[0]), 1).when(before.rlike(CUES[1]), 2).otherwise(0).alias("cue"),
                F.lit(shape).alias("shape"), F.when(digits.between(14, 19), _luhn(all_digits)).otherwise(False).cast("int").alias("luhn"),
                # the ten last digits as area, exchange and line: neither of the first two begins with 0 or 1
                F.when(digits < 10, 0).when(F.substring(all_digits, -10, 10).rlike("^[2-9][0-9]{2}[2-9]"), 2).otherwise(1).alias("area"),
            )
        return make

    parts = [_places(text, p, described(KINDS.index(name))) for name, p in GENERATORS.items()]
    card, phone = KINDS.index("card"), KINDS.index("phone")
    for k, (name, shape) in enumerate(SHAPES.items()):
        # `digits` is a bucket: 4 and more from 14 digits on, 6 and more from 16 on
        if name in ("run", "plain", "card"):
            parts.append(F.filter(_starts(text, shape, described(card, k)), lambda c: c["digits"] >= 4))
        if name != "card":
            parts.append(F.filter(_starts(text, shape, described(phone, k)), lambda c: c["digits"] < 6))
    parts = [F.coalesce(p, none) for p in parts]
    return F.when(text.rlike(r"(?i)[0-9@]|[\[(\s]at[\])\s]"), F.array_sort(F.concat(*parts))).otherwise(none)


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


# ---- boosted trees ----------------------------------------------------------------------


class Trees:
    """Gradient boosting of small trees on counted feature vectors, with a calibrated threshold for each kind."""

    def __init__(self, rounds: int = 30, depth: int = 3, rate: float = 0.3):
        self.rounds, self.depth, self.rate = rounds, depth, rate
        self.trees: list = []
        self.start, self.thresholds = 0.0, [math.inf] * len(KINDS)
        self.measured: dict[str, tuple[float, float]] = {}

    def fit(self, x: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> None:
        n = positive + negative
        if not n.sum():
            return
        share = (positive.sum() + 0.5) / (n.sum() + 1)
        self.start = float(np.log(share / (1 - share)))
        score = np.full(len(x), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            grad, hess = positive - n * p, n * p * (1 - p)
            tree, step = self._grow(x, grad, hess, np.ones(len(x), bool), self.depth)
            self.trees.append(tree)
            score += step

    def _grow(self, x, grad, hess, rows, depth):
        leaf = float(self.rate * grad[rows].sum() / (hess[rows].sum() + 1.0))
        gain_of = lambda m: grad[m].sum() ** 2 / (hess[m].sum() + 1.0)
        best = (1e-6, None, None)
        if depth:
            for f in range(x.shape[1]):
                for cut in np.unique(x[rows, f])[1:]:
                    low = rows & (x[:, f] < cut)
                    gain = gain_of(low) + gain_of(rows & ~low) - gain_of(rows)
                    if gain > best[0]:
                        best = (gain, f, int(cut))
        if best[1] is None:
            return leaf, np.where(rows, leaf, 0.0)
        low = rows & (x[:, best[1]] < best[2])
        left, a = self._grow(x, grad, hess, low, depth - 1)
        right, b = self._grow(x, grad, hess, rows & ~low, depth - 1)
        return (best[1], best[2], left, right), a + b

    def score(self, x: np.ndarray) -> np.ndarray:
        def values(tree):
            if not isinstance(tree, tuple):
                return np.full(len(x), tree)
            return np.where(x[:, tree[0]] < tree[1], values(tree[2]), values(tree[3]))

        return sum((values(t) for t in self.trees), np.full(len(x), self.start))

    def calibrate(self, x: np.ndarray, positive: np.ndarray, negative: np.ndarray, precision: float) -> None:
        """For each kind the lowest score at and above which held-out candidates are right often enough.

        `measured` gets the (precision, recall) of the candidates of each kind that has such a score.
        """
        score = self.score(x)
        for k, kind in enumerate(KINDS):
            own = np.flatnonzero(x[:, 0] == k) if len(x) else np.zeros(0, int)
            order = own[np.argsort(-score[own], kind="stable")]
            right, all_ = np.cumsum(positive[order]), np.cumsum((positive + negative)[order])
            last = np.r_[score[order][1:] != score[order][:-1], True] if len(order) else np.zeros(0, bool)
            good = np.flatnonzero(last & (right >= precision * all_) & (all_ > 0))
            if len(good):
                self.thresholds[k] = float(score[order][good[-1]]) - 1e-9
                self.measured[kind] = (float(right[good[-1]] / all_[good[-1]]), float(right[good[-1]] / max(positive[order].sum(), 1e-9)))

    def column(self, span: Column) -> Column:
        """The score as an expression over a candidate's fields."""
        names = list(FEATURES)

        def value(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(tree)
            return F.when(span[names[tree[0]]] < tree[1], value(tree[2])).otherwise(value(tree[3]))

        return sum((value(t) for t in self.trees), F.lit(self.start))


def respelt(text: Column, spans: Column, pick: Column) -> Column:
    """(text, spans) with every span written another way; `pick` and its place choose which.

    Addresses get blanks, brackets and words for their marks, phone numbers lose the plus sign (or
    with it the country code 1) and change separators, cards get separators that the base pattern does not take.
    """
    def other(s: Column) -> Column:
        piece = F.substring(text, s["start"] + 1, s["end"] - s["start"])
        at = F.pmod(pick + s["start"], F.lit(4)) + 1
        one_of = lambda *forms: F.element_at(F.array(*forms), at.cast("int"))
        local, domain = F.substring_index(piece, "@", 1), F.substring_index(piece, "@", -1)
        email = one_of(*[
            F.concat(local, F.lit(a), F.replace(domain, F.lit("."), F.lit(d))) for a, d in ((" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "."), (" @ ", "."))
        ])
        ip = F.replace(piece, F.lit("."), one_of(*map(F.lit, (" . ", "[.]", "(.)", ". "))))
        bare = F.regexp_replace(piece, "[+()]", "")
        short = F.regexp_replace(F.trim(bare), r"^1[\x20.-]+", "")
        phone = one_of(*[F.regexp_replace(form, r"[\x20.-]+", mark) for form, mark in ((short, "."), (F.trim(bare), "-"), (short, "-"), (F.trim(bare), " "))])
        card = one_of(*[F.regexp_replace(_digits(piece), "([0-9]{4})(?=[0-9])", f"$1{mark}") for mark in (".", "/", "  ", " -")])
        return F.when(s["kind"] == 0, email).when(s["kind"] == 1, ip).when(s["kind"] == 2, card).otherwise(phone)

    def step(done: Column, s: Column) -> Column:
        between = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        start = F.length(done["out"]) + F.length(between)
        made = F.get(F.transform(F.array(other(s)), lambda o: F.struct(
            F.concat(done["out"], between, o).alias("out"), s["end"].alias("at"),
            F.concat(done["spans"], F.array(F.struct(start.alias("start"), s["kind"].alias("kind"), (start + F.length(o)).alias("end")))).alias("spans"),
        )), F.lit(0))
        return F.when(s["start"] >= done["at"], made).otherwise(done)

    first = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))
    return F.aggregate(spans, first, step, lambda done: F.struct(F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))).alias("text"), done["spans"].alias("spans")))


def fitted(found: DataFrame, precision: float = 0.9) -> Trees:
    """Trees from every row of `found`: (doc_id, text, base, proposed), stored; the text may be null where there is no base span.

    The base patterns know one spelling of each kind. Right examples are base spans that `respelt`
    writes another way in their own texts: a candidate counts as right if it has the kind and, within
    a character, the ends of such a span. Wrong ones are the other candidates there, and all candidates
    of the texts as they are that meet no base span: dates, ids, numbers that fail the
    check digit. A fifth of the documents, by hash of the id, calibrates a threshold for each kind.
    """
    rows = found.select((fold(F.col("doc_id"), 5) == 0).alias("held"), "text", "base", "proposed", F.xxhash64("doc_id").alias("pick"))
    plain = rows.select("held", "base", F.explode("proposed").alias("c"))
    wrong = plain.where(~F.exists("base", lambda b: _overlap(b, F.col("c")))).select("held", "c", F.lit(False).alias("agrees"))
    again = rows.where(F.size("base") > 0).select("held", respelt(F.col("text"), F.col("base"), F.col("pick")).alias("r"))
    again = stored(again.select("held", F.col("r.text").alias("text"), F.col("r.spans").alias("spans")), "respelt")
    near = again.select("held", "spans", F.explode(candidates(F.col("text"))).alias("c")).where(F.exists("spans", lambda b: _overlap(b, F.col("c"))))
    same = F.exists("spans", lambda b: (b["kind"] == F.col("c.kind")) & (F.abs(b["start"] - F.col("c.start")) <= 1) & (F.abs(b["end"] - F.col("c.end")) <= 1))
    each = wrong.unionAll(near.select("held", "c", same.alias("agrees")))
    counted = each.select("held", *[F.col(f"c.{n}").alias(n) for n in FEATURES], "agrees")
    rows = counted.groupBy("held", *FEATURES).agg(F.count_if("agrees").alias("yes"), F.count_if(~F.col("agrees")).alias("no")).collect()
    rows = sorted(map(tuple, rows))  # bounded by twice the product of FEATURES

    def part(held: bool):
        own = [r for r in rows if r[0] == held]
        table = np.array([r[1:] for r in own], np.int64).reshape(len(own), len(FEATURES) + 2)
        return table[:, :-2], table[:, -2].astype(float), table[:, -1].astype(float)

    trees = Trees()
    trees.fit(*part(False))
    trees.calibrate(*(part(True) if any(r[0] for r in rows) else part(False)), precision)
    return trees


def all_spans(base: Column, proposed: Column, trees: Trees) -> Column:
    """Base spans and the selected candidates: those that overlap no base span.

    Of two where one lies in the other, the one with the higher score stays (then the longer one).
    """
    if min(trees.thresholds) == math.inf:
        return base
    bound = F.array(*[F.lit(-t) for t in trees.thresholds])  # of the negated score; infinite where a kind has none
    span = lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))
    free = F.filter(proposed, lambda c: ~F.exists(base, lambda b: _overlap(b, c)))
    scored = F.transform(free, lambda c: F.struct((-trees.column(c)).alias("score"), (c["start"] - c["end"]).alias("length"), span(c).alias("span")))
    best_first = F.array_sort(F.filter(scored, lambda c: c["score"] <= F.element_at(bound, c["span"]["kind"] + 1)))
    within = lambda a, b: (b["start"] <= a["start"]) & (a["end"] <= b["end"])

    def step(chosen: Column, c: Column) -> Column:
        nested = F.exists(chosen, lambda o: within(o, c["span"]) | within(c["span"], o))
        return F.when(nested, chosen).otherwise(F.concat(chosen, F.array(c["span"])))

    added = F.aggregate(best_first, F.array().cast(SPAN), step)
    return F.when(F.size(proposed) == 0, base).otherwise(F.array_sort(F.concat(base, added)))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"], s["end"])), ",")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", precision: float = 0.9) -> DataFrame:
    """(doc_id, base, spans) of every document: arrays of (start, kind, end), sorted.

    `kind` indexes KINDS; places are code points, ends exclusive. Null texts count as empty and
    have no spans. Repeated rows give repeated results; ids may be null; an empty table gives no rows and
    other columns are ignored. One scan of the texts; what it finds is stored, fits the trees and is selected from.
    """
    text = F.col("text")
    texts = _texts(docs, id_col, text_col).select("doc_id", "text", base_spans(text).alias("base"), candidates(text).alias("proposed"))
    found = stored(texts.withColumn("text", F.when(F.size("base") > 0, text)), "proposed")
    trees = fitted(found, precision)
    return found.select("doc_id", "base", all_spans(F.col("base"), F.col("proposed"), trees).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base spans by kind, the hash of their list, and the list of all spans."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == F.lit(k))).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans join."""
    name = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(done: Column, s: Column) -> Column:
        between = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        more = F.struct(F.concat(done["out"], between, F.element_at(name, s["kind"] + 1)).alias("out"), s["end"].alias("at"))
        wider = F.struct(done["out"].alias("out"), F.greatest(done["at"], s["end"]).alias("at"))
        return F.when(s["start"] >= done["at"], more).otherwise(wider)

    rest = lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step, rest)).otherwise(text)


def redacted(docs: DataFrame, precision: float = 0.9) -> DataFrame:
    """The documents with personal data replaced in `text`, all columns; null texts stay null.

    `n_chars`, where there is one, follows the new text. Repeated rows give repeated results, an
    empty table gives no rows, other columns keep whatever name they have.
    """
    text = F.col("text")
    plain = F.coalesce(text, F.lit(""))
    base, proposed, found = (fresh(docs, n) for n in ("base_spans", "proposed_spans", "all_spans"))
    held = stored(docs.select("*", base_spans(plain).alias(base), candidates(plain).alias(proposed)), "proposed")
    trees = fitted(held.select(F.col("doc_id").cast("long").alias("doc_id"), plain.alias("text"), F.col(base).alias("base"), F.col(proposed).alias("proposed")), precision)
    spans = held.withColumn(found, all_spans(F.col(base), F.col(proposed), trees))
    out = spans.withColumn("text", F.when(text.isNotNull(), redact(text, F.col(found))))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return out.select(*docs.columns)
