"""Operators that work row by row or count: small fixtures against brute force, and odd inputs."""

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from areastats.llm.common import settled_labels
from areastats.llm import decontamination, embeddings, language, mixing, pii, quality, toxicity, urls, warc

LONG = "word " * 60_000
ODD = [(1, None, None, None), (2, "", "en", "a"), (3, "!!", "en", None), (None, "some words here", "en", "a"), (4, LONG, "fr", "b"), (5, "same", "fr", "b"), (5, "same", "fr", "b")]
SCHEMA = "doc_id long, text string, lang string, source string, score string, label string, size string"


def documents(spark, rows=ODD):
    return spark.createDataFrame([(*r, "s", "l", "z") for r in rows], SCHEMA)


# ---- personal data ----------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    twice = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))]
    return sum(twice) % 10 == 0


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return {
        "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in text.split(".")),
        "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15,
    }[kind]


def brute_spans(text):
    found = [(m.start(), k, m.end()) for k, kind in enumerate(PATTERNS) for m in re.finditer(PATTERNS[kind], text) if valid(kind, m[0])]
    return sorted(found)


def pii_texts():
    rng = random.Random(2)
    parts = ["a@b.c", "x.y_z@mail-1.example.com.", "1.2.3.4", "999.1.1.1", "001.255.0.7.5.6.7.8", "4111 1111 1111 1111", "4111111111111112", "+1 (974) 555-3436", "+12", "é", "😀", " ", ", ", "_", "-", "@", ".", "+", "7", "call ", "token "]
    made = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(400)]
    return [*made, "", "1" * 20_000, "1 " * 9000 + "x", "a.b@" * 3000, "a@b" + ".c" * 9000, "a@b.c_d@e.f"]


def test_base_spans_against_brute_force(spark):
    rows = list(enumerate(pii_texts()))
    docs = spark.createDataFrame([*rows, (-1, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    for i, text in rows:
        base = [tuple(s) for s in found[i].base]
        assert base == brute_spans(text), text[:80]
        assert set(base) <= {tuple(s) for s in found[i].spans}
    assert found[-1].base == found[-1].spans == []
    row = pii.digest(pii.personal_data(docs)).where("doc_id = 3").first()
    listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in brute_spans(rows[3][1]))
    assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()


def test_trees_learn_and_compile(spark):
    rng = np.random.default_rng(0)
    x = np.stack([rng.integers(0, n, 500) for n in pii.FEATURES.values()], axis=1)
    right = (x[:, 1] > 3) & (x[:, 0] != 1)
    trees = pii.Trees(rounds=20)
    trees.fit(x, right * 3.0, ~right * 3.0)
    trees.calibrate(x, right * 3.0, ~right * 3.0, 0.95)
    assert ((trees.score(x) >= np.array(trees.thresholds)[x[:, 0]]) == right).mean() > 0.95
    frame = spark.createDataFrame(x.tolist(), ", ".join(f"{n} int" for n in pii.FEATURES)).selectExpr("struct(*) AS c")
    got = [r[0] for r in frame.select(trees.column(pii.F.col("c"))).collect()]
    assert np.allclose(got, trees.score(x))
    empty = pii.Trees()
    empty.fit(x[:0], np.zeros(0), np.zeros(0))
    assert empty.thresholds == [float("inf")] * 4


def test_numbers_inside_a_run_are_proposed(spark):
    rows = [
        (1, "call 555-123-4567 2024-05-01"), (2, "12 555-123-4567 30"), (3, "555-123-4567 555-987-6543 555-222-3333"),
        (4, "\U0001f600 (555) 123-4567 7 4111 1111 1111 1111 9"),
    ]
    text = pii.F.col("text")
    found = spark.createDataFrame(rows, "doc_id long, text string").select("text", pii.candidates(text).alias("c")).collect()
    spans = [{(pii.KINDS[c.kind], r.text[c.start : c.end]) for c in r.c} for r in found]
    assert all(("phone", "555-123-4567") in s for s in spans[:3])
    assert {("phone", "555-987-6543"), ("phone", "555-222-3333")} <= spans[2]
    assert {("phone", "(555) 123-4567"), ("card", "4111 1111 1111 1111")} <= spans[3]


def test_of_nested_candidates_the_best_stays(spark):
    trees = pii.Trees()
    trees.trees, trees.thresholds = [(list(pii.FEATURES).index("shape"), 1, 1.0, 2.0)], [0.5] * 4
    docs = spark.createDataFrame([("call 555-123-4567 2024-05-01",)], "text string")
    text = pii.F.col("text")
    row = docs.select(pii.all_spans(pii.base_spans(text), pii.candidates(text), trees).alias("s")).first()
    assert (5, pii.KINDS.index("phone"), 17) in [tuple(x) for x in row.s]
    assert pii.KINDS.index("card") not in [x.kind for x in row.s]


def test_other_spellings_keep_their_places(spark):
    texts = [t for t in pii_texts() if len(t) < 2000] + ["write a.b@c-d.org, 10.0.0.1; +1 (974) 555-3436 or 4111 1111 1111 1111!"]
    text = pii.F.col("text")
    rows = spark.createDataFrame([(t, k) for t in texts for k in range(4)], "text string, pick long")
    for r in rows.select("text", pii.base_spans(text).alias("b"), pii.respelt(text, pii.base_spans(text), pii.F.col("pick")).alias("r")).collect():
        kept = []
        for s in r.b:
            if not kept or s.start >= kept[-1].end:
                kept.append(s)
        assert [s.kind for s in r.r.spans] == [s.kind for s in kept]
        gaps = lambda t, spans: [t[a:b] for a, b in zip([0, *(s.end for s in spans)], [*(s.start for s in spans), len(t)])]
        assert gaps(r.text, kept) == gaps(r.r.text, r.r.spans)


def test_other_spellings_are_selected_and_look_alikes_are_not(spark):
    rng = random.Random(21)
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    name = lambda: "".join(rng.choices("abcdefgh", k=6))

    def card(right):
        while True:
            d = "4" + digits(15)
            if luhn(d) == right:
                return d

    rows = []
    for i in range(600):
        phone = f"+1 ({rng.randint(2, 9)}{digits(2)}) {rng.randint(2, 9)}{digits(2)}-{digits(4)}"
        said = [f"mail {name()}@{name()}.org now", f"call {phone} today", f"card {card(True)} paid", f"on 2024-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}", f"id {card(False)} end", f"order {digits(9)} end"]
        rows.append((i, " and ".join(rng.sample(said, 4))))
    bad = card(False)
    asked = [(9001, "mail bob at site dot org now"), (9002, "call 415.555.2671 today"), (9003, f"id {bad} end"), (9004, "on 2024-03-12 we met"), (9005, "mail bob [at] site [dot] org now")]
    found = {r.doc_id: [(pii.KINDS[s.kind], s.start, s.end) for s in r.spans] for r in pii.personal_data(spark.createDataFrame([*rows, *asked], "doc_id long, text string")).where("doc_id > 9000").collect()}
    assert found[9001] == [("email", 5, 24)] and found[9002] == [("phone", 5, 17)] and found[9005] == [("email", 5, 28)]
    assert found[9003] == [] and found[9004] == []


def test_redaction_keeps_the_rest(spark):
    rows = [(1, "mail a@b.cc or 1.2.3.4, é +1 (974) 555-3436.", None, None), *ODD]
    docs = documents(spark, rows).withColumn("n_chars", pii.F.lit(7).cast("long"))
    out = pii.redacted(docs)
    assert out.columns == docs.columns
    got = [(r.text, r.n_chars) for r in out.collect()]
    assert ("mail [EMAIL] or [IP], é [PHONE].", 32) in got
    assert (None, 7) in got and (LONG, len(LONG)) in got and len(got) == len(rows)


def test_native_plan(spark):
    found = pii.personal_data(documents(spark))
    plan = found._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- mixing -----------------------------------------------------------------------------


def brute_targets(sizes):
    """Share out by weight, stop at twice the size, share the excess anew."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, stopped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in stopped)
        open_ = [s for s in names if s not in stopped]
        target = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if target[s] > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in stopped else target[s] for s in names}
        stopped |= over


def test_mix_meets_its_targets(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), "en", rng.choice([None, "", "a", "b", "b", "b", "b", "c", "ü"])) for i in range(3000)]
    docs = documents(spark, rows).repartition(7)
    found = mixing.mix(docs).collect()
    assert sorted(r.doc_id for r in found) == list(range(3000))
    sizes, taken = {}, {}
    for r in found:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert r.taken in (0, r["size"], 2 * r["size"])
    want = brute_targets(sizes)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * 300
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in found)


def test_mixed_documents_repeat_as_counted(spark):
    rows = [(i, "a b c", "en", "a" if i % 3 else "b") for i in range(300)]
    docs = documents(spark, [*rows, *ODD])
    out = mixing.mixed_documents(docs)
    copies = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    wanted = {}
    for r in mixing.mix(docs).collect():
        wanted[r.doc_id] = wanted.get(r.doc_id, 0) + r.copies
    assert copies == {k: v for k, v in wanted.items() if v}
    assert None in copies
    clashing = docs.withColumnsRenamed({"label": "mix_size", "score": "mixed_row", "size": "row_number_of_documents"})
    assert mixing.mixed_documents(clashing).count() == out.count()
    two = documents(spark, [(1, "first text", "en", "a"), (1, "second text of this id", "en", "a"), (None, "third", "en", "a")])
    assert {r.text for r in mixing.mixed_documents(two, share=(2, 1)).collect()} == {"first text", "second text of this id", "third"}
    assert set(docs.columns) < set(out.columns)
    assert mixing.mix(documents(spark, [])).count() == 0


# ---- decontamination --------------------------------------------------------------------


def edit_distance(pattern, text):
    """(distance, end) of the nearest piece of text, by dynamic programming."""
    above = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        row = [i]
        for j, d in enumerate(text, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (c != d)))
        above = row
    best = min(above)
    return best, above.index(best)


def test_myers_against_dynamic_programming():
    rng = random.Random(6)
    for _ in range(300):
        pattern, text = ("".join(rng.choices("abé", k=rng.randint(1, n))) for n in (90, 40))
        assert min([len(pattern), *decontamination.distances(pattern, text)]) == edit_distance(pattern, text)[0]
        for i, d in enumerate(decontamination.distances(pattern, text, anchored=True)):
            assert d == whole_distance(pattern, text[: i + 1])


def whole_distance(a, b):
    above = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        row = [i]
        for j, d in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (c != d)))
        above = row
    return above[-1]


def test_whole_words_against_brute_force():
    rng = random.Random(16)
    for _ in range(400):
        words = ["".join(rng.choices("ab", k=rng.randint(1, 4))) for _ in range(rng.randint(1, 9))]
        text = " ".join(rng.choices(["a", "aa", "ba", "ab", "b", *words], k=rng.randint(1, 14)))
        pattern, rate = " ".join(words), rng.choice([0.06, 0.2])
        starts = [0, *(i + 1 for i, c in enumerate(text) if c == " ")]
        ends = [*(i for i, c in enumerate(text) if c == " "), len(text)]
        best = min(((whole_distance(pattern, text[s:e]), s, e) for s in starts for e in ends if s < e))
        found = decontamination.Passages([(1, pattern)], rate).matches(text)
        assert [(m[1], m[2], m[3]) for m in found] == ([best] if best[0] <= int(len(pattern) * rate) else [])
    assert decontamination.Passages([(1, "a a")], 0.06).matches("ba a a") == [(1, 0, 3, 6)]


def test_edited_passages_are_found(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 7)))
    items = [(k, " ".join(word() for _ in range(40)).capitalize() + ".") for k in range(12)]
    docs, want = [], set()
    for i in range(60):
        filler = [word() for _ in range(rng.choice([0, 30, 400]))]
        if i % 3 == 0:
            k = rng.randrange(12)
            text = list(items[k][1])
            for _ in range(int(0.05 * len(text)) - 1):
                text[rng.randrange(len(text))] = rng.choice("xyz ")
            filler.insert(len(filler) // 2, "".join(text).upper() + " !!")
            want.add((i, k))
        docs.append((i, " ".join(filler), "en", None))
    bench = spark.createDataFrame([*items, (90, None), (91, ""), (None, "x"), (92, "short one"), (0, items[0][1])], "item_id long, text string")
    table = documents(spark, [*docs, (200, "a Short, one!", None, None), (201, "a short oneself", None, None), *ODD])
    found = decontamination.contaminated(table, bench, block_chars=1500).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want | {(200, 92)}
    assert all(0 <= r.start_char < r.end_char for r in found)
    brute = {(i, k) for i, t, *_ in docs for k, p in items if edit_distance(decontamination.normal(p), decontamination.normal(t))[0] <= 0.06 * len(decontamination.normal(p))}
    assert brute == want
    kept = decontamination.decontaminated(table, bench)
    assert kept.columns == table.columns
    assert kept.count() == table.count() - len({i for i, _ in want}) - 1
    assert decontamination.contaminated(table, bench.limit(0)).count() == 0


# ---- classifiers ------------------------------------------------------------------------


def test_toxicity_learns_words_and_scores_all_windows(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 6)))
    rows, labels = [], []
    for i in range(700):
        words = [word() for _ in range(rng.choice([10, 80, 300]))]
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), "vile" + rng.choice(["", "ly", "st", "ness"]))
        rows.append((i, " ".join(words), "en", None))
        labels.append((i, int(bad)))
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    far = " ".join(word() for _ in range(30_000)) + " vile vilest vilely"
    docs = documents(spark, [*rows, (1000, far, None, None), (1001, None, None, None), *ODD[3:]])
    found = toxicity.toxicity(docs, marks).collect()
    held = [(r.predicted, dict(labels)[r.doc_id]) for r in found if r.held_out and r.doc_id in dict(labels)]
    assert sum(p == y for p, y in held) / len(held) > 0.9
    by_id = {r.doc_id: r for r in found}
    assert by_id[1000].predicted == 1 and by_id[1001].predicted == 0
    assert all(0 <= r.score <= 1 for r in found)
    assert len(found) == docs.count()


def test_network_gradients():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(30)]
    net = toxicity.Network({w: k + 2 for k, w in enumerate(words)}, np.zeros(32, np.float32), np.zeros(toxicity.BUCKETS, np.float32))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    ids = rng.integers(1, 31, (3, toxicity.WINDOW))
    ids[0, 40:] = 0
    table = net.inputs(words)
    table = table.astype(np.float64)
    loss = lambda: float(net.forward(net.project(table), ids).sum())
    _, kept = net.forward(net.project(table), ids, keep=True)
    grad, _ = net.gradients(table, ids, kept, np.ones(3))
    for name in ("wx", "wh", "wa", "va", "wo"):
        flat, g = net.p[name].reshape(-1), grad[name].reshape(-1)
        for at in rng.integers(0, len(flat), 4):
            old = flat[at]
            flat[at] = old + 1e-2
            up = loss()
            flat[at] = old - 1e-2
            down = loss()
            flat[at] = old
            assert (up - down) / 2e-2 == pytest.approx(g[at], rel=0.05, abs=2e-3)


def test_windows_cover_every_word():
    for n in (0, 1, 63, 64, 65, 112, 113, 500):
        covered = {w for s in toxicity.windows(n) for w in range(s, min(n, s + toxicity.WINDOW))}
        assert covered == set(range(n))


def test_language(spark):
    rng = random.Random(9)
    word = {"aa": "abcde", "zz": "vwxyz"}
    rows = [(i, " ".join("".join(rng.choices(word[k], k=4)) for _ in range(rng.choice([1, 200]))), k, None) for i, k in enumerate(["aa", "zz"] * 60)]
    docs = documents(spark, [*rows, *ODD])
    found = {r.doc_id: r for r in language.languages(docs).collect()}
    assert all(found[i].lang_pred == lang for i, _, lang, _ in rows if i not in (1, 2, 3, 4, 5))
    assert found[1].lang_pred == found[2].lang_pred == found[3].lang_pred == "und" and found[1].score == 0
    signs = documents(spark, [*rows, (900, "½ ² Ⅷ ①", None, None), (901, "½ é", None, None)])
    assert {r.doc_id: r.lang_pred == "und" for r in language.languages(signs).collect() if r.doc_id >= 900} == {900: True, 901: False}
    nothing = language.languages(documents(spark, [(1, "abc", None, None)])).first()
    assert (nothing.lang_pred, nothing.score) == ("und", 0.0)
    assert language.languages(documents(spark, [])).count() == 0


def test_naive_bayes_against_brute_force():
    rng = random.Random(1)
    texts = ["".join(rng.choices("abc é", k=n)) for n in (0, 1, 2, 7, 300)] * 3
    counts = np.random.default_rng(0).integers(0, 50, (language.BUCKETS, 3)).astype(float)
    model = language.NaiveBayes(["x", "y", "z"], counts, np.array([1.0, 2.0, 3.0]))
    alone = np.concatenate([model.posterior([t]) for t in texts])
    assert np.allclose(model.posterior(texts), alone)


def test_quality_rules(spark):
    rng = random.Random(10)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 6)))
    rows, labels = [], []
    for i in range(600):
        words = [word() for _ in range(rng.choice([10, 80, 300]))]
        good = i % 3 != 0
        if not good:
            words = [f"{w}***" for w in words] if i % 2 else [words[0]] * len(words)
        rows.append((i, " ".join(words), "en", None))
        labels.append((i, int(good)))
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    docs = documents(spark, [*rows, *[(1000 + (r[0] or 0), *r[1:]) for r in ODD]])
    found = quality.quality(docs, marks).collect()
    held = [(r.predicted, dict(labels)[r.doc_id]) for r in found if r.held_out and r.doc_id in dict(labels)]
    assert sum(p == y for p, y in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in found) and len(found) == docs.count()
    rules = quality.fitted(docs, marks)
    sample = quality.described(docs, "doc_id", "text").where("doc_id < 50").collect()
    x = np.array([[r[n] for n in quality.STATISTICS] for r in sample])
    want = 1 / (1 + np.exp(-(rules.matrix(x) @ rules.weights + rules.bias)))
    got = {r.doc_id: r.score for r in found}
    assert np.allclose([got[r.doc_id] for r in sample], want)
    assert quality.quality(docs, marks.limit(0)).select("score").distinct().count() == 1


def test_conflicting_labels_count_as_the_largest(spark):
    marks = spark.createDataFrame([(1, 0), (1, 1), (1, 0), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    assert sorted(map(tuple, settled_labels(marks, "toxic").collect())) == [(1, 1), (2, 0)]


# ---- embeddings, urls, archives ---------------------------------------------------------


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(11)
    centres = rng.standard_normal((25, 24))
    vectors = [c + s * rng.standard_normal(24) for c in centres for s in (0, 0.1, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6)]
    vectors += [vectors[0]] * 5 + [2 * vectors[9]] + [np.eye(24)[0], 0.9 * np.eye(24)[0] + np.sqrt(1 - 0.81) * np.eye(24)[1]]
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] + [0.0] * 23, [None] + [1.0] * 23, [1.0, 2.0]]
    rows = [(i, None if v is None else list(map(lambda x: None if x is None else float(x), v)), i) for i, v in enumerate([*vectors, *odd])]
    table = spark.createDataFrame([*rows, (None, vectors[3].tolist(), 0)], "vec_id long, embedding array<double>, rep int")
    found = {r.vec_id: r for r in embeddings.linked(table, tile_rows=16).collect()}
    x = np.array(vectors)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    for i in range(len(x)):
        for j in range(len(x)):
            if abs(unit[i] @ unit[j] - 0.9) < 1e-9:
                near[i, j] = float(np.dot(x[i], x[j])) / (np.linalg.norm(x[i]) * np.linalg.norm(x[j])) >= 0.9
    np.fill_diagonal(near, False)
    root = np.arange(len(x))
    while True:
        new = root.copy()
        a, b = np.nonzero(near)
        np.minimum.at(new, a, root[b])
        if (new == root).all():
            break
        root = new
    for i in range(len(x)):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (near[i].sum(), root[i], root[i] == i)
    for i in range(len(x), len(x) + len(odd)):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)
    assert near.sum() > 100 and len(found) == len(rows) + 1
    assert embeddings.linked(table.limit(0)).count() == 0


def test_vectors_of_any_length_and_magnitude(spark):
    rows = [
        (0, [1e-200, 0.0]), (1, [1.0, 0.0]), (2, [1e200, 1e190]), (3, [5e-324, 0.0]), (4, [0.0, 1e308]), (5, [2.0, 0.0]), (6, [1e300, -1e300]),
        (10, [1.0, 2.0, 3.0]), (11, [1.0, 2.0, 3.0]), (12, [-1.0, -2.0, -3.0]), (20, [7.0]), (21, [-7.0]), (22, [1e-310]), (30, [0.0, 0.0, 0.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.linked(table).collect()}
    assert found == {
        0: (4, 0), 1: (4, 0), 2: (4, 0), 3: (4, 0), 5: (4, 0), 4: (0, 4), 6: (0, 6), 10: (1, 10), 11: (1, 10), 12: (0, 12), 20: (1, 20), 22: (1, 20), 21: (0, 21), 30: (0, 30),
    }


def test_crowded_tiles_are_cut(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "MAX_TILES", 2)
    rng = np.random.default_rng(2)
    vectors = np.concatenate([rng.standard_normal((150, 6)), rng.standard_normal(6) + 0.05 * rng.standard_normal((150, 6))])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in embeddings.linked(table, tile_rows=32).collect()}
    assert [found[i] for i in range(len(vectors))] == want.tolist()


def test_urls(spark):
    rows = [
        ("https://www.Example.ORG/es/1", "block", "example.org/es/"), ("http://example.org/en/199?x#y", "block", "example.org/en/1"),
        ("http://a.example.org/en/2", "allow", "org/"), ("http://x.com/fr/1", "allow", "com/fr/"), ("http://x.com/de/1", "block", "com/de/"),
        ("http://x.org", "allow", None), ("http://x.org?/", "allow", None), ("http://notcom/de/", "allow", None),
        ("http://free-bets.example.net/en/1", "block", None), ("http://alphabets.net/", "allow", None), ("http://casino.com/fr/", "allow", "com/fr/"),
        (None, "allow", None), ("", "allow", None), ("no scheme.org/", "allow", None), ("http://", "allow", None), ("x://ÀB.org/é?", "allow", "org/"),
    ]
    pages = spark.createDataFrame([(i, r[0], "h") for i, r in enumerate(rows)], "page_id long, url string, host string")
    found = {r.page_id: r for r in urls.judged(pages).collect()}
    for i, (url, verdict, rule) in enumerate(rows):
        assert (found[i].verdict, found[i].rule) == (verdict, rule), url
    assert (found[0].host, found[0].path) == ("www.example.org", "/es/1")
    assert (found[15].host, found[15].path) == ("Àb.org", "/é")
    assert urls.judged(pages.limit(0)).count() == 0
    everything = urls.PREFIX_RULES + urls.HOST_RULES
    index = urls.Index(everything, {"org": 5, "example": 9})
    for r in found.values():
        fits = [x for x in everything if re.search(x.pattern, r.host + r.path)]
        want = min(fits, key=lambda x: (-len(x.name), x.name)) if fits else None
        assert index.longest(r.host + r.path) == want


def test_archives_round_trip(spark):
    html = ["<p>é😀</p>", "", None, "x" * 300_000, "a\r\n\r\nb", *[f"page {i % 7}" for i in range(400)]]
    rows = [(i, f"http://{'abc'[i % 3]}.Example.com/{i % 5}" if i % 11 else None, h, "x") for i, h in enumerate(html)]
    rows += [(2, "http://r.com/\r\nX: y", None, "x"), (700, "http://q.com:80/", "é", "x"), (None, "http://q.com/", "unique", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, offset string")
    found = warc.archived(pages, with_payload=True).collect()
    first = {}
    for i, _, h, _ in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h, _ in rows:
        payload = (h or "").encode()
        again = i is not None and first[h or ""] != i
        want.append((-1 if i is None else i, len(payload), warc.digest(payload), "revisit" if again else "response", first[h or ""] if again else -1, None if again else payload))
    key = lambda r: tuple(str(x) for x in r)
    got = [(-1 if r.page_id is None else r.page_id, r.payload_bytes, r.payload_digest, r.record_type, -1 if r.refers_to is None else r.refers_to, None if r.payload is None else bytes(r.payload)) for r in found]
    assert sorted(got, key=key) == sorted(want, key=key)
    few = warc.archived(pages, min_revisit_bytes=8).collect()
    assert {r.record_type for r in few if r.payload_bytes < 8} == {"response"}
    assert warc.archived(pages.limit(0)).count() == 0


def test_index_look_up_across_blocks(tmp_path):
    spark_free = [(f"k{i // 4:03d}", i % 4, "a", i, 1) for i in range(100)]
    import json
    import zlib

    for name, part in (("s0", spark_free[:50]), ("s1", spark_free[50:])):
        directory, data = [], b""
        for at in range(0, len(part), 3):
            lines = part[at : at + 3]
            block = zlib.compress("\n".join(json.dumps(x) for x in lines).encode())
            directory.append([*lines[0][:2], len(data), len(block)])
            data += block
        (tmp_path / name).write_bytes(data)
        (tmp_path / f"{name}.directory").write_text(json.dumps(directory))
    index = warc.Shards(str(tmp_path), [(*p[0][:2], *p[-1][:2], n) for n, p in (("s0", spark_free[:50]), ("s1", spark_free[50:]))])
    for line in spark_free:
        assert list(index.find(line[:2])) == [line]
    assert list(index.find(("k000", 9))) == list(index.find(("zzz", 0))) == list(index.find(("", 0))) == []


def test_trees_count_the_candidates_of_all_documents(spark, monkeypatch):
    digits = F.lpad((F.col("id") % 10_000).cast("string"), 4, "0")
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("at 555 123 "), digits, F.lit(" o'clock")).alias("text"))
    counted = []
    for name in ("fit", "calibrate"):
        own = getattr(pii.Trees, name)
        monkeypatch.setattr(pii.Trees, name, lambda self, x, yes, no, *more, own=own: counted.append(yes.sum() + no.sum()) or own(self, x, yes, no, *more))
    each = docs.select(F.sum(F.size(pii.candidates(F.col("text"))))).first()[0]
    pii.personal_data(docs)
    assert each >= 60_000 and sum(counted) == each
    counted.clear()
    pii.redacted(docs)
    assert sum(counted) == each


def test_training_makes_what_grows_with_the_words_part_by_part(spark, monkeypatch):
    rng = random.Random(3)
    words = pa.array(["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(100_000)])
    grams, counts = toxicity.Grams(words), np.arange(100_000)
    whole = np.bincount(grams.buckets, np.repeat(counts, grams.lengths), toxicity.BUCKETS)
    tracemalloc.start()
    got = grams.among(counts)[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got == whole).all() and peak < 200 * len(words)
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda encoded, names, labels: seen.append((encoded, names, labels)))
    docs = spark.createDataFrame([(i, f"zeta \U0001f600x \uffeey alpha{i}") for i in range(40)], "doc_id long, text string")
    toxicity.fitted(docs, spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int"))
    (encoded, names, labels), = seen
    assert isinstance(names, pa.Array) and names.to_pylist() == sorted(names.to_pylist())
    assert len(encoded) == len(labels) == len(names) - 3
    assert {" ".join(names[int(k) - 1].as_py() for k in own) for own in encoded} == {f"zeta x \uffeey alpha{i}".replace("\uffee", "") for i in range(40) if f"alpha{i}" in names.to_pylist()}
