"""Periodic runs against brute force, and the query with its made periods."""

import hashlib
import random
import re
import zlib

from areastats.llm import periodic, queries

SF_DIR = "/root/testdata/sf0.001"


def brute_runs(w):
    """All maximal stretches by every lag; of equal stretches that with the smallest period."""
    found = {}
    for q in range(1, len(w)):
        i = q
        while i < len(w):
            if w[i] != w[i - q]:
                i += 1
                continue
            first = i
            while i < len(w) and w[i] == w[i - q]:
                i += 1
            start, length = first - q, i - first + q
            if length >= max(6, 4 * q):
                found.setdefault((start, length), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] or None, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
        sha(" ".join(x for i, x in enumerate(w) if i not in dropped)),
    )


def made_words(rng):
    kind = rng.randrange(5)
    if kind == 0:
        return [rng.choice("ab") for _ in range(rng.randint(0, 80))]
    if kind == 1:
        unit = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
        return (unit * rng.randint(1, 9))[rng.randint(0, 3) :] + [rng.choice("abc") for _ in range(rng.randint(0, 6))] + unit * rng.randint(0, 6)
    if kind == 2:
        inner = ["x"] * rng.randint(5, 9) + ["y"]
        return (inner * rng.randint(3, 6) + ["z"]) * rng.randint(1, 6)
    if kind == 3:
        return ["a", "b"] * rng.randint(0, 40) + ["a", "a", "b"] * rng.randint(0, 20)
    return [str(rng.randrange(4)) for _ in range(rng.randint(0, 300))]


def test_runs_against_brute_force():
    rng = random.Random(5)
    documents = [made_words(rng) for _ in range(3000)]
    documents += [["w"] * 500, [], ["w"] * 5, ["w"] * 6, ["a", "b"] * 4, ["a", "b"] * 3 + ["a"]]
    found = periodic.runs_of([[x.encode() for x in w] for w in documents])
    for w, runs in zip(documents, found, strict=True):
        assert runs == brute_runs(w), w


def test_nested_and_long_periods():
    rng = random.Random(9)
    for period in (1, 2, 3, 7, 26, 61, 139, 500):
        unit = [b"%d" % rng.randrange(1 << 30) for _ in range(period)]
        words = [b"start", *(unit * 4), *unit[: period // 2]]
        if len(words) - 1 >= 6:
            assert periodic.runs_of([words]) == [[(1, len(words) - 1, period)]]
        short = [[b"start", *(unit * 4)[: 4 * period - 1]]]  # one word less than four periods
        assert periodic.runs_of(short) == [brute_runs(short[0])] == [[]]


def test_one_word_a_million_times():
    assert periodic.runs_of([[b"w"] * 1_000_000]) == [[(0, 1_000_000, 1)]]


ODD = [(1, None), (2, ""), (3, " \t\n"), (None, "a b " * 9), (4, "word " * 60_000), (5, "a b " * 9), (5, "a b " * 9), (6, "é x\x1cy   " * 8)]


def test_odd_rows_and_made_periods(spark):
    rows = ODD + [(k, " ".join(made_words(random.Random(k)))) for k in range(10, 400)]
    docs = spark.createDataFrame([(i, t, "r", 1) for i, t in rows], "doc_id long, text string, runs string, n_words int")
    found = periodic.digest(periodic.periodic_runs(docs.select("doc_id", periodic.looped(docs.doc_id, docs.text).alias("text"), "runs", "n_words")))
    got = [tuple(r) for r in found.collect()]
    assert sorted((g for g in got if g[0] != 4), key=repr) == sorted((brute_row(i, t) for i, t in rows if i != 4), key=repr)
    assert next(g for g in got if g[0] == 4)[1:6] == (1, 0, 60_000, 1, 60_000_000)
    assert periodic.digest(periodic.periodic_runs(docs.limit(0))).collect() == []


def test_query_against_brute_force(spark):
    found = {r.doc_id: tuple(r) for r in queries.QUERIES["op13_periodic_runs"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    for doc_id, text in docs:
        if text is None or len(text) < 12_000:
            assert found[doc_id] == brute_row(doc_id, text), doc_id
