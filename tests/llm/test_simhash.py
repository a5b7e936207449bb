import random

import numpy as np
import pytest
import xxhash

from areastats.llm import simhash
from areastats.llm.components import components


def brute_fingerprint(text, width=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, near):
    root = {i: i for i in ids}
    while True:
        changed = False
        for a in ids:
            for b in ids:
                if root[a] != root[b] and near(a, b):
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
        if not changed:
            return root


def texts():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(300)]
    base = [" ".join(rng.choices(words, k=rng.choice([3, 30, 200]))) for _ in range(30)]
    near = []
    for t in base:
        for _ in range(3):
            w = t.split()
            w[rng.randrange(len(w))] = rng.choice(words)
            near.append("  ".join(w).upper().replace("É", "é"))
    return [None, "", " \n\t ", "one", "ONE", "a b c", *base, *near, *base[:5]]


def test_components_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 8)  # cut shards into pieces
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, code string, rep string")
    found = {r.doc_id: r for r in simhash.simhash_components(docs).collect()}
    codes = {i: brute_fingerprint(t) for i, t in rows}
    assert {i: r.fingerprint for i, r in found.items()} == {i: f"{c:016x}" for i, c in codes.items()}
    want = brute_components(list(codes), lambda a, b: (codes[a] ^ codes[b]).bit_count() <= 4)
    assert {i: r.component_id for i, r in found.items()} == want
    assert len(set(want.values())) < len(rows) - 20


def test_repeated_rows_null_ids_and_empty_tables(spark):
    schema = "doc_id long, text string"
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (None, "z y x w v u"), (2, None)]
    found = simhash.simhash_components(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in found) == [(0, 0), (0, 1), (1, 1), (1, 1), (2, 2)]
    assert simhash.simhash_components(spark.createDataFrame([], schema)).count() == 0
    assert simhash.deduplicate(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize(("bits", "radius"), [(64, 4), (256, 50)])
def test_tree_finds_what_brute_force_finds(bits, radius):
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 2**63, (300, bits // 64), dtype=np.uint64)
    near = codes[:100].copy()
    for k in range(100):
        for b in rng.choice(bits, k % (2 * radius), replace=False):
            near[k, b // 64] ^= np.uint64(1 << int(b % 64))
    found = set()
    for q, c in simhash.BKTree(codes, leaf=4).within(near, radius):
        found |= set(zip(q.tolist(), c.tolist(), strict=True))
    apart = simhash.hamming(near[:, None], codes[None])
    assert found == set(zip(*(x.tolist() for x in np.nonzero(apart <= radius)), strict=True))


def test_block_shards_meet_within_the_radius():
    for distinct in (1, 10**5, 10**8, 10**10):
        blocks, agree = simhash.block_scheme(distinct, 4)
        assert blocks - 4 == agree  # so many blocks agree in any pair within the radius


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(1000, i) for i in range(1001, 1100)]
    links = [(b, a) for a, b in chain[::2]] + chain[1::2] + star + star[:3] + [(7, 7), (None, 5)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 1 for i in range(1, 61)} | {1000: 1000} | {i: 1000 for i in range(1001, 1100)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_deduplicate_keeps_one_row_of_each_component(spark):
    rows = [(i, t, "en") for i, t in enumerate(texts())]
    rows += [(0, rows[0][1], "again"), (0, "another text of the same id, unlike any other", "x"), (None, rows[1][1], "linked"), (None, "no id, no twin at all here", "y")]
    rows += [(None, "two rows without an id say the same", "z")] * 2 + [(900, None, None), (901, "", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_row string")
    kept = [tuple(r) for r in simhash.deduplicate(docs).collect()]
    code = [brute_fingerprint(t or "") for _, t, _ in rows]
    root = brute_components(list(range(len(rows))), lambda a, b: (code[a] ^ code[b]).bit_count() <= 4)
    groups = {}
    for i, r in root.items():
        groups.setdefault(r, []).append(rows[i])
    assert len(kept) == len(groups)
    for group in groups.values():
        ids = [r[0] for r in group if r[0] is not None]
        assert sum(r in kept and r[0] == (min(ids) if ids else None) for r in set(group)) == 1
    assert simhash.deduplicate(docs.limit(0)).columns == docs.columns
