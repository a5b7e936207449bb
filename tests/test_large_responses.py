"""Response documents read at byte ranges against a JSON parser."""

import json
import random

import pytest

from areastats.sources import map_elements

TEXTS = ['plain', 'a } b', '{{', '"quoted" }', 'back\\slash', '\\"}', 'ünï } ☂', '', ':', 'x: ', '[{', 'line\nbreak']


def document(pick, size):
    out = []
    for i in range(size):
        tags = {pick.choice(TEXTS): pick.choice(TEXTS) for _ in range(pick.randrange(4))}
        if pick.random() < 0.5:
            out.append({"type": "node", "id": i, "lon": i / 8, "lat": -i / 4, "tags": tags})
        else:
            out.append({"type": "way", "id": i, "tags": tags, "geometry": [{"lon": k / 2, "lat": 1.0} for k in range(pick.randrange(5))]})
    return out


def plain(e):
    shape = e.get("geometry")
    return (e["type"], e["id"], e.get("lon"), e.get("lat"), sorted(e["tags"].items()), None if shape is None else [(p["lon"], p["lat"]) for p in shape])


def as_plain(rows):
    return [(r.type, r.id, r.lon, r.lat, sorted(r.tags.items()), None if r.geometry is None else [(p.lon, p.lat) for p in r.geometry]) for r in rows]


@pytest.mark.parametrize("block", [64, 10**8])
def test_blocks_of_any_size(spark, tmp_path, block):
    pick = random.Random(block)
    want = []
    for n, (size, indent, header) in enumerate([(20, None, {}), (15, 2, {"version": 0.6, "osm3s": {"a": {"b": "}{"}, "c": "\\"}}), (1, None, {"note": 'x "{" '}), (0, None, {}), (0, 1, {"h": {}})]):
        elements = document(pick, size)
        want += elements
        body = json.dumps({**header, "elements": elements, "after": {"type": 1}}, indent=indent, ensure_ascii=bool(n % 2))
        (tmp_path / f"{n}.json").write_text(body + "\n" * (n % 2), encoding="utf-8")
    (tmp_path / "empty.json").write_text("")
    keys = {"spark.sql.files.maxPartitionBytes": str(block), "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        got = as_plain(map_elements.read_large_map_responses(spark, str(tmp_path)).collect())
        assert sorted(got, key=repr) == sorted(map(plain, want), key=repr)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
