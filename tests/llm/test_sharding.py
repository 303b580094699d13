from collections import Counter

import pytest

from lorespan.llm import sharding


def brute(shards, slots):
    """Turn by turn with whole permutations written out."""
    from hashlib import sha256

    order = sorted(shards)
    wishes = {}
    for s in order:
        d = sha256(s.encode()).digest()
        first, skip = int.from_bytes(d[:8], "big") % slots, int.from_bytes(d[8:16], "big") % (slots - 1) + 1
        wishes[s] = [(first + k * skip) % slots for k in range(slots)]
        assert len(set(wishes[s])) == slots
    owner = {}
    while len(owner) < slots:
        for s in order:
            free = next((w for w in wishes[s] if w not in owner), None)
            if free is not None:
                owner[free] = s
    return [owner[k] for k in range(slots)]


def test_table_matches_written_out_permutations():
    shards = ["c", "a", "d", "b"]
    assert [shards[k] for k in sharding.fill(shards, 101)] == brute(shards, 101)
    assert sharding.fill(["x"], 2).tolist() == [0, 0]


def test_even_and_stable():
    shards = sharding.shard_names(20)
    owner = sharding.fill(shards, 10_007)
    counts = Counter(owner.tolist())
    assert max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.fill(shards[:-1], 10_007)
    moved = sum(a != b for a, b in zip(owner, fewer) if a != 19)
    assert moved < 0.05 * 10_007


@pytest.mark.parametrize("shards, slots", [([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)])
def test_bad_tables(shards, slots):
    with pytest.raises(ValueError):
        sharding.fill(shards, slots)


def test_placement(spark):
    from hashlib import md5

    shards = sharding.shard_names(8)
    owner = sharding.fill(shards, 1009)
    rows = [(1, "a"), (2, "b"), (2, "b"), (None, "c"), (-7, None)]
    df = spark.createDataFrame([(*r, "old", 5) for r in rows], "doc_id long, text string, Shard string, slot int")
    got = sharding.place(df, "doc_id", shards, 1009)
    assert sorted(got.columns) == ["doc_id", "shard", "slot", "text"]
    found = {(r.doc_id, r.slot, r.shard) for r in got.collect()}
    want = set()
    for i, _ in rows:
        slot = 0 if i is None else int(md5(str(i).encode()).hexdigest()[:15], 16) % 1009
        want.add((i, slot, shards[owner[slot]]))
    assert found == want and got.count() == 5
    assert sharding.place(df.limit(0), "doc_id", shards, 1009).collect() == []


def test_written_shards(spark, tmp_path):
    placed = sharding.place(spark.range(500).withColumnRenamed("id", "doc_id"), "doc_id", sharding.shard_names(4), 101)
    sharding.write_shards(placed, str(tmp_path / "s"), rows_per_file=50)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(map(tuple, back.select("doc_id", "shard").collect())) == sorted(map(tuple, placed.select("doc_id", "shard").collect()))
