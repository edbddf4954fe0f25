import collections
import math
import zlib

import xxhash

from odometer.llm.sharding import restore_shards, shard_documents, topology, write_shards


def fold(values):
    """Spark's xxhash64 of several strings: each hash seeds the next."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode(), seed)
    return seed


def weigh(node):
    return sum(map(weigh, node.values())) if isinstance(node, dict) else node


def place(key, tree, path=""):
    draws = []
    for name, child in sorted(tree.items(), key=lambda kv: str(kv[0])):
        at = f"{path}/{name}"
        u = ((fold([key, at]) >> 11) + 0.5) / (1 << 53)
        draws.append((-math.log(u) / weigh(child), name, child, at))
    _, name, child, at = min(draws, key=lambda d: d[0])
    return place(key, child, at) if isinstance(child, dict) else name


def rows(docs_of, n=600):
    return docs_of([(i, "hot" if i % 3 == 0 else f"text {i}") for i in range(n)] + [(None, "n"), (5, None), (7, ""), (7, "")])


def test_against_brute_force_and_growth(docs_of):
    found = shard_documents(rows(docs_of), topology(8), topology(9)).collect()
    assert len(found) == 604
    moved = 0
    for r in found:
        key = "\0null" if r.doc_id is None else str(r.doc_id)
        assert r.shard == place(key, topology(8)) and r.grown_shard == place(key, topology(9))
        assert r.grown_shard in (r.shard, 8)
        moved += r.grown_shard == 8
    assert 30 < moved < 110
    counts = collections.Counter(r.shard for r in found)
    assert set(counts) == set(range(8)) and max(counts.values()) < 2 * min(counts.values())
    for s, n in counts.items():
        mine = sorted((r for r in found if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(n))
        assert [(r.text_crc32, r.size) for r in mine] == sorted((r.text_crc32, r.size) for r in mine)
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].text_crc32 == zlib.crc32(b"text 1") and by_id[1].size == 7


def test_weights_move_rows_only_into_grown_subtrees(docs_of):
    tree = topology(8)
    heavier = topology(8)
    heavier["region1"]["rack3"][7] = 4.0
    for r in shard_documents(rows(docs_of), tree, heavier).collect():
        if r.shard != r.grown_shard:
            # Into the region, the rack or the shard whose weight grew.
            assert r.grown_shard in (4, 5, 6, 7)
            if r.shard in (6, 7):
                assert r.grown_shard == 7 and r.shard == 6
            elif r.shard in (4, 5):
                assert r.grown_shard in (6, 7)


def test_counts_from_the_base_on_grow_into_themselves(docs_of):
    docs = rows(docs_of, 200)
    for n in (8, 9, 11):
        assert all(r.grown_shard in (r.shard, n) for r in shard_documents(docs, topology(n), topology(n + 1)).collect())


def test_empty_table_and_round_trip(spark, docs_of, scratch):
    assert shard_documents(docs_of([]), topology(8)).count() == 0
    docs = rows(docs_of, 50)
    write_shards(docs, topology(8), f"{scratch}/shards")
    back = restore_shards(spark, f"{scratch}/shards").select(docs.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, docs.collect()))
