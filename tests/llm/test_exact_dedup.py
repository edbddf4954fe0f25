import hashlib
import re

import pytest
from pyspark.sql import functions as F

from odometer.llm.exact_dedup import drop_exact_duplicates, exact_duplicates

TEXTS = [
    (5, "a  b\tc"), (3, "a b c"), (9, "a b c "), (1, None), (2, ""), (7, "  "), (8, " "), (10, "é" * 50 + "x"), (11, "é" * 50 + "x"),
    (12, "é" * 50 + "y"), (13, "b" * 97), (14, "b" * 97), (15, "b" * 96), (16, "c" * 40 + "b" * 57), (4, "c" * 40 + "b" * 57),
    (None, "a b c"), (20, "same"), (20, "same"), (21, "a\u00a0b"), (22, "a b"),
]


def expected(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (i, _), n in zip(rows, norm):
        ids = [j for (j, _), m in zip(rows, norm) if m == n]
        keep = min((j for j in ids if j is not None), default=None)
        out.append((i, keep, len(ids), hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [8, 16_384])
@pytest.mark.parametrize("keys", [None, 3, 1])
def test_groups_equal_texts_whatever_the_hash_does(docs_of, size, keys):
    # Few keys: nearly all blocks collide, and only their contents tell.
    key = F.xxhash64 if keys is None else (lambda b: F.pmod(F.xxhash64(b), F.lit(keys)))
    found = exact_duplicates(docs_of(TEXTS), size, key).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == expected(TEXTS)
    groups = {}
    for r in found:
        groups.setdefault((r.level, r.name), []).append(r)
    for g in groups.values():
        assert len({r.text_sha256 for r in g}) == 1 and sum(r.kept for r in g) == 1
    assert len(groups) == len({r.text_sha256 for r in found})


def test_more_ambiguous_keys_than_literals(docs_of, monkeypatch):
    monkeypatch.setattr("odometer.llm.exact_dedup.AMBIGUOUS_KEYS", 1)
    found = exact_duplicates(docs_of(TEXTS), 8, lambda b: F.pmod(F.xxhash64(b), F.lit(3))).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == expected(TEXTS)


def test_long_text_of_many_levels(docs_of):
    long = "".join(f"{i:07d} " for i in range(3000))
    rows = [(1, long), (2, long[:-1] + "x"), (3, long), (4, "y" + long[1:])]
    found = {r.doc_id: (r.keep_id, r.level) for r in exact_duplicates(docs_of(rows), 64).collect()}
    assert found == {1: (1, 9), 2: (2, 9), 3: (1, 9), 4: (4, 9)}


def test_empty_table_and_kept_rows(docs_of):
    assert exact_duplicates(docs_of([])).count() == 0
    docs = docs_of(TEXTS)
    kept = drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(rows) == len({e[3] for e in expected(TEXTS)})
    assert sorted(i for i, _ in rows if i is not None) == [1, 3, 4, 7, 9, 10, 12, 13, 15, 20, 21, 22]
