import math

from pyspark.sql import functions as F

from odometer.llm.mixing import mix_plan, mixed_documents, source_targets


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(most * sizes[s] for s in fixed)
        share = left / sum(weight[s] for s in free) if free else 0
        above = {s for s in free if weight[s] * share > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in fixed else weight[s] * share for s in names}
        fixed |= above


ROWS = (
    [(i, "w " * (i % 17), "big") for i in range(300)]
    + [(1000 + i, "a b  c\n", "small") for i in range(4)]
    + [(2000 + i, "x y z", "Z") for i in range(20)]
    + [(3000, None, None), (3001, "one two", None), (3002, "", "empty"), (None, "n n n", "big"), (7, "w " * 7, "big"), (7, "w " * 7, "big")]
    + [(4000, "long " * 50_000, "𝔘")]
)


def n(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return len([w for w in text.split(" ") if w])


def sizes_of(rows):
    out = {}
    for _, t, s in rows:
        out[s] = out.get(s, 0) + n(t)
    return out


def test_targets(spark):
    for sizes in [{"a": 100, "b": 1, "c": 50}, {"a": 1, "b": 1000, "c": 0, None: 7}, {None: 5}, {"é": 3, "z": 4, "𝔘": 5, "": 6}, {"a": 0}]:
        found = source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
        want = brute_targets(sizes)
        assert {r.source: round(r.target, 6) for r in found} == {s: round(v, 6) for s, v in want.items()}


def test_plan(docs_of):
    docs = docs_of(ROWS)
    found = mix_plan(docs)
    assert found.columns == [*docs.columns, "mix"]
    rows = found.collect()
    assert len(rows) == len(ROWS)
    sizes, taken = sizes_of(ROWS), {}
    want = brute_targets(sizes)
    for r in rows:
        m = r.mix
        assert m.size == n(r.text) and m.source_size == sizes[r.source] and abs(m.target - want[r.source]) < 1e-6
        assert 0 <= m.taken <= 3 * m.size and m.taken == m.copies * m.size + m.part
        taken[r.source] = taken.get(r.source, 0) + m.taken
    for s, t in taken.items():
        assert abs(t - math.floor(want[s])) <= 2, (s, t, want[s])  # repeated rows share a cut
    again = mix_plan(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_documents(docs_of):
    docs = docs_of(ROWS)
    plan = {(r.doc_id, r.source): r.mix for r in mix_plan(docs).collect()}
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    words, copies = {}, {}
    whole = {(i, s): t for i, t, s in ROWS}
    for r in out.collect():
        key = (r.doc_id, r.source)
        words[key] = words.get(key, 0) + n(r.text)
        copies.setdefault(key, []).append(r.text)
        assert r.text == whole[key] or whole[key].startswith(r.text) or n(r.text) < n(whole[key])
    for key, m in plan.items():
        if key[0] != 7:
            assert words.get(key, 0) == m.taken


def test_one_row_repeated_and_empty(docs_of):
    rows = [(1, "a b c", "s")] * 50 + [(2, "d " * 10, "t")]
    plan = mix_plan(docs_of(rows)).collect()
    assert len(plan) == 51
    assert len({r.mix for r in plan if r.doc_id == 1}) == 1
    assert mix_plan(docs_of([])).count() == 0 and mixed_documents(docs_of([])).count() == 0
    assert [r.mix.taken for r in mix_plan(docs_of([(1, None, None), (2, " ", "x")])).collect()] == [0, 0]


def test_columns_that_clash_with_the_plans(spark):
    rows = [(i, "w " * (i % 5 + 1), "ab"[i % 2]) for i in range(20)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, source string")
    names = "target epochs source_size at at_words mix plan p_source key size words nth stretch left cell ahead unit m rank weight cut".split()
    clashing = plain.select("*", *[F.lit("x").alias(c) for c in names])
    assert mixed_documents(clashing).columns == clashing.columns
    told = lambda df: sorted(tuple(r[c] for c in ("doc_id", "text", "source")) for r in df.collect())
    assert told(mixed_documents(clashing)) == told(mixed_documents(plain))
    assert {r.target for r in mixed_documents(clashing).collect()} == {"x"}
