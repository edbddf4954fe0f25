"""SentencePiece against the library itself: ids, spans, text, normalised text."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece as library

from odometer.llm.queries import PIECE_MODEL, QUERIES, tokenizer_path
from odometer.llm.sentencepieces import Codec, encode_documents, piece_rows

SF_DIR = "/root/testdata/sf0.001"
HARD = [
    "", " ", "  a", "a ", "▁a", "a▁▁b", "\x00", "a\x00b", "\n", " \n\t ", "<s>", "</s> <unk> <0x41>", "\ufeffa",
    "日本🧿\U0001f9ff", "x" * 5000, "ab" * 2000 + " " * 3000 + "日" * 300, "the quick " * 30_000,
]


@pytest.fixture(scope="module")
def theirs():
    return library.SentencePieceProcessor(model_file=tokenizer_path(PIECE_MODEL))


@pytest.fixture(scope="module")
def ours():
    return Codec(tokenizer_path(PIECE_MODEL))


def random_texts(alphabet, n, longest, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(alphabet, k=rnd.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("texts", [HARD, random_texts("abc  \n\t▁éü日本🧿,.'0<>x\x00", 2000, 40)], ids=["hard", "random"])
def test_ids_spans_and_text(ours, theirs, texts):
    for text in texts:
        ids, firsts, lasts = ours.encode(text)
        if len(text) < 10_000:
            assert [*zip(ids, firsts, lasts)] == [(p.id, p.begin, p.end) for p in theirs.encode(text, return_type="proto").pieces]
        ids, *_ = ours.encode(text, True, True)
        assert ids.tolist() == theirs.encode(text, add_bos=True, add_eos=True)
        assert ours.decode(ids) == theirs.decode(ids.tolist())


def test_decoding_any_ids(ours, theirs):
    rnd = random.Random(2)
    for _ in range(3000):
        ids = [rnd.randrange(32_000 if rnd.random() < 0.3 else 300) for _ in range(rnd.randint(0, 12))]
        assert ours.decode(ids) == theirs.decode(ids)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf"])
def test_compiled_character_map(rule):
    lib = library.SentencePieceNormalizer(rule_name=rule)
    ours = Codec(lib.serialized_model_proto())
    for text in random_texts("AB ａﬁ Å\u030a㍿\u200b\u3000\t\n éÀÇ日本が゙ﾊﾟ株①½\xad\ufeffΣ🧿", 1500, 25):
        normal, places = ours.normalise(text)
        want, chars = lib.normalize(text, with_offsets=True)
        starts = {b: i for i, b in enumerate(np.cumsum([0, *(len(c.encode()) for c in text)]).tolist())}
        at = np.cumsum([0, *(len(c.encode()) for c in normal)])
        assert (normal, [starts[p] for p in places[at].tolist()]) == (want, chars)


def test_spans_tile_the_text(ours):
    text = "Ünï  cödé 🧿 text\nwith ▁ marks"
    _, firsts, lasts = ours.encode(text, True, True)
    assert firsts[0] == 0 and lasts[-1] == len(text.encode()) and (firsts[1:] == lasts[:-1]).all()


def test_every_document(spark, theirs):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op13_sentencepiece"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = theirs.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(theirs.decode(ids).encode()).hexdigest()


def test_nulls_repeats_clashes_and_empty_tables(spark):
    path = tokenizer_path(PIECE_MODEL)
    df = spark.createDataFrame([(1, None, 7), (None, "", 7), (2, "a b", 7), (2, "a b", 7)], "doc_id long, text string, ids int")
    rows = encode_documents(df, path).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, len(r.ids) // 4, r.decoded) for r in rows) == [
        (False, 1, 2, ""), (False, 2, 4, "a b"), (False, 2, 4, "a b"), (True, 0, 2, "")
    ]
    pieces = piece_rows(encode_documents(df.filter("doc_id = 2").limit(1), path)).orderBy("place").collect()
    assert [(p.doc_id, p.place, p.first, p.last) for p in pieces] == [(2, 0, 0, 0), (2, 1, 0, 1), (2, 2, 1, 3), (2, 3, 3, 3)]
    assert encode_documents(df.limit(0), path).collect() == []
