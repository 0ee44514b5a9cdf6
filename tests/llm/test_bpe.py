"""BPE by a pair occurrence index, against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from returnscope.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts_of_many_kinds(n):
    rng = random.Random(3)
    scripts = [
        "aab  \n\té字!1'sll<|endoftext|>",
        "".join(map(chr, range(128))),
        "".join(chr(c) for c in range(0x20, 0x3000) if not 0xD800 <= c < 0xE000),
        "".join(chr(c) for c in range(0x10000, 0x20000)),
    ]
    return ["".join(rng.choice(rng.choice(scripts)) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_ids_equal_the_library(library):
    texts = texts_of_many_kinds(5_000) + [
        "", " ", "a" * 5_000, " " * 3_000, "ab" * 2_000, "<|endoftext|>", "x<|endoftext|> y <|endoftext|><|endoftext|>", "<|endoftext", "don't we'll",
    ]
    words = bpe.load(PATH)
    ids = [np.frombuffer(x, "<u4").tolist() for x in words.encode(texts, {})]
    for text, own, theirs in zip(texts, ids, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert own == theirs.ids, text
        assert words.decode(np.array(own, "<u4").tobytes()) == library.decode(theirs.ids, skip_special_tokens=False)


def test_words_known_or_not_and_in_any_order_give_the_same(monkeypatch):
    texts = texts_of_many_kinds(300)
    words = bpe.load(PATH)
    alone = [words.encode([t], {})[0] for t in texts]
    assert words.encode(texts, {}) == alone
    monkeypatch.setattr(bpe, "MANY", 1)
    assert words.encode(texts, {}) == alone
    monkeypatch.setattr(bpe, "MANY", 10**9)
    assert words.encode(texts, {}) == alone


def test_a_vocabulary_out_of_order_is_refused(tmp_path):
    import json

    with open(PATH, encoding="utf-8") as file:
        stored = json.load(file)
    stored["model"]["merges"].reverse()
    (tmp_path / "odd.json").write_text(json.dumps(stored))
    with pytest.raises(ValueError, match="before it"):
        bpe.Vocabulary(str(tmp_path / "odd.json"))


def test_rows_are_encoded_whole_whatever_stands_beside_them(spark, library):
    rows = [(1, "héllo  wörld", 5), (1, None, 5), (None, "", 5), (2, "z" * 300_000 + " end", 5), (1, "héllo  wörld", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids long")
    both = bpe.encode(docs, PATH, decoded=True)
    assert both.columns == ["id", "n_tokens", "ids", "decoded"]
    got = sorted(((r["id"], r["decoded"], r["n_tokens"]) for r in both.collect()), key=str)
    want = [(i, t or "", len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows]
    assert got == sorted(want, key=str)
    apart = bpe.decode(both.drop("decoded"), PATH)
    assert sorted(apart.collect(), key=str) == sorted(both.collect(), key=str)
    assert bpe.encode(docs.limit(0), PATH, decoded=True).count() == 0


def test_the_query_equals_the_library(spark, library, tmp_path):
    texts = [*texts_of_many_kinds(50), None, ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.op13_bpe(spark, str(tmp_path)).collect()}
    for n, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False).encode()
        assert got[n] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back).hexdigest())
