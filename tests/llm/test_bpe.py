import hashlib

import public_tokenizers
import pytest
import tiktoken
from helpers import ODD, odd_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from viewrecon.llm import bpe

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.codec(PATH).ranks, special_tokens={})


def encode(text):
    return next(bpe.codec(PATH).encode([text.encode()]))


@settings(max_examples=600, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("aestrvlmdS'' \n\t .,!1½é漢😀́‍<|endoftext|>", max_size=60)))
def test_equals_the_library(reference, text):
    text = text.encode("utf-8", "replace").decode()
    ids, offsets = encode(text)
    assert ids == reference.encode_ordinary(text)
    assert bpe.codec(PATH).decode(ids) == text.encode()
    assert offsets[0] == 0 and offsets[-1] == len(text.encode()) and offsets == sorted(set(offsets)) or text == ""


@pytest.mark.parametrize("text", ["'s", "''s", " 's", "'sam'll", "'re'r e", "a\n'v", "\n\n'd", "a  b", "a \n b", "   ", "x" * 5000, " " * 3000 + "a", "'" * 501 + "s", "ab" * 4000 + " z"])
def test_corners(reference, text):
    assert encode(text)[0] == reference.encode_ordinary(text)


@pytest.mark.parametrize("left,right", [("a", "a"), ("1", "1"), ("!", "!"), (" ", " ")])
def test_every_code_point(reference, left, right):
    """Each code point between two others, in texts of 512 of them: the ids equal the library's."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["\n".join(left + c + right for c in points[i : i + 512]) for i in range(0, len(points), 512)]
    for text, (ids, _) in zip(texts, bpe.codec(PATH).encode([t.encode() for t in texts]), strict=True):
        assert ids == reference.encode_ordinary(text)


def test_texts_of_a_block_do_not_mix(reference):
    texts = ["a", "", "'", "s", " ", " b", "\U0010ffff", "c"]
    got = [ids for ids, _ in bpe.codec(PATH).encode([t.encode() for t in texts])]
    assert got == [reference.encode_ordinary(t) for t in texts]


def test_cache_is_bounded():
    c = bpe.Codec(PATH)
    c.CACHE = 10
    list(c.encode([" ".join(f"w{i}q" for i in range(500)).encode()]))
    assert len(c.cache) <= 10


def test_whole_table(spark, sf_dir, reference):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = bpe.op3_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())


def test_encode_decode_frames(spark):
    docs = odd_docs(spark).selectExpr("*", "1 AS ids", "2 AS offsets", "3 AS decoded", "4 AS __other")
    both = bpe.decode(bpe.encode(docs, PATH), PATH)
    rows = both.collect()
    assert len(rows) == len(ODD) and all(bytes(r.decoded).decode() == (r.text or "") for r in rows)
    assert both.columns == ["doc_id", "text", "__other", "ids", "offsets", "decoded"]
    assert bpe.encode(docs.limit(0), PATH).count() == 0
