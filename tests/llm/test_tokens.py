from __future__ import annotations

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tierline.llm.tokens import counted

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "a  b", "a\x1cb c", "a" * 9000, " " * 9000, "x <|endoftext|> y" * 900, "\n \n" * 4000,
    "it's " * 3000 + "  " * 500, "é  　" * 3000, "12 3" * 5000 + "\u0085 \n" * 2000, "<|endoftext|>" * 2000, "ab<|endo ftext|>",
    "don't\t 'll" * 2000, "😀 😀😀" * 3000, "𝔘𝔫 \x00 \n\x00 a\n\x00b", "word, " * 4000 + "end",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("chunk,overlap", [(1000, 50), (64, 16), (100_000, 1_024)])
def test_counts_equal_the_library(docs, library, chunk, overlap):
    texts = TEXTS if chunk > 64 else [t and t[:3000] for t in TEXTS]
    got = {r.doc_id: r for r in counted(docs(texts, extra=["row", "start", "chars"]), PATH, chunk=chunk, overlap=overlap).collect()}
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False))
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 512), i


def test_documents(docs, library, small):
    rows = [(i, t, "s") for i, t in small]
    got = {r.doc_id: r.n_tokens for r in counted(docs(rows), PATH, chunk=2_000, overlap=64).collect()}
    assert got == {i: len(library.encode(t or "", add_special_tokens=False)) for i, t in small}


def test_empty_null_id_and_repeats(docs):
    assert counted(docs([]), PATH).count() == 0
    long = "some words " * 300
    rows = [(None, long, "s"), (1, long, "s"), (1, long, "s"), (1, "other", "s"), (None, None, "s")]
    assert sorted(r.n_tokens for r in counted(docs(rows), PATH, chunk=500, overlap=40).collect())[:2] == [0, 1]
    assert counted(docs(rows), PATH, chunk=500, overlap=40).count() == 5


def test_cuts_between_texts_side_by_side(library):
    import numpy as np
    import pyarrow as pa

    from tierline.llm.tokens import _Encoder

    encoder = _Encoder(PATH)
    assert encoder.cuts
    ends = ["", "a", " ", "\n", "a ", " a", "a\n", "\na", ".", "a.", "a. ", ".\n\n", "\u00a0", "\u3000", "\u180e", "\ufeff", "é", "日", "'s", "<|endoftext|>", "a\x85"]
    texts = [x + m + y for x in ends for m in ("", " ", "\n", "b c", "b.c d's\ne") for y in ends]
    assert encoder.counts(pa.array(texts)).tolist() == encoder.lengths(texts)
    shuffled = np.random.default_rng(3).permutation(texts).tolist()
    sliced = pa.array(["left out", *shuffled]).slice(1)
    assert encoder.counts(sliced).tolist() == encoder.lengths(shuffled)


def test_other_tokenizers_are_not_cut():
    import json

    from tierline.llm.tokens import _Encoder, cuts_at_blanks

    assert not _Encoder(public_tokenizers.path("word_bpe_49k.json")).cuts
    model = json.loads(Tokenizer.from_file(PATH).to_str())
    assert cuts_at_blanks(model)
    for change in ({"pre_tokenizer": None}, {"normalizer": {"type": "NFC"}}, {"pre_tokenizer": model["pre_tokenizer"] | {"add_prefix_space": True}}):
        assert not cuts_at_blanks(model | change)
    for token in ("two words", "dotted.name"):
        assert not cuts_at_blanks(model | {"added_tokens": [{"content": token}]})


def test_chunks_grow_without_reading_the_texts_again(docs, spark):
    """Runs that no border falls into are joined from the chunks until one does."""
    from tierline.llm.tokens import _PIECE, _ddl, _last_start, widened

    text = "".join(chr(97 + i % 26) for i in range(1_000))
    for size in (1, 63, 64, 65, 80, 81, 500, 999):
        starts = range(0, _last_start(size, 64, 16) + 1, 64)
        rows = [(1, 1, size, size, s, text[:size][s : s + 80]) for s in starts]
        got = widened(spark.createDataFrame(rows, _ddl(_PIECE)), 256, 64).collect()
        assert sorted((r.start, r.text) for r in got) == [(s, text[:size][s : s + 320]) for s in range(0, _last_start(size, 256, 64) + 1, 256)]
