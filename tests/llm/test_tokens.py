"""op1 and op8 against the tokenizer libraries."""

import base64
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from temblor.llm import bpe, packing

from .conftest import ODD

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tik():
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _encoded(docs, **kw):
    got = bpe.decode(bpe.encode(docs, RANKS, P.PATTERN, **kw), RANKS).collect()
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, bytes(r["ids"]), r["n_tokens"],
                   bytes(r["decoded"])) for r in got)


def _expected(tik, rows):
    out = []
    for i, t in rows:
        ids = tik.encode_to_numpy(t or "").astype("<u4")
        out.append((i is None, i or 0, ids.tobytes(), len(ids), (t or "").encode()))
    return sorted(out)


def test_bpe_equals_library_on_odd_rows(odd_docs, tik):
    assert _encoded(odd_docs) == _expected(tik, ODD)


def test_bpe_empty_table(no_docs):
    assert _encoded(no_docs) == []


@pytest.mark.parametrize("chunk,overlap", [(64, 16), (40, 8), (200, 60)])
def test_bpe_stitches_small_chunks(make_docs, tik, chunk, overlap):
    rng = np.random.default_rng(5)
    alphabet = list("ab  \n\n'st12.,!é日") + ["'re", "   ", "\t"]
    rows = [(i, "".join(rng.choice(alphabet, 700))) for i in range(25)]
    # no common boundary in an overlap: one letter run, one run of spaces
    rows += [(100, "x" * 900), (101, " " * 500 + "y"), (102, "a\n" * 400), (None, "z " * 300),
             (103, "b" * 300 + " word " * 60), (103, "b" * 300 + " word " * 60)]
    docs = make_docs(rows)
    assert _encoded(docs, chunk=chunk, overlap=overlap) == _expected(tik, rows)


def test_bpe_chunks_must_exceed_overlaps(odd_docs):
    with pytest.raises(ValueError):
        bpe.encode(odd_docs, RANKS, P.PATTERN, chunk=10, overlap=5)


def test_binary_pieces():
    assert packing.binary_pieces(4096 * 2 + 5) == [4096, 4096, 4, 1]
    assert packing.binary_pieces(1) == [1]
    assert packing.binary_pieces(0) == []
    for n in range(1, 300):
        got = packing.binary_pieces(n, 64)
        assert sum(got) == n and got == sorted(got, reverse=True)


SPECIAL = [(50, "hello <|endoftext|> world"), (51, "a<|endoftext|>b<|startoftext|>"),
           (52, "<|endoftext|>"), (53, "<|ENDOFTEXT|> <|endoftext |> É<|startoftext|>é x"),
           (54, "<|endoftext|><|endoftext|> \n<|startoftext|>\t1")]


def test_pack_equals_library(make_docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(WORDS)
    rows = packing.pack(make_docs([*ODD, *SPECIAL]), WORDS).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    assert all(r["length"] == 1 << r["bucket"] and r["offset"] == 0 for r in rows)
    got = {}
    for r in rows:
        got.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], bytes(r["ids"])))
    want = {}
    for i, t in [*ODD, *SPECIAL]:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.setdefault((i, len(ids)), []).append(ids.tobytes())
    assert set(got) == set(want)
    for key, texts in want.items():
        joined = b"".join(p for _, p in sorted(got[key])) if len(texts) == 1 else None
        assert joined in (None, texts[0])
        assert sum(len(p) for _, p in got[key]) == sum(map(len, texts))


def test_pack_sequence_ids_keep_lengths_together(odd_docs):
    rows = sorted(packing.pack(odd_docs, WORDS).select("sequence_id", "length").collect())
    lengths = [r["length"] for r in rows]
    assert lengths == sorted(lengths)


def test_word_ids_equal_library_on_words():
    from tokenizers import Tokenizer
    spec = open(WORDS, encoding="utf-8").read()
    tok, words = Tokenizer.from_str(spec), packing.WordIds(spec, limit=50)
    text = ("It's  ''s 'tis I'LL x²½ 5,000.5 <|endoftext|> é e\u0301 ÀÈ İstanbul ΣΑΣ a\x1cb c\xa0d "
            "ﬀ ſ K ǆ ŉ ẞ " + " ".join(f"w{i}ord{i}" for i in range(300)))
    assert np.frombuffer(packing.text_ids(words, text), "<u4").tolist() == tok.encode(
        text, add_special_tokens=False).ids
    assert zlib.crc32(packing.text_ids(words, "")) == 0
