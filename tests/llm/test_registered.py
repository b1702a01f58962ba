"""The registered queries themselves, column by column, against brute force over
a whole small table."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] or "" for r in
            spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def rows_of(spark, key):
    return [r.asDict() for r in E.queries()[key](spark, SF).collect()]


def test_op1_columns(spark, documents):
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(
        bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    tik = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in rows_of(spark, "op1_byte_bpe")}
    assert set(got) == set(documents)
    for i, text in documents.items():
        ids = tik.encode_ordinary(text)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(
            np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def base_spans(text):
    assign = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
              r"""([A-Za-z0-9+/_.=-]+)""")
    found = [("assign", *m.span()) for m in re.finditer(assign, text, re.A) if len(m[1]) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return found


def test_op5_columns(spark):
    kinds = ["assign", "access", "hex", "crf"]
    sf = SF.replace("0.001", "0.01")  # the smallest table has no secrets
    documents = {r["doc_id"]: r["text"] or "" for r in
                 spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r.asDict() for r in E.queries()["op5_secret_scan"](spark, sf).collect()}
    assert set(got) == set(documents)
    n = 0
    for i, text in documents.items():
        want = sorted(base_spans(text), key=lambda s: (s[1], kinds.index(s[0])))
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), (i, joined)
        assert [got[i][f"n_{k}"] for k in kinds[:3]] == [
            sum(s[0] == k for s in want) for k in kinds[:3]]
        spans = got[i]["spans"].split(",") if got[i]["spans"] else []
        assert [s for s in spans if not s.startswith("crf:")] == (joined.split(",") if want else [])
        assert all(re.fullmatch(r"(assign|access|hex|crf):\d+:\d+", s) for s in spans)
        n += len(want)
    assert n > 0


def test_op6_base_columns(spark, documents):
    def tokens(text):
        return re.findall(r"[^\x20\x09-\x0D]+", re.sub(
            "[A-Z]", lambda m: m[0].lower(), text)) + [None]
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in documents}
    counts = Counter(t for i, text in documents.items() if not held[i] for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    for r in rows_of(spark, "op6_lm_score"):
        own = tokens(documents[r["doc_id"]])
        assert r["held_out"] == held[r["doc_id"]] and r["train_tokens"] == total
        assert r["n_tokens"] == len(own) and r["n_known"] == sum(counts[t] > 0 for t in own)
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0


def test_op8_columns(spark, documents):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    pieces = {}
    for r in rows_of(spark, "op8_pack"):
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == set(documents)
    for i, text in documents.items():
        ids = np.array(tok.encode(text, add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["offset"] == 0
            assert r["length"] <= 4096 and r["length"] & (r["length"] - 1) == 0
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:at].tobytes())
        assert at == len(ids)
    ids = [r["sequence_id"] for p in pieces.values() for r in p]
    assert len(ids) == len(set(ids))


def test_op3_columns(spark, documents):
    from .test_joins import brute_links, groups_of
    order = sorted(documents)
    links = brute_links([documents[i] for i in order])
    root = groups_of(len(order), links)
    got = {r["doc_id"]: r for r in rows_of(spark, "op3_ngram_join")}
    for n, i in enumerate(order):
        assert got[i]["n_links"] == sum(n in p for p in links)
        assert got[i]["group_id"] == order[root[n]]
        assert got[i]["kept"] == (got[i]["group_id"] == i)


def test_op10_columns(spark):
    from .test_joins import groups_of
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r["embedding"] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.98
    links = [(i, j) for i in range(len(rows)) for j in range(i)
             if near[i, j] and rows[i]["label"] == rows[j]["label"] is not None]
    root = groups_of(len(rows), links)
    got = {r["vec_id"]: r for r in rows_of(spark, "op10_metric_join")}
    for n, r in enumerate(rows):
        assert got[r["vec_id"]]["n_links"] == sum(n in p for p in links)
        assert got[r["vec_id"]]["component_id"] == rows[root[n]]["vec_id"]
        assert got[r["vec_id"]]["kept"] == (root[n] == n)
