"""op3 and op10 against brute force, components, and the pipeline."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from temblor.llm import langid, metric_join, ngram_join, packing, quality, secrets, shingles
from temblor.llm.common import connected_components

from .conftest import LONG, ODD

SF = "/root/testdata/sf0.01"


def groups_of(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute_shingles(text):
    words = shingles.normalize(text).split()
    return {b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_links(texts, threshold=0.8):
    sets = [brute_shingles(t) for t in texts]
    return [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
            and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold]


def test_words_ignore_case_and_punctuation():
    assert shingles.normalize("The, quick--Brown\n(fox) É!") == "the quick brown fox é".encode()
    assert shingles.normalize(None) == shingles.normalize(" .,") == b""


def test_shingles_equal_brute_force():
    texts = [t for _, t in ODD] + ["a b c d", "a b c d e", "a b c d e f"]
    got = shingles.shingle_sets([shingles.normalize(t) for t in texts])
    assert [len(s) for s in got] == [len(brute_shingles(t)) for t in texts]
    pieces = shingles.pieces(shingles.normalize(LONG))
    assert len(pieces) > 1 and len(shingles.shingle_sets([shingles.normalize(LONG)])[0]) == 4


@pytest.mark.parametrize("block", [512, 7])
def test_ngram_join_equals_brute_force(make_docs, block):
    rng = np.random.default_rng(8)
    words = np.array([f"w{i}" for i in range(500)])
    texts = []
    for _ in range(6):
        base = list(rng.choice(words, 150))
        for edits in (0, 0, 1, 2, 3, 4, 6, 10):
            t = list(base)
            for at in rng.choice(150, edits, replace=False):
                t[at] = f"e{rng.integers(1 << 30)}"
            texts.append(" ".join(t))
    shared = " ".join(rng.choice(words, 60))  # a passage in many documents is no link
    texts += [shared + " " + " ".join(rng.choice(words, 100)) for _ in range(30)]
    texts += ["a b c", "A, b c!", "a b d", "", None, "..."]
    rows = [(10 + i, t) for i, t in enumerate(texts)]
    links = brute_links(texts)
    n_links = [sum(i in p for p in links) for i in range(len(texts))]
    root = groups_of(len(texts), links)
    got = {r["doc_id"]: r for r in ngram_join.similar_documents(
        make_docs(rows), block=block).collect()}
    assert {i: r["n_links"] for i, r in got.items()} == {10 + i: n for i, n in enumerate(n_links)}
    assert {i: r["group_id"] for i, r in got.items()} == {10 + i: 10 + g for i, g in
                                                          enumerate(root)}
    assert all(r["kept"] == (r["doc_id"] == r["group_id"]) for r in got.values())


def test_ngram_join_odd_rows(odd_docs, no_docs, make_docs):
    got = ngram_join.similar_documents(odd_docs).collect()
    assert len(got) == len(ODD)
    # rows that share an id are one document; null ids link with nothing
    assert all(r["n_links"] == 0 and r["kept"] for r in got)
    assert ngram_join.similar_documents(no_docs).count() == 0
    twins = make_docs([(None, "one two three"), (1, "one two three"), (2, "one two three")])
    got = sorted(map(tuple, ngram_join.similar_documents(twins).collect()), key=str)
    assert got == sorted([(None, None, 0, None, True), (1, 1, 1, 1, True), (2, 1, 1, 1, False)],
                         key=str)


def test_prefixes_shorten_until_recall(spark, make_docs, monkeypatch):
    """Links just above the threshold force shorter prefixes."""
    depths = []
    real = ngram_join.star_edges
    monkeypatch.setattr(ngram_join, "star_edges",
                        lambda reps, depth: depths.append(depth) or real(reps, depth))
    rng = np.random.default_rng(3)
    rows = []
    for g in range(40):
        base = [f"x{g}y{i}" for i in range(130)]
        other = list(base)
        for at in (20, 60):
            other[at] = f"z{rng.integers(1 << 30)}"
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(other))]
    got = ngram_join.similar_documents(make_docs(rows), recall=0.9999).collect()
    assert depths == [6, 5, 4] and all(r["n_links"] == 1 for r in got)
    with pytest.raises(ValueError, match="recall"):
        ngram_join.similar_documents(make_docs(rows[:4]), recall=0.99999999)


def pairs_and_groups(rows, links):
    """Links of each distinct row to other pairs of id and content, and groups in
    which equal ids are one. ``rows``: (id, content); ``links``: index pairs."""
    known = list(dict.fromkeys(rows))
    linked = {i: {rows[b] for a, b in links if a == i} | {rows[a] for a, b in links if b == i}
              for i in range(len(rows))}
    same = [(i, j) for i in range(len(rows)) for j in range(i) if rows[i][0] == rows[j][0]]
    root = groups_of(len(rows), [*links, *same])
    least = {}
    for i, r in enumerate(root):
        least[r] = min(least.get(r, rows[i][0]), rows[i][0])
    return {row: (len(linked[rows.index(row)] - {row}), least[root[rows.index(row)]])
            for row in known}


@pytest.mark.parametrize("seed", range(3))
def test_ngram_join_with_several_texts_of_an_id(make_docs, seed):
    rng = np.random.default_rng(seed)
    base = [[f"b{g}w{i}" for i in range(120)] for g in range(6)]
    rows = [(5, " ".join(base[0])), (5, " ".join(base[1])), (7, " ".join(base[1][:-2])),
            (9, " ".join(base[0])), (3, " ".join(base[2])), (11, " ".join(base[3])),
            (11, " ".join(base[2])), (12, " ".join(base[3][1:])), (12, " ".join(base[4])),
            (12, " ".join(base[4][2:])), (20, " ".join(base[5])), (20, " ".join(base[5]))]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    want = pairs_and_groups(rows, brute_links([t for _, t in rows]))
    docs = make_docs(rows)
    got = ngram_join.similar_documents(docs).collect()
    assert sorted((r["doc_id"], r["n_links"], r["group_id"]) for r in got) == sorted(
        (i, *want[i, t]) for i, t in rows)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[7]["n_links"] == 1 and by_id[7]["group_id"] == 5 == by_id[9]["group_id"]
    assert {by_id[i]["group_id"] for i in (3, 11, 12)} == {3}


@pytest.mark.parametrize("seed", range(3))
def test_metric_join_with_several_vectors_of_an_id(spark, seed):
    rng = np.random.default_rng(seed)
    a, b, c, d = (tuple(v) for v in np.eye(8)[:4].tolist())
    near = tuple((np.array(b) + 0.1 * np.eye(8)[5]).tolist())
    rows = [(5, a), (5, b), (7, b), (9, near), (2, c), (11, d), (11, c), (12, d), (30, near),
            (30, near)]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    cos = [(i, j) for i in range(len(rows)) for j in range(i)
           if np.dot(rows[i][1], rows[j][1]) / np.linalg.norm(rows[i][1])
           / np.linalg.norm(rows[j][1]) >= 0.98]
    want = pairs_and_groups(rows, cos)
    df = spark.createDataFrame([(i, list(v), 1) for i, v in rows],
                               "vec_id long, embedding array<double>, label int")
    got = metric_join.similar_vectors(df).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == sorted(
        (i, *want[i, v]) for i, v in rows)
    by_id = {r["vec_id"]: r for r in got}
    assert by_id[7]["n_links"] == 3 and by_id[7]["component_id"] == 5
    assert {by_id[i]["component_id"] for i in (2, 11, 12)} == {2}


@pytest.mark.parametrize("edges", [
    [], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)],
    [(5, 4), (4, 5), (7, 7), (9, 8), (8, 4)],
    [tuple(map(int, p)) for p in np.random.default_rng(1).integers(0, 90, (70, 2))]])
def test_connected_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    root = groups_of(100, [e for e in edges if e[0] != e[1]])
    assert got == {x: root[x] for e in edges if e[0] != e[1] for x in e}


def brute_vectors(rows, cosine=0.98):
    ok = [i for i, (_, v, lab) in enumerate(rows) if v and lab is not None
          and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = []
    for i in ok:
        for j in ok:
            if j < i and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                    links.append((i, j))
    return links


@pytest.mark.parametrize("pivots,block", [(128, 1024), (16, 9), (1, 5)])
def test_metric_join_equals_brute_force(spark, pivots, block):
    rng = np.random.default_rng(6)
    rows = []
    for c in range(12):
        centre = rng.normal(size=8)
        rows += [(len(rows) + i, (centre + rng.normal(size=8) * 0.12).tolist(), c % 3)
                 for i in range(14)]
    rows += [(len(rows) + i, rows[3][1], 0) for i in range(5)]
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [], 0), (n + 2, [0.0] * 8, 0), (n + 3, [1.0, None] * 4, 0),
             (n + 4, [float("nan")] + [1.0] * 7, 0), (n + 5, [float("inf")] * 8, 0),
             (n + 6, rows[3][1], None), (n + 7, [1.0, 2.0], 0), (n + 8, [2.0, 4.0], 0),
             (n + 9, [1e300] * 8, 0), (n + 10, [1e-300] * 8, 0)]
    df = spark.createDataFrame([(*r, "x", True) for r in rows],
                               "vec_id long, embedding array<double>, label int, node string, "
                               "own boolean")
    links = brute_vectors(rows)
    root = groups_of(len(rows), links)
    got = {r["vec_id"]: r for r in metric_join.similar_vectors(
        df, pivots=pivots, block=block).collect()}
    assert {i: r["n_links"] for i, r in got.items()} == {
        i: sum(i in p for p in links) for i in range(len(rows))}
    assert {i: r["component_id"] for i, r in got.items()} == dict(enumerate(root))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_metric_join_sends_a_vector_once_to_a_home(spark, monkeypatch):
    """Vectors that no bound tells apart, in many cells: each goes to its own home and to
    at most half of the others, however many cells and vectors these have."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(1_000, 24))
    centres[300:420] = centres[0] + rng.normal(size=(120, 24)) * 0.05  # one group of many links
    centres[420:600] = centres[600:780] + rng.normal(size=(180, 24)) * 0.05
    rows = [(i, v.tolist(), 1 if i % 10 else 2) for i, v in enumerate(centres.astype("float32"))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    monkeypatch.setattr(metric_join, "HOME", 3, raising=False)  # homes of 90 or 64 vectors
    write, sent = metric_join.materialize, []

    def noted(found, name):
        if name == "vector-links":
            plan = found._jdf.queryExecution().analyzed().children().head()
            sent.append(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(
                df._jdf.sparkSession(), plan).count())
        return write(found, name)
    monkeypatch.setattr(metric_join, "materialize", noted)
    got = {r["vec_id"]: r for r in metric_join.similar_vectors(df, block=16).collect()}
    assert 1_000 < sent[0] < 6_500  # 52,505 before
    links = brute_vectors(rows)
    root = groups_of(len(rows), links)
    count = np.bincount(np.array(links).ravel(), minlength=len(rows))
    assert len(links) > 5_000
    assert {i: r["n_links"] for i, r in got.items()} == dict(enumerate(count.tolist()))
    assert {i: r["component_id"] for i, r in got.items()} == dict(enumerate(root))


def test_metric_join_empty_and_null_ids(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert metric_join.similar_vectors(spark.createDataFrame([], schema)).count() == 0
    got = metric_join.similar_vectors(spark.createDataFrame(
        [(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1)], schema)).collect()
    assert sorted(map(str, got)) == sorted(map(str, [
        type(got[0])(vec_id=None, n_links=0, component_id=None, kept=True),
        *[type(got[0])(vec_id=1, n_links=0, component_id=1, kept=True)] * 2]))


def test_no_forbidden_code():
    import inspect
    for module in (ngram_join, metric_join, packing, quality, secrets, langid, corpus_pipeline):
        code = inspect.getsource(module)
        assert not re.search(r"localCheckpoint|crossJoin|\.toPandas\(|except ImportError", code)


def test_registered():
    assert {f"op{i}" for i in range(1, 14)} == {k.split("_")[0] for k in E.queries()
                                                if re.match(r"op\d+_", k)}
    assert E.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in E.oracle_sql()


def test_pipeline_with_clashing_columns(spark, odd_docs, no_docs):
    """Extra columns named like the operators' own go through unharmed."""
    for docs in (odd_docs.withColumns({"id": F.lit(1), "content": F.lit("c"), "kept": F.lit(True),
                                       "row": F.lit(2), "spans": F.lit("s")}), no_docs):
        names = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == names
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= 0


def test_pipeline_stages(spark):
    """Each stage against its definition, on what the one before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame(
        [(90_001, None, "en", "s", 0), (90_002, "", None, "s", 0), (90_003, "123 !!", "en", "s", 6),
         (None, docs.where("doc_id = 1").first()["text"], None, "s", 9)], docs.schema)
    docs = docs.unionByName(extra).unionByName(docs.where("doc_id = 5"))
    out = {"": docs}
    for (name, stage), before in zip(corpus_pipeline.STAGES, ["", "language", "quality",
                                                             "near_duplicates", "secrets"]):
        out[name] = stage(spark, out[before], SF).persist()
    names = docs.columns
    assert all(out[n].columns == names for n, _ in corpus_pipeline.STAGES[:-1])

    def texts(name):
        return [(r["doc_id"], r["text"]) for r in out[name].collect()]

    letters = [(i, t) for i, t in texts("") if t and any(map(str.isalpha, t))]
    assert sorted(texts("language"), key=str) == sorted(letters, key=str)
    assert out["language"].where("lang is null").count() == 0
    kept = {(r["doc_id"], r["kept"]) for r in quality.judge(out["language"]).collect()}
    assert sorted(texts("quality"), key=str) == sorted(
        [r for r in texts("language") if (r[0], True) in kept], key=str)
    rows = sorted({r for r in texts("quality") if r[0] is not None})
    root = groups_of(len(rows), brute_links([t for _, t in rows]))
    first = [r for i, r in enumerate(rows) if root[i] == i]
    assert sorted(r for r in texts("near_duplicates") if r[0] is not None) == first
    assert sum(i is None for i, _ in texts("near_duplicates")) == 1
    after = dict(texts("secrets"))
    assert set(after) == {i for i, _ in texts("near_duplicates")}
    for i, t in texts("near_duplicates"):
        spans = secrets.base_spans(t)
        assert ("[SECRET]" in after[i]) if spans else True
        assert not secrets.base_spans(after[i])
        assert spans or after[i] == t or "[SECRET]" in after[i]
    packed = out["packing"].groupBy("doc_id").agg(F.sum("length").alias("n"),
                                                  F.max("doc_tokens").alias("m")).collect()
    assert {r["doc_id"] for r in packed} == set(after) and all(r["n"] == r["m"] for r in packed)
