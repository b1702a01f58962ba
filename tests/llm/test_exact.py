"""op11, op12 and op13 against brute force."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from temblor.llm import codes, importance, inner_search, vectors

from .conftest import ODD

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()),
                        T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType()),
                        # names that the operators use themselves
                        T.StructField("row", T.StringType()), T.StructField("norm", T.StringType()),
                        T.StructField("id", T.StringType()), T.StructField("error", T.LongType())])

ODD_VECTORS = [(0, None, 1), (50, [], 1), (100, [1.0, None, 0.0, 0.0], 1),
               (150, [float("nan"), 0.0, 0.0, 0.0], 2), (200, [float("inf"), 0.0, 0.0, 0.0], 2)]


@pytest.fixture(scope="module")
def make_vectors(spark):
    def make(rows):
        """rows: (vec_id, embedding, label)"""
        return spark.createDataFrame([(*r, "x", "y", "z", 7) for r in rows], VECTORS)
    return make


def whole(v):
    if not v or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(256 * float(np.float32(x))) for x in v]


# ------------------------------------------------------------------------ op11
def brute_top(rows, every=50, k=5):
    known = [(i, whole(v)) for i, v, _ in rows]
    out = []
    for a, (q, x) in enumerate(known):
        if x is None or q is None or q % every:
            continue
        found = sorted((-sum(s * t for s, t in zip(x, y)), i is None, i or 0)
                       for b, (i, y) in enumerate(known) if b != a and y and len(y) == len(x))
        out += [(q, n + 1, None if no else i, -s) for n, (s, no, i) in enumerate(found[:k])]
    return sorted(out, key=str)


def top(df, **kw):
    return sorted(map(tuple, inner_search.top_products(df, **kw).collect()), key=str)


@pytest.mark.parametrize("block", [8192, 40])
def test_top_products_equal_brute_force(make_vectors, block):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 8)) * rng.lognormal(0, 0.8, size=(400, 1))
    rows = [(int(i), v.tolist(), 0) for i, v in enumerate(x)]
    # a third of all rows equal (ties), negative and repeated ids, null ids
    rows += [(1000 + i, [0.5] * 8, 1) for i in range(200)]
    rows += [(-50, [-1.0] * 8, 1), (None, [0.5] * 8, 1), (50, [0.25] * 8, 3), *ODD_VECTORS]
    assert top(make_vectors(rows), block=block) == brute_top(rows)


def test_top_products_fewer_than_k_and_other_lengths(make_vectors):
    rows = [(0, [1.0, 0.0], 1), (50, [0.0, 1.0], 1), (7, [0.5, 0.5], 1), (100, [1.0, 2.0, 3.0], 1),
            (150, [0.0], 1)]
    got = top(make_vectors(rows))
    assert got == brute_top(rows) and len(got) == 4
    assert top(make_vectors([])) == top(make_vectors(ODD_VECTORS)) == []
    assert top(make_vectors([(1, [1.0], 0), (2, [2.0], 0)])) == []


def test_top_products_stop_when_lengths_no_longer_reach(make_vectors):
    # Long vectors first: the threshold they set leaves the rest unread.
    rows = [(i, [4.0, 4.0] if i < 60 else [0.01, 0.01], 0) for i in range(600)]
    assert top(make_vectors(rows), block=50) == brute_top(rows)


def test_unit_prunes_by_length_and_partial_sums(monkeypatch):
    import pandas as pd
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(64, 16)) * 100, rng.normal(size=(4000, 16))]).astype("<i4")
    frame = pd.DataFrame({"row": range(len(x)), "id": range(len(x)), "no_id": 0,
                          "norm": np.sqrt((x.astype(float) ** 2).sum(1)),
                          "vector": [v.tobytes() for v in x]})
    q = frame.head(20).rename(columns={"row": "q_row", "id": "q_id"}).assign(threshold=np.nan)
    seen = []
    real = inner_search.products
    monkeypatch.setattr(inner_search, "products", lambda a, b: seen.append(len(b)) or real(a, b))
    turn, head = inner_search.rotation(x)
    got = inner_search.best_of(q, frame, turn, head, 5, chunk=64)
    assert sum(seen) < 400  # of 4,064 vectors
    scores = x[:20].astype(int) @ x.T.astype(int)
    scores[np.arange(20), np.arange(20)] = -1 << 60
    for i in range(20):
        assert sorted(got[got.q_row == i].score, reverse=True) == sorted(
            scores[i], reverse=True)[:5]


def test_products_beyond_doubles_are_exact():
    a = np.array([[(1 << 28) - 1, 3]], "<i4")
    assert inner_search.products(a, a)[0, 0] == ((1 << 28) - 1) ** 2 + 9


def test_too_large_components_raise(make_vectors):
    with pytest.raises(Exception, match="scaled component"):
        top(make_vectors([(0, [float(1 << 21)], 0), (1, [1.0], 0)]))


# ------------------------------------------------------------------------ op12
def words_of(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_resample(rows, target, max_n=1, buckets=10_000, percent=10, min_words=20):
    def found(text):
        w = words_of(text)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets
                for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]
    own, wanted = [0] * buckets, [0] * buckets
    for _, text in rows:
        for b in found(text):
            own[b] += 1
    for text in target:
        for b in found(text):
            wanted[b] += 1
    s_all, t_all = sum(own), sum(wanted)
    gain = [math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
            for s, t in zip(own, wanted)]
    out = []
    for doc, text in rows:
        f = found(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        name = "" if doc is None else doc
        h = int(hashlib.sha256(f"2024:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(f), weight, score, None, len(words_of(text))])
    able = sorted((r for r in out if r[5] >= min_words),
                  key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def resampled(docs, target, **kw):
    return sorted(map(tuple, importance.resample(docs, target, **kw).collect()), key=str)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(11)
    words = np.array([f"w{i}" for i in range(300)] + ["É", "日本", "Naïve", "x1-y"])
    return [(int(i), " ".join(rng.choice(words, rng.integers(5, 80)))) for i in range(300)]


@pytest.mark.parametrize("max_n,percent", [(1, 10), (2, 37), (1, 100)])
def test_resample_equals_brute_force(spark, make_docs, texts, max_n, percent):
    rows = [*texts, *ODD, *[(9, "one two three " * 10)] * 40, (None, "null id " * 20)]
    target = [*[t for _, t in texts[:20]], None, "", "W3 w3, W4"]
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(target)],
                                  "item_id long, text string, buckets string")
    got = resampled(make_docs(rows), bench, max_n=max_n, percent=percent)
    assert got == brute_resample(rows, target, max_n, percent=percent)


def test_resample_cuts_inside_ties(spark, make_docs):
    # Every row has the same id and text: the cutoff falls inside one tie.
    rows = [(5, "a b c d e " * 10)] * 95 + [(5, "a b c d e " * 20)] * 25
    bench = spark.createDataFrame([("a b",)], "text string")
    got = resampled(make_docs(rows), bench)
    assert got == brute_resample(rows, ["a b"])
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 13))


def test_resample_empty_tables(spark, make_docs, no_docs, odd_docs):
    bench = spark.createDataFrame([], "text string")
    assert resampled(no_docs, bench) == []
    assert resampled(odd_docs, bench) == brute_resample(ODD, [])


def test_bisection_and_ranks_over_ranges(spark):
    rng = np.random.default_rng(2)
    values = [int(v) for v in rng.integers(-10**17, 10**17, 500)] + [3] * 300
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "a long, b long")
    expected = sorted((v, i) for i, v in enumerate(values))
    for n in (1, 200, 400, 800):
        chosen = df.where(importance.first_rows(df, ["a", "b"], n))
        assert sorted(map(tuple, chosen.collect())) == expected[:n]
        ranks = importance.ranked(chosen, ["a", "b"], n, range_rows=90).orderBy("rank").collect()
        assert [(r["a"], r["b"], r["rank"]) for r in ranks] == [
            (*v, k + 1) for k, v in enumerate(expected[:n])]


# ------------------------------------------------------------------------ op13
def brute_codes(rows, parts, entries, rounds):
    kept = sorted(((i is None, i or 0, whole(v), label) for i, v, label in rows if whole(v)),
                  key=lambda r: r[:3])
    x = np.array([r[2] for r in kept]).reshape(len(kept), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()

    def assigned():
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(3)
        return d.argmin(2), d.min(2).sum(1)
    for _ in range(rounds):
        code, _ = assigned()
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = x[code[:, p] == e, p]
                if len(mine):
                    books[p, e] = mine.sum(0) // len(mine)
    code, error = assigned()
    total = {}
    for r, e in zip(kept, error):
        total[r[3]] = total.get(r[3], 0) + int(e)
    digest = hashlib.sha256(",".join(map(str, books.ravel())).encode()).hexdigest()
    return sorted(((None if r[0] else r[1], "".join(f"{c:02x}" for c in cs), int(e), total[r[3]],
                    digest) for r, cs, e in zip(kept, code, error)), key=str)


def coded(df, **kw):
    return sorted(map(tuple, codes.compress(df, **kw).collect()), key=str)


@pytest.mark.parametrize("entries,rounds", [(64, 2), (16, 6), (1, 2), (2, 3), (200, 4)])
def test_codes_equal_brute_force(make_vectors, entries, rounds):
    rng = np.random.default_rng(entries)
    x = rng.normal(size=(500, 8)) * 0.3
    rows = [(int(i) * 3 - 60, v.tolist(), int(i) % 5 or None) for i, v in enumerate(x)]
    rows += [(9000 + i, [0.25] * 8, 4) for i in range(250)]     # copies
    rows += [(-60, [0.1] * 8, 4), (None, [0.2] * 8, 1)]          # a repeated id, a null id
    rows += [(i, v, label) for i, v, label in ODD_VECTORS]
    got = coded(make_vectors(rows), parts=4, entries=entries, rounds=rounds)
    assert got == brute_codes(rows, 4, entries, rounds)


def test_codes_few_or_no_vectors(make_vectors):
    rows = [(i, [0.5 * i, 1.0, -1.0, 0.0], None) for i in range(3)]
    assert coded(make_vectors(rows), parts=2) == brute_codes(rows, 2, 64, 2)
    assert coded(make_vectors([])) == coded(make_vectors(ODD_VECTORS)) == []
    with pytest.raises(ValueError, match="do not fit"):
        codes.compress(make_vectors([(1, [1.0, 2.0], 0), (2, [1.0, 2.0, 3.0], 0)]), parts=1)


def test_bounds_spare_most_distances():
    rng = np.random.default_rng(0)
    centres = rng.integers(-2000, 2000, (32, 4))
    x = (centres[rng.integers(0, 32, 5000)] + rng.integers(-40, 40, (5000, 4))).astype(np.int64)
    code, near, low, far = codes.assign_all(x, centres, 8)
    books = centres + rng.integers(-5, 5, centres.shape)
    moved = np.sqrt(((books - centres) ** 2).sum(1)) + 1e-6
    code, near, low, own, used = codes.assign_bounded(x, books, moved, code, near, low)
    d = codes.squares(x, books)
    assert (code == d.argmin(1)).all() and (own == d.min(1)).all()
    assert (used == 0).mean() > 0.9
    others = np.take_along_axis(d, near.astype(int), 1)
    assert (low[:, :-1] <= np.sqrt(others)).all()


def test_number_of_bounds_adapts(spark):
    used = spark.createDataFrame([(0,)] * 900 + [(3,)] * 95 + [(9,)] * 5, "used long")
    assert codes.fewer_bounds(used, 16, 16) == 3
    assert codes.fewer_bounds(used, 16, 64) == 8   # an eighth of the entries at least
    assert codes.fewer_bounds(used, 2, 64) == 2    # never more than before


def test_whole_numbers_floor_like_doubles(make_vectors):
    rows = vectors.whole_numbers(make_vectors([(1, [0.1, -0.1, 0.00390625, -0.0], 0)]),
                                 "vec_id", "embedding", 256, label=F.col("label")).collect()
    assert np.frombuffer(rows[0]["vector"], "<i4").tolist() == [25, -26, 1, 0]
