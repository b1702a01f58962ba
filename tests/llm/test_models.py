"""op5, op6 and op7: brute force, exactness of decoding, held-out quality."""

import math
import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from temblor.llm import langid, lm, secrets
from temblor.llm.common import crc32_mod

from .conftest import ODD

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r for r in documents.collect()}


# --- op5 -----------------------------------------------------------------

def brute_spans(text):
    out = []
    for kind, pattern, flags, size in (
            ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                       r"""([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 6),
            ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24)):
        for m in re.finditer(pattern, text, flags):
            if len(m[2] if kind == "assign" else m[0]) >= size:
                out.append((m.start(), secrets.KINDS.index(kind), m.end()))
    return sorted(out)


TRICKY = ["token=token :abcdefgh token=abcdefgh", "PASSWORD = 'x' Api_Key:\"abcdef\"",
          "a" * 23 + " " + "a" * 24 + "g", "AKIAAKIA" + "A" * 20, "AKIA" + "B" * 15,
          "ſecret=abcdefg toKen=abcdefg", "é secret: " + "0123456789abcdef" * 2,
          "password=abcdef0123456789abcdef01"]


def test_base_spans_equal_brute_force(texts):
    for t in [*TRICKY, *[r["text"] for r in texts.values()], *[t or "" for _, t in ODD]]:
        assert [(s, k, e) for s, k, e, _ in secrets.base_spans(t)] == brute_spans(t)


@pytest.fixture(scope="module")
def field(documents):
    return secrets.fit(documents)


def test_field_decodes_as_over_the_whole_text(field, texts):
    checked = 0
    for t in [*TRICKY, *[r["text"] for r in texts.values()][:250]]:
        tokens = list(secrets.FINE.finditer(t))
        tags = field.decode([m[0] for m in tokens], secrets.file_hint(t))
        begun, whole = None, []
        for m, y in zip([*tokens, None], [*tags, secrets.O]):
            if begun is not None and y != secrets.I:
                whole.append((begun, end))
                begun = None
            if y == secrets.B:
                begun = m.start()
            if y != secrets.O:
                end = m.end()
        assert field.spans(t) == whole
        checked += bool(whole)
    assert checked


def test_viterbi_is_the_best_sequence(field):
    from itertools import product
    tokens = ["the", "token", "=", "a1b2c3d4e5f6a7b8c9", "and"]
    keys = secrets.surroundings(tokens, True)

    def value(tags):
        path = [secrets.O, *tags, secrets.O]
        return sum(field.moves[a][b] for a, b in zip(path, path[1:])) + sum(
            field.emission(k)[y] for k, y in zip(keys, tags))

    best = max(product((0, 1, 2), repeat=len(tokens)), key=value)
    assert value(best) == pytest.approx(value(field.decode(tokens, True)))


def test_field_finds_held_out_secrets(field, texts):
    """Spans of documents that the sample did not hold are found again."""
    hit = total = 0
    for t in [r["text"] for r in texts.values()][::2]:
        base = [(v, e) for _, _, e, v in secrets.base_spans(t)]
        got = field.spans(t)
        total += len(base)
        hit += sum(any(s < e2 and s2 < e for s2, e2 in got) for s, e in base)
    assert total and hit / total > 0.9


def _key(rng, n):
    return "".join(rng.choices(string.ascii_letters + string.digits, k=n))


# Forms that no base pattern matches, with the recall asked for.
PLANTED = {
    "pwd": (lambda r: f"pwd: {_key(r, 12)}", 0.7),
    "bearer": (lambda r: f"Authorization: Bearer {_key(r, 32)}", 0.95),
    "parts": (lambda r: f"bearer {_key(r, 20)}.{_key(r, 24)}.{_key(r, 30)}", 0.95),
    "credential": (lambda r: f'credentials="{_key(r, 16)}"', 0.95),
    "other name": (lambda r: f'client_id = "{_key(r, 32)}"', 0.95),
    "bare": (lambda r: f"the value {_key(r, 32)}", 0.85),
}

HARMLESS = [
    "see RFC2616 and HTML5 in iPhone12", "id 550e8400-e29b-41d4-a716-446655440000 here",
    "version v1.12.3b4 of lib2to3", "at 2024-05-01T12:30:00Z exactly", "mail a.b2@c3.example.com",
    "https://www.example.com/a1/b2/page12.html?id=12345", "commit 3f2a9bc fixed it",
    "call +49 (136) 555-7479", "ISBN 978-3-16-148410-0", "getElementById2 and parseInt32Value",
    "the token of trust, password required", "auth: required", "key: value",
    "API key management in OAuth2", "Donaudampfschifffahrtsgesellschaftskapitän",
    "order AB12-9934-XZ", "9807915762804490", "image1024x768.png", "sha256sum of x86_64",
    "token ring 802.11ac", "key 12 of 30", "chapter3section4paragraph5", "keys: A1, B2, C3",
    "HELLO WORLD2024 BIGSALE50OFF"]


@pytest.mark.parametrize("form", PLANTED)
def test_field_finds_planted_secrets(field, texts, form):
    make, recall = PLANTED[form]
    rng, some = random.Random(form), [r["text"] for r in texts.values()][:200]
    hit = 0
    for t in some:
        before, secret, after = t[:300], make(rng), t[300:600]
        text = f"{before} {secret} {after}"
        assert not any(s < len(before) + 1 + len(secret) and len(before) < e
                       for s, _, e, _ in secrets.base_spans(text))
        end = len(before) + 1 + len(secret)
        value = end - len(secret.split()[-1])
        hit += any(s < end and value < e for s, e in field.spans(text))
    assert hit / len(some) >= recall


def test_field_leaves_the_rest_alone(field, texts):
    wrong = [h for h in HARMLESS if field.spans(f"some plain words {h} and more of them")]
    assert len(wrong) <= 1, wrong
    for t in [r["text"] for r in texts.values()]:
        base = secrets.base_spans(t)
        assert all(any(s < e2 and s2 < e for s2, _, e2, _ in base) for s, e in field.spans(t))


def test_altered_windows_keep_their_spans():
    tokens = ["the", "rivers", "token", "=", '"', "a1b2" * 10, '"', "hills", "and", "valleys"]
    tags = [secrets.O] * 5 + [secrets.B] + [secrets.O] * 4
    for k, (low, _, named, signed) in enumerate(secrets.MANNERS):
        got, marks, hint = secrets.altered(tokens, tags, k)
        assert (got, marks, hint) == secrets.altered(tokens, tags, k)
        at = marks.index(secrets.B)
        assert len(got) == len(marks) and marks.count(secrets.B) == 1 and hint == named
        assert sum(len(t) for t, y in zip(got, marks) if y != secrets.O) >= low
        assert ("token" in got[:at]) == named and ("=" in got[:at]) == signed
    assert secrets.altered(tokens, [secrets.O] * 10, 0)[1].count(secrets.B) == 0


def test_scan_of_odd_rows(odd_docs, no_docs, field):
    got = secrets.scan(odd_docs, field, keep=("score", "label")).collect()
    assert len(got) == len(ODD) and all(r["spans"] == [] for r in got)
    assert secrets.scan(no_docs, field).count() == 0
    assert secrets.fit(no_docs) is None
    assert secrets.scan(odd_docs, None).count() == len(ODD)


def test_redaction(make_docs, field):
    docs = make_docs([(1, "x password=abcdef0123456789abcdef01 y " + "0" * 24), (2, "clean"),
                      (3, None)])
    got = secrets.scan(docs, field, keep=("text",)).select(
        "doc_id", secrets.redacted(F.col("text"), F.col("spans")).alias("t")).collect()
    assert {r["doc_id"]: r["t"] for r in got} == {1: "x [SECRET] y [SECRET]", 2: "clean", 3: None}


def _hidden(n, seed=0):
    """Values that look like the field's own secrets, for ``n`` long texts."""
    rng = np.random.default_rng(seed)
    alphabet = list("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789")
    return ["".join(rng.choice(alphabet, 28)) for _ in range(n)]


def test_field_learns_from_rare_and_long_documents(make_docs):
    """Names in plain prose, spans only in long texts: both reach the sample."""
    prose = [f"the secret of page {i} is a token of trust and no password at all " * 3
             for i in range(1_500)]
    filler = "some plain words of a long page about rivers and hills\n" * 200
    long = [f"{filler}token = {v}\n{filler}" for v in _hidden(12)]
    docs = make_docs([*enumerate(prose), *enumerate(long, 5_000)])
    field = secrets.fit(docs)
    assert field is not None
    for v in _hidden(5, 3):
        t = f"{filler}password = {v}\n{filler}"
        at = t.index(v)
        assert any(s < at + len(v) and at < e for s, e in field.spans(t))
    assert sum(bool(field.spans(t)) for t in prose) == 0


def test_positive_group_is_that_of_the_base_spans(make_docs, texts):
    some = [*TRICKY, *[r["text"] for r in texts.values()], *[t for _, t in ODD if t is not None],
            "the token and the secret", "token=abcde", "x token : 'abcde!' api_key=a.b-c/"]
    got = make_docs(list(enumerate(some))).select(
        "doc_id", secrets.has_base_span(F.col("text")).alias("has")).collect()
    assert {r["doc_id"]: r["has"] for r in got} == {
        i: bool(secrets.base_spans(t)) for i, t in enumerate(some)}


def test_pieces_hold_whole_spans():
    rng = np.random.default_rng(6)
    for k in range(60):
        parts = [rng.choice(["word", "a.b", "x" * 50, "token = " + "ab3" * 5, "0a" * 15,
                             "AKIA" + "Q7" * 9, "api_key='zz9zz9zz9' y"]) + rng.choice([" ", "\n", "-"])
                 for _ in range(400)]
        text = "".join(parts)
        whole = {text[s:e] for s, _, e, _ in secrets.base_spans(text)}
        got = secrets.pieces(text, 2_000, 100)
        assert got and sum(map(len, got)) <= 2_000 and all(p in text for p in got)
        found = [p[s:e] for p in got for s, _, e, _ in secrets.base_spans(p)]
        assert found and set(found) <= whole
    assert secrets.pieces("token=" + "a1" * 9_000, 2_000)[0] == "token=" + "a1" * 997
    assert secrets.pieces("plain " * 900, 2_000) == [("plain " * 333).strip()]


# --- op6 -----------------------------------------------------------------

def test_base_scores_equal_brute_force(make_docs):
    rng = np.random.default_rng(2)
    words = [f"W{i}" for i in range(60)] + ["é", " x", "a\x0bb"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 40)))) for i in range(120)] + ODD[:-3]
    docs = make_docs(rows)
    got = lm.score(docs, crc32_mod("doc_id", 7) == 2, top_words=20, rounds=1).collect()

    def cut(t):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]

    def out(i):
        return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2

    count = Counter(w for i, t in rows if not out(i) for w in cut(t))
    n, v = sum(count.values()), len(count)
    want = sorted((i is None, i or 0, out(i), len(cut(t)), sum(count[w] > 0 for w in cut(t)), n,
                   round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in cut(t)), 6))
                  for i, t in rows)
    assert want == sorted((r["doc_id"] is None, r["doc_id"] or 0, r["held_out"], r["n_tokens"],
                           r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                          for r in got)
    assert all(r["score"] < 0 for r in got)


def _model(k=3, classes=5):
    rng = np.random.default_rng(4)
    norm = lambda x: x / x.sum(-1, keepdims=True)
    return lm.Model(norm(rng.random(k)), norm(rng.random((k, k))), norm(rng.random((k, classes))))


def test_forward_equals_sum_over_paths():
    from itertools import product
    m = _model()
    for seq in ([0], [1, 4, 2], [3, 3, 0, 1, 2, 4]):
        total = sum(np.prod([m.start[p[0]], *[m.moves[a, b] for a, b in zip(p, p[1:])],
                             *[m.emit[s, o] for s, o in zip(p, seq)]])
                    for p in product(range(3), repeat=len(seq)))
        assert m.log10([np.array(seq)])[0] == pytest.approx(math.log10(total))


def test_forward_is_exact_across_segments():
    m = _model()
    rng = np.random.default_rng(1)
    seqs = [rng.integers(0, 5, n) for n in (1, 255, 256, 257, 3000, 700)]
    want = []
    for s in seqs:
        v, log = m.start * m.emit[:, s[0]], 0.0
        for o in s[1:]:
            v = (v @ m.moves) * m.emit[:, o]
            log += math.log10(v.sum())
            v /= v.sum()
        want.append(log + math.log10(v.sum()))
    assert np.allclose(m.log10(seqs), want)


def test_expected_counts_equal_brute_force():
    from itertools import product
    m = _model()
    seqs = [np.array([0, 3, 1]), np.array([4]), np.array([2, 2, 2, 1])]
    totals = [np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))]
    m.expected(seqs, totals)
    want = [np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))]
    for seq in seqs:
        paths = list(product(range(3), repeat=len(seq)))
        w = np.array([np.prod([m.start[p[0]], *[m.moves[a, b] for a, b in zip(p, p[1:])],
                               *[m.emit[s, o] for s, o in zip(p, seq)]]) for p in paths])
        for p, x in zip(paths, w / w.sum()):
            want[0][p[0]] += x
            for a, b in zip(p, p[1:]):
                want[1][a, b] += x
            for s, o in zip(p, seq):
                want[2][s, o] += x
    assert all(np.allclose(a, b) for a, b in zip(totals, want))


def test_expected_counts_are_exact_across_segments():
    m = _model()
    rng = np.random.default_rng(3)
    seqs = [rng.integers(0, 5, n) for n in (1, 255, 256, 257, 2000, 512, 700)]
    totals = [np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))]
    m.expected(seqs, totals)
    want = [np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))]
    for seq in seqs:
        alpha, beta = [m.start * m.emit[:, seq[0]]], [np.ones(3)]
        for o in seq[1:]:
            v = (alpha[-1] / alpha[-1].sum() @ m.moves) * m.emit[:, o]
            alpha.append(v)
        for o in seq[:0:-1]:
            v = m.moves @ (m.emit[:, o] * beta[-1])
            beta.append(v / v.sum())
        beta.reverse()
        for t, o in enumerate(seq):
            here = alpha[t] * beta[t]
            want[2][:, o] += here / here.sum()
            if t == 0:
                want[0] += here / here.sum()
            else:
                both = alpha[t - 1][:, None] * m.moves * (m.emit[:, o] * beta[t])[None]
                want[1] += both / both.sum()
    assert all(np.allclose(a, b) for a, b in zip(totals, want))
    empty = [np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))]
    m.expected([], empty)
    assert not any(x.any() for x in empty) and len(m.log10([])) == 0


def test_model_beats_the_base_on_held_out(documents, no_docs):
    got = lm.score(documents, crc32_mod("doc_id", 7) == 2).where("held_out").toPandas()
    assert got["score"].sum() > got["base_score"].sum()
    assert lm.score(no_docs, crc32_mod("doc_id", 7) == 2).count() == 0


def test_nothing_to_train_on(make_docs):
    got = lm.score(make_docs([(1, "a b"), (2, None)]), F.lit(True)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 for r in got)


# --- op7 -----------------------------------------------------------------

def test_phrases_equal_brute_force(texts):
    known = {lang: "\n".join(r["text"] for r in texts.values() if r["lang"] == lang)[:4000]
             for lang in ("en", "de")}
    parser = langid.Parser(known)
    some = [r["text"] for r in texts.values()][:20] + ["日本 the Ünd ß!", "", "a", "zzz qqq"]
    phrases, _ = parser.counts(some)
    for text, got in zip(some, phrases.tolist()):
        for lang, n in zip(parser.langs, got):
            reference, want = " " + langid.normalize(known[lang]) + " ", 0
            for a in range(0, len(text), langid.STRETCH):
                s, i = langid.normalize(text[a:a + langid.STRETCH]), 0
                while i < len(s):
                    j = i + 1
                    while j <= len(s) and s[i:j] in reference:
                        j += 1
                    want, i = want + 1, max(j - 1, i + 1)
            assert n == want


def test_held_out_accuracy(spark, monkeypatch, texts):
    got = langid.op7_language(spark, SF).toPandas()
    held = got[got["held_out"]]
    right = [texts[r.doc_id]["lang"] == r.lang_pred for r in held.itertuples()]
    assert len(got) == len(texts) and np.mean(right) > 0.95
    assert got["score"].between(0, 1).all()


def test_language_of_odd_rows(odd_docs, no_docs):
    known = {"en": "the quick brown fox and the same text", "de": "der die und das"}
    got = langid.identify(odd_docs, known, keep=("label",))
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got.collect()}
    assert got.count() == len(ODD)
    assert all(by[i] == ("und", 0.0) for i in (1, 2, 3, 7)) and by[4][0] == "en"
    assert langid.fit(no_docs) == {} and langid.identify(no_docs, known).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd_docs, {}).collect()} == {"und"}


SCRIPTS = {
    "zh": [chr(0x4E00 + 7 * i % 900) for i in range(900)],
    "ja": [chr(0x3041 + i) for i in range(83)] + [chr(0x30A1 + i) for i in range(83)],
    "ru": [chr(0x430 + i) for i in range(32)], "el": [chr(0x3B1 + i) for i in range(24)],
    "en": [chr(0x61 + i) for i in range(26)]}


def _script_texts(n, seed, size=600):
    """Texts of made words in each script, from one word list a language."""
    out = {}
    for lang, letters in SCRIPTS.items():
        rng = np.random.default_rng(len(lang) + ord(lang[0]))
        words = ["".join(rng.choice(letters, rng.integers(2, 6))) for _ in range(400)]
        rng = np.random.default_rng(seed)
        out[lang] = [" ".join(rng.choice(words, size // 4)) for _ in range(n)]
    return out


def test_letters_of_every_script_are_told_apart():
    """More letters than the dense tables have columns: none is dropped."""
    known = {k: "\n".join(v) for k, v in _script_texts(8, 1).items()}
    parser = langid.Parser(known)
    assert len({c for v in known.values() for c in v}) > 10 * langid.LETTERS
    some = [t for v in _script_texts(3, 2).values() for t in v]
    phrases, _ = parser.counts(some)
    for text, got in zip(some, phrases.tolist()):
        for lang, n in zip(parser.langs, got):
            reference, want = " " + langid.normalize(known[lang]) + " ", 0
            for a in range(0, len(text), langid.STRETCH):
                s, i = langid.normalize(text[a:a + langid.STRETCH]), 0
                while i < len(s):
                    j = i + 1
                    while j <= len(s) and s[i:j] in reference:
                        j += 1
                    want, i = want + 1, max(j - 1, i + 1)
            assert n == want
    for lang, texts in _script_texts(3, 3).items():
        assert [got for got, _ in parser.judge(texts)] == [lang] * 3


def test_language_of_han_kana_and_cyrillic(make_docs):
    rows = [(i, t, lang) for i, (lang, t) in enumerate(
        (lang, t) for lang, v in _script_texts(12, 1).items() for t in v)]
    new = [(900 + i, t, lang) for i, (lang, t) in enumerate(
        (lang, t) for lang, v in _script_texts(4, 5, 80).items() for t in v)]
    got = langid.identify(make_docs(new), langid.fit(make_docs(rows)), keep=("lang",)).collect()
    assert len(got) == len(new) and all(r["lang_pred"] == r["lang"] for r in got)


def test_every_labelled_language_is_learned(make_docs):
    """More labels than 50, the rarest only on a long text; no label without a letter."""
    rng = np.random.default_rng(7)
    words = {f"l{k:02}": ["".join(rng.choice(SCRIPTS["en"], 5)) for _ in range(40)]
             for k in range(60)}
    rows = [(i, " ".join(rng.choice(words[lang], 60)), lang)
            for i, lang in enumerate([*words] * 2) if lang != "l59"]
    rows += [(500, "1234 " * 2_000 + " ".join(rng.choice(words["l59"], 3_000)), "l59"),
             (501, "42 %", "digits"), (502, None, "none")]
    known = langid.fit(make_docs(rows))
    assert set(known) == set(words) and len(known["l59"]) > 3_000
    new = [(900 + k, " ".join(rng.choice(words[lang], 40)), lang) for k, lang in enumerate(words)]
    got = langid.identify(make_docs(new), known, keep=("lang",)).collect()
    assert all(r["lang_pred"] == r["lang"] for r in got)


def test_narrower_tables_give_the_same_phrases():
    known = {k: "\n".join(v) for k, v in _script_texts(8, 1).items()}
    some = [t for v in _script_texts(2, 2).values() for t in v]
    wide = langid.Parser(known).counts(some)[0]
    kept, langid.TABLE_SIZE = langid.TABLE_SIZE, 100_000
    try:
        assert (langid.Parser(known).counts(some)[0] == wide).all()
    finally:
        langid.TABLE_SIZE = kept
