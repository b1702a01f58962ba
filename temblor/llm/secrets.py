"""Secret scans by a linear-chain conditional random field.

Texts are cut into letter-digit runs and single other characters; each token is
tagged as the begin of a secret, inside one, or outside, from its shape, the
tokens around it and features of its file, and the best tag sequence is found
by Viterbi. The field is trained here, on the base patterns' spans in a bounded
sample of documents, by gradient steps on the conditional log-likelihood
(batched forward-backward). So that shape and surroundings count and not only
the names of the base patterns, each window around a span is also learned in
altered copies: another value under the name, the name dropped, the sign
dropped, the value alone; ordinary words of the copies become look-alikes that
are no secrets (identifiers, versions, times, UUIDs).

Most words cannot be part of a secret in any neutral surrounding: their margin
for "outside" exceeds all that neighbours and transitions could add. Such words
are certain, so they cut the chain, and Viterbi runs only over the stretches
around the others. The result is that of decoding the whole text.

Base patterns are kept beside the field's spans; a span of the field that
touches a base span is left out.

Defined results: null and empty texts hold no spans; without any base span in
the documents, the field adds none; texts of any length are scanned whole;
repeated rows are scanned as often as they
occur; other columns are ignored.
"""

from __future__ import annotations

import random
import re
import string
import zlib
from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, forget, hash_sample, release, table, text_of

KINDS = ["assign", "access", "hex", "crf"]

# Base patterns (fixed values): letters of the names in either case, ASCII only.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
# The same for Spark: ASSIGN's values are its second group.
ASSIGN_SQL = "(?i)" + ASSIGN.pattern
OTHERS_SQL = f"{ACCESS.pattern}|{HEX.pattern}"

# The training sample's bound: documents with and without a base span, and
# characters of each; characters on either side of a long document's spans.
WORDS_KEPT = 100_000
SAMPLE_DOCS = 200
SAMPLE_CHARS = 8_000
AROUND = 400
STEPS = 120
PAD = 40

B, I, O = 0, 1, 2
HINTS = {"password", "passwd", "pwd", "secret", "token", "apikey", "api", "key", "auth",
         "bearer", "credential", "credentials", "passphrase"}
MARKS = "=:\"'._-/+@"
NEUTRAL = {"word", "punct", "edge", "none", "True", "False"}
FINE = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+|[^\s0-9A-Za-z\x80-\U0010ffff]")
WORD = re.compile(r"\S+")
SPACE = re.compile(r"\s")
RUN = re.compile("[a-z]{5}|[A-Z]{5}")


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) of the base patterns, in order."""
    out = []
    low = text.lower()
    if any(n in low for n in NAMES):
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text)
                if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out)


def has_base_span(text: Column) -> Column:
    """True where ``base_spans`` finds any."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN_SQL), F.lit(2))
    return text.rlike(OTHERS_SQL) | (text.rlike(ASSIGN_SQL) & F.exists(
        values, lambda v: F.length(v) >= 6))


SIZES = (3, 7, 11, 15, 19, 23, 31, 39)


def shape(token: str) -> tuple[str, str, str]:
    """(length class, kinds of characters, changes between letters and digits,
    whether all could be hexadecimal and whether letters run on as in words)."""
    if len(token) == 1 and not token.isalnum():
        return "0", token if token in MARKS else "p", "0"
    size = str(bisect_left(SIZES, len(token)))
    if token.isalpha():
        return size, "a" if token.islower() else "A" if token.isupper() else "aA", "0"
    kinds = "".join(k for k, f in (("a", str.islower), ("A", str.isupper), ("9", str.isdigit))
                    if any(map(f, token)))
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:]))
    return size, kinds, (f"{min(turns, 4)}{'h' * all(c in '0123456789abcdef' for c in token)}"
                         f"{'w' * bool(RUN.search(token))}")


def token_class(token: str) -> str:
    if token.lower() in HINTS:
        return "hint"
    if token[0].isalnum() or token[0] >= "\x80":
        return "digits" if token.isdigit() else "mixed" if any(map(str.isdigit, token)) \
            else "word"
    return token if token in "=:\"'" else "punct"


def contexts(tokens: list[str]) -> list[str]:
    """What is being assigned at each token: to a hinted name, to another, or nothing."""
    out, state, hinted = [], "none", False
    for t in tokens:
        out.append(state)
        kind = token_class(t)
        if kind == "hint":
            hinted, state = True, "none"
        elif kind in "=:":
            state = "hinted" if hinted else "named"
        elif kind in "\"'" or t in "_-":
            pass
        else:
            state, hinted = "none", False
    return out


def surroundings(tokens: list[str], hint: bool) -> list[tuple]:
    """(shape, what is assigned, classes of the two tokens before and the one
    after, file feature) of each token."""
    kinds = ["edge", "edge", *map(token_class, tokens), "edge"]
    return [(shape(t), c, kinds[i + 1], kinds[i], kinds[i + 3], hint)
            for i, (t, c) in enumerate(zip(tokens, contexts(tokens)))]


def features(key: tuple) -> list[str]:
    """Feature names of a token with these surroundings."""
    (size, kinds, turns), c, p, q, n, hint = key
    return ["b:", f"l:{size}", f"k:{kinds}", f"t:{turns}", f"x:{c}:{size}{kinds}{turns}",
            f"p:{p}", f"q:{q}", f"n:{n}", f"c:{c}", f"f:{hint}"]


def file_hint(text: str) -> bool:
    low = text.lower()
    return any(n in low for n in NAMES)


class Field:
    """Weights by feature name (rows of B, I, O) and transitions."""

    def __init__(self, weights: dict[str, list[float]], moves: list[list[float]]):
        self.weights, self.moves = weights, moves
        # The most that neutral surroundings can add to a tag other than outside.
        neutral = [max([max(w[B], w[I]) - w[O] for k, w in weights.items()
                        if k[:2] == g and k[2:] in NEUTRAL] or [0.0])
                   for g in ("p:", "q:", "n:", "c:", "f:")]
        swing = max((moves[a][y] + moves[y][b] - moves[a][O] - moves[O][b if b != I else B]
                     for a in (B, I, O) for y in (B, I) for b in (B, I, O)), default=0.0)
        self.need = sum(neutral) + max(swing, 0.0)
        self.words: dict[str, bool] = {}
        self.shapes: dict[tuple, bool] = {}
        self.emissions: dict[tuple, tuple] = {}

    def outside(self, token: str) -> bool:
        """True if ``token`` is outside in every neutral surrounding."""
        if token_class(token) not in ("word", "punct"):
            return False
        s = shape(token)
        known = self.shapes.get(s)
        if known is None:
            own = self._sum(features((s, "none", "", "", "", ""))[:5])
            known = self.shapes[s] = own[O] - max(own[B], own[I]) > self.need
        return known

    def certain(self, word: str) -> bool:
        known = self.words.get(word)
        if known is None:
            if len(self.words) > WORDS_KEPT:
                self.words.clear()
            known = self.words[word] = all(map(self.outside, FINE.findall(word)))
        return known

    def _sum(self, names: list[str]) -> tuple:
        ws = [self.weights.get(n, (0.0, 0.0, 0.0)) for n in names]
        return tuple(sum(w[y] for w in ws) for y in (B, I, O))

    def emission(self, key: tuple) -> tuple:
        known = self.emissions.get(key)
        if known is None:
            if len(self.emissions) > WORDS_KEPT:
                self.emissions.clear()
            known = self.emissions[key] = self._sum(features(key))
        return known

    def decode(self, tokens: list[str], hint: bool) -> list[int]:
        """Viterbi over one stretch between tokens that are outside."""
        m = self.moves
        score, back = (-1e9, -1e9, 0.0), []
        for key in surroundings(tokens, hint):
            emit = self.emission(key)
            step = [max((score[a] + m[a][y], a) for a in (B, I, O)) for y in (B, I, O)]
            back.append([a for _, a in step])
            score = [v + e for (v, _), e in zip(step, emit)]
        y = max((score[a] + m[a][O], a) for a in (B, I, O))[1]
        tags = []
        for came in reversed(back):
            tags.append(y)
            y = came[y]
        return tags[::-1]

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Spans of secrets in a whole text."""
        doubt = [i for i, w in enumerate(text.split()) if not self.certain(w)]
        if not doubt:
            return []
        hint, words, out = file_hint(text), list(WORD.finditer(text)), []
        at, stretches = 0, []
        for i in doubt:  # a word may change what the next ones need
            a, b = max(0, i - 2), min(len(words), i + 5)
            if stretches and a <= stretches[-1][1]:
                stretches[-1][1] = b
            else:
                stretches.append([a, b])
        for a, b in stretches:
            at = words[a].start()
            found = list(FINE.finditer(text, at, words[b - 1].end()))
            tags = self.decode([m[0] for m in found], hint)
            begin = None
            for m, y in zip([*found, None], [*tags, O]):
                if begin is not None and y != I:
                    out.append((begin, end))
                    begin = None
                if y == B:
                    begin = m.start()
                if y != O:
                    end = m.end()
        return out


def pieces(text: str, chars: int = SAMPLE_CHARS, around: int = AROUND) -> list[str]:
    """A text of at most ``chars`` characters; of a longer one, what stands
    around its first base spans, or its start if it has none, up to as many.
    No piece begins or ends within a word or a base span shorter than that."""
    if len(text) <= chars:
        return [text]
    spans: list[list[int]] = []  # spans that overlap are one
    for s, _, e, _ in base_spans(text):
        if spans and s < spans[-1][1]:
            spans[-1][1] = max(e, spans[-1][1])
        else:
            spans.append([s, e])
    if not spans:
        return [text[:chars].rpartition(" ")[0] or text[:chars]]
    out, room, done = [], chars, 0
    for i, (s, e) in enumerate(spans):
        if e <= done:  # the piece before holds it
            continue
        a = max(s - around, done)
        if i:
            a = max(a, spans[i - 1][1])
        if a and not text[a - 1].isspace():  # the first word that begins after a
            gap = SPACE.search(text, a, s)
            a = gap.end() if gap else s
        b = min(e + around, len(text))
        for x, y in spans[i + 1:i + 1 + around]:
            if x >= b:
                break
            if y > b:
                b = x
        if b < len(text) and b > e:
            b = next((k for k in range(b, e, -1) if text[k - 1].isspace()), e)
        b = min(b, a + chars)
        if out and b - a > room:
            break
        out.append(text[a:b])
        room, done = room - (b - a), b
    return out


def training_windows(text: str, hint: bool | None = None,
                     ) -> list[tuple[list[str], list[int], bool]]:
    """Token windows with the tags of the base spans: around each span, and the
    start of the text. ``hint`` is the file feature, if the text is a piece."""
    tokens = list(FINE.finditer(text))
    spans = [(value, end) for _, _, end, value in base_spans(text)]
    tags = []
    for m in tokens:
        inside = [s for s in spans if s[0] <= m.start() < s[1]]
        tags.append(O if not inside else I if tags and tags[-1] != O and all(
            s[0] != m.start() for s in inside) else B)
    centres = [i for i, y in enumerate(tags) if y == B] + [PAD // 2] + list(
        range(PAD, len(tokens), 400))
    out, hint = [], file_hint(text) if hint is None else hint
    for c in dict.fromkeys(centres):
        a = max(0, c - PAD // 2)
        some = tokens[a:a + PAD]
        if some:
            out.append(([m[0] for m in some], tags[a:a + PAD], hint))
    return out


ALPHABETS = (string.ascii_letters + string.digits, string.ascii_lowercase + string.digits,
             string.ascii_uppercase + string.digits)
# Manners of altered copies: lengths of the new value, whether the name stays, whether the sign.
MANNERS = [(6, 24, True, True), (20, 44, False, True), (16, 44, True, False),
           (20, 44, False, False)]
LOOK_ALIKES = 5


def _value(rng: random.Random, low: int, high: int) -> list[str]:
    """Tokens of a random value; a long one may have parts."""
    n, alphabet = rng.randint(low, high), rng.choice(ALPHABETS)
    at, mark = n, ""
    if n >= 20 and rng.random() < 0.4:
        at, mark = rng.randint(8, n - 8), rng.choice("-_./+")
    while True:
        v = "".join(rng.choices(alphabet, k=n))
        parts = [v[:at], v[at:]] if mark else [v]
        if all(sum(a.isdigit() != b.isdigit() for a, b in zip(p, p[1:])) > 1 for p in parts):
            return [parts[0], mark, parts[1]] if mark else parts


def _look_alike(rng: random.Random, word: str, words: list[str]) -> list[str]:
    """Tokens with letters and digits that are no secret."""
    number = str(rng.randint(0, 9999))
    case = rng.choice([str.lower, str.title, str.upper])
    glued = "".join(case(w) + rng.choice(["", number[:1], number[:2]])
                    for w in rng.choices(words, k=rng.randint(1, 3)))
    two = [f"{rng.randint(0, 59):02d}" for _ in range(5)]
    hexes = ["".join(rng.choices("0123456789abcdef", k=k)) for k in (8, 4, 4, 4, 12)]
    return rng.choice([
        [word + number], [number[:2] + word], [glued + number], [number[:2] + glued],
        [case("".join(rng.choices(words, k=rng.randint(1, 4))))],
        ["v" + number[:1], ".", number[:2], ".", two[0]], [word, "_", word + number[:2]],
        ["20" + two[0], "-", two[1], "-", two[2] + "T" + two[3], ":", two[4], ":", "00Z"],
        [hexes[0]], [t for h in hexes for t in (h, "-")][:-1]])


def altered(tokens: list[str], tags: list[int], manner: int) -> tuple[list[str], list[int], bool]:
    """A copy of a window whose spans have other values and, by ``manner``, no
    name or no sign before them, and in which some words are look-alikes."""
    low, high, named, signed = MANNERS[manner]
    rng = random.Random(zlib.crc32("\x00".join([str(manner), *tokens]).encode()))
    plain = [t for t, y in zip(tokens, tags) if y == O and token_class(t) == "word"
             and len(t) > 4] or ["item"]
    out: list[str] = []
    marks: list[int] = []
    states = contexts(tokens)
    free = [i for i, t in enumerate(tokens) if tags[i] == O and states[i] == "none"
            and token_class(t) == "word" and (not i or token_class(tokens[i - 1]) != "hint")]
    changed = set(rng.sample(free, min(LOOK_ALIKES, len(free))))
    for i, (t, y) in enumerate(zip(tokens, tags)):
        if y == B:
            lead = len(out)  # where name, sign and quotes before the value begin
            while lead and marks[lead - 1] == O and (
                    token_class(out[lead - 1]) == "hint" or out[lead - 1] in "=:\"'_-"):
                lead -= 1
            before = [x for x in out[lead:] if signed or x not in "=:\"'"]
            if not named:
                before = [x for x in before if token_class(x) != "hint" and x not in "_-"]
                before[:0] = [rng.choice(plain)] * signed
            value = _value(rng, low, high)
            out[lead:] = [*before, *value]
            marks[lead:] = [*[O] * len(before), B, *[I] * (len(value) - 1)]
        elif y == O:
            if i and tags[i - 1] != O and t in "\"'" and not signed:
                continue
            new = _look_alike(rng, t, plain) if i in changed else [t]
            out += new
            marks += [O] * len(new)
    first = max(0, marks.index(B) - PAD // 2) if B in marks else 0
    return out[first:first + PAD], marks[first:first + PAD], named


def with_altered(windows: list[tuple]) -> list[tuple]:
    """The windows, and altered copies of those that hold a span."""
    return [*windows, *[altered(tokens, tags, k) for tokens, tags, _ in windows if B in tags
                        for k in range(len(MANNERS))]]


def train(windows, steps: int = STEPS, l2: float = 1e-7, rate: float = 0.15) -> Field | None:
    """Conditional log-likelihood by batched forward-backward and Adam."""
    import numpy as np
    if not any(y != O for _, tags, _ in windows for y in tags):
        return None
    names: dict[str, int] = {}
    rows = [[[names.setdefault(f, len(names)) for f in features(k)] for k in surroundings(t, h)]
            for t, _, h in windows]
    n, per = len(rows), len(rows[0][0])
    ids = np.full((n, PAD, per), len(names))
    gold = np.full((n, PAD), O)
    mask = np.zeros((n, PAD))
    for i, (r, (_, tags, _)) in enumerate(zip(rows, windows)):
        ids[i, :len(r)], gold[i, :len(r)], mask[i, :len(r)] = r, tags, 1.0
    w, m = np.zeros((len(names) + 1, 3)), np.zeros((3, 3))
    bar = np.zeros((3, 3))
    bar[O, I] = -1e4  # a secret cannot go on without a begin
    one = np.eye(3)[gold] * mask[:, :, None]
    before = np.concatenate([np.full((n, 1), O), gold[:, :-1]], 1)
    real = np.einsum("nta,ntb->ab", np.eye(3)[before] * mask[:, :, None], one)
    first, second = [np.zeros_like(w), np.zeros_like(m)], [np.zeros_like(w), np.zeros_like(m)]

    def lse(x, axis):
        top = x.max(axis)
        return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis))

    for k in range(1, steps + 1):
        emit = w[ids].sum(2) * mask[:, :, None]
        move = m + bar
        alpha = np.zeros((n, PAD, 3))
        score = np.tile([-1e9, -1e9, 0.0], (n, 1))
        prev = np.zeros((n, PAD, 3))
        for t in range(PAD):
            prev[:, t] = score
            new = lse(score[:, :, None] + move, 1) + emit[:, t]
            score = alpha[:, t] = np.where(mask[:, t, None] > 0, new, score)
        total = lse(score, 1)
        beta = np.zeros((n, 3))
        want, pairs = np.zeros((n, PAD, 3)), np.zeros((3, 3))
        for t in range(PAD - 1, -1, -1):
            on = mask[:, t, None]
            joint = np.exp(prev[:, t, :, None] + move + (emit[:, t] + beta)[:, None, :]
                           - total[:, None, None]) * on[:, :, None]
            pairs += joint.sum(0)
            want[:, t] = joint.sum(1)
            beta = np.where(on > 0, lse(move + (emit[:, t] + beta)[:, None, :], 2), beta)
        slope = np.zeros_like(w)
        diff = (one - want).reshape(-1, 3)
        for y in range(3):
            slope[:, y] = np.bincount(ids.reshape(-1), np.repeat(diff[:, y], per), len(w))
        for j, (x, g) in enumerate(((w, slope / n - l2 * w), (m, (real - pairs) / n - l2 * m))):
            first[j] = 0.9 * first[j] + 0.1 * g
            second[j] = 0.99 * second[j] + 0.01 * g * g
            x += rate * (first[j] / (1 - 0.9 ** k)) / (
                np.sqrt(second[j] / (1 - 0.99 ** k)) + 1e-8)
    w[-1] = 0
    return Field({f: w[i].tolist() for f, i in names.items()}, (m + bar).tolist())


def fit(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
        sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Field | None:
    """Train on the base spans of at most ``sample_docs`` documents that hold a
    base span and as many that do not; of a document longer than
    ``sample_chars``, on pieces of that length in all."""
    bounded_batches(docs.sparkSession)
    text = F.col(text_col)
    some = docs.select(F.col(id_col).alias("id"), text.alias("text")).where(text.isNotNull())
    marked = some.withColumn("spans", has_base_span(F.col("text")))

    def cut(rows):
        rows = rows.select("__g", "__h", "id", "text")
        schema = T.StructType([f for f in rows.schema if f.name != "text"]).add(
            "text", T.ArrayType(T.StringType())).add("hint", T.BooleanType())

        def cut_rows(batches):
            import pyarrow as pa
            for b in batches:
                texts = b.column(3).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:3],
                     pa.array([pieces(t, sample_chars) for t in texts], pa.list_(pa.string())),
                     pa.array([file_hint(t) for t in texts], pa.bool_())],
                    names=[*b.schema.names[:3], "text", "hint"])

        return rows.mapInArrow(cut_rows, schema)

    picked = dict.fromkeys(
        (t, r["hint"]) for r in hash_sample(marked, sample_docs, "spans", "text", "id",
                                            cut=cut).collect() for t in r["text"])
    return train(with_altered([w for t, hint in picked for w in training_windows(t, hint)]))


def scan(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text",
         keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, ``spans``: array of (kind, start, end) in code points, end
    exclusive, by start and kind; and the columns named in ``keep``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(id_col).alias("__id"), text_of(text_col).alias("__text"),
                       *[F.col(c) for c in keep])
    span = T.StructType().add("kind", T.StringType()).add("start", T.LongType()).add(
        "end", T.LongType())
    schema = T.StructType([f for f in rows.schema if f.name != "__text"]).add(
        "spans", T.ArrayType(span))
    model = (field.weights, field.moves) if field else None

    def scan_rows(batches):
        import pyarrow as pa
        forget()
        crf = Field(*model) if model else None
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                   ("end", pa.int64())]))
        for b in batches:
            out = []
            for text in b.column(1).to_pylist():
                found = [(s, k, e) for s, k, e, _ in base_spans(text)]
                for s, e in crf.spans(text) if crf else ():
                    if not any(s < y and x < e for x, _, y in found):
                        found.append((s, 3, e))
                out.append([{"kind": KINDS[k], "start": s, "end": e}
                            for s, k, e in sorted(found)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *b.columns[2:], pa.array(out, span)],
                names=["__id", *b.schema.names[2:], "spans"])
        del crf
        release()

    return rows.mapInArrow(scan_rows, schema).withColumnRenamed("__id", id_col)


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span (sorted by start; they may overlap) replaced."""
    length = F.char_length(text).cast("long")

    def upto(state, a, b):
        return F.concat(state["out"], F.substring(text, (a + 1).cast("int"),
                                                  F.greatest(b - a, F.lit(0)).cast("int")))

    def step(state, s):
        return F.struct(
            F.when(s["start"] >= state["at"], F.concat(upto(state, state["at"], s["start"]),
                                                       F.lit(mark)))
            .otherwise(state["out"]).alias("out"),
            F.greatest(state["at"], s["end"]).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    return F.when(F.size(spans) > 0, F.aggregate(
        spans, start, step, lambda st: upto(st, st["at"], length))).otherwise(text)


def op5_secret_scan(spark, sf_dir):
    """Base and field spans of every document."""
    docs = table(spark, sf_dir, "documents")
    found = scan(docs, fit(docs))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
                        F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
