"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds every substring of some labelled
reference text. A text is parsed against it greedily into the longest phrases
the reference holds (a letter unknown to it is a phrase of its own); a text in
the reference's language needs fewer. The language with the fewest phrases,
normalised by log2 of the reference length and by the text's length, wins.

Texts are read in stretches of ``STRETCH`` characters, each parsed from its
start, so a very long text is as cheap as many short ones. All stretches of a
batch, in all languages, step through the transitions together: dense tables
for each language's most frequent letters, a sorted list for its other ones.

Parsed are lower-cased letters, and one blank for each run of anything else.
Every letter of a reference is told apart, in whatever script it is.

Defined results: null texts and texts without a letter are ``und`` with score
0, as is everything where nothing is labelled; equal counts go to the smaller
language name; repeated rows are judged as often as they occur; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, crc32_mod, held, small, table

UNKNOWN = "und"
STRETCH = 1024
# The training sample's bound, for each language: rows, characters of a row,
# and characters of the reference made from them.
SAMPLE_ROWS = 40
SAMPLE_CHARS = 4_000
REFERENCE_CHARS = 30_000
# Letters of a language with a column in its dense table, and numbers in the
# tables of all languages (beyond which each has fewer columns); its other
# letters are looked up in the sorted list. The results do not depend on them.
LETTERS = 62
TABLE_SIZE = 1 << 26
SLICE = 1 << 22        # characters parsed together


def normalize(text: str) -> str:
    """Lower-cased letters, one blank for each run of other characters."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings: state 0 is dead (and
    has none), state 1 the root."""
    nxt: list[dict[int, int]] = [{}, {}]
    link, length = [0, 0], [0, 0]
    last = 1
    for c in codes:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(1)
        p = last
        while p and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[cur] = clone
                while p and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
        last = cur
    return nxt


class Parser:
    """Phrase counts of texts against each language's reference."""

    def __init__(self, references: dict[str, str]):
        from collections import Counter

        import numpy as np
        self.np = np
        self.langs = sorted(references)
        clean = {k: " " + normalize(v) + " " for k, v in references.items()}
        # One code for each letter of any reference; 0 is the blank, the last
        # one any other letter.
        letters = sorted({c for t in clean.values() for c in t} - {" "})
        code = {c: i for i, c in enumerate([" ", *letters])}
        self.other = len(code)
        codes = np.zeros(0x110000, np.int32)
        codes[[i for i in range(0x110000) if chr(i).isalpha()]] = self.other
        for c, i in code.items():
            codes[ord(c)] = i
        self.codes = codes
        # A state is where its row begins in the table of all languages, with a
        # column for the blank and each of the most frequent letters; column 0
        # (every entry 0) is for letters without one. The others' transitions
        # are in ``rare_to``, by state and code in ``rare_keys``.
        self.columns = np.zeros((len(self.langs), self.other + 1), np.uint8)
        self.rare = np.zeros((len(self.langs), self.other + 1), bool)
        self.first = np.zeros((len(self.langs), self.other + 1), np.int64)
        tables, keys, to, at = [np.zeros(LETTERS + 2, np.int32)], [], [], LETTERS + 2
        states = 2 * sum(map(len, clean.values()))  # at most
        dense = min(LETTERS, max(0, TABLE_SIZE // max(1, states) - 2))
        for k, lang in enumerate(self.langs):
            text = [code[c] for c in clean[lang]]
            seen = [c for c, _ in sorted(Counter(x for x in text if x).items(),
                                         key=lambda x: (-x[1], x[0]))]
            column = {c: i + 1 for i, c in enumerate([0, *seen[:dense]])}
            self.columns[k, list(column)] = list(column.values())
            self.rare[k, seen[dense:]] = True
            moves, width = suffix_automaton(text), len(column) + 1
            small = at + len(moves) * width < 1 << 31
            table = np.zeros((len(moves), width), np.int32 if small else np.int64)
            for i, row in enumerate(moves):
                for c, j in row.items():
                    if c in column:
                        table[i, column[c]] = at + j * width
                    else:
                        keys.append((at + i * width) * (self.other + 1) + c)
                        to.append(at + j * width)
            for c, j in moves[1].items():
                self.first[k, c] = at + j * width
            tables.append(table.reshape(-1))
            at += table.size
        self.table = np.concatenate(tables)
        self.first = self.first.astype(self.table.dtype)
        order = np.argsort(np.array(keys, np.int64))
        self.rare_keys = np.array(keys, np.int64)[order]
        self.rare_to = np.array(to, self.table.dtype)[order]
        self.rare_langs = np.flatnonzero(self.rare.any(1))
        self.scale = np.array([np.log2(len(clean[k]) + 1) for k in self.langs])

    def _stretch_codes(self, stretch: str):
        np = self.np
        low = stretch.lower()
        got = self.codes[np.frombuffer(low.encode("utf-32-le"), np.uint32)]
        blank = got == 0
        drop = blank & np.concatenate([[True], blank[:-1]])
        got = got[~drop]
        return got[:-1] if len(got) and got[-1] == 0 else got

    def counts(self, texts: list[str]):
        """(phrases by text and language, parsed characters by text)."""
        np = self.np
        n, k = len(texts), len(self.langs)
        phrases, chars = np.zeros((n, k), np.int64), np.zeros(n, np.int64)
        if not k:
            return phrases, chars
        held, owner, size = [], [], 0

        def flush():
            if held:
                phrases_of, lens = self._parse(held)
                np.add.at(phrases, owner, phrases_of)
                np.add.at(chars, owner, lens)
                held.clear()
                owner.clear()

        for i, text in enumerate(texts):
            for a in range(0, len(text), STRETCH):
                got = self._stretch_codes(text[a:a + STRETCH])
                if len(got):
                    held.append(got)
                    owner.append(i)
                    size += len(got)
                    if size > SLICE or len(held) * k > SLICE:
                        flush()
                        size = 0
        flush()
        return phrases, chars

    def _parse(self, held):
        np = self.np
        n, k = len(held), len(self.langs)
        lens = np.array(list(map(len, held)))
        order = np.argsort(-lens, kind="stable")
        longest = int(lens.max())
        kind = np.uint8 if self.other < 1 << 8 else np.int32
        grid = np.zeros((n, longest), kind)
        for row, i in enumerate(order):
            grid[row, :lens[i]] = held[i]
        grid = np.ascontiguousarray(grid.T)
        active = np.searchsorted(-lens[order], -np.arange(longest), side="left")
        state = np.zeros((k, n), self.table.dtype)
        count = np.zeros((k, n), np.int32)
        for t in range(longest):
            m = int(active[t])
            c = grid[t, :m]
            nxt = self.table.take(state[:, :m] + self.columns[:, c])
            for i in self.rare_langs:
                self._rare_moves(state[i], c, self.rare[i], nxt[i])
            new = nxt == 0
            count[:, :m] += new
            state[:, :m] = np.where(new, self.first[:, c], nxt)
        out = np.zeros((n, k), np.int64)
        out[order] = count.T
        return out, lens

    def _rare_moves(self, state, c, rare, nxt):
        """Fill in the transitions by letters without a column."""
        np = self.np
        on = np.flatnonzero(rare[c])
        if len(on):
            key = state[on].astype(np.int64) * (self.other + 1) + c[on]
            at = np.minimum(np.searchsorted(self.rare_keys, key), len(self.rare_keys) - 1)
            nxt[on] = np.where(self.rare_keys[at] == key, self.rare_to[at], 0)

    def judge(self, texts: list[str | None]) -> list[tuple[str, float]]:
        np = self.np
        phrases, chars = self.counts([t or "" for t in texts])
        out = []
        letters = [bool(t) and any(map(str.isalpha, t)) for t in texts]
        cost = phrases * self.scale / np.maximum(chars, 1)[:, None]
        for has, row in zip(letters, cost.tolist()):
            if not has or not row:
                out.append((UNKNOWN, 0.0))
                continue
            best = min(range(len(row)), key=lambda i: (row[i], self.langs[i]))
            second = min((v for i, v in enumerate(row) if i != best), default=None)
            sure = 1.0 if second is None else (1 - row[best] / second if second else 0.0)
            out.append((self.langs[best], sure))
        return out


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
        id_col: str = "doc_id",
        sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """Reference text by language, for every label that stands on a text with a
    letter: from at most ``sample_rows`` such rows of each (in the order of a
    hash), of a longer text its first ``sample_chars`` characters of letters
    and blanks between them."""
    rows = (labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                            F.col(lang_col).cast("string").alias("lang"))
            .where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")))
    texts: dict[str, list[str]] = {}
    for r in label_sample(rows, sample_rows, sample_chars).collect():
        texts.setdefault(r["lang"], []).append(r["text"])
    return references(agreeing(texts, REFERENCE_CHARS), REFERENCE_CHARS)


def label_sample(rows: DataFrame, n: int, chars: int) -> DataFrame:
    """``lang`` and ``text`` (cut to ``chars``) of at most ``n`` rows of each
    label, as ``hash_sample`` takes them, but for any number of labels: their
    counts are joined, and only cut texts of about four times ``n`` rows a
    label are sent."""
    counts = rows.groupBy(F.col("lang").alias("__lang")).agg(F.count(F.lit(1)).alias("__count"))
    share = F.xxhash64("text", "id").bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)
    letters = F.substring(F.ltrim(F.regexp_replace("text", r"\P{L}+", " ")), 1, chars)
    order = Window.partitionBy("lang").orderBy("__h", "text", "id")
    return (rows.withColumn("__h", share).join(small(counts), F.col("lang") == F.col("__lang"))
            .where(F.col("__h") * F.col("__count") < 4 * n)
            .select("lang", "__h", "id", F.when(F.char_length("text") <= chars, F.col("text"))
                    .otherwise(letters).alias("text"))
            .withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= n)
            .orderBy("lang", "__n").select("lang", "text"))


def references(texts: dict[str, list[str]], room: int) -> dict[str, str]:
    return {lang: "\n".join(dict.fromkeys(parts))[:room] for lang, parts in texts.items() if parts}


def agreeing(texts: dict[str, list[str]], room: int) -> dict[str, list[str]]:
    """Leave out rows whose label the other half of the sample contradicts: a
    single mislabelled text would win every copy of itself."""
    halves = [{lang: dict.fromkeys(parts[i::2]) for lang, parts in texts.items()} for i in (0, 1)]
    kept: dict[str, list[str]] = {lang: [] for lang in texts}
    for mine, other in (halves, halves[::-1]):
        known = references({k: [t for t in v if t not in {x for p in mine.values() for x in p}]
                            for k, v in other.items()}, room)
        rows = [(lang, t) for lang, parts in mine.items() for t in parts]
        judged = Parser(known).judge([t for _, t in rows]) if known and rows else []
        kept_here = [(lang, t) for (lang, t), (got, _) in zip(rows, judged)
                     if got == lang or lang not in known]
        for lang, t in kept_here if judged else rows:
            kept[lang].append(t)
    return {lang: parts or texts[lang] for lang, parts in kept.items()}


def identify(docs: DataFrame, known: dict[str, str], id_col: str = "doc_id",
             text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the columns in ``keep``, ``lang_pred``, ``score``: one minus
    the winner's normalised phrases over the runner-up's."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"),
                       *[F.col(c) for c in keep])
    schema = T.StructType([f for f in rows.schema if f.name != "__text"])
    schema = schema.add("lang_pred", T.StringType()).add("score", T.DoubleType())

    def judge_rows(batches):
        import pyarrow as pa
        parser = held(("langid", hash(tuple(sorted(known.items())))), lambda: Parser(known))
        for b in batches:
            got = parser.judge(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *b.columns[2:], pa.array([x for x, _ in got], pa.string()),
                 pa.array([x for _, x in got], pa.float64())],
                names=["__id", *b.schema.names[2:], "lang_pred", "score"])

    return rows.mapInArrow(judge_rows, schema).withColumnRenamed("__id", id_col)


def op7_language(spark, sf_dir):
    """Language of every document; a quarter of the ids is held out of training."""
    docs = table(spark, sf_dir, "documents")
    held_out = crc32_mod("doc_id", 4) == 2
    known = fit(docs.where(~held_out))
    return (identify(docs, known)
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score"))
