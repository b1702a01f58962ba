"""Packing by power-of-two decomposition.

A document's tokens are cut into pieces whose lengths are the powers of two of
its token count (as many pieces of the largest length as fit, then one for
each remaining binary digit, longest first). Every piece is a sequence of its
own: no sequence crosses documents and none needs padding. Sequences of equal
length share a bucket, and sequence ids of one bucket lie in one range, so
batches of equal length are ranges of ids.

The word vocabulary's ids of a text are the ids of its blank-separated words,
one after the other (white space is dropped and no pre-token crosses it), so
each worker keeps a bounded dictionary of words it has met.

Defined results: a null or empty text is the end id alone; strings of added
tokens in a text are those tokens, as in the library's own call; repeated rows are packed as often as they
occur; the id column may be null; other columns are ignored.
"""

from __future__ import annotations

import json
from array import array

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, bounded_batches, held, table, text_of

MAX_LENGTH = 4096
END_ID = 2
WORDS_KEPT = 400_000

# Contraction endings are pre-tokens of their own (fixed values).
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


class WordIds(dict):
    """Ids of a blank-free word as little-endian bytes.

    Keeps the words met lately, in two generations of at most ``limit`` each.
    Words below U+0250 are cut into pre-tokens here and looked up in the merge
    model; any other word, and one that holds an added token's string, takes the
    library's whole path."""

    def __init__(self, spec: str, limit: int = WORDS_KEPT):
        import regex
        from tokenizers import Tokenizer
        super().__init__()
        self.limit, self.older = limit, {}
        self.whole = Tokenizer.from_str(spec)
        self.model = self.whole.model
        parts = json.loads(spec)
        added = parts.get("added_tokens") or []
        if any(set(t["content"]) & set(SPACES) or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("an added token reaches over blanks: words are not apart")
        self.added = regex.compile("|".join(regex.escape(t["content"]) for t in added) or r"(?!)")
        kinds = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
        split = (parts["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        pattern = CONTRACTIONS + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        self.plain = (kinds == ["NFC", "Replace", "Lowercase"]
                      and split[0].get("pattern", {}).get("Regex") == pattern)
        self.cut = regex.compile(pattern).findall
        self.letters = _byte_letters()

    def __missing__(self, word: str) -> bytes:
        out = self.older.get(word)
        if out is None:
            out = array("I", self.ids(word)).tobytes()
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[word] = out
        return out

    def ids(self, word: str) -> list[int]:
        # Below U+0250 nothing combines, and lower case is one for one but for
        # the dotted capital I (U+0130); unprintable characters differ in what
        # counts as white space.
        if not (self.plain and max(word, default="") < "\u0250" and "\u0130" not in word
                and word.isprintable() and not self.added.search(word)):
            return self.whole.encode(word, add_special_tokens=False).ids
        word = word.lower()
        pieces = [word] if word.isalpha() else self.cut(word)
        if not word.isascii():
            pieces = [w.encode().decode("latin-1").translate(self.letters) for w in pieces]
        return [t.id for w in pieces for t in self.model.tokenize(w)]


def _byte_letters() -> dict[int, str]:
    """Printable stand-in of each byte, as byte-level vocabularies spell them:
    printable Latin-1 stands for itself, the rest follow from U+0100 on."""
    same = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in same]
    return {b: chr(b) for b in same} | {b: chr(256 + i) for i, b in enumerate(rest)}


def word_ids(spec: str) -> WordIds:
    return held(("words", hash(spec)), lambda: WordIds(spec))


def text_ids(words: WordIds, text: str) -> bytes:
    """Ids of a text as little-endian unsigned 32-bit integers."""
    for blank in "\n\t\r":
        text = text.replace(blank, " ")
    return b"".join(map(words.__getitem__, text.split(" ")))


def binary_pieces(n: int, longest: int = MAX_LENGTH) -> list[int]:
    """Lengths of the pieces of ``n`` tokens: powers of two, longest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(longest.bit_length() - 1, -1, -1)
                                         if rest >> b & 1]


def pack(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
         longest: int = MAX_LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``id_col``, ``start``, ``length``, ``ids`` (binary),
    ``doc_tokens``, ``bucket`` (log2 of the length), ``sequence_id``,
    ``offset`` (0: a sequence is one piece).

    A narrow map: no shuffle, no state beyond one batch. ``sequence_id`` holds
    the bucket in its high bits, so equal lengths are contiguous; below them is
    Spark's partition and row number (unique up to 2**26 partitions)."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(vocabulary_path, encoding="utf-8") as f:
        spec = f.read()
    rows = docs.select(F.col(id_col).alias("doc"), text_of(text_col).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    end = end_id.to_bytes(4, "little")

    def cut_rows(batches):
        import pyarrow as pa
        words = word_ids(spec)
        for b in batches:
            doc, start, length, ids, total = [], [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                buf = text_ids(words, text) + end
                n, at = len(buf) // 4, 0
                for size in binary_pieces(n, longest):
                    doc.append(i)
                    start.append(at)
                    length.append(size)
                    ids.append(buf[4 * at:4 * (at + size)])
                    total.append(n)
                    at += size
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(doc, pa.int32())), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(total, pa.int64())],
                names=["doc", "start", "length", "ids", "doc_tokens"])

    pieces = rows.mapInArrow(cut_rows,
                             f"doc {kind}, start long, length long, ids binary, doc_tokens long")
    bucket = F.log2("length").cast("int")
    return pieces.select(
        F.col("doc").alias(id_col), "start", "length", "ids", "doc_tokens",
        bucket.alias("bucket"),
        F.shiftleft(bucket.cast("long"), 59)
        .bitwiseOR(F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))


def op8_pack(spark, sf_dir):
    """Pieces of every document under the 49k word vocabulary, ids as crc32."""
    import public_tokenizers as tokenizers
    pieces = pack(table(spark, sf_dir, "documents"), tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
