"""Byte-level BPE encoding and decoding by overlapping chunks.

A text longer than one chunk is cut into overlapping chunks, which are
pre-tokenised independently, wherever Spark puts them. The pattern only looks
ahead, so the scan from a position depends on nothing before it: as soon as
two neighbouring chunks share a pre-token boundary in their overlap, they
agree from there on. The first such boundary (behind a character that is not
white space, so that a cut there cannot change a run of spaces) ends one piece
and starts the next; the pieces are then encoded independently and their ids
put together in order. A text in which some overlap holds no common boundary
(one pre-token longer than the overlap) is encoded as one piece.

Decoding maps ids to their raw bytes and concatenates them.

Defined results: null text is empty, an empty text has no ids; repeated rows
stay repeated; the id column may be null; other columns are ignored.
"""

from __future__ import annotations

import base64

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, held, materialize, table, text_of

CHUNK = 65_536
OVERLAP = 4_096


def _codec(ranks: bytes, pattern: str):
    """(tiktoken encoding, bytes by id), built once per worker process."""
    import tiktoken

    def build():
        table_ = {base64.b64decode(a): int(b)
                  for a, b in (line.split() for line in ranks.splitlines() if line)}
        by_id = [b""] * (max(table_.values(), default=-1) + 1)
        for token, rank in table_.items():
            by_id[rank] = token
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table_,
                                 special_tokens={}), by_id

    return held(("bpe", hash(ranks), pattern), build)


def boundaries(text: str, pattern) -> list[int]:
    """Ends of the pre-tokens of ``text``."""
    return [m.end() for m in pattern.finditer(text)]


def cut(text: str, chunk: int, overlap: int) -> list[tuple[int, str]]:
    """Overlapping chunks (start, text); neighbours share ``overlap`` characters."""
    step = chunk - overlap
    starts = range(0, max(1, len(text) - overlap), step)
    return [(s, text[s:s + chunk]) for s in starts]


def edge_boundaries(start: int, chunk_text: str, last: bool, overlap: int, pattern):
    """Boundaries usable as cuts in the first and last ``overlap`` characters.

    The last two characters of a chunk may still be read differently with the
    text that follows, and a cut behind white space could merge a run of it;
    both are left out."""
    ends = [e for e in boundaries(chunk_text, pattern)
            if (last or e <= len(chunk_text) - 2) and not chunk_text[e - 1].isspace()]
    head = [start + e for e in ends if e <= overlap]
    tail = [start + e for e in ends if e > len(chunk_text) - overlap]
    return head, tail


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``id_col``, ``ids`` (binary: little-endian unsigned 32-bit), ``n_tokens``.

    Row identity across the passes over long texts is an id written with their
    chunks to the shared folder, so repeated rows and null ids stay apart."""
    if not 0 < 2 * overlap < chunk:
        raise ValueError("a chunk must be longer than two overlaps")
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(ranks_path, "rb") as f:
        ranks = f.read()
    rows = docs.select(F.col(id_col).alias("doc"), text_of(text_col).alias("text"))
    n = F.char_length("text")

    def encode_rows(batches):
        import pyarrow as pa
        enc, _ = _codec(ranks, pattern)
        for b in batches:
            ids = [enc.encode_to_numpy(t).astype("<u4").tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())],
                                             names=["doc", "ids"])

    kind = rows.schema["doc"].dataType.simpleString()
    short = rows.where(n <= chunk).mapInArrow(encode_rows, f"doc {kind}, ids binary")

    def chunk_rows(batches):
        import pandas as pd
        for pdf in batches:
            for row, doc, text in pdf.itertuples(index=False):
                parts = cut(text, chunk, overlap)
                for i in range(0, len(parts), 64):
                    some = parts[i:i + 64]
                    yield pd.DataFrame({"row": row, "doc": doc, "n_parts": len(parts),
                                        "k": range(i, i + len(some)),
                                        "start": [s for s, _ in some],
                                        "part": [p for _, p in some]})

    def scan_rows(batches):
        import pandas as pd
        import regex
        compiled = regex.compile(pattern)
        for pdf in batches:
            edges = [edge_boundaries(s, p, k == m - 1, overlap, compiled) for s, p, k, m in
                     zip(pdf["start"], pdf["part"], pdf["k"], pdf["n_parts"])]
            yield pd.DataFrame({**{c: pdf[c] for c in pdf.columns},
                                "head": [h for h, _ in edges], "tail": [t for _, t in edges]})

    base = f"row long, doc {kind}, n_parts int, k int, start long, part string"
    parts = materialize(
        rows.where(n > chunk).select(F.monotonically_increasing_id().alias("row"), "doc", "text")
        .mapInPandas(chunk_rows, base).repartition("row", "k")
        .mapInPandas(scan_rows, f"{base}, head array<long>, tail array<long>"), "bpe-parts")
    before = parts.select("row", (F.col("k") + 1).alias("k"), F.col("tail").alias("prev_tail"))
    sync = (parts.select("row", "k", "n_parts", "head").join(before, ["row", "k"], "left")
            .select("row", "k", "n_parts",
                    F.when(F.col("k") == 0, F.lit(0)).otherwise(
                        F.array_min(F.array_intersect("head", "prev_tail"))).alias("cut")))
    cuts = sync.select("row", "k", "n_parts", "cut")
    ends = cuts.select("row", (F.col("k") - 1).alias("k"), F.col("cut").alias("to"))
    broken = cuts.where(F.col("cut").isNull()).select("row").distinct()
    pieces = (parts.drop("head", "tail", "n_parts")
              .join(cuts.select("row", "k", "cut"), ["row", "k"])
              .join(ends, ["row", "k"], "left"))

    def stitched(batches):
        import pandas as pd
        enc, _ = _codec(ranks, pattern)
        for pdf in batches:
            ids = []
            for start, part, a, b in zip(pdf["start"], pdf["part"], pdf["cut"], pdf["to"]):
                stop = len(part) if pd.isna(b) else int(b) - start
                ids.append(enc.encode_to_numpy(part[int(a) - start:stop]).astype("<u4").tobytes())
            yield pd.DataFrame({"row": pdf["row"], "doc": pdf["doc"], "k": pdf["k"], "ids": ids})

    def whole(batches):
        import pandas as pd
        enc, _ = _codec(ranks, pattern)
        for pdf in batches:
            ids = []
            for pieces_ in pdf["parts"]:
                text = "".join(p["part"] if not i else p["part"][overlap:]
                               for i, p in enumerate(sorted(pieces_, key=lambda p: p["k"])))
                ids.append(enc.encode_to_numpy(text).astype("<u4").tobytes())
            yield pd.DataFrame({"doc": pdf["doc"], "ids": ids})

    joined = (pieces.join(broken, "row", "left_anti")
              .select("row", "doc", "k", "start", "part", "cut", "to")
              .mapInPandas(stitched, f"row long, doc {kind}, k int, ids binary")
              .groupBy("row").agg(F.first("doc").alias("doc"),
                                  F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("p"))
              .select("doc", F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))")
                      .alias("ids")))
    unsynced = (parts.join(broken, "row", "left_semi").groupBy("row")
                .agg(F.first("doc").alias("doc"),
                     F.collect_list(F.struct("k", "part")).alias("parts"))
                .select("doc", "parts").mapInPandas(whole, f"doc {kind}, ids binary"))
    return (short.unionByName(joined).unionByName(unsynced)
            .select(F.col("doc").alias(id_col), "ids",
                    (F.octet_length("ids") / 4).cast("long").alias("n_tokens")))


def decode(encoded: DataFrame, ranks_path: str, pattern: str = "", ids_col: str = "ids",
           out_col: str = "decoded") -> DataFrame:
    """Add ``out_col``: the raw bytes of the ids, concatenated (null ids: null)."""
    with open(ranks_path, "rb") as f:
        ranks = f.read()
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)

    def decode_rows(batches):
        import numpy as np
        import pyarrow as pa
        _, by_id = _codec(ranks, pattern)
        get = by_id.__getitem__
        for b in batches:
            at = b.schema.get_field_index(ids_col)
            out = [None if v is None else b"".join(map(get, np.frombuffer(v, "<u4").tolist()))
                   for v in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())],
                                             names=[*b.schema.names, out_col])

    return encoded.mapInArrow(decode_rows, f"{fields}, `{out_col}` binary")


def op1_byte_bpe(spark, sf_dir):
    """Ids and exact round trip of every document under the 50k multilingual ranks."""
    import public_tokenizers as tokenizers
    path = tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = encode(table(spark, sf_dir, "documents"), path, tokenizers.PATTERN)
    return (decode(ids, path, tokenizers.PATTERN)
            .select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256")))
