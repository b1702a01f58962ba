"""LM scoring by a hidden Markov language model.

Tokens are emitted in two steps: a hidden state emits a word class, the class
emits the word. Classes are the most frequent training words, one each, and for
the rest the hash of a word's ending; a word's probability within its class
comes from its exact count over all training documents. Transition and class
emission probabilities are trained by Baum-Welch over all training documents:
each task adds up expected counts, Spark sums them by parameter, and only the
parameters reach the driver.

The vocabulary grows with the corpus and is never held in one place. One pass
cuts the documents into chunks of bounded size and writes, for each chunk, its
documents as local word numbers and its word list with training counts. Counts
are summed by word and joined back to the chunks' word lists, and each chunk's
documents meet their own list. From then on a document is a sequence of class
numbers.

Training and scoring are exact over whole documents: sequences are cut into
segments, the scaled product of transition and emission matrices of each
segment is computed for many segments at once, and the products of a document
are applied in order (for training also in reverse).

Defined results: null and empty texts are the end token alone; a null id counts
as '' in the split; without training documents every word is unknown and has
probability 1 within its class; repeated rows are scored as often as they
occur; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (bounded_batches, crc32_mod, hash_sample, materialize, release, table,
                     text_of)

STATES = 6
TOP_WORDS = 2000
ENDINGS = 64          # classes of the other words
ROUNDS = 4            # of Baum-Welch
CHUNK_TOKENS = 2_000_000
SEGMENT = 256
TOGETHER = 1024       # segments stepped through together
SEED_TOKENS = 200     # shortest document that may seed a state
SEED_LONGEST = 20_000
UNIT = 1 << 20        # expected counts are summed as integers of 1/UNIT


class LocalWords(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def planes(seq):
    """Numbers as bytes, all lowest bytes first: the higher ones are nearly all
    equal and compress to nothing."""
    import numpy as np
    return np.ascontiguousarray(seq.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def numbers(data: bytes):
    import numpy as np
    return np.ascontiguousarray(
        np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def chunk_table(docs: DataFrame, held_out, id_col: str, text_col: str,
                chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """One row per document (``seq``: ``planes`` of its local word numbers, end
    token last) and one per word of a chunk (``word``, empty for the end;
    ``local``; ``count`` in training documents), told apart by ``is_word``."""
    bounded_batches(docs.sparkSession, 4 << 20)
    rows = docs.select(F.col(id_col).alias("doc"), held_out.alias("held_out"),
                       text_of(text_col).cast("binary").alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()

    def chunk_rows(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        base = TaskContext.get().partitionId() << 32
        names = ["chunk", "is_word", "doc", "held_out", "seq", "word", "local", "count"]
        state = {"n": 0, "chunk": base, "words": LocalWords(), "docs": [], "doc_type": None}

        def flush():
            words, held = state["words"], state["docs"]
            if not held:
                return
            n, m = len(held), len(words)
            none = np.zeros(0, np.uint32)
            counts = np.bincount(np.concatenate([none, *[s for _, out, s in held if not out]]),
                                 minlength=m)
            # Renumbered, the most frequent words first.
            order = np.argsort(-np.bincount(np.concatenate([s for _, _, s in held]),
                                            minlength=m), kind="stable")
            place = np.empty(m, np.uint32)
            place[order] = np.arange(m, dtype=np.uint32)
            counts = counts[order]
            yield pa.RecordBatch.from_arrays(
                [pa.array([state["chunk"]] * n, pa.int64()), pa.array([False] * n),
                 pa.array([d for d, _, _ in held], state["doc_type"]),
                 pa.array([o for _, o, _ in held], pa.bool_()),
                 pa.array([planes(place[s]) for _, _, s in held], pa.binary()),
                 pa.nulls(n, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())],
                names=names)
            names_of = list(words)
            keys = [names_of[i] for i in order.tolist()]
            for a in range(0, m, 100_000):
                k = len(keys[a:a + 100_000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([state["chunk"]] * k, pa.int64()), pa.array([True] * k),
                     pa.nulls(k, state["doc_type"]), pa.nulls(k, pa.bool_()),
                     pa.nulls(k, pa.binary()), pa.array(keys[a:a + k], pa.binary()),
                     pa.array(range(a, a + k), pa.int32()),
                     pa.array(counts[a:a + k], pa.int64())], names=names)
            state.update(n=0, chunk=state["chunk"] + 1, words=LocalWords(), docs=[])

        for b in batches:
            state["doc_type"] = b.column(0).type
            for doc, out, text in zip(*(c.to_pylist() for c in b.columns)):
                words = text.lower().split()
                words.append(b"")
                seq = np.array(list(map(state["words"].__getitem__, words)), np.int64)
                state["docs"].append((doc, out, seq.astype(np.uint32)))
                state["n"] += len(seq)
                if state["n"] >= chunk_tokens:
                    yield from flush()
        yield from flush()
        release()

    return rows.mapInArrow(
        chunk_rows, f"chunk long, is_word boolean, doc {kind}, held_out boolean, seq binary, "
                    "word binary, local int, count long")


def word_classes(counts: DataFrame, top_words: int, endings: int) -> DataFrame:
    """Add ``class``: 0 the end, 1.. the most frequent words, then the endings."""
    spark = counts.sparkSession
    # A histogram of the counts gives the least count that can be among the
    # top, so that little more than the top is sorted and sent.
    words = counts.where("count > 0 and octet_length(word) > 0").withColumn(
        "step", F.floor(F.log2("count") * 16))
    least, more = None, 0
    for r in words.groupBy("step").count().orderBy(F.desc("step")).collect():
        least, more = r["step"], more + r["count"]
        if more >= top_words:
            break
    top = [r["word"] for r in words.where(F.col("step") >= F.lit(least))
           .orderBy(F.desc("count"), "word").limit(top_words).collect()]
    named = spark.createDataFrame([(bytearray(w), i + 1) for i, w in enumerate(top)],
                                  "word binary, top int")
    ending = F.crc32(F.expr("substring(word, greatest(octet_length(word) - 1, 1), 2)")) % endings
    # At most ``top_words`` rows: a proven bound.
    return counts.join(F.broadcast(named), "word", "left").select(
        "word", "count", F.when(F.octet_length("word") == 0, F.lit(0)).otherwise(
            F.coalesce("top", (ending + top_words + 1).cast("int"))).alias("class"))


def segments(sequences):
    """The sequences' segments, each one's sequence and its place in that."""
    import numpy as np
    cuts = [(i, a) for i, s in enumerate(sequences) for a in range(0, len(s), SEGMENT)]
    return ([sequences[i][a:a + SEGMENT] for i, a in cuts],
            np.array([i for i, _ in cuts], np.int64),
            np.array([a // SEGMENT for _, a in cuts], np.int64))


def in_order(place):
    """Segments of place 0, of place 1 and so on."""
    import numpy as np
    order = np.argsort(place, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(place[order])) + 1) if len(place) else []


def grids(parts):
    """Segments to be stepped through together, longest first: their numbers,
    their classes by step, and how many last beyond each step."""
    import numpy as np
    order = np.array(sorted(range(len(parts)), key=lambda i: -len(parts[i])), np.int64)
    for a in range(0, len(order), TOGETHER):
        at = order[a:a + TOGETHER]
        lens = np.array([len(parts[i]) for i in at])
        grid = np.zeros((int(lens[0]), len(at)), np.int64)
        for j, i in enumerate(at):
            grid[:lens[j], j] = parts[i]
        yield at, grid, np.searchsorted(-lens, -np.arange(len(grid)), side="left")


class Model:
    """Start, moves (state by state) and emissions (state by class), with the
    arithmetic of one task."""

    def __init__(self, start, moves, emit):
        self.start, self.moves, self.emit = start, moves, emit

    def products(self, parts, first):
        """Of each segment the scaled product of its moves and emissions, from
        each state before it to each state at its end, and the log10 of the
        scale. A document's first segment (``first``) begins with the start
        probabilities instead of a move."""
        import numpy as np
        k = len(self.start)
        by_class = np.ascontiguousarray(self.emit.T)
        product, logs = np.zeros((len(parts), k, k)), np.zeros(len(parts))
        for at, grid, active in grids(parts):
            run = np.where(first[at][:, None, None], self.start[None, None, :], self.moves[None])
            run = run * by_class[grid[0]][:, None, :]
            log = np.zeros(len(at))
            for t in range(1, len(grid)):
                m = active[t]
                step = (run[:m].reshape(-1, k) @ self.moves).reshape(m, k, k)
                step *= by_class[grid[t, :m]][:, None, :]
                if t % 8 == 0:
                    top = step.max((1, 2))
                    step /= top[:, None, None]
                    log[:m] += np.log10(top)
                run[:m] = step
            product[at], logs[at] = run, log
        return product, logs

    def expected(self, sequences, totals) -> None:
        """Add expected counts of the sequences to ``totals`` (start, moves,
        emit). Segments are stepped through side by side, but not apart: the
        products of a sequence's segments, applied in order, give the states
        before each segment and, in reverse, the weights of what follows it."""
        import numpy as np
        parts, owner, place = segments(sequences)
        k = len(self.start)
        last = np.append(owner[1:] != owner[:-1], True)
        before, after = np.full((len(parts), k), 1.0 / k), np.ones((len(parts), k))
        several = np.flatnonzero((place > 0) | ~last)
        if len(several):
            product, _ = self.products([parts[i] for i in several], place[several] == 0)
            index = np.zeros(len(parts), np.int64)
            index[several] = np.arange(len(several))
            steps = in_order(place)
            for on in steps:
                on = on[~last[on]]
                v = np.einsum("nk,nkj->nj", before[on], product[index[on]])
                before[on + 1] = v / v.sum(1, keepdims=True)
            for on in reversed(steps[1:]):
                v = np.einsum("nkj,nj->nk", product[index[on]], after[on])
                after[on - 1] = v / v.sum(1, keepdims=True)
        by_class = np.ascontiguousarray(self.emit.T)
        for at, grid, active in grids(parts):
            longest, n = grid.shape
            first = place[at] == 0
            alpha = np.zeros((longest, n, k))
            scale = np.ones((longest, n))
            for t in range(longest):
                m = active[t]
                v = (np.where(first[:, None], self.start, before[at] @ self.moves) if t == 0
                     else alpha[t - 1, :m] @ self.moves) * by_class[grid[t, :m]]
                scale[t, :m] = v.sum(1)
                alpha[t, :m] = v / scale[t, :m, None]
            ends = alpha[[len(parts[i]) - 1 for i in at], np.arange(n)]
            beta = after[at] / (ends * after[at]).sum(1, keepdims=True)
            weights = np.zeros((longest, n, k))
            for t in range(longest - 1, -1, -1):
                m = active[t]
                weights[t, :m] = alpha[t, :m] * beta[:m]
                ahead = by_class[grid[t, :m]] * beta[:m] / scale[t, :m, None]
                if t:
                    totals[1] += (alpha[t - 1, :m].T @ ahead) * self.moves
                    beta[:m] = ahead @ self.moves.T
                else:  # the move from the segment before
                    totals[1] += (before[at][~first].T @ ahead[~first]) * self.moves
            totals[0] += weights[0][first].sum(0)
            for s in range(k):
                totals[2][s] += np.bincount(grid.ravel(), weights[:, :, s].ravel(),
                                            self.emit.shape[1])

    def log10(self, sequences):
        """log10 probability of each sequence."""
        import numpy as np
        parts, owner, place = segments(sequences)
        product, logs = self.products(parts, place == 0)
        # The first segment ignores the state before it.
        state = np.full((len(sequences), len(self.start)), 1.0 / len(self.start))
        out = np.zeros(len(sequences))
        for on in in_order(place):
            who = owner[on]
            v = np.einsum("nk,nkj->nj", state[who], product[on])
            total = v.sum(1)
            state[who] = v / total[:, None]
            out[who] += np.log10(total) + logs[on]
        return out


def estimate(totals, states: int, classes: int):
    """Probabilities from expected counts, smoothed."""
    import numpy as np
    start, moves, emit = totals
    start = start + 0.1
    moves = moves + 0.1
    emit = emit + 0.01
    return Model(start / start.sum(), moves / moves.sum(1, keepdims=True),
                 emit / emit.sum(1, keepdims=True) if classes else np.ones((states, 0)))


def train(classed: DataFrame, class_counts, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over the training rows of ``classed`` (``classes``: 16-bit
    class numbers). States start from the corpus frequencies leaning towards
    one document each."""
    import numpy as np
    k = len(class_counts)
    training = classed.where("not held_out")
    seeds = hash_sample(training.where(F.octet_length("classes").between(
        2 * SEED_TOKENS, 2 * SEED_LONGEST)).select("doc", "classes"), states, None, "classes",
        "doc").collect()
    emit = np.tile((class_counts + 1.0) / (class_counts + 1.0).sum(), (states, 1))
    for s, r in enumerate(seeds):
        own = np.bincount(np.frombuffer(r["classes"], "<u2"), minlength=k)
        emit[s] = 0.5 * emit[s] + 0.5 * own / own.sum()
    rng = np.random.default_rng(11)
    emit *= rng.uniform(0.9, 1.1, emit.shape)
    moves = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
    model = Model(np.full(states, 1.0 / states), moves / moves.sum(1, keepdims=True),
                  emit / emit.sum(1, keepdims=True))
    for _ in range(rounds):
        given = (model.start, model.moves, model.emit)

        def count_rows(batches, given=given):
            import pyarrow as pa
            m = Model(*given)
            totals = [np.zeros_like(x) for x in given]
            for b in batches:
                m.expected([np.frombuffer(x, "<u2") for x in b.column(0).to_pylist()], totals)
            flat = np.rint(np.concatenate([t.ravel() for t in totals]) * UNIT).astype(np.int64)
            some = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(flat[some])],
                                             names=["i", "n"])
            release()

        got = (training.select("classes").mapInArrow(count_rows, "i int, n long")
               .groupBy("i").agg(F.sum("n").alias("n")).collect())  # one row per parameter
        flat = np.zeros(states + states * states + states * k)
        for r in got:
            flat[r["i"]] = r["n"] / UNIT
        a, b = states, states + states * states
        model = estimate((flat[:a], flat[a:b].reshape(states, states),
                          flat[b:].reshape(states, k)), states, k)
    return model


def score(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text",
          states: int = STATES, top_words: int = TOP_WORDS, endings: int = ENDINGS,
          rounds: int = ROUNDS) -> DataFrame:
    """``id_col``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (add-one unigram) and ``score`` (the model), both log10.

    ``held_out``: boolean column of rows that are scored but not learned from."""
    import numpy as np
    chunks = materialize(chunk_table(docs, held_out, id_col, text_col), "lm-chunks")
    lists = chunks.where("is_word").select("chunk", "word", "local", "count")
    counts = materialize(word_classes(materialize(
        lists.groupBy("word").agg(F.sum("count").alias("count")), "lm-counts"),
        top_words, endings), "lm-classes")
    known = counts.where("count > 0")
    per_class = known.groupBy("class").agg(F.sum("count").alias("n"),
                                           F.count(F.lit(1)).alias("v")).collect()
    k = top_words + 1 + endings
    n_class, v_class = np.zeros(k), np.zeros(k)
    for r in per_class:
        n_class[r["class"]], v_class[r["class"]] = r["n"], r["v"]
    n, v = int(n_class.sum()), int(v_class.sum())
    # The end and the frequent words are their classes' only words.
    room = np.where(np.arange(k) <= top_words, 0.0, n_class + v_class + 1.0)
    per_token = float(np.log10(n + (v + 1)))
    numbered = lists.join(counts.withColumnRenamed("count", "total"), "word").select(
        F.col("chunk").alias("list"), "local", "total", "class")
    kind = chunks.schema["doc"].dataType.simpleString()

    def classed_rows(texts, words):
        import pandas as pd
        size = int(words["local"].max()) + 1 if len(words) else 0
        total, cls = np.zeros(size), np.zeros(size, np.int64)
        total[words["local"]] = words["total"]
        cls[words["local"]] = words["class"]
        base = np.log10(total + 1)
        own = room[cls]
        inside = np.where(own > 0, base - np.log10(np.maximum(own, 1)), 0.0)
        seqs = [numbers(s) for s in texts["seq"]]
        release()
        return pd.DataFrame({
            "doc": texts["doc"], "held_out": texts["held_out"],
            "n_tokens": [len(s) for s in seqs],
            "n_known": [int((total[s] > 0).sum()) for s in seqs],
            "base": [float(base[s].sum()) - per_token * len(s) for s in seqs],
            "inside": [float(inside[s].sum()) for s in seqs],
            "classes": [cls[s].astype("<u2").tobytes() for s in seqs]})

    classed = materialize(
        chunks.where("not is_word").select("chunk", "doc", "held_out", "seq").groupBy("chunk")
        .cogroup(numbered.groupBy("list")).applyInPandas(
            classed_rows, f"doc {kind}, held_out boolean, n_tokens long, n_known long, "
                          "base double, inside double, classes binary"), "lm-sequences")
    model = train(classed, n_class, states, rounds)
    given = (model.start, model.moves, model.emit)

    def score_rows(batches):
        import pyarrow as pa
        m = Model(*given)
        for b in batches:
            got = m.log10([np.frombuffer(x, "<u2") for x in b.column(6).to_pylist()])
            got += b.column(5).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(got, pa.float64())],
                                             names=[*b.schema.names[:5], "score"])
        release()

    return classed.mapInArrow(
        score_rows, f"doc {kind}, held_out boolean, n_tokens long, n_known long, base double, "
                    "score double").select(
        F.col("doc").alias(id_col), "held_out", "n_tokens", "n_known",
        F.lit(n).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")


def op6_lm_score(spark, sf_dir):
    """Base and model log10 probabilities of every document; a seventh held out."""
    return score(table(spark, sf_dir, "documents"), crc32_mod("doc_id", 7) == 2)
