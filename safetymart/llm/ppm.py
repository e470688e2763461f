"""Language-model scores by prediction by partial matching over bytes."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from safetymart.llm.common import LOWER, row_chunks, stored, text_bytes

# Bytes of context.
ORDER = 5
# So many of the most frequent words and grams go to every task at most (16 bytes a
# gram, 34 MB); all others are joined with the texts that hold them.
HEAD_WORDS, HEAD_GRAMS = 1 << 18, 1 << 21
CHUNK_BYTES = 2 << 20
HELD_WORDS, HELD_GRAMS = 400_000, 2_000_000
END = b"\n"
_NO_GRAM = -1


def _words(raw: bytes) -> list[bytes]:
    return raw.translate(LOWER).split()


def coded_stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of texts, each after ``ORDER`` and before one end symbol.

    Also the places that are coded (all but the leading ends) and where each text's
    coded places start among these.
    """
    lead = END * (ORDER - 1)
    stream = np.frombuffer(END + b"".join(lead + t + END for t in texts), np.uint8)
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    shift = np.repeat(1 + (ORDER - 1) * np.arange(1, len(texts) + 1), lengths)
    return stream, np.arange(starts[-1]) + shift, starts


def _grams(stream: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Context and symbol of each place as one number, the symbol lowest."""
    code = stream[places - ORDER].astype(np.int64)
    for back in range(ORDER - 1, -1, -1):
        code = (code << 8) | stream[places - back]
    return code


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words and grams of (held_out, text); what only held-out texts hold has 0."""

    def table(keys, codes, n) -> pa.RecordBatch:
        kinds = (pa.binary(), pa.int64(), pa.int64())
        arrays = [pa.array(x, k) for x, k in zip((keys, codes, n), kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=["word", "gram", "n"])

    def word_table(words: Counter) -> pa.RecordBatch:
        return table(list(words), [_NO_GRAM] * len(words), list(words.values()))

    def merged(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        codes, times = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(codes, kind="stable")  # runs in order are merged, not sorted anew
        codes, times = codes[order], times[order]
        first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])[: len(codes)])
        return codes[first], np.add.reduceat(times, first) if len(first) else times

    words: Counter = Counter()
    held = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    waiting = 0
    for batch in batches:
        aside = np.array(batch.column(0).to_pylist(), bool)
        data, starts = text_bytes(batch.column(1))
        for a, b in row_chunks(starts, CHUNK_BYTES):
            raw = data[starts[a] : starts[b]].tobytes()
            at = (starts[a : b + 1] - starts[a]).tolist()
            own: tuple[list, list] = ([], [])
            for s, e, of in zip(at, at[1:], aside[a:b].tolist()):
                own[of].append(_words(raw[s:e]))
            for w in own[0]:
                words.update(w)
            if own[0]:
                words[b""] += len(own[0])  # the end token
            for weight, texts in zip((1, 0), own):
                if texts:
                    stream, places, _ = coded_stream([b" ".join(w) for w in texts])
                    codes, times = np.unique(_grams(stream, places), return_counts=True)
                    held.append((codes, times * weight))
                    waiting += len(codes)
            if len(words) > HELD_WORDS:
                yield word_table(words)
                words = Counter()
            # What is held is merged when as much again is waiting.
            if waiting > max(len(held[0][0]), HELD_GRAMS // 4):
                held, waiting = [merged(held)], 0
                if len(held[0][0]) > HELD_GRAMS:
                    yield table([b""] * len(held[0][0]), *held[0])
                    held = [(held[0][0][:0], held[0][1][:0])]
    yield word_table(words)
    codes, times = merged(held)
    yield table([b""] * len(codes), codes, times)


def gram_costs(grams: DataFrame) -> DataFrame:
    """(code, n, log10) of grams (code, n) of ``ORDER`` bytes and a symbol after them.

    The trie's levels are tables of grams, each made from the one above without its
    first byte. A gram with n = 0 is asked for, but has not occurred in training.

    A symbol is looked for in the longest context that has occurred. Where it has not
    followed, the context's escape probability is paid (method D: half of each
    distinct symbol's first occurrence goes to the escape) and the next shorter
    context is asked, without the symbols just ruled out. Below the empty context
    all bytes not ruled out are alike.

    From the empty context up, each level is joined with the one below: ``log10`` is
    what a gram costs there, ``escaped`` what it costs below its context once that
    has been left. A gram has at most 256 longer ones of the next level, and a context
    as many symbols, so no key of a join or window is hot.
    """
    def shorter(k: int) -> Column:
        return F.col("code").bitwiseAND(256**k - 1)

    levels = [grams]
    for k in range(ORDER, 0, -1):
        level = levels[-1].groupBy(shorter(k).alias("code")).agg(F.sum("n").alias("n"))
        levels.append(stored(level, f"grams_{k - 1}"))
    seen = F.col("n") > 0
    whole, distinct = F.sum("n"), F.count(F.when(seen, 1))
    here = F.log10(F.col("n") - 0.5) - F.log10("whole")
    leave = F.log10(F.col("distinct") / 2) - F.log10("whole")

    root = levels.pop()
    of_all = W.partitionBy(F.shiftright("code", 8))  # 256 rows at most
    root = root.withColumns({"whole": whole.over(of_all), "distinct": distinct.over(of_all)})
    alike = -F.log10(F.greatest(F.lit(1), 256 - F.col("distinct")))
    cost = F.when(seen, here).when(F.col("whole") > 0, leave + alike).otherwise(alike)
    below = stored(root.withColumns({"escaped": alike, "log10": cost}), "costs_0")
    for k in range(1, ORDER + 1):
        up = below.select(F.col("code").alias("up"), *(F.col(c).alias(f"up_{c}") for c in _LEVEL))
        level = levels.pop().withColumn("up", shorter(k)).join(up, "up")
        follows = W.partitionBy(F.shiftright("code", 8))
        level = level.withColumns(
            {
                "whole": whole.over(follows),
                "distinct": distinct.over(follows),
                "ruled_out": F.sum(F.when(seen, F.col("up_n")).otherwise(0)).over(follows),
            }
        )
        left = F.col("up_whole") - F.col("ruled_out")
        free = (F.col("up_distinct") - F.col("distinct")) / 2
        further = F.log10(free) - F.log10(left) + F.col("up_escaped")
        found = F.log10(F.col("up_n") - 0.5) - F.log10(left)
        # Where every symbol of the shorter context is ruled out, it costs nothing.
        escaped = (
            F.when(left <= 0, F.col("up_escaped"))
            .when(F.col("up_n") > 0, found)
            .otherwise(further)
        )
        level = level.withColumn("escaped", F.when(~seen, escaped))
        cost = F.when(seen, here).when(F.col("whole") > 0, leave + F.col("escaped"))
        level = level.withColumn("log10", cost.otherwise(F.col("up_log10")))
        wanted = _LEVEL if k < ORDER else ("n", "log10")
        below = stored(level.select("code", *wanted), f"costs_{k}")
    return below


_LEVEL = ("n", "whole", "distinct", "escaped", "log10")


def _least_count(rows: DataFrame, most: int) -> int:
    """The smallest n of which at most ``most`` rows have as much or more."""
    step = F.floor(F.log2("n") * 16).cast("int")
    steps = rows.filter("n > 0").groupBy(step.alias("step")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("n").alias("least"), F.max("n").alias("top")
    )
    found, total = None, 0
    for r in sorted(steps.collect(), key=lambda r: -r["step"]):
        total += r["rows"]
        if total > most:
            return found if found is not None else r["top"] + 1
        found = r["least"]
    return found or 1


def score_texts(
    docs: DataFrame,
    held_out_col: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    alpha: float = 0.1,
    head_words: int = HEAD_WORDS,
    head_grams: int = HEAD_GRAMS,
) -> DataFrame:
    """log10 probabilities of every text: a byte model's, and a word count's.

    Both learn from the rows where ``held_out_col`` is not true. A text is its
    words, lower-cased (A-Z), and one end; the byte model codes the words with a
    blank between them and the end as one symbol, from ``ORDER`` ends as first
    context. The base is log10((c + alpha) / (N + alpha * (V + 1))) over tokens.

    Null and empty texts are the end alone; with nothing to learn from, every
    symbol has probability 1/256 and N and V are 0. Repeated rows are scored each.
    Columns: id_col, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Words and grams of all texts are counted in one pass and one shuffle. The most
    frequent ones go to every task, up to a number; the others of each text are
    joined with their costs. Nothing is left out of the counts.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(held_out_col), F.lit(False)).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    counts = rows.select("held_out", "text").mapInArrow(
        _count_batches, "word binary, gram bigint, n bigint"
    )
    counts = stored(counts.groupBy("word", "gram").agg(F.sum("n").alias("n")), "counts")
    is_word = F.col("gram") == _NO_GRAM
    words = counts.filter(is_word & (F.col("n") > 0)).select("word", "n")
    facts = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("words")
    ).first()
    n_train, distinct = facts["tokens"], facts["words"]
    costs = gram_costs(counts.filter(~is_word).select(F.col("gram").alias("code"), "n"))
    least_word, least_gram = _least_count(words, head_words), _least_count(costs, head_grams)
    words_head = words.filter(F.col("n") >= least_word).toArrow()
    grams_head = costs.filter(F.col("n") >= least_gram).select("code", "log10").toArrow()
    codes = grams_head.column("code").to_numpy()
    order = np.argsort(codes)
    logs = grams_head.column("log10").to_numpy()[order]
    shared = spark.sparkContext.broadcast((words_head, codes[order], logs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, codes, costs = shared.value
        counted = zip(frequent.column("word").to_pylist(), frequent.column("n").to_pylist())
        known = {w: math.log10(n + alpha) for w, n in counted}.get
        for batch in batches:
            data, starts = text_bytes(batch.column(3))
            for a, b in row_chunks(starts, CHUNK_BYTES):
                raw = data[starts[a] : starts[b]].tobytes()
                texts, sums, lengths, in_head, tails = [], [], [], [], []
                for s, e in zip(starts[a:b] - starts[a], starts[a + 1 : b + 1] - starts[a]):
                    words = _words(raw[s:e])
                    texts.append(b" ".join(words))
                    values = list(map(known, words))
                    rare = Counter(w for w, v in zip(words, values) if v is None)
                    found = [v for v in values if v is not None]
                    end = known(b"")
                    sums.append(sum(found) + (end or 0.0))
                    lengths.append(len(words) + 1)
                    in_head.append(len(found) + (end is not None))
                    if end is None:
                        rare[b""] += 1
                    tails.append([{"word": w, "times": n} for w, n in rare.items()])
                score, grams = _text_costs(*coded_stream(texts), codes, costs)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(a, b - a) for i in range(3)),
                        pa.array(lengths, pa.int64()),
                        pa.array(in_head, pa.int64()),
                        pa.array(sums, pa.float64()),
                        pa.array(score, pa.float64()),
                        pa.array(tails, _TAIL),
                        grams,
                    ],
                    names=names,
                )

    names = ["row", "id", "held_out", "n_tokens", "n_head", "head", "score", "tail", "grams"]

    scored = rows.mapInArrow(
        run,
        "row bigint, id bigint, held_out boolean, n_tokens bigint, n_head bigint, "
        "head double, score double, tail array<struct<word:binary,times:int>>, "
        "grams array<struct<gram:bigint,times:bigint>>",
    )
    scored = stored(scored, "scored")
    tail = scored.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.times")
    joined = tail.join(words.filter(F.col("n") < least_word), "word", "left")
    n, none = F.coalesce("n", F.lit(0)), F.lit(0).cast("long")
    of_words = joined.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(n + F.lit(alpha))).alias("rest"),
        F.sum(F.when(n > 0, F.col("times").cast("long")).otherwise(none)).alias("n_rest"),
        F.lit(0.0).alias("grams_rest"),
    )
    tail = scored.select("row", F.explode("grams").alias("g")).select("row", "g.gram", "g.times")
    rare = costs.filter(F.col("n") < least_gram).select(F.col("code").alias("gram"), "log10")
    of_grams = tail.join(rare, "gram").groupBy("row").agg(
        F.lit(0.0).alias("rest"),
        none.alias("n_rest"),
        F.sum(F.col("times") * F.col("log10")).alias("grams_rest"),
    )
    rest = of_words.unionByName(of_grams).groupBy("row").agg(
        *(F.sum(c).alias(c) for c in ("rest", "n_rest", "grams_rest"))
    )
    each = math.log10(n_train + alpha * (distinct + 1))
    zero = F.lit(0)
    return scored.drop("tail", "grams").join(rest, "row", "left").select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_rest", zero)).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("head") + F.coalesce("rest", zero) - F.col("n_tokens") * each).alias("base_score"),
        (F.col("score") + F.coalesce("grams_rest", F.lit(0.0))).alias("score"),
    )


def _text_costs(
    stream: np.ndarray, places: np.ndarray, first: np.ndarray, codes: np.ndarray, costs: np.ndarray
) -> tuple[np.ndarray, pa.Array]:
    """Each text's sum over the grams in ``codes`` (sorted), and its other grams, counted."""
    own, which = np.unique(_grams(stream, places), return_inverse=True)
    if len(codes):
        at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
        known = codes[at] == own
        value = np.where(known, costs[at], 0.0)
    else:
        known, value = np.zeros(len(own), bool), np.zeros(len(own))
    score = np.add.reduceat(value[which], first[:-1])
    rare = np.flatnonzero(~known[which])
    text = np.searchsorted(first, rare, "right") - 1
    pairs, times = np.unique(text * len(own) + which[rare], return_counts=True)
    ends = np.searchsorted(pairs // len(own), np.arange(len(first)))
    grams = pa.StructArray.from_arrays(
        [pa.array(own[pairs % len(own)], pa.int64()), pa.array(times, pa.int64())],
        names=["gram", "times"],
    )
    return score, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), grams)


_TAIL = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int32())]))
