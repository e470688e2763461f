"""Best-two-fit packing of token sequences into windows of fixed length."""

from __future__ import annotations

import array
import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from safetymart.llm.common import stored

# The vocabulary's end-of-text token as it stands in texts, and
# Unicode's white space, at which the tokenizer's own pattern splits.
END_OF_TEXT = "<|endoftext|>"
_WHITE = "\t-\r \x85\xa0" + "".join(
    map(chr, (0x1680, 0x2000, 0x2D, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)
# Pieces of the tokenizer's pattern never reach over these chunks: a word with the
# blank before it, white space up to the last character before a word, the rest.
_CHUNKS = re.compile(f" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")

# Distinct chunks whose ids a task remembers, and the longest it remembers.
CACHED, CACHED_CHARS = 600_000, 48
# Bytes of ids that a task holds before it hands them on.
BATCH_BYTES = 4 << 20
SEPARATOR = 0
# Numbers of pieces, by task and length, that are broadcast; more are joined.
MAX_FIRSTS = 1 << 19
# ``nth`` counts the pieces of one length in the order in which their ``task`` made them.
PIECES = (
    "id bigint, piece int, start bigint, length int, ids binary, ids_crc32 bigint, "
    "task int, nth bigint"
)


class ChunkIds(dict):
    """Token ids of chunks, as little-endian 32-bit bytes, worked out once."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        ids = array.array("I", self.encode(chunk)).tobytes()
        if len(chunk) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.clear()
            self[chunk] = ids
        return ids


class Encoder:
    """Texts to ids of a byte-level BPE vocabulary, chunk by chunk.

    ``ranks`` is the vocabulary file by ranks, ``full`` the same vocabulary as the
    tokenizer's own file, which texts with the end-of-text token go through.
    """

    def __init__(self, full: str, ranks: str, pattern: str):
        import tiktoken

        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        bpe = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={}
        )
        self.ids = ChunkIds(bpe.encode_ordinary)
        self.full, self._tokenizer = full, None

    def __call__(self, text: str) -> bytes:
        if END_OF_TEXT in text:
            if self._tokenizer is None:
                from tokenizers import Tokenizer

                self._tokenizer = Tokenizer.from_file(self.full)
            ids = self._tokenizer.encode(text, add_special_tokens=False).ids
            return array.array("I", ids).tobytes()
        return b"".join(map(self.ids.__getitem__, _CHUNKS.findall(text)))


def public_encoder() -> Encoder:
    import public_tokenizers

    path = public_tokenizers.path
    return Encoder(
        path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 2048,
    encoder=public_encoder,
    with_ids: bool = True,
) -> DataFrame:
    """The pieces of every text's ids: no piece is longer than ``size``.

    A document is its ids and then ``SEPARATOR``. Only a longer one is cut; all
    its pieces have ``size`` ids, except that the first may have fewer. Null is
    an empty text. Columns: id, piece, start (ids before it), length, ids
    (little-endian 32-bit; null without ``with_ids``), ids_crc32, task, nth.
    """
    end = SEPARATOR.to_bytes(4, "little")

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64())
        kinds = (*kinds, pa.int32(), pa.int64())
        names = ("id", "piece", "start", "length", "ids", "ids_crc32", "task", "nth")
        columns = zip(*rows) if rows else [()] * len(names)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=list(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(), TaskContext.get().partitionId()
        made = [0] * (size + 1)
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                total = len(ids) // 4
                start, n = 0, (total - 1) % size + 1
                for piece in range(-(-total // size)):
                    own = ids[4 * start : 4 * (start + n)]
                    kept = own if with_ids else None
                    rows.append((doc.as_py(), piece, start, n, kept, zlib.crc32(own), task, made[n]))
                    made[n] += 1
                    start, n = start + n, size
                held += 4 * total
                if held > BATCH_BYTES:
                    yield table(rows)
                    rows, held = [], 0
        yield table(rows)

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, PIECES)


def plan_bins(counts: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins for so many pieces of each length: (number of bins, [(length, pieces)]).

    Best-two-fit, on lengths instead of pieces: a bin is filled greedily, longest
    piece that fits first; then its smallest piece is given back if two unpacked
    pieces fill the gap it leaves better. The bin is repeated as often as the
    pieces last, so that the work depends on the number of lengths only.
    """
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    bins = []
    while left.any():
        here = left.copy()
        used: dict[int, int] = {}
        gap = size
        while True:
            fitting = np.flatnonzero(here[: gap + 1])
            if not len(fitting):
                break
            length = int(fitting[-1])
            n = min(int(here[length]), gap // length)
            used[length] = used.get(length, 0) + n
            here[length] -= n
            gap -= n * length
        smallest = min(used)
        two = _best_two(here, gap + smallest) if gap else None
        if two and sum(two) > smallest:
            used[smallest] -= 1
            for length in two:
                used[length] = used.get(length, 0) + 1
        used = {length: n for length, n in used.items() if n}
        times = min(int(left[length]) // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= n * times
        bins.append((times, sorted(used.items(), reverse=True)))
    return bins


def _best_two(left: np.ndarray, gap: int) -> tuple[int, int] | None:
    """The two lengths that are left and together come nearest to ``gap``."""
    lengths = np.flatnonzero(left[: gap + 1])
    if not len(lengths):
        return None
    # For each first length the longest second one that still fits.
    at = np.searchsorted(lengths, gap - lengths, "right") - 1
    alone = (at >= 0) & (lengths[at] == lengths) & (left[lengths] < 2)
    at = np.where(alone, at - 1, at)
    total = np.where(at >= 0, lengths + lengths[np.maximum(at, 0)], -1)
    best = int(np.argmax(total))
    if total[best] < 0:
        return None
    return int(lengths[best]), int(lengths[at[best]])


def place_pieces(pieces: DataFrame, size: int = 2048) -> DataFrame:
    """Stored ``pieces`` with sequence_id and offset: where each stands after packing.

    The plan needs only how many pieces have each length, ``size`` numbers. A
    piece is then placed by its rank among those of its length: its number within its
    task, after the pieces of all earlier tasks. No ids move, and nothing is sorted. The
    numbers of the tasks are broadcast up to ``MAX_FIRSTS``, and joined beyond.
    """
    by_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    by_task = stored(by_task, "counts")
    sizes = by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()
    base, slots, taken = 0, [], dict.fromkeys((r["length"] for r in sizes), 0)
    for times, content in plan_bins({r["length"]: r["n"] for r in sizes}, size):
        offset = 0
        for length, n in content:
            slots.append((length, taken[length], n, base, offset))
            taken[length] += n * times
            offset += length * n
        base += times
    slots.sort()
    shared = pieces.sparkSession.sparkContext.broadcast(
        np.array(slots or [(0, 0, 1, 0, 0)], np.int64)
    )

    @F.pandas_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        lengths, begin, n, base, offset = shared.value.T
        # Ranks are below 2**48 and lengths below 2**15.
        at = np.searchsorted(
            (lengths << 48) + begin, (length.to_numpy(np.int64) << 48) + rank, "right"
        )
        at -= 1
        into = rank.to_numpy() - begin[at]
        return pd.DataFrame(
            {
                "sequence_id": base[at] + into // n[at],
                "offset": offset[at] + into % n[at] * lengths[at],
            }
        )

    earlier = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("long")
    firsts = by_task.select("task", "length", first.alias("first"))
    small = by_task.count() <= MAX_FIRSTS
    ranks = pieces.join(F.broadcast(firsts) if small else firsts, ["task", "length"])
    ranks = ranks.withColumn("place", place("length", F.col("first") + F.col("nth")))
    names = [c for c in pieces.columns if c not in ("task", "nth")]
    return ranks.select(*names, "place.sequence_id", "place.offset")


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 2048,
    encoder=public_encoder,
    with_ids: bool = True,
) -> DataFrame:
    """All texts as token sequences of at most ``size`` ids; one row per piece.

    Columns: id_col, piece, start, length, ids, ids_crc32, sequence_id, offset. A
    null or empty text is one piece that holds the separator alone. Repeated rows
    are packed each; an empty table gives no rows. Texts are tokenized once: the
    pieces are written to the shared folder, then counted and placed.
    """
    pieces = stored(token_pieces(docs, id_col, text_col, size, encoder, with_ids), "pieces")
    return place_pieces(pieces, size).withColumnRenamed("id", id_col)
