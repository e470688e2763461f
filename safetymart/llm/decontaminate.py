"""Benchmark decontamination by a suffix automaton over the words of test items."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from safetymart.llm.common import LOWER, dropped, row_chunks, stored, text_bytes, unused

# The bytes that words are made of, after lower-casing.
_WORD = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TO_WORDS = bytes(LOWER[b] if LOWER[b] in _WORD else 0x20 for b in range(256))
_WORD_BYTES = re.compile(rb"[^ ]+")

# Item words that one automaton holds. Its size in memory is in proportion, so a
# block is what is broadcast at a time; larger benchmarks take more passes.
BLOCK_WORDS = 100_000
CHUNK_BYTES = 4 << 20

SPAN = "struct<first:int,last:int,start:int,end:int>"
LEAK = f"struct<n_words:bigint,n_hit:bigint,spans:array<{SPAN}>,items:array<bigint>>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


class SuffixAutomaton:
    """All word sequences of some items, and which windows of them count.

    A window is ``window`` consecutive words of an item, or a whole shorter item.
    The automaton has a state per set of equal end places; ``length`` is the
    longest sequence of a state, ``link`` the state of its longest suffix that
    ends in more places.
    """

    def __init__(self, items: Iterable[tuple[int | None, bytes]], window: int):
        self.window = window
        self.word_id: dict[bytes, int] = {}
        self.length, self.link = [0], [-1]
        self.next: list[dict[int, int]] = [{}]
        coded = []
        for item_id, text in items:
            words = [self.word_id.setdefault(w, len(self.word_id)) for w in words_of(text)]
            if words:
                coded.append((item_id, words))
                last = 0
                for w in words:
                    last = self._extend(last, w)
        # Windows of full length by the state that holds them, short items by theirs.
        self.full: dict[int, set] = {}
        self.short: dict[int, list[tuple[int, int | None]]] = {}
        pairs = set()
        self.shortest = window
        for item_id, words in coded:
            pairs.update(zip(words, words[1:]))
            state = 0
            for i, w in enumerate(words, 1):
                state = self.next[state][w]
                if i >= window:
                    self.full.setdefault(self._holder(state, window), set()).add(item_id)
            if len(words) < window:
                holder = self._holder(state, len(words))
                self.short.setdefault(holder, []).append((len(words), item_id))
                self.shortest = min(self.shortest, len(words))
        size = max(1, len(self.word_id))
        self.pairs = np.array(sorted(a * size + b for a, b in pairs), np.int64)
        self.pair_bits = np.zeros(1 << 20, bool)
        self.pair_bits[self.pairs & 0xFFFFF] = True

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        return len(self.length) - 1

    def _split(self, state: int, word: int) -> int:
        """The state after ``word`` whose longest sequence continues ``state``'s."""
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, self.link[target], {**self.next[target]})
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new = self._state(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word)
        return new

    def _holder(self, state: int, n: int) -> int:
        """The state of the last ``n`` words of ``state``'s sequences."""
        while self.length[self.link[state]] >= n and state:
            state = self.link[state]
        return state

    def stream(self, words: list[int], at: int, hit: np.ndarray, items: set) -> None:
        """Feed words; mark the windows they complete in ``hit`` from ``at`` on."""
        state = matched = 0
        for i, w in enumerate(words, at + 1):
            while state and w not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if w not in self.next[state]:
                continue
            state, matched = self.next[state][w], matched + 1
            if matched >= self.window:
                hit[i - self.window : i] = True
                items |= self.full.get(self._holder(state, self.window), set())
            if self.short:
                suffix = state
                while suffix > 0:
                    for n, item_id in self.short.get(suffix, ()):
                        if n <= matched:
                            hit[i - n : i] = True
                            items.add(item_id)
                    suffix = self.link[suffix]

    def linked(self, ids: np.ndarray) -> np.ndarray:
        """Whether each word and the next follow each other in any item."""
        left, right = ids[:-1].astype(np.int64), ids[1:].astype(np.int64)
        key = left * max(1, len(self.word_id)) + right
        ok = (left >= 0) & (right >= 0) & self.pair_bits[key & 0xFFFFF]
        at = np.flatnonzero(ok)
        place = np.searchsorted(self.pairs, key[at])
        found = self.pairs[np.minimum(place, len(self.pairs) - 1)] == key[at]
        ok[at] = found
        return ok

    def scan(self, text: bytes, ends: np.ndarray) -> tuple:
        """Hits and items of adjoining documents; ``ends`` are their last bytes.

        Words are looked up all at once. Only runs in which each two neighbours
        are neighbours in an item too can hold a window; these are streamed.
        """
        flat = text.translate(_TO_WORDS)
        words: list[bytes] = []
        counts, start = [], 0
        for end in ends:
            own = flat[start:end].split()
            words += own
            counts.append(len(own))
            start = end
        first = np.concatenate([[0], np.cumsum(counts)])
        lookup = self.word_id.get
        ids = np.fromiter((lookup(w, -1) for w in words), np.int32, len(words))
        hit = np.zeros(len(words), bool)
        items: dict[int, set] = {}
        if len(ids) and len(self.word_id):
            joined = np.zeros(len(ids) + 1, bool)
            if len(self.pairs) and len(ids) > 1:
                joined[1:-1] = self.linked(ids)
            joined[first] = False
            begins = np.flatnonzero(~joined[:-1])
            stops = np.append(begins[1:], len(ids))
            long = (stops - begins >= self.shortest) & (ids[begins] >= 0)
            docs = np.searchsorted(first, begins[long], "right") - 1
            for b, e, d in zip(begins[long], stops[long], docs):
                self.stream(ids[b:e].tolist(), int(b), hit, items.setdefault(int(d), set()))
        return first, hit, items


def _spans(text: bytes, hit: np.ndarray) -> list[dict]:
    """Maximal runs of hit words, with the bytes they take."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    if not len(edge):
        return []
    at = [m.span() for m in _WORD_BYTES.finditer(text.translate(_TO_WORDS))]
    return [
        {"first": int(a), "last": int(b - 1), "start": at[a][0], "end": at[b - 1][1]}
        for a, b in zip(edge[::2], edge[1::2])
    ]


def _scan_batches(automaton, text_col: str, leak: str, schema: pa.Schema):
    leak_type = schema.field(leak).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = automaton.value
        for batch in batches:
            data, starts = text_bytes(batch.column(text_col))
            found: list[dict] = []
            for a, b in row_chunks(starts, CHUNK_BYTES):
                raw = data[starts[a] : starts[b]].tobytes()
                ends = starts[a + 1 : b + 1] - starts[a]
                first, hit, items = model.scan(raw, ends)
                n_hit = np.concatenate([[0], np.cumsum(hit)])[first]
                for d in range(b - a):
                    n = int(n_hit[d + 1] - n_hit[d])
                    own = raw[starts[a + d] - starts[a] : ends[d]] if n else b""
                    spans = _spans(own, hit[first[d] : first[d + 1]]) if n else []
                    ids = sorted(i for i in items.get(d, ()) if i is not None)
                    n_words = int(first[d + 1] - first[d])
                    found.append(
                        {"n_words": n_words, "n_hit": n, "spans": spans, "items": ids}
                    )
            if leak in batch.schema.names:  # a later block: together with the earlier
                found = [_merged(x, y) for x, y in zip(batch.column(leak).to_pylist(), found)]
            columns = [c for c in batch.schema.names if c != leak]
            arrays = [batch.column(c) for c in columns] + [pa.array(found, leak_type)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, leak])

    return run


def _merged(x: dict, y: dict) -> dict:
    spans: list[dict] = []
    for s in sorted(x["spans"] + y["spans"], key=lambda s: (s["first"], s["last"])):
        if spans and s["first"] <= spans[-1]["last"] + 1:
            if s["last"] > spans[-1]["last"]:
                spans[-1] = {**spans[-1], "last": s["last"], "end": s["end"]}
        else:
            spans.append(s)
    return {
        "n_words": x["n_words"],
        "n_hit": sum(s["last"] - s["first"] + 1 for s in spans),
        "spans": spans,
        "items": sorted({*x["items"], *y["items"]}),
    }


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    into: str = "leak",
) -> DataFrame:
    """``docs`` with a struct ``into``: which words of each text stand in test items.

    A word is hit if it lies in an occurrence of ``window`` consecutive words of
    an item, or of a whole shorter item. ``spans`` are the maximal runs of hit
    words, as word numbers and as bytes of the text; ``items`` the ids of items
    with an occurring window, each once. A null or empty text has no words, an
    item without words no windows; an item with a null id marks words but is not
    listed; repeated rows each get their own result. A column named ``into``
    would be replaced. No shuffle; items are collected in blocks of about
    ``BLOCK_WORDS`` words, for each of which the documents are passed once. Of more
    blocks than one, each pass but the last is written to the shared folder, so that
    one block's automaton is broadcast at a time and one pass is on disk.
    """
    spark = docs.sparkSession
    texts = items.select(
        F.col(item_id_col).cast("long").alias("id"),
        F.encode(F.coalesce(F.col(item_text_col), F.lit("")), "UTF-8").alias("text"),
    )
    # A word takes two bytes at least, with what parts it from the next.
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / 2 / BLOCK_WORDS))
    dealt = texts.withColumn("block", F.pmod(F.xxhash64("text", "id"), F.lit(blocks)))
    docs = docs.drop(into)
    leak = T.StructField(into, T._parse_datatype_string(LEAK))
    schema = T.StructType([*docs.schema.fields, leak])
    arrow = pa.schema([(into, _arrow_type())])
    passed = None
    for block in range(blocks):
        rows = dealt.filter(F.col("block") == block).select("id", "text").collect()
        model = SuffixAutomaton(((r["id"], bytes(r["text"])) for r in rows), window)
        shared = spark.sparkContext.broadcast(model)
        docs = docs.mapInArrow(_scan_batches(shared, text_col, into, arrow), schema)
        if block + 1 < blocks:
            docs, before = stored(docs, "passed"), passed
            passed = docs
            shared.unpersist()
            if before is not None:
                dropped(before)
    return docs


def _arrow_type() -> pa.DataType:
    span = pa.struct([(n, pa.int32()) for n in ("first", "last", "start", "end")])
    return pa.struct(
        [
            ("n_words", pa.int64()),
            ("n_hit", pa.int64()),
            ("spans", pa.list_(span)),
            ("items", pa.list_(pa.int64())),
        ]
    )


def remove_leaks(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    max_coverage: float = 0.5,
    **names,
) -> DataFrame:
    """``docs`` without the words that stand in test items.

    Every span that ``find_leaks`` reports is cut out of its text. A document of
    which more than ``max_coverage`` of the words are hit goes as a whole. Other
    texts, null ones too, stay as they are. Same columns as ``docs``.
    """
    leak = unused(docs, "leak")
    found = find_leaks(docs, items, text_col, into=leak, **names)
    kept = found.filter(F.col(f"{leak}.n_hit") <= max_coverage * F.col(f"{leak}.n_words"))
    raw = F.encode(F.col(text_col), "UTF-8")
    spans = F.col(f"{leak}.spans")
    # The kept pieces lie between the end of a span and the start of the next.
    ends = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    starts = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.octet_length(text_col)))
    pieces = F.zip_with(
        ends, starts, lambda a, b: F.decode(F.substring(raw, a + 1, b - a), "UTF-8")
    )
    cut = F.when(F.size(spans) > 0, F.array_join(pieces, "")).otherwise(F.col(text_col))
    return kept.withColumn(text_col, cut).select(*docs.columns)
