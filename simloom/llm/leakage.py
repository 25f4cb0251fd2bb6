"""Evaluation texts in training texts: a distributed positional inverted index.

The index holds the postings of every word of the corpus.  It is cut by documents:
a segment is the inverted file of some ``SEGMENT_CHARS`` characters of text, the
sorted terms of these documents and, for each term, the ascending positions at which
it stands.  Segments are built where the text is read and stored as they are, so no
posting is ever shuffled; an index in a folder is added to, opened again, and
searched by any number of item sets without a look at the texts.

A search takes the items to the segments:

1. every run of ``words`` consecutive item words has an anchor, its pair of
   neighbouring words that is rarest in the segment; runs with a word that the
   segment lacks are nowhere in it;
2. the anchor's two lists of positions, offset-adjusted by one, are intersected, the
   shorter one looked up in the longer; less the anchor's place in the item this gives
   the diagonals of (document, item) that can hold a passage;
3. on these diagonals the postings of all the item's terms are compared, and runs of
   consecutive hits (with ``slop``, of hits with small gaps) are the passages.

The items' words are sent to all workers, at most ``MAX_ITEM_WORDS`` at a time; more
items are searched in several passes.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import runtime

#: Words of all items together that are sent to the workers at a time.
MAX_ITEM_WORDS = 4_000_000
WORDS = 12
#: Characters of the texts of one segment (one longer text is a segment of its own).
SEGMENT_CHARS = 8 << 20
#: Places of diagonals that are compared at a time.
GRID = 1 << 22

_WORD = re.compile(r"[^\W_]+")
_SEGMENT = "docs binary, starts binary, terms binary, counts binary, gaps binary"


def words_of(text: str) -> list[str]:
    """Maximal runs of letters and digits of the lower-cased text."""
    return _WORD.findall(text.lower())


def term_numbers(words: list[str]) -> np.ndarray:
    """64-bit hashes that stand for words; that two words of a collection share one is left to chance (about 2^-64 a pair)."""
    digests = b"".join(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest() for w in words)
    return np.frombuffer(digests, np.int64)


def build_segment(docs: list[int], texts: list[list[str]]) -> list[bytes]:
    """The inverted file of tokenised documents, as the columns of ``_SEGMENT``.

    Positions run on from one document to the next.  A term's positions are stored as
    its first one and the gaps between them.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    flat = pa.array([w for t in texts for w in t], pa.string()).dictionary_encode()
    number = term_numbers(flat.dictionary.to_pylist())
    terms, place = np.unique(number, return_inverse=True)
    code = place[flat.indices.to_numpy()] if len(flat) else np.empty(0, np.int64)
    position = np.argsort(code, kind="stable")
    counts = np.bincount(code, minlength=len(terms))
    gaps = np.diff(position, prepend=0)
    first = np.cumsum(counts) - counts
    gaps[first] = position[first]
    columns = (np.array(docs, np.int64), starts.astype(np.int64), terms, counts.astype(np.uint32), gaps.astype(np.uint32))
    return [c.tobytes() for c in columns]


class Segment:
    """A stored inverted file, opened."""

    def __init__(self, docs: bytes, starts: bytes, terms: bytes, counts: bytes, gaps: bytes):
        self.docs, self.starts, self.terms = (np.frombuffer(x, np.int64) for x in (docs, starts, terms))
        self.counts = np.frombuffer(counts, np.uint32).astype(np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        upto = np.cumsum(np.frombuffer(gaps, np.uint32).astype(np.int64))
        base = np.concatenate([[0], upto])[self.first]
        self.positions = upto - np.repeat(base, self.counts)
        # the same postings by position: which term stands there
        self.term_at = np.empty(len(self.positions), np.int32)
        self.term_at[self.positions] = np.repeat(np.arange(len(self.terms), dtype=np.int32), self.counts)

    def codes(self, numbers: np.ndarray) -> np.ndarray:
        """Places of terms in the segment, -1 for those it lacks."""
        if len(self.terms) == 0:
            return np.full(len(numbers), -1, np.int64)
        at = np.minimum(np.searchsorted(self.terms, numbers), len(self.terms) - 1)
        return np.where(self.terms[at] == numbers, at, -1)

    def list_of(self, code: int) -> np.ndarray:
        return self.positions[self.first[code] : self.first[code] + self.counts[code]]

    def followed(self, one: int, two: int) -> np.ndarray:
        """Positions at which the term ``one`` stands right before ``two``."""
        a, b = self.list_of(one), self.list_of(two)
        if len(a) <= len(b):
            at = np.minimum(np.searchsorted(b, a + 1), len(b) - 1)
            return a[b[at] == a + 1]
        at = np.minimum(np.searchsorted(a, b - 1), len(a) - 1)
        return b[a[at] == b - 1] - 1

    def anchors(self, code: np.ndarray, need: int) -> np.ndarray:
        """Places in an item of the rarest neighbouring words of every run of ``need`` words that can be here."""
        if len(code) < need:
            return np.empty(0, np.int64)
        count = np.where(code >= 0, self.counts[code], 0)
        rarity = (np.minimum(count[:-1], count[1:]) << 32) + np.maximum(count[:-1], count[1:])
        runs = np.lib.stride_tricks.sliding_window_view(rarity, need - 1)
        here = np.lib.stride_tricks.sliding_window_view(count, need).min(1) > 0
        return np.unique(runs.argmin(1)[here] + np.nonzero(here)[0])

    def passages(self, code: np.ndarray, words: int, slop: int) -> tuple[np.ndarray, ...]:
        """(document's place, first place in it, first place in the item, equal words) of the passages of one item."""
        need = words if slop == 0 else max(2, words // 2)
        none = np.empty(0, np.int64)
        shift, inside = [none], [none]
        for k in self.anchors(code, need).tolist():
            at = self.followed(code[k], code[k + 1])
            shift.append(at - k)
            inside.append(at)
        doc = np.searchsorted(self.starts, np.concatenate(inside), side="right") - 1
        lines = np.unique(np.stack([doc, np.concatenate(shift)], axis=1), axis=0)
        out = [(none,) * 4]
        step = max(1, GRID // len(code))
        for lo in range(0, len(lines), step):
            doc, shift = lines[lo : lo + step].T
            place = shift[:, None] + np.arange(len(code))
            within = (place >= self.starts[doc][:, None]) & (place < self.starts[doc + 1][:, None])
            equal = within & (self.term_at[np.where(within, place, 0)] == code)
            i, j = np.nonzero(equal)
            if len(i) == 0:
                continue
            apart = np.concatenate([[True], (np.diff(i) != 0) | (np.diff(j) > slop + 1)])
            torn = np.concatenate([[True], (np.diff(i) != 0) | (np.diff(j) > 1)])
            run = np.cumsum(apart) - 1
            count = np.bincount(run)
            # the longest unbroken stretch of each run
            stretch = np.cumsum(torn) - 1
            longest = np.zeros(len(count), np.int64)
            np.maximum.at(longest, run[torn], np.bincount(stretch))
            keep = (count >= words) & (longest >= need)
            i, j = i[apart][keep], j[apart][keep]
            out.append((doc[i], shift[i] + j - self.starts[doc[i]], j, count[keep]))
        return tuple(np.concatenate(x) for x in zip(*out))


class CorpusIndex:
    """Segments of a corpus in a folder that all executors share; a manifest names the runs that are whole."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or f"{runtime.scratch(spark)}/corpus-{uuid.uuid4().hex}"
        held = runtime.read_manifest(spark, self.folder)
        self.runs: list[str] = json.loads(held)["runs"] if held else []

    def add(self, corpus: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> None:
        """Index the texts of ``corpus``; null ids and texts are left out."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            docs: list[int] = []
            texts: list[list[str]] = []
            size = 0

            def segment() -> pa.RecordBatch:
                return pa.record_batch(
                    [pa.array([c], pa.binary()) for c in build_segment(docs, texts)], [f.split()[0] for f in _SEGMENT.split(", ")]
                )

            for batch in batches:
                for doc, text in zip(batch.column(0), batch.column(1)):
                    docs.append(doc.as_py())
                    text = text.as_py()
                    texts.append(words_of(text))
                    size += len(text)
                    if size >= SEGMENT_CHARS:
                        yield segment()
                        docs, texts, size = [], [], 0
            if docs:
                yield segment()

        source = corpus.select(F.col(doc_col).cast("long").alias("d"), F.col(text_col).alias("t"))
        segments = source.filter("d IS NOT NULL AND t IS NOT NULL").mapInArrow(run, _SEGMENT)
        name = f"run-{uuid.uuid4().hex}"
        segments.write.option("compression", "zstd").parquet(f"{self.folder}/{name}")
        runtime.publish_manifest(self.spark, self.folder, json.dumps({"runs": [*self.runs, name]}))
        self.runs.append(name)

    def search(self, sequences: list[tuple[str, ...]], owners: list[list[int]], words: int, slop: int = 0) -> DataFrame:
        """(doc_id, item_id, doc_from, item_from, run) of word sequences and the ids of the items that consist of them."""
        schema = "doc_id long, item_id long, doc_from int, item_from int, run int"
        if not self.runs:
            return self.spark.createDataFrame([], schema)
        ends = np.cumsum([len(s) for s in sequences])
        number = term_numbers([w for s in sequences for w in s])
        shared = self.spark.sparkContext.broadcast((number, ends, owners))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            numbers, upto, ids = shared.value
            for batch in batches:
                for row in zip(*(batch.column(i) for i in range(5))):
                    segment = Segment(*(x.as_py() for x in row))
                    codes = np.split(segment.codes(numbers), upto[:-1])
                    out: list[list[np.ndarray]] = [[], [], [], [], []]
                    for code, own in zip(codes, ids):
                        doc, place, start, count = segment.passages(code, words, slop)
                        for item in own if len(doc) else []:
                            for column, value in zip(out, (segment.docs[doc], np.full(len(doc), item), place, start, count)):
                                column.append(value)
                    if out[0]:
                        whole = [np.concatenate(c) for c in out]
                        yield pa.record_batch(
                            [pa.array(c.astype(np.int64 if n < 2 else np.int32)) for n, c in enumerate(whole)],
                            ["doc_id", "item_id", "doc_from", "item_from", "run"],
                        )

        table = self.spark.read.schema(_SEGMENT).parquet(*(f"{self.folder}/{r}" for r in self.runs))
        return table.mapInArrow(run, schema)


def _item_groups(items: DataFrame, id_col: str, text_col: str, words: int) -> Iterator[dict[tuple[str, ...], list[int]]]:
    """Distinct word sequences of items that are long enough, with their ids, ``MAX_ITEM_WORDS`` words at a time."""
    rows = items.select(F.col(id_col).cast("long"), F.col(text_col)).filter(
        F.col(id_col).isNotNull() & F.col(text_col).isNotNull()
    )
    held: dict[tuple[str, ...], list[int]] = defaultdict(list)
    total = 0
    for item, text in rows.distinct().toLocalIterator():
        found = tuple(words_of(text))
        if len(found) < words:
            continue
        if found not in held:
            total += len(found)
        held[found].append(item)
        if total >= MAX_ITEM_WORDS:
            yield held
            held, total = defaultdict(list), 0
    if held:
        yield held


def leaked_passages(
    corpus: DataFrame | None,
    items: DataFrame,
    words: int = WORDS,
    doc_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    slop: int = 0,
    index: CorpusIndex | None = None,
) -> DataFrame:
    """(doc_id, item_id, doc_from, item_from, run): common runs of ``words`` words or more.

    With ``slop`` 0 a run is exact: consecutive words on both sides, as long as
    possible.  With a larger ``slop`` it is a proximity match: up to ``slop``
    consecutive item words may differ inside a run, which still has ``words``
    equal ones, half as many of them unbroken; ``run`` counts the equal words.

    ``corpus`` is indexed first, in ``index`` if one is given; without ``corpus`` the texts
    that ``index`` has are searched, none of them is read again.

    Places are word positions from 0.  Null ids and texts on either side have no
    rows; items shorter than ``words`` words cannot leak; items of equal words
    come out each; rows under one document id are searched one by one and their equal
    results come once.  Empty tables give an empty result.  ``words`` must be 2 or more.
    """
    if words < 2:
        raise ValueError("a passage has two words at least")
    spark = items.sparkSession
    if index is None:
        index = CorpusIndex(spark)
    if corpus is not None:
        index.add(corpus, doc_col, text_col)
    out = spark.createDataFrame([], "doc_id long, item_id long, doc_from int, item_from int, run int")
    for group in _item_groups(items, item_col, item_text_col, words):
        out = out.unionByName(index.search(list(group), list(group.values()), words, slop))
    return out.distinct()
