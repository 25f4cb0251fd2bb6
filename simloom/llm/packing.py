"""Filling containers of a fixed number of tokens: harmonic packing.

Texts are measured by a public tokenizer.  A size between C/(j+1) (exclusive)
and C/j (inclusive) is of class j, and a container of class j takes exactly j
texts of it, whatever their sizes; classes beyond the last are merged into one
that is filled next-fit.  A class is filled independently of all others, and
inside a class every task fills its own slice, ``LOT`` texts at a time, so nothing is
ordered globally and no task holds more: each lot leaves one open container a class
at most, and the open ones are merged in a second, small pass, ``OPEN`` of them a task.

A text longer than a container is cut into whole containers and a rest, which
is packed like a text of its own; no other text is cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import runtime

CAPACITY = 8192
#: Sizes of at most CAPACITY / CLASSES are one class.
CLASSES = 64
#: Texts that a task fills into containers at a time, and open containers that one task merges.
LOT, OPEN = 1 << 18, 2048
#: Characters handed to the tokenizer at a time; a longer text is cut at white space.
PIECE = 1 << 16


def tiktoken_counter(path: str | None = None, pattern: str | None = None) -> Callable[[list[str]], list[int]]:
    """Counts tokens with a byte-level BPE vocabulary file in tiktoken's format.

    ``path`` defaults to the installed public 50k vocabulary.  Special tokens'
    strings in a text are ordinary text.
    """
    import base64

    import tiktoken

    if path is None or pattern is None:
        import public_tokenizers

        path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
        pattern = pattern or public_tokenizers.PATTERN
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def count(texts: list[str]) -> list[int]:
        return [len(coder.encode_ordinary(text)) for text in texts]

    return count


def pieces(text: str, size: int = PIECE) -> list[str]:
    """``text`` in parts of about ``size`` characters, cut before white space where there is some.

    Byte-level patterns never join a word with the white space before the
    previous one, so the parts' token counts add up to the text's.
    """
    if len(text) <= size:
        return [text]
    out, lo = [], 0
    while lo < len(text):
        hi = min(len(text), lo + size)
        if hi < len(text):
            at = hi
            while at > lo + 1 and not (text[at] == " " and text[at - 1].isalnum()):
                at -= 1
            if at > lo + 1:
                hi = at
        out.append(text[lo:hi])
        lo = hi
    return out


def token_counts(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    counter: Callable[[], Callable[[list[str]], list[int]]] = tiktoken_counter,
) -> DataFrame:
    """(doc_id, tokens): the tokens of every non-null text, with whole texts counted.

    ``counter`` makes the counting function; it is called once per worker task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for batch in batches:
            count = count or counter()
            parts = [pieces(t) for t in batch.column(1).to_pylist()]
            flat = count([p for ps in parts for p in ps])
            ends = np.cumsum([len(ps) for ps in parts])
            sums = np.concatenate([[0], np.cumsum(flat)])
            tokens = sums[ends] - sums[np.concatenate([[0], ends[:-1]])] if len(ends) else np.empty(0)
            yield pa.record_batch([batch.column(0), pa.array(tokens.astype(np.int64))], ["doc_id", "tokens"])

    source = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.filter("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(run, "doc_id long, tokens long")


def cut_texts(packed: DataFrame) -> DataFrame:
    """(doc_id): the texts that stand in several containers, that is those longer than one."""
    return packed.filter("part > 0").select("doc_id").distinct()


def _fill(sizes: np.ndarray, capacity: int, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """(container, class) of each size; containers numbered from 0 within the call."""
    kind = np.minimum(capacity // np.maximum(sizes, 1), classes)
    bins = np.empty(len(sizes), np.int64)
    used = 0
    for c in np.unique(kind):
        at = np.nonzero(kind == c)[0]
        if c < classes:
            number = np.arange(len(at)) // c
        else:  # next-fit by running sums: a container begins where the sum would overflow
            upto = np.concatenate([[0], np.cumsum(sizes[at])])
            begins, lo = [], 0
            while lo < len(at):
                begins.append(lo)
                lo = max(lo + 1, int(np.searchsorted(upto, upto[lo] + capacity, side="right")) - 1)
            number = np.searchsorted(begins, np.arange(len(at)), side="right") - 1
        bins[at] = used + number
        used += int(number[-1]) + 1
    return bins, kind


def pack(counts: DataFrame, capacity: int = CAPACITY, classes: int = CLASSES) -> DataFrame:
    """(container, doc_id, part, tokens): every text in containers of ``capacity`` tokens.

    ``part`` numbers the pieces of a text from 0; only a text longer than a
    container has several.  Empty texts take no room and go with any container.
    Ids that come several times are placed as often.  Container names are unique
    but in no order.  Result defined up to the choice of the slices; the sizes
    in a container never exceed the capacity.  An empty table gives an empty result.
    """
    spark = counts.sparkSession
    parts = counts.select(
        "doc_id",
        F.col("tokens"),
        F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("tokens") / capacity) - 1, F.lit(0)).cast("int"))).alias("part"),
    ).select(
        "doc_id",
        "part",
        F.least(F.lit(capacity), F.col("tokens") - F.col("part") * capacity).cast("long").alias("tokens"),
    )

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        slice_no = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []
        rows = done = 0

        def filled() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            sizes = table["tokens"].to_numpy()
            bins, kind = _fill(sizes, capacity, classes)
            number = np.bincount(bins)
            load = np.bincount(bins, weights=sizes)
            # a container of class j is closed with j texts; of the last class if half full at least
            closed = np.where(kind < classes, number[bins] >= kind, load[bins] * 2 >= capacity)
            names = pa.array([f"{slice_no}-{done}-{b}" for b in range(len(number))], pa.string())
            return pa.record_batch(
                [
                    names.take(pa.array(bins)),
                    table["doc_id"].combine_chunks(),
                    table["part"].combine_chunks(),
                    table["tokens"].combine_chunks(),
                    pa.array(closed),
                ],
                ["container", "doc_id", "part", "tokens", "closed"],
            )

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= LOT:
                yield filled()
                held, rows, done = [], 0, done + 1
        if rows:
            yield filled()

    schema = "container string, doc_id long, part int, tokens long, closed boolean"
    # slices as large as the session's partitions; the content decides the order in them
    sliced = parts.repartition(runtime.fan_out(counts, copies=0.2), "doc_id").sortWithinPartitions("doc_id", "part")
    first = runtime.written(sliced.mapInArrow(fill, schema), "packed")
    done = first.filter("closed").select("container", "doc_id", "part", "tokens")
    # what the slices left open: at most classes * classes texts a slice; sized again by first-fit decreasing
    left = first.filter("NOT closed")
    lots = left.groupBy("container").agg(F.sum("tokens").alias("size"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        sizes = table["size"].to_numpy()
        order = np.argsort(-sizes, kind="stable")
        room: list[int] = []
        into = np.empty(len(sizes), np.int64)
        for at in order:  # first fit over the open lots of a few slices
            size = int(sizes[at])
            for b, r in enumerate(room):
                if size <= r:
                    break
            else:
                b = len(room)
                room.append(capacity)
            room[b] -= size
            into[at] = b
        names = [f"open-{TaskContext.get().partitionId()}-{b}" for b in into]
        yield pa.record_batch([table["container"].combine_chunks(), pa.array(names)], ["container", "merged"])

    few = max(1, -(-lots.count() // OPEN))
    merged = lots.repartition(few, "container").sortWithinPartitions("container")
    merged = merged.mapInArrow(merge, "container string, merged string")
    rest = left.join(merged, "container").select(F.col("merged").alias("container"), "doc_id", "part", "tokens")
    return done.unionByName(rest)


def container_fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row (containers, texts, tokens, fill): how well the containers are filled."""
    loads = packed.groupBy("container").agg(F.sum("tokens").alias("load"), F.count("*").alias("c"))
    return loads.agg(
        F.count("*").alias("containers"),
        F.sum("c").alias("texts"),
        F.sum("load").alias("tokens"),
        F.round(F.sum("load") / (F.count("*") * capacity), 4).alias("fill"),
    )
