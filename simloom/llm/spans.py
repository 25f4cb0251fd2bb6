"""Long exact spans shared between records: a log-structured fingerprint index.

Every text is fingerprinted by winnowing: of the hashes of its ``GRAM``-long
windows, the smallest of each run of ``least - GRAM + 1`` neighbours is kept, so
any span of ``least`` characters that two texts share yields a fingerprint in
both, at the same place of the span.

The index is log-structured.  A batch of texts becomes a run: its fingerprints,
cut into buckets by hash and sorted, written once and never changed.  A new batch is
merge-joined with the runs that are there: all are cut into the same buckets, so
neither the batch nor the history is shuffled again, and only counts and the hits
come out.  Runs are compacted into one when there are more than ``MAX_RUNS``.  A
manifest in the index's folder names the runs in force; it is replaced only after
a run is whole, so an index can be opened again, and a failed call changes nothing.

Hits are verified on the texts: the window's surroundings are fetched from the
documents with hits (a Bloom filter of fixed size keeps the others out of the
join), compared, and extended to both sides.  A hash with very many texts is
cut into pairs of blocks.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import bloom, grouping, runtime

LEAST = 300
#: Length of a hashed window.
GRAM = 192
#: Rows of one fingerprint that one group holds; beyond it, groups are pairs of blocks.
BLOCK = 4096
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xBF58476D1CE4E5B9)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def window_hashes(points: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hashes of all windows of ``gram`` code points, by doubling: a few vector passes, no loop over the text."""
    if len(points) < gram:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        value = (points.astype(np.uint64) + np.uint64(1)) * _MIX[0]
        value ^= value >> np.uint64(32)
        power, width, done, whole = _BASE, 1, 0, None
        while True:
            if gram & width:  # the window is put together from powers of two, left to right
                if whole is None:
                    whole = value
                else:
                    length = len(points) - (done + width) + 1
                    whole = whole[:length] * power + value[done : done + length]
                done += width
            if done == gram:
                break
            value = value[:-width] * power + value[width:]
            power = power * power
            width *= 2
        whole = whole ^ (whole >> np.uint64(29))
        whole *= _MIX[1]
        whole ^= whole >> np.uint64(32)
    return whole


def _running_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    done = 1
    out = values
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    if done < width:
        out = np.minimum(out[: len(out) - (width - done)], out[width - done :])
    return out


def winnow(points: np.ndarray, least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of the kept windows: where a window is the minimum of some run it stands in."""
    hashes = window_hashes(points, gram)
    run = least - gram + 1
    if len(hashes) < run:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    low = _running_min(hashes, run)
    # a window is kept if a run that covers it has it as its minimum: the largest of the minima around it
    pad = np.zeros(run - 1, np.uint64)
    around = ~_running_min(~np.concatenate([pad, low, pad]), run)
    places = np.nonzero(hashes == around)[0]
    return hashes[places], places


def fingerprints(df: DataFrame, id_col: str, text_col: str, least: int = LEAST, gram: int = GRAM) -> DataFrame:
    """(h, doc_id, at): the kept windows of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, d, p = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(text) < least:
                    continue
                kept, places = winnow(code_points(text), least, gram)
                h.append(kept)
                p.append(places)
                d.append(np.full(len(kept), doc, np.int64))
            if h:
                yield pa.record_batch(
                    [np.concatenate(h).view(np.int64), np.concatenate(d), np.concatenate(p).astype(np.int32)],
                    ["h", "doc_id", "at"],
                )

    source = df.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("t"))
    return source.filter(f"d IS NOT NULL AND length(t) >= {int(least)}").mapInArrow(run, "h long, doc_id long, at int")


class SpanIndex:
    """Runs of fingerprints in a folder that all executors share.

    Opening a ``folder`` that holds an index goes on with it.  With ``texts`` the index
    keeps the texts of its batches too, so that later batches can be verified
    against them without the earlier documents at hand.
    """

    MAX_RUNS = 4
    SCHEMA = "h long, doc_id long, at int"

    def __init__(
        self,
        spark: SparkSession,
        folder: str | None = None,
        least: int = LEAST,
        gram: int = GRAM,
        texts: bool = False,
    ):
        self.spark, self.least, self.gram, self.texts = spark, least, gram, texts
        self.folder = folder or f"{runtime.scratch(spark)}/spans-{uuid.uuid4().hex}"
        self.runs: list[str] = []
        self.kept: list[str] = []
        self.buckets = 0
        held = runtime.read_manifest(spark, self.folder)
        if held is not None:
            known = json.loads(held)
            self.least, self.gram, self.texts = known["least"], known["gram"], known["texts"]
            self.runs, self.kept, self.buckets = known["runs"], known["kept"], known["buckets"]
        if not 0 < self.gram <= self.least:
            raise ValueError("the window must be within the least span")

    def _publish(self, runs: list[str], kept: list[str]) -> None:
        known = {"least": self.least, "gram": self.gram, "texts": self.texts, "runs": runs, "kept": kept, "buckets": self.buckets}
        runtime.publish_manifest(self.spark, self.folder, json.dumps(known))
        self.runs, self.kept = runs, kept

    def _read(self, run: str) -> DataFrame:
        """A run as a bucketed table: joins and sums by hash need no shuffle."""
        name = f"span_run_{uuid.uuid5(uuid.NAMESPACE_URL, f'{self.folder}/{run}').hex}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (h BIGINT, doc_id BIGINT, at INT) USING parquet "
            f"CLUSTERED BY (h) SORTED BY (h) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{run}'"
        )
        return self.spark.table(name)

    def _forget(self, run: str) -> None:
        """Delete a run that is no longer in force."""
        name = f"span_run_{uuid.uuid5(uuid.NAMESPACE_URL, f'{self.folder}/{run}').hex}"
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        runtime.remove(self.spark, f"{self.folder}/{run}")

    def _write(self, rows: DataFrame) -> str:
        run = f"run-{uuid.uuid4().hex}"
        name = f"span_run_{uuid.uuid5(uuid.NAMESPACE_URL, f'{self.folder}/{run}').hex}"
        (
            rows.repartition(self.buckets, "h")
            .write.format("parquet")
            .bucketBy(self.buckets, "h")
            .sortBy("h")
            .option("path", f"{self.folder}/{run}")
            .saveAsTable(name)
        )
        return run

    def history(self) -> DataFrame:
        """(doc_id, text) of all batches, if the index keeps texts."""
        table = self.spark.read.schema("doc_id long, text string")
        return table.parquet(*(f"{self.folder}/{k}" for k in self.kept))

    def add(self, batch: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(h, doc_id, at, c): fingerprints that a text of this batch shares with another text.

        ``c`` is the number of rows of the hash.  The batch is part of the index afterwards.
        """
        if not self.buckets:
            self.buckets = runtime.fan_out(batch, copies=0.5)
        run = self._write(fingerprints(batch, id_col, text_col, self.least, self.gram))
        new = self._read(run)
        counted = [F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("c")]
        shared = new.groupBy("h").agg(*counted)
        met = []
        for number, old in enumerate(self.runs):
            # the history's rows of hashes that the batch has
            rows = self._read(old).join(new.select("h"), "h", "left_semi")
            met.append(rows)
            sums = rows.groupBy("h").agg(*counted).toDF("h", "l", "g", "k")
            shared = shared.join(sums, "h", "left").select(
                "h",
                F.least("lo", "l").alias("lo"),
                F.greatest("hi", "g").alias("hi"),
                (F.col("c") + F.coalesce("k", F.lit(0))).alias("c"),
            )
        shared = shared.filter("lo < hi").select("h", "c")
        hits = None
        for rows in [new, *met]:
            here = rows.join(shared, "h").select("h", "doc_id", "at", "c")
            hits = here if hits is None else hits.unionByName(here)
        hits = runtime.written(hits, "span-hits")
        kept = self.kept
        if self.texts:
            name = f"texts-{uuid.uuid4().hex}"
            texts = batch.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            texts.filter(f"doc_id IS NOT NULL AND length(text) >= {self.least}").write.parquet(f"{self.folder}/{name}")
            kept = [*kept, name]
        self._publish([*self.runs, run], kept)
        if len(self.runs) > self.MAX_RUNS:
            self.compact()
        return hits

    def compact(self) -> None:
        """All runs merged into one; the old ones are deleted once the manifest names it."""
        old, rows = self.runs, None
        for run in old:
            rows = self._read(run) if rows is None else rows.unionByName(self._read(run))
        size = runtime.input_bytes(rows) // runtime.PARTITION_BYTES + 1
        # every bucket is cut in two, again and again, once runs outgrow them
        before = self.buckets
        while self.buckets < size:
            self.buckets *= 2
        try:
            merged = self._write(rows)
        except BaseException:
            self.buckets = before
            raise
        self._publish([merged], self.kept)
        for run in old:
            self._forget(run)


def _surroundings(df: DataFrame, hits: DataFrame, id_col: str, text_col: str, least: int, gram: int) -> DataFrame:
    """(h, c, doc_id, at, lead, around): each hit with the characters within reach of its window."""
    places = hits.groupBy("doc_id").agg(F.collect_list(F.struct("h", "at", "c")).alias("places"))
    source = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    texts = bloom.likely(source.filter("text IS NOT NULL"), "doc_id", hits.select("doc_id"))
    reach = least - gram
    joined = texts.join(places, "doc_id").select("doc_id", "text", "places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, text, found in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for p in found:
                    lo = max(0, p["at"] - reach)
                    rows.append((p["h"], p["c"], doc, p["at"], p["at"] - lo, text[lo : p["at"] + gram + reach]))
            if rows:
                h, c, doc, at, lead, around = zip(*rows)
                yield pa.record_batch(
                    [
                        pa.array(h, pa.int64()),
                        pa.array(c, pa.int64()),
                        pa.array(doc, pa.int64()),
                        pa.array(at, pa.int32()),
                        pa.array(lead, pa.int32()),
                        pa.array(around, pa.string()),
                    ],
                    ["h", "c", "doc_id", "at", "lead", "around"],
                )

    return joined.mapInArrow(cut, "h long, c long, doc_id long, at int, lead int, around string")


def _padded(texts: list[str], leads: np.ndarray, reach: int, gram: int) -> np.ndarray:
    """Code points aligned on the window; unlike fillers where a text ends."""
    width = gram + 2 * reach
    out = np.empty((len(texts), width), np.int64)
    out[:] = -1 - np.arange(len(texts))[:, None]
    for k, (text, lead) in enumerate(zip(texts, leads)):
        points = code_points(text)
        out[k, reach - lead : reach - lead + len(points)] = points
    return out


def _same_window(table: pa.Table, least: int, gram: int, rows: int = 256) -> Iterable[pa.RecordBatch]:
    """Verified matches among the texts of one hash."""
    reach = least - gram
    doc, at, side = (table[c].to_numpy() for c in ("doc_id", "at", "side"))
    grid = _padded(table["around"].to_pylist(), table["lead"].to_numpy(), reach, gram)
    for lo in range(0, len(doc), rows):
        here = slice(lo, lo + rows)
        i, j = np.nonzero((doc[here, None] < doc[None, :]) & ((side[here, None] == 0) | (side[here, None] != side[None, :])))
        i += lo
        for part in range(0, len(i), 1 << 14):
            x, y = i[part : part + (1 << 14)], j[part : part + (1 << 14)]
            equal = grid[x] == grid[y]
            whole = equal[:, reach : reach + gram].all(1)
            left = np.cumprod(equal[:, :reach][:, ::-1], axis=1).sum(1)
            right = np.cumprod(equal[:, reach + gram :], axis=1).sum(1)
            keep = whole & (left + right >= reach)
            x, y, left, right = x[keep], y[keep], left[keep], right[keep]
            if len(x):
                yield pa.record_batch(
                    [
                        pa.array(doc[x]),
                        pa.array(doc[y]),
                        pa.array((at[x] - left).astype(np.int32)),
                        pa.array((at[y] - left).astype(np.int32)),
                        pa.array((left + gram + right).astype(np.int32)),
                    ],
                    ["doc_a", "doc_b", "from_a", "from_b", "run"],
                )


def shared_spans(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST,
    gram: int = GRAM,
    batches: int = 2,
    index: SpanIndex | None = None,
) -> DataFrame:
    """(doc_a, doc_b, from_a, from_b, run): verified common stretches, doc_a < doc_b.

    Each row is a stretch of at least ``least`` equal characters (code points as
    stored) around one fingerprint, extended by ``least - gram`` at most to
    either side; the rows of a longer stretch overlap and cover it.  Every pair
    of texts that shares ``least`` characters has a row.  The texts are taken in
    as ``batches`` batches, by a hash of the id, into ``index``, whose runs are
    compacted at the end.

    An ``index`` that holds earlier texts is searched as well: the rows are those of
    pairs with at least one text of ``df``.  It must keep the texts, as matches with them
    are verified.

    Null ids and texts and texts shorter than ``least`` have no rows; rows of one
    id are one record, compared with others only.  An empty table gives an empty
    result.  Other columns are ignored.
    """
    spark = df.sparkSession
    index = index or SpanIndex(spark, least=least, gram=gram)
    if index.runs and not index.texts:
        raise ValueError("the index holds earlier texts' fingerprints but not the texts to verify matches with")
    hits, earlier = None, bool(index.runs)
    ids = df.select(F.col(id_col).cast("long").alias("id")).distinct()
    for number in range(batches):
        part = df.filter(F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(batches)) == number) if batches > 1 else df
        found = index.add(part, id_col, text_col)
        hits = found if hits is None else hits.unionByName(found)
    if len(index.runs) > 1:  # the hits are written, so nothing reads the runs any more
        index.compact()
    # a hash hit in several batches comes with ever larger counts; its last has all its rows
    hits = runtime.written(hits.groupBy("h", "doc_id", "at").agg(F.max("c").alias("c")), "span-places")
    texts, id_col, text_col = (index.history(), "doc_id", "text") if index.texts else (df, id_col, text_col)
    around = _surroundings(texts, hits, id_col, text_col, index.least, index.gram)
    blocks = F.greatest(F.ceil(F.col("c") / BLOCK), F.lit(1)).cast("int")
    cut = around.withColumn("r", blocks).withColumn("own", F.pmod(F.xxhash64("doc_id", "at"), F.col("r")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("r") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(low == high, 0).when(F.col("own") == low, 1).otherwise(2)
    cut = cut.select(
        F.when(F.col("r") == 1, F.col("h")).otherwise(F.xxhash64("h", low, high)).alias("grp"),
        side.alias("side"),
        "doc_id",
        "at",
        "lead",
        "around",
    )

    least, gram = index.least, index.gram

    def verify(group: pa.Table) -> Iterable[pa.RecordBatch]:
        yield from _same_window(group, least, gram)

    schema = "doc_a long, doc_b long, from_a int, from_b int, run int"
    found = grouping.map_groups(cut, "grp", verify, schema, runtime.fan_out(df, copies=0.5))
    if not earlier:
        return found
    # two texts of the history were reported when the later of them came
    known = [ids.select(F.col("id").alias(c), F.lit(True).alias(f"new_{c}")) for c in ("doc_a", "doc_b")]
    flagged = found.join(known[0], "doc_a", "left").join(known[1], "doc_b", "left")
    return flagged.filter("new_doc_a OR new_doc_b").select("doc_a", "doc_b", "from_a", "from_b", "run")


def sharing_pairs(spans: DataFrame) -> DataFrame:
    """(doc_a, doc_b): pairs of records with a common stretch."""
    return spans.select("doc_a", "doc_b").distinct()


def shared_amount(df: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, shared_chars, partners): how much of each sharing record stands elsewhere too."""
    both = spans.select(F.col("doc_a").alias("doc_id"), F.col("doc_b").alias("other"), F.col("from_a").alias("lo"), "run")
    both = both.unionByName(
        spans.select(F.col("doc_b").alias("doc_id"), F.col("doc_a").alias("other"), F.col("from_b").alias("lo"), "run")
    ).withColumn("hi", F.col("lo") + F.col("run"))
    both = runtime.written(both, "span-sides")
    order = Window.partitionBy("doc_id").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    distinct = both.groupBy("doc_id", "lo").agg(F.max("hi").alias("hi"))
    fresh = F.greatest(F.col("hi") - F.greatest(F.col("lo"), F.coalesce(F.max("hi").over(order), F.lit(0))), F.lit(0))
    covered = distinct.withColumn("fresh", fresh).groupBy("doc_id").agg(F.sum("fresh").alias("shared_chars"))
    partners = both.select("doc_id", "other").distinct().groupBy("doc_id").agg(F.count("*").alias("partners"))
    sizes = df.select(F.col(id_col).cast("long").alias("doc_id"), F.length(text_col).cast("long").alias("n_chars"))
    sizes = sizes.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("n_chars").alias("n_chars"))
    return covered.join(partners, "doc_id").join(sizes, "doc_id").select(
        "doc_id", "n_chars", F.col("shared_chars").cast("long").alias("shared_chars"), "partners"
    )
