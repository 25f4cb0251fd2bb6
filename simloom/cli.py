"""Command line: ``python -m simloom.cli MODE``.

    encode        items of a path list or an image folder -> vectors
    cluster       vectors of array folders or a table -> report, labels, groups, previews
    index-search  per-shard hit lists, written by shard
    process-hits  stored hit lists -> groups
    label         group text + catalog -> class map and relabelled catalog
    refine        groups -> the representatives' vectors and paths
    annotate      path list -> capped data list
    annotate-json groups of a size band + JSON documents -> documents with the group's fields
    normalise     array folder -> array folder of unit vectors
    conditions    ranked array shards, folder and path lists -> joint centroids and divergence
    divergence    vectors with folders -> scores and centroids

Both spellings of flags with several words are accepted (``--top-k``, ``--top_k``).
"""

from __future__ import annotations

import argparse
import importlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import runtime
from .functions import names, vectors
from .operators import centroids, clusters, encode, knn, labels, shards
from .plans import pipelines
from .sinks import writers
from .sources import readers


def _flag(parser: argparse.ArgumentParser, name: str, **options: object) -> None:
    spellings = [f"--{name}"] + ([f"--{name.replace('-', '_')}"] if "-" in name else [])
    parser.add_argument(*spellings, **options)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="simloom", description=__doc__.split("\n", 1)[0])
    modes = top.add_subparsers(dest="mode", required=True)

    def mode(name: str, *inputs: str) -> argparse.ArgumentParser:
        sub = modes.add_parser(name)
        for option in (*inputs, "output"):
            _flag(sub, option, required=True)
        return sub

    sub = mode("encode", "input")
    _flag(sub, "content", default="bytes", choices=("bytes", "path"), help="what the encoder is given of a listed file")
    _flag(sub, "per-batch", action="store_true", help="one folder per batch, not merged")
    _flag(sub, "encoder", default="simloom.operators.encode:hashed_features", help="module:function that makes the encoder")
    _flag(sub, "dim", type=int, default=encode.FINAL, choices=(encode.FINAL, encode.MID + encode.FINAL))
    _flag(sub, "batch-size", type=int, default=1024)
    _flag(sub, "use-l2-norm", action=argparse.BooleanOptionalAction, default=True)
    _flag(sub, "split-threshold", type=int, default=shards.SPLIT)

    sub = mode("cluster")
    _flag(sub, "input", nargs="+", help="array folders, concatenated, or one table")
    _flag(sub, "preset", help="a name in the file of presets, instead of the input")
    _flag(sub, "presets", help="JSON file: name -> list of array folders or names of other presets")
    _flag(sub, "save-images", action="store_true", help="write the first readable images of the largest groups")
    _flag(sub, "policy", default="wall", choices=("wall", "bridge"))
    _flag(sub, "remove-duplicates", action=argparse.BooleanOptionalAction, default=True)
    _flag(sub, "duplicate-thresh", type=float, default=0.9)
    _flag(sub, "cluster-thresh", type=float, default=None)
    _flag(sub, "top-k", type=int, default=100)
    _flag(sub, "keep", default="min", choices=("min", "max", "first"))
    _flag(sub, "save-groups", type=int, default=50)
    _flag(sub, "max-shard", type=int, default=shards.MAX_SHARD)

    sub = mode("index-search", "input")
    _flag(sub, "top-k", type=int, default=100)
    _flag(sub, "max-shard", type=int, default=shards.MAX_SHARD)
    _flag(sub, "ranks", type=int, default=1)
    _flag(sub, "rank", type=int, help="search the shards of this rank only; ranks write side by side")

    sub = mode("process-hits", "hits")
    _flag(sub, "duplicate-thresh", type=float, default=0.9)
    _flag(sub, "cluster-thresh", type=float, default=0.5)
    _flag(sub, "max-shard", type=int, default=shards.MAX_SHARD)

    sub = mode("label", "groups", "items", "catalog")
    _flag(sub, "marker", required=True, help="paths that hold it get their class from the file name")

    mode("refine", "groups", "items")

    sub = mode("annotate", "input")
    _flag(sub, "root", required=True, help="name of the folder that holds the class folders")
    _flag(sub, "limit", type=int, default=99)
    _flag(sub, "name", default="data")

    sub = mode("annotate-json", "groups", "items", "documents")
    _flag(sub, "least", type=int, default=400)
    _flag(sub, "most", type=int, default=1000)
    _flag(sub, "root", default="", help="put before the paths in the documents")

    mode("normalise", "input")

    sub = mode("conditions", "input")
    _flag(sub, "glob", default="temp-*_embs*.npy")
    _flag(sub, "folders", required=True, help="text, a folder a line, one per vector")
    _flag(sub, "paths", required=True, help="text, a path a line, one per vector")
    _flag(sub, "final", type=int, default=encode.FINAL)

    sub = mode("divergence", "input")
    _flag(sub, "folder", default="folder")
    return top


def _vectors(spark: SparkSession, inputs: Sequence[str]) -> DataFrame:
    """(data_index, embedding, path): a Parquet table, or array folders one after the other."""
    if len(inputs) == 1 and not inputs[0].endswith(".npy"):
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").load(inputs[0]).select("path")
        if files.isEmpty():
            return spark.read.parquet(inputs[0]).select("data_index", "embedding", "path")
    return pipelines.load(spark, list(inputs))


def _preset(spark: SparkSession, file: str, name: str, seen: tuple[str, ...] = ()) -> list[str]:
    """The folders of a preset; a preset may name others, whose folders come in their order."""
    text = "".join(r["line"] for r in readers.line_list(spark, file).orderBy("data_index").withColumnRenamed("value", "line").collect())
    known = json.loads(text)

    def folders(one: str, seen: tuple[str, ...]) -> list[str]:
        if one in seen:
            raise SystemExit(f"preset {one} names itself")
        if one not in known:
            return [one]
        return [f for part in known[one] for f in folders(part, (*seen, one))]

    if name not in known:
        raise SystemExit(f"no preset {name}; there are {', '.join(sorted(known))}")
    return folders(name, ())


def _encoder(name: str, dim: int):
    module, _, function = name.partition(":")
    factory = getattr(importlib.import_module(module), function)
    return (lambda: factory(dim)) if name.endswith(":hashed_features") else factory


def run(spark: SparkSession, argv: Sequence[str] | None = None) -> dict[str, str]:
    """Runs one mode; returns what was written."""
    args = parser().parse_args(argv)
    out = args.output
    if args.mode == "encode":
        if args.input.endswith(".txt"):
            items = readers.path_list(spark, args.input)
            items = encode.read_files(items) if args.content == "bytes" else items.withColumn("content", F.col("path"))
        else:
            listed = readers.image_folder(spark, args.input)
            items = listed.join(readers.image_bytes(spark, args.input, "*"), "path")
        made = encode.encode(items, _encoder(args.encoder, args.dim), dim=args.dim, normalise=args.use_l2_norm, batch=args.batch_size)
        made = made.join(items.select("data_index", "path"), "data_index")
        if args.per_batch:
            writers.write_batches(made.withColumn("batch", F.floor(F.col("data_index") / args.batch_size)), out)
        else:
            writers.write_split(made, out, threshold=args.split_threshold)
        return {"vectors": out}
    if args.mode == "cluster":
        usual = {"wall": 0.7, "bridge": 0.5}[args.policy]
        config = pipelines.Config(
            policy=args.policy,
            duplicate=args.duplicate_thresh if args.remove_duplicates else None,
            cluster=usual if args.cluster_thresh is None else args.cluster_thresh,
            k=args.top_k,
            keep=args.keep,
            max_shard=args.max_shard,
            previews=args.save_groups,
        )
        if bool(args.input) == bool(args.preset):
            raise SystemExit("cluster takes an input or a preset")
        items = _vectors(spark, args.input or _preset(spark, args.presets, args.preset))
        decode = encode.decode_image if args.save_images else None
        return pipelines.write_outputs(pipelines.run(items, config), items, out, config, decode=decode)
    if args.mode == "index-search":
        items = _vectors(spark, [args.input])
        jobs = shards.plan_jobs(items.count(), args.ranks, args.max_shard)
        size = jobs[0].end if jobs else 1
        mine = [j for j in jobs if args.rank is None or j.rank == args.rank]
        if mine:
            span = (mine[0].job, mine[-1].job + 1)
            writers.write_knn(knn.sharded_topk(items, args.top_k, span[1], size, "data_index", first=span[0]), out, beside=args.rank is not None)
        return {"hits": out}
    if args.mode == "process-hits":
        hits = spark.read.parquet(args.hits)
        config = pipelines.Config(policy="bridge", duplicate=args.duplicate_thresh, cluster=args.cluster_thresh, max_shard=args.max_shard)
        count = hits.agg(F.max("shard")).first()[0]
        result = pipelines.process_hits(hits, config, 0 if count is None else int(count) + 1)
        writers.write_group_text(result.groups, out)
        return {"groups": out}
    if args.mode == "label":
        groups = readers.group_text(spark, args.groups).select("group_id", "member")
        items = spark.read.parquet(args.items)
        classes = items.select(F.col("data_index").alias("member"), names.class_of("path", args.marker).alias("class"))
        mapping = labels.class_map(groups, classes)
        catalog = readers.path_list(spark, args.catalog)
        rows = labels.relabel(catalog, mapping, "path", names.class_of("path", args.marker))
        files = writers.write_labels(rows, out, labels.remap_file_names(rows))
        return dict(zip(("classes", "data_list"), files))
    if args.mode == "refine":
        groups = readers.group_text(spark, args.groups).select("group_id", "member")
        first = clusters.representatives(groups).select("group_id", F.col("member").alias("data_index"))
        spark.read.parquet(args.items).join(first, "data_index").write.mode("overwrite").parquet(out)
        return {"vectors": out}
    if args.mode == "annotate":
        items = readers.path_list(spark, args.input)
        rows = items.select(names.class_below("path", args.root).alias("folder"), F.col("path").alias("file_path"), "data_index")
        rows = labels.capped(rows, args.limit, "data_index")
        files = writers.write_labels(rows, out, labels.annotation_file_names(rows, args.name))
        return dict(zip(("classes", "data_list"), files))
    if args.mode == "annotate-json":
        groups = readers.group_text(spark, args.groups).select("group_id", "member")
        band = clusters.size_band(groups, args.least, args.most)
        items = spark.read.parquet(args.items).select(F.col("data_index").alias("member"), "path")
        rows = labels.annotated(band, items, readers.json_documents(spark, args.documents), args.root)
        writers.write_json_documents(rows, out, "json", "name")
        return {"documents": out}
    if args.mode == "normalise":
        items = pipelines.load(spark, [args.input])
        unit = items.select("data_index", vectors.as_float(vectors.l2_normalize("embedding")).alias("embedding"), "path")
        writers.write_npy(unit, out, "embs_norm_")
        writers.write_npy(unit, out, "fpaths_", value="path")
        return {"vectors": out}
    if args.mode == "conditions":
        files = readers.ranked_files(spark, args.input, args.glob)
        rows = readers.with_index(readers.npy_rows(spark, files).select("shard", "row", "embedding"), "shard", "row")
        folders = readers.line_list(spark, args.folders).withColumnRenamed("value", "folder")
        paths = readers.line_list(spark, args.paths).withColumnRenamed("value", "path")
        joined = readers.zip_by_index(readers.zip_by_index(rows, folders), paths)
        joined = runtime.written(encode.split_joint(joined, final=args.final), "conditions")
        scores = centroids.divergence(joined, "folder", "final", "path")
        scored = scores.select(F.col("class").alias("folder"), F.col("id").alias("file_path"), "score")
        writers.write_divergence(scored, f"{out}/scores")
        means = centroids.condition_centroids(joined, "folder", joint="embedding")
        writers.write_centroids(means, f"{out}/centroids", per_class=True)
        return {"scores": f"{out}/scores", "centroids": f"{out}/centroids"}
    items = spark.read.parquet(args.input)
    scores = centroids.divergence(items, args.folder, "embedding", "path")
    scored = scores.select(F.col("class").alias("folder"), F.col("id").alias("file_path"), "score")
    writers.write_divergence(scored, f"{out}/scores")
    writers.write_centroids(centroids.centroids(items, args.folder, "embedding"), f"{out}/centroids")
    return {"scores": f"{out}/scores", "centroids": f"{out}/centroids"}


if __name__ == "__main__":
    session = SparkSession.builder.appName("simloom").getOrCreate()
    for what, where in run(session).items():
        print(f"{what}: {where}")
