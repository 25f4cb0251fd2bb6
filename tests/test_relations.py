"""Names, labels, centroids, shards, sources, sinks, folders and the compactor."""

import json
import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from simloom.functions import names, vectors
from simloom.operators import centroids, encode, knn, labels, listing, shards
from simloom.plans import pipelines
from simloom.sinks import writers
from simloom.sources import readers
from simloom.streaming import compactor


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("path", "want"),
    [("a/b/c/d.jpg", "b/c"), ("c/d.jpg", "c"), ("d.jpg", ""), ("", ""), (None, None)],
)
def test_class_from_parents(spark, path, want):
    assert one(spark, names.class_from_parents(F.lit(path).cast("string"))) == want


def test_names(spark):
    assert one(spark, names.class_from_file(F.lit("x/40d2_face_5.jpg"))) == "40d2_face_5"
    assert one(spark, names.class_from_file(F.lit("x/ab"))) == ""
    assert one(spark, names.class_of(F.lit("x/portal/a.jpeg"), "portal")) == "a."
    assert one(spark, names.class_below(F.lit("r/root/c/x.jpg"), "root")) == "c"
    assert one(spark, names.class_below(F.lit("r/other/c/x.jpg"), "root")) == "other/c"
    assert one(spark, names.scene_of(F.lit("scene_7_pid2_cnt15.jpg"))) == "scene_7"
    assert one(spark, names.frame_of(F.lit("scene_7_pid2_cnt15.jpg"))) == 15
    assert one(spark, names.frame_of(F.lit("nothing.jpg"))) is None
    assert one(spark, names.group_name(F.lit(3))) == "group_0003"
    assert one(spark, names.group_name(F.lit(12345))) == "group_12345"
    assert [one(spark, names.thousands(F.lit(n))) for n in (999, 1000, 12999)] == ["999", "1K", "12K"]
    assert [int(x) for x in one(spark, names.natural_key(F.lit("d/embs_10_2.npy")))] == [10, 2]
    rank, index = names.rank_index(F.lit("o/temp-3_12_embs_norm.npy"))
    assert (one(spark, rank), one(spark, index)) == (3, 12)


def test_vectors(spark):
    v = lambda *x: F.array(*(F.lit(float(i)) for i in x))
    assert one(spark, vectors.l2_normalize(v(0, 0))) == [0.0, 0.0]
    assert one(spark, vectors.l2_normalize_guarded(v(3, 4))) == [0.6, 0.8]
    assert one(spark, vectors.l2_normalize_guarded(v(0, 0))) == [0.0, 0.0]
    assert one(spark, vectors.inner_product(v(1, 2), v(3, 4))) == 11.0
    assert one(spark, vectors.inner_product(v(1, 2), v(3))) is None
    assert one(spark, vectors.cosine(v(0, 0), v(1, 0))) is None
    assert one(spark, vectors.tail(v(1, 2, 3), 2)) == [2.0, 3.0]
    assert one(spark, vectors.tail(v(1), 2)) is None
    assert one(spark, vectors.vector_slice(v(1, 2, 3), 1, 2)) == [2.0, 3.0]


def test_last_class_write_wins(spark, rows):
    groups = spark.createDataFrame([(0, 0), (0, 1), (1, 2), (1, 3)], "group_id long, member long")
    classes = spark.createDataFrame([(0, "A"), (1, "B"), (2, "C"), (3, "B")], "member long, class string")
    mapping = labels.class_map(groups, classes)
    assert rows(mapping) == [("A", "A"), ("B", "C"), ("C", "C")]
    assert rows(labels.class_list(mapping)) == [("A",), ("C",)]
    catalog = spark.createDataFrame([("p1", "A"), ("p2", "B"), ("p3", "Z"), ("p4", None)], "path string, class string")
    assert rows(labels.relabel(catalog, mapping, "path", F.col("class"))) == [("A", "p1"), ("C", "p2")]
    assert rows(labels.relabel_counts(catalog, mapping, F.col("class"))) == [(2, 2)]


def test_capped_classes(spark, rows):
    data = [("c", "c/a.jpg", 0), ("c", "c/origin.jpg", 1), ("c", "c/b.jpg", 2)]
    items = spark.createDataFrame(data, "folder string, file_path string, o long")
    assert [r[1] for r in sorted(rows(labels.capped(items, 2, "o")), key=lambda r: r[2])] == ["c/origin.jpg", "c/a.jpg"]
    assert labels.capped(items, 0, "o").count() == 3
    twice = items.unionByName(spark.createDataFrame([("c", "d/origin.jpg", 3)], items.schema))
    assert ("c", "d/origin.jpg", 0) in rows(labels.capped(twice, 9, "o")) and labels.capped(twice, 9, "o").count() == 3
    with pytest.raises(Exception, match="no original"):
        labels.capped(items.filter("o <> 1"), 2, "o").collect()


def test_json_fields(spark):
    nested = '{"a": "x", "b": 2, "c": {"d": [1, 2.5, null]}, "e": true}'
    df = spark.createDataFrame([(nested,), (None,), ("{broken",), ("[1]",)], "j string")
    fields = {"b": F.lit(5), "f": F.lit("y"), "g": F.lit(None).cast("int")}
    got = [json.loads(r["x"]) for r in df.select(labels.augment_json(df, "j", fields).alias("x")).collect()]
    assert got[0] == {"a": "x", "b": 5, "c": {"d": [1, 2.5, None]}, "e": True, "f": "y", "g": None}
    assert got[1:] == [{"b": 5, "f": "y", "g": None}] * 3


def test_a_member_without_an_item_fails(spark):
    groups = spark.createDataFrame([(0, 1), (0, 2), (1, 3)], "group_id long, member long")
    items = spark.createDataFrame([(1, "p/1"), (2, None), (3, "p/3")], "data_index long, path string")
    assert {tuple(r) for r in labels.label_rows(groups, items).collect()} == {("group_0000", "p/1"), ("group_0000", None), ("group_0001", "p/3")}
    with pytest.raises(Exception, match="no item for member"):
        labels.label_rows(groups, items.limit(1)).collect()


def test_runs_over_many_slices(spark):
    folders = [None, None, "a", "a", "b", "b", "b", "a", None, "c"]
    data = [(n, folders[n // 7 % len(folders)]) for n in range(210)]
    want, run, last = [], 0, object()
    for _, f in data:
        run, last = run + (f != last), f
        want.append(run)
    df = spark.createDataFrame(data, "o long, f string").repartition(5)
    assert [r["run"] for r in centroids.flush_groups(df, "f", "o").orderBy("o").collect()] == want
    assert centroids.flush_groups(df.limit(0), "f", "o").count() == 0


def test_centroids(spark, rows):
    data = [(1, "a", [1.0, 0.0]), (2, "a", [0.0, 1.0]), (3, "b", [2.0, 2.0]), (4, None, [1.0, 1.0]), (5, "b", None)]
    df = spark.createDataFrame(data, "vec_id long, label string, embedding array<float>").repartition(3)
    got = {r["class"]: (r["n"], r["centroid"]) for r in centroids.centroids(df).collect()}
    assert got == {"a": (2, [0.5, 0.5]), "b": (1, [2.0, 2.0]), None: (1, [1.0, 1.0])}
    scores = {r["id"]: r["score"] for r in centroids.divergence(df).collect()}
    assert scores == {1: 0.707107, 2: 0.707107, 3: 1.0, 4: 1.0}
    assert centroids.centroids(df.limit(0)).count() == 0
    runs = spark.createDataFrame([(0, "x"), (1, "x"), (2, "y"), (3, "x")], "o long, f string")
    assert [r["run"] for r in centroids.flush_groups(runs, "f", "o").orderBy("o").collect()] == [1, 1, 2, 3]


def test_shard_plan():
    assert shards.plan_jobs(0) == []
    jobs = shards.plan_jobs(30500, 3, 1000)
    assert len(jobs) == 31 and [j.rank for j in jobs].count(2) == 11 and jobs[-1].end == 30500
    assert [(j.start, j.end) for j in shards.plan_jobs(10, 3, 100)] == [(0, 4), (4, 8), (8, 10)]
    assert shards.part_count(10, 10) == 1 and shards.part_count(11, 10) == 2


def test_line_sources(spark, tmp_path, rows):
    text = tmp_path / "list.txt"
    text.write_text(" b.jpg \n\na.jpg\n  \nc.jpg")
    assert rows(readers.path_list(spark, f"file://{text}").select("data_index", "path")) == [(0, "b.jpg"), (1, "a.jpg"), (2, "c.jpg")]
    assert readers.line_list(spark, f"file://{text}").count() == 5
    groups = spark.createDataFrame([(0, 3), (0, 1), (1, 2)], "group_id long, member long")
    writers.write_group_text(groups.coalesce(1), f"file://{tmp_path}/groups")
    back = readers.group_text(spark, f"file://{tmp_path}/groups")
    assert rows(back) == [(0, 0, 1), (0, 1, 3), (1, 0, 2)]


def test_array_folder(spark, tmp_path):
    assert readers.natural_sorted(["embs_10", "embs_2", "final_embs"]) == ["final_embs", "embs_2", "embs_10"]
    one_, two = np.eye(3, dtype=np.float32)[:2], np.eye(3, dtype=np.float32)[2:]
    np.save(tmp_path / "embs_10.npy", two)
    np.save(tmp_path / "embs_2.npy", one_)
    np.save(tmp_path / "fpaths_2.npy", np.array(["a", "b"]))
    np.save(tmp_path / "fpaths_10.npy", np.array(["c"]))
    np.save(tmp_path / "indices_2.npy", np.arange(2))
    got = readers.npy_table(spark, f"file://{tmp_path}").orderBy("data_index").collect()
    assert [r["path"] for r in got] == ["a", "b", "c"] and got[2]["embedding"] == [0.0, 0.0, 1.0]
    np.save(tmp_path / "fpaths_11.npy", np.array(["d"]))
    with pytest.raises(ValueError, match="3 vectors but 4 paths"):
        readers.npy_table(spark, f"file://{tmp_path}")


def test_arrays_of_objects_are_refused(spark, tmp_path):
    np.save(tmp_path / "embs_1.npy", np.array([{"a": 1}], dtype=object))
    np.save(tmp_path / "fpaths_1.npy", np.array(["a"]))
    with pytest.raises(Exception, match="pickled objects"):
        readers.npy_table(spark, f"file://{tmp_path}").collect()


def picture(value):
    return np.full((4, 6, 3), value, np.uint8)


def test_images_of_several_formats():
    rng = np.random.default_rng(3)
    pixels = rng.integers(0, 256, (5, 7, 3), np.uint8)
    row = np.zeros((5, 24), np.uint8)
    row[:, :21] = pixels[::-1, :, ::-1].reshape(5, 21)
    bmp = b"BM" + struct.pack("<IHHIIiiHHIIiiII", 54 + 120, 0, 0, 54, 40, 7, 5, 1, 24, 0, 120, 0, 0, 0, 0) + row.tobytes()
    assert (encode.decode_image(bmp) == pixels).all()

    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    # one line of each filter
    flat, lines = pixels.astype(int).reshape(5, 21), []
    for y, kind in enumerate((0, 1, 2, 3, 4)):
        left = np.concatenate([[0] * 3, flat[y, :-3]])
        up = flat[y - 1] if y else np.zeros(21, int)
        corner = np.concatenate([[0] * 3, up[:-3]])
        a, b, c = abs(up - corner), abs(left - corner), abs(left + up - 2 * corner)
        paeth = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
        guess = (0, left, up, (left + up) // 2, paeth)[kind]
        lines.append(bytes([kind]) + ((flat[y] - guess) % 256).astype(np.uint8).tobytes())
    head = struct.pack(">IIBBBBB", 7, 5, 8, 2, 0, 0, 0)
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")
    assert (encode.decode_image(png) == pixels).all()
    assert (encode.decode_image(writers.encode_ppm(pixels)) == pixels).all()
    for broken in (b"", b"BM", png[:40], bmp[:60], b"\xff\xd8\xff"):
        assert encode.decode_image(broken) is None


def test_a_hot_folder_is_joined_nowhere(spark, rows, monkeypatch):
    """Per-folder results with broadcasts switched off, dictionaries flushed often and one folder holding most rows."""
    monkeypatch.setattr(listing, "DICTIONARY", 3)
    data = [(n, "hot/" if n % 5 else f"f{n % 35}", f"d/s{n % 50}/x{n % 400}.jpg") for n in range(2000)] + [(2000, None, "p"), (2001, "f", None)]
    df = spark.createDataFrame(data, "list_pos long, folder string, file_path string").repartition(6)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = listing.folder_results(df)
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = {tuple(r) for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want: dict = {}
    for _, f, p in data:
        if f is not None and p is not None:
            want.setdefault(f.rstrip("/"), set()).add(p)
    assert got == {(f, len(ps), len({p.split("/")[-2] for p in ps}), min(ps)) for f, ps in want.items()}
    assert "Join" not in plan and listing.folder_results(df.limit(0)).count() == 0


def test_images_and_encoder(spark, tmp_path, rows):
    for name, value in (("b.PNG", 10), ("a.jpg", 200)):
        (tmp_path / name).write_bytes(writers.encode_ppm(picture(value)))
    (tmp_path / "note.txt").write_text("no image")
    found = readers.image_folder(spark, f"file://{tmp_path}").orderBy("data_index").collect()
    assert [r["path"].rsplit("/", 1)[-1] for r in found] == ["a.jpg", "b.PNG"]
    assert (encode.decode_ppm(writers.encode_ppm(picture(7))) == 7).all()
    assert encode.decode_ppm(b"junk") is None
    assert encode.preprocess(picture(255)).shape == (3, 112, 112) and encode.preprocess(picture(255)).max() == 1.0
    items = spark.createDataFrame([(0, "x"), (1, "x"), (2, "y")], "data_index long, content string")
    got = {r["data_index"]: r["embedding"] for r in encode.encode(items, lambda: encode.hashed_features(8), dim=8).collect()}
    assert got[0] == got[1] != got[2] and abs(sum(x * x for x in got[2]) - 1) < 1e-6
    with pytest.raises(Exception, match="no content"):
        encode.encode(spark.createDataFrame([(0, None)], items.schema), encode.hashed_features).collect()
    members = spark.createDataFrame(
        [(0, 0, "d/a.jpg", writers.encode_ppm(picture(9))), (0, 1, "d/b.jpg", b"junk"), (0, 2, "d/c.jpg", writers.encode_ppm(picture(8)))],
        "rank long, pos long, path string, content binary",
    )
    sheet = writers.sheet_images(members, encode.decode_ppm, limit=1)
    assert [(r["folder"], r["name"]) for r in sheet.collect()] == [("group_0000", "a.jpg")]


def test_sinks(spark, tmp_path, rows):
    df = spark.range(25).withColumnRenamed("id", "data_index")
    writers.write_split(df, f"file://{tmp_path}/split", threshold=10)
    parts = spark.read.parquet(f"file://{tmp_path}/split").groupBy("part").agg(F.min("data_index"), F.max("data_index"))
    assert rows(parts) == [(0, 0, 9), (1, 10, 19), (2, 20, 24)]
    groups = spark.createDataFrame([(0, 1), (1, 2), (1, 3)], "group_id long, member long")
    writers.write_report(groups, f"file://{tmp_path}/report", 4)
    lines = [r["value"] for r in spark.read.text(f"file://{tmp_path}/report").collect()]
    assert lines == ["Group sizes:", " Size 1: 1 group(s)", " Size 2: 1 group(s)", "Removed 4 duplicate images"]
    (tmp_path / "foreign").mkdir()
    (tmp_path / "foreign" / "x").write_text("not ours")
    with pytest.raises(ValueError):
        writers.fresh_folder(spark, f"file://{tmp_path}/foreign", replace=True)
    assert (tmp_path / "foreign" / "x").exists()
    rows_ = spark.createDataFrame([("a/b", 'p,"1"', 0.5)], "folder string, file_path string, score double")
    writers.write_divergence(rows_, f"file://{tmp_path}/div")
    back = spark.read.schema("f string, p string, s double").option("escape", '"').csv(f"file://{tmp_path}/div")
    assert back.first()["f"] == "a_b"


def test_pipelines(spark, tmp_path):
    angles = [0, 1, 30, 120, 121]
    data = [(i, [float(np.cos(np.radians(a))), float(np.sin(np.radians(a)))], f"d/{i}.jpg") for i, a in enumerate(angles)]
    df = spark.createDataFrame(data, "data_index long, embedding array<float>, path string")
    for config in (pipelines.Config(k=5), pipelines.BRIDGE, pipelines.Config(policy="bridge", cluster=0.7, k=5, max_shard=3)):
        result = pipelines.run(df, config)
        assert {r["id"] for r in result.removed.collect()} >= {1, 4}
        assert result.groups.count() == 5 - result.removed.count()
    whole = pipelines.run(df, pipelines.Config(duplicate=None, k=5))
    assert whole.groups.count() == 5
    out = pipelines.write_outputs(whole, df, f"file://{tmp_path}/out", pipelines.Config(duplicate=None))
    assert spark.read.parquet(out["data_list"]).count() == 5
    with pytest.raises(ValueError):
        pipelines.Config(k=0)


def test_folder_results_against_loops(spark):
    data = [
        (0, "A/", "x/s1/p.jpg"), (1, "a ", "X//s1\\p.jpg"), (2, "a", "x/portraits/s2_1.jpg"), (3, "a", None),
        (4, None, "x/s1/p.jpg"), (5, "b", ""), (6, "b", "flat.jpg"), (7, "", "x/s9/q.jpg"), (8, "a", "x/s2/z.jpg"),
    ]
    df = spark.createDataFrame(data, "list_pos long, folder string, file_path string").withColumn("n", F.lit(1)).withColumn("code", F.lit(2))
    got = {r["folder"]: (r["listings"], r["subjects"], r["first_path"]) for r in listing.folder_results(df).collect()}
    assert got == {"a": (3, 2, "x/portraits/s2_1.jpg"), "b": (2, 1, ""), "": (1, 1, "x/s9/q.jpg")}
    assert {r[0] for r in listing.large_folders(listing.folder_results(df), 0.3).collect()} == {"a", "b"}
    assert listing.folder_results(df.limit(0)).count() == 0


def test_compactor_survives_repeats_and_new_files(spark, tmp_path, rows):
    schema = "file_id long, file_name string, fpaths array<string>"
    first = [(1, "a", ["p", " q ", None, ""]), (2, "b", None), (3, "c", [])]
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(f"file://{tmp_path}/in")
    folder = f"file://{tmp_path}/out"
    assert rows(compactor.compact_files(spark, f"file://{tmp_path}/in", folder)) == [("p", 1, 0), ("q", 1, 1)]
    spark.createDataFrame([(4, "d", ["q", "r", "r"])], schema).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    assert rows(compactor.compact_files(spark, f"file://{tmp_path}/in", folder)) == [("p", 1, 0), ("q", 1, 1), ("r", 4, 1)]
    assert rows(compactor.compact_files(spark, f"file://{tmp_path}/in", folder)) == [("p", 1, 0), ("q", 1, 1), ("r", 4, 1)]
    assert rows(compactor.dropped(spark, folder)) == [(4, 0), (4, 2)]
    # a batch handed out again replaces its own output
    log = compactor.log_entries(spark, folder).count()
    again = compactor.entries(spark.createDataFrame([(4, "d", ["q", "r", "r"])], schema))
    again.write.mode("overwrite").parquet(compactor.batch_path(folder, 1))
    assert compactor.log_entries(spark, folder).count() == log


def test_wide_hit_lists_become_rows(spark, rows):
    df = spark.createDataFrame([(0, [1.0, 0.5, -9.0], [0, 2, -1])], "q long, cos array<float>, idx array<int>")
    assert rows(knn.to_long(df, "q", "cos", "idx", offset=10)) == [(0, 1, 10, 1.0), (0, 2, 12, 0.5)]
    twice = spark.createDataFrame([(0, 5, 0.9), (0, 0, 1.0), (0, 5, 0.9), (0, 7, 0.9)], "q long, n long, sim double")
    assert rows(knn.merge_shards(twice, 2)) == [(0, 1, 0, 1.0), (0, 2, 5, 0.9)]


def test_batches_hits_and_documents(spark, tmp_path, rows):
    df = spark.createDataFrame([(0, 0, "a"), (1, 1, "b")], "batch int, data_index long, path string")
    writers.write_batches(df, f"file://{tmp_path}/batches")
    assert rows(spark.read.parquet(f"file://{tmp_path}/batches/batch=1")) == [(1, "b")]
    hits = spark.createDataFrame([(0, 1, 1, 1, 1.0), (1, 1, 1, 5, 0.5)], "shard int, q long, rk int, n long, sim double")
    writers.write_knn(hits, f"file://{tmp_path}/hits")
    assert spark.read.parquet(f"file://{tmp_path}/hits").filter("shard = 1").count() == 1
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "a.json").write_text('{"a": 1}')
    docs = readers.json_documents(spark, f"file://{tmp_path}/docs")
    writers.write_json_documents(docs.select(labels.augment_json(docs, "json", {"b": F.lit("x")}).alias("json")), f"file://{tmp_path}/out")
    assert json.loads(spark.read.text(f"file://{tmp_path}/out").first()["value"]) == {"a": 1, "b": "x"}
    left = spark.createDataFrame([(0, "x")], "data_index long, a string")
    with pytest.raises(ValueError, match="1 rows on one side but 2"):
        readers.zip_by_index(left, df.select("data_index", "path"))
    assert rows(names_union(spark)) == [(0, 1), (1, 2)]


def names_union(spark):
    parts = [spark.createDataFrame([(i + 1,)], "x long") for i in range(2)]
    return readers.union_shards(parts).select("shard", "x")


def test_a_late_file_with_an_old_time_is_taken_in(spark, rows, tmp_path):
    schema = "file_id long, fpaths array<string>"
    source, folder = tmp_path / "in", f"file://{tmp_path}/out"
    spark.createDataFrame([(1, ["p"])], schema).coalesce(1).write.parquet(f"file://{source}")
    assert rows(compactor.compact_files(spark, f"file://{source}", folder)) == [("p", 1, 0)]
    spark.createDataFrame([(2, ["q"])], schema).coalesce(1).write.parquet(f"file://{tmp_path}/late")
    late = next((tmp_path / "late").glob("*.parquet"))
    old = late.stat().st_mtime - 400 * 86400
    os.utime(late, (old, old))
    late.rename(source / "late.parquet")
    assert rows(compactor.compact_files(spark, f"file://{source}", folder)) == [("p", 1, 0), ("q", 2, 0)]
