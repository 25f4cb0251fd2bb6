"""Modes of the command line end to end, streaming versions, and the entry point without extras."""

import math
import subprocess
import sys
from pathlib import Path

import json

import numpy as np
import pytest

from simloom import cli, runtime
from simloom.streaming import folders

ROOT = Path(__file__).resolve().parents[1]


def angles(*degrees):
    return np.array([[math.cos(math.radians(d)), math.sin(math.radians(d))] for d in degrees], np.float32)


@pytest.fixture
def arrays(tmp_path):
    folder = tmp_path / "arrays"
    folder.mkdir()
    np.save(folder / "embs_0.npy", angles(0, 1, 30))
    np.save(folder / "embs_1.npy", angles(120, 121))
    np.save(folder / "fpaths_0.npy", np.array(["r/A/1.jpg", "r/A/2.jpg", "r/B/3.jpg"]))
    np.save(folder / "fpaths_1.npy", np.array(["r/C/4.jpg", "r/C/5.jpg"]))
    return f"file://{folder}"


def test_cluster_and_what_follows(spark, arrays, tmp_path, rows):
    out = f"file://{tmp_path}/out"
    made = cli.run(spark, ["cluster", "--input", arrays, "--output", out, "--top_k", "5"])
    data = spark.read.parquet(made["data_list"])
    assert rows(data) == [("group_0000", "r/A/1.jpg"), ("group_0000", "r/B/3.jpg"), ("group_0001", "r/C/4.jpg")]
    assert "Removed 2 duplicate images" in [r[0] for r in spark.read.text(made["report"]).collect()]

    whole = cli.run(spark, ["cluster", "--input", arrays, "--output", f"{out}2", "--no-remove-duplicates", "--policy", "bridge", "--save-groups", "0"])
    assert [r[0] for r in spark.read.text(whole["groups"]).collect()] == ["0, 1, 2", "3, 4"]

    items = f"file://{tmp_path}/items"
    cli.pipelines.load(spark, [arrays]).write.parquet(items)
    refined = cli.run(spark, ["refine", "--groups", whole["groups"], "--items", items, "--output", f"{out}3"])
    assert sorted(r["path"] for r in spark.read.parquet(refined["vectors"]).collect()) == ["r/A/1.jpg", "r/C/4.jpg"]

    catalog = tmp_path / "catalog.txt"
    catalog.write_text("r/B/9.jpg\nr/Z/1.jpg\n")
    labelled = cli.run(spark, ["label", "--groups", whole["groups"], "--items", items, "--catalog", f"file://{catalog}", "--marker", "portraits", "--output", f"{out}4"])
    assert rows(spark.read.parquet(labelled["data_list"])) == [("r/A", "r/B/9.jpg")]


def test_search_by_shards_then_process(spark, arrays, tmp_path):
    hits, groups = f"file://{tmp_path}/hits", f"file://{tmp_path}/groups"
    cli.run(spark, ["index-search", "--input", arrays, "--output", hits, "--top-k", "3", "--max-shard", "3"])
    assert spark.read.parquet(hits).select("shard").distinct().count() == 2
    cli.run(spark, ["process-hits", "--hits", hits, "--output", groups, "--max-shard", "3"])
    assert [r[0] for r in spark.read.text(groups).collect()] == ["0, 2", "3"]


def test_encode_annotate_divergence(spark, tmp_path, rows):
    listed = tmp_path / "list.txt"
    listed.write_text("root/a/1.jpg\nroot/a/origin.jpg\nroot/a/2.jpg\n")
    made = cli.run(spark, ["encode", "--input", f"file://{listed}", "--content", "path", "--output", f"file://{tmp_path}/vec", "--split-threshold", "2"])
    table = spark.read.parquet(made["vectors"])
    assert table.count() == 3 and table.select("part").distinct().count() == 2
    noted = cli.run(spark, ["annotate", "--input", f"file://{listed}", "--root", "root", "--limit", "2", "--output", f"file://{tmp_path}/ann"])
    assert rows(spark.read.parquet(noted["data_list"])) == [("a", "root/a/1.jpg"), ("a", "root/a/origin.jpg")]
    table.selectExpr("'a/b' AS folder", "path", "embedding").write.parquet(f"file://{tmp_path}/fold")
    scored = cli.run(spark, ["divergence", "--input", f"file://{tmp_path}/fold", "--output", f"file://{tmp_path}/div"])
    assert spark.read.csv(scored["scores"]).filter("_c0 = 'a_b'").count() == 3


def test_encode_reads_the_listed_files(spark, tmp_path):
    for name, text in (("1.jpg", b"same"), ("2.jpg", b"same"), ("3.jpg", b"other")):
        (tmp_path / name).write_bytes(text)
    listed = tmp_path / "list.txt"
    listed.write_text("".join(f"{tmp_path}/{n}.jpg\n" for n in (1, 2, 3)))
    made = cli.run(spark, ["encode", "--input", f"file://{listed}", "--output", f"file://{tmp_path}/vec", "--per-batch", "--batch-size", "2"])
    rows = spark.read.parquet(made["vectors"]).orderBy("data_index").collect()
    assert rows[0]["embedding"] == rows[1]["embedding"] != rows[2]["embedding"]
    assert [r["batch"] for r in rows] == [0, 0, 1] and rows[2]["path"].endswith("3.jpg")
    listed.write_text(f"{tmp_path}/none.jpg\n")
    with pytest.raises(Exception, match="none.jpg"):
        cli.run(spark, ["encode", "--input", f"file://{listed}", "--output", f"file://{tmp_path}/vec2"])


def test_ranks_search_side_by_side(spark, arrays, tmp_path):
    search = ["index-search", "--input", arrays, "--top-k", "3", "--max-shard", "3", "--ranks", "2"]
    cli.run(spark, [*search, "--output", f"file://{tmp_path}/all"])
    for rank in ("1", "0"):
        cli.run(spark, [*search, "--rank", rank, "--output", f"file://{tmp_path}/each"])
    whole, each = ({tuple(r) for r in spark.read.parquet(f"file://{tmp_path}/{n}").collect()} for n in ("all", "each"))
    assert whole == each and len({r[-1] for r in whole}) == 2


def test_presets_and_images(spark, arrays, tmp_path):
    presets = tmp_path / "presets.json"
    presets.write_text(json.dumps({"one": [arrays], "both": ["one", "one"], "loop": ["loop"]}, indent=1))
    base = ["cluster", "--presets", f"file://{presets}", "--output", f"file://{tmp_path}/out", "--no-remove-duplicates"]
    made = cli.run(spark, [*base, "--preset", "both", "--save-images"])
    assert spark.read.parquet(made["data_list"]).count() == 10
    assert not (tmp_path / "out" / "images").exists()  # none of the paths is an image that can be read
    for wrong in (["--preset", "none"], ["--preset", "loop"], []):
        with pytest.raises(SystemExit):
            cli.run(spark, [*base, *wrong])


def test_annotation_of_documents(spark, tmp_path):
    (tmp_path / "json").mkdir()
    for n in range(3):
        (tmp_path / "json" / f"s{n}_pid1_cnt{n + 7}.json").write_text('{"old": {"k": [1, 2]}, "frame_cnt": "x"}')
    (tmp_path / "groups.txt").write_text("0, 1\n2\n")
    items = [(n, f"s{n}_pid1_cnt{n + 7}.jpg") for n in range(3)]
    spark.createDataFrame(items, "data_index long, path string").write.parquet(f"file://{tmp_path}/items")
    argv = ["annotate-json", "--groups", f"file://{tmp_path}/groups.txt", "--items", f"file://{tmp_path}/items", "--documents", f"file://{tmp_path}/json"]
    cli.run(spark, [*argv, "--least", "2", "--most", "9", "--root", "/r/", "--output", f"file://{tmp_path}/done"])
    assert sorted(p.name for p in (tmp_path / "done").glob("*.json")) == ["s0_pid1_cnt7.json", "s1_pid1_cnt8.json"]
    want = {"old": {"k": [1, 2]}, "img_path": "/r/s1_pid1_cnt8.jpg", "frame_cnt": 8, "scene_str": "s1", "face_id": 0}
    assert json.loads((tmp_path / "done" / "s1_pid1_cnt8.json").read_text()) == want


def test_normalised_shards_and_conditions(spark, arrays, tmp_path):
    made = cli.run(spark, ["normalise", "--input", arrays, "--output", f"file://{tmp_path}/unit"])
    back = cli.pipelines.load(spark, [made["vectors"]]).orderBy("data_index").collect()
    assert [r["path"] for r in back] == ["r/A/1.jpg", "r/A/2.jpg", "r/B/3.jpg", "r/C/4.jpg", "r/C/5.jpg"]
    assert all(abs(sum(x * x for x in r["embedding"]) - 1) < 1e-6 for r in back)

    folder = tmp_path / "ranked"
    folder.mkdir()
    np.save(folder / "temp-0_10_embs_norm.npy", np.array([[5, 3, 4], [1, 0, 1]], np.float32))
    np.save(folder / "temp-0_2_embs_norm.npy", np.array([[1, 1, 0]], np.float32))
    (tmp_path / "fol.txt").write_text("a/b\na/b\nc\n")
    (tmp_path / "path.txt").write_text("1.jpg\n2.jpg\n3.jpg\n")
    argv = ["conditions", "--input", f"file://{folder}", "--folders", f"file://{tmp_path}/fol.txt", "--paths", f"file://{tmp_path}/path.txt", "--final", "2"]
    made = cli.run(spark, [*argv, "--output", f"file://{tmp_path}/cond"])
    means = {r["class"]: r["centroid"] for r in spark.read.parquet(made["centroids"]).collect()}
    assert means == {"a_b": [3.0, 2.0, 2.0], "c": [1.0, 0.0, 1.0]}
    scores = {r[1]: float(r[2]) for r in spark.read.csv(made["scores"]).collect()}
    assert scores == {"1.jpg": 0.707107, "2.jpg": 0.989949, "3.jpg": 1.0}


def test_running_centroids(spark, tmp_path):
    schema = "folder string, embedding array<float>"
    source, folder = f"file://{tmp_path}/in", f"file://{tmp_path}/state"
    spark.createDataFrame([("a", [1.0, 0.0]), ("b", [4.0, 4.0])], schema).coalesce(1).write.parquet(source)
    folders.run_centroids(spark, source, schema, folder).collect()
    spark.createDataFrame([("a", [0.0, 3.0]), ("b", None)], schema).coalesce(1).write.mode("append").parquet(source)
    got = {r["class"]: (r["n"], r["centroid"]) for r in folders.run_centroids(spark, source, schema, folder).collect()}
    assert got == {"a": (2, [0.5, 1.5]), "b": (1, [4.0, 4.0])}


def test_incremental_removal(spark, rows):
    state = folders.IncrementalRemoval(spark, threshold=0.9)
    make = lambda start, m: spark.createDataFrame([(start + i, v.tolist()) for i, v in enumerate(m)], "data_index long, embedding array<double>")
    assert rows(state.add(make(0, angles(0, 1, 90)), 0)) == [(1,)]
    second = make(3, angles(91, 180, 2))
    assert rows(state.add(second, 1)) == [(3,), (5,)]
    state = folders.IncrementalRemoval(spark, state.folder, threshold=0.9)  # opened again
    assert state.batches == [0, 1] and rows(state.add(second, 1)) == [(3,), (5,)]
    assert sorted(r["id"] for r in state.kept().collect()) == [0, 2, 4]


def test_incremental_removal_of_more_copies_than_any_list(spark):
    state = folders.IncrementalRemoval(spark, threshold=0.9)
    make = lambda ids: spark.createDataFrame([(i, [1.0, 2.0]) for i in ids], "data_index long, embedding array<double>")
    assert state.add(make(range(300)), 0).count() == 299
    assert state.add(make(range(300, 450)), 1).count() == 150
    assert [r["id"] for r in state.kept().collect()] == [0]


def test_the_rest_works_without_the_optional_package(tmp_path):
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('simloom.llm'): raise ModuleNotFoundError(name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import simloom.cli, simloom.streaming.folders, simloom.queries\n"
        "assert not [m for m in sys.modules if m.startswith('simloom.llm')]\n"
        "assert 'p5_found' in simloom.queries.queries()\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_every_query_is_callable_and_every_sql_has_its_query():
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(callable(f) for f in entry.queries().values())


def test_checkpoint_folder_is_the_session_s(spark):
    assert runtime.checkpoint_dir(spark) == runtime.checkpoint_dir(spark)
