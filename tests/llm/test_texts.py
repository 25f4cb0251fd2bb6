"""Text operators and splits against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from simloom.llm import leakage, packing, spans, splits


def documents(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return df.withColumn("h", F.lit(1)).withColumn("at", F.lit(2)).withColumn("t", F.lit(3)) if extra else df


# --- containers


@pytest.fixture
def words_counter():
    def make():
        return lambda texts: [len(t.split()) for t in texts]

    return make


def test_containers_hold_every_text_once_and_never_overflow(spark, words_counter):
    rnd = random.Random(1)
    sizes = {i: rnd.choice([0, 1, 2, 3, 7, 20, 33, 34, 50, 51, 99, 100, 101, 250]) for i in range(500)}
    rows = [(i, " ".join(["w"] * n)) for i, n in sizes.items()] + [(900, None), (None, "w w")]
    counts = packing.token_counts(documents(spark, rows), counter=words_counter)
    assert {r["doc_id"]: r["tokens"] for r in counts.collect()} == sizes
    packed = packing.pack(counts, capacity=100, classes=8)
    got = packed.collect()
    load, parts = {}, {}
    for r in got:
        load[r["container"]] = load.get(r["container"], 0) + r["tokens"]
        parts.setdefault(r["doc_id"], []).append(r)
    assert max(load.values()) <= 100
    assert {d: sum(r["tokens"] for r in rs) for d, rs in parts.items()} == sizes
    assert all(len(rs) == max(1, -(-sizes[d] // 100)) for d, rs in parts.items())
    assert {r[0] for r in packing.cut_texts(packed).collect()} == {d for d, n in sizes.items() if n > 100}
    fill = packing.container_fill(packed, 100).first()
    assert fill["tokens"] == sum(sizes.values()) and fill["fill"] > 0.7


def test_packing_of_nothing(spark, words_counter):
    counts = packing.token_counts(documents(spark, [(1, "x")]).limit(0), counter=words_counter)
    assert packing.pack(counts).count() == 0


def test_classes_take_fixed_counts():
    import numpy as np

    bins, kind = packing._fill(np.array([60, 40, 60, 34, 34, 50, 30, 30, 5, 5]), 100, 3)
    assert kind.tolist() == [1, 2, 1, 2, 2, 2, 3, 3, 3, 3]
    assert len(set(bins[[0, 2]])) == 2 and bins[1] == bins[3] and bins[4] == bins[5] and len(set(bins[6:])) == 1


def test_long_texts_are_counted_piece_by_piece():
    rnd = random.Random(3)
    text = "".join(rnd.choice(["word ", "x", "  ", "\n", "12 ", "é ", ". "]) for _ in range(4000))
    assert "".join(packing.pieces(text, 100)) == text
    count = packing.tiktoken_counter()
    assert sum(count(packing.pieces(text, 100))) == count([text])[0]
    assert packing.pieces("a" * 250, 100) == ["a" * 100, "a" * 100, "a" * 50]


# --- leaks


def brute_leaks(docs, items, n):
    out = set()
    for d, text in docs:
        for i, item in items:
            if d is None or i is None or text is None or item is None:
                continue
            a, b = leakage.words_of(text), leakage.words_of(item)
            grams = {tuple(b[k : k + n]) for k in range(len(b) - n + 1)}
            if any(tuple(a[k : k + n]) in grams for k in range(len(a) - n + 1)):
                out.add((d, i))
    return out


def test_leaks_against_brute_force(spark):
    rnd = random.Random(5)
    vocabulary = [f"w{k}" for k in range(12)]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i, text(rnd.randrange(0, 30))) for i in range(25)]
    docs = []
    for d in range(60):
        body = text(rnd.randrange(0, 80))
        if rnd.random() < 0.5:
            words = leakage.words_of(rnd.choice(items)[1])
            lo = rnd.randrange(0, max(1, len(words)))
            body += ", " + " - ".join(words[lo : lo + rnd.randrange(1, 20)]).upper() + "! " + text(5)
        docs.append((d, body))
    items += [(100, items[0][1]), (101, None), (None, items[1][1]), (102, ""), (103, "ALL alone, in One two_three")]
    docs += [(200, None), (None, items[1][1]), (201, ""), (202, "all alone in one two three"), (203, (text(10) + " ") * 400 + items[2][1])]
    corpus = documents(spark, docs)
    held = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(5))
    for n in (4, 6, 12):
        found = leakage.leaked_passages(corpus, held, n)
        got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
        assert got == brute_leaks(docs, items, n), n
    by_id = dict(docs)
    for r in leakage.leaked_passages(corpus, held, 4).collect():
        a = leakage.words_of(by_id[r["doc_id"]])[r["doc_from"] : r["doc_from"] + r["run"]]
        b = leakage.words_of(dict(items)[r["item_id"]])[r["item_from"] : r["item_from"] + r["run"]]
        assert a == b and r["run"] >= 4


def test_leaks_of_empty_tables(spark):
    corpus = documents(spark, [(1, "a b c d e f")])
    items = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    assert leakage.leaked_passages(corpus.limit(0), items, 3).count() == 0
    assert leakage.leaked_passages(corpus, items.limit(0), 3).count() == 0
    assert leakage.leaked_passages(corpus, items, 3).count() == 1
    with pytest.raises(ValueError):
        leakage.leaked_passages(corpus, items, 1)


def test_proximity_bridges_changed_words(spark):
    corpus = documents(spark, [(1, "x a b c d Q f g h i y"), (2, "a b c d")])
    items = spark.createDataFrame([(1, "a b c d e f g h i")], "item_id long, text string")
    assert leakage.leaked_passages(corpus, items, 6).count() == 0
    row = leakage.leaked_passages(corpus, items, 6, slop=1).first()
    assert (row["doc_from"], row["item_from"], row["run"]) == (1, 0, 8)


def test_a_stored_index_is_searched_without_the_texts(spark, tmp_path, monkeypatch):
    """Small segments, items in several groups, an index that is added to and opened again: the same passages."""
    rnd = random.Random(6)
    text = lambda n: " ".join(rnd.choice("abcdefg") for _ in range(n))
    docs = [(d, text(60)) for d in range(30)]
    items = spark.createDataFrame([(i, text(20)) for i in range(9)] + [(9, None)], "item_id long, text string")
    whole = {tuple(r) for r in leakage.leaked_passages(documents(spark, docs), items, 5).collect()}
    near = {tuple(r) for r in leakage.leaked_passages(documents(spark, docs), items, 8, slop=1).collect()}
    monkeypatch.setattr(leakage, "SEGMENT_CHARS", 300)
    monkeypatch.setattr(leakage, "MAX_ITEM_WORDS", 50)
    monkeypatch.setattr(leakage, "GRID", 64)
    folder = f"file://{tmp_path}/index"
    for part in (docs[:11], docs[11:]):
        leakage.CorpusIndex(spark, folder).add(documents(spark, part))
    index = leakage.CorpusIndex(spark, folder)
    assert len(index.runs) == 2
    assert whole and {tuple(r) for r in leakage.leaked_passages(None, items, 5, index=index).collect()} == whole
    assert near and {tuple(r) for r in leakage.leaked_passages(None, items, 8, slop=1, index=index).collect()} == near
    # brute force of the proximity matches
    words, want = {d: t.split() for d, t in docs}, set()
    for item, t in ((r["item_id"], r["text"].split()) for r in items.filter("text IS NOT NULL").collect()):
        for d, w in words.items():
            for shift in range(-len(t), len(w)):
                at = [k for k in range(len(t)) if 0 <= k + shift < len(w) and w[k + shift] == t[k]]
                runs = [[at[0]]] if at else []
                for k in at[1:]:
                    runs[-1].append(k) if k - runs[-1][-1] <= 2 else runs.append([k])
                for run in runs:
                    whole_stretch = any(set(range(k, k + 4)) <= set(run) for k in run)
                    if len(run) >= 8 and whole_stretch:
                        want.add((d, item, run[0] + shift, run[0], len(run)))
    assert near == want


# --- shared spans


def brute_spans(docs, least):
    out = set()
    windows = {d: {t[k : k + least] for k in range(len(t) - least + 1)} for d, t in docs if d is not None and t is not None}
    for a in windows:
        for b in windows:
            if a < b and windows[a] & windows[b]:
                out.add((a, b))
    return out


def span_documents():
    rnd = random.Random(8)
    alphabet = "ab \U0001f600é"
    text = lambda n: "".join(rnd.choice(alphabet) for _ in range(n))
    shared = [text(n) for n in (29, 30, 31, 60, 200)]
    docs = [(d, text(rnd.randrange(0, 90)) + rnd.choice(shared) + text(rnd.randrange(0, 90))) for d in range(60)]
    docs += [(100, shared[3]), (101, shared[3]), (102, None), (None, shared[3]), (103, ""), (104, "a" * 500), (105, "a" * 300), (106, shared[4] * 50)]
    return docs


@pytest.mark.parametrize("batches", [1, 3])
def test_spans_against_brute_force(spark, batches):
    docs = span_documents()
    found = spans.shared_spans(documents(spark, docs), least=30, gram=20, batches=batches)
    got = {tuple(r) for r in spans.sharing_pairs(found).collect()}
    assert got == brute_spans(docs, 30)
    by_id = dict(docs)
    for r in found.collect():
        assert r["run"] >= 30
        assert by_id[r["doc_a"]][r["from_a"] : r["from_a"] + r["run"]] == by_id[r["doc_b"]][r["from_b"] : r["from_b"] + r["run"]]


def test_shared_amount_covers_all_shared_characters(spark):
    docs = [(d, t) for d, t in span_documents() if d is not None and t is not None and d not in (104, 105)]
    df = documents(spark, docs)
    found = spans.shared_spans(df, least=30, gram=20)
    got = {r["doc_id"]: (r["n_chars"], r["shared_chars"]) for r in spans.shared_amount(df, found).collect()}
    seen = {}
    for d, t in docs:
        for k in range(len(t) - 29):
            seen.setdefault(t[k : k + 30], set()).add(d)
    want = {}
    for d, t in docs:
        marks = [False] * len(t)
        for k in range(len(t) - 29):
            if len(seen[t[k : k + 30]]) > 1:
                marks[k : k + 30] = [True] * 30
        if any(marks):
            want[d] = (len(t), sum(marks))
    assert got == want


def test_later_batches_meet_earlier_runs(spark):
    rnd = random.Random(2)
    text = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    passage = text(60)
    index = spans.SpanIndex(spark, least=30, gram=20)
    index.MAX_RUNS = 2
    parts = [documents(spark, [(10 * b + k, text(40) + (passage if k == 1 else "") + text(40)) for k in range(3)]) for b in range(4)]
    counts = [index.add(p).select("doc_id").distinct().count() for p in parts]
    assert counts == [0, 2, 3, 4] and len(index.runs) <= 2


def test_calls_on_one_index_equal_one_call_on_all(spark, tmp_path, monkeypatch):
    """Links to texts of earlier calls are found, also after opening the index again and compacting it."""
    monkeypatch.setattr(spans.SpanIndex, "MAX_RUNS", 2)
    docs = span_documents()
    whole = {tuple(r) for r in spans.shared_spans(documents(spark, docs), least=30, gram=20).collect()}
    found = set()
    for number in range(4):
        index = spans.SpanIndex(spark, f"file://{tmp_path}/index", least=30, gram=20, texts=True)
        assert bool(index.runs) == (number > 0)
        part = documents(spark, docs[number::4])
        found |= {tuple(r) for r in spans.shared_spans(part, batches=1, index=index).collect()}
    assert found == whole and whole
    bare = spans.SpanIndex(spark, least=30, gram=20)
    bare.add(documents(spark, docs))
    with pytest.raises(ValueError):
        spans.shared_spans(documents(spark, docs), index=bare)


def test_hot_fingerprints_in_blocks_change_nothing(spark, monkeypatch):
    docs = span_documents()
    whole = {tuple(r) for r in spans.shared_spans(documents(spark, docs), least=30, gram=20).collect()}
    monkeypatch.setattr(spans, "BLOCK", 3)
    cut = {tuple(r) for r in spans.shared_spans(documents(spark, docs), least=30, gram=20).collect()}
    assert whole == cut


def test_spans_of_nothing(spark):
    df = documents(spark, [(1, "x" * 10), (2, None)])
    assert spans.shared_spans(df, least=30, gram=20).count() == 0
    assert spans.shared_spans(df.limit(0), least=30, gram=20).count() == 0


def test_window_hashes_are_equal_only_for_equal_windows():
    rnd = random.Random(4)
    text = "".join(rnd.choice("ab") for _ in range(600))
    for gram in (1, 3, 8, 21):
        held = {}
        for k, h in enumerate(spans.window_hashes(spans.code_points(text), gram).tolist()):
            assert held.setdefault(text[k : k + gram], h) == h
        assert len(set(held.values())) == len(held)


# --- splits


def listing(spark, rows):
    df = spark.createDataFrame([(i, f, p) for i, (f, p) in enumerate(rows)], "list_pos long, folder string, file_path string")
    return df.withColumn("a", F.lit(1)).withColumn("subject", F.lit("x"))


def test_components_and_splits(spark, rows):
    data = []
    for k in range(40):
        data += [(f"G{k}/", f"x/s{k}/p{j}.jpg") for j in range(5)]
    data += [("g0", "y/S1/p.jpg"), (" g1", "y\\portraits\\s2_7.jpg"), ("g5", None), (None, "x/s9/p.jpg"), ("alone", "")]
    components = splits.folder_components(listing(spark, data))
    assert rows(splits.together(components)) == [("g0", "g1"), ("g0", "g2"), ("g1", "g2")]
    shares = spark.createDataFrame([("train", 0.8), ("validation", 0.1), ("test", 0.1), ("none", 0.0)], "split_name string, fraction double")
    got = splits.assign_splits(components, shares).collect()
    assert len(got) == 41
    of = {r["folder"]: r["split_name"] for r in got}
    assert of["g0"] == of["g1"] == of["g2"]
    weight = {s: sum(5 for f in of if of[f] == s) for s in ("train", "validation", "test")}
    assert 130 <= weight["train"] <= 180 and min(weight.values()) >= 5
    assert rows(splits.assign_splits(components, shares)) == rows(splits.assign_splits(components, shares))


def test_splits_of_empty_tables(spark):
    empty = listing(spark, [("a", "b")]).limit(0)
    components = splits.folder_components(empty)
    shares = spark.createDataFrame([("train", 1.0)], "split_name string, fraction double")
    assert components.count() == 0 and splits.assign_splits(components, shares).count() == 0
    one = splits.folder_components(listing(spark, [("a", "b/c.jpg")]))
    assert splits.assign_splits(one, shares).count() == 1
    assert splits.assign_splits(one, shares.limit(0)).count() == 0


def test_contraction_of_paths_and_stars(spark):
    pairs = [(i, i + 1) for i in range(0, 70)] + [(200, 200 + i) for i in range(1, 30)]
    df = spark.createDataFrame(pairs + [(5, 5), (None, 2)], "a long, b long")
    got = {r["node"]: r["component"] for r in splits.contract(df).collect()}
    assert len(got) == 71 + 30
    assert len({got[i] for i in range(71)}) == 1 and len({got[i] for i in range(200, 230)}) == 1
    assert got[0] != got[200]


def test_shared_spans_leave_a_compacted_index(spark):
    df = documents(spark, [(n, f"{n:03d} " * 20) for n in range(8)])
    index = spans.SpanIndex(spark, least=30, gram=20)
    spans.shared_spans(df, least=30, gram=20, index=index).count()
    assert len(index.runs) == 1
    want = sorted(tuple(r) for r in spans.fingerprints(df, "doc_id", "text", 30, 20).collect())
    assert want and sorted(tuple(r) for r in index._read(index.runs[0]).collect()) == want


def test_a_proximity_query_is_registered(spark, tmp_path):
    from simloom.llm import queries

    words = [f"w{n}" for n in range(20)]
    changed = words[:8] + ["other"] + words[9:]
    spark.createDataFrame([(1, " ".join(changed))], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(5, " ".join(words))], "item_id long, text string").write.parquet(f"{tmp_path}/eval_items.parquet")
    named = queries.queries()
    assert [tuple(r) for r in named["p9_near"](spark, str(tmp_path)).collect()] == [(1, 5, 0, 0, 19)]
    assert named["p9_found"](spark, str(tmp_path)).count() == 0
