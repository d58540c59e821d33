"""Near duplicates, fingerprints, classifier, shards, components and the pipeline."""

import random
import re

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from jobtide.llm import near_dedup, order_minhash, quality_classifier, sharding
from jobtide.llm.components import connected_components
from jobtide.llm.tables import stored

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts, strict=True)], SCHEMA)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def groups_by_brute_force(texts):
    sets, label = [shingles(t) for t in texts], list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    return [len(s) for s in sets], label


def near_texts():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [None, "", " \n", "one", "One", "two words", "Two  Words", "a b c d", "a b c d e", "A b c d e\n", "é b", "É b"]
    for size in (8, 20, 60, 200):
        for _ in range(6):
            base = rng.choices(vocabulary, k=size)
            texts.append(" ".join(base))
            for _ in range(8):
                copy = list(base)
                for _ in range(rng.randint(0, max(1, size // 25))):
                    copy[rng.randrange(size)] = rng.choice(vocabulary)
                texts.append(" ".join(copy[: rng.randint(size * 8 // 10, size)]))
    shared = rng.choices(vocabulary, k=30)
    texts += [" ".join(shared + rng.choices(vocabulary, k=rng.randint(2, 14))) for _ in range(60)]
    return texts


def test_near_duplicates(spark):
    texts = near_texts()
    sizes, label = groups_by_brute_force(texts)
    rows = near_dedup.near_duplicates(frame(spark, texts).repartition(7)).orderBy("doc_id").collect()
    assert [r.n_shingles for r in rows] == sizes
    assert [r.component_id for r in rows] == label
    assert [r.kept for r in rows] == [i == x for i, x in enumerate(label)]


def test_chains_whose_centre_is_not_shared(spark):
    """Neighbours are alike, the ends are not: one component all the same."""
    words = [f"v{i}" for i in range(400)]
    texts = [" ".join(words[i * 12 : i * 12 + 120]) for i in range(23)]
    order = random.Random(2).sample(range(23), 23)
    rows = near_dedup.near_duplicates(frame(spark, [texts[i] for i in order])).collect()
    assert {r.component_id for r in rows} == {0}


def test_near_duplicates_on_odd_rows(spark):
    text = " ".join(f"x{i}" for i in range(30))
    docs = frame(spark, [text, text, text, None, None, text + " y", "z"], [5, None, 5, 1, None, 3, None]).withColumn("row", quality_classifier.F.lit("clash"))
    rows = near_dedup.near_duplicates(docs).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in rows) == sorted(
        [(5, 3, False), (-1, 3, False), (5, 3, False), (1, 1, True), (-1, -1, True), (3, 3, True), (-1, -1, True)]
    )
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, -1, 1, 3]
    only_null = frame(spark, [text, text], [None, None])
    assert near_dedup.drop_near_duplicates(only_null).count() == 1
    assert near_dedup.near_duplicates(docs.where("false")).count() == 0


def test_repeated_rows_stay_once(spark):
    docs = frame(spark, ["a b c d e f"] * 3 + ["other words are here now"], [7, 7, 9, 2])
    assert sorted(r.doc_id for r in near_dedup.drop_near_duplicates(docs).collect()) == [2, 7]


def test_densified_signatures_estimate_likeness():
    rng = np.random.default_rng(1)
    for size in (4, 40, 400):
        same = []
        for _ in range(60):
            union = rng.integers(0, 2**63, size, np.uint64)
            a, b = np.unique(union), np.unique(union[: size * 3 // 4])
            same.append((near_dedup.signature(a) == near_dedup.signature(b)).mean())
        assert abs(np.mean(same) - 0.75) < 0.05


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000, i) for i in range(1001, 1100)] + [(2000 + i, 2001 + i) for i in range(50)]
    label = {x: x for e in edges for x in e}
    for _ in label:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
        if not changed:
            break
    rows = connected_components(spark.createDataFrame([*edges, (5000, 5000), (None, 1)], "a BIGINT, b BIGINT")).collect()
    alone = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.component for r in rows} == {x: c for x, c in label.items() if x not in alone}
    assert connected_components(spark.createDataFrame([], "a STRING, b STRING")).count() == 0


@pytest.mark.parametrize("kind", ["rising", "falling", "random", "hub"])
def test_components_take_few_rounds(spark, kind):
    size = 2_000
    names = list(range(size))
    if kind == "falling":
        names.reverse()
    if kind == "random":
        random.Random(4).shuffle(names)
    edges = [(size, name) for name in range(100_000)] if kind == "hub" else list(zip(names, names[1:]))
    steps = []

    def store(df, name):
        steps.append(name)
        return stored(df, name)

    rows = connected_components(spark.createDataFrame(edges, "a BIGINT, b BIGINT"), store=store)
    assert rows.where("component = 0").count() == rows.count() == len({x for e in edges for x in e})
    # a chain in random order falls geometrically; ordered ones and hubs are one tree
    assert steps.count("parents") <= (15 if kind == "random" else 2)
    assert steps.count("parents") + steps.count("jumps") <= (24 if kind == "random" else 14)


def test_fingerprints(spark):
    rng = random.Random(6)
    long = "".join(rng.choices("abcdefgh ", k=40_000))
    texts = ["", None, "short", "a" * 5000, "the cat sat on the mat and looked around", "the cat sat on the mat and looked around!", "é👩‍👧 x" * 9, long]
    rows = order_minhash.report(frame(spark, texts).repartition(3)).orderBy("doc_id").collect()
    assert rows[0].fingerprint == rows[1].fingerprint and rows[0].near_next == 1.0
    assert rows[4].near_next > 0.5 > rows[5].near_next
    for i, r in enumerate(rows):
        text, after = texts[i] or "", texts[(i + 1) % len(texts)] or ""
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        assert r.n_chars == len(text)
        assert r.edited_fingerprint == order_minhash.sketches(edited).astype(">u4").tobytes().hex()
    one = order_minhash.report(frame(spark, ["just one"], [4])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert order_minhash.report(frame(spark, [])).count() == 0


def test_next_documents_with_ties_and_nulls(spark):
    ids = [None, None, 3, 3, -(2**62), 2**62, 10]
    texts = ["n2", "n1", "t2", "t1", "low", "high", "ten"]
    rows = order_minhash.with_next(order_minhash.fingerprints(frame(spark, texts, ids))).collect()
    assert {r.text: r.next_text for r in rows} == dict(zip(["n1", "n2", "low", "t1", "t2", "ten", "high"], ["n2", "low", "t1", "t2", "ten", "high", "n1"], strict=True))


def test_order_counts():
    """Swapped halves have the same k-mers but for the joint, yet another order."""
    rng = random.Random(3)
    a, b = ("".join(rng.choices("abcdefgh", k=2000)) for _ in range(2))
    same = (order_minhash.sketches(a + b) == order_minhash.sketches(b + a)).mean()
    assert 0.3 < same < 0.7
    assert (order_minhash.sketches(a) == order_minhash.sketches(a)).all()


def test_repeats_are_numbered():
    kmers = order_minhash.numbered_kmers("ab" * 50)
    assert len(set(kmers.tolist())) == len(kmers)


def test_classifier(spark):
    larger = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{larger}/documents.parquet"), spark.read.parquet(f"{larger}/labels.parquet")
    extra = docs.withColumn("score", quality_classifier.F.lit("clash"))
    rows = {r.doc_id: r for r in quality_classifier.scored(extra, labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    good = [rows[i].predicted for i, q in truth.items() if q == 1]
    assert sum(good) >= 0.95 * len(good)
    held = {q: [rows[i].score for i in truth if truth[i] == q and rows[i].held_out] for q in (0, 1)}
    assert np.mean([[a > b for a in held[1]] for b in held[0]]) > 0.9


def test_classifier_learns_only_from_the_other_folds(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", quality_classifier.F.when(quality_classifier.held_out(labels.doc_id), 1 - labels.quality).otherwise(labels.quality))
    a, b = (sorted(map(tuple, quality_classifier.scored(docs, x).collect())) for x in (labels, turned))
    assert a == b


def test_classifier_on_odd_input(spark):
    docs = frame(spark, [None, "", "x" * 200_000, "Shti " * 5, "w"], [1, 2, 3, None, 4])
    none = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    assert {r.score for r in quality_classifier.scored(docs, none).collect()} == {0.5}
    few = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 1, 1), (3, 0, 0), (3, 1, 0), (4, 1, 0)], "doc_id BIGINT, quality INT, toxic INT")
    rows = quality_classifier.scored(docs, few).collect()
    assert len(rows) == 5 and not any(np.isnan(r.score) for r in rows)
    assert quality_classifier.scored(docs.where("false"), few).count() == 0


def filled(shards, slots):
    """Turn by turn with whole preference lists."""
    lists = [[(o + j * s) % slots for j in range(slots)] for o, s in (sharding.preference(n, slots) for n in shards)]
    held, at = {}, [0] * len(shards)
    while len(held) < slots:
        for n, wanted in enumerate(lists):
            while at[n] < slots and wanted[at[n]] in held:
                at[n] += 1
            if len(held) < slots:
                held[wanted[at[n]]] = n
    return [held[i] for i in range(slots)]


@pytest.mark.parametrize(("count", "slots"), [(1, 7), (3, 7), (7, 7), (10, 251), (64, 4099)])
def test_shard_table(count, slots):
    names = [f"s{i}" for i in range(count)]
    table = sharding.lookup_table(names, slots)
    assert table == filled(names, slots)
    sizes = np.bincount(table, minlength=count)
    assert sizes.max() - sizes.min() <= 1


def test_shards_stay_when_one_goes():
    names = [f"s{i}" for i in range(20)]
    before, after = sharding.lookup_table(names, 4099), sharding.lookup_table(names[:-1], 4099)
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != 19)
    assert moved < 0.1 * 4099
    with pytest.raises(ValueError, match="prime"):
        sharding.lookup_table(names, 4100)


def test_shard_placement(spark):
    docs = frame(spark, ["a", "b", "c", None], [1, 1, None, 2]).withColumn("slot", quality_classifier.F.lit("clash"))
    rows = sharding.place(docs).collect()
    assert len(rows) == 4 and len({(r.doc_id, r.shard) for r in rows}) == 3
    plan = sharding.place(docs)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan
    assert sharding.place(docs.where("false")).count() == 0


def test_pipeline_stages(spark):
    """Each stage's decisions take effect; clean and single documents stay."""
    docs, before = spark.read.parquet(f"{SF}/documents.parquet"), None
    texts = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:4]:
        after = pd.DataFrame([r.asDict() for r in stage(spark, docs, SF).collect()])
        assert list(after.columns) == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "near_dedup":
            _, label = groups_by_brute_force(list(before.text))
            least = before.doc_id.groupby(np.array(label)).min()
            assert sorted(after.doc_id) == sorted(least)
        elif name == "quality_rules":
            want = [i for i in before.doc_id if len(texts[i].split()) >= 20]
            assert set(after.doc_id) <= set(want) and len(after) > 0.8 * len(want)
        elif name == "secret_scan":
            assert list(sorted(after.doc_id)) == sorted(before.doc_id)
            assert not after.text.str.contains(r"token = \"[0-9a-f]{16}").any()
        before = after
        docs = spark.createDataFrame(after, SCHEMA)
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SF).toPandas()
    assert set(packed.doc_id) == set(before.doc_id)
    assert (packed.groupby("doc_id").length.sum() == packed.groupby("doc_id").doc_tokens.first()).all()


def test_pipeline_without_documents(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").where("false").write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
