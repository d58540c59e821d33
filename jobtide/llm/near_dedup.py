"""Near duplicates: one-permutation hashing, optimal densification, banded buckets, star edges.

1. Every text's set of 5-word shingles is hashed once.  The hash space is cut into ``BINS`` bins and the
   smallest hash of each bin is kept; an empty bin borrows from the first filled bin in a random order
   of its own (optimal densification), so small sets get independent values too.  ``ROWS`` bins make
   one of ``BANDS`` band keys.  A pair with similarity 0.75 shares no key with probability below 1e-5.
2. Texts with the same set are one node, so copies never meet in a bucket.
3. In each bucket the member that shares the most buckets with the most others is the centre (the text
   the copies come from, or the one with the least beside a shared passage), and the others get one edge to it:
   a star, so the number of candidate pairs is bounded by the number of members.  They are confirmed on full sets.
4. Stars alone would lose a link between two members neither of which is like the centre.  Members of buckets
   that are still in different components are therefore looked up by their rarest shingles, one of
   which any two alike sets share (prefix filter), and pairs across components are confirmed as well.
5. Components of confirmed links; the smallest doc_id of each names it.

Results for odd input: without words (null, empty, blanks) the set is empty and nothing is linked;
fewer than five words are one shingle; repeated rows are copies of each other; a row with a null
id takes part, names no component unless all members lack one (then ``component_id`` is null), and is
kept only if no member has an id and it is the first; an empty table gives an empty table; extra columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf

from jobtide.llm.components import connected_components
from jobtide.llm.tables import Scratch, stored

Store = Callable[[DataFrame, str], DataFrame]
SHINGLE = 5
BINS, BANDS, ROWS = 128, 32, 4
LIKE = 75  # per cent
_STEPS = np.random.default_rng(20240607)
_FACTORS = _STEPS.integers(1, 2**63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
_ORDERS = np.stack([_STEPS.permutation(BINS) for _ in range(BINS)])
_BAND_FACTORS = _STEPS.integers(1, 2**63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = text.encode().lower().split() if text else []  # bytes: A-Z only, ASCII blanks only
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(hashes.tobytes())], np.uint64)
    count = len(words) - SHINGLE + 1
    total = np.zeros(count, np.uint64)
    for i in range(SHINGLE):
        total += _mixed(hashes[i : i + count] * _FACTORS[i])
    return np.unique(_mixed(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Smallest hash per bin of a sorted, non-empty set; empty bins borrow."""
    bins = (shingles >> np.uint64(57)).astype(np.int64)
    filled, first = np.unique(bins, return_index=True)
    values = np.zeros(BINS, np.uint64)
    values[filled] = shingles[first]
    if len(filled) < BINS:
        has = np.zeros(BINS, bool)
        has[filled] = True
        empty = np.flatnonzero(~has)
        orders = _ORDERS[empty]
        values[empty] = values[orders[np.arange(len(empty)), has[orders].argmax(axis=1)]]
    return values


def band_keys(values: np.ndarray) -> np.ndarray:
    mixed = _mixed(values.reshape(BANDS, ROWS) * _BAND_FACTORS)
    return _mixed(mixed.sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _marks(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        shingles = shingle_set(text)
        if len(shingles):
            rows.append((len(shingles), xxhash.xxh3_128_digest(shingles.tobytes()), band_keys(signature(shingles))))
        else:
            rows.append((0, None, None))
    return pd.DataFrame(rows, columns=["n_shingles", "digest", "bands"])


def _sets(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: shingle_set(text).view(np.int64))


def _alike(common: Column, n_a: Column, n_b: Column) -> Column:
    return common * 100 >= (n_a + n_b - common) * LIKE


def _measured(pairs: DataFrame, sets: DataFrame, store: Store) -> DataFrame:
    """Pairs (a, b) with their sizes and the size of the intersection of their full sets."""
    sizes = sets.select("node", "n")
    near = (
        pairs.join(sizes.toDF("a", "n_a"), "a")
        .join(sizes.toDF("b", "n_b"), "b")
        .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * LIKE)
    )
    near = store(near, "pairs")
    with_b = near.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
    both = with_b.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
    return both.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("set_a", "set_b")).cast("bigint").alias("common"))


def _rest(buckets: DataFrame, labels: DataFrame, sets: DataFrame, store: Store) -> DataFrame:
    """Pairs of members of one bucket in different components, as far as they can be alike.

    Buckets of texts that share a long passage hold many members that are no duplicates.  Two sets
    that are alike share one of the rarest shingles of each (the first quarter in a common order), and
    a shared passage is not rare among these members, so they are looked up by their rarest shingles.
    """
    members = (
        buckets.where("node != centre")
        .join(labels, "node", "left")
        .select("band", "node", F.coalesce("component", "node").alias("component"))
    )
    members = store(members, "members")
    split = members.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
    nodes = store(members.join(split.select("band"), "band", "left_semi").select("node", "component").distinct(), "open")

    rows = sets.join(nodes, "node").select("node", "component", "n", F.explode("shingles").alias("shingle"))
    known = store(rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "frequencies")
    own = Window.partitionBy("node")
    # shingles that occur once come first of all; they are counted, not listed
    place = F.col("n") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("times", "shingle"))
    rare = rows.join(known, "shingle").withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * LIKE / 100) + 1)
    rare = store(rare.select("shingle", "node", "component", "n", "place"), "rare")

    mixed = rare.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
    rare = store(rare.join(store(mixed.select("shingle"), "mixed"), "shingle"), "rare")
    # in each look-up the members of the largest component do not pair with each other
    most = rare.groupBy("shingle", "component").count().groupBy("shingle").agg(F.max_by("component", F.struct("count", "component")).alias("main"))
    rare = rare.join(store(most, "main"), "shingle").withColumn("seeks", F.col("component") != F.col("main")).drop("main")
    rare = store(rare, "rare")

    # of two alike sets the smaller shares with the larger at least 2t / (1 + t) of itself
    small = rare.where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * 2 * LIKE / (100 + LIKE)) + 1)
    x, y = small.alias("x"), rare.alias("y")
    least = F.ceil((F.col("x.n") + F.col("y.n")) * LIKE / (100 + LIKE))
    fits = (
        (F.col("x.shingle") == F.col("y.shingle"))
        & (F.col("x.component") != F.col("y.component"))
        & ((F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.node") < F.col("y.node"))))
        & (F.col("x.n") * 100 >= F.col("y.n") * LIKE)
        & (F.col("x.place") <= F.col("x.n") - least + 1)
        & (F.col("y.place") <= F.col("y.n") - least + 1)
    )
    pairs = x.where("seeks").join(y, fits).unionAll(x.where("NOT seeks").join(y.where("seeks"), fits))
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _labelled(docs: DataFrame, doc_id: str, text: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """The stored input (row, document, marks) and one label row per input row."""
    document = F.struct(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("columns") if columns else F.lit(True).alias("columns"))
    marked = docs.select(document.alias("document")).withColumn("mark", pandas_udf(_marks, "n_shingles bigint, digest binary, bands array<bigint>")("document.text"))
    marks = stored(marked.select(F.monotonically_increasing_id().alias("row"), "document", "mark.*"), "marks")

    scratch = Scratch(docs.sparkSession, "near-duplicates")
    store = scratch.store
    # copies become one node, named by their first row
    nodes = store(marks.where("digest IS NOT NULL").groupBy("digest").agg(F.min("row").alias("node")), "nodes")
    banded = marks.select(F.col("row").alias("node"), "bands", F.col("n_shingles").alias("n")).join(nodes.select("node"), "node")
    keys = store(banded.select("node", "n", F.explode("bands").alias("band")), "bands")
    sizes = keys.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = store(keys.join(store(sizes, "sizes"), "band"), "shared")
    weights = store(shared.groupBy("node").agg(F.sum("size").alias("weight")), "weights")
    weighed = shared.join(weights, "node")
    centres = weighed.groupBy("band").agg(F.max(F.struct("weight", -F.col("n"), "node")).alias("first"))
    centres = store(centres.select("band", F.col("first.node").alias("centre")), "centres")
    buckets = store(shared.drop("size").join(centres, "band"), "buckets")

    wanted = store(buckets.select("node").distinct(), "candidates")
    texts = marks.select(F.col("row").alias("node"), "document.text", F.col("n_shingles").alias("n")).join(wanted, "node")
    sets = store(texts.select("node", "n", pandas_udf(_sets, "array<bigint>")("text").alias("shingles")), "sets")

    edges = buckets.where("node != centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    first = store(_measured(edges, sets, store), "measured")
    linked = _alike(F.col("common"), F.col("n_a"), F.col("n_b"))
    labels = connected_components(first.where(linked), store=store)
    more = store(_measured(_rest(buckets, labels, sets, store), sets, store).where(linked).select("a", "b"), "links")
    if not more.isEmpty():
        labels = connected_components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more), store=store)

    groups = nodes.join(labels, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    given = marks.select("row", "document.doc_id", "n_shingles", "digest")
    rows = stored(given.join(store(groups, "groups"), "digest", "left").drop("digest"), "rows")
    heads = (
        rows.where("component IS NOT NULL")
        .groupBy("component")
        .agg(F.min("doc_id").alias("least_id"), F.min(F.when(F.col("doc_id").isNull(), F.col("row"))).alias("least_row"))
    )
    named = rows.join(stored(heads, "heads"), "component", "left")
    # marks, rows and heads stay for whoever reads the result
    scratch.discard()
    alone = F.col("component").isNull()
    by_id = F.when(F.col("doc_id").isNotNull(), F.col("doc_id").eqNullSafe(F.col("least_id")))
    kept = F.when(alone, F.lit(True)).otherwise(F.coalesce(by_id, F.col("least_id").isNull() & (F.col("row") == F.col("least_row"))))
    component_id = F.when(alone, F.col("doc_id")).otherwise(F.col("least_id"))
    return marks, named.select("row", "doc_id", "n_shingles", component_id.alias("component_id"), kept.alias("kept"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept."""
    return _labelled(docs, doc_id, text, [])[1].drop("row")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, with all its columns.

    Rows that repeat the id of a document that stays count as that document; the first one read stays.
    """
    marks, labels = _labelled(docs, doc_id, text, docs.columns)
    labels = stored(labels.select("row", "doc_id", "kept"), "labelled")
    kept = labels.where("kept")
    first = kept.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("row").alias("row")).select("row")
    stay = stored(first.unionByName(kept.where("doc_id IS NULL").select("row")), "kept")
    # the rows that go are the fewer ones; where their list is small the texts need not move
    gone = stored(labels.select("row").join(stay, "row", "left_anti"), "dropped")
    return marks.join(gone, "row", "left_anti").select("document.columns.*")
