"""Routing against a table of bindings, next to the word-by-word definition of topic patterns."""

import random

from pyspark.sql import functions as F

from jobtide.operators import routing


def fits(pattern, words):
    if not pattern:
        return not words
    if pattern[0] == "#":
        return fits(pattern[1:], words) or (bool(words) and words[0] != "" and fits(pattern, words[1:]))
    if not words or not (pattern[0] == words[0] or (pattern[0] == "*" and words[0] != "")):
        return False
    return fits(pattern[1:], words[1:])


def words_of(text):
    return text.split(".") if text else []


def expected(keys, patterns):
    return sorted((e, k, p) for e, k in keys for x, p in patterns if None not in (e, k, x, p) and e == x and fits(words_of(p), words_of(k)))


def test_all_short_patterns(spark):
    """Any pattern and key of up to four words, the odd ones too."""
    rng = random.Random(11)
    alphabet = ["a", "b", "*", "#", "", "a+(", "$1"]
    patterns = {("x", ".".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 5)))) for _ in range(500)}
    patterns |= {("x", "#"), ("x", ""), ("x", "#.#"), ("x", "#.a.#.b.#"), ("x", "a.#.#.b"), ("y", "a.*"), ("x", None), (None, "a")}
    keys = {("x", ".".join(rng.choice(["a", "b", "", "a+(", "$1", "*", "a\n"]) for _ in range(rng.randrange(0, 5)))) for _ in range(200)}
    keys |= {("x", ""), ("y", "a.b"), ("z", "a"), (None, "a"), ("x", None)}
    keys = {(e, k) for e, k in keys if k is None or "#" not in k}
    messages = spark.createDataFrame(sorted(keys, key=str), "exchange STRING, routing_key STRING")
    bindings = spark.createDataFrame(sorted(patterns, key=str), "exchange STRING, pattern STRING")
    got = routing.route_by_table(messages, bindings).collect()
    want = expected(keys, patterns)
    assert sorted((r.exchange, r.routing_key, r.pattern) for r in got) == want
    reached = {(e, k) for e, k, _ in want}
    lost = {tuple(r) for r in routing.unrouted_by_table(messages, bindings).collect()}
    assert lost == keys - reached


def test_further_columns_and_repeats(spark):
    messages = spark.createDataFrame([("x", "a.b", 1), ("x", "a.b", 2)], "exchange STRING, routing_key STRING, `odd name` INT")
    bindings = spark.createDataFrame([("h", "x", "a.*"), ("h", "x", "a.*"), ("g", "x", "#")], "handler STRING, exchange STRING, pattern STRING")
    got = routing.route_by_table(messages, bindings)
    assert got.columns == ["exchange", "routing_key", "odd name", "handler", "pattern"]
    assert sorted((r["odd name"], r.handler) for r in got.collect()) == [(n, h) for n in (1, 2) for h in ("g", "h", "h")]
    assert routing.route_by_table(messages, bindings.where("false")).count() == 0
    assert routing.unrouted_by_table(messages, bindings.where("false")).count() == 2
    assert routing.route_by_table(messages.where("false"), bindings).count() == 0


def test_ten_thousand_bindings_are_one_look_up_per_shape(spark):
    """No message meets all bindings, also where only words between two ``#`` tell them apart."""
    exchange = F.concat(F.lit("x"), F.col("id") % 2).alias("exchange")
    number = F.col("id").cast("string")
    patterns = F.array(F.concat(F.lit("order."), number, F.lit(".#")), F.concat(F.lit("#.order.#."), number, F.lit(".#.F")))
    bindings = spark.range(10000).select(exchange, F.explode(patterns).alias("pattern"))
    messages = spark.range(20000).select(exchange, F.concat(F.lit("order."), F.col("id") % 12000, F.lit(".F")).alias("routing_key"))
    compiled = routing.compile_bindings(bindings)
    assert compiled.select("__shape").distinct().count() == 2
    assert compiled.groupBy("exchange", "__shape", "__ends", "__within").count().agg(F.max("count")).first()[0] == 1
    routed = routing.route_by_table(messages, bindings)
    assert routed.count() == 2 * (10000 + 8000)
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_a_probe_is_one_number(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        bindings = spark.createDataFrame([("x", "order.1.#"), ("x", "#.2.#.F"), ("x", "*.*.F")], "exchange STRING, pattern STRING")
        messages = spark.createDataFrame([("x", "order.1.F"), ("x", "order.2.F"), ("x", "order..F")], "exchange STRING, routing_key STRING")
        routed = routing.route_by_table(messages, bindings)
        plan = routed._jdf.queryExecution().executedPlan().toString()
        assert not [line for line in plan.splitlines() if "hashpartitioning" in line and "__ends" in line]
        found = sorted((r.routing_key, r.pattern) for r in routed.collect())
    finally:
        spark.conf.set(key, before)
    assert found == [("order.1.F", "*.*.F"), ("order.1.F", "order.1.#"), ("order.2.F", "#.2.#.F"), ("order.2.F", "*.*.F")]
