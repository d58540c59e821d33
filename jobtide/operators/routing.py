"""Topic routing against a table of bindings, for bindings by the thousands.

``messages.route`` tests each pattern on each message, which suits a handful of handlers.  Here the patterns are rows, and
most differ from each other in their words only: ``order.17.#`` and ``order.18.#`` have one shape, ``ww#``.  A message
is looked up once per shape that its number of words allows, by its words at the places where the shape has words.  So the cost
of a message depends on the number of shapes, not of bindings, and the look-up is an equality join.

The words before the first ``#`` and after the last one are looked up.  Patterns with words between two ``#`` are looked up
by one of these as well, the one that the fewest patterns have, with each word of the message.  What is looked up is a hash,
and what it finds is confirmed by a regular expression afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_SHAPES = "__shapes"


def _words(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, r"\."))


def _mask(words: Column) -> Column:
    """``w`` for a word, ``*`` for any one word."""
    return F.array_join(F.transform(words, lambda w: F.when(w == "*", "*").otherwise("w")), "")


def _dotted_regex(words: Column) -> Column:
    """Regular expression over a key whose words all have a dot before them."""
    escaped = lambda w: F.regexp_replace(w, "([^A-Za-z0-9_])", r"\\$1")
    any_word = r"\.[^.]+"
    part = lambda w: F.when(w == "#", rf"(?:{any_word})*").when(w == "*", any_word).otherwise(F.concat(F.lit(r"\."), escaped(w)))
    return F.concat(F.lit("^"), F.array_join(F.transform(words, part), ""), F.lit(r"\z"))


def compile_bindings(bindings: DataFrame) -> DataFrame:
    """Each binding (``exchange``, ``pattern`` and more) with its ``__shape``, the words to look up and what is left to confirm.

    A binding without a pattern or an exchange receives nothing and is left out.
    """
    rows = bindings.where("exchange IS NOT NULL AND pattern IS NOT NULL").withColumn("__words", _words(F.col("pattern")))
    size, first = F.size("__words"), F.array_position("__words", "#").cast("int")
    last = size - F.array_position(F.reverse("__words"), "#").cast("int") + 1
    is_open = first > 0
    between = F.slice("__words", F.greatest(first, F.lit(1)), F.greatest(last - first, F.lit(0)))
    rows = rows.withColumns(
        {
            "__head": F.when(is_open, F.slice("__words", F.lit(1), first - 1)).otherwise(F.col("__words")),
            "__tail": F.when(is_open, F.slice("__words", last + 1, size - last)).otherwise(F.array().cast("array<string>")),
            "__open": is_open,
            "__inner": F.when(is_open, F.filter(between, lambda w: w != "#")).otherwise(F.array().cast("array<string>")),
        }
    )
    inner = rows.select("exchange", "pattern", F.explode(F.filter("__inner", lambda w: w != "*")).alias("word")).distinct()
    times = inner.groupBy("exchange", "word").agg(F.count(F.lit(1)).alias("times"))
    rarest = F.min_by("word", F.struct("times", "word")).alias("__rarest")
    rows = rows.join(inner.join(times, ["exchange", "word"]).groupBy("exchange", "pattern").agg(rarest), ["exchange", "pattern"], "left")
    shape = F.struct(
        _mask(F.col("__head")).alias("head"),
        F.col("__open").alias("open"),
        _mask(F.col("__tail")).alias("tail"),
        F.col("__rarest").isNotNull().alias("within"),
    )
    literal = F.filter(F.concat("__head", "__tail"), lambda w: w != "*")
    return rows.withColumns(
        {
            "__shape": shape,
            "__ends": F.array_join(literal, "."),
            "__within": F.coalesce("__rarest", F.lit("")),
            "__between": F.size("__inner") > 0,
            "__regex": _dotted_regex(F.col("__words")),
        }
    ).drop("__words", "__head", "__tail", "__open", "__inner", "__rarest")


def _hash(shape: Column, ends: Column, within: Column) -> Column:
    return F.xxhash64(shape, ends, within)


def _probes(shapes: Column, words: Column) -> Column:
    """Hashes of shape, words at its ends and word within for each shape whose number of words a key has; each hash once."""
    length = lambda s: F.length(s["head"]) + F.length(s["tail"])
    fitting = F.filter(shapes, lambda s: (F.size(words) == length(s)) | (s["open"] & (F.size(words) >= length(s))))

    def probes(s: Column) -> Column:
        ends = F.concat(
            F.slice(words, F.lit(1), F.length(s["head"])),
            F.slice(words, F.size(words) - F.length(s["tail"]) + 1, F.length(s["tail"])),
        )
        mask = F.concat(s["head"], s["tail"])
        wanted = F.array_join(F.filter(ends, lambda w, i: F.substring(mask, i + 1, F.lit(1)) == "w"), ".")
        within = F.when(s["within"], F.array_distinct(words)).otherwise(F.array(F.lit("")))
        return F.transform(within, lambda w: _hash(s, wanted, w))

    return F.array_distinct(F.flatten(F.transform(fitting, probes)))


def route_by_table(messages: DataFrame, bindings: DataFrame) -> DataFrame:
    """One row per message and binding that it fits: the message with the binding's columns (but ``exchange``).

    ``bindings`` has ``exchange``, ``pattern`` and any further columns that messages do not have; equal bindings each
    receive the message.  Messages without exchange or routing key, or that fit nothing, give no row.
    """
    own = [c for c in bindings.columns if c != "exchange"]
    compiled = compile_bindings(bindings)
    # one row per exchange; patterns have few shapes, however many they are
    shapes = compiled.groupBy("exchange").agg(F.collect_set("__shape").alias(_SHAPES))
    key = F.col("routing_key")
    probed = messages.join(shapes, "exchange").withColumn("__hash", F.explode(_probes(F.col(_SHAPES), _words(key)))).drop(_SHAPES)
    # a message is repeated per shape, so a probe carries one number, and the expression of what it meets decides
    hashed = compiled.select(*[F.col(f"`{c}`") for c in bindings.columns], "__regex", _hash(F.col("__shape"), F.col("__ends"), F.col("__within")).alias("__hash"))
    joined = probed.join(hashed, ["exchange", "__hash"])
    dotted = F.when(key == "", "").otherwise(F.concat(F.lit("."), key))
    return joined.where(F.rlike(dotted, F.col("__regex"))).select(*[F.col(f"`{c}`") for c in messages.columns], *[F.col(f"`{c}`") for c in own])


def unrouted_by_table(messages: DataFrame, bindings: DataFrame) -> DataFrame:
    """Messages that fit no binding, also those without exchange or routing key."""
    keys = messages.select("exchange", "routing_key").distinct()
    reached = route_by_table(keys, bindings.select("exchange", "pattern")).select("exchange", "routing_key").distinct()
    return messages.join(reached, ["exchange", "routing_key"], "left_anti").select(*[F.col(f"`{c}`") for c in messages.columns])
