"""Phrase collocations from a weighted de Bruijn graph of word sequences.

Nodes are sequences of three words, edges the sequences of four that lead from one to the next.

1. **Where edges end.** Pieces end at punctuation.  An edge may also end before a word with which it would hold a pair
   or triple of words that is met fewer than ``LEAST`` times: no phrase over such a place counts, and shorter ones keep
   their counts; edges from rarer words are left out.  Words and pairs are counted in hashed cells first, then triples of
   frequent pairs; a cell's count is never below that of what is in it, so what is in a cell below ``LEAST`` is
   rare for certain.  The other cells are two bit maps, which are broadcast.  There is a cell for every 8 to 16 bytes of
   text, so that as few rare pairs share a cell with others at any size, up to ``MOST_BITS`` (32 MB a map); beyond
   that more edges are longer than they need be, up to one of four words for every word.
2. **Edges.** Every word begins one edge: the four words from it on, or fewer if the edge ends before (the
   correction at a piece's end).  Edges are counted within parts of a task's text, added up over the task, then over all:
   a task hands over each edge it meets once, unless it meets more than ``HELD_BYTES`` of different ones.  An edge is
   handed over by each task that meets it, so splits are joined to two tasks a core, or ``TASK_BYTES`` of text a task if those are more.
3. **Flow.** A node's count is the weight that flows through it: the edges that begin with it and
   the ends of pieces there; two and one words likewise.  So all counts come from the edges.
4. **Paths.** A node through which one edge brings and one takes all its flow is unary.  Edges joined
   by unary nodes are compacted into one path with one weight, in as many rounds as the length of the longest path has
   binary digits.  Inside a path the counts of three words are the weight; only its ends are looked up.
5. **Scores.** A phrase is dropped if one that is a word longer holds it with 80 % of its count (any still longer
   one has no more).  For the others the parts of each cut are looked up, and the lowest cut counts.

Counts are exact: words and phrases are compared as text; hashes serve the cells only.

Results for odd input: a null text is empty; a null language is ``und``, like that name itself; texts
without words add nothing; repeated rows and null ids count each; an empty table gives an empty table;
extra columns of any name are not looked at.  A very long text is one unit of work of its task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from jobtide.llm.tables import Scratch, arrow_rows, shuffles_freed
from jobtide.llm.words import Words, chunks, mixed, split_words, word_hashes

LEAST = 30
LONGEST = 4
COVERED = 80  # per cent
SHOWN = 2_000  # phrases of a language in the report
CELL_BYTES = 16  # of text, for which there is a cell at least
LEAST_BITS, MOST_BITS = 20, 28  # number of cells, as a power of two
ROWS = 2_000  # texts handed to a task together
PART_BYTES = 4_000_000  # of text that is held as words together
HELD_BYTES = 64_000_000  # of different edges that a task adds up before it hands them over
TASK_BYTES = 512_000_000  # of text whose edges a task counts at most, unless the splits are larger
_WAITING = 8_000_000  # bytes of counted edges that are added up together at least
_SENT = 100_000  # edges of a batch that is handed over
_BLOCK, _BLOCKS = 1 << 14, 1 << 12  # cells of a block at least, blocks at most
_TOGETHER = 4_000_000  # cells counted together in a task
_NEXT = np.uint64(0x9E3779B97F4A7C15)
BLANKS = b"\x20\x09"
STOPS = b".,;:!?\x0a\x0b\x0c\x0d"
_KEY = ["lang", "phrase"]
_EDGE = ["phrase", "words", "weight"]


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text")).where("text is not null and text <> ''")


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    for batch in batches:
        lang, text = batch.columns
        for one in lang.unique():
            for some in chunks(text.filter(pc.equal(lang, one)), PART_BYTES):
                yield one.as_py(), split_words(some, BLANKS, STOPS)


def _text_bytes(docs: DataFrame, text: str, lang: str) -> int:
    return _texts(docs, text, lang).agg(F.sum(F.octet_length("text"))).first()[0] or 0


def _bits(size: int) -> int:
    return min(max(LEAST_BITS, (size // CELL_BYTES).bit_length()), MOST_BITS)


def cell_bits(docs: DataFrame, text: str = "text", lang: str = "lang") -> int:
    """Number of cells for the words and pairs of a table's texts, as a power of two."""
    return _bits(_text_bytes(docs, text, lang))


def counting_tasks(size: int, cores: int) -> int:
    """Number of tasks that count the edges of so many bytes of text, if there are not fewer splits."""
    return max(2 * cores, -(-size // TASK_BYTES))


def _cell(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(keys) >> np.uint64(64 - bits)).astype(np.int32)


def _marked(held: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (held[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 == 1


def _ahead(marks: np.ndarray) -> np.ndarray:
    """The next word's mark at each word."""
    return np.append(marks[1:], False)


class _Runs:
    """Cells of the words of some texts and of the pairs and triples that begin there; pairs and triples within pieces only.

    ``held`` has the bit map of words and pairs, then that of triples, as far as they are known.
    """

    def __init__(self, lang: str, words: Words, held: Sequence[np.ndarray], bits: int):
        codes, same_piece = words.codes, np.append(words.piece[1:] == words.piece[:-1], False)
        hashes = word_hashes(words.different, xxhash.xxh3_64_intdigest(lang))
        self.kinds = _cell(hashes, bits)
        following = np.append(hashes[codes[1:]], np.uint64(0))
        pairs = (hashes * _NEXT)[codes] + following
        self.pair_at = np.flatnonzero(same_piece)
        self.pairs = _cell(pairs[self.pair_at], bits)
        if held:
            joined = np.zeros(len(codes), bool)
            joined[self.pair_at] = _marked(held[0], self.pairs)
            third = np.append(following[1:], np.uint64(0))
            self.triple_at = np.flatnonzero(joined & _ahead(joined))
            self.triples = _cell(mixed(pairs[self.triple_at]) * _NEXT + third[self.triple_at], bits)
            # words from each on until a rare pair or triple or the end of the piece; 0 for a rare word
            self.reach = _marked(held[0], self.kinds)[codes].astype(np.int8) + joined
        if len(held) > 1:
            triple = np.zeros(len(codes), bool)
            triple[self.triple_at] = _marked(held[1], self.triples)
            self.reach += triple
            self.reach += triple & _ahead(triple)


def _block(bits: int) -> int:
    """Cells of a block; places in a block have 16 bits."""
    return max(_BLOCK, (1 << bits) // _BLOCKS)


def _handed_over(found: list[np.ndarray], least: int, block: int) -> pa.RecordBatch:
    """Counted cells by blocks, as bytes: the places in the block, then the counts, which matter up to ``least`` only."""
    cells, counts = np.unique(np.concatenate(found), return_counts=True)
    blocks, starts = np.unique(cells // block, return_index=True)
    low, counts = (cells % block).astype(np.uint16), np.minimum(counts, least).astype(np.min_scalar_type(least))
    ends = np.append(starts[1:], len(cells))
    entries = [low[i:j].tobytes() + counts[i:j].tobytes() for i, j in zip(starts, ends)]
    return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(entries, pa.binary())], ["block", "entries"])


def frequent_cells(docs: DataFrame, bits: int, held: Sequence[np.ndarray] = (), text: str = "text", lang: str = "lang", least: int = LEAST) -> np.ndarray:
    """Bit map of the ``2 ** bits`` cells: those whose words and pairs are met ``least`` times or more, together.

    With the bit map of these in ``held``: of triples, both of whose pairs are in its cells.
    """
    shared, size_of_block = docs.sparkSession.sparkContext.broadcast(list(held)), _block(bits)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for language, words in _by_language(batches):
            runs = _Runs(language, words, shared.value, bits)
            found += [runs.triples] if shared.value else [runs.pairs, runs.kinds[words.codes]]
            size += sum(map(len, found[-2:]))
            if size >= _TOGETHER:
                yield _handed_over(found, least, size_of_block)
                found, size = [], 0
        if found:
            yield _handed_over(found, least, size_of_block)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.min_scalar_type(least)
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, entries in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                count = len(entries) // (2 + kind.itemsize)
                low, n = np.frombuffer(entries, np.uint16, count), np.frombuffer(entries, kind, count, 2 * count)
                own = sums.setdefault(block, np.zeros(size_of_block, kind))
                own[low] = np.minimum(own[low].astype(np.int64) + n, least)
        maps = [np.packbits(own >= least, bitorder="little").tobytes() for own in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(maps, pa.binary())], ["block", "map"])

    cells = _texts(docs, text, lang).mapInArrow(counted, "block INT, entries BINARY").repartition("block")
    made = np.zeros((1 << bits) // 8, np.uint8)
    for block, part in cells.mapInArrow(summed, "block INT, map BINARY").collect():  # at most 32 MB in all, whatever the table
        made[block * size_of_block // 8 : (block + 1) * size_of_block // 8] = np.frombuffer(part, np.uint8)
    return made


def _distinct(words: Words, reach: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different edges of some texts as phrases, with their numbers of words and their counts."""
    kinds, begin = len(words.different) + 1, np.flatnonzero(reach)
    reach, columns = reach[begin], []
    for step in range(LONGEST):
        column = words.codes.take(begin + step, mode="clip").astype(np.int64)
        column[reach <= step] = kinds - 1  # stands for no word
        columns.append(column)
    # two pairs of words, then the pair of pairs; numbers stay below 64 bits
    _, left = np.unique(columns[0] * kinds + columns[1], return_inverse=True)
    _, right = np.unique(columns[2] * kinds + columns[3], return_inverse=True)
    _, first, weights = np.unique(left * (right.max(initial=0) + 1) + right, return_index=True, return_counts=True)
    parts = [words.different.take(pa.array(column[first], mask=column[first] == kinds - 1)) for column in columns]
    return pc.binary_join_element_wise(*parts, " ", null_handling="skip"), reach[first], weights


def _added_up(counted: list[pa.RecordBatch]) -> pa.RecordBatch:
    """(phrase, words, weight): each different edge of a language once, with the sum of its weights."""
    phrases = pa.chunked_array([one["phrase"] for one in counted]).dictionary_encode()
    different = phrases.chunk(0).dictionary  # of all chunks
    words, weights = np.zeros(len(different), np.int8), np.zeros(len(different), np.int64)
    for part, one in zip(phrases.chunks, counted):
        codes = part.indices.to_numpy()
        words[codes] = one["words"].to_numpy()
        np.add.at(weights, codes, one["weight"].to_numpy())
    return pa.RecordBatch.from_arrays([different, pa.array(words), pa.array(weights)], _EDGE)


def _with_language(counted: dict[str, list[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    for language, parts in counted.items():
        made = _added_up(parts)
        for begin in range(0, len(made), _SENT):
            some = made.slice(begin, _SENT)
            yield pa.RecordBatch.from_arrays([pa.array([language] * len(some), pa.string()), *some.columns], ["lang", *_EDGE])


def edges(docs: DataFrame, held: Sequence[np.ndarray], text: str = "text", lang: str = "lang", tasks: int | None = None) -> DataFrame:
    """(lang, phrase, words, weight) of all edges; the empty phrase has the number of all words.

    They are counted in so many ``tasks`` at most, if that is given.
    """
    shared, bits = docs.sparkSession.sparkContext.broadcast(list(held)), (8 * len(held[0])).bit_length() - 1

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.RecordBatch]] = {}
        size, added = 0, 0
        for language, words in _by_language(batches):
            if not len(words.codes):
                continue
            phrases, sizes, weights = _distinct(words, _Runs(language, words, shared.value, bits).reach)
            columns = [
                pa.concat_arrays([phrases, pa.array([""])]),
                pa.array(np.append(sizes, 0), pa.int8()),
                pa.array(np.append(weights, len(words.codes)), pa.int64()),
            ]
            own = pa.RecordBatch.from_arrays(columns, _EDGE)
            held.setdefault(language, []).append(own)
            size += own.nbytes
            # as much waits as is added up already, so no edge is added up many times
            if size >= 2 * added + _WAITING:
                for one in held:
                    held[one] = [_added_up(held[one])]
                size = added = sum(parts[0].nbytes for parts in held.values())
                if added >= HELD_BYTES:
                    yield from _with_language(held)
                    held, size, added = {}, 0, 0
        yield from _with_language(held)

    texts = _texts(docs, text, lang)
    texts = texts.coalesce(tasks) if tasks else texts
    made = texts.mapInArrow(counted, "lang STRING, phrase STRING, words BYTE, weight BIGINT")
    return made.groupBy(*_KEY, "words").agg(F.sum("weight").alias("weight"))


def flows(edge_table: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, words, n) of every sequence of up to four words that is met ``least`` times or more."""
    prefixes = F.transform(
        F.sequence(F.lit(1), F.col("words").cast("int")),
        lambda k: F.struct(F.call_function("substring_index", F.col("phrase"), F.lit(" "), k).alias("phrase"), k.cast("byte").alias("words")),
    )
    through = edge_table.where("words > 0").select("lang", "weight", F.explode(prefixes).alias("node"))
    return through.groupBy("lang", "node.phrase", "node.words").agg(F.sum("weight").alias("n")).where(F.col("n") >= least)


def _without_last(phrase: Column, words: Column) -> Column:
    return F.call_function("substring_index", phrase, F.lit(" "), words - 1)


def _without_first(phrase: Column, words: Column) -> Column:
    return F.call_function("substring_index", phrase, F.lit(" "), 1 - words)


def nodes(counts: DataFrame) -> DataFrame:
    """Phrases of two and three words with the heaviest edge into and out of them (0: none)."""
    longer = counts.where("words > 2")
    phrase, words = F.col("phrase"), F.col("words").cast("int")
    sides = longer.select(
        "lang",
        "n",
        F.explode(
            F.array(
                F.struct(_without_last(phrase, words).alias("phrase"), F.lit(True).alias("leaves")),
                F.struct(_without_first(phrase, words).alias("phrase"), F.lit(False).alias("leaves")),
            )
        ).alias("node"),
    )
    heaviest = sides.groupBy("lang", "node.phrase").agg(
        F.max(F.when(F.col("node.leaves"), F.col("n"))).alias("most_out"), F.max(F.when(~F.col("node.leaves"), F.col("n"))).alias("most_in")
    )
    return counts.where(f"words between 2 and {LONGEST - 1}").join(heaviest, _KEY, "left").fillna(0, ["most_in", "most_out"])


def paths(counts: DataFrame, node_table: DataFrame, scratch: Scratch) -> DataFrame:
    """(lang, phrase, weight, steps): the edges of four words, compacted at unary nodes; ``steps`` edges make a path."""
    phrase = F.col("phrase")
    all_edges = counts.where(f"words = {LONGEST}").select(
        *_KEY, "n", _without_last(phrase, F.lit(LONGEST)).alias("begin"), _without_first(phrase, F.lit(LONGEST)).alias("end")
    )
    unary = node_table.where(f"words = {LONGEST - 1} and most_in = n and most_out = n").select("lang", F.col("phrase").alias("node"), F.col("n").alias("flow"))
    before = all_edges.select("lang", F.col("end").alias("node"), F.col("phrase").alias("to"), F.col("n").alias("brought"))
    before = before.join(unary, ["lang", "node"]).where("brought = flow").select("lang", F.col("node").alias("begin"), "to", "flow")
    linked = all_edges.join(before, ["lang", "begin"], "left")
    # an edge's way back along its path: so many steps to that edge; a first edge leads to itself
    ways = linked.select(*_KEY, "n", F.coalesce("to", "phrase").alias("to"), F.when(F.col("to").isNull(), 0).otherwise(1).cast("bigint").alias("steps"))
    ways = scratch.store(ways, "ways")
    while True:
        further = ways.where("steps > 0").select("lang", F.col("phrase").alias("to"), F.col("to").alias("beyond"), F.col("steps").alias("more"))
        if ways.where("steps > 0").join(further, ["lang", "to"], "left_semi").isEmpty():
            break
        doubled = ways.join(further, ["lang", "to"], "left")
        doubled = doubled.select(*_KEY, "n", F.coalesce("beyond", "to").alias("to"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"))
        ways = scratch.store(doubled, "ways")
    inside = F.sort_array(F.collect_list(F.when(F.col("steps") > 0, F.struct("steps", F.substring_index("phrase", " ", -1).alias("word")))))
    made = ways.groupBy("lang", F.col("to").alias("first")).agg(inside.alias("inside"), F.first("n").alias("weight"), F.count(F.lit(1)).alias("steps"))
    later = F.transform("inside", lambda one: one["word"])
    return made.select("lang", F.concat_ws(" ", F.array("first"), later).alias("phrase"), "weight", "steps")


def _candidates(path_table: DataFrame, node_table: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, left, right): phrases no longer one covers; counts of three-word parts that a path tells."""
    tokens = F.split("phrase", " ")
    first, last, weight = F.lit(0), F.col("steps").cast("int") - 1, F.col("weight")
    windows = F.transform(
        F.sequence(first, last),
        lambda i: F.struct(
            F.array_join(F.slice(F.col("tokens"), i + 1, LONGEST), " ").alias("phrase"),
            F.when(i > first, weight).alias("left"),
            F.when(i < last, weight).alias("right"),
        ),
    )
    # the generator keeps the split text from being made again for each window
    opened = path_table.select("lang", "steps", "weight", F.explode(F.array(tokens)).alias("tokens"))
    whole = opened.select("lang", "weight", F.explode(windows).alias("one")).select(
        "lang", "one.phrase", F.lit(LONGEST).cast("byte").alias("words"), F.col("weight").alias("a"), "one.left", "one.right"
    )
    covering = F.greatest("most_in", "most_out").cast("decimal(20,0)") * 100 >= F.col("n").cast("decimal(20,0)") * COVERED
    unknown = F.lit(None).cast("bigint")
    shorter = node_table.where(~covering).select(*_KEY, "words", F.col("n").alias("a"), unknown.alias("left"), unknown.alias("right"))
    return whole.unionByName(shorter)


def scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score): the lowest cut of each candidate."""
    phrase, words = F.col("phrase"), F.col("words").cast("int")

    def part(k: Column, before: bool) -> Column:
        text = F.call_function("substring_index", phrase, F.lit(" "), k if before else k - words)
        known = F.when((words == LONGEST) & (k == (LONGEST - 1 if before else 1)), F.col("left" if before else "right"))
        return F.struct(k.alias("k"), F.lit(before).alias("before"), text.alias("part"), known.alias("known"))

    cuts = F.sequence(F.lit(1), words - 1)
    both = F.concat(F.transform(cuts, lambda k: part(k, True)), F.transform(cuts, lambda k: part(k, False)))
    parts = candidates.select(*_KEY, "a", F.explode(both).alias("one")).select(*_KEY, "a", "one.*")
    told = parts.where("known is not null").select(*_KEY, "a", "k", "before", F.col("known").alias("n"))
    looked = parts.where("known is null").join(counts.select("lang", F.col("phrase").alias("part"), "n"), ["lang", "part"])
    cut = (
        told.unionByName(looked.select(*_KEY, "a", "k", "before", "n"))
        .groupBy(*_KEY, "a", "k")
        .agg(F.max(F.when(F.col("before"), F.col("n"))).alias("l"), F.max(F.when(~F.col("before"), F.col("n"))).alias("r"))
    )
    score = F.expr("cast(2000000 * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + r) as bigint)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("lowest")
    return cut.groupBy(*_KEY, "a").agg(lowest).select(*_KEY, "a", "lowest.l", "lowest.r", "lowest.score")


class Graph:
    """The counted graph of a table's texts."""

    def __init__(self, docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST):
        self.scratch = Scratch(docs.sparkSession, "collocations")
        with arrow_rows(docs.sparkSession, ROWS), shuffles_freed(docs.sparkSession):
            size = _text_bytes(docs, text, lang)
            bits, tasks = _bits(size), counting_tasks(size, docs.sparkSession.sparkContext.defaultParallelism)
            held = [frequent_cells(docs, bits, (), text, lang, least)]
            held.append(frequent_cells(docs, bits, held, text, lang, least))
            counted = self.scratch.store(edges(docs, held, text, lang, tasks), "edges")
        self.totals = counted.where("words = 0").select("lang", F.col("weight").alias("n"))
        self.counts = self.scratch.store(flows(counted, least), "counts")
        self.nodes = self.scratch.store(nodes(self.counts), "nodes")
        self.paths = self.scratch.store(paths(self.counts, self.nodes, self.scratch), "paths")

    def collocations(self) -> DataFrame:
        """(lang, phrase, a, l, r, n, score) of all candidates that are not dropped."""
        return scored(_candidates(self.paths, self.nodes), self.counts).join(self.totals, "lang")


def report(docs: DataFrame) -> DataFrame:
    """The first phrases of each language."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = Graph(docs, least=LEAST).collocations().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= SHOWN)
    return best.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
