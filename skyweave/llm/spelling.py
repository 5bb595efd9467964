"""Groups of spelling variants: words one edit apart, found by walking a trie that is a table of edges."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyweave.llm.tokens import mix, odd_numbers
from skyweave.llm.workspace import Workspace, numbered

LETTERS = "[A-Za-zÀ-ÿ]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_U = np.uint64


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    letters: str = LETTERS,
    min_length: int = 7,
    min_count: int = 2,
    change: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """``word``, ``n``: how often each word stands in all texts.

    Words are the longest runs of ``letters`` (a class of a regular expression), with A-Z in lower case; ``change`` gets the document's id as
    text and the word and gives what is counted in its place, never a longer one. Words under ``min_length`` code
    points or ``min_count`` occurrences are left out. Null texts have no words, a null id is an empty one.
    """
    runs = F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(f"{letters}{{{min_length},}}"), F.lit(0))
    name = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    each = docs.select(name.alias("id"), F.explode(runs).alias("run"))
    each = each.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    word = F.col("run") if change is None else change(F.col("id"), F.col("run"))
    return (
        each.select(word.alias("word"))
        .where(F.length("word") >= min_length)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_count)
    )


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per prefix of each word (key, word; odd keys are reversed words) from one before its half on: a hash of trie, depth and prefix, and the code point
    behind it, -1 at the end of the word.

    The half is where the edits of a word begin: in the trie of words behind the first half, in that of reversed words behind the rest.
    """
    factor, of_trie, of_depth = odd_numbers(1212, 3)
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            keys, texts = (c.slice(at, 4096) for c in batch.columns)
            words = texts.to_pylist()
            sizes = np.array([len(w) for w in words], dtype=np.int64)
            codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
            begin = np.cumsum(sizes) - sizes
            inner = np.arange(len(codes)) - np.repeat(begin, sizes)
            powers = np.full(int(sizes.max(initial=0)) + 1, factor, dtype=np.uint64)
            powers[0] = 1
            terms = mix(codes.astype(np.uint64) + _U(1)) * np.cumprod(powers, dtype=np.uint64)[inner]
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
            keys = keys.to_numpy()
            tries = keys & 1
            half = np.where(tries == 0, sizes // 2, sizes - sizes // 2)
            first = np.maximum(half - 1, 0)
            counts = sizes - first + 1
            row = np.repeat(np.arange(len(words)), counts)
            depth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + first[row]
            place = begin[row] + depth
            hashes = sums[place] - sums[begin[row]]
            nodes = mix(hashes + of_trie * tries[row].astype(np.uint64) + of_depth * depth.astype(np.uint64))
            ahead = np.where(depth == sizes[row], -1, np.append(codes, 0)[place].astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[row]),
                    texts.take(pa.array(row)),
                    pa.array(depth.astype(np.int32)),
                    pa.array(nodes.view(np.int64)),
                    pa.array(ahead.astype(np.int32)),
                    pa.array(depth == half[row]),
                ],
                names=["key", "word", "depth", "node", "ahead", "begins"],
            )


_PREFIXES = "key long, word string, depth int, node long, ahead int, begins boolean"


MASKS = 4


def _rest(word: Column, at: Column) -> Column:
    """A hash of what stands behind a place of a word."""
    return F.xxhash64(F.substr(word, at + 1))


def _bit(hashed: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), hashed.bitwiseAND(63).cast("int"))


def _which(hashed: Column) -> Column:
    return F.shiftright(hashed, 6).bitwiseAND(MASKS - 1)


def _trie(both: DataFrame, workspace: Workspace) -> tuple[DataFrame, DataFrame]:
    """The edge table of the tries, and the states without an edit.

    Nodes are the prefixes at which words part or end and those at which a word's edits begin; what lies between is the label of
    an edge. An edge also has masks of what stands behind its end in the words below: one of 256 bits for each different rest. A word's
    states without an edit are the nodes on its own way.
    """
    prefixes = both.mapInArrow(_prefixes, _PREFIXES)
    nodes = (
        prefixes.groupBy("node")
        .agg(F.min("ahead").alias("low"), F.max("ahead").alias("high"), F.max("begins").alias("begins"))
        .where((F.col("low") != F.col("high")) | (F.col("low") == -1) | F.col("begins"))
        .select("node")
    )
    # A word's nodes are at most as many as its letters.
    way = Window.partitionBy("key").orderBy("depth")
    size, trie = F.length("word"), F.col("key").bitwiseAND(1)
    half = F.when(trie == 0, F.floor(size / 2)).otherwise(F.ceil(size / 2))
    steps = workspace.keep(
        prefixes.join(nodes, "node").select(
            trie.cast("byte").alias("trie"), "word", "depth", "node", (F.col("depth") >= half).alias("own"),
            F.lag("node").over(way).alias("from_node"), F.lag("depth").over(way).alias("from_depth"),
        ),
        "steps",
    )
    label = F.substr("word", F.col("from_depth") + 1, F.col("depth") - F.col("from_depth"))
    edges = (
        steps.where("from_node is not null")
        .select(
            "node", "from_node", label.alias("label"), (F.col("depth") == F.length("word")).alias("ends"),
            _rest(F.col("word"), F.col("depth")).alias("rest"),
        )
        .groupBy("node")
        .agg(
            F.first("from_node").alias("from_node"), F.first("label").alias("label"), F.max("ends").alias("ends"),
            *[F.bit_or(F.when(_which(F.col("rest")) == i, _bit(F.col("rest")))).alias(f"mask{i}") for i in range(MASKS)],
        )
        .select(
            F.col("from_node").alias("node"), "label", F.col("node").alias("to_node"), "ends", *[f"mask{i}" for i in range(MASKS)]
        )
    )
    states = steps.where("own").select("trie", "word", F.col("depth").alias("at"), "node")
    return workspace.keep(edges, "edges"), states


def _edited(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states without an edit moved along every edge with one: a code point missing, replaced or too many.

    A state goes on only if what is left of the word has its bit in the edge's masks.
    """
    masks = [f"mask{i}" for i in range(MASKS)]
    rest = F.col("rest")
    mask = reduce(lambda found, i: found.when(_which(rest) == i, F.col(masks[i])), range(1, MASKS), F.when(_which(rest) == 0, F.col(masks[0])))
    to, at = F.col("to"), F.col("at")
    ends = F.explode(F.array(*[F.col("at") + F.length("label") + F.lit(d) for d in (-1, 0, 1)]))
    part = F.substr("word", at + 1, to - at)
    return (
        states.join(edges, "node")
        .select("trie", "word", "at", "label", "to_node", "ends", *masks, ends.alias("to"))
        .where(to <= F.length("word"))
        .select("*", _rest(F.col("word"), to).alias("rest"))
        .where(mask.bitwiseAND(_bit(rest)) != 0)
        .where(F.levenshtein(part, F.col("label"), 1) == 1)
        .select(
            "trie", "word", to.alias("at"), F.col("to_node").alias("node"), "ends",
            F.concat(F.substr("word", F.lit(1), at), F.col("label"), F.substr("word", to + 1)).alias("near"),
        )
    )


def _followed(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States with their edit moved along the edge whose label comes next in the word."""
    size = F.length("label")
    ahead = F.substr("word", F.col("at") + 1, F.lit(1))
    by_letter = edges.select("node", F.substr("label", F.lit(1), F.lit(1)).alias("letter"), "label", "to_node", "ends")
    return (
        states.drop("ends").withColumn("letter", ahead)
        .join(by_letter, ["node", "letter"])
        .where(F.substr("word", F.col("at") + 1, size) == F.col("label"))
        .select("trie", "word", (F.col("at") + size).alias("at"), F.col("to_node").alias("node"), "ends", "near")
    )


def neighbours(words: DataFrame, workspace: Workspace) -> DataFrame:
    """``word``, ``near``: every pair of different words one inserted, deleted or replaced code point apart, in both orders.

    ``words`` has distinct texts in ``word``, of four code points or more; shorter ones and nulls have no pairs. Two words one
    edit apart share the half of either before the edit or the half behind it. So the walk starts at the node of a word's first half in
    a trie of the words, and at that of its reversed second half in a trie of the reversed words. States are (word, place, node,
    edits): those without an edit are the nodes on the word's own way; joined with the table of edges they become states with
    one edit, which go on level by level, a join with the edges each, until they end where a word does. From a node
    there are at most as many edges as there are letters, so the states grow with the words; and rounds follow the number
    of forks behind a half, not the length of words. Nodes are known by a 64-bit hash of their prefix, so each pair found is compared
    once more.
    """
    known = words.select("word").where(F.length("word") >= 4)
    named = workspace.keep(numbered(known, "key"), "words")
    both = named.select((2 * F.col("key")).alias("key"), "word").union(
        named.select((2 * F.col("key") + 1).alias("key"), F.reverse("word").alias("word"))
    )
    edges, states = _trie(both, workspace)
    states = workspace.keep(_edited(states, edges), "states-1")
    workspace.drop("steps")
    done = (F.col("at") == F.length("word")) & F.col("ends")
    found, number = [states.where(done)], 1
    while not (states := states.where(F.col("at") < F.length("word"))).isEmpty():
        number += 1
        states = workspace.keep(_followed(states, edges), f"states-{number}")
        found.append(states.where(done))
    turned = [F.when(F.col("trie") == 0, F.col(c)).otherwise(F.reverse(c)).alias(c) for c in ("word", "near")]
    pairs = reduce(DataFrame.unionByName, found).select(*turned).distinct()
    return workspace.keep(pairs.where(F.levenshtein("word", "near", 1) == 1), "pairs")


def _roots(forms: DataFrame, workspace: Workspace) -> DataFrame:
    """``word``, ``root``: the end of each word's chain of forms, by doubling."""
    current, number = workspace.keep(forms.select("word", F.col("form").alias("root")), "root-0"), 0
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        number += 1
        current = workspace.keep(
            current.join(ahead, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            f"root-{number}",
        )
        if current.where("moved").isEmpty():
            return current.select("word", "root")
        current = current.select("word", "root")


def spelling_variants(words: DataFrame, workspace: Workspace, times: int = 10) -> DataFrame:
    """Per word: word, n, n_near, form, form_n, root.

    ``words`` has each ``word`` once, of four code points or more, with its count ``n`` (``word_counts``). ``n_near`` is the
    number of words one edit away. The form of a word is the most frequent of them, ties to the smallest in code-point
    order, if it is at least ``times`` as frequent (two or more), else null; the root is where the chain of forms ends, the word itself
    if it has no form. Chains end, since counts grow along them. Rows with a null word are left out; empty input, empty result.
    """
    if times < 2:
        raise ValueError("a form must be at least twice as frequent")
    counted = workspace.keep(words.where(F.col("word").isNotNull()).select("word", "n"), "counted")
    pairs = neighbours(counted, workspace)
    of_near = counted.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = (
        pairs.join(of_near, "near")
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best"))
    )
    judged = counted.join(best, "word", "left").withColumn("best_n", -F.col("best.order"))
    has_form = F.col("best_n") >= times * F.col("n")
    judged = workspace.keep(
        judged.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(has_form, F.col("best.near")).alias("form"), F.when(has_form, F.col("best_n")).alias("form_n"),
        ),
        "judged",
    )
    roots = _roots(judged.where("form is not null"), workspace)
    return judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
