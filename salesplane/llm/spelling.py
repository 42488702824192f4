"""Spelling variants: words one edit apart, found by a frontier over a trie.

The vocabulary's trie is a table of edges (node, label, child); chains without a
branch are one edge.  Its words are sorted into ranges of bounded size, each
range builds its edges, and nodes that lie on a border between ranges are kept in
both, so the parts fit together.  Frontier states (word, pos, node, edits) join
the edges level by level: a state without an edit follows its own word, and where
another edge leaves its path takes the one edit there; a state with an edit must
match each label.  An edge tells how many letters words have below its child and
which letters follow there, so a state that cannot reach a word's end is dropped
where it arises.  States at the end of their word in a node that ends a word are
its neighbours.

Two words one edit apart agree in at least half their letters before or after the
edit.  So there are two tries, of words and of words reversed, and an edit is made
in the second half of a word only: near the root, where the trie is dense, no
state branches.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import if_small, read_table, staged

MIN_LENGTH = 5
MIN_COUNT = 3
#: A run whose hash this divides loses a letter.
DROP_STEP = 97
#: A form has at least so many times its word's occurrences.
FORM_RATIO = 2
#: Words of a range whose edges are built together, and words counted together.
RANGE_WORDS = 50_000
COUNTED_WORDS = 300_000
#: Bits of an edge's masks; a word's rest of so many letters or more has the last one.
MASK_BITS = 62


def changed(doc_id: int | None, run: str) -> str:
    """The word of a lower-cased run; without doc_id it is the run."""
    return run if doc_id is None else _dropped(zlib.crc32(f"{doc_id}:{run}".encode()), run)


def _dropped(h: int, run: str) -> str:
    if h % DROP_STEP:
        return run
    i = h % len(run)
    return run[:i] + run[i + 1:]


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of ``docs`` (doc_id, text).  A task adds up its words before they are shuffled."""
    long_run = f"[a-zÀ-ÿ]{{{min_length},}}"  # a shorter run gives no word

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        runs_of = re.compile(long_run).findall

        def rows() -> pd.DataFrame:
            return pd.DataFrame({"word": pd.Series(list(total), dtype=object), "n": pd.Series(list(total.values()), dtype="int64")})

        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"].astype("Int64"), pdf["text"]):
                # bytes.lower() changes A-Z only.
                runs = Counter(runs_of(text.encode().lower().decode()))
                if doc_id is not pd.NA:
                    head = zlib.crc32(f"{doc_id}:".encode())
                    for run in [r for r in runs if zlib.crc32(r.encode(), head) % DROP_STEP == 0]:
                        word, k = changed(doc_id, run), runs.pop(run)
                        if len(word) >= min_length:
                            total[word] += k
                total.update(runs)
                if len(total) > COUNTED_WORDS:
                    yield rows()
                    total.clear()
        yield rows()

    return (docs.select("doc_id", "text").where("text is not null").mapInPandas(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    i = 0
    while a[i] == b[i]:
        i += 1
    return i


def border_rows(words: list[str], before: str | None, after: str | None) -> list[tuple[int, int, int, bool]]:
    """(side, depth, node, is one here) for the prefixes that a range of sorted
    ``words`` shares with the last word before it and the first one after it."""
    out = []
    for side, own, other in ((0, words, before), (1, words[::-1], after)):
        least, nodes = len(own[0]), {0}
        for a, b in zip(own, own[1:]):
            least = min(least, _common(a, b))
            nodes.add(least)
            if not least:
                break
        reach = _common(own[0], other) if other else 0
        nodes.add(reach)
        name = xxhash.xxh3_64()
        for d in range(reach + 1):
            out.append((side, d, name.intdigest() - (1 << 63), d in nodes))
            name.update(own[0][d:d + 1].encode())
    return out


def range_trie(words: list[str], of_first, of_last) -> tuple[list[int], list[int], list[int], list[int]]:
    """Nodes of the compressed trie of sorted distinct ``words``: (depth, parent,
    word whose prefix it is, word that ends there or -1).  The first word's
    prefixes of the depths ``of_first`` and the last one's of ``of_last`` are nodes."""
    depth, parent, word, ends = [], [], [], []

    def node(d: int, w: int, e: int) -> int:
        depth.append(d)
        parent.append(-1)
        word.append(w)
        ends.append(e)
        return len(depth) - 1

    path = [node(int(d), 0, -1) for d in sorted({0, *of_first})]

    def leave(to: int, w: int) -> None:
        """Close the path's nodes deeper than ``to``, which becomes a node."""
        while depth[path[-1]] > to:
            v = path.pop()
            if depth[path[-1]] < to:
                path.append(node(to, w, -1))
            parent[v] = path[-1]

    for i, w in enumerate(words):
        if i:
            leave(_common(words[i - 1], w), i)
        if depth[path[-1]] == len(w):
            ends[path[-1]] = i
        else:
            path.append(node(len(w), i, i))
    have = {depth[v] for v in path}
    path = sorted(path + [node(int(d), len(words) - 1, -1) for d in {*of_last} - have], key=lambda v: depth[v])
    leave(0, 0)
    return depth, parent, word, ends


def node_masks(words: list[str], depth: list[int], parent: list[int], word: list[int], ends: list[int]) -> tuple[list[int], list[int]]:
    """For each node, bit masks of the letters that words have below it (none: it
    ends one) and of the letters that follow it."""
    rest, letters, most = [0] * len(depth), [0] * len(depth), 1 << (MASK_BITS - 1)
    for v in sorted(range(len(depth)), key=depth.__getitem__, reverse=True):
        if ends[v] >= 0:
            rest[v] |= 1
        if (p := parent[v]) >= 0:
            below = rest[v] << (depth[v] - depth[p])
            rest[p] |= below if below < most else below & (most - 1) | most
            letters[p] |= 1 << ord(words[word[v]][depth[p]]) % MASK_BITS
    return rest, letters


def _half(length: int) -> int:
    """Least number of letters before an edit that the trie of this direction finds."""
    return length // 2


def trie(words: DataFrame, range_words: int = RANGE_WORDS) -> tuple[DataFrame, DataFrame]:
    """(edges, frontier) of ``words`` (word; distinct, in any one direction).

    edges: (node, label, child, ends, rest, letters): ``ends`` is the word that ends
    in the child, or null; rest and letters are the child's masks.  frontier: each word at its first node at or beyond half its length:
    (word, pos, node).  Nodes are named by a hash of their prefix."""
    n = words.count()
    placed = staged(words.repartitionByRange(max(1, -(-n // range_words)), "word")
                    .select("word", F.spark_partition_id().alias("part")))
    ends_of = placed.groupBy("part").agg(F.min("word").alias("first"), F.max("word").alias("last"))
    by_part = Window.orderBy("part")  # one row for each range
    ends_of = ends_of.select("part", F.lag("last").over(by_part).alias("before"), F.lead("first").over(by_part).alias("after"))

    def border(pdf: pd.DataFrame) -> pd.DataFrame:
        out = border_rows(sorted(pdf["word"]), pdf["before"].iloc[0], pdf["after"].iloc[0])
        return pd.DataFrame(out, columns=["side", "depth", "node", "own"]).assign(part=pdf["part"].iloc[0])

    # What is a node in one of the ranges that share a prefix is one in all of them.
    shared = staged(placed.join(F.broadcast(ends_of), "part").groupBy("part")
                    .applyInPandas(border, "side int, depth int, node long, own boolean, part int"))
    nodes = shared.where("own").select("node").distinct()
    borders = (shared.join(nodes, "node").groupBy("part")
               .agg(F.collect_list(F.when(F.col("side") == 0, F.col("depth"))).alias("of_first"),
                    F.collect_list(F.when(F.col("side") == 1, F.col("depth"))).alias("of_last")))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        own = sorted(pdf["word"])
        depth, parent, word, ends = range_trie(own, pdf["of_first"].iloc[0], pdf["of_last"].iloc[0])
        name = [xxhash.xxh3_64_intdigest(own[w][:d]) - (1 << 63) for d, w in zip(depth, word)]
        rest, letters = node_masks(own, depth, parent, word, ends)
        out = [(name[p], own[w][depth[p]:d], name[v], own[e] if e >= 0 else None, rest[v], letters[v], -1)
               for v, (d, p, w, e) in enumerate(zip(depth, parent, word, ends)) if p >= 0]
        for v, e in enumerate(ends):
            if e >= 0:
                while parent[v] >= 0 and depth[parent[v]] >= _half(len(own[e])):
                    v = parent[v]
                out.append((name[v], None, 0, own[e], 0, 0, depth[v]))
        return pd.DataFrame(out, columns=["node", "label", "child", "ends", "rest", "letters", "pos"])

    built = staged(placed.join(if_small(borders), "part").groupBy("part")
                   .applyInPandas(build, "node long, label string, child long, ends string, rest long, letters long, pos int"))
    # A border's edges are built in several ranges; the one that holds the child's word knows it,
    # and each knows the words of its own below the child.
    edges = (built.where("pos < 0").groupBy("node", "label")
             .agg(F.first("child").alias("child"), F.max("ends").alias("ends"), F.bit_or("rest").alias("rest"), F.bit_or("letters").alias("letters")))
    return edges, built.where("pos >= 0").select(F.col("ends").alias("word"), "pos", "node")


def _advance(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states that the edges lead to, with the word that ends there."""
    label, pos = F.col("label"), F.col("pos")
    size, left = F.length(label), F.length("word") - pos
    tail = F.expr("substring(label, 2)")

    def to(at: Column, edits: Column) -> Column:
        return F.struct(at.cast("int").alias("pos"), edits.alias("edits"))

    def words_from(start: int, length: Column) -> Column:
        return F.col("word").substr(pos + start + 1, length)

    def has(mask: str, bit: Column) -> Column:
        return F.col(mask).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bit.cast("int"))) != 0

    def fits(used: Column) -> Column:
        """A word below the child has as many letters there as the state's word beyond these."""
        return (left >= used) & has("rest", F.least(left - used, F.lit(MASK_BITS - 1)))

    own, fresh, one = F.col("next") == F.col("letter"), F.col("edits") == 0, F.lit(1)
    ways = F.array(
        F.when(own & (fresh | fits(size)) & (words_from(0, size) == label), to(pos + size, F.col("edits"))),
        F.when(~own & fits(size) & (words_from(1, size - 1) == tail), to(pos + size, one)),
        F.when(~own & fits(size - 1) & (words_from(0, size - 1) == tail), to(pos + size - 1, one)),
        F.when(~own & fits(size + 1) & (words_from(1, size) == label), to(pos + size + 1, one)))
    moved = (states.withColumn("next", F.expr("substring(word, pos + 1, 1)"))
             .join(edges, (F.col("node") == F.col("from")) & (fresh | own))
             .select("word", F.col("child").alias("node"), "ends", "letters", F.explode(F.array_compact(ways)).alias("to"))
             .select("word", "to.pos", "node", "to.edits", "ends", "letters"))
    # An edited word's next letter has to follow the node; an unedited word needs a way on.
    after = has("letters", F.ascii(F.expr("substring(word, pos + 1, 1)")) % MASK_BITS)
    return moved.where(F.when(fresh, F.col("letters") != 0).otherwise((left == 0) | after)).drop("letters")


def neighbours(words: DataFrame, range_words: int = RANGE_WORDS) -> DataFrame:
    """(word, near): all ordered pairs of ``words`` (word; distinct) one edit apart.

    A state at its word's end without an edit goes on: an edge of one letter there
    is a word with that letter added."""
    found = []
    at_end = (F.col("edits") == 1) & (F.col("pos") == F.length("word")) & F.col("ends").isNotNull()
    # A word that ends one letter before the state's word: that letter is the edit.
    one_less = (F.col("edits") == 0) & (F.col("pos") == F.length("word") - 1) & F.col("ends").isNotNull()
    for turn in (lambda c: c, F.reverse):
        edges, frontier = trie(words.select(turn(F.col("word")).alias("word")), range_words)
        edges = staged(edges.select(F.col("node").alias("from"), F.substring("label", 1, 1).alias("letter"), "label", "child", "ends", "rest", "letters"))
        ends = edges.where("ends is not null").select(F.col("child").alias("node"), "ends").distinct()
        first = frontier.where(F.col("pos") == F.length("word") - 1)
        states = staged(frontier.withColumn("edits", F.lit(0)).withColumn("ends", F.lit(None).cast("string"))
                        .unionByName(first.join(ends, "node").withColumn("edits", F.lit(0)).select("word", "pos", "node", "edits", "ends")))
        while True:
            found.append(states.where(at_end | one_less).select(turn(F.col("word")).alias("word"), turn(F.col("ends")).alias("near")))
            live = states.where((F.col("edits") == 0) | (F.col("pos") < F.length("word"))).drop("ends")
            if live.isEmpty():
                break
            states = staged(_advance(live, edges))
    pairs = found[0]
    for f in found[1:]:
        pairs = pairs.unionByName(f)
    return pairs.distinct().where(F.levenshtein("word", "near", 1) == 1)


def group_variants(counts: DataFrame, ratio: int = FORM_RATIO, range_words: int = RANGE_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of ``counts`` (word, n;
    words distinct).  A form has at least ``ratio`` times its word's count, so a
    path of forms is short; it is followed by doubling."""
    counts = staged(counts.select("word", "n"))
    pairs = staged(neighbours(counts.select("word"), range_words))
    near = (pairs.join(counts.select(F.col("word").alias("near"), F.col("n").alias("m")), "near").groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "near")).alias("best")))
    rows = counts.join(near, "word", "left")
    is_form = -F.col("best.less") >= ratio * F.col("n")
    rows = staged(rows.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                              F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")))
    steps = rows.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = staged(steps.join(if_small(on), "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                         F.col("next").isNotNull().alias("moved")))
        steps = further.select("word", "root")
        if further.where("moved").isEmpty():
            break
    return (rows.join(steps, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = FORM_RATIO,
                      range_words: int = RANGE_WORDS) -> DataFrame:
    """Words of ``docs`` (doc_id, text), their near words and forms: word, form,
    root, n, n_near, form_n.

    Null and empty texts have no words; runs of rows without doc_id stay as they
    are; repeated rows count each; an empty table gives no rows; other columns are
    not read.  Words of any length are compared whole.
    """
    return group_variants(word_counts(docs, min_length, min_count), ratio, range_words)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read_table(spark, sf_dir, "documents"))
