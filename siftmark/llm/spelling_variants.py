"""Spelling variants by a relational trie frontier.

Words that differ by one inserted, deleted or replaced code point are neighbours. Their trie is a table of
edges (node, letter, words below), and the search is a table of states (word, position, node, edits) that
is joined with the edges of its level, one level after another:

* a state without an edit goes on along its word's own letters; at every other edge of its node the first
  difference lies, and it becomes a state with one edit (replaced, inserted or deleted letter), kept if
  the child has an edge for the letter that must come next;
* a state with one edit follows the letters of its word only;
* an edge with at most two words below holds them itself, so that the trie ends where words part. A state
  that meets such an edge, or the end of a word, is terminal: what it holds is compared with its word,
  and words at one edit become neighbours.

One edit leaves the first or the last half of a word as it is. Each word is therefore sought twice: in the
trie of the words from its middle on, and in the trie of the reversed words, likewise. Both live in one
table. A node is as hot as the words below it, a number that states and edges both carry; hot nodes are
split by it (SALT_ROWS), with their edges repeated for each part. Every level is written to the shared
folder. The number of levels follows the longest beginning that three words share.

Defined results: null and empty texts have no words, rows that share an id or repeat count as they are, a null id never
loses a letter, extra columns are not read, an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftmark.sources.scratch import scratch_folder, written

RUN = r"([A-Za-zÀ-ÿ]+)"
MIN_LENGTH, MIN_COUNT = 6, 5
#: Words below a node from which its states are split into parts.
SALT_ROWS = 2048
#: Words that an edge holds itself.
HELD = 2
FORM_RATIO = 5
#: Instead of a position: a word without an edit that goes on, and a pair that is found.
ON, FOUND = -1, -2


def lowered(run: str) -> Column:
    """A-Z in lower case; only words that have any capital are translated letter by letter."""
    changed = F.translate(F.col(run), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.lower(run) == F.col(run), F.col(run)).otherwise(changed)


def vocabulary(docs: DataFrame, one_in: int = 199, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of letters with at least MIN_LENGTH code points and MIN_COUNT occurrences.

    Where the crc32 of `<id>:<run>` is divisible by `one_in`, the run loses the code point at that number modulo its length.
    """
    runs = docs.select(F.col(id_col).cast("string").alias("_id"), F.explode(F.regexp_extract_all(text_col, F.lit(RUN), F.lit(1))).alias("_run"))
    runs = runs.where(F.length("_run") >= MIN_LENGTH).select("_id", lowered("_run").alias("_run"))
    runs = runs.withColumn("_h", F.crc32(F.concat("_id", F.lit(":"), "_run")))
    at = F.pmod("_h", F.length("_run")).cast("int")
    shorter = F.concat(F.substr("_run", F.lit(1), at), F.substr("_run", at + 2))
    word = F.when(F.col("_h") % one_in == 0, shorter).otherwise(F.col("_run"))
    counted = runs.select(word.alias("word")).where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= MIN_COUNT)


def _salts(size: str) -> Column:
    return F.floor(F.col(size) / SALT_ROWS).cast("int") + 1


def _salted(states: DataFrame) -> DataFrame:
    return states.withColumn("salt", F.pmod(F.xxhash64("s"), _salts("size")).cast("int"))


def _letter(c: str, at: Column | int) -> Column:
    """Letter of a text at a place counted from 0; empty beyond its end."""
    return F.substr(F.col(c), (F.lit(at) if isinstance(at, int) else at) + 1, F.lit(1))


def _edges(alive: DataFrame) -> DataFrame:
    """Edges that leave the nodes of a level, with the letters that follow and the words that a small one holds.

    `size` is the number of words below the parent; each edge is repeated for each part of its parent.
    """
    depth = F.length("node")
    edges = alive.groupBy("back", "node", "size", _letter("s", depth).alias("letter")).agg(
        F.count(F.lit(1)).alias("below"), F.min("s").alias("lo"), F.max("s").alias("hi"),
        F.collect_set(_letter("s", depth + 1)).alias("following"))
    return edges.withColumn("salt", F.explode(F.sequence(F.lit(0), _salts("size") - 1))).drop("size")


def _outcomes(joined: DataFrame, *cases: tuple[Column, Column]) -> DataFrame:
    """A row for each case (pos, v) that holds: FOUND with a word at one edit, ON, or a position with its next letter below the child."""
    pos, v = F.col("case.pos"), F.col("case.v")
    near = F.when(F.abs(F.length(v) - F.length("s")) <= 1, F.levenshtein("s", v) == 1)
    holds = F.when(pos == FOUND, near).when(pos == ON, True).otherwise(F.array_contains("following", _letter("s", pos)))
    each = joined.withColumn("case", F.explode(F.array(*[F.struct(p.cast("int").alias("pos"), w.alias("v")) for p, w in cases])))
    return each.where(pos.isNotNull()).where(holds).select(
        "back", "s", "start", pos.alias("pos"), F.concat("node", "letter").alias("node"), F.col("below").alias("size"), v.alias("v"))


def _level(alive: DataFrame, edited: DataFrame, edges: DataFrame) -> DataFrame:
    """One step of all states: pairs found, words that go on, and states with one edit.

    No number of the level is in the plan, so the code that Spark compiles for one level serves all.
    """
    none, depth = F.lit(None).cast("string"), F.length("node")
    own, small = F.col("letter") == _letter("s", depth), (F.col("below") <= HELD) | (F.col("letter") == "")
    lo, hi = F.when(small, F.col("lo")), F.when(small & (F.col("hi") != F.col("lo")), F.col("hi"))
    first = F.when(small, FOUND)
    # at the first difference a letter is replaced, inserted (the other word has one more) or deleted (this word has one more)
    steps = alive.join(edges, ["back", "node", "salt"]).where(own | (depth >= F.col("start")))
    steps = _outcomes(
        steps, (first.when(own, ON).when(F.length("s") > depth, depth + 1), lo), (first.when(~own, depth), hi),
        (F.when(~small & ~own & (F.col("letter") == _letter("s", depth + 1)), depth + 2), none))
    follow = edited.withColumn("letter", _letter("s", F.col("pos"))).join(edges, ["back", "node", "salt", "letter"])
    return steps.unionByName(_outcomes(follow, (first.otherwise(F.col("pos") + 1), lo), (first, hi)))


def neighbours(words: DataFrame, least: int = MIN_LENGTH) -> DataFrame:
    """(word, near) in both directions, from distinct words of at least `least` code points."""
    spark, n = words.sparkSession, F.length("word")
    both = words.select(F.lit(False).alias("back"), F.col("word").alias("s"), F.floor(n / 2).cast("int").alias("start")).unionAll(
        words.select(F.lit(True), F.reverse("word"), (n - F.floor(n / 2)).cast("int")))
    placed = both.withColumn("node", F.substr("s", F.lit(1), F.lit(least // 2)))
    sizes = placed.groupBy("back", "node").agg(F.count(F.lit(1)).alias("size"))
    begin = placed.join(sizes, ["back", "node"]).select(
        "back", "s", "start", F.lit(ON).alias("pos"), "node", "size", F.lit(None).cast("string").alias("v"))
    folder, level = scratch_folder(spark), 0
    begin.write.parquet(f"{folder}/level={level}")
    schema = begin.schema
    while True:
        states = spark.read.schema(schema).parquet(f"{folder}/level={level}").where(F.col("pos") != FOUND)
        if states.isEmpty():
            break
        alive, edited = _salted(states.where(F.col("pos") == ON)).drop("pos", "v"), _salted(states.where(F.col("pos") >= 0)).drop("v")
        level += 1
        _level(alive, edited, written(_edges(alive))).write.parquet(f"{folder}/level={level}")
    found = spark.read.schema(schema).parquet(folder).where(F.col("pos") == FOUND)
    turned = lambda c: F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c))
    return found.select(turned("s").alias("word"), turned("v").alias("near")).distinct()


def word_forms(words: DataFrame, near: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word.

    The form is the most frequent neighbour (ties: the least in code-point order) if it is at least FORM_RATIO times
    as frequent. Forms are followed to the last by doubling, so chains of any length need few rounds.
    """
    with_n = near.join(words.withColumnsRenamed({"word": "near", "n": "near_n"}), "near")
    best = with_n.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    rows = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "best.near", (-F.col("best.less")).alias("near_n"))
    has = F.col("near_n") >= FORM_RATIO * F.col("n")
    rows = written(rows.select("word", "n", "n_near", F.when(has, F.col("near")).alias("form"), F.when(has, F.col("near_n")).alias("form_n")))
    links = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        links = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    return rows.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_forms(docs: DataFrame) -> DataFrame:
    """Forms of all words of the documents."""
    words = written(vocabulary(docs))
    return word_forms(words, neighbours(words.select("word")))
