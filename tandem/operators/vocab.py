"""Vocabulary: word counts, alphabet, pair counts and best pair (A10-A12, O7,
U1).  The trainer on top of them is in ``bpe.py``.

The scale-dependent part (counting words over the whole corpus) is one Arrow pass and a
partial+final hash aggregation; all else runs over distinct words only.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.config import SPECIAL_TOKENS
from tandem.functions.text import cutter, pretoken_classes
from tandem.session import join_measured

ONE_CHAR = r"(?s)."


def stack_languages(df: DataFrame, cols=("en", "vi")) -> DataFrame:
    """All sentences of both languages as one column ``text`` (U1, UNION ALL)."""
    return df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias("text"))


def word_counts(texts: DataFrame, col: str = "text") -> DataFrame:
    """Frequency of every normalised pre-token (A10).

    Each Arrow batch is normalised, pre-tokenised and counted in one pass, so a word
    is one row for a batch however often it stands there; partial aggregation and one
    exchange of words add the batches up.
    """
    patterns = pretoken_classes(texts.sparkSession)

    def count(batches):
        cut = cutter(patterns)
        for b in batches:
            words, _ = cut(t.as_py() for t in b.column(0))
            n = words.value_counts()
            yield pa.record_batch([n.field("values"), n.field("counts")], ["word", "n"])

    return texts.select(col).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def char_alphabet(words: DataFrame, n_special: int = len(SPECIAL_TOKENS)) -> DataFrame:
    """Distinct characters with ids in code-point order after the specials
    (A11).  The alphabet is bounded by the character set, so the ordering
    window over it is small."""
    chars = (words.select(F.explode(F.regexp_extract_all("word", F.lit(ONE_CHAR), 0)).alias("token"))
             .distinct())
    from pyspark.sql import Window
    return chars.select("token", (F.row_number().over(Window.orderBy("token")) - 1 + n_special)
                        .cast("int").alias("id"))


def words_to_symbols(words: DataFrame, alphabet: DataFrame) -> DataFrame:
    """``(word, n, syms)`` with ``syms`` = " id id … " of its characters."""
    exploded = words.select("word", "n", F.posexplode(
        F.regexp_extract_all("word", F.lit(ONE_CHAR), 0)).alias("pos", "token"))
    j = join_measured(exploded, alphabet, "token")  # one row per distinct character
    g = j.groupBy("word", "n").agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("s"))
    return g.select("word", "n", F.concat(F.lit(" "), F.array_join(
        F.transform("s", lambda x: x["id"].cast("string")), " "), F.lit(" ")).alias("syms"))


def _sym_array(col="syms"):
    return F.split(F.trim(F.col(col)), " ").cast("array<int>")


def pair_stats(words: DataFrame) -> DataFrame:
    """Per adjacent pair: weighted count ``n`` and ``bound`` = the largest
    weighted count of a trigram that extends it left or right (A12).

    Pairs come from zipping shifted slices of the symbol array (codegen'd
    array functions, no lambdas); missing neighbours are -1.
    """
    w = words.select("n", _sym_array().alias("s")).filter(F.size("s") >= 2)
    n = F.size("s")
    a = F.slice("s", 1, n - 1)
    b = F.slice("s", 2, n - 1)
    left = F.concat(F.array(F.lit(-1)), F.slice("s", 1, n - 2))
    right = F.concat(F.slice("s", 3, n - 2), F.array(F.lit(-1)))
    ev = w.select("n", F.explode(F.arrays_zip(a.alias("a"), b.alias("b"),
                                              left.alias("l"), right.alias("r"))).alias("e"))
    ev = ev.select("n", F.col("e.a").alias("a"), F.col("e.b").alias("b"), F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("e.l").alias("nb")),
        F.struct(F.lit(1).alias("side"), F.col("e.r").alias("nb")))).alias("x"))
    tri = ev.groupBy("a", "b", F.col("x.side").alias("side"), F.col("x.nb").alias("nb")) \
            .agg(F.sum("n").alias("c"))
    return tri.groupBy("a", "b").agg(
        F.sum(F.when(F.col("side") == 1, F.col("c"))).alias("n"),
        F.coalesce(F.max(F.when(F.col("nb") >= 0, F.col("c"))), F.lit(0)).alias("bound"))


def best_pair(stats: DataFrame) -> DataFrame:
    """Pair with the highest count, ties → smallest (a, b)."""
    return stats.orderBy(F.desc("n"), "a", "b").limit(1)
