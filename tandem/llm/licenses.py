"""Licence scan (operator 1, native): ordered signature rules.

A text is reduced to its lower-cased words joined by one space.  A document
passes a gate when any of a few substrings occurs; each rule is tried on a
gated document only where its keyword occurs.  A rule's places come from
splitting the word string at its pattern: the words of the pieces before a
place give its word offset.  Detections overlap; one is suppressed when its
interval lies inside a detection of higher priority, or of equal priority that
is longer or, for equal intervals, ordered earlier.  That relation is
transitive, so no order of resolving is needed: running maxima of interval
ends per priority, in order of start, decide it in one ordered pass a document.

Everything is DataFrame expressions: one scan, and one exchange of narrow
rows (ids, offsets) by document.  Texts are not shuffled.

Cases: null and empty texts have 0 words, no places and empty labels; repeated
rows each keep their row; tied ids with different texts are separate
documents; null ids are allowed; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tandem.llm.common import documents
from tandem.llm.license_rules import GATES, rules

#: What separates words: every ASCII character but letters and digits.
_GAP = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _spaces(c):
    return F.length(c) - F.length(F.replace(c, F.lit(" ")))


def _rule_table():
    return F.array(*[F.struct(F.lit(i).alias("id"), F.lit(r.keyword).alias("kw"),
                              F.lit(f"(?<= )(?:{r.pattern})(?= )").alias("re")) for i, r in enumerate(rules())])


def detections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per detection, at least one per input row (rule is null where
    nothing was found): doc_id, tkey, n_words, rule, start, stop (words)."""
    text = F.col(text_col)
    d = docs.select(F.col(id_col).alias("doc_id"), F.md5(text).alias("tkey"),
                    F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), _GAP, " ")).alias("w"))
    # a one-row generator keeps the word string from being computed anew in every use
    d = d.select("doc_id", "tkey", F.inline(F.array(F.struct(F.concat(F.lit(" "), "w", F.lit(" ")).alias("w")))))
    low = F.lower("w")
    gate = F.lit(False)
    for g in GATES:
        gate = gate | F.contains(low, F.lit(g))
    d = d.select("doc_id", "tkey", F.when(F.col("w") == "  ", 0).otherwise(_spaces(F.col("w")) - 1)
                 .cast("long").alias("n_words"), F.when(gate, F.translate("w", _UPPER, _LOWER)).alias("w"))
    d = d.select("doc_id", "tkey", "n_words", F.inline(F.array(F.struct("w"))))
    tried = F.filter(_rule_table(), lambda r: F.contains(F.col("w"), r["kw"]))
    found = F.transform(tried, lambda r: F.struct(
        r["id"].alias("rule"), F.regexp_extract_all(F.col("w"), r["re"], F.lit(0)).alias("hits"), r["re"].alias("re")))
    found = F.filter(found, lambda r: F.size(r["hits"]) > 0)
    places = F.flatten(F.transform(found, lambda r: F.zip_with(
        F.slice(F.transform(F.call_function("split", F.col("w"), r["re"], F.lit(-1)), _spaces), 1, F.size(r["hits"])),
        F.transform(r["hits"], lambda h, k: F.struct(k.alias("k"), _spaces(h).alias("inner"))),
        lambda gap, h: F.struct(r["rule"].alias("rule"), h["k"].alias("k"), gap.alias("gap"), h["inner"].alias("inner")))))
    d = d.select("doc_id", "tkey", "n_words", F.explode_outer(F.when(F.col("w").isNotNull(), places)).alias("p"))
    d = d.select("doc_id", "tkey", "n_words", "p.*")
    key = Window.partitionBy("doc_id", "tkey")
    # equal rows of the table give equal detections: one is kept, with their number
    d = d.withColumn("same", F.row_number().over(key.orderBy("rule", "k"))
                     - F.rank().over(key.orderBy("rule", "k")) + 1)
    d = d.withColumn("rows", F.max("same").over(key)).where("same = 1")
    by_rule = Window.partitionBy("doc_id", "tkey", "rule").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("start", (F.sum(F.col("gap") + F.col("inner")).over(by_rule) - F.col("inner") - 1).cast("long"))
    return d.select("doc_id", "tkey", "rows", "n_words", "rule", "start",
                    (F.col("start") + F.col("inner") + 1).alias("stop"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score (the largest weight of a surviving detection)
    and detections (label, start, stop of the surviving ones in order)."""
    table = rules()
    d = detections(docs, id_col, text_col)
    of = lambda field: F.element_at(F.array(*[F.lit(getattr(r, field)) for r in table]), F.col("rule") + 1)
    d = d.withColumns({"label": of("label"), "priority": of("priority"), "weight": of("weight"), "base": of("base")})
    doc = ["doc_id", "tkey"]
    before = Window.partitionBy(*doc).orderBy("start").rangeBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*doc).orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    same = Window.partitionBy(*doc, "start")
    hidden = F.lit(False)
    for p in sorted({r.priority for r in table}):
        mine = F.col("priority") == p
        above = F.max(F.when(F.col("priority") > p, F.col("stop"))).over(upto)
        equal = F.max(F.when(mine, F.col("stop"))).over(before)
        longer = F.max(F.when(mine, F.col("stop"))).over(same)
        earlier = F.min(F.when(mine, F.struct(-F.col("stop"), F.col("rule")))).over(same)
        hidden = hidden | (mine & (F.coalesce(above >= F.col("stop"), F.lit(False))
                                   | F.coalesce(equal >= F.col("stop"), F.lit(False))
                                   | (longer > F.col("stop"))
                                   | (earlier < F.struct(-F.col("stop"), F.col("rule")))))
    d = d.withColumn("kept", F.col("rule").isNotNull() & ~hidden)
    base = F.col("base") & F.col("rule").isNotNull()
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    out = d.groupBy("doc_id", "tkey").agg(
        F.max("rows").alias("rows"), F.max("n_words").alias("n_words"),
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        joined(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        joined(F.collect_set(F.when(base | F.col("kept"), F.col("label")))).alias("labels"),
        F.coalesce(F.max(F.when(F.col("kept"), F.col("weight"))), F.lit(0.0)).cast("double").alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("kept"), F.struct("start", "stop", "label")))).alias("detections"))
    return out.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).drop("_", "rows", "tkey")


def op1_license_scan(spark, sf_dir):
    return scan(documents(spark, sf_dir)).drop("detections")
