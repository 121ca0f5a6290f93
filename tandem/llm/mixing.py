"""Mixing sources to target weights by Poisson replication (operator 8).

A source with target share w of ``rows`` output rows and n input rows has the
mean repetition rate w * rows / n.  Each document's count is the Poisson
quantile of a uniform number hashed from (seed, id), so a rerun or a lost
executor gives the same counts; a document is exploded by its count, and the
copies are shuffled globally by a hash of (seed, id, copy).

Only the per-source table (one row a source: size, rate, quantile table) is
joined to the documents; it is broadcast when counted small, and otherwise
joined by shuffle with AQE splitting the hot sources.

Cases: a null source is a source of its own; a null id hashes as the empty
string; tied ids get equal counts; a source of weight 0 (or missing from the
weights) gives no rows; an empty table gives no rows; null and empty texts are
replicated like others; all columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import documents, join_small, unit

SEED = 17
#: Target share of a source: its size to this power, normalised.
TEMPER = 0.7
#: A Poisson rate above this is drawn as the sum of several draws of rate below it.
RATE_STEP = 64


def source_rates(docs: DataFrame, weights: dict | None = None, rows: int | None = None,
                 source_col: str = "source", temper: float = TEMPER) -> DataFrame:
    """(_src, _n, _rate, _draws, _cdf) per source.  Without ``weights`` a
    source's target is its size to the power ``temper``; without ``rows`` the
    output is as large as the input."""
    n = docs.groupBy(F.col(source_col).alias("_src")).agg(F.count(F.lit(1)).alias("_n"))
    if weights is None:
        n = n.withColumn("_w", F.pow(F.col("_n").cast("double"), F.lit(temper)))
    else:
        pairs = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
        n = n.withColumn("_w", F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("_src")), F.lit(0.0)))
    tot = n.agg(F.sum("_w").alias("_sw"), F.sum("_n").alias("_sn"))  # one row
    n = n.join(F.broadcast(tot)).withColumn(
        "_rate", F.col("_w") / F.col("_sw") * F.coalesce(F.lit(rows).cast("double"), F.col("_sn").cast("double"))
        / F.col("_n"))
    n = n.withColumn("_draws", F.greatest(F.lit(1), F.ceil(F.col("_rate") / RATE_STEP).cast("int"))) \
         .withColumn("_step", F.col("_rate") / F.col("_draws"))
    # quantile table: P(X <= k) for k up to where double precision ends
    top = F.ceil(F.col("_step") + 12 * F.sqrt(F.col("_step")) + 40).cast("int")
    first = F.struct(F.exp(-F.col("_step")).alias("p"), F.array(F.exp(-F.col("_step"))).alias("c"))
    cdf = F.aggregate(F.sequence(F.lit(1), top), first, lambda acc, k: F.struct(
        (acc["p"] * F.col("_step") / k).alias("p"),
        F.concat(acc["c"], F.array(F.element_at(acc["c"], -1) + acc["p"] * F.col("_step") / k)).alias("c")),
        lambda acc: acc["c"])
    return n.withColumn("_cdf", cdf).select("_src", "_n", "_rate", "_draws", "_cdf")


def replicate(docs: DataFrame, weights: dict | None = None, rows: int | None = None, seed: int = SEED,
              id_col: str = "doc_id", source_col: str = "source", temper: float = TEMPER) -> DataFrame:
    """Every column of ``docs`` as the struct ``row``, with rate, n_copies,
    copy (from 0) and the shuffle key ``place``; in global order of ``place``."""
    rates = source_rates(docs, weights, rows, source_col, temper)
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    base = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"row.{id_col}").cast("string"), F.lit("")))
    held = held.withColumn("_src", F.col(f"row.{source_col}"))
    # the join must match a null source with itself
    held = held.withColumn("_key", F.struct(F.col("_src").isNull(), F.coalesce(F.col("_src").cast("string"), F.lit(""))))
    rates = rates.withColumn("_key", F.struct(F.col("_src").isNull(),
                                              F.coalesce(F.col("_src").cast("string"), F.lit("")))).drop("_src")
    j = join_small(held, rates, ["_key"])
    count = F.aggregate(F.sequence(F.lit(1), F.col("_draws")), F.lit(0), lambda acc, d: acc + F.size(F.filter(
        F.col("_cdf"), lambda c: c < unit(F.concat(base, F.lit(":"), d.cast("string"))))))
    j = j.withColumn("n_copies", count).where("n_copies > 0 and _rate > 0")
    out = j.select("row", F.col("_rate").alias("rate"), "n_copies",
                   F.explode(F.sequence(F.lit(0), F.col("n_copies") - 1)).alias("copy"))
    key = F.substring(F.md5(F.concat(base, F.lit("#"), F.col("copy").cast("string"))), 1, 16)
    # places are uniform, so equal ranges of them are the partitions: no sampling pass as for orderBy
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.floor(F.conv(F.substring("place", 1, 7), 16, 10).cast("long") * parts / (1 << 28)).cast("int")
    return out.withColumn("place", key).repartitionById(parts, part).sortWithinPartitions("place", f"row.{id_col}")


def mixed(docs: DataFrame, **kw) -> DataFrame:
    """The replicated rows with the columns of ``docs``, globally shuffled."""
    return replicate(docs, **kw).select("row.*")


def op8_poisson_mixing(spark, sf_dir):
    """The whole replicated documents in shuffled order, with n_copies, copy and place."""
    return replicate(documents(spark, sf_dir)).select("row.*", "n_copies", "copy", "place")


OP8_SQL = f"""
WITH RECURSIVE s AS (
  SELECT source, count(*) AS n, pow(count(*)::DOUBLE, {TEMPER}) AS w FROM documents GROUP BY source),
t AS (SELECT sum(w) AS sw, sum(n) AS sn FROM s),
r AS (SELECT source, w / sw * sn::DOUBLE / n AS rate FROM s, t),
q AS (SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM r
      UNION ALL
      SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM q
      WHERE k < rate + 12 * sqrt(rate) + 40),
u AS (SELECT doc_id, source,
        (('0x' || substr(md5('{SEED}:' || doc_id || ':1'), 1, 13))::BIGINT + 0.5) / 4503599627370496.0 AS u
      FROM documents),
n AS (SELECT doc_id, count(*) FILTER (WHERE q.c < u.u)::INT AS n_copies
      FROM u JOIN q ON u.source IS NOT DISTINCT FROM q.source GROUP BY doc_id)
SELECT d.*, n_copies, copy::INT AS copy,
       substr(md5('{SEED}:' || doc_id || '#' || copy), 1, 16) AS place
FROM documents d JOIN n USING (doc_id), unnest(range(n_copies)) AS x(copy) WHERE n_copies > 0
"""
