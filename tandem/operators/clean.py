"""Cleaning: lengths, length / ratio / score predicates, masks and the
filter funnel (P2-P11, J2, J3, A1, A8, A9).

Predicates are plain Columns so Catalyst fuses them into one Filter inside
whole-stage codegen; the only exchange in ``clean_pairs`` is the score join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.config import CleanConfig
from tandem.functions.text import is_blank, strip_text, word_count

DEFAULT = CleanConfig()


def with_lengths(df: DataFrame, en: str = "en", vi: str = "vi") -> DataFrame:
    """Add ``len_en``, ``len_vi`` = whitespace word counts.

    The counts are produced by a one-row generator so each regex runs once
    per row: as plain projected columns Catalyst would inline them into
    every predicate that uses them (eight regex scans per row in the fused
    cleaning filter, and a generated method too large to JIT)."""
    lens = F.struct(word_count(en).alias("len_en"), word_count(vi).alias("len_vi"))
    return df.select("*", F.inline(F.array(lens)))


def strip_pairs(df: DataFrame) -> DataFrame:
    """Unicode-strip both sides."""
    return df.withColumn("en", strip_text("en")).withColumn("vi", strip_text("vi"))


def nonempty_pred(en: str = "en", vi: str = "vi") -> Column:
    """Both sides non-blank; NULL counts as blank."""
    return ~is_blank(en) & ~is_blank(vi)


def length_pred(cfg: CleanConfig = DEFAULT) -> Column:
    """``min_len <= len <= max_len`` on both sides, inclusive."""
    return (F.col("len_en").between(cfg.min_len, cfg.max_len)
            & F.col("len_vi").between(cfg.min_len, cfg.max_len))


def ratio_only_pred(cfg: CleanConfig = DEFAULT) -> Column:
    """Length ratio within ``max_ratio`` both ways, by multiplication (no
    division, so no divide-by-zero); (0, 0) passes this mask alone (A9)."""
    r = F.lit(float(cfg.max_ratio))
    return ((F.col("len_en") * r >= F.col("len_vi"))
            & (F.col("len_vi") * r >= F.col("len_en")))


def nonzero_pred() -> Column:
    return (F.col("len_en") > 0) & (F.col("len_vi") > 0)


def ratio_pred(cfg: CleanConfig = DEFAULT) -> Column:
    """Both lengths > 0 and ratio within bounds (P5)."""
    return nonzero_pred() & ratio_only_pred(cfg)


def score_pred(cfg: CleanConfig = DEFAULT, col: str = "score") -> Column:
    """``score > threshold`` evaluated in float32, NaN and NULL dropped.

    The threshold literal is cast to float so the comparison stays single
    precision (a double comparison keeps boundary rows).
    """
    s = F.col(col).cast("float")
    return ~F.isnan(s) & (s > F.lit(float(cfg.score_threshold)).cast("float"))


def keep_mask(cfg: CleanConfig = DEFAULT) -> Column:
    """length ∧ ratio ∧ nonzero ∧ score, NULL → false."""
    return F.coalesce(length_pred(cfg) & ratio_pred(cfg) & score_pred(cfg), F.lit(False))


def with_keep_mask(df: DataFrame, cfg: CleanConfig = DEFAULT) -> DataFrame:
    return with_lengths(df).withColumn("keep_mask", keep_mask(cfg))


def clean_pairs(pairs: DataFrame, cfg: CleanConfig = DEFAULT) -> DataFrame:
    """Flagship: lengths → length → ratio → score in one fused filter (P10).

    ``pairs`` must carry ``id, en, vi, score`` (score attached by J2).
    """
    return (with_lengths(pairs)
            .filter(length_pred(cfg) & ratio_pred(cfg) & score_pred(cfg))
            .select("id", "en", "vi"))


def clean_pairs_sequential(pairs: DataFrame, scores: DataFrame,
                           cfg: CleanConfig = DEFAULT) -> DataFrame:
    """Variant A: length, ratio filters, then a semi join with the set of
    ids whose score passes (P7/J3).  Must return the same ids as P10."""
    lr = with_lengths(pairs).filter(length_pred(cfg)).filter(ratio_pred(cfg))
    good = scores.filter(score_pred(cfg)).select("id")
    return semi_by_ids(lr, good).select("id", "en", "vi")


def clean_pairs_masked(pairs: DataFrame, cfg: CleanConfig = DEFAULT) -> DataFrame:
    """Variant B: add ``keep_mask`` then filter on it (P8+P9)."""
    return filter_by_mask(with_keep_mask(pairs, cfg)).select("id", "en", "vi")


def filter_by_mask(df: DataFrame, mask: str = "keep_mask") -> DataFrame:
    return df.filter(F.col(mask))


def semi_by_ids(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Keep rows whose id is in ``ids`` (J3).  A semi join: AQE broadcasts the
    id side only when its runtime size is under the threshold."""
    return df.join(ids.select(key), key, "left_semi")


def attach_scores(pairs: DataFrame, scores: DataFrame) -> DataFrame:
    """Left join scores on id; missing score ⇒ NULL ⇒ never kept."""
    return pairs.join(scores.select("id", "score"), "id", "left")


def score_alignment(pairs: DataFrame, scores: DataFrame) -> DataFrame:
    """One row: pair count, score count and whether they differ (S8 warning).

    Both inputs are tagged and unioned into one aggregation (no join)."""
    tagged = (pairs.select(F.lit(True).alias("is_pair"))
              .unionByName(scores.select(F.lit(False).alias("is_pair"))))
    return (tagged.agg(F.count_if(F.col("is_pair")).alias("n_pairs"),
                       F.count_if(~F.col("is_pair")).alias("n_scores"))
            .withColumn("mismatch", F.col("n_pairs") != F.col("n_scores")))


def _pct(num: Column, den: Column) -> Column:
    # NULL on empty input instead of a division error
    return F.try_divide(num * F.lit(100.0), den.cast("double"))


def filter_funnel(pairs: DataFrame, cfg: CleanConfig = DEFAULT) -> DataFrame:
    """Rows after each cumulative stage in ONE pass.

    Stages: all → length → length+ratio → length+ratio+score.  Also the
    rows removed per stage and percentages of the original.
    """
    d = with_lengths(pairs)
    L = length_pred(cfg)
    R = ratio_pred(cfg)
    S = score_pred(cfg)
    agg = d.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.count_if(F.coalesce(L, F.lit(False))).alias("n_length"),
        F.count_if(F.coalesce(L & R, F.lit(False))).alias("n_length_ratio"),
        F.count_if(F.coalesce(L & R & S, F.lit(False))).alias("n_all"),
    )
    return agg.select(
        "*",
        (F.col("n_pairs") - F.col("n_length")).alias("removed_length"),
        (F.col("n_length") - F.col("n_length_ratio")).alias("removed_ratio"),
        (F.col("n_length_ratio") - F.col("n_all")).alias("removed_score"),
        _pct(F.col("n_pairs") - F.col("n_all"), F.col("n_pairs")).alias("removed_pct"),
        _pct(F.col("n_all"), F.col("n_pairs")).alias("retained_pct"),
    )


def mask_counts(pairs: DataFrame, cfg: CleanConfig = DEFAULT) -> DataFrame:
    """Independent per-mask counts, one pass (A9).  The ratio mask has no >0
    guard here; the guard is counted separately."""
    d = with_lengths(pairs)
    return d.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.count_if(F.coalesce(length_pred(cfg), F.lit(False))).alias("n_length_mask"),
        F.count_if(F.coalesce(ratio_only_pred(cfg), F.lit(False))).alias("n_ratio_mask"),
        F.count_if(F.coalesce(nonzero_pred(), F.lit(False))).alias("n_nonzero_mask"),
        F.count_if(F.coalesce(score_pred(cfg), F.lit(False))).alias("n_score_mask"),
        F.count_if(keep_mask(cfg)).alias("n_keep"),
    )


def nonempty_report(pairs: DataFrame) -> DataFrame:
    """Rows before / after the non-blank filter and the number dropped."""
    return pairs.agg(
        F.count(F.lit(1)).alias("n_in"),
        F.count_if(nonempty_pred()).alias("n_kept"),
    ).withColumn("n_dropped", F.col("n_in") - F.col("n_kept"))
