"""Headline-query benchmark.

Runs the headline queries at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
on ``local[$BENCH_CPUS]`` and prints ONE JSON line.  Every query is forced
completely (a Parquet write, or its one-row result), never collected row by row.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tandem.config import VOCAB_SIZE  # noqa: E402
from tandem.operators import clean as C  # noqa: E402
from tandem.operators import epochs as EP  # noqa: E402
from tandem.operators import evaluate as EV  # noqa: E402
from tandem.operators import vocab as V  # noqa: E402
from tandem.operators.bpe import bpe_train  # noqa: E402
from tandem.plans.evaluate import pred_ref  # noqa: E402
from tandem.session import build_session  # noqa: E402
from tandem.sources import fixtures as FX  # noqa: E402


_OUT = tempfile.mkdtemp(prefix="tandem-bench-out-")
_N = [0]


def _write(df) -> None:
    """Materialise a table result the way a pipeline does: a Parquet write."""
    _N[0] += 1
    df.write.mode("overwrite").parquet(os.path.join(_OUT, f"t{_N[0]}"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    vocab_size = int(os.environ.get("BENCH_BPE_VOCAB", VOCAB_SIZE))
    spark = build_session(f"local[{cpus}]", app="tandem-bench", shuffle_partitions=max(8, cpus * 2),
                          extra={"spark.driver.memory": "16g"})
    if spark.sparkContext.getCheckpointDir() is None and not spark.sparkContext.getConf().get(
            "spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tandem-bench-ckpt-"))

    # warm-up: JVM JIT, codegen cache and Python workers, on the smallest
    # scale factor (not timed, not the measured input)
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        _write(C.clean_pairs(FX.pairs(spark, warm)))
        C.filter_funnel(FX.pairs(spark, warm)).first()
        _write(V.word_counts(V.stack_languages(FX.pairs(spark, warm, with_score=False))))
        EV.corpus_bleu(pred_ref(spark, warm)).first()
    spark.range(1000).select(F.sum("id")).collect()

    times: dict[str, float] = {}
    extra: dict = {}

    def timed(name, fn):
        t0 = time.time()
        out = fn()
        times[name] = round(time.time() - t0, 3)
        return out

    timed("clean_pairs", lambda: _write(C.clean_pairs(FX.pairs(spark, sf_dir))))
    funnel = timed("filter_funnel", lambda: C.filter_funnel(FX.pairs(spark, sf_dir)).first())
    extra["funnel_n_all"] = funnel["n_all"]
    pairs = FX.pairs(spark, sf_dir, with_score=False)
    timed("word_counts", lambda: _write(V.word_counts(V.stack_languages(pairs))))
    bleu = timed("corpus_bleu", lambda: EV.corpus_bleu(pred_ref(spark, sf_dir)).first())
    extra["bleu"] = round(bleu["bleu"], 4)

    model = timed("bpe_train", lambda: bpe_train(
        spark, V.word_counts(V.stack_languages(pairs)).checkpoint(), vocab_size))
    extra["bpe_rounds"] = model.rounds
    extra["bpe_merges"] = len(model.merges)

    def prepare():
        root = os.path.join(_OUT, "dataset")
        EP.save_dataset(FX.splits(pairs), root)
        _write(EP.prepare_batches(spark, root, model))
    timed("prepare_batches", prepare)

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                      "cpus": cpus, "extra": extra}))
    spark.stop()


if __name__ == "__main__":
    main()
