"""Every stage of the pipeline against a plain version on its own input."""

from collections import Counter

import duckdb
from pyspark.sql import functions as F
from test_operators import SF, brute_capacity, brute_near, clashing, empty, lower, odd_rows, split

import corpus_pipeline
from tandem.llm import mixing, quality, queries
from tandem.llm.common import documents
from tandem.session import read_table


def test_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = documents(spark, sf)
    stages = [f for _, f in corpus_pipeline.STAGES]
    kept = stages[0](spark, docs, sf).checkpoint()
    assert kept.columns == docs.columns
    weights = quality.train(docs, read_table(spark, sf, "labels"))
    want = {r.row.doc_id for r in quality.scored(docs, weights).where("score >= 0.5").collect()}
    assert {r.doc_id for r in kept.collect()} == want and kept.count() == len(want)
    label = read_table(spark, sf, "labels")
    share = kept.join(label, "doc_id").agg(F.avg("quality")).first()[0]
    assert share > 0.98 and kept.join(label.where("quality = 1"), "doc_id").count() >= 0.97 * label.where("quality = 1").count()

    one = stages[1](spark, kept, sf).checkpoint()
    near = brute_near(((r.doc_id, r.text) for r in kept.collect()), 5, 4, 5)
    assert {r.doc_id for r in one.collect()} == {i for i, (_, c) in near.items() if c == i} and one.columns == docs.columns

    clean = stages[2](spark, one, sf).checkpoint()
    flat = lambda t: " " + " ".join(split(lower(t), "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")) + " "
    items = [flat(r.text) for r in read_table(spark, sf, "benchmark").collect()]
    leaks = {r.doc_id for r in one.collect() if any(x in flat(r.text) for x in items)}
    left = {r.doc_id for r in clean.collect()}
    assert leaks and not leaks & left and len(left) >= one.count() - 1.1 * len(leaks)

    mixed = stages[3](spark, clean, sf).checkpoint()
    assert mixed.columns == docs.columns
    con = duckdb.connect()
    con.register("documents", clean.select("doc_id", "source").toArrow())
    want = Counter(x[0] for x in con.execute(mixing.OP8_SQL).fetchall())
    assert Counter(r.doc_id for r in mixed.collect()) == want

    last = stages[4](spark, mixed, sf).collect()
    assert len(last) == mixed.count()
    groups = Counter()
    import hashlib
    for r in mixed.collect():
        groups[hashlib.md5(r.text.encode()).digest()] += len(r.text.encode()) + 16
    loads = Counter()
    for r in last:
        loads[r.shard] += r.size
    assert max(loads.values()) == brute_capacity([groups[k] for k in sorted(groups)], 40)


def test_stages_on_odd_and_empty_rows(spark):
    for df in (clashing(odd_rows(spark)), empty(spark)):
        docs = df
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF).checkpoint()
            assert docs.columns == df.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_mixing_matches_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = queries.QUERIES["op8_poisson_mixing"](spark, SF)
    want = con.execute(queries.ORACLES["op8_poisson_mixing"])
    cols = [d[0] for d in want.description]
    assert sorted(cols) == sorted(got.columns)
    assert Counter(tuple(r) for r in got.select(*cols).collect()) == Counter(want.fetchall())
