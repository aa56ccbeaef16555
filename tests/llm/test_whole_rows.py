"""Nothing is left out on the way to a result."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from stepstone.llm import quality, simhash, toxicity, url_lists
from stepstone.llm.labelled import labelled_sample


def test_every_event_is_a_change(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    changes = url_lists.changes_of(spark, small)
    assert changes.count() == changes.select("seq").distinct().count() == events.count()
    assert changes.groupBy("list", "key").count().where("count > 1").count() > 0


def test_repeated_id_is_sampled_once(spark):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(50)] + [(2, "b"), (3, "c")], "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 0)], "doc_id bigint, toxic int")
    found = labelled_sample(docs, labels, "toxic", F.lit(True), (2, 2)).collect()
    assert sorted(tuple(r) for r in found) == [(1, "text 0", 0), (2, "b", 1), (3, "c", 0)]


INTERNAL = "_text __text _toxic_score toxic_score _quality_score quality_score _mark mark _n n _id id _of of fp root component_id row score word node r a.b"


def test_stages_return_all_columns_unchanged(spark, odd, labels):
    """Whatever the columns of the input are called, and in whatever case of letters."""
    names = INTERNAL.split()
    docs = odd.select("doc_id", "text", *[F.concat(F.lit(f"{n} of "), F.coalesce("doc_id", F.lit(-1))).alias(n.upper() if k % 2 else n) for k, n in enumerate(names)])
    whole = Counter(docs.collect())
    for stage in (lambda d: toxicity.keep_clean(d, labels), lambda d: quality.keep_good(d, labels), simhash.one_of_each):
        found = stage(docs)
        assert found.columns == docs.columns
        rows = Counter(found.collect())
        assert rows and not rows - whole
    model = toxicity.fit([], np.zeros(0))
    assert toxicity.with_score(docs, model, docs.columns, name="s").drop("s").columns == docs.columns
    kept = [c for c in docs.columns if c.lower() != "fp"]
    assert simhash.fingerprints(docs, kept).columns == [*kept, "fp"]
