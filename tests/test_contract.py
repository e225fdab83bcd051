"""Driver contract, language model floor, stream = batch."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from postlens.operators import language as LG
from postlens.plans import catalog
from postlens.sources.tables import table

from conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"subreddit", "keyword", "count", "rank"}
    assert df.count() > 0


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_language_model_accuracy(spark):
    d = table(spark, SF_SMALL, "documents")
    model = LG.fit_language_model(d.where(F.xxhash64("doc_id") % 5 != 0))
    held = LG.detect_language(d.where(F.xxhash64("doc_id") % 5 == 0), model)
    acc = held.agg(F.avg((F.col("lang") == F.col("language_detected")).cast("double"))).first()[0]
    assert acc >= 0.9


def test_stream_equals_batch(spark):
    streamed = catalog.QUERIES["stream_ingest_events"](spark, SF_SMALL)
    batch = table(spark, SF_SMALL, "events").select("event_id").distinct()
    assert streamed.count() == batch.count()
    assert streamed.select("event_id").subtract(batch).count() == 0
