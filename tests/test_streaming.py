"""The row-wise form plans give the same rows on a stream as on a table."""

import uuid
from collections import Counter

from test_plans import FORM, form

from fieldspark.plans import effort as ef
from fieldspark.streaming.form_stream import append_media_events, media_event_stream


def test_stream_equals_batch(spark, tmp_path):
    landed, out = str(tmp_path / "landed"), str(tmp_path / "events")
    # the cluster's checkpoint folder outlives a test run, so the stream gets a name of its own
    name = f"media-events-{uuid.uuid4().hex}"
    sheet = form(spark)
    schema = spark.createDataFrame([], FORM).schema
    for part in ("_row_id <= 4", "_row_id > 4"):
        sheet.where(part).write.mode("append").parquet(landed)
        stream = media_event_stream(spark, landed, schema)
        query = append_media_events(stream, out, name, str(tmp_path))
        query.awaitTermination(120)
        assert query.exception() is None
    want = ef.media_events(ef.standardise_form(sheet))
    got = spark.read.parquet(out).select(*want.columns)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
