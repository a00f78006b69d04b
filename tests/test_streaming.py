"""Streaming upsert of arriving files."""

import json

from pyspark.sql import types as T

from boardloom.operators.state import FINDINGS, Versions
from boardloom.streaming.ingest import upsert_stream

ARRIVING = T.StructType([T.StructField(c, T.StringType()) for c in ("fingerprint", "school_code", "title", "url")])


def test_upsert_stream(spark, tmp_path):
    incoming = tmp_path / "in"
    incoming.mkdir()
    state = Versions(spark, str(tmp_path / "state"), FINDINGS)
    for n, prints in enumerate((["a", "b"], ["b", "c", "c"])):
        (incoming / f"{n}.json").write_text("\n".join(json.dumps({"fingerprint": p, "school_code": "s", "title": f"t{n}", "url": "u"}) for p in prints))
        upsert_stream(spark, str(incoming), ARRIVING, state, str(tmp_path / "check")).awaitTermination()
    assert {r.fingerprint: r.title for r in state.read().collect()} == {"a": "t0", "b": "t0", "c": "t1"}
