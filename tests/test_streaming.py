"""Streamed NDJSON ingest: two runs over growing input append each file once."""

import uuid

from tessera.session import scratch_path
from tessera.sources.registry import load_table
from tessera.streaming import run_ingest
from tests.conftest import SF001


def test_incremental_ingest(spark):
    cust = load_table(spark, SF001, "customer")
    src = scratch_path(spark, "stream-src")
    dst = scratch_path(spark, "stream-dst")
    name = f"cust-{uuid.uuid4().hex}"
    first = cust.where("c_custkey < 100")
    first.write.mode("append").json(src)
    out = run_ingest(spark, src, cust.schema, dst, name)
    assert out.count() == first.count()
    cust.where("c_custkey >= 100").write.mode("append").json(src)
    out = run_ingest(spark, src, cust.schema, dst, name)
    assert out.count() == cust.count()
    assert sorted(r[0] for r in out.select("c_custkey").collect()) == \
        sorted(r[0] for r in cust.select("c_custkey").collect())
