"""Incremental page ingest: each landed page is read exactly once."""

import json
import os
import subprocess
import sys
import uuid

import pytest

from tessera.streaming import ingest_pages_stream

SCHEMA = "page struct<number:int,totalPages:int>, _embedded struct<events:array<struct<id:string>>>"


def _land(path, number, total, ids):
    doc = {"page": {"number": number, "totalPages": total}, "_embedded": {"events": [{"id": i} for i in ids]}}
    (path / f"page-{number}-{uuid.uuid4().hex[:6]}.json").write_text(json.dumps(doc))


def test_stream_appends_new_pages_once(spark, tmp_path):
    landing, table = tmp_path / "landing", tmp_path / "table"
    landing.mkdir()
    _land(landing, 0, 3, ["a", "b"])
    _land(landing, 3, 3, ["past-the-end"])
    at = {"name": f"pages_{uuid.uuid4().hex[:6]}", "checkpoint": str(tmp_path / "ckpt")}
    ingest_pages_stream(spark, str(landing), SCHEMA, str(table), **at).awaitTermination(120)
    assert sorted(r.id for r in spark.read.parquet(str(table)).collect()) == ["a", "b"]
    _land(landing, 1, 3, ["c"])
    ingest_pages_stream(spark, str(landing), SCHEMA, str(table), **at).awaitTermination(120)
    assert sorted(r.id for r in spark.read.parquet(str(table)).collect()) == ["a", "b", "c"]


APP = """
import sys
from tessera.session import get_spark
from tessera.streaming import ingest_pages_stream
landing, table, shared, schema = sys.argv[1:]
spark = get_spark("local[2]", 2, extra={"spark.checkpoint.dir": shared})
ingest_pages_stream(spark, landing, schema, table).awaitTermination(120)
print("ROWS", *sorted(r.id for r in spark.read.parquet(table).collect()))
"""


def test_pages_between_two_applications_are_not_lost(tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

    def run():
        out = subprocess.run([sys.executable, "-c", APP, str(landing), str(tmp_path / "table"), str(tmp_path / "shared"), SCHEMA],
                             cwd=root, capture_output=True, text=True, timeout=240, env={**os.environ, "PYTHONPATH": root})
        return next((x.split()[1:] for x in out.stdout.splitlines() if x.startswith("ROWS")), out.stderr[-2000:])

    _land(landing, 0, 9, ["a"])
    assert run() == ["a"]
    _land(landing, 1, 9, ["b"])
    assert run() == ["a", "b"]


def test_stream_needs_a_lasting_checkpoint(spark, tmp_path):
    from tessera.streaming.pages import stream_checkpoint
    if not spark.conf.get("spark.checkpoint.dir", None):
        with pytest.raises(RuntimeError):
            stream_checkpoint(spark, "a", "b")
