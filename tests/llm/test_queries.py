"""Registered queries against their SQL, and the pipeline, on the smallest tables."""

import hashlib
import zlib
from pathlib import Path

import duckdb
import pytest
import corpus_pipeline
from conftest import rows_of
from tallyfield.llm import queries, secret_scan

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result, wanted = queries.queries()[name](spark, SF_DIR), duck.sql(queries.oracle_sql()[name])
    columns = sorted(result.columns)
    assert columns == sorted(wanted.columns)
    assert rows_of(result.select(*columns)) == sorted(wanted.select(*columns).fetchall(), key=repr)


@pytest.mark.parametrize("name, columns", [
    ("op3_mixing", {"doc_id", "size", "source_size", "target", "taken"}), ("op5_html_extract", {"page_id", "url", "text", "n_chars"}),
    ("op7_brown_lm", {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"}),
    ("op8_secret_scan", {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"}),
    ("op9_bpe", {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}),
])
def test_query_without_sql(spark, name, columns):
    given = "pages" if name == "op5_html_extract" else "documents"
    key = "page_id" if given == "pages" else "doc_id"
    source = {r[key]: r for r in spark.read.parquet(f"{SF_DIR}/{given}.parquet").collect()}
    rows = queries.queries()[name](spark, SF_DIR).collect()
    assert set(rows[0].asDict()) >= columns and sorted(r[key] for r in rows) == sorted(source)
    crc = {k: zlib.crc32(str(k).encode()) % 5 for k in source}
    for r in rows:
        if name == "op5_html_extract":
            assert r["n_chars"] == len(r["text"])
            continue
        words = (source[r["doc_id"]]["text"] or "").encode().split()
        if name == "op3_mixing":
            assert r["size"] == len(words) and r["taken"] in (0, len(words), 2 * len(words))
        if name == "op7_brown_lm":
            assert r["held_out"] == (crc[r["doc_id"]] == 1) and r["n_tokens"] == len(words) + 1 and r["n_known"] <= r["n_tokens"]
        if name == "op8_secret_scan":
            base = secret_scan.base_findings(source[r["doc_id"]]["text"] or "")
            spans = ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in base)
            assert r["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
            assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in base) for i in range(3)]
            assert ",".join(s for s in r["spans"].split(",") if s and not s.startswith("model")) == spans


def test_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert set(rows.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"}
    assert rows.count() > 0
