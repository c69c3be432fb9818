"""Every named query against its SQL in DuckDB, and the plans that the big ones must have."""

import compare
import pytest

from cellweave.plans.catalog import QUERIES, SQL


@pytest.fixture(scope="module")
def con(sf):
    return compare.connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf, con, name):
    assert compare.mismatch(QUERIES[name](spark, sf), con, SQL[name]) is None


@pytest.mark.parametrize(("name", "step", "start", "near"), [("nearest_resample_whole", 1.2, 0.3, 0.5), ("bilinear_resample_whole", 0.7, 0.2, 0)])
def test_resampling_covers_the_source(spark, sf, name, step, start, near):
    sf = "/root/testdata/sf0.01"
    last = QUERIES["raster_algebra"](spark, sf).agg({"row": "max"}).first()[0]
    reached = QUERIES[name](spark, sf).agg({"row": "max"}).first()[0]
    assert reached * step + start + near < last + 1 and (reached + 1) * step + start + near > last


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry_runs(spark):
    import __spark_entry__

    rows = __spark_entry__.entry(spark).collect()
    assert rows and rows == sorted(rows, key=lambda r: -r["prob_media"])
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, sf):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan(QUERIES["range_filters"](spark, sf))
    assert "GreaterThanOrEqual(o_totalprice,1000.0)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp" in text
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan(QUERIES["one_hot"](spark, sf))


def test_aggregates_combine_before_the_shuffle(spark, sf):
    text = plan(QUERIES["named_agg"](spark, sf))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_avg" in text


def test_features_of_quality_are_written_once(spark, tmp_path):
    from cellweave.plans import quality_of_models

    texts = ["", None, "A.b\n.Cé..\U0001f600Z", "x" * 50, "..", "ÀÉ AZ\r\n."]
    spark.createDataFrame([(i, t, len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, i % 2) for i in range(7)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    found = quality_of_models._quality(spark, str(tmp_path))
    assert "FileScan" not in plan(found)  # fits and measures don't read the texts again
    share = lambda t, kept: None if t is None else sum(map(kept, t)) / max(1, len(t))
    assert {r["doc_id"]: (r["dots"], r["upper"], r["held"]) for r in found.collect()} == {i: (share(t, lambda c: c == "."), share(t, lambda c: "A" <= c <= "Z"), i % 5 == 0) for i, t in enumerate(texts)}
