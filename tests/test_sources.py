"""Typed readers, landing inventory, partition overwrite and the table store."""

import json
import os

from pyspark.sql import functions as F

from riskview.schemas import KYC_DOCUMENTS, WATCHLIST_SANCTIONS
from riskview.sources import readers
from riskview.sources.inventory import landing_inventory
from riskview.sources.store import TableStore, write_partitioned


def test_csv_quoted_commas_and_empty_cells(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "wl.csv")
    with open(p, "w") as f:
        f.write("watchlist_id,entity_name,alias,list_type,country,designation,listed_date,"
                "source_system,record_date\n")
        f.write('W1,"Doe, John",,OFAC,US,"Say ""hi"", ok",2020-01-02,s,2024-01-01\n')
    df = readers.read_source(spark, "watchlist_sanctions", p)
    r = df.first()
    assert df.schema == WATCHLIST_SANCTIONS
    assert (r.entity_name, r.alias, r.designation, str(r.listed_date)) == \
        ("Doe, John", None, 'Say "hi", ok', "2020-01-02")


def test_json_array_file(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "kyc.json")
    docs = [{"doc_id": "D1", "customer_id": "C1", "doc_type": "PASSPORT",
             "doc_status": "EXPIRED", "verification_date": "2023-01-02",
             "expiry_date": "2024-01-02", "batch_timestamp": "2024-01-31T10:00:00"},
            {"doc_id": "D2", "customer_id": "C2", "doc_status": "VERIFIED"}]
    with open(p, "w") as f:
        json.dump(docs, f, indent=2)
    df = readers.read_source(spark, "kyc_documents", p)
    assert df.schema == KYC_DOCUMENTS
    rows = {r.doc_id: r for r in df.collect()}
    assert len(rows) == 2 and str(rows["D1"].expiry_date) == "2024-01-02"
    assert rows["D2"].verification_date is None


def test_ndjson_keeps_corrupt_lines(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "t.json")
    with open(p, "w") as f:
        f.write('{"transaction_id": "T1", "amount": 5.5, "txn_date": "2024-01-01T10:00:00"}\n')
        f.write("{not json\n")
    from riskview.schemas import TRANSACTION_FEED
    df = readers.read_ndjson(spark, p, TRANSACTION_FEED, keep_corrupt=True).cache()
    assert df.filter(F.col(readers.CORRUPT).isNotNull()).count() == 1
    assert df.filter(F.col("transaction_id") == "T1").first().amount == 5.5


def test_inventory_reports_missing_folder(spark, tmpdir_path):
    for folder, n in (("a", 2), ("b", 1)):
        os.makedirs(os.path.join(tmpdir_path, folder))
        for i in range(n):
            with open(os.path.join(tmpdir_path, folder, f"f{i}.csv"), "w") as f:
                f.write("x" * 2048)
    inv = {r.folder: r for r in landing_inventory(spark, tmpdir_path, ["a", "b", "c"]).collect()}
    assert (inv["a"].files, inv["a"].total_kb, inv["a"].present) == (2, 4.0, True)
    assert (inv["c"].files, inv["c"].present) == (0, False)


def test_partition_overwrite_keeps_other_days(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "t")
    day = lambda d, v: spark.createDataFrame([(v, d)], "v string, ingest_day int")
    write_partitioned(day(1, "a"), p, ["ingest_day"])
    write_partitioned(day(2, "b"), p, ["ingest_day"])
    write_partitioned(day(1, "c"), p, ["ingest_day"])     # re-run of day 1
    got = sorted((r.ingest_day, r.v) for r in spark.read.parquet(p).collect())
    assert got == [(1, "c"), (2, "b")]


def test_store_publish_reads_latest_and_self_overwrite(spark, tmpdir_path):
    st = TableStore(spark, tmpdir_path)
    st.publish(spark.range(5), "gold", "t")
    # read the table and publish its next version in the same plan
    st.publish(st.read("gold", "t").withColumn("id", F.col("id") * 10), "gold", "t")
    assert sorted(r.id for r in st.read("gold", "t").collect()) == [0, 10, 20, 30, 40]
    # another schema replaces the table's
    st.publish(spark.range(2).selectExpr("id", "id AS more"), "gold", "t")
    assert st.read("gold", "t").columns == ["id", "more"] and len(st.versions("gold", "t")) == 3


def test_csv_columns_are_bound_by_the_header(spark, tmpdir_path):
    import pytest
    head = "entity_name,watchlist_id,alias,list_type,country,designation,listed_date,source_system,record_date\n"
    p = os.path.join(tmpdir_path, "wl.csv")
    with open(p, "w") as f:
        f.write(head + "Doe John,W1,,OFAC,US,x,2020-01-02,s,2024-01-01\n")
    r = readers.read_source(spark, "watchlist_sanctions", p).first()
    assert (r.watchlist_id, r.entity_name) == ("W1", "Doe John")
    with open(p, "w") as f:
        f.write(head.replace("alias", "other") + "Doe John,W1,,OFAC,US,x,2020-01-02,s,2024-01-01\n")
    with pytest.raises(readers.HeaderError):
        readers.read_source(spark, "watchlist_sanctions", p)


def test_csv_files_with_different_headers_raise(spark, tmpdir_path):
    import pytest
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    for name, text in (("1.csv", "a,b\n1,2\n"), ("2.csv", "b,a\n2,1\n")):
        with open(os.path.join(tmpdir_path, name), "w") as f:
            f.write(text)
    with pytest.raises(Exception, match="header"):
        readers.read_csv(spark, tmpdir_path, schema).collect()


def test_nested_folders_are_read_by_every_reader(spark, tmpdir_path):
    df = spark.range(10).selectExpr("id AS doc_id", "CAST(id AS STRING) AS name")
    deep = f"{tmpdir_path}/{{}}/2024-01-30/late"
    df.write.option("header", True).csv(deep.format("csv"))
    df.write.json(deep.format("ndjson"))
    df.write.parquet(deep.format("parquet"))
    from riskview.plans.catalog import write_json_arrays
    write_json_arrays(df, deep.format("json_array"), 4)
    for fmt in ("csv", "ndjson", "json_array", "parquet"):
        got = readers.read_source(spark, "x", f"{tmpdir_path}/{fmt}", fmt, df.schema)
        assert got.count() == 10, fmt


def test_truncated_array_is_kept_as_text(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "d.json"), "w") as f:
        f.write('[{"doc_id": "D1"}, {"doc_id": "D2"}, {"doc_id": ')
    df = readers.read_source(spark, "kyc_documents", tmpdir_path, keep_corrupt=True).cache()
    kept = df.filter(F.col(readers.CORRUPT).isNotNull()).collect()
    assert kept and "D2" in kept[0][readers.CORRUPT]


def test_pipeline_layer_report(spark, tmpdir_path):
    from riskview.plans import pipeline
    lay = pipeline.Layout(landing=f"{tmpdir_path}/landing", root=f"{tmpdir_path}/lake",
                          formats={"transaction_feed": "ndjson", "kyc_documents": "ndjson"})
    spark.createDataFrame([(1, "SUCCESS")], "transaction_id long, status string") \
        .write.json(f"{tmpdir_path}/landing/transaction_feed")
    lay2 = pipeline.Layout(landing=lay.landing, root=lay.root,
                           formats={"transaction_feed": "ndjson"},
                           schemas={"transaction_feed": spark.read.json(
                               f"{tmpdir_path}/landing/transaction_feed").schema})
    pipeline.run_bronze(spark, lay2, "2024-01-31 00:00:00")
    rep = {r.table_name: r for r in pipeline.layer_report(spark, lay, "bronze").collect()}
    assert rep["transaction_feed"].rows == 1 and rep["transaction_feed"].error is None
    assert rep["TOTAL"].rows == 1
    assert rep["kyc_documents"].rows is None and rep["kyc_documents"].error


def test_json_array_landing_bounded_files_round_trip(spark, tmpdir_path):
    import glob
    import json

    from riskview.plans.catalog import write_json_arrays
    from riskview.sources.readers import read_json_array
    df = spark.range(0, 2500, 1, 4).selectExpr(
        "id AS doc_id", "id % 7 AS customer_id", "CAST(id AS STRING) AS doc_type",
        "date_add(DATE '2020-01-01', CAST(id % 400 AS INT)) AS verification_date")
    path = f"{tmpdir_path}/docs"
    write_json_arrays(df, path, rows_per_file=300)
    files = [f for f in glob.glob(f"{path}/**/*.txt", recursive=True)]
    sizes = []
    for f in files:
        with open(f) as fh:
            arr = json.loads(fh.read())       # the whole file is one JSON array
        assert isinstance(arr, list)
        sizes.append(len(arr))
    assert sum(sizes) == 2500 and max(sizes) <= 300 and len(files) >= 9
    back = read_json_array(spark, path, df.schema)
    assert back.columns == df.columns
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_inventory_root_with_regex_characters(spark, tmpdir_path):
    from riskview.sources.inventory import landing_inventory
    root = f"{tmpdir_path}/land+ing (v1)"
    spark.range(3).write.parquet(f"{root}/account_activity")
    got = {r.folder: (r.files > 0, r.present)
           for r in landing_inventory(spark, root, ["account_activity", "kyc"]).collect()}
    assert got == {"account_activity": (True, True), "kyc": (False, False)}


def test_inventory_rounds_the_sum_and_stands_a_missing_root(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/a")
    for i in range(10):
        with open(f"{tmpdir_path}/a/f{i}.csv", "w") as f:
            f.write("x" * 40)                      # 0.04 kB each: ten are 0.4, not ten times 0.0
    assert landing_inventory(spark, tmpdir_path, ["a"]).first().total_kb == 0.4
    got = landing_inventory(spark, f"{tmpdir_path}/nowhere", ["a", "b"]).collect()
    assert sorted((r.folder, r.files, r.present) for r in got) == [("a", 0, False), ("b", 0, False)]
