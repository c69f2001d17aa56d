from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest

from martlake.schemas import SOURCE_SCHEMAS
from martlake.session import new_scratch_dir
from martlake.sinks.files import write_layer
from martlake.sinks.jdbc import jdbc_write_options
from martlake.sources.files import ingest, read_layer, read_source_csv


def _write(path: str, text: str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_reviews_csv_with_line_breaks_and_quotes(spark):
    p = _write(
        new_scratch_dir(spark, "csv") + "/reviews.csv",
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,"ok","line one\nline ""two"", end",2018-01-01 10:00:00,2018-01-02 11:00:00\n'
        "r2,o2,x,,,not a time,2018-01-03 00:00:00\n",
    )
    rows = read_source_csv(spark, "reviews", p).orderBy("review_id").collect()
    assert len(rows) == 2
    assert rows[0]["review_comment_message"] == 'line one\nline "two", end'
    assert rows[0]["review_creation_date"] == dt.datetime(2018, 1, 1, 10, 0)
    assert rows[1]["review_score"] is None  # bad number -> NULL
    assert rows[1]["review_creation_date"] is None  # bad timestamp -> NULL
    assert rows[1]["review_answer_timestamp"] == dt.datetime(2018, 1, 3)


def test_customers_keep_leading_zero_zip_and_money_is_exact(spark):
    root = new_scratch_dir(spark, "csv")
    c = _write(root + "/c.csv", "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\nc1,u1,01310,sao paulo,SP\n")
    assert read_source_csv(spark, "customers", c).first()["customer_zip_code_prefix"] == "01310"
    inferred = read_source_csv(spark, "customers", c, infer_schema=True).first()
    assert inferred["customer_zip_code_prefix"] == 1310  # why inference is not the default
    i = _write(root + "/i.csv", "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\no1,1,p,s,2018-01-01 00:00:00,0.10,0.20\n")
    r = read_source_csv(spark, "order_items", i).first()
    assert r["price"] + r["freight_value"] == Decimal("0.30")


def test_ingest_writes_parquet_with_load_time(spark):
    root = new_scratch_dir(spark, "ingest")
    c = _write(root + "/c.csv", "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\nc1,u1,1,x,SP\n")
    df = ingest(spark, "customers", c, root + "/ods")
    assert "etl_timestamp" in df.columns and df.count() == 1


def test_csv_columns_go_by_header_name(spark):
    root = new_scratch_dir(spark, "csv")
    c = _write(root + "/c.csv", "Customer_Unique_ID ,customer_id,extra,customer_state,customer_city,customer_zip_code_prefix\nu1,c1,?,SP,x,01310\n")
    row = read_source_csv(spark, "customers", c).first()
    assert tuple(row) == ("c1", "u1", "01310", "x", "SP")
    p = _write(root + "/p.csv", "product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm\np1,toys,1,2,3,4,5,6,7\n")
    assert tuple(read_source_csv(spark, "products", p).first())[2:4] == (1, 2)
    for header in ("customer_id,customer_city\n", "customer_id,customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"):
        bad = _write(new_scratch_dir(spark, "csv") + "/bad.csv", header)
        with pytest.raises(ValueError, match="customers"):
            read_source_csv(spark, "customers", bad)


def test_bad_rows_are_counted(spark):
    from pyspark.sql import Observation

    root = new_scratch_dir(spark, "csv")
    i = _write(root + "/i.csv", "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
               "o1,1,p,s,2018-01-01 00:00:00,0.10,0.20\no2,two,p,s,2018-01-01 00:00:00,0.10,0.20\no3,3,p,s,soon,x,0.20\n")
    seen = Observation("items")
    df = ingest(spark, "order_items", i, root + "/ods", observation=seen)
    assert seen.get == {"rows": 3, "bad_rows": 2} and df.count() == 3 and "_corrupt_record" not in df.columns
    assert "etl_timestamp" in ingest(spark, "order_items", i, infer_schema=True).columns


def test_hot_day_is_split_and_small_days_stay_whole(spark):
    from pyspark.sql import functions as F

    path = new_scratch_dir(spark, "layer")
    day = F.when(F.col("id") % 10 < 8, F.lit(0)).otherwise((F.col("id") % 40).cast("int"))
    df = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("x"), F.date_add(F.lit(dt.date(2020, 1, 1)), day).alias("d"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_layer(df, path, partition_by="d")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes") if old is None else spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = {}
    for r in read_layer(spark, path).select("d", F.input_file_name().alias("f")).distinct().collect():
        files[r["d"]] = files.get(r["d"], 0) + 1
    assert files[dt.date(2020, 1, 1)] >= 3
    # days that share the hot day's shuffle partition are cut with it, others are whole
    small = [n for d, n in files.items() if d != dt.date(2020, 1, 1)]
    assert sum(n <= 2 for n in small) >= len(small) / 2


def test_scratch_folder_rules(spark):
    from martlake.session import drop_scratch, scratch_root, write_scratch_table

    before = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == before.rstrip("/") and spark.conf.get("spark.checkpoint.dir") == before
    path = new_scratch_dir(spark, "gone")
    spark.range(3).write.parquet(path)
    assert drop_scratch(spark, path) and not drop_scratch(spark, path)
    with pytest.raises(ValueError):
        drop_scratch(spark, "/tmp/elsewhere")

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        folder = None

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return self.folder

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session())
    Context.folder = "hdfs://x/y/"
    assert scratch_root(Session()) == "hdfs://x/y"
    assert write_scratch_table is not None


def test_partitioned_layer_prunes_dates(spark):
    path = new_scratch_dir(spark, "layer")
    df = spark.createDataFrame(
        [(1, dt.date(2020, 1, 1)), (2, dt.date(2020, 1, 2)), (3, dt.date(2020, 1, 2))],
        "id int, d date",
    )
    write_layer(df, path, partition_by="d")
    back = read_layer(spark, path)
    assert dict(back.dtypes)["d"] == "date"
    q = back.filter(back.d == dt.date(2020, 1, 2))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan and "= 2020-01-02" in plan
    assert sorted(r.id for r in q.collect()) == [2, 3]
    # dynamic overwrite replaces only the days present in the new frame
    write_layer(
        spark.createDataFrame([(9, dt.date(2020, 1, 2))], "id int, d date"),
        path,
        partition_by="d",
        dynamic_overwrite=True,
    )
    assert sorted(r.id for r in read_layer(spark, path).collect()) == [1, 9]


def test_jdbc_write_options():
    o = jdbc_write_options("jdbc:x://h/db", "t", properties={"user": "u"}, num_partitions=4)
    assert o == {
        "url": "jdbc:x://h/db",
        "dbtable": "t",
        "batchsize": "1000",
        "truncate": "true",
        "numPartitions": "4",
        "user": "u",
    }


def test_ingest_all_counts_rows_while_writing(spark):
    from martlake.plans.warehouse import write_source_csv
    from martlake.schemas import SOURCE_FILES
    from martlake.sources.files import ingest_all
    from martlake.sources.fixtures import BUILDERS
    from tests.conftest import SF001

    root = new_scratch_dir(spark, "ingest_all")
    expected = {}
    for table, name in SOURCE_FILES.items():
        df = BUILDERS[table](spark, SF001)
        expected[table] = df.count()
        write_source_csv(df, f"{root}/raw/{name}")
    counts = ingest_all(spark, f"{root}/raw", f"{root}/ods")
    assert counts == expected
    assert read_layer(spark, f"{root}/ods/orders").count() == expected["orders"]


def test_quarantine_tells_the_failing_columns_and_keeps_the_text(spark):
    from martlake.sources.quarantine import WHOLE_ROW, quarantine

    root = new_scratch_dir(spark, "csv")
    lines = [
        "price,order_id,order_item_id,product_id,seller_id,shipping_limit_date,freight_value",
        "0.10,o1,1,p,s,2018-01-01 00:00:00,0.20", 'x,"o,2",two,p,s,2018-01-01 00:00:00,0.20',
        "0.10,o3,3,p,s,soon,", "0.10,o4,4,p,s,2018-01-01 00:00:00,0.20,more", "0.10,o5", ",,,,,,",
    ]
    good, bad = quarantine(spark, "order_items", _write(root + "/i.csv", "\n".join(lines) + "\n"), root + "/out")
    assert good.columns == SOURCE_SCHEMAS["order_items"].fieldNames()
    assert sorted(r["order_id"] or "" for r in good.collect()) == ["", "o1"]
    rejects = {r["order_id"]: (r["failed"], r["raw"]) for r in bad.collect()}
    assert rejects["o,2"] == (["order_item_id", "price"], lines[2])
    assert rejects["o3"] == (["shipping_limit_date"], lines[3])
    assert rejects["o4"] == ([WHOLE_ROW], lines[4]) and rejects["o5"] == ([WHOLE_ROW], lines[5])
    assert good.count() + bad.count() == len(lines) - 1


def _review_file(path, n, end="\n"):
    """Reviews whose messages hold line breaks, quotes, commas and blank lines."""
    head = "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp"
    rows = [head]
    for i in range(n):
        text = ["plain", '"two\nlines"', '"a ""quoted"" one,\n\n\nwith ""\n"" breaks"', '"' + "long\n" * (i % 40) + '"', ""][i % 5]
        rows.append(f"r{i},o{i},{i % 6 or 'x'},{'t' if i % 3 else ''},{text},2018-01-01 10:00:00,2018-01-02 11:00:0{i % 10}")
        if i % 50 == 0:
            rows.append("")
    return _write(path, end.join(r.replace("\n", end) for r in rows) + (end if n % 2 else ""))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("block", [64, 700, 1 << 20])
def test_records_with_line_breaks_are_read_by_blocks(spark, end, block):
    from martlake.sources.records import read_records_csv

    root = new_scratch_dir(spark, "csv")
    for k, n in enumerate((301, 40, 0)):
        _review_file(f"{root}/reviews/{k}.csv", n, end)
    want = sorted(map(tuple, read_source_csv(spark, "reviews", root + "/reviews").collect()), key=repr)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = read_records_csv(spark, "reviews", root + "/reviews")
        got = sorted(map(tuple, df.collect()), key=repr)
        if block < 1000:
            from martlake.sources.records import _lines

            assert _lines(spark, root + "/reviews").rdd.getNumPartitions() > 10
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(want) == 341 and got == want


def test_files_with_another_header_are_an_error(spark):
    from martlake.sources.records import read_records_csv

    root = new_scratch_dir(spark, "csv")
    _review_file(f"{root}/r/0.csv", 5)
    other = "order_id,review_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"
    _write(f"{root}/r/1.csv", other + "o,r,1,,,2018-01-01 10:00:00,2018-01-01 10:00:00\n")
    with pytest.raises(Exception, match="another header"):
        read_records_csv(spark, "reviews", f"{root}/r").collect()
