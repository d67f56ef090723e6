import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfsight.sources import readers, sinks

D = dt.date


def test_csv_is_read_as_text_and_coerced(spark, tmp_path):
    (tmp_path / "lines.csv").write_text(
        "posting_date,revenue,note\n2025-01-02,5.50,a\n2025-13-40,n/a,b\nsoon,,c\n"
    )
    schema = T.StructType([
        T.StructField("posting_date", T.DateType()),
        T.StructField("revenue", T.DecimalType(18, 2)),
        T.StructField("note", T.StringType()),
        T.StructField("units", T.DoubleType()),
    ])
    df = readers.csv_coerced_scan(spark, str(tmp_path), schema, fill={"revenue": 0})
    rows = [(r.posting_date, float(r.revenue), r.note, r.units) for r in df.orderBy("note").collect()]
    assert rows == [(D(2025, 1, 2), 5.5, "a", None), (None, 0.0, "b", None), (None, 0.0, "c", None)]


def test_month_files_in_one_read(spark, tmp_path):
    for name, n in (("may", 1), ("october", 2)):
        (tmp_path / f"fva_{name}_2025.csv").write_text(f"item,qty\nx,{n}\n")
    schema = T.StructType([T.StructField("item", T.StringType()), T.StructField("qty", T.DoubleType())])
    df = readers.scan_month_files(spark, f"{tmp_path}/fva_*_2025.csv", schema, r"fva_([a-z]+)_(\d{4})")
    assert sorted(tuple(r) for r in df.collect()) == [
        (D(2025, 5, 1), "x", 1.0), (D(2025, 10, 1), "x", 2.0)
    ]


def test_month_files_are_matched_by_name(spark, tmp_path):
    (tmp_path / "fva_may_2025.csv").write_text("item,description,qty\nx,long,1\n")
    (tmp_path / "fva_june_2025.csv").write_text("description,more,item,qty\nB,z,y,2\n")
    (tmp_path / "fva_july_2025.csv").write_text("qty,item\n3,w\n")
    schema = T.StructType.fromDDL("item string, description string, qty double")
    df = readers.scan_month_files(spark, f"{tmp_path}/fva_*_2025.csv", schema, r"fva_([a-z]+)_(\d{4})")
    assert sorted(tuple(r) for r in df.collect()) == [
        (D(2025, 5, 1), "x", "long", 1.0), (D(2025, 6, 1), "y", "B", 2.0), (D(2025, 7, 1), "w", None, 3.0)
    ]


def test_coerced_files_are_matched_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("day,n\n2025-01-02,1\n")
    (tmp_path / "b.csv").write_text("n,day\n2,03/02/2025\nx,soon\n")
    schema = T.StructType.fromDDL("day date, n long")
    forms = ("yyyy-MM-dd", "dd/MM/yyyy")
    df = readers.csv_coerced_scan(spark, str(tmp_path), schema, date_formats=forms)
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(
        map(str, [(D(2025, 1, 2), 1), (D(2025, 2, 3), 2), (None, None)])
    )
    text = spark.createDataFrame([("soon", "1"), (" ", "x"), (None, None)], "day string, n string")
    assert readers.rejected_cells(text, schema, forms).first().asDict() == {"day": 1, "n": 1}


def test_unsplit_jdbc_reads_are_refused(spark):
    with pytest.raises(ValueError, match="numPartitions"):
        readers.load_transactions(spark, jdbc={"url": "jdbc:x", "dbtable": "t"})


def test_inventory_document_with_month_names(spark, tmp_path):
    product = {"sku": "s", "productName": "n", "qtyAvailable": 3, "atRisk": True}
    document = {"months": {"October": {"products": [product, {"sku": "t", "productName": "m"}]},
                           "2024-02": {"products": [product]}, "Later": {"products": [product]}}}
    (tmp_path / "inv.json").write_text(json.dumps(document, indent=1))
    rows = readers.read_inventory_documents(
        spark, str(tmp_path / "inv.json"), year=2025, multi_line=True
    ).collect()
    got = {(r.month, r.sku): (r.qty_available, r.at_risk, r.weeks_of_supply) for r in rows}
    assert got == {
        (D(2025, 10, 1), "s"): (3, True, None), (D(2025, 10, 1), "t"): (0, False, None),
        (D(2024, 2, 1), "s"): (3, True, None), (None, "s"): (3, True, None),
    }


def test_csv_sink_is_sorted_with_headers(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_csv(spark.range(100).select(F.col("id"), (-F.col("id")).alias("neg")), path, ["neg"])
    back = spark.read.csv(path, header=True, schema="id long, neg long")
    assert back.count() == 100
    parts = sorted(p for p in (tmp_path / "out").iterdir() if p.suffix == ".csv")
    ids = [int(line.split(",")[0]) for p in parts for line in p.read_text().splitlines()[1:]]
    assert ids == list(range(99, -1, -1))


def test_document_sink_keeps_nulls(spark, tmp_path):
    df = spark.sql("SELECT 'May' AS month, array(struct('x' AS item, CAST(NULL AS INT) AS qty)) AS products")
    sinks.write_documents(df, str(tmp_path / "docs"))
    text = "".join(p.read_text() for p in (tmp_path / "docs").glob("*.json"))
    assert json.loads(text) == {"month": "May", "products": [{"item": "x", "qty": None}]}


def test_month_overwrite_touches_only_its_months(spark, tmp_path):
    path = str(tmp_path / "table")
    frame = lambda rows: spark.createDataFrame(rows, "month date, v int")
    sinks.overwrite_months(frame([(D(2025, 1, 1), 1), (D(2025, 2, 1), 2)]), path)
    for _ in range(2):
        sinks.overwrite_months(frame([(D(2025, 2, 1), 20), (D(2025, 3, 1), 30)]), path)
    assert {(r.month, r.v) for r in spark.read.parquet(path).collect()} == {
        (D(2025, 1, 1), 1), (D(2025, 2, 1), 20), (D(2025, 3, 1), 30)
    }


def test_transactions_loader(spark, tmp_path, sf_dir):
    from shelfsight.plans.inputs import transactions

    path = str(tmp_path / "tx")
    transactions(spark, sf_dir).write.parquet(path)
    df = readers.load_transactions(spark, path)
    assert df.count() == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    with pytest.raises(ValueError):
        readers.load_transactions(spark)


def test_dictionary_lists_described_columns(spark):
    df = sinks.describe_columns(spark.range(1).withColumn("b", F.lit(1)), {"b": "second"})
    assert [tuple(r) for r in sinks.output_dictionary(df).collect()] == [("b", "second")]
    with pytest.raises(ValueError):
        sinks.describe_columns(df, {"missing": "x"})


def one_document(months):
    return {"made": "x [{ y", "months": {
        key: {"products": [{"sku": f"{key}-{i}", "productName": f'n{i} {{"sku": }} "[{{', "qtyAvailable": i,
                            "atRisk": i % 2 == 0, "velocityMonthly": None} for i in range(n)]}
        for key, n in months.items()}}


@pytest.mark.parametrize("layout", [{}, {"indent": 2}, {"separators": (",", ":")}])
def test_one_document_is_read_by_many_tasks(spark, tmp_path, layout):
    months = {f"2024-{m:02d}": 40 * (m % 4) for m in range(2, 13)} | {"Later": 3}
    document = one_document(months)
    path = tmp_path / "all.json"
    path.write_text(json.dumps(document, **layout))
    whole = readers.inventory_explode(
        spark.createDataFrame([(json.dumps(document),)], "text string"), text="text"
    )
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "4000b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        read = readers.read_inventory_documents(spark, str(path), multi_line=True)
        records = spark.read.text(str(path), lineSep=readers._object_start(spark, str(path)))
        assert records.rdd.getNumPartitions() > 4
        got = sorted(map(str, read.collect()))
    finally:
        spark.conf.set(size, before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == sorted(map(str, whole.collect())) and len(got) == sum(months.values())


def test_documents_without_products(spark, tmp_path):
    for name, document in (("a", {"months": {}}), ("b", {"months": {"May": {"products": []}}})):
        (tmp_path / f"{name}.json").write_text(json.dumps(document))
    assert readers.read_inventory_documents(spark, str(tmp_path), 2025, multi_line=True).collect() == []


def test_headers_of_many_files_cost_the_jobs_of_few(spark, tmp_path):
    def jobs(n):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            (folder / f"f{i}.csv").write_text("a,b\n1,2\n" if i % 2 else 'b,"a ""q"", x",a\n2,9,1\n')
        group = f"headers-{n}"
        spark.sparkContext.setJobGroup(group, group)
        df = readers._read_csv_by_name(spark, str(folder), ["a", "b"])
        seen = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert {tuple(r) for r in df.collect()} == {("1", "2")} and df.count() == n
        return seen

    # one query with two shuffles, each of which adaptive execution starts as a job
    assert jobs(50) == jobs(3) <= 3


def test_headers_with_quotes_gaps_and_empty_names(spark, tmp_path):
    (tmp_path / "x.csv").write_text('"a ""b"", c",,plain,\n1,2,3,4\n')
    (tmp_path / "y.csv").write_text("﻿plain\n7\n")
    (tmp_path / "empty.csv").write_text("")
    rows = readers.csv_headers(spark, str(tmp_path)).collect()
    assert {r.file.rsplit("/")[-1]: r.header for r in rows} == {
        "x.csv": ['a "b", c', "", "plain", ""], "y.csv": ["plain"]
    }
    df = readers._read_csv_by_name(spark, str(tmp_path), ["plain", 'a "b", c', "none"])
    assert sorted(map(str, map(tuple, df.collect()))) == ["('3', '1', None)", "('7', None, None)"]


def test_positions_follow_the_part_files(spark, tmp_path):
    from shelfsight.sources.ordered import read_csv_in_order

    path = str(tmp_path / "sorted")
    values = spark.range(2000).select((F.col("id") * 7919 % 2003).alias("v")).repartition(6)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        sinks.write_csv(values, path, [F.col("v").desc()])
    finally:
        spark.conf.unset(coalesce)
    assert len(list((tmp_path / "sorted").glob("*.csv"))) > 1
    schema = T.StructType.fromDDL("v long")
    back = read_csv_in_order(spark, path, schema).orderBy("position").collect()
    assert [r.position for r in back] == list(range(1, 2001))
    assert [r.v for r in back] == sorted((r.v for r in back), reverse=True)
