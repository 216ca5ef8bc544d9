import csv
import random
from collections import Counter

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tradewind.plans.normalize import normalize, normalize_joined, normalize_table
from tradewind.plans.profile import profile_layer, row_counts, sample_rows, schema_rows
from tradewind.sources.layers import LayerPaths, fingerprint, location, publish, published, read_layer, read_table, register_layer
from tradewind.sources.rawcsv import read_split_csv, read_wide_csv, split_records, stage_wide_csv
from tradewind.sources.reportfiles import read_report, write_report
from tradewind.sources.schema import conform, typed_numbers

CSV = (
    "order_id,review_comment_message,price,order_purchase_timestamp\n"
    'o1,"two\nlines",1.5,10/2/2017 10:56\n'
    'o2,"says ""hi"", twice",,10/02/2017 1:05\n'
    'o2,"says ""hi"", twice",,10/02/2017 1:05\n'
)


@pytest.fixture()
def export(tmp_path):
    path = tmp_path / "export.csv"
    path.write_text(CSV)
    return str(path)


def test_wide_csv_is_text(spark, export):
    df = read_wide_csv(spark, export)
    assert {t for _, t in df.dtypes} == {"string"}
    assert df.collect()[0].review_comment_message == "two\nlines"
    assert df.collect()[1].review_comment_message == 'says "hi", twice' and df.collect()[1].price is None
    schema = StructType([StructField(c, StringType()) for c in df.columns])
    assert read_wide_csv(spark, export, schema).collect() == df.collect()


def test_stage_and_normalize(spark, export, tmp_path):
    tables = normalize(stage_wide_csv(spark, export, str(tmp_path / "staged")))
    # Tables without any of their columns are skipped; present columns only; rows distinct.
    assert set(tables) == {"orders", "order_items", "order_payments", "order_reviews"}
    assert tables["orders"].columns == ["order_id", "order_purchase_timestamp"]
    assert tables["orders"].count() == 2 and tables["order_payments"].columns == ["order_id"]
    assert dict(tables["orders"].dtypes)["order_purchase_timestamp"] == "timestamp"


def test_missing_table_is_none_and_other_errors_surface(spark, tmp_path):
    assert read_table(spark, str(tmp_path), "absent") is None
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_table(spark, str(tmp_path), "broken")
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        read_table(spark, str(tmp_path), "empty")


def test_layer_round_trip_and_catalog(spark, tmp_path):
    base = str(tmp_path / "layer")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    publish(df, base, "t")
    publish(df.where("id = 1"), base, "t")
    assert read_layer(spark, base, ["t", "absent"])["t"].count() == 1
    assert register_layer(spark, base, ["t", "absent"]) == ["t"]
    assert spark.sql("SELECT v FROM t").first().v == "a"
    for _ in range(2):
        assert register_layer(spark, base, ["t"], database="shop_test") == ["`shop_test`.`t`"]
    assert spark.sql("SELECT v FROM shop_test.t").first().v == "a"
    spark.sql("DROP DATABASE shop_test CASCADE")
    assert read_table(spark, base, "t").count() == 1


def test_layer_is_snappy_with_microseconds(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    publish(spark.sql("SELECT timestamp'2018-01-01 00:00:00.123456' AS t"), str(tmp_path), "t")
    meta = pq.ParquetFile(glob.glob(f"{tmp_path}/t/*/*.parquet")[0])
    assert meta.metadata.row_group(0).column(0).compression == "SNAPPY"
    assert meta.schema_arrow.field("t").type.unit == "us"


def test_shuffles_are_sized_by_the_files(spark, tmp_path, monkeypatch):
    from tradewind import session

    before = spark.conf.get("spark.sql.shuffle.partitions")
    for name in ("a", "b"):
        publish(spark.range(1000).repartition(1), str(tmp_path), name)
    with session.sized_shuffles(spark, str(tmp_path)):
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
    monkeypatch.setattr(session, "PART_BYTES", 100)
    files = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    with pytest.raises(ZeroDivisionError), session.sized_shuffles(spark, str(tmp_path)):
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == -(-files // 100) > int(before)
        1 / 0
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_shuffle_sizes_from_a_gigabyte_to_a_hundred_terabytes():
    from tradewind.session import shuffle_parts

    assert [shuffle_parts(n) for n in (0, 1 << 30, 1 << 40, 100 << 40)] == [1, 16, 4096, 102_400]


def test_paths():
    paths = LayerPaths.under("/data/", "/in.csv")
    assert (paths.cleaned, paths.raw_csv, paths.database) == ("/data/cleaned", "/in.csv", None)
    text = '{"raw_csv":"r","staged":"s","normalized":"n","cleaned":"c","wrangled":"w","reports":"p","models":"m","other":1}'
    assert LayerPaths.from_json(text).wrangled == "w"


def test_reports_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([("a", 1), ("b", None)], "k string, n int")
    write_report(df, str(tmp_path), "r")
    assert rows(read_report(spark, str(tmp_path), "r")) == [("a", "1"), ("b", None)]


def test_types(spark):
    df = spark.createDataFrame([("o", "3.0", "0.85", "x")], "order_id string, order_item_id string, price string, freight_value string")
    assert tuple(typed_numbers(df, "order_items").first()) == ("o", 3, 0.85, None)
    assert conform(df, {"price": "double", "new": "int"}).dtypes == [("price", "double"), ("new", "int")]


def test_profiles(spark, tmp_path):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "id int, v string")
    assert [tuple(r) for r in row_counts({"t": df, "u": df.where("id = 1")}).collect()] == [("t", 3), ("u", 1)]
    assert [tuple(r) for r in schema_rows({"t": df}).collect()] == [("t", 1, "id", "int", 3), ("t", 2, "v", "string", 3)]
    assert [r.id for r in sample_rows(df, ["id"], 2).collect()] == [1, 2]
    publish(df, str(tmp_path), "t")
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("not parquet")
    got = {r.table_name: r for r in profile_layer(spark, str(tmp_path), ["t", "absent", "bad"]).collect()}
    assert tuple(got["t"])[1:] == ("ok", 3, 2, "struct<id:int,v:string>")
    assert got["absent"].status == "missing" and got["bad"].status.startswith("failed")


def test_files_with_different_headers_are_not_mixed(spark, tmp_path):
    (tmp_path / "a.csv").write_text("order_id,price\no1,5\n" * 1)
    (tmp_path / "b.csv").write_text("price,order_id\n7,o2\n")
    for multi_line in (True, False):
        with pytest.raises(Exception, match="(?i)header|schema"):
            read_wide_csv(spark, str(tmp_path), multi_line=multi_line).collect()
    (tmp_path / "b.csv").write_text("order_id,price\no2,7\n")
    assert sorted(r["order_id"] for r in read_wide_csv(spark, str(tmp_path)).collect()) == ["o1", "o2"]


def test_typed_nan_is_no_number(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "price double, order_item_id int")
    assert [r["price"] for r in typed_numbers(df, "order_items").orderBy("order_item_id").collect()] == [None, 2.0]


def test_small_amounts_are_not_rounded_away(spark):
    from tradewind.functions.numbers import money_sum

    df = spark.createDataFrame([(0.004,), (0.004,), (0.004,)], "v double")
    assert df.agg(money_sum(df["v"])).first()[0] == 0.012


FIELDS = ["plain", "", "two\nlines", 'says ""hi"', "a,b", "\n", "\n\n\n", "é🙂", " padded ", "x" * 90, '"', "line\n" * 12, "crlf\r\ninside", None]


def write_csv(path, rows, end):
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(["id", "a", "b", "c"])
        writer.writerows(rows)


@pytest.mark.parametrize("split_bytes", [40, 333, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_split_files_have_the_rows_of_whole_ones(spark, tmp_path, split_bytes, end):
    rng, n = random.Random(split_bytes), 30 if split_bytes < 100 else 150
    for name in ("a.csv", "b.csv"):
        write_csv(tmp_path / name, [[k, *rng.choices(FIELDS, k=3)] for k in range(n)], end)
    (tmp_path / "only_header.csv").write_text("id,a,b,c" + end)
    (tmp_path / "empty.csv").write_text("")
    with open(tmp_path / "a.csv", "a", newline="") as out:
        out.write(end + end + 'last,"no line end","",')  # empty lines, and no line end behind the last record
    whole = read_wide_csv(spark, str(tmp_path))
    split = read_split_csv(spark, str(tmp_path), split_bytes=split_bytes)
    assert split.dtypes == whole.dtypes
    assert Counter(map(tuple, split.collect())) == Counter(map(tuple, whole.collect())) and whole.count() == 2 * n + 1


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    rng = random.Random(1)
    write_csv(tmp_path / "one.csv", [[k, *rng.choices(FIELDS, k=3)] for k in range(4000)], "\n")
    path = str(tmp_path / "one.csv")
    assert read_wide_csv(spark, path).rdd.getNumPartitions() == 1
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    records = split_records(spark, path, 10_000)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert records.where("NOT first").count() == 4000 and records.where("first").count() == 1
    blocks = spark.read.parquet(max((str(p) for p in _stored_in(spark) if "record" in spark.read.parquet(str(p)).columns), key=lambda p: len(p)))
    assert blocks.select("block").distinct().count() > 10


def _stored_in(spark):
    from pathlib import Path

    from tradewind.session import shared_folder

    return sorted(Path(shared_folder(spark).removeprefix("file:")).glob("tradewind-*"), key=lambda p: p.stat().st_mtime)[-2:]


def test_a_field_longer_than_several_blocks_is_one_record(spark, tmp_path):
    text = "long line\n" * 400 + 'with ""quotes""\n' + "more\n" * 100
    (tmp_path / "x.csv").write_text(f'id,a\n1,"{text}"\n2,b\n3,"{text}"')
    expect = text.replace('""', '"')
    rows = {r["id"]: r["a"] for r in read_split_csv(spark, str(tmp_path / "x.csv"), split_bytes=100).collect()}
    assert rows == {"1": expect, "2": "b", "3": expect}


def test_split_files_with_other_headers_stop_the_job(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"order_id","two\nlines"\no1,5\n')
    (tmp_path / "b.csv").write_text('two,order_id\n7,o2\n')
    with pytest.raises(ValueError, match="header"):
        read_split_csv(spark, str(tmp_path), split_bytes=12)
    (tmp_path / "b.csv").write_text('ORDER_ID,"two\nlines"\no2,7\n')
    assert sorted(map(tuple, read_split_csv(spark, str(tmp_path), split_bytes=12).collect())) == [("o1", "5"), ("o2", "7")]


def failing(df):
    return df.withColumn("v", F.when(F.col("id") >= 90, F.raise_error(F.lit("killed midway"))).otherwise("new"))


def test_a_failed_job_leaves_the_old_version(spark, tmp_path):
    base = str(tmp_path / "layer")
    old = spark.range(10).withColumn("v", F.lit("old"))
    assert published(spark, base, "t") is None
    publish(old, base, "t", note="from x")
    first = published(spark, base, "t")
    assert first.note == "from x" and location(spark, base, "t") == first.path
    (name,) = register_layer(spark, base, ["t"], database="publish_test")
    with pytest.raises(Exception, match="killed midway"):
        publish(failing(spark.range(100).repartition(8)), base, "t")
    assert published(spark, base, "t") == first
    for table in (read_table(spark, base, "t"), spark.table(name)):
        assert table.count() == 10 and table.where("v = 'old'").count() == 10
    reader = read_table(spark, base, "t")
    publish(failing(spark.range(50)), base, "t")
    assert spark.table(name).count() == 10, "the catalog goes on with the old version until it is switched"
    assert register_layer(spark, base, ["t"], database="publish_test") == [name]
    assert spark.table(name).where("v = 'new'").count() == 50 == read_table(spark, base, "t").count()
    assert reader.count() == 10, "whoever reads the version before can go on"
    publish(spark.range(5).withColumn("other", F.lit(1)), base, "t")
    register_layer(spark, base, ["t"], database="publish_test")
    assert spark.table(name).columns == ["id", "other"] and spark.table(name).count() == 5
    folders = [p.name for p in (tmp_path / "layer" / "t").iterdir()]
    assert len(folders) == 2 and published(spark, base, "t").version in folders
    spark.sql("DROP DATABASE publish_test CASCADE")


def test_fingerprint_follows_the_files(spark, tmp_path):
    base = str(tmp_path)
    assert fingerprint(spark, base, "t") is None
    publish(spark.range(10), base, "t")
    first = fingerprint(spark, base, "t")
    assert first == fingerprint(spark, base, "t")
    publish(spark.range(10), base, "t")
    assert fingerprint(spark, base, "t") not in (None, first)


def test_scratch_is_removed(spark, tmp_path):
    from tradewind.session import scratch, shared_folder, stored

    before = shared_folder(spark)
    with pytest.raises(ZeroDivisionError), scratch(spark, str(tmp_path)) as folder:
        assert shared_folder(spark) == folder and stored(spark.range(7)).count() == 7
        assert list(tmp_path.rglob("*.parquet"))
        1 / 0
    assert shared_folder(spark) == before and not list(tmp_path.rglob("*.parquet"))


def test_counts_while_writing(spark, tmp_path):
    from tradewind.plans.profile import count_rows, counted
    from tradewind.session import observing_session, with_settings_of

    own = with_settings_of(spark, observing_session(spark))
    assert own.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    df = own.createDataFrame([(k % 7, k) for k in range(50)], "k int, v int")

    def change(rows):
        assert rows.count() == 50  # a look at the input beforehand
        return rows.where("v > 4").dropDuplicates(["k"])

    changed, counts = counted("t", df, change)
    publish(changed, str(tmp_path), "t")
    assert [tuple(r) for r in count_rows(spark, [counts()]).collect()] == [("t", 50, 43, 7)]


def test_joined_tables_are_normalized_before_their_rows_are_multiplied(spark, rows):
    people = spark.createDataFrame([(i, None if i == 0 else i % 3) for i in range(60)], "id int, zip int")
    geo = spark.createDataFrame([(i % 2, float(i % 4), None if i == 3 else "c") for i in range(40)], "geo_zip int, lat double, city string")
    wide = people.join(geo, people["zip"] == geo["geo_zip"], "left")
    for columns in (["geo_zip", "lat", "city"], ["zip", "city"], ["lat", "absent"]):
        got = normalize_joined(people, geo, "zip", "geo_zip", columns)
        assert rows(got) == rows(normalize_table(wide, columns)) and len(got.columns) == len(set(columns) - {"absent"})
    plan = normalize_joined(people, geo, "zip", "geo_zip", ["geo_zip", "lat"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 3  # one on each side and one on the joined rows


def test_blocks_grow_with_the_text(spark, tmp_path, monkeypatch, rows):
    from tradewind_queries import queries as q

    texts = [(i, f'a "{i}"\n' + "x y\n" * (i % 7 * 2_000), "en", "s", 5) for i in range(60)]
    spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    sizes, read = [], q.read_split_csv
    monkeypatch.setattr(q, "read_split_csv", lambda s, folder, split_bytes: sizes.append(split_bytes) or read(s, folder, split_bytes=split_bytes))
    assert rows(q.wide_csv_split(spark, str(tmp_path))) == rows(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    monkeypatch.setattr(q, "MOST_BLOCKS", 3)
    assert rows(q.wide_csv_split(spark, str(tmp_path))) == rows(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    assert sizes[0] == 100_000 and sizes[1] > 400_000  # three blocks for 1.4 MB of text
