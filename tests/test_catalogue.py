from __future__ import annotations

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from lumenloom.operators import quality
from lumenloom.plans import medallion as m
from lumenloom.sinks import line_files, tables
from lumenloom.sources import files
from lumenloom.sources import products as src

STYLES = '''id,gender,masterCategory,subCategory,articleType,baseColour,season,year,usage,productDisplayName
1,Men,Apparel,Topwear,Shirts,Navy,Fall,2011,Casual,Good row
2,Men,Apparel,Topwear,Shirts,Navy,Fall,2011,Casual,One,too many
3,Men,Apparel,Topwear,Shirts,Navy,Fall,2011,Casual,Trailing,
4,Men,Apparel
5,Men,Apparel,Topwear,Shirts,Navy,Fall,2011,Casual,"Quoted, comma ""and quotes"""
6, men ,apparel,Topwear,Shirts,Navy,Fall,NA,NA,Missing words
7,Men,Apparel,Topwear,Shirts,Navy,Fall,2011,Casual,Two,,many
8,Men,Apparel,Topwear,Shirts,Navy,Fall,2012.0,null,n/a
9,Men,Apparel,Topwear,Shirts,Navy,Fall,oops,Casual,
'''


@pytest.fixture
def styles(spark, tmp_path):
    path = tmp_path / "styles.csv"
    path.write_text(STYLES)
    return src.read_products_csv(spark, str(path))


def test_csv_skips_long_rows_and_pads_short_ones(styles):
    got = {r.id: r for r in styles.collect()}
    assert sorted(got) == [1, 4, 5, 6, 8, 9]
    assert got[4].masterCategory == "Apparel" and got[4].productDisplayName is None
    assert got[5].productDisplayName == 'Quoted, comma "and quotes"'


def test_csv_na_words_and_numbers(styles):
    got = {r.id: r for r in styles.collect()}
    assert got[6].usage is None and got[6].year is None and got[6].gender == " men "
    assert got[8].year == 2012 and got[8].usage is None and got[8].productDisplayName is None
    assert got[9].year is None and got[9].usage == "Casual"


def test_csv_result_does_not_depend_on_the_columns_read(styles):
    assert styles.select("id").count() == 6
    assert styles.count() == 6


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    first = {r.id for r in src.sample_products(df, 10, 42).collect()}
    again = {r.id for r in src.sample_products(df.repartition(7), 10, 42).collect()}
    other = {r.id for r in src.sample_products(df, 10, 43).collect()}
    assert len(first) == 10 and first == again and first != other
    assert src.keep_assets(df, src.sample_products(df, 10, 42)).count() == 10


def bronze(spark, records):
    names = list(m.BRONZE_NAMES.values())
    schema = ", ".join(
        f"{n} {'int' if n in ('ID', 'YEAR', 'FILE_SIZE_BYTES') else 'string' if i < 10 else 'double'}"
        for i, n in enumerate(names)
    )
    defaults = dict.fromkeys(names)
    return spark.createDataFrame([tuple({**defaults, **r}.values()) for r in records], schema)


def test_multicolor_flag_at_the_edge(spark):
    stds = [(45.0, 45.0, 45.0), (45.0, 45.0, 45.1), (None, 90.0, 90.0)]
    raw = bronze(spark, [{"ID": i, "STD_R": a, "STD_G": b, "STD_B": c} for i, (a, b, c) in enumerate(stds)])
    got = {r.id: r.is_multicolored for r in m.clean_products(raw).collect()}
    assert got == {0: False, 1: True, 2: False}


def test_labels_are_trimmed_of_blanks_and_upper_cased(spark):
    raw = bronze(spark, [{"ID": 1, "GENDER": "  men ", "USAGE": "\tx ", "PRODUCT_DISPLAY_NAME": " a B "}])
    row = m.clean_products(raw).first()
    assert (row.gender, row.usage, row.product_display_name) == ("MEN", "\tX", "a B")


def test_rare_and_missing_classes_leave_the_training_set(spark):
    records = [{"ID": i, "MASTER_CATEGORY": "ten"} for i in range(10)]
    records += [{"ID": 100 + i, "MASTER_CATEGORY": "nine"} for i in range(9)]
    records += [{"ID": 200 + i} for i in range(20)]
    dim = m.product_dim(m.clean_products(bronze(spark, records)))
    ml = m.ml_dataset(dim)
    assert {r.target_categoria_principal for r in ml.collect()} == {"TEN"}
    assert [tuple(r) for r in m.class_counts(ml).collect()] == [("TEN", 10)]


def test_rows_without_id_are_no_products(spark):
    dim = m.product_dim(m.clean_products(bronze(spark, [{"ID": None}, {"ID": 3}])))
    assert [r.produto_id for r in dim.collect()] == [3]


def test_rounding_is_decimal(spark):
    got = spark.range(1).select(
        m.round_decimal(F.lit(0.285), 2).alias("a"), m.scaled(F.lit(127.5)).alias("b")
    ).first()
    assert (got.a, got.b) == (0.29, 0.5)


def test_report_keeps_null_groups(spark):
    raw = bronze(spark, [{"ID": 1, "MEAN_R": 10.0}, {"ID": 2, "MEAN_R": 20.0}])
    row = m.color_metrics(m.product_dim(m.clean_products(raw))).first()
    assert row.categoria_principal is None and row.total_produtos == 2 and row.avg_vermelho == 15.0
    assert row.pct_multicolorido == 0.0


def test_checks_find_planted_failures(spark):
    good = bronze(spark, [{"ID": i, "MASTER_CATEGORY": "c", "GENDER": "g"} for i in range(12)])
    bad = good.unionByName(bronze(spark, [{"ID": 3, "MASTER_CATEGORY": "c"}, {"ID": None}]))

    def failures(raw):
        silver = m.clean_products(raw)
        dim = m.product_dim(silver)
        found = {
            "stg_products": silver,
            "dim_produtos_analytics": dim,
            "fct_preparacao_ml": m.ml_dataset(dim),
            "fct_metricas_cores_bi": m.color_metrics(dim),
        }
        out = quality.run_checks(found)
        return found, {(r.table_name, r.column_name, r.check_name): r.failures for r in out.collect()}

    found, got = failures(good)
    assert len(got) == 12 and not any(got.values())
    quality.require_checks(found)
    found, got = failures(bad)
    assert got["stg_products", "id", "unique"] == 1
    assert got["stg_products", "id", "not_null"] == 1
    assert got["stg_products", "master_category", "not_null"] == 1
    assert got["dim_produtos_analytics", "genero", "not_null"] == 1
    with pytest.raises(AssertionError, match="stg_products.id unique: 1"):
        quality.require_checks(found)


def test_column_statistics_report_unknown_columns(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("bbb", 2)], "s string, n int")
    got = {r.column_name: r for r in quality.column_stats(df, ["s", "n", "x"]).collect()}
    assert (got["s"].rows, got["s"].nulls, got["s"].min, got["s"].max, got["s"].avg_length) == (3, 1, "a", "bbb", 2.0)
    assert got["n"].approx_distinct == 2 and got["x"].error == "column not found"


def test_reload_replaces_and_a_failed_load_keeps_the_old_rows(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS reload")
    tables.load_raw(spark.range(5), "reload.t")
    assert tables.load_raw(spark.range(3), "reload.t").count() == 3
    # an error while writing
    broken = spark.range(3).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="boom"):
        tables.load_raw(broken, "reload.t")
    assert spark.table("reload.t").count() == 3


def test_snapshot_manifest_describes_the_files(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    manifest = tables.export_snapshot(df, str(tmp_path / "snap")).collect()
    assert [r.item_count for r in manifest if r.file == "*"] == [2]
    assert all(len(r.md5) == 32 and r.bytes > 0 for r in manifest if r.file != "*")
    lines = {r.value for r in spark.read.text(str(tmp_path / "snap" / "data")).collect()}
    assert lines == {'{"Item":{"k":1}}', '{"Item":{"k":2,"v":"x"}}'}


def test_scan_csv_headers(spark, tmp_path, rows):
    path = tmp_path / "p.csv"
    path.write_text("name,age,city\nAlice,30,NYC\nBob,,LA\n")
    used = files.scan_csv(spark, str(path), "USE")
    assert used.columns == ["name", "age", "city"]
    assert rows(used.where("age IS NULL"), "name") == [("Bob",)]
    assert files.scan_csv(spark, str(path), "NONE").count() == 3
    ignored = files.scan_csv(spark, str(path), "IGNORE")
    assert ignored.columns == ["_1", "_2", "_3"] and ignored.count() == 2
    with pytest.raises(ValueError):
        files.scan_csv(spark, str(path), "MAYBE")


def test_scan_json_layouts(spark, tmp_path, rows):
    lines = tmp_path / "a.jsonl"
    lines.write_text('{"n": 1, "s": "x"}\n{broken\n{"n": 2}\n')
    assert rows(files.scan_json(spark, str(lines), "n int, s string")) == [(1, "x"), (2, None)]
    assert files.scan_json(spark, str(lines)).count() == 2
    array = tmp_path / "b.json"
    array.write_text('[{"n": 1},\n {"n": 2}]')
    assert rows(files.scan_json(spark, str(array), "n int", document=True)) == [(1,), (2,)]
    got = files.scan_json(spark, str(array), document=True)
    assert rows(got.select(F.try_variant_get("row", "$.n", "int"))) == [(1,), (2,)]


def test_explode_items_of_objects(spark, rows):
    df = spark.createDataFrame([('{"a":{"z":1,"b":[2]}}',), ('{"a":5}',), (None,)], "j string")
    got = files.explode_items(df, "j", "/a")
    assert rows(got.select("index", "key", F.to_json("value"))) == [(0, "b", "[2]"), (1, "z", "1")]


def test_lines_quote_and_keep_nulls(spark):
    df = spark.createDataFrame([('a,"b"', None, "x\ny")], "p string, q string, r string")
    assert tables.to_lines(df, "csv").first().line == '"a,""b""",,"x\ny"'
    assert tables.to_lines(df, "json").first().line == '{"p":"a,\\"b\\"","q":null,"r":"x\\ny"}'


def test_catalogue_formats():
    assert files.format_of("x.ParquetHiveSerDe") == "parquet"
    assert files.format_of("org.openx.JsonSerDe", "TextInputFormat") == "json"
    assert files.format_of(None, "org.apache.hadoop.hive.ql.X") == "json"
    assert files.format_of("org.apache.hadoop.hive.serde2.OpenCSVSerde", "TextInputFormat") == "csv"
    assert files.format_of(None) == "csv"


def test_files_are_what_their_writers_tell(spark, tmp_path):
    """Several folders and full files in gzip: bytes and hashes of the manifest are those of the files."""
    rows_ = [(f"g={i % 3}", f"line {i} é") for i in range(3000)] + [("g=9", None)]
    df = spark.createDataFrame(rows_, "folder string, value string").repartition(4, "folder").sortWithinPartitions("folder")
    path, manifest = str(tmp_path / "out"), str(tmp_path / "told")
    for _ in range(2):  # the second run replaces the first
        line_files.write_lines(df, path, ".gz", zipped=True, most_records=400, most_bytes=5000, manifest=manifest)
    told = {r.file: r for r in spark.read.json(manifest).collect()}
    found = {str(p.relative_to(path)): p.read_bytes() for p in (tmp_path / "out").rglob("*.gz")}
    assert told.keys() == found.keys() and len(told) > 3 * 1000 * 12 // 5000
    for name, data in found.items():
        raw = gzip.decompress(data)
        t = told[name]
        assert (t.bytes, t.md5) == (len(data), hashlib.md5(data).hexdigest())
        assert (t.raw_bytes, t.raw_md5, t.items) == (len(raw), hashlib.md5(raw).hexdigest(), raw.count(b"\n"))
        assert t.items <= 400 and t.raw_bytes <= 5000 + 20
    assert sorted((r.g, r.value) for r in spark.read.text(path).collect()) == sorted((int(f[2:]), v or "") for f, v in rows_)


def test_failed_writes_leave_nothing(spark, tmp_path):
    bad = spark.range(2000).select(F.lit("f").alias("folder"), F.when(F.col("id") < 1999, F.col("id").cast("string")).otherwise(F.raise_error(F.lit("stop"))).alias("value"))
    with pytest.raises(Exception, match="stop"):
        line_files.write_lines(bad.repartition(3), str(tmp_path / "out"), most_records=100)
    assert not [p for p in (tmp_path / "out").rglob("*.txt")]


def test_sample_by_histogram_is_the_lowest_ranks(spark):
    """The cut bucket is refined until it is small; equal keys and equal rows are cut exactly too."""
    rows_ = [(i % 700, i // 2) for i in range(3000)] + [(1, 1)] * 500 + [(None, 5)] * 3
    df = spark.createDataFrame(rows_, "id int, v int")
    ranked = df.withColumn("r", F.coalesce(F.md5(F.concat_ws("|", F.col("id").cast("string"), F.lit("42"))), F.lit("x"))).orderBy("r")
    keys = [r.id for r in ranked.collect()]
    for n in (0, 1, 37, 1500, 3400, 3502, 3503, 9000):
        got = src.sample_products(df, n, 42, few=20).collect()
        assert len(got) == min(n, 3503)
        assert sorted(map(str, (r.id for r in got))) == sorted(map(str, keys[:n]))
    again = src.sample_products(df.repartition(9), 1500, 42, few=20)
    assert sorted(map(str, again.collect())) == sorted(map(str, src.sample_products(df, 1500, 42, few=20).collect()))


def test_csv_lines_are_counted_before_they_are_parsed(spark, tmp_path):
    header = ",".join(src.PRODUCT_SCHEMA.fieldNames())
    full = '1,Men,"A ""x"", b",c,d,e,f,2011,g,"name, with, commas"'
    (tmp_path / "a.csv").write_bytes(f"{header}\r\n{full}\r\n\r\n2,Men\r\n3{',x' * 10}\r\n".encode())
    (tmp_path / "b.csv").write_text(f'﻿"{header.replace(",", chr(34) + "," + chr(34))}"\n4,,,,,,,,,last\n5,,,,,,,,,,\n')
    before = spark.conf.get("spark.sql.csv.parser.columnPruning.enabled")
    got = sorted(map(tuple, src.read_products_csv(spark, str(tmp_path)).select("id", "masterCategory", "year", "productDisplayName").collect()))
    assert got == [(1, 'A "x", b', 2011, "name, with, commas"), (2, None, None, None), (4, None, None, "last")]
    assert spark.conf.get("spark.sql.csv.parser.columnPruning.enabled") == before
    multi = src.read_products_csv(spark, str(tmp_path / "a.csv"), multi_line=True)
    assert sorted((r.id, r.year) for r in multi.select("id", "year").collect()) == [(1, 2011), (2, None)]
