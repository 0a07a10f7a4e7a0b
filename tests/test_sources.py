from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from granary.sources import delimited, landing, tables, workspace


@pytest.fixture
def files(tmp_path):
    def write(**texts):
        for name, text in texts.items():
            path = tmp_path / name.replace("__", "/")
            path.parent.mkdir(parents=True, exist_ok=True)
            path.with_suffix(".csv").write_bytes(text.encode("utf-8"))
        return str(tmp_path)

    return write


def test_byte_order_mark_and_stray_blank(spark, files):
    root = files(history="﻿Name,Year,Amount\nA,1993, 12.5\nB,1994,7\n")
    df = delimited.scan_sniffed(spark, f"{root}/history.csv")
    assert df.columns == ["Name", "Year", "Amount"]
    assert [r[0] for r in df.select(F.trim("Amount").try_cast("double")).collect()] == [12.5, 7.0]


@pytest.mark.parametrize("sep", [",", ";"])
def test_separator_is_sniffed(spark, files, sep):
    root = files(f=f"a{sep}b\n1{sep}2\n")
    df = delimited.scan_sniffed(spark, f"{root}/f.csv")
    assert df.columns == ["a", "b"] and tuple(df.first()) == ("1", "2")


def test_tagged_files_meet_by_name(spark, files, rows):
    root = files(w__aceh="A;B\n1;2\n", w__riau="B;C\n5;6\n", w__jambi="", w__other="A;B\n9;9\n")
    df = delimited.scan_tagged_files(spark, root, codes=["aceh", "riau", "jambi", "lampung"])
    got = rows(df.select("code", "A", "B", "C"))
    assert got == [("aceh", "1", "2", None), ("riau", None, "5", "6")]
    assert delimited.scan_tagged_files(spark, root, codes=["nowhere"]) is None


def test_lines_that_do_not_fit_can_be_kept(spark, files, rows):
    root = files(f="a,b\n1,2\n3\n4,5,6\n")
    got = rows(delimited.scan_delimited(spark, f"{root}/f.csv", corrupt="raw"))
    assert got == [("1", "2", None), ("3", None, "3"), ("4", "5", "4,5,6")]
    tagged = workspace.settle(delimited.scan_tagged_files(spark, root, ",", corrupt="raw"), "tagged")
    assert tagged.where("raw is not null").count() == 2


def test_tagged_files_with_one_header(spark, files, rows):
    root = files(w__aceh="A;B\n1;2\n", w__riau="A;B\n5;6\n", w__other="A;B\n9;9\n")
    df = delimited.scan_tagged_files(spark, root, codes=["aceh", "riau"], same_header=True)
    assert rows(df.select("code", "A", "B")) == [("aceh", "1", "2"), ("riau", "5", "6")]


def test_headers_in_another_order_never_mix_columns_up(spark, files, rows):
    root = files(w__a="x;y\n1;2\n", w__b="y;x\n4;3\n\n")
    assert rows(delimited.scan_tagged_files(spark, root).select("code", "x", "y")) == [("a", "1", "2"), ("b", "3", "4")]
    for scan in (lambda: delimited.scan_delimited(spark, f"{root}/w", ";"), lambda: delimited.scan_sniffed(spark, f"{root}/w"),
                 lambda: delimited.scan_tagged_files(spark, root, same_header=True)):
        with pytest.raises(Exception, match="(?i)header"):
            scan().collect()


def test_a_file_with_a_repeated_column_is_reported_and_the_others_are_read(spark, files, rows):
    root = files(w__a="x;y\n1;2\n", w__b="x;X\n4;3\n", w__c="", w__d="x;y\n5;6\n")
    assert rows(delimited.scan_tagged_files(spark, root).select("code", "x", "y")) == [("a", "1", "2"), ("d", "5", "6")]
    report = {r.relative_path: r.status for r in delimited.scan_report(spark, root).collect()}
    assert report == {"w/a.csv": "read", "w/b.csv": "repeated column", "w/c.csv": "empty", "w/d.csv": "read"}


def _text_scans(df) -> int:
    return sum("FileScan" in line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "parquet" not in line.lower())


@pytest.mark.parametrize("headers", [1, 2, 50])
def test_any_number_of_headers_is_one_scan(spark, files, headers):
    """Files with their own columns in their own order, with quoted separators in the values."""
    texts, made = {}, []
    for i in range(headers):
        names = [f"n{j}" for j in range(2 + i % 7)]
        names = names[i % len(names) :] + names[: i % len(names)]
        lines = [";".join(names)]
        for row in range(3):
            values = {n: f"{i};{row}{n}" if n == "n1" else f"{i}-{row}{n}" for n in names}
            lines.append(";".join(f'"{values[n]}"' for n in names))
            made.append(values | {"code": f"f{i}"})
        texts[f"w__f{i}"] = "\r\n".join(lines) + "\n"
    df = delimited.scan_tagged_files(spark, files(**texts))
    assert _text_scans(df) == 1 and len(df.columns) == len({c for values in made for c in values})
    want = [tuple(values.get(c) for c in df.columns) for values in made]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)


def test_columns_meet_whatever_their_case_and_odd_names_are_kept(spark, files, rows):
    root = files(w__a="Amount;a`b;x.y\n1;2;3\n", w__b="x.y;AMOUNT\n4;5\n6\n7;8;9\n")
    df = delimited.scan_tagged_files(spark, root, corrupt="bad line")
    assert df.columns == ["Amount", "a`b", "x.y", "bad line", "code"]
    assert rows(df) == sorted([("1", "2", "3", None, "a"), ("5", None, "4", None, "b"), (None, None, "6", "6", "b"), ("8", None, "7", "7;8;9", "b")], key=repr)


def test_other_files_do_not_matter_where_codes_are_given(spark, files, rows):
    root = files(w__a="x;y\n1;2\n", w__b="x;y\n3;4\n", w__other="y;x\n5;6\n", w__twice="x;X\n7;8\n")
    df = delimited.scan_tagged_files(spark, root, codes=["a", "b"])
    assert rows(df.select("code", "x", "y")) == [("a", "1", "2"), ("b", "3", "4")] and _text_scans(df) == 1


def test_only_first_lines_are_read_for_headers(spark, files):
    root = files(w__a="x;y\n" + "1;2\n" * 200_000, w__b="y;x\n" + "1;2\n" * 200_000)
    heads = {r.uri.rsplit("/", 1)[1]: r.header for r in delimited.file_headers(spark, root).collect()}
    assert heads == {"a.csv": "x;y", "b.csv": "y;x"}
    assert delimited.scan_tagged_files(spark, root).where("x = '1'").count() == 200_000


def test_an_unreadable_file_is_told_and_can_be_passed_over(spark, tmp_path, rows):
    import gzip

    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(b"x;y\n1;2\n"))
    (tmp_path / "b.csv.gz").write_bytes(gzip.compress(b"y;x\n4;3\n"))
    (tmp_path / "c.csv.gz").write_bytes(b"no archive at all")
    how = {"glob": "*.csv.gz", "pattern": r"([^/]+)\.csv\.gz$"}
    with pytest.raises(Exception):
        delimited.scan_tagged_files(spark, str(tmp_path), **how).collect()
    df = delimited.scan_tagged_files(spark, str(tmp_path), skip_unreadable=True, **how)
    assert rows(df.select("code", "x", "y")) == [("a", "1", "2"), ("b", "3", "4")]
    report = {r.relative_path: r.status for r in delimited.scan_report(spark, str(tmp_path), glob="*.csv.gz").collect()}
    assert report == {"a.csv.gz": "read", "b.csv.gz": "read", "c.csv.gz": "unreadable"}


@pytest.mark.parametrize("name", ["a[1]", "a{b,c}", "a b%20+c", "a*?"])
def test_file_names_are_no_patterns(spark, files, rows, name):
    root = files(**{f"w__{name}": "x;y\n1;2\n", "w__z": "y;x\n4;3\n"})
    assert rows(delimited.scan_tagged_files(spark, root).select("code", "x", "y")) == sorted([(name, "1", "2"), ("z", "3", "4")], key=repr)


def test_landing_copies_bytes_and_counts_failures(spark, files, tmp_path_factory):
    root = files(w__a="x,y\n1,2\n", f__b="﻿z\n", w__empty="")
    found = landing.manifest(spark, root)
    assert {r.relative_path: r.length for r in found.collect()} == {"w/a.csv": 8, "f/b.csv": 5, "w/empty.csv": 0}
    landing.require_folders(found, ["w", "f"])
    with pytest.raises(FileNotFoundError):
        landing.require_folders(found, ["w", "absent"])
    target = tmp_path_factory.mktemp("landed")
    summary = landing.landing_summary(landing.land_files(found, str(target))).first()
    assert tuple(summary) == (3, 3, 0)
    assert (target / "f/b.csv").read_bytes() == "﻿z\n".encode()
    assert not list(target.rglob("*.part"))
    gone = found.withColumn("path", F.concat("path", F.lit(".gone")))
    assert tuple(landing.landing_summary(landing.land_files(gone, str(target))).first()) == (3, 0, 3)


@pytest.mark.parametrize(
    "root, path, below",
    [
        ("/a/b", "file:/a/b/x/a/b/f.csv", "x/a/b/f.csv"),
        ("/a/b/", "hdfs://nn:9000/a/b/f.csv", "f.csv"),
        ("hdfs://nn:9000/a", "hdfs://nn:9000/a/a/f.csv", "a/f.csv"),
        ("hdfs:///a", "hdfs://nn/a/f.csv", "f.csv"),
        ("file:///a b", "file:/a b/c.csv", "c.csv"),
        ("s3a://bucket", "s3a://bucket/k/f.csv", "k/f.csv"),
        ("rel/dir", "file:/home/u/rel/dir/rel/dir/f.csv", "rel/dir/f.csv"),
        ("/", "file:/x/f.csv", "x/f.csv"),
        ("/a.b", "file:/a.b/f.csv", "f.csv"),
    ],
)
def test_path_below_the_root(spark, root, path, below):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(landing.relative_to(F.col("p"), root)).first()[0] == below


def test_optional_tables(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/b")
    spark.range(2).write.parquet(f"{tmp_path}/c")
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "broken.parquet").write_bytes(b"not a table")
    (tmp_path / "e").mkdir()
    paths = {n: f"{tmp_path}/{n}" for n in "abce"}
    found = tables.scan_available(spark, paths)
    assert list(found) == ["b", "c"]
    assert {r.dataset for r in tables.left_out(spark, paths).collect()} == {"a", "e"}
    with pytest.raises(Exception, match="broken"):  # there, but no table
        tables.scan_available(spark, {n: f"{tmp_path}/{n}" for n in "bd"})["d"].count()
    assert [tuple(r) for r in tables.availability(found).collect()] == [("b", 3, True), ("c", 2, False)]
    assert tables.labelled_union(found, "model").groupBy("model").count().count() == 2
    with pytest.raises(FileNotFoundError):
        tables.scan_available(spark, {"a": f"{tmp_path}/a"})


def test_sinks(spark, tmp_path):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    assert tuple(tables.write_verified(df, f"{tmp_path}/t", num_files=4).first()) == (1000, 1000, True)
    assert len([p for p in (tmp_path / "t").iterdir() if p.suffix == ".parquet"]) == 4
    tables.write_table(df, f"{tmp_path}/p", partition_by=["k"])
    assert spark.read.parquet(f"{tmp_path}/p").where("k = 1").count() == 333
    assert len(list((tmp_path / "p").rglob("*.parquet"))) == 3
    assert tables.export_table(spark, f"{tmp_path}/t", f"{tmp_path}/copy")
    (tmp_path / "file").write_text("x")
    with pytest.warns(UserWarning, match="not exported"):
        assert not tables.export_table(spark, f"{tmp_path}/t", f"{tmp_path}/file/copy2")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.export_table(spark, f"{tmp_path}/nothing", f"{tmp_path}/copy3")
    told = tables.which_are_empty({"none": df.where("id < 0"), "all": df, "some": df.where("k = 1")})
    assert {r.dataset: r.is_empty for r in told.collect()} == {"none": True, "all": False, "some": False}
    assert tables.is_empty(None) and tables.is_empty(df.where("id < 0")) and not tables.is_empty(df)


class _Session:
    """Only the settings a session would give."""

    def __init__(self, **settings):
        self.conf = {k.replace("_", "."): v for k, v in settings.items()}


def test_work_folder_is_the_one_the_cluster_names():
    named = _Session(spark_checkpoint_dir="hdfs://x/y/", spark_master="yarn")
    assert workspace.shared_folder(named) == "hdfs://x/y"
    local = _Session(spark_master="local[2]", spark_app_id="a1")
    assert workspace.shared_folder(local) == workspace.shared_folder(local)
    for settings in ({"spark_master": "yarn"}, {}):  # a hidden master is no local run
        with pytest.raises(RuntimeError):
            workspace.shared_folder(_Session(**settings))


def test_settled_table_equals_its_source(spark):
    df = spark.range(10).withColumn("x", F.col("id") / 3)
    assert workspace.settle(df, "test").exceptAll(df).isEmpty()
    assert workspace.is_broadcast(workspace.settle(df, "small"))


def test_published_versions(spark, tmp_path):
    path = f"{tmp_path}/t"
    first = tables.publish(spark.range(10), path)
    old = tables.published(spark, path)
    assert old.count() == 10 and tables.versions(spark, path) == [first.rsplit("/", 1)[1]]
    broken = spark.range(100).withColumn("id", F.when(F.col("id") == 99, F.raise_error("stop").cast("bigint")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="stop"):
        tables.publish(broken, path)
    assert tables.published(spark, path).count() == 10
    tables.publish(spark.range(20), path)
    assert old.count() == 10  # a reader that began before
    tables.publish(tables.published(spark, path).where("id < 5"), path)  # a table may be made from itself
    assert tables.published(spark, path).count() == 5
    assert len(tables.versions(spark, path)) == 2 and not list(tmp_path.glob("t/_current.*"))
    assert tables.scan_table(spark, path).count() == 5
    spark.range(3).write.parquet(f"{tmp_path}/plain")
    assert tables.published(spark, f"{tmp_path}/plain").count() == 3
    assert tuple(tables.write_verified(spark.range(7), path, versioned=True).first()) == (7, 7, True)
    assert tables.export_table(spark, path, f"{tmp_path}/out") and spark.read.parquet(f"{tmp_path}/out").count() == 7
