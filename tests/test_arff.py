"""ARFF reading and writing on small files of our own."""

import gzip

import pytest

from trialbook.sources import arff, tables

DENSE = """% a comment
@relation 'some data'

@attribute family {GB,GK, 'T N', "Z'A", U}
@attribute 'with%2Fslash' REAL
@ATTRIBUTE "quoted name" string
@attribute flag {TRUE,false}
@attribute whole INTEGER

@data
% another comment
GB, 1.5, 'it\\'s, here', TRUE, 3
?,?,?,?,?

'T N', -2e3, "x, y", false, 4.0
"Z'A",0,'?',TRUE,-7
U,1,'\\"median\\"',false,255
U,1,'',false,0
U,1,'back\\\\slash\\nline',false,0
"""


@pytest.fixture
def dense(tmp_path):
    path = tmp_path / "dense.arff"
    path.write_text(DENSE, encoding="utf8")
    return str(path)


def test_dense(spark, dense):
    df, features = arff.read_dense(spark, dense)
    rows = [tuple(r) for r in df.orderBy("rowid").collect()]
    assert rows == [
        (0, "GB", 1.5, "it's, here", True, 3), (1, None, None, None, None, None), (2, "T N", -2000.0, "x, y", False, 4),
        (3, "Z'A", 0.0, "?", True, -7), (4, "U", 1.0, '"median"', False, 255), (5, "U", 1.0, "", False, 0),
        (6, "U", 1.0, "back\\slash\nline", False, 0)]
    assert [f.name for f in features] == ["family", "with%2Fslash", "quoted name", "flag", "whole"]
    assert features[0].nominal_values == ("GB", "GK", "T N", "Z'A", "U")
    assert [f.data_type for f in features] == ["nominal", "numeric", "string", "nominal", "numeric"]


def test_gzip_and_dispatch(spark, tmp_path, dense):
    path = str(tmp_path / "dense.arff.gz")
    with gzip.open(path, "wt", encoding="utf8") as f:
        f.write(DENSE)
    assert sorted(tables.read_dataset(spark, path).collect(), key=lambda r: r[0]) == sorted(tables.read_dataset(spark, dense).collect(), key=lambda r: r[0])
    assert tables.read_preferred(spark, str(tmp_path / "absent.parquet"), dense).count() == 7
    with pytest.raises(ValueError):
        tables.read_dataset(spark, "data.csv")


def test_rowids_over_many_splits(spark, tmp_path):
    path = tmp_path / "long.arff"
    lines = [f"% noise {i}\n{i},{'a' if i % 2 else 'b'}" for i in range(20_000)]
    path.write_text("@relation r\n@attribute i INTEGER\n@attribute c {a,b}\n@data\n" + "\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        df, _ = arff.read_dense(spark, str(path))
        assert df.filter("rowid <> i").count() == 0
        assert df.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("line", ["GB,1.5,x,TRUE", "XX,1.5,x,TRUE,3", "GB,word,x,TRUE,3"])
def test_bad_rows_are_errors(spark, tmp_path, line):
    path = tmp_path / "bad.arff"
    path.write_text(DENSE + line + "\n")
    with pytest.raises(Exception):
        arff.read_dense(spark, str(path))[0].collect()


def test_date_attributes_are_refused():
    with pytest.raises(ValueError):
        arff.parse_header(["@attribute d DATE 'yyyy'", "@data"])


def test_sparse(spark, tmp_path):
    path = tmp_path / "sparse.arff"
    path.write_text("@relation s\n@attribute a NUMERIC\n@attribute b {0,1,2}\n@attribute c REAL\n@data\n{0 1.5, 2 -3}\n{}\n{1 2,2 ?}\n")
    entries, _ = arff.read_sparse(spark, str(path))
    assert sorted(tuple(r) for r in entries.filter("value IS NOT NULL").collect()) == [(0, 0, 1.5), (0, 2, -3.0), (2, 1, 2.0)]
    assert tuple(arff.sparse_shape(entries).first()) == (3, 3)
    vectors = {r["rowid"]: r["features"].toArray().tolist() for r in arff.sparse_vectors(entries, 3, arff.sparse_rows(spark, str(path))).collect()}
    assert str(dict(sorted(vectors.items()))) == str({0: [1.5, 0.0, -3.0], 1: [0.0, 0.0, 0.0], 2: [0.0, 2.0, float('nan')]})  # a missing value is no zero
    whole = tables.read_dataset(spark, str(path)).orderBy("rowid").collect()
    assert [type(r["features"]).__name__ for r in whole] == ["SparseVector"] * 3 and whole[1]["features"].numNonzeros() == 0
    path.write_text("@relation s\n@attribute a STRING\n@data\n{0 x}\n")
    with pytest.raises(ValueError):
        arff.read_sparse(spark, str(path))


def test_split_file(spark, tmp_path):
    head = "@relation s\n@attribute type {TRAIN,TEST,OTHER}\n@attribute rowid NUMERIC\n@attribute repeat NUMERIC\n@attribute fold NUMERIC\n@data\n"
    path = tmp_path / "splits.arff"
    path.write_text(head + "TRAIN,5,0,1\nTEST,6,0,1\n")
    rows = sorted(tuple(r) for r in arff.read_splits(spark, str(path)).collect())
    assert rows == [(0, 1, 0, "TEST", 6), (0, 1, 0, "TRAIN", 5)]
    path.write_text(head + "OTHER,5,0,1\n")
    with pytest.raises(Exception):
        arff.read_splits(spark, str(path)).collect()


TRACE = "@relation t\n@attribute repeat NUMERIC\n@attribute fold NUMERIC\n@attribute iteration NUMERIC\n@attribute evaluation NUMERIC\n@attribute selected {true,false}\n"


def test_trace_file(spark, tmp_path):
    path = tmp_path / "trace.arff"
    path.write_text(TRACE + "@attribute parameter_p__strategy STRING\n@data\n0,0,0,0.5,false,'\\\"median\\\"'\n0,0,1,0.75,true,'\\\"mean\\\"'\n")
    rows = arff.read_trace(spark, str(path), 7).orderBy("iteration").collect()
    assert [(r["run_id"], r["iteration"], r["evaluation"], r["selected"]) for r in rows] == [(7, 0, 0.5, False), (7, 1, 0.75, True)]
    assert rows[1]["parameters"] == {"p__strategy": '"mean"'}
    path.write_text(TRACE + "@attribute strategy STRING\n@data\n")
    with pytest.raises(ValueError, match="do not start with"):
        arff.read_trace(spark, str(path))
    path.write_text(TRACE.replace("@attribute iteration NUMERIC\n", "") + "@data\n")
    with pytest.raises(ValueError, match="lacks"):
        arff.read_trace(spark, str(path))


def test_round_trip(spark, tmp_path):
    rows = [(0, "a,b", None, True, 1), (1, "it's", 0.5, False, 2), (2, "?", -1e-9, None, None), (3, "", 1e300, True, 3),
            (4, "line\nbreak\ttab\\", 0.1, True, 4), (5, "% no comment", 0.0, True, 5), (6, "é 漢", 2.0, True, 6)]
    df = spark.createDataFrame(rows, "rowid long, s string, x double, b boolean, i long").repartition(3)
    arff.write_dense(df, str(tmp_path / "out"), "a relation")
    back, features = arff.read_dense(spark, str(tmp_path / "out"))
    assert [tuple(r) for r in back.orderBy("rowid").collect()] == rows
    assert features[2].nominal_values == ("True", "False")
    with pytest.raises(ValueError):
        arff.write_sparse(df, str(tmp_path / "sparse"), "r")


def test_cache(spark, tmp_path, dense):
    df, features = arff.read_dense(spark, dense)
    tables.write_cache(df, features, str(tmp_path / "cache"))
    back, same = tables.read_cache(spark, str(tmp_path / "cache"))
    assert same == features
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
