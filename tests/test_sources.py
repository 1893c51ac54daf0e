"""CSV scan edge rows (A1) and the dict-like reader (A2)."""

import os

from quire.sources import read_csv_rows, read_reviews_csv
from pyspark.sql.types import StringType, StructField, StructType


def _write(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_csv_edge_rows(spark, workdir):
    text = ('a,b,c\n'
            '1,"he said ""hi""\nline2",5\n'
            '2,,6\n'
            '3,"",7\n'
            '4,x\n'
            '5,x,8,9\n'
            '\n'
            '6, sp ,1\n')
    path = _write(f"{workdir}/edge", text)
    schema = StructType([StructField(c, StringType(), True) for c in "abc"])
    rows = {r["a"]: r for r in read_reviews_csv(spark, path, schema).collect()}
    assert sorted(rows) == ["1", "2", "3", "4", "5", "6"]
    assert rows["1"]["b"] == 'he said "hi"\nline2' and rows["1"]["c"] == "5"
    assert rows["2"]["b"] is None and rows["3"]["b"] is None
    assert rows["4"]["b"] == "x" and rows["4"]["c"] is None
    assert rows["5"]["c"] == "8"
    assert rows["6"]["b"] == " sp "


def test_csv_header_matched_by_name(spark, workdir):
    path = _write(f"{workdir}/order", "c,a,b\n3,1,2\n")
    schema = StructType([StructField(c, StringType(), True) for c in "abc"])
    r = read_reviews_csv(spark, path, schema).first()
    assert (r["a"], r["b"], r["c"]) == ("1", "2", "3")


def test_dict_reader_empty_is_empty_string(spark, workdir):
    path = _write(f"{workdir}/dict", 'x,y,z\n1,,"q"\n2\n')
    rows = sorted(read_csv_rows(spark, path, ["x", "y", "z"]).collect())
    assert [tuple(r) for r in rows] == [("1", "", "q"), ("2", "", "")]
    every = read_csv_rows(spark, path)
    assert every.columns == ["x", "y", "z"] and sorted(map(tuple, every.collect())) == \
        [("1", "", "q"), ("2", "", "")]


def test_multiline_roundtrip_conversations(spark, workdir):
    from quire.sources import land_csv
    from quire.sources.fixtures import table
    conv = table(spark, "/root/testdata/sf0.01", "conversations").selectExpr(
        "cast(conv_id as string) conv_id", "cast(turn as string) turn", "role", "text")
    land_csv(conv, f"{workdir}/conv")
    schema = StructType([StructField(c, StringType(), True) for c in conv.columns])
    back = read_reviews_csv(spark, f"{workdir}/conv", schema)
    assert back.count() == conv.count()
    assert back.exceptAll(conv).count() == 0 and conv.exceptAll(back).count() == 0


def test_archive_bytes_match_python_csv_writer(spark, workdir):
    import csv
    import glob
    import io

    from quire.sinks import write_minute_archive
    rows = [("a1", "2024-01-01T00:00:00+00:00", '  spaced, "quoted"\ntext  '),
            ("", "2024-01-01T00:00:30+00:00", ""),
            ("a3", "2024-01-01T00:00:59+00:00", "plain")]
    df = spark.createDataFrame([("01_01_2024_00_00",) + r for r in rows],
                               "minute string, author_id string, created_at string, text string")
    write_minute_archive(df.coalesce(1), f"{workdir}/arch")
    files = glob.glob(f"{workdir}/arch/minute=01_01_2024_00_00/*.csv")
    assert len(files) == 1
    got = open(files[0], newline="", encoding="utf-8").read()
    buf = io.StringIO(newline="")
    w = csv.writer(buf, lineterminator="\n")
    w.writerow(["author_id", "created_at", "text"])
    for r in rows:
        w.writerow(r)
    assert got == buf.getvalue()  # same bytes but for the row terminator
    back = list(csv.reader(io.StringIO(got, newline="")))
    assert back == [["author_id", "created_at", "text"]] + [list(r) for r in rows]
