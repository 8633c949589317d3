"""CSV files with line breaks inside cells, cut into records by many tasks."""

import csv
import io
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from salesflow.sources.files import list_files, read_delimited_master, read_text_csvs
from salesflow.sources.records import ends_inside, file_lines, header_names, parsed_records, records


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def small_blocks(spark):
    """Files are cut into blocks of a few lines."""
    sizes = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "0"}
    before = {key: spark.conf.get(key) for key in sizes}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def odd_cell(r):
    return r.choice([
        f"plain{r.randrange(100)}", "", '"line\nbreak"', '"%s"' % ("\n" * r.randrange(1, 5)), '"say ""hi"" , now"', '5" pipe', '""', ' "spaced',
        '"long %s"' % ("x\n" * r.randrange(60)), '"a,b"', 'a"b"c', '"""q"""', '"\n""\n"""',
    ])


@pytest.mark.parametrize("seed", [1, 2])
def test_records_agree_with_a_reader_of_whole_files(spark, small_blocks, tmp_path, seed):
    r = random.Random(seed)
    files = []
    for n in range(4):
        lines = [",".join([f"id{n}-{i}", odd_cell(r), odd_cell(r)]) + "\n" + "\n" * (r.random() < 0.1) for i in range(100)]
        path = tmp_path / f"f{n}.csv"
        path.write_text("a,b,c\n" + "".join(lines))
        files.append(str(path))
    assert file_lines(spark, files).rdd.getNumPartitions() > 20
    got = parsed_records(spark, files, ["a", "b", "c"]).select("a", "b", "c")
    whole = spark.read.options(
        header=True, quote='"', escape='"', multiLine=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(files)
    assert rows(got) == rows(whole) and got.count() == 400


def test_records_are_numbered_and_sort_in_file_order(spark, small_blocks, tmp_path):
    path = tmp_path / "f.csv"
    body = [[f"n{i}", "x\ny" * (i % 3), "z" * (i % 40)] for i in range(200)]
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows([["a", "b", "c"], *body])
    path.write_text(text.getvalue())
    found = records(spark, [str(path)]).orderBy("place").collect()
    assert [r["number"] for r in found] == list(range(1, 202))
    assert [next(csv.reader(io.StringIO(r["record"], newline=""))) for r in found[1:]] == body


def test_a_cell_longer_than_many_blocks(spark, small_blocks, tmp_path):
    path = tmp_path / "f.csv"
    cell = "line\n" * 2000
    path.write_text(f'a,b\n1,"{cell}"\n2,x\n')
    assert rows(parsed_records(spark, [str(path)], ["a", "b"]).select("a", "b")) == Counter([("1", cell), ("2", "x")])


def test_windows_line_ends_stay_inside_cells_only(spark, tmp_path):
    (tmp_path / "f.csv").write_bytes(b'\xef\xbb\xbfa,b\r\n1,"x\r\ny"\r\n2,z\r\n')
    out = read_text_csvs(spark, [str(tmp_path / "f.csv")])
    assert rows(out) == Counter([("1", "x\r\ny"), ("2", "z")])


def test_jobs_do_not_grow_with_the_files(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"f{i}.csv").write_text(f'a,b\n{i},"x\ny"\n')
    files = list_files(spark, str(tmp_path), ".csv")

    def jobs(some):
        group = f"csv-{len(some)}"
        spark.sparkContext.setJobGroup(group, group)
        read_text_csvs(spark, some)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(files) == jobs(files[:1]) <= 2
    assert rows(read_text_csvs(spark, files)) == Counter((str(i), "x\ny") for i in range(12))


def test_what_a_line_does(spark):
    lines = ["", "a,b", '"a', '"a"', 'x,"a', '5" x', '5" x,"a', '"a""', '"a"""', '"a",5" b', '"",""', '";"', "a;\"", '""x"y', ' "a']
    out = spark.createDataFrame([(x,) for x in lines], "value string").select(
        "value", ends_inside(F.col("value"), ",", False).alias("o"), ends_inside(F.col("value"), ",", True).alias("i")
    )
    ends = {r["value"]: (r["o"], r["i"]) for r in out.collect()}
    assert ends[""] == (False, True) and ends["a,b"] == (False, True)
    assert ends['"a'] == (True, False) and ends['"a"'] == (False, False) and ends['x,"a'] == (True, False)
    assert ends['5" x'] == (False, False) and ends['5" x,"a'] == (True, True)
    assert ends['"a""'][0] is True
    assert ends['"a"""'][0] is False and ends['"a",5" b'][0] is False and ends['""x"y'][0] is False and ends[' "a'][0] is False


def test_header_names_as_the_reader_gives_them(spark, tmp_path):
    header = 'a,,A,"b\nc",d'
    (tmp_path / "f.csv").write_text(header + "\n1,2,3,4,5\n")
    whole = spark.read.options(header=True, quote='"', escape='"', multiLine=True).csv(str(tmp_path / "f.csv"))
    assert list(header_names(header)) == whole.columns


def test_master_folder_with_line_breaks(spark, tmp_path):
    (tmp_path / "1.csv").write_text('City ;ADM1\n"Ban\ndung";W\n')
    (tmp_path / "2.csv").write_text("City ;ADM1\nJakarta;J\n")
    out = read_delimited_master(spark, str(tmp_path), ";", ["City", "ADM1"], row_no="n")
    assert [r["City"] for r in out.orderBy("n").collect()] == ["Ban\ndung", "Jakarta"]
    (tmp_path / "3.csv").write_text("Other;ADM1\nx;J\n")
    with pytest.raises(ValueError, match="different headers"):
        read_delimited_master(spark, str(tmp_path), ";")
