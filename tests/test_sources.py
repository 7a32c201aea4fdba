import csv
import random
import re

import pytest
from pyspark.sql import functions as F

from siftmark.catalog import queries
from siftmark.operators.content import content_digest
from siftmark.plans import warehouse as wh
from siftmark.sources import readers, writers
from siftmark.sources.scratch import written
from siftmark.spec import ISO3_HEADERS, NAME_HEADERS
from util import SPEC, plan, rows


@pytest.fixture
def raw(tmp_path):
    (tmp_path / "population.csv").write_text(
        '"Data Source","Indicators",\n\n"Last Updated Date","2025-01-01",\n\n'
        '"Country Name","Country Code","Indicator","1960","1961",\n'
        '"Bahamas, The","BHS","Population","100","",\n"Brazil","BRA","Population","200.5","n/a",\n'
        '"World","WLD","Population","9","9",\n'
    )
    (tmp_path / "codes.csv").write_text(
        "GEOM;ISO3 CODE;ISO2 CODE;LABEL EN\n1;BRA;BR; Brazil \n2;NAM;NA;Namibia\n3;;XX;nothing\n4;BHS;BS;Bahamas\n5;nan;XX;bad\n"
    )
    (tmp_path / "long.csv").write_text(
        "Commodity,Country_Name,Market_Year,Attribute_ID,Attribute_Description,Value,Unit_Description\n"
        'x,"Bahamas, The",2020,1,Production,1.5,u\nx,BRAZIL,2020,1,Production,n/a,u\nx,BRAZIL,2021,1,Production,2,u\n'
        "x,Other,2021,1,Production,3,u\nx,Nowhere,2021,1,Production,3,u\nx,Namibia,,1,Production,3,u\n"
    )
    return tmp_path


def test_clean_layer(spark, raw):
    raw_codes = readers.read_csv(spark, str(raw / "codes.csv"), sep=";", ordered=True)
    order = F.struct(*readers.FILE_ORDER)
    codes = wh.clean_codes(raw_codes)
    assert rows(codes.select("iso3_code", "iso2_code", "english_name")) == [
        ("BHS", "BS", "Bahamas"), ("BRA", "BR", "Brazil"), ("NAM", "NA", "Namibia")  # the code NA survives
    ]
    assert rows(wh.code_labels(raw_codes, order)) == [
        ("bahamas", "BHS"), ("brazil", "BRA"), ("namibia", "NAM")
    ]
    long = wh.clean_long_fact(
        readers.read_csv(spark, str(raw / "long.csv")), wh.code_labels(raw_codes, order), SPEC
    )
    assert rows(long) == [
        ("BHS", "Bahamas, The", 2020, 1, "Production", 1.5, "u"), ("BRA", "BRAZIL", 2021, 1, "Production", 2.0, "u")
    ]
    wide = readers.read_csv_after_preamble(spark, str(raw / "population.csv"))
    assert readers.period_columns(wide.columns) == ["1960", "1961"]
    population = wh.clean_population(wide, codes, SPEC)
    assert rows(population) == [("Bahamas, The", "BHS", 1960, 100.0), ("Brazil", "BRA", 1960, 200.5)]
    dim = wh.dim_entity(codes, SPEC)
    assert dim.filter(F.col("region").isNull()).count() == 3


def test_later_label_row_wins(spark, tmp_path):
    (tmp_path / "codes.csv").write_text("ISO3 CODE;ISO2 CODE;LABEL EN\nZZZ;Z;Brazil\nBRA;B; BRAZIL\nAAA;A;Chad\n")
    raw = readers.read_csv(spark, str(tmp_path / "codes.csv"), sep=";", ordered=True)
    labels = wh.code_labels(raw, F.struct(*readers.FILE_ORDER))
    assert rows(labels) == [("brazil", "BRA"), ("chad", "AAA")]


def test_later_file_wins_whatever_its_size(spark, tmp_path):
    """Spark packs large files first; the order of the names counts."""
    head = "ISO3 CODE;ISO2 CODE;LABEL EN\n"
    filler = "".join(f"F{k};F;Filler {k}\n" for k in range(500))
    (tmp_path / "part-0.csv").write_text(head + "OLD;B;Brazil\n")
    (tmp_path / "part-1.csv").write_text(head + "NEW;B;Brazil\n" + filler)
    raw = readers.read_csv(spark, str(tmp_path), sep=";", ordered=True)
    labels = wh.code_labels(raw, F.struct(*readers.FILE_ORDER))
    assert labels.filter("_label = 'brazil'").first()[1] == "NEW"


def test_data_line_equal_to_a_preamble_line_stays(spark, tmp_path):
    (tmp_path / "p.csv").write_text("x,1\n\nnote\n\nname,2001\na,5\nx,1\nnote\nname,2001\n")
    found = readers.read_csv_after_preamble(spark, str(tmp_path / "p.csv"))
    assert rows(found) == [("a", "5"), ("name", "2001"), ("note", None), ("x", "1")]


def test_line_breaks_in_quoted_fields(spark, tmp_path):
    (tmp_path / "q.csv").write_text('a,b\n"one\ntwo",3\nx,4\n')
    found = readers.read_csv(spark, str(tmp_path / "q.csv"))
    assert rows(found) == [("one\ntwo", "3"), ("x", "4")]
    (tmp_path / "p.csv").write_text('t\n\n\n\na,b\n"one\ntwo",3\n"\n\n",4\n')
    assert rows(readers.read_csv_after_preamble(spark, str(tmp_path / "p.csv"))) == [("\n\n", "4"), ("one\ntwo", "3")]


@pytest.fixture
def blocks(spark):
    """Files are read in blocks of the given bytes."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, size)
    spark.conf.set(name, before)


def odd_fields(seed, n):
    rng = random.Random(seed)
    parts = ['"', '""', "\n", "\r\n", ",", "plain", "é", " ", "x" * 30]
    # a field of white space only or an empty one is left to the reader's rules for unquoted text
    return [(str(k), "".join(rng.choice(parts) for _ in range(rng.randrange(1, 9))) + "z", rng.choice(["a", "b\nc"])) for k in range(n)]


@pytest.mark.parametrize("size", [97, 1000])
def test_blocks_of_a_file_with_line_breaks_in_quotes(spark, tmp_path, blocks, size):
    """Every block starts somewhere else: in a field, between quotes, in a record, in the header."""
    data = odd_fields(size, 60)
    for k, part in enumerate((data[:25], data[25:])):
        with open(tmp_path / f"part-{k}.csv", "w", newline="") as f:
            writer = csv.writer(f, quoting=csv.QUOTE_ALL if k else csv.QUOTE_MINIMAL, lineterminator="\r\n" if k else "\n")
            writer.writerows([("k\ney", "text", "more"), *part])
    blocks(size)
    found = readers.read_csv(spark, str(tmp_path), ordered=True)
    assert found.columns[:3] == ["k\ney", "text", "more"]
    got = [tuple(r)[:3] for r in found.orderBy(*readers.FILE_ORDER).collect()]
    assert got == data
    if size <= 1000:
        assert readers.file_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 2


def test_a_field_over_several_blocks(spark, tmp_path, blocks):
    long = "\n".join(f"line {k} of it" for k in range(60))
    (tmp_path / "f.csv").write_text(f'a,b\n1,"{long}"\n2,"x""y"\n3,"{long}\n"\n4,end\n')
    blocks(100)
    assert rows(readers.read_csv(spark, str(tmp_path / "f.csv"))) == [("1", long), ("2", 'x"y'), ("3", long + "\n"), ("4", "end")]


def test_records_over_arrow_batches(spark, tmp_path):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, 3)
    try:
        data = odd_fields(4, 60)
        with open(tmp_path / "f.csv", "w", newline="") as f:
            csv.writer(f, lineterminator="\n").writerows([("k", "text", "more"), *data])
        assert sorted(tuple(r) for r in readers.read_csv(spark, str(tmp_path / "f.csv")).collect()) == sorted(data)
    finally:
        spark.conf.set(name, before)


def test_lines_without_open_quotes_are_left_to_the_reader(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b\n"x,y",1\n"p""q",2\n')
    found = readers.read_csv(spark, str(tmp_path / "f.csv"))
    assert "FileScan csv" in plan(found) and rows(found) == [('p"q', "2"), ("x,y", "1")]


def test_an_unclosed_quote_stays_in_its_file(spark, tmp_path):
    (tmp_path / "f1.csv").write_text('a,b\n1,"open\n2,x\n')
    (tmp_path / "f2.csv").write_text("a,b\n3,y\n")
    got = rows(readers.read_csv(spark, str(tmp_path)))
    assert len(got) == 2 and got[1] == ("3", "y")


def test_preamble_shorter_than_asked(spark, raw):
    with pytest.raises(ValueError):
        readers.read_csv_after_preamble(spark, str(raw / "codes.csv"), skip=40)


def test_resolve_headers():
    assert readers.resolve_headers(["a", "ISO3", "name"], {"name": NAME_HEADERS, "ISO3": ISO3_HEADERS}) == ["name", "ISO3"]
    with pytest.raises(KeyError, match="ISO3, name"):
        readers.resolve_headers(["a"], {"name": NAME_HEADERS, "ISO3": ISO3_HEADERS})


def test_export(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 0.1, 'a "quoted", text'), (2, float("nan"), None), (3, 1 / 3, "x"), (4, 2.0, "y"), (5, 1e20, "z"), (6, -1.5e-7, "w")],
        "k int, v double, s string",
    )
    counts = writers.export_tables({"t": df}, str(tmp_path / "out"))
    assert rows(counts) == [("t", 6, 6, True, True)]
    back = readers.read_csv(spark, str(tmp_path / "out" / "t"))
    got = {int(r.k): (r.v, r.s) for r in back.collect()}
    assert got[1] == ("0.1", 'a "quoted", text')
    assert got[2] == (None, None)
    assert got[4][0] == "2"
    for k, v in [(3, 1 / 3), (5, 1e20), (6, -1.5e-7)]:
        assert float(got[k][0]) == float(f"{v:.15g}")


def test_export_keeps_values(spark, tmp_path):
    """Values that need quotes, and the digits that an export keeps, come back equal; a lost value is told."""
    odd = [' a "quoted", value\nwith a break ', "", None, "NULL", "1,5", "\r\n", '"', "ü"]
    df = spark.createDataFrame([(k, s, k / 7 if k else float("inf"), k % 2 == 0) for k, s in enumerate(odd)], "k bigint, s string, v double, b boolean")
    assert rows(writers.export_tables({"t": df}, str(tmp_path / "out"))) == [("t", 8, 8, True, True)]
    back = writers.typed(readers.read_csv(spark, str(tmp_path / "out" / "t"), keep_empty=True), df)
    assert [r.s for r in back.orderBy("k").collect()] == odd
    assert rows(content_digest(back)) != rows(content_digest(back.replace("ü", "u")))


def test_write_table_replaces_and_sorts(spark, tmp_path):
    path = str(tmp_path / "table")
    for n in (5, 3):
        df = spark.range(n).select(F.col("id").alias("k"), (-F.col("id")).alias("p"))
        writers.write_table(df, path, sort_by=["k", "p"])
    assert rows(readers.read_table(spark, path)) == [(0, 0), (1, -1), (2, -2)]


def test_views(spark):
    writers.register_views({"v_some_view": spark.range(3)})
    assert readers.read_table(spark, "v_some_view").count() == 3


def test_written_keeps_special_values(spark):
    df = spark.createDataFrame([(float("nan"), -0.0, None), (float("inf"), 1.0, "s")], "a double, b double, c string")
    assert str(rows(written(df), "b")) == str(rows(df, "b"))


def test_texts_are_written_and_put_together_by_many_tasks(spark, tmp_path, monkeypatch):
    """A table of several read blocks becomes several CSV files, and no text is shuffled by its file alone."""
    docs = [(i, "a" if i % 3 else None, f"line {i}\n" * 40 + 'x"y') for i in range(4000)]
    spark.createDataFrame(docs, "doc_id long, lang string, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "scratch_folder", lambda _: f"{tmp_path}/scratch")
    monkeypatch.setattr(queries, "WRITE_BLOCK", 50_000)
    found = {r.lang: (r.rows, r.characters, r.differing, r.several_blocks)
             for r in queries.csv_quoted_breaks(spark, str(tmp_path)).collect()}
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None
    want = {lang: sum(len(t) + 18 for _, x, t in docs if x == lang) for lang in ("a", None)}
    assert {k: v[1:] for k, v in found.items()} == {k: (n, 0, True) for k, n in want.items()}
    assert len(list((tmp_path / "scratch" / "texts").glob("*.csv"))) > 1
    by_file = re.findall(r"Exchange hashpartitioning\(_file#\d+, \d+\).*\n.*", plan(readers.csv_records(spark, f"{tmp_path}/scratch/texts")[0]))
    assert by_file and not any("value#" in x for x in by_file)


def test_small_blocks_share_tasks(spark, tmp_path, monkeypatch):
    """Of many blocks of 100 KB a task reads several, and what is stored on the way isn't read in such blocks."""
    docs = [(i, "a", f"line {i} x\n" * 500 + 'x"y') for i in range(1500)]
    spark.createDataFrame(docs, "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "scratch_folder", lambda _: f"{tmp_path}/scratch")
    spark.sparkContext.setJobGroup("small blocks", "")
    try:
        [found] = queries.csv_quoted_breaks(spark, str(tmp_path)).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert (found.rows, found.characters, found.differing, found.several_blocks) == (1500, sum(len(t) + 18 for *_, t in docs), 0, True)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(k) for j in tracker.getJobIdsForGroup("small blocks") for k in tracker.getJobInfo(j).stageIds]
    blocks = sum(f.stat().st_size for f in (tmp_path / "scratch" / "texts").glob("*.csv")) // 100_000
    assert blocks > 80 and max(s.numTasks for s in stages if s) < 40


def test_blocks_in_one_task_keep_their_places(spark, tmp_path, blocks):
    data = odd_fields(11, 400)
    for k in range(2):
        with open(tmp_path / f"part-{k}.csv", "w", newline="") as f:
            csv.writer(f, lineterminator="\n").writerows([("k", "text", "more"), *data[k::2]])
    plain = sorted(tuple(r) for r in readers.read_csv(spark, str(tmp_path)).collect())
    found = readers.read_csv(spark, str(tmp_path), ordered=True, block=50)
    assert sorted(tuple(r)[:3] for r in found.collect()) == plain == sorted(data)
    assert [tuple(r)[:3] for r in found.orderBy(*readers.FILE_ORDER).collect()] == [*data[::2], *data[1::2]]
    assert found.select("_block").distinct().count() > 100
    blocks(50)
    lines = readers.file_lines(spark, str(tmp_path))
    assert readers.in_fewer_tasks(spark, lines).rdd.getNumPartitions() <= max(2 * spark.sparkContext.defaultParallelism, 1) < lines.rdd.getNumPartitions()
