import csv
import io
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sievework.operators import contacts as ops
from sievework.plans.qualify import prepared
from sievework.sinks.results import write_results_csv
from sievework.sources.contacts import land_contacts, normalise_columns, read_contacts
from sievework.sources.records import csv_records, ends_inside


def write(path, text):
    path.write_bytes(text.encode())
    return str(path)


CSV = (
    " Name ,COMPANY,Website,Linkedin URL,Deal Size\n"
    'Ann,"Acme, Inc",acme.com,,10\n'
    "NA,null,,,\n"
    'Bob,"line one\nline two"," x.com ",https://l/in/bob,"say ""hi"""\n'
    "\n"
    "Cid,Short\n"
    "  Dee  ,,,https://l/in/dee,é\n"
)


def test_every_field_is_text(spark, tmp_path):
    contacts, quarantined = read_contacts(spark, write(tmp_path / "c.csv", CSV))
    assert contacts.columns == ["name", "company", "website", "linkedin_url", "deal_size"]
    assert [tuple(r) for r in contacts.collect()] == [
        ("Ann", "Acme, Inc", "acme.com", "", "10"),
        ("NA", "null", "", "", ""),
        ("Bob", "line one\nline two", " x.com ", "https://l/in/bob", 'say "hi"'),
        ("Cid", "Short", "", "", ""),
        ("  Dee  ", "", "", "https://l/in/dee", "é"),
    ]
    assert quarantined.collect() == []


def test_over_long_rows_are_quarantined(spark, tmp_path):
    text = 'name,company,website\na,b,c\na,b,c,d\na,b,,\n"x,y",b,"c"\ns,t\na,b,c,\n'
    contacts, quarantined = read_contacts(spark, write(tmp_path / "c.csv", text))
    assert [tuple(r)[:3] for r in contacts.collect()] == [("a", "b", "c"), ("x,y", "b", "c"), ("s", "t", "")]
    assert [r["name"] for r in contacts.select("name").collect()] == ["a", "x,y", "s"]
    assert contacts.count() == 3
    assert sorted(r["record"].strip() for r in quarantined.collect()) == ["a,b,,", "a,b,c,", "a,b,c,d"]


def test_header_problems(spark, tmp_path):
    with pytest.raises(ValueError, match="same after normalisation"):
        read_contacts(spark, write(tmp_path / "a.csv", "name,company,Website,website \na,b,c,d\n"))
    with pytest.raises(ValueError, match="required columns.*company"):
        read_contacts(spark, write(tmp_path / "b.csv", "name,website\na,b\n"))
    with pytest.raises(ValueError, match="same after"):
        normalise_columns(spark.createDataFrame([(1, 2)], ["a b", "A_B"]))


def test_optional_columns_and_bom(spark, tmp_path):
    contacts, _ = read_contacts(spark, write(tmp_path / "c.csv", "﻿name,company\na,b\n"))
    assert [r.asDict() for r in contacts.collect()] == [{"name": "a", "company": "b", "website": "", "linkedin_url": ""}]


def test_landing_numbers_rows_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(3):
        write(folder / f"{i}.csv", "name,company,website\n" + "".join(f"n{i}{j},c,w.com\n" for j in range(4)))
    landed = land_contacts(spark, str(folder), str(tmp_path / "out"))
    first = {r["name"]: r["contact_id"] for r in landed.collect()}
    assert len(set(first.values())) == 12
    assert first == {r["name"]: r["contact_id"] for r in landed.repartition(5).collect()}


def test_split_keeps_every_row_once(spark):
    urls = ["", " ", "\t\xa0", "a.com", None]
    rows = [(i, "n", "c", w, u) for i, (w, u) in enumerate((w, u) for w in urls for u in urls)]
    df = spark.createDataFrame(rows, "contact_id long, name string, company string, website string, linkedin_url string")
    kept, skipped = ops.kept(df), ops.skipped(df)
    assert {r["contact_id"] for r in kept.collect()} == {i for i, *_, w, u in rows if "a.com" in (w, u)}
    assert kept.count() + skipped.count() == len(rows)
    assert ops.with_website(df).count() == 5 and ops.with_profile_url(df).count() == 5


def test_result_columns_must_not_be_there_yet(spark):
    df = spark.createDataFrame([(1, "n", "c", "w", "u", 3)], "contact_id long, name string, company string, website string, linkedin_url string, s1_score int")
    with pytest.raises(ValueError, match="s1_score"):
        prepared(df)


def test_csv_output_reads_back(spark, tmp_path):
    rows = [(1, 'q"uo,te', "two\nlines", True, 6.0), (2, None, "", False, 0.0)]
    df = spark.createDataFrame(rows, "contact_id long, name string, company string, hot_lead boolean, final_score double")
    write_results_csv(df.coalesce(1), str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("*.csv")
    assert part.read_text().startswith('"contact_id","name","company","hot_lead","final_score"\n')
    back = pd.read_csv(part, dtype=str, keep_default_na=False)
    assert back.values.tolist() == [["1", 'q"uo,te', "two\nlines", "True", "6.0"], ["2", "", "", "False", "0.0"]]


def random_csv(rng, n):
    def field():
        text = "".join(rng.choice(["a", "b", " ", "é", ",", '"', "\n", "\r\n", '""', "x" * 9]) for _ in range(rng.randint(0, 6)))
        if rng.random() < 0.5 or any(c in text for c in ',"\n\r'):
            return '"' + text.replace('"', '""') + '"'
        return text

    rows = [",".join(field() for _ in range(rng.choice([3, 3, 3, 3, 2, 1]))) for _ in range(n)]
    return "name,company,website\n" + "".join(r + rng.choice(["\n", "\r\n", "\n\n"]) for r in rows)


@pytest.mark.parametrize("seed,size", [(1, 64), (2, 333), (3, 900)])
def test_split_records_equal_a_sequential_read(spark, tmp_path, seed, size):
    rng = random.Random(seed)
    folder = tmp_path / "in"
    folder.mkdir()
    texts = [random_csv(rng, 150) for _ in range(2)]
    for i, text in enumerate(texts):
        write(folder / f"{i}.csv", text)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in before:
        spark.conf.set(k, str(size))
    try:
        contacts, quarantined = read_contacts(spark, str(folder))
        assert csv_records(spark, str(folder)).select(F.spark_partition_id()).distinct().count() > 4
        found = [sorted(map(tuple, df.collect())) for df in (contacts.select("name", "company", "website"), quarantined.select("record"))]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    whole = [r for text in texts for r in list(csv.reader(io.StringIO(text, newline="")))[1:] if r]
    assert found == [sorted(tuple((r + ["", ""])[:3]) for r in whole), []]


def test_quotes_inside_a_field_open_nothing(spark, tmp_path):
    text = 'name,company,website\n5" pipe,b,c\n"x"y,d "e,f\n"open, "" still\nopen" tail,g\n'
    contacts, _ = read_contacts(spark, write(tmp_path / "c.csv", text))
    assert [r["name"] for r in contacts.collect()] == ['5" pipe', '"x"y', '"open, " still\nopen" tail']
    for line, inside, want in [('a,"b', False, True), ('b",c', True, False), ('b"",c', True, True), ('a"b', False, False), ('x",""', True, False), ('""', True, True), ('"""', True, False), ('","', False, False)]:
        assert ends_inside(line, inside) is want, (line, inside)


def test_another_header_fails_the_read(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "0.csv", "name,company\na,b\n")
    write(folder / "1.csv", "company,name\nb,a\n")
    with pytest.raises(Exception, match="Another header"):
        read_contacts(spark, str(folder))[0].collect()


def test_a_large_file_of_broken_lines_is_read_by_many_tasks(spark, tmp_path):
    row = 'n,"' + "line\n" * 200 + '",w.com\n'
    path = write(tmp_path / "c.csv", "name,company,website\n" + row * 30_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2m")
    try:
        contacts, _ = read_contacts(spark, path)
        assert csv_records(spark, path).select(F.spark_partition_id()).distinct().count() >= 10
        got = contacts.groupBy("name", F.length("company").alias("n"), "website").count().collect()
        assert [tuple(r) for r in got] == [("n", 1000, "w.com", 30_000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
