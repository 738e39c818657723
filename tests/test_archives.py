"""Archives, workbooks, mappings and text rules against hand-made input."""

import re
import zipfile

import pytest
from pyspark.sql import functions as F

from sparkloom.operators import extraction, layout
from sparkloom.operators.mapping import Constant, Either, Joined, Json, Many, Record, Text, Value, map_records
from sparkloom.sources import archives
from tests.conftest import canonical


@pytest.fixture
def formats(spark):
    return archives.register(spark)


def test_zipped_csv_reads_members_by_header_name(formats, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("one.csv", "﻿Building Id;statutDA;Surface (m2)\r\n1;ok; 12 \r\n2;\"a;\"\"b\"\"\nc\";\r\n3\r\n\r\n".encode())
        z.writestr("notes.pdf", b"not a table")
        z.writestr("sub/two.tsv", "statutDA\tmore\tBuilding Id\nx\ty\t9\n")
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("empty.csv", "")
    read = formats.read.format("zipped_csv").load(str(tmp_path))
    assert read.columns == ["archive", "member", "building_id", "statut_da", "surface_m2"]
    rows = canonical(read.drop("archive").collect())
    assert rows == canonical([("one.csv", "1", "ok", "12"), ("one.csv", "2", 'a;"b"\nc', None), ("one.csv", "3", None, None), ("sub/two.tsv", "9", "x", None)])
    assert read.rdd.getNumPartitions() == 3
    wanted = formats.read.format("zipped_csv").options(columns="statut_da,absent", ragged="skip").load(str(tmp_path))
    assert canonical(wanted.select("statut_da", "absent").collect()) == canonical([("ok", None), ('a;"b"\nc', None), ("x", None)])
    assert formats.read.format("zipped_csv").option("columns", "a").load("file:" + str(tmp_path / "b.zip")).count() == 0


def workbook(path, sheets, shared=(), styles=""):
    main, rel = archives.MAIN[1:-1], "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x">' + "".join(f'<Relationship Id="r{i}" Target="{"/xl/" if i else ""}worksheets/s{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">' + "".join(f"<si>{s}</si>" for s in shared) + "</sst>")
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}">{styles}</styleSheet>')
        for i, rows in enumerate(sheets.values()):
            z.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="{main}"><sheetData>{rows}</sheetData></worksheet>')


def test_workbook_cells(formats, tmp_path):
    styles = '<numFmts><numFmt numFmtId="170" formatCode="dd/mm/yyyy"/><numFmt numFmtId="171" formatCode="&quot;day&quot;0"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs>'
    first = '<row r="2"><c r="B2" t="s"><v>0</v></c><c r="D2" t="s"><v>1</v></c></row><row r="4"><c r="B4" s="1"><v>45292</v></c><c r="C4" s="2"><v>45292.5</v></c><c r="D4" s="3"><v>7</v></c><c r="AA4" t="b"><v>1</v></c></row><row><c t="inlineStr"><is><t>x</t></is></c><c/><c t="str"><f>1</f><v>y</v></c></row>'
    workbook(tmp_path / "w.xlsx", {"2024": first, "leer": ""}, ("<t>Name</t>", "<r><t>Ric</t></r><r><t>h</t></r><rPh><t>no</t></rPh>"), styles)
    cells = formats.read.format("xlsx_cells").load(str(tmp_path))
    assert canonical(cells.drop("file").collect()) == canonical(
        [("2024", 2, 2, "Name"), ("2024", 2, 4, "Rich"), ("2024", 4, 2, "2024-01-01"), ("2024", 4, 3, "2024-01-01 12:00:00"), ("2024", 4, 4, "7"), ("2024", 4, 27, "true"), ("2024", 5, 1, "x"), ("2024", 5, 3, "y")]
    )
    rows = layout.grid_rows(cells, "sheet", "row", "col", "value", "Name").where("row = 4").collect()
    assert rows[0].fields == {"Name": "2024-01-01", "Rich": "7"}


def test_archives_round_trip_and_add_up(formats, tmp_path):
    df = formats.range(500).select(F.col("id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit('é;"\n'), "id")).alias("Some Text"))
    for kind in ("zipped_csv", "xlsx_cells"):
        path = str(tmp_path / kind)
        for part in (0, 1):
            df.where(F.col("id") % 2 == part).repartition(2).write.format(kind).mode("append").save(path)
        read = formats.read.format(kind).load(path)
        if kind == "xlsx_cells":
            grid = layout.grid_rows(read, "file", "row", "col", "value", "id")
            read = grid.select(grid.fields["id"].alias("id"), F.try_element_at("fields", F.lit("Some Text")).alias("some_text"))
        assert canonical(read.select("id", "some_text").collect()) == canonical([(str(r.id), r["Some Text"]) for r in df.collect()])


RECORDS = [
    '{"id": 7, "listing": {"prices": {"rent": {"value": "1200.5"}}, "title": {"de": "Haus", "fr": " "}, "address": {"street": "", "locality": "Nyon"}, "images": [{"url": "a"}, {}, {"url": " "}, {"n": 2}]}, "agents": []}',
    '{"Ref No.": "R-1", "card": {"price": 5}, "title": "plain", "images": [], "agents": [{"first": "A", "mobile": "1"}, {"x": 1}], "dates": {"days": 30}}',
    '{"id": "", "title": "no id"}',
    "not json",
    None,
]
MAPPING = {
    "id": Value(("id", "Ref No.")),
    "price": Value(("$.card.price", "$.listing.prices.rent.value"), "double"),
    "title": Text(("$.listing.title", "title"), ("fr", "en")),
    "address": Record({"street": Value(("street",)), "city": Value(("locality",)), "land": Constant("CH")}, "$.listing.address"),
    "images": Many(("$.listing.images", "images"), Record({"url": Value(("url",)), "n": Value(("n",), "int")})),
    "agent": Json(Many(("agents",), Record({"name": Joined((Value(("first",)), Value(("last",))), " "), "phone": Value(("phone", "mobile"))}))),
    "until": Either((Value(("$.dates.until",)), Value(("$.dates.days",), clean=lambda c: F.concat(c, F.lit(" days"))))),
    "source": Constant("portal"),
    "state": Value(("state",), default="online"),
    "object": Value(("listing",)),
}


def test_mapping_of_nested_records(spark):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(RECORDS)], "row int, json string")
    rows = {r.row: r.asDict(recursive=True) for r in map_records(df, "json", MAPPING, keep=("row",)).collect()}
    assert rows[0] == {
        "row": 0, "id": "7", "price": 1200.5, "title": "Haus", "address": {"street": None, "city": "Nyon", "land": "CH"}, "images": [{"url": "a", "n": None}, {"url": None, "n": 2}],
        "agent": None, "until": None, "source": "portal", "state": "online", "object": None,
    }
    assert rows[1] == {"row": 1, "id": "R-1", "price": 5.0, "title": "plain", "address": None, "images": None, "agent": '[{"name":"A","phone":"1"}]', "until": "30 days", "source": "portal", "state": "online", "object": None}
    assert [rows[i]["id"] for i in (2, 3, 4)] == [None, None, None] and rows[3]["title"] is None
    assert {r.row for r in map_records(df, "json", MAPPING, keep=("row",), required=("id",)).collect()} == {0, 1}


NOTICE = (
    "Aliénateurs: Dupont Jean, à Bulle; acquéreuse: Favre Anne; No 496, route du Tot 13; terrain de 1'234 m2 (acquis le 06.03.98). "
    "Veräusserer: Muster AG ; Erwerber: Meier; art. 12-3 PPE, Bahnhofstrasse 5a, 85 m²"
)
PERMIT = "AVIS D'ENQUÊTE No CAMAC 123456 Parcelle(s) 12, 345 chemin des Prés 4"


def test_fields_of_notices(spark):
    df = spark.createDataFrame([(1, NOTICE), (2, PERMIT), (3, None), (4, "")], "id int, text string")
    rows = {r.id: r.found for r in extraction.extract(df, "text", extraction.NOTICES).collect()}
    found = lambda i: [(f.field, f.value) for f in rows[i]]
    assert found(1) == [
        ("seller", "Dupont Jean, à Bulle"), ("buyer", "Favre Anne"), ("parcel", "496"), ("address", "route du Tot 13"), ("surface", "1'234"), ("acquired", "06.03.98"),
        ("seller", "Muster AG"), ("buyer", "Meier"), ("share", "12-3"), ("address", "Bahnhofstrasse 5a"), ("surface", "85"),
    ]
    assert found(2) == [("permit_type", "AVIS D'ENQUÊTE"), ("permit", "123456"), ("parcel", "12, 345"), ("address", "chemin des Prés 4")]
    assert rows[3] == rows[4] == []
    for i, text in ((1, NOTICE), (2, PERMIT)):
        assert all(f.value in text[f.start : f.stop] for f in rows[i])
    assert spark.range(1).select(extraction.surface(F.lit("1'234"))).first()[0] == 1234


def test_overlaps_go_by_priority_then_place_then_length(spark):
    rules = (extraction.Rule("a", "b+", 1), extraction.Rule("c", "ab", 0, exact=True), extraction.Rule("d", "bb(?P<value>x?)", 1), extraction.Rule("e", "x+y", 1))
    df = spark.createDataFrame([("abbb bbxxy AB",)], "text string").withColumn("rule", F.lit(1))
    row = extraction.extract(df, "text", rules).first()
    assert [(f.field, f.value, f.start) for f in row.found] == [("c", "ab", 0), ("d", "x", 5), ("a", "B", 12)] and row.rule == 1


def test_case_numbers_people_status_and_grade(spark):
    cases = [({"Dossier no": " 12 ", "affaire": ""}, "Affaire X/9"), ({"x": "1"}, "Réf. : AB-1, puis Requête n° 2024/7"), ({"référence interne": "z"}, "rien"), ({"la référence": "z"}, "rien"), (None, "Dossier n° 5.1")]
    df = spark.createDataFrame(cases, "fields map<string,string>, text string")
    assert [r.case for r in extraction.case_number(df, "text", "fields").collect()] == ["12", "2024/7", "z", None, "5.1"]
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(extraction.people(F.lit("M. Peter Etter et Mme Ann Muller, Dr. Lee & Co"))) == ["Peter Etter", "Ann Muller", "Lee", "Co"]
    assert [one(extraction.permit_status(F.lit(x))) for x in ("AVIS D’ENQUETE (P)", "Permis délivré", "PERMIS DE DEMOLIR", "autre", None)] == ["pendant", "accordé", "accordé", None, None]
    grades = [("Full-time", "intern"), (None, "Internship"), ("", "permanent"), ("PART", None), (None, "freelancer"), (None, None)]
    assert [one(extraction.employment_grade(F.lit(a), F.lit(b))) for a, b in grades] == ["full_time", "internship", "full_time", "part_time", "freelance", None]


def test_rules_agree_with_plain_patterns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    for r in extraction.extract(docs, "text", (extraction.Rule("n", r"\d{3,}"),)).collect():
        assert [f.value for f in r.found] == re.findall(r"\d{3,}", r.text)
