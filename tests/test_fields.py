"""Rules, labels, house style, maps of fields, geometry texts, sitemaps, logs, routing and work lists on hand-written records."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sparkloom.functions import records, rules, shapes, text, values
from sparkloom.operators import keyed, shape
from sparkloom.sources import feeds, files


def each(spark, column, inputs, kind="string"):
    """What ``column`` makes of each input, in order."""
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(column.alias("out")).collect()]


def test_property_type(spark):
    cases = {
        "Appartement en PPE, 4 pièces": "PPE", "part de COP": "COP", "Art. 12 B-F": "B-F", "ppe": None, "Terrain bâti": "terrain bati", "terrain  non bati": "terrain non bati",
        "une HABITATION individuelle et garage": "habitation individuelle", "Appartement, villa": "appartement", "Villa jumelle": "villa", "immeuble locatif": "immeuble",
        "zone rurale": "rural", "rural": "rural", "garages": None, "garage box": "garage", "place  de parc": "place de parc", "Chalet": "chalet", "parcelle 12": "parcelle",
        "part de copropriété simple": "COP", "Eigentumswohnung": "PPE", "Stockwerkeigentum": "PPE", "": None, None: None,
    }
    assert each(spark, rules.property_type(F.col("x")), list(cases)) == list(cases.values())


def test_portal_and_language(spark):
    refs = {"mig-12-3": "migrated", "AB1C-9Z9Z-123": "newhome", "AB1C-9Z9Z-123\n": "other", "ab1c-9z9z-123": "other", "17.5": "other", "": "unknown", None: "unknown"}
    assert each(spark, rules.portal(F.col("x"), "other"), list(refs)) == list(refs.values())
    rows = [("French", "ZH"), (None, "TI"), ("", "GR"), (None, "GE"), (None, None), ("DE-ch", "TI")]
    df = spark.createDataFrame(rows, "l string, c string").select(rules.canton_language(F.col("l"), F.col("c")))
    assert [r[0] for r in df.collect()] == ["fr", "it", "de", "fr", "fr", "de"]


def test_extra_properties(spark):
    given = ["2nd floor", "3e Étage", "disponible de suite", "Surface propriété: 820 m2", "surface utilisable env.", "Construit en 1987, 2001", "étage disponible"]
    found = each(spark, rules.extra_properties(F.col("x")), [given, [], None, [None]], "array<string>")
    assert tuple(found[0]) == ("étage disponible", "disponible de suite", 820, None, 1987)
    assert all(tuple(f) == (None,) * 5 for f in found[1:])


def test_labels(spark):
    truncated = {"zone de": True, "Zone liées à": True, "de": False, "accès pour les ": True, "lande": False, "": False, None: False}
    assert each(spark, rules.truncated_label(F.col("x")), list(truncated)) == list(truncated.values())
    noise = {"0 50 100 m": True, "- — ": True, "ab": True, "abc": False, "Légende générale": True, "1'000.5 m": True, "Commune de X": True, "zone 5": False, "": True, None: True}
    assert each(spark, rules.noise_label(F.col("x")), list(noise)) == list(noise.values())
    paragraphs = {"A. Belle": True, "a. belle": False, "Zones: ": True, "• zone": True, "- zone": True, "-zone": False, "12.5 – 14": True, "12 m": False, "oui? à voir encore.": True, None: False}
    assert each(spark, rules.paragraph_label(F.col("x")), list(paragraphs)) == list(paragraphs.values())


def test_house_style(spark):
    cases = {
        "a — b – c": "a - b - c",
        "quoi ? oui  !": "quoi? oui!",
        "1'500 CHF et 12.50 francs, 7 Franc": "CHF 1'500.- et CHF 12.50, CHF 7.-",
        "12.50 CHF CHF": "CHF 12.50 CHF",
        '<a class="x" href="https://www.rival.ch/p">voir</a> <a href="https://other.ch">là</a> <a href="/ici">ici</a>': 'voir <a href="https://other.ch" target="_blank" rel="noopener">là</a> <a href="/ici">ici</a>',
        '<a href="https://rivalxch/p">voir</a>': '<a href="https://rivalxch/p" target="_blank" rel="noopener">voir</a>',
        None: None,
    }
    assert each(spark, text.house_style(F.col("x"), ("rival.ch",)), list(cases)) == list(cases.values())


def test_without_phrases(spark):
    cases = {
        "Bonjour. Dis-moi que tu m'as vue sur Place ! \n\n\n\nÀ bientôt https://www.place.ch/ad/12?x=1) fin": "Bonjour.  \n\nÀ bientôt ) fin",
        "Incall: Je reçois en salon. Outcall : je ne me deplace pas.": None,
        "Tell me that you saw me on PLACE!": None,
        "Pour voir mes photos non censurées : ici": "ici",
        "  ": None,
        None: None,
    }
    assert each(spark, text.without_phrases(F.col("x"), "place"), list(cases)) == list(cases.values())


def test_html_fields(spark):
    html = "<b>Affaire</b>: A/12 &amp; B<br/>Lieu : Genève<BR >: ohne<br>leer:<br> <br>Lieu: Ville: basse<br>nichts"
    line = each(spark, records.html_lines(F.col("x")), [html, "", None])
    assert line == [["Affaire: A/12 & B", "Lieu : Genève", ": ohne", "leer:", "Lieu: Ville: basse", "nichts"], [], None]
    fields = each(spark, records.key_values(records.html_lines(F.col("x"))), [html, "", None])
    assert fields == [{"Affaire": "A/12 & B", "Lieu": "Ville: basse"}, {}, None]


def test_sections(spark):
    found = each(spark, records.sections(F.col("x"), r"Art\. [0-9]+"), ["vor Art. 1 eins Art. 2", "Art. 7x", "ohne", "", None])
    plain = [[tuple(r) for r in rows] if rows is not None else None for rows in found]
    assert plain == [[(0, None, "vor "), (1, "Art. 1", " eins "), (2, "Art. 2", "")], [(0, None, ""), (1, "Art. 7", "x")], [(0, None, "ohne")], [(0, None, "")], None]


def test_json_records(spark):
    assert each(spark, records.flat_labels(F.col("x")), ['{"fr": {"language": "fr", "value": "Genève"}, "de": {"language": "de"}}', "{", None]) == [{"fr": "Genève"}, {}, {}]
    ids = ['[{"building_id": "12/34-5", "floor": 2}, {"building_id": "9/9"}, {"floor": null}]', '{"a": 1}', "[1", "[]", None]
    first, *rest = each(spark, records.split_building_ids(F.col("x")), ids)
    assert json.loads(first) == [{"building_id": "12/34", "feuillet_number": "5", "floor": 2}, {"building_id": "9/9"}, {"floor": None}]
    assert rest == ids[1:]
    tidy = each(spark, records.tidy_record(F.col("x"), "cpv", "vendors"), ['{"id": 7, "cpv": [], "vendors": {"a": [1]}, "note": null, "tags": [], "t": "[x"}', '{"cpv": "[]", "vendors": {}}', "[1]", "", None])
    assert [json.loads(t) if t else t for t in tidy] == [{"id": 7, "vendors": '{"a":[1]}', "tags": [], "t": "[x"}, {"cpv": "[]"}, None, None, None]
    names = [[("FR", "Noël"), ("fr", "autre"), ("DE", None)], [], None]
    assert each(spark, records.by_language(F.col("x"), "fr"), names, "array<struct<language: string, text: string>>") == ["Noël", None, None]


def test_numbers_dates_and_points(spark):
    assert each(spark, values.prefix_integer(F.col("x")), [" 12,5 m2", "-3", "a1", "", None, "9" * 30]) == [12, -3, None, None, None, None]
    days = {"3/4/2024": "2024-04-03", " 13/12/2024 ": "2024-12-13", "2024-01-02": "2024-01-02", "1/2": "1/2", "003/4/24": "24-04-003", None: None}
    assert each(spark, values.day_first(F.col("x")), list(days)) == list(days.values())
    got = each(spark, values.candle_times(F.col("x"), F.lit(900_000)), [1_704_067_200_000, None], "bigint")
    assert [str(v) for v in got[0]] == ["2024-01-01 00:00:00", "2024-01-01 00:14:59.999000", "0", "1"] and got[1]["open_time"] is None
    today = F.lit("2024-03-31").cast("date")
    assert [str(d) for d in each(spark, values.fetch_from(F.col("x"), today, 30), [None, "2024-01-05", "2024-03-30"])] == ["2024-03-01", "2024-01-05", "2024-03-01"]
    bern = each(spark, values.swiss_point(F.col("x")), [["x", "2600000.0/1200000", "1/2"], ["2600000/12000"], None], "array<string>")
    assert abs(bern[0]["lon"] - 7.438637) < 1e-5 and abs(bern[0]["lat"] - 46.951081) < 1e-5 and bern[1:] == [None, None]
    assert each(spark, values.ewkt(values.swiss_point(F.col("x"))), [["2600000/1200000"]], "array<string>")[0].startswith("SRID=4326;POINT(7.43863")


def test_geojson(spark):
    square = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]
    hole = [[1.0, 1.0], [2.0, 1.0], [2.0, 2.0], [1.0, 2.0], [1.0, 1.0]]
    docs = [
        {"x": 7.5, "y": "46"}, {"rings": [square, hole]}, {"rings": [square[::-1][:-1]]}, {"rings": [square[:2]]}, {"rings": []}, {"paths": [[[0, 1], [2, 3]]]},
        {"z": 1}, {"x": None, "y": 2},
    ]
    found = each(spark, shapes.geojson(F.col("x")), [*map(json.dumps, docs), "{", "", None])
    polygon = lambda *rings: {"type": "Polygon", "coordinates": list(rings)}
    turned = each(spark, shapes.geojson(F.col("x")), [json.dumps({"rings": [square[::-1][:-1]]})])[0]
    assert [json.loads(f) if f else f for f in found[:2]] == [{"type": "Point", "coordinates": [7.5, 46.0]}, polygon(square, hole[::-1])]
    ring = json.loads(turned)["coordinates"][0]
    assert ring[0] == ring[-1] and sorted(ring[1:]) == sorted(square[1:]) and sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:], strict=False)) == 32
    assert json.loads(found[5]) == {"type": "MultiLineString", "coordinates": [[[0, 1], [2, 3]]]}
    assert found[3] is found[4] is None and found[6:] == [None] * 5


def test_geojson_turns_random_rings(spark):
    rng = random.Random(3)
    rings = [[[rng.randint(0, 9), rng.randint(0, 9)] for _ in range(rng.randint(3, 7))] for _ in range(80)]
    area = lambda r: sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1], strict=True)) / 2
    found = [json.loads(f)["coordinates"][0] for f in each(spark, shapes.geojson(F.col("x")), [json.dumps({"rings": [r]}) for r in rings])]
    assert [area(f) for f in found] == [abs(area(r)) for r in rings]


def test_sitemaps(spark, tmp_path):
    index = '<sitemapindex xmlns="s"><sitemap><loc>https://x.ch/new.xml</loc><lastmod>2024-05-02</lastmod></sitemap><sitemap><loc>https://x.ch/old.xml</loc><lastmod>2024-01-01T10:00:00Z</lastmod></sitemap><sitemap><loc>https://x.ch/undated.xml</loc></sitemap></sitemapindex>'
    page = lambda loc, more="": f"<url><loc> {loc} </loc>{more}</url>"
    files_ = {
        "index.xml": index,
        "new.xml": f"<urlset>{page('https://x.ch/fr/a', '<lastmod>2020-01-01</lastmod>')}{page('https://x.ch/de/b')}</urlset>",
        "old.xml": f"<urlset>{page('https://x.ch/fr/c')}</urlset>",
        "undated.xml": f"<urlset>{page('https://x.ch/fr/d')}{page('')}</urlset>",
        "flat.xml": '<urlset xmlns:news="n">'
        + page("https://x.ch/fr/e", "<lastmod>2020-01-01</lastmod><news:news><news:publication_date>2024-05-03</news:publication_date><news:title>E</news:title></news:news>")
        + page("https://x.ch/fr/f", "<lastmod>2020-01-01</lastmod>") + page("https://x.ch/fr/g", "<lastmod>soon</lastmod>") + "</urlset>",
    }
    for name, content in files_.items():
        (tmp_path / name).write_text(content)
    cutoff = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)
    found = feeds.read_sitemaps(spark, str(tmp_path), cutoff, r"/fr/")
    rows = sorted(tuple(r) for r in found.collect())
    assert rows == [("https://x.ch/fr/a", "", "2020-01-01"), ("https://x.ch/fr/d", "", None), ("https://x.ch/fr/e", "E", "2024-05-03"), ("https://x.ch/fr/g", "", "soon")]
    assert [r[0] for r in rows] == [f"https://x.ch/fr/{c}" for c in "adeg"]
    assert dict((r[0][-1], r[1:]) for r in rows) == {"a": ("", "2020-01-01"), "d": ("", None), "e": ("E", "2024-05-03"), "g": ("", "soon")}
    assert [r[0][-1] for r in feeds.read_sitemaps(spark, str(tmp_path), cutoff, r"/fr/", most=2).collect()] == ["e", "a"]


def test_log_grows(spark, tmp_path):
    path = str(tmp_path / "log")
    for i in (1, 2):
        files.append_jsonl_log(spark.createDataFrame([(i, None if i == 2 else "ok")], "run int, status string"), path)
    (tmp_path / "log" / "broken.json").write_text('{"run": 3, "sta\n{"run": 4, "status": "late"}\n')
    shape_ = StructType([StructField("run", LongType()), StructField("status", StringType())])
    assert sorted(tuple(r) for r in files.read_jsonl_log(spark, path, shape_).collect()) == [(1, "ok"), (2, None), (4, "late")]
    assert files.read_jsonl_log(spark, path).count() == 3


def test_routes(spark):
    one = spark.createDataFrame([(1,)], "a int")
    routes = {"plots": {"table": "Plots", "flat": "plots_flat", "renames": {"a": "id"}}, "roads": {"table": "Roads"}}
    found = files.routed({"plots": one, "roads": one}, routes)
    assert list(found) == ["Plots", "Roads"] and found["Plots"].columns == ["id"]
    assert list(files.routed({"plots": one, "roads": one}, routes, "flat")) == ["plots_flat"]
    with pytest.raises(ValueError, match="two sets"):
        files.routed({"plots": one, "roads": one}, {"plots": {"table": "T"}, "roads": {"table": "T"}})
    with pytest.raises(KeyError):
        files.routed({"lakes": one}, routes)


def test_work_list(spark):
    df = spark.createDataFrame([(i if i else None, i) for i in range(400)], "k int, v int")
    known = df.where("k < 300 OR k IS NULL").union(df.where("k < 5"))
    assert keyed.work_list(df, known, ["k"], "seed").count() == 400
    daily = keyed.work_list(df, known, ["k"], "daily", 0.2)
    rows = {(r["k"], r["is_new"]) for r in daily.collect()}
    again = {r["k"] for r in keyed.work_list(df, known, ["k"], "daily", 0.2).collect() if not r["is_new"]}
    assert {k for k, new in rows if new} == set(range(300, 400)) and {k for k, new in rows if not new} == again and 20 <= len(again) <= 110
    with pytest.raises(ValueError, match="mode"):
        keyed.work_list(df, known, ["k"], "weekly")


def test_writable(spark):
    df = spark.createDataFrame([(1, "x", 2)], "a int, `b.c` string, z int")
    out = shape.writable(df, ["country", "b.c", "a", "gone"], ("a",), country="CH")
    assert out.columns == ["country", "b.c"] and tuple(out.first()) == ("CH", "x")
    with pytest.raises(ValueError, match="not writable"):
        shape.writable(df, ["a"], ("a",), a=1)
