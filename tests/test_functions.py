import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from folioflow.functions import dates, flags, media, text as T
from folioflow.settings import Site


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_title_sort(spark):
    rows = [("abesanji", "Sanji Abe"), ("Sanji Abe", "Sanji Abe"), ("", "Sanji Abe"), ("", "The Title"), ("", "the Title"),
            (None, "a"), ("", "An É-1 b"), ("", "the the end")]
    out = values(spark, rows, "s string, t string", T.title_sort("s", "t"))
    assert out == ["abesanji", "sanjiabe", "sanjiabe", "thetitle", "title", "a", "ané1b", "theend"]


def test_none_strip(spark):
    rows = [(None,), ("  a b\n\x1c",), ("",)]
    assert values(spark, rows, "x string", T.none_strip("x")) == ["", "a b", ""]


def test_image_id(spark):
    name = "en-archivepd-i37-00239-1"
    rows = [(f"{name}.jpg",), (f"/mediawiki/images/thumb/a/a1/{name}.jpg/200px-{name}.jpg",), (".jpg",), ("a..jpg",), ("x",),
            ("thumb.jpg",), ("/thumb.jpg",), ("a/",)]
    assert values(spark, rows, "u string", T.image_id("u")) == [name, name, ".jpg", "a.", "x", "", "", ""]


def test_fix_external_url(spark):
    base = "http://repository.example.org"
    rows = [("http://lib.example.org/sn83025333",), (base + "/ddr-test-67-19/",), (base + "/ddr/test/67/19/",), ("see " + base + "/ddr/test/67/19/",)]
    out = values(spark, rows, "u string", T.fix_external_url("u", base))
    assert out == ["http://lib.example.org/sn83025333", base + "/ddr-test-67-19/", base + "/ddr-test-67-19/", rows[3][0]]


def test_str_to_bool(spark):
    rows = [("Yes",), ("ON",), ("1",), ("off",), ("0",), ("F",), ("maybe",), (None,)]
    assert values(spark, rows, "x string", T.str_to_bool("x")) == [True, True, True, False, False, False, None, None]
    with pytest.raises(PySparkException):
        values(spark, [("maybe",)], "x string", T.str_to_bool("x", strict=True))


def test_url_title(spark):
    rows = [("http://www.example.org/Tule%20Lake/?a=1#x",), ("/A/B;p=1",), ("Foo",), ("https://h",), ("50%+%C3%A9",)]
    out = spark.createDataFrame(rows, "u string").select(T.url_title("u").alias("t")).select("t", T.url_unquote("t")).collect()
    assert [tuple(r) for r in out] == [
        ("Tule%20Lake", "Tule Lake"), ("AB", "AB"), ("Foo", "Foo"), ("", ""), ("50%+%C3%A9", "50%+é"),
    ]


def test_href_title(spark):
    rows = [("/wiki/A/B/",), ("/A",), ("",), ("/",), ("http://x/wiki/C",)]
    assert values(spark, rows, "h string", T.href_title("h", "/wiki")) == ["A/B", "A", "", "", "http://x/C"]


def test_replace_domain(spark):
    df = spark.createDataFrame([("http://old.org/a", None)], "display string, original string")
    assert tuple(T.replace_domain(df, "old.org", "new.org:80").first()) == ("http://new.org/a", None)
    assert tuple(T.replace_domain(df, "", "new.org").first()) == ("http://old.org/a", None)


def test_join_path(spark):
    rows = [("a", "b"), ("a/", "b"), ("a", "/b"), ("", "b")]
    assert values(spark, rows, "x string, y string", T.join_path("x", "y")) == ["a/b", "a/b", "/b", "b"]


def test_absolute_url_and_small_helpers(spark):
    df = spark.createDataFrame([("X", ["a", "b"], [])], "t string, l array<string>, e array<string>")
    row = df.select(T.absolute_url("author", "t"), T.unwrap_single("l"), T.unwrap_single("e"), T.first_letter(F.lit("éa"))).first()
    assert tuple(row) == ("/authors/X/", "a", None, "É")


def test_dates(spark):
    d = datetime.datetime
    cases = {
        "2012-08-29T10:11:12Z": d(2012, 8, 29, 10, 11, 12),
        "2012-08-29 10:11:12.5": d(2012, 8, 29, 10, 11, 12, 500000),
        "2012-08-29T10:11": d(2012, 8, 29, 10, 11),
        "2012-8-9": d(2012, 8, 9),
        "20120829T101112": d(2012, 8, 29, 10, 11, 12),
        "8/29/2012 1:02": d(2012, 8, 29, 1, 2),
        "29 August 2012": d(2012, 8, 29),
        "Wed, 29 Aug 2012 10:11:12 GMT": d(2012, 8, 29, 10, 11, 12),
        "Aug 29, 2012": d(2012, 8, 29),
        "8/5/2013 3:30 PM": d(2013, 8, 5, 15, 30),
        "June 5, 2013 12:30 am": d(2013, 6, 5, 0, 30),
        "5 June 2013, 12:00:01 p.m.": d(2013, 6, 5, 12, 0, 1),
        "8/5/2013 13:30 PM": None,
        "5 June 2013 10:11 +09:00": d(2013, 6, 5, 10, 11),
        "Mon Aug 5 10:11:12 2013": d(2013, 8, 5, 10, 11, 12),
        "5 June 2013 garbage": None,
        "8/29/2012x": None,
        "2012-13-45": None,
        "soon": None,
    }
    assert values(spark, [(k,) for k in cases], "t string", dates.lenient_ts("t")) == list(cases.values())
    rows = [("2012-08-29T10:11:12Z",), ("2012-08-29 10:11:12",)]
    assert values(spark, rows, "t string", dates.revision_ts("t")) == [d(2012, 8, 29, 10, 11, 12), None]
    stamps = [(d(2012, 8, 29, 10, 11, 12),), (d(2012, 8, 29, 10, 11, 12, 5),)]
    assert values(spark, stamps, "t timestamp_ntz", dates.iso_text("t")) == ["2012-08-29T10:11:12", "2012-08-29T10:11:12.000005"]
    assert values(spark, stamps, "t timestamp_ntz", dates.record_text("t")) == ["2012-08-29T10:11:12"] * 2


def test_published(spark):
    rows = [([("Published",), ("Camps",)],), ([("Camps",)],), ([("published",)],), ([],), (None,)]
    out = values(spark, rows, "c array<struct<`*`: string>>", flags.is_published("c"))
    assert out == [True, False, False, False, False]


def test_coordinates(spark):
    box = '<div id="databox-Camps">\n<p>\nGISLat: 41.8833;\nGISLng: -121.3667;\nGISTGNId: 2012922;\n</p>\n</div>'
    rows = [("Just some random text",), (box,), (box.replace("databox-Camps", "other"),), (box + "GISLat: 1.5; GISLong: 2.5",), (box + "GISLat: 0.0;",)]
    out = values(spark, rows, "t string", flags.coordinates("t"))
    assert [tuple(x) if x else None for x in out] == [None, (-121.3667, 41.8833), None, (2.5, 1.5), None]


def test_media_columns(spark):
    site = Site(sources_url="https://s/media/sources/", sources_base="/m/sources")
    df = spark.createDataFrame([("https://s/media/sources/a/x.jpg",), ("https://s/media/sources/sources/x.jpg",), ("",), (None,)], "original string")
    out = df.select(*[c.alias(n) for n, c in media.media_columns("original", site).items()]).collect()
    assert [tuple(r) for r in out] == [
        ("x.jpg", "https://s/media/sources/a/x.jpg", "a/x.jpg", "/m/sources/a/x.jpg"),
        ("x.jpg", "https://s/media/sources/sources/x.jpg", "sources/x.jpg", "/m/sources/x.jpg"),
        ("", "", "", ""),
        ("", "", "", ""),
    ]
