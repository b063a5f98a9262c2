import pytest
from pyspark.sql import functions as F

from folioflow.functions import people

# One to four invented people; given names of one, two and three words.
PEOPLE = [["Okonkwo", "Mirela Ruth"], ["Vance", "Theo"], ["Ibarra", "Luz"], ["Quist", "Anneke Jo Mae"]]

# Worked out by hand from each style's rule, for the first one, two, three and four of them.
EXPECTED = {
    "apa": (
        "Okonkwo, Mirela Ruth.",
        "Okonkwo, Mirela R., and Vance, Theo.",
        "Okonkwo, Mirela R., Vance, Theo, and Ibarra, Luz.",
        "Okonkwo, Mirela R., Vance, Theo, Ibarra, Luz, and Quist, Anneke J. M.",
    ),
    "bibtex": (
        "Okonkwo, M. R.",
        "Okonkwo, M. R. and Vance, T.",
        "Okonkwo, M. R. and Vance, T. and Ibarra, L.",
        "Okonkwo, M. R. and Vance, T. and Ibarra, L. and Quist, A. J. M.",
    ),
    "chicago": (
        "Mirela Ruth Okonkwo.",
        "Mirela Ruth Okonkwo and Theo Vance.",
        "Mirela Ruth Okonkwo, Theo Vance and Luz Ibarra.",
        "Mirela Ruth Okonkwo et al.",
    ),
    "cse": (
        "Okonkwo M R.",
        "Okonkwo M R, Vance T.",
        "Okonkwo M R, Vance T, Ibarra L.",
        "Okonkwo M R, Vance T, Ibarra L, Quist A J M.",
    ),
    "mhra": (
        "Mirela Ruth Okonkwo.",
        "Mirela Ruth Okonkwo and Theo Vance.",
        "Mirela Ruth Okonkwo, Theo Vance and Luz Ibarra.",
        "Mirela Ruth Okonkwo and others.",
    ),
    "mla": (
        "Okonkwo, Mirela Ruth.",
        "Okonkwo, Mirela Ruth, and Theo Vance.",
        "Okonkwo, Mirela Ruth, Theo Vance, and Luz Ibarra.",
        "Okonkwo, Mirela Ruth, et al.",
    ),
}


def test_styles(spark):
    names = spark.createDataFrame([(i, n) for i, n in enumerate(PEOPLE[:k] for k in range(5))], "i int, names array<array<string>>")
    rows = names.select("i", *[people.cite(s, "names", "Nobody.").alias(s) for s in people.STYLES]).orderBy("i").collect()
    for style, expected in EXPECTED.items():
        assert [r[style] for r in rows] == ["Nobody.", *expected]


def test_styles_do_not_disturb_one_another(spark):
    names = spark.createDataFrame([(PEOPLE[:3],)], "names array<array<string>>")
    row = names.select(people.cite("mla", "names", "").alias("mla"), people.cite("cse", "names", "").alias("cse")).first()
    assert row.cse == EXPECTED["cse"][2] and row.mla == EXPECTED["mla"][2]


@pytest.mark.parametrize(
    "form, theo, anneke",
    [
        (people.surname_given, "Vance, Theo", "Quist, Anneke Jo Mae"),
        (people.surname_given_initials, "Vance, Theo", "Quist, Anneke J. M."),
        (people.given_surname, "Theo Vance", "Anneke Jo Mae Quist"),
        (people.surname_initials, "Vance, T.", "Quist, A. J. M."),
        (people.surname_initials_plain, "Vance T", "Quist A J M"),
    ],
)
def test_name_forms(spark, form, theo, anneke):
    names = spark.createDataFrame([(PEOPLE[1],), (PEOPLE[3],), (["Plume"],)], "n array<string>")
    assert [r[0] for r in names.select(F.expr(form("n"))).collect()] == [theo, anneke, "Plume"]


@pytest.mark.parametrize(
    "text, expected",
    [
        (" \t Vance, Theo \n", [["Vance", "Theo"]]),
        ("\nOkonkwo,Mirela Ruth; Ibarra,Luz", [["Okonkwo", "Mirela Ruth"], ["Ibarra", "Luz"]]),
        ("Quist, A and Plume, B", [["Quist", "A"], ["Plume", "B"]]),
        ("One, Two, Three", [["One, Two, Three"]]),
        ("Sand, A and Plume, B", [["S"], ["", "A"], ["Plume", "B"]]),
    ],
)
def test_parse_names(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(people.parse_names("t")).first()[0] == expected
