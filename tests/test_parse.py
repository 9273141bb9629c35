"""Literal cases for the text parsers and label functions."""

from random import Random

import pytest
from pyspark.sql import functions as F

from marquee.functions import parse, text
from marquee.sources import pages


@pytest.mark.parametrize("make, cases", [
    (parse.na_to_null, {"a": "a", "": None, "N/A": None, None: None}),
    (parse.parse_money, {"$1,234": 1234, "N/A": None, "": None, "$12.5": None, " $5 ": 5, "1_000": None, None: None}),
    (parse.parse_minutes, {"142 min": 142, "  90 min": 90, "1,200 min": None, "142min": None, "N/A": None, " ": None}),
    (parse.parse_digits, {"2019": 2019, "2019-2021": None, "N/A": None, " 7": None, "2019\n": None, "99999999999": None}),
    (parse.parse_rating, {"7.5": 7.5, "8": 8.0, ".5": 0.5, "5.": 5.0, "1.2.3": None, ".": None, "1d": None, "N/A": None}),
    (parse.parse_votes, {"1,234,567": 1234567, "N/A": None, None: None, "12": 12}),
    (parse.parse_number, {"1,234": 1234.0, "1e3": 1000.0, " 7 ": 7.0, "-2.5": -2.5, "1d": None, "nan": None, "inf": None, "N/A": None}),
    (lambda c: text.nth_label(c, 1), {"a, b ,c": "b", "a": None, None: None, "a,": ""}),
    (lambda c: text.contains_text(c, "marvel"), {"MARVEL Studios": True, "Toho": False, None: False}),
    (text.strip, {"\t a b \n": "a b", "\xa0x": "x"}),
])
def test_scalar_functions(value_of, make, cases):
    assert value_of(make, list(cases)) == list(cases.values())


def test_slugify(value_of):
    got = value_of(text.slugify, ["Amélie", "Spider-Man: No  Way Home", "Ⅳ Über", None, "a\nb"])
    assert got == ["Amelie", "Spider-Man-No-Way-Home", "IV-Uber", None, "a-b"]


AWARDS = {
    "Won 3 Oscars. 56 wins & 30 nominations total": (56, 30, 56, 0, 0, 0),
    "Nominated for 2 Oscars. 10 wins & 20 nominations total": (10, 20, 10, 2, 0, 0),
    "1 win & 1 nomination": (1, 0, 0, 0, 0, 0),
    "Nominated for 1 BAFTA Award28 nominations total": (0, 28, 0, 0, 0, 1),
    "5 wins & 7 nominations": (5, 7, 0, 0, 0, 0),
    "Won 1 BAFTA Award4 wins & 9 nominations total": (4, 9, 0, 0, 4, 0),
    "12 wins before the Oscars, 3 wins after": (3, 0, 3, 0, 0, 0),
    "N/A": (0,) * 6, "": (0,) * 6, None: (0,) * 6,
}


def test_awards(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(AWARDS)], "i int, awards string")
    got = rows.select("i", *parse.award_columns("awards")).orderBy("i").drop("i").collect()
    assert [tuple(r) for r in got] == list(AWARDS.values())


def test_ratings(spark):
    source = "array<struct<Source:string,Value:string>>"
    rows = spark.createDataFrame([
        (0, [("Rotten Tomatoes", "85%"), ("Metacritic", "76/100")]),
        (1, [("Rotten Tomatoes", "n/a")]),
        (2, None),
        (3, [("Rotten Tomatoes", "10%"), ("Rotten Tomatoes", "x%"), ("Metacritic", "9/10"), ("Metacritic", "bad")]),
        (4, []),
    ], f"i int, r {source}")
    got = rows.select("i", parse.rotten_tomatoes("r"), parse.metacritic("r")).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [(85, 76), (None, None), (None, None), (10, 9), (None, None)]


def test_label_split_keeps_spacing_before_a_comma(spark):
    row = spark.sql("SELECT 'a , b,c' AS c").select(text.split_labels("c"), text.stripped_labels("c")).first()
    assert row[0] == ["a ", "b", "c"] and row[1] == ["a", "b", "c"]


def test_page_table(spark):
    from marquee.sources import pages

    html = {
        "two tables": "<TABLE><tr><td>x</td><td>1</td></tr></TABLE><table><tr><th>h</th></tr>"
                      "<tr><td> Production Budget</td><td>$5,000</td></tr><tr><td>a</td><td>b</td><td>c</td></tr>"
                      "<tr><td>Opening Weekend</td><td><b>$10</b></td></tr></table>",
        "none": "<p>Production Budget</p>",
        "repeat": "<table><tr><td>Production Budget</td><td>1</td></tr><tr><td>Production Budget</td><td>2</td></tr></table>",
        "pieces": "<table><tr><td>&nbsp;Production <i>Budget</i> </td><td><!-- x -->$ <b> 7</b>&amp;8</td></tr></table>",
        "null": None,
    }
    rows = spark.createDataFrame(list(html.items()), "k string, html string")
    got = {r["k"]: r["v"] for r in rows.select("k", pages.label_values("html").alias("v")).collect()}
    assert got["two tables"] == {"Production Budget": "$5,000", "Opening Weekend": "$10"}
    assert got["none"] == {} and got["pieces"] == {"ProductionBudget": "$7&8"}
    assert got["repeat"] == {"Production Budget": "2"} and not got["null"]


def test_long_page(spark):
    """Long runs of spaces and a long cell need no deep recursion."""
    from marquee.sources import pages

    cell = "x" * 200_000
    html = f"<table><tr><td>{' ' * 50_000}Production Budget</td><td>{cell}</td></tr></table>"
    got = spark.createDataFrame([(html,)], "html string").select(pages.label_values("html").alias("v")).first()["v"]
    assert got == {"Production Budget": cell}


def test_candidate_without_year(spark):
    from marquee.sources import pages

    rows = spark.createDataFrame([(1, "Up!", 2009), (2, "Up!", None)], "movie_id int, title string, y int")
    got = pages.candidate_urls(rows, year=F.col("y")).orderBy("movie_id", "pos").select("movie_id", "pos", "url").collect()
    assert [(r[0], r[1], r[2].rsplit("/", 1)[1]) for r in got] == [
        (1, 0, "Up-(2009)"), (1, 1, "Up#tab=summary"), (2, 0, "Up#tab=summary")]


def test_first_hit_parses_each_page_once(spark):
    candidates = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c"), (3, 0, "b")], "movie_id bigint, pos int, url string")
    table = "<table><tr><td>Production Budget</td><td>$%d</td></tr></table>"
    landed = spark.createDataFrame([("a", "<p>none</p>"), ("b", table % 1), ("c", None), ("x", table % 2)], "url string, html string")
    hits = pages.first_hit(candidates, landed)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan
    assert sorted((r["movie_id"], r["url"], r["data"]["Production Budget"]) for r in hits.collect()) == [(1, "b", "$1"), (3, "b", "$1")]


def test_plain_pages_are_read_as_the_tokenizer_reads_them():
    pieces = ["<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", '<TD a="1">', "a", "b&amp", "&lt;", "<", " ", "<br/>", "<!-- x -->", "<b>",
              "</b>", "Production Budget", "<script>", "</script>", '</td x="1">', "<td a=b>", "<p a='<'>", "<table ", "<title>", '<tr\n b="2" >']
    random = Random(7)
    for _ in range(3000):
        html = "<table>" * random.randint(0, 1) + "".join(random.choices(pieces, k=random.randint(2, 25)))
        fed, read = pages._Tables(), pages._Tables()
        fed.feed(html)
        fed.close()
        read.read(html)
        assert [t.rows for t in fed.tables] == [t.rows for t in read.tables] and [t.text for t in fed.tables] == [t.text for t in read.tables], html
