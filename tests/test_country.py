"""The country report on a small file, and on the full file where one is given.

``COUNTRY_STATISTICS`` names a copy of the full file: 227 lines, ``;`` separated,
decimal commas, ``.`` for missing values.
"""

import os

import pytest
from conftest import rows

from millrace.plans import country
from millrace.sources.readers import read_csv_header
from millrace.sources.schemas import POPULATION

LINES = """\
"Aland";"Aland";"AX";"ALA";"Europe";"Northern";TRUE;"40,5";"10,5";"yes";"no"
"Bland";"Bland";"NA";"NAM";"Africa";"Southern";FALSE;"20,5";.;"no";.
"Cland";"Cland";"CL";"PSE";"Africa";"Southern";FALSE;"18,5";"30,5";"no";"yes"
"Dland";"Dland";"DL";"PSE";"Africa";"Northern";FALSE;"19,5";"20,5";"no";"yes"
"Eland";"Eland";.;.;"Africa";"Northern";FALSE;"19,5";"20,5";"no";"yes"
"Fland";"Fland";"-";"-";"Africa";"Northern";.;"19,5";"20,5";"no";"yes"
"""


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("country") / "c.csv"
    path.write_text(LINES, encoding="utf-8")
    return country.load_countries(spark, str(path)).cache()


def test_load(small):
    got = small.select("iso_3166_2", "development", "age_median", "above_average_yu")
    assert rows(got) == [
        ("AX", "Developed", 40.5, False),
        ("CL", "Not Developed", 18.5, True),
        ("DL", "Not Developed", 19.5, True),
        ("NA", "Not Developed", 20.5, None),
    ]


def test_tables(small):
    tables = country.country_tables(small)
    assert rows(tables["region_bars"]) == [("Africa", "Not Developed", 3), ("Europe", "Developed", 1)]
    assert rows(tables["unemployment_means"]) == [
        ("Africa", "Northern", 20.5, 1, 1),
        ("Africa", "Southern", 30.5, 1, 2),
        ("Europe", "Northern", 10.5, 1, 1),
    ]
    for table in tables.values():
        assert table.count() > 0


def test_bubbles(spark, small, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("Country Name,Country.Code,X2020\nP,PSE,7\nA,ALA,5\n", encoding="utf-8")
    names = [field.split() for field in POPULATION.split(", ")]
    population = read_csv_header(
        spark,
        str(path),
        {"Country.Code": " ".join(names[0]), "X2020": " ".join(names[1])},
    )
    assert rows(country.population_bubbles(small, population)) == [
        ("Aland", 10.5, 40.5, "Developed", 5),
        ("Cland", 30.5, 18.5, "Not Developed", 7),
        ("Dland", 20.5, 19.5, "Not Developed", 7),
    ]


@pytest.mark.skipif("COUNTRY_STATISTICS" not in os.environ, reason="full country file not given")
def test_golden_numbers(spark):
    countries = country.load_countries(spark, os.environ["COUNTRY_STATISTICS"]).cache()
    assert countries.count() == 210
    tables = country.country_tables(countries)
    bars = {tuple(r)[:2]: r.n for r in tables["region_bars"].collect()}
    no, yes = "Not Developed", "Developed"
    assert bars == {
        ("Africa", no): 51,
        ("Americas", no): 41,
        ("Americas", yes): 5,
        ("Asia", no): 47,
        ("Asia", yes): 3,
        ("Europe", yes): 42,
        ("Oceania", no): 19,
        ("Oceania", yes): 2,
    }
    fit = {r.development: (r.slope, r.intercept, r.n) for r in tables["fit"].collect()}
    assert fit[yes] == pytest.approx((0.0619373709, 40.9777249470, 46), abs=1e-9)
    assert fit[no] == pytest.approx((0.0391117715, 26.5000599771, 125), abs=1e-9)
    boxes = {r.region_name: tuple(r)[2:] for r in tables["unemployment_boxes"].collect()}
    assert boxes["Africa"] == pytest.approx((7.4, 15.0, 28.5, 0.7, 53.4, 0))
    assert boxes["Americas"] == pytest.approx((9.375, 14.55, 23.825, 5.0, 29.6, 1))
    assert boxes["Asia"] == pytest.approx((7.125, 14.8, 23.0, 0.4, 42.2, 0))
    assert boxes["Europe"] == pytest.approx((9.825, 14.0, 20.675, 6.1, 34.3, 2))
    assert boxes["Oceania"] == pytest.approx((11.25, 17.1, 28.0, 1.3, 38.4, 1))
    ages = {r.region_name: tuple(r)[2:] for r in tables["age_boxes"].collect()}
    assert ages["Africa"] == pytest.approx((18.0, 19.8, 21.6, 14.8, 25.8, 6))
    assert ages["Americas"] == pytest.approx((29.325, 33.25, 37.125, 23.2, 48.5, 0))
    for name, want in (
        ("unemployment_density", {yes: 3.3729499759, no: 4.2584552741}),
        ("age_density", {yes: 1.4170657299, no: 2.3512587763}),
    ):
        got = {r[0]: r[1] for r in tables[name].select("development", "bandwidth").distinct().collect()}
        assert got == pytest.approx(want, abs=1e-9)
    means = tables["unemployment_means"].collect()
    assert len(means) == 17
    assert (means[0].sub_region_name, means[0].n_values) == ("Eastern Asia", 5)
    assert means[0]["mean"] == pytest.approx(8.92)
    assert (means[-1].sub_region_name, means[-1].n_values) == ("Polynesia", 3)
    assert means[-1]["mean"] == pytest.approx(36.4)
