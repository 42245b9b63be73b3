"""Operators against plain Python loops on random rows with gaps, ties and a hot key."""

import random
from collections import defaultdict
from statistics import fmean

import pytest

from caseframe.operators import overview, rankings, risk
from caseframe.operators.forecast import forecast_grid
from caseframe.operators.places import COUNTY_CENTRES, county_centres, map_layer
from caseframe.schema import HIGH, LOW, MEDIUM
from tests.conftest import rows

SCHEMA = (
    "Disease string, County string, Year int, Sex string, Count int, Population int,"
    " Recalculated_Rate double, Predicted_Rate double"
)
COUNTIES = [name for name, *_ in COUNTY_CENTRES[:9]] + ["Nowhere", None]


def random_rows(seed):
    chance = random.Random(seed)
    made = []
    for _ in range(3000):
        hot = chance.random() < 0.35
        made.append(
            (
                "HIV" if hot else chance.choice(["A", "B", "C", "D", None]),
                "Kern" if hot else chance.choice(COUNTIES),
                chance.choice([2001, 2003, 2007, 2010, 2014, None]),
                chance.choice(["Male", "Female", "Total"]),
                chance.choice([0, 0, 1, 2, 5]),
                chance.choice([None, 0, 100, 5000]),
                chance.choice([0.0, 1.5, 7.25, 60.0]),
                # few values and few rows per cell, so that all bands and ties occur
                chance.choice([0.0, 5.0, 5.01, 40.0, 50.0, 80.0]),
            )
        )
    return made


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    made = random_rows(request.param)
    df = spark.createDataFrame(made, SCHEMA).repartition(6)
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return [dict(zip(names, row, strict=True)) for row in made], df.cache()


def grouped(cells, *keys):
    groups = defaultdict(list)
    for cell in cells:
        groups[tuple(cell[key] for key in keys)].append(cell)
    return groups


def total(cells):
    return sum(cell["Count"] for cell in cells)


def test_key_figures(case):
    cells, df = case

    def largest(key):
        groups = {k[0]: total(v) for k, v in grouped(cells, key).items() if k[0] is not None}
        return min(groups, key=lambda name: (-groups[name], name))

    found = overview.key_figures(df).collect()[0]
    assert found["Total_Cases"] == total(cells)
    assert found["Avg_Rate"] == pytest.approx(fmean(c["Recalculated_Rate"] for c in cells))
    assert (found["Top_County"], found["Top_Disease"]) == (largest("County"), largest("Disease"))


def test_growth(case):
    cells, df = case
    expected = {}
    for (disease,), group in grouped(cells, "Disease").items():
        early = [c for c in group if c["Year"] and 2001 <= c["Year"] <= 2005]
        late = [c for c in group if c["Year"] and 2010 <= c["Year"] <= 2014]
        if disease is not None and early and late:
            expected[disease] = (total(early), total(late), total(late) - total(early))
    found = {r[0]: tuple(r)[1:4] for r in rankings.disease_growth(df).collect()}
    assert found == expected


def test_top_diseases(case):
    cells, df = case
    expected = sorted(
        ((key[0], total(group)) for key, group in grouped(cells, "Disease").items()),
        key=lambda pair: (-pair[1], pair[0] is not None, pair[0]),
    )
    assert [r[:2] for r in rows(rankings.top_diseases(df))] == expected


def test_sex_distribution(case):
    cells, df = case
    groups = {k[0]: total(v) for k, v in grouped(cells, "Sex").items() if k[0] != "Total"}
    whole = sum(groups.values())
    for found in rankings.sex_distribution(df).collect():
        assert found["Total_Cases"] == groups[found["Sex"]]
        assert found["Percentage"] == pytest.approx(100 * groups[found["Sex"]] / whole, abs=0.006)


def test_map(case, spark):
    cells, df = case
    known = {name for name, *_ in COUNTY_CENTRES}
    means = {
        key[0]: fmean(c["Recalculated_Rate"] for c in group)
        for key, group in grouped(cells, "County").items()
        if key[0] in known
    }
    top = max(means.values())
    found = {r["County"]: r for r in map_layer(df, county_centres(spark)).collect()}
    assert set(found) == set(means)
    for name, mean in means.items():
        assert found[name]["height"] == pytest.approx(mean / top * 30_000 + 5_000)
        red, green, blue, alpha = found[name]["color"]
        share = mean / top
        assert red == pytest.approx(min(255, 510 * share), abs=1)
        assert green == pytest.approx(255 if share <= 0.5 else 510 - 510 * share, abs=1)
        assert (blue, alpha) == (50, 180)


def bands(cells):
    found = {}
    for key, group in grouped(cells, "Disease", "Year", "County").items():
        if key[2] is not None:
            mean = fmean(c["Predicted_Rate"] for c in group)
            found[key] = (mean, LOW if mean <= 5 else MEDIUM if mean <= 50 else HIGH)
    return found


def test_county_risk_and_counts(case):
    cells, df = case
    sparse = df.limit(0).unionByName(df.filter("Count = 5 AND Sex = 'Total'"))
    few = [c for c in cells if c["Count"] == 5 and c["Sex"] == "Total"]
    expected = bands(few)
    table = risk.county_risk(sparse)
    found = {(r["Disease"], r["Year"], r["County"]): r for r in table.collect()}
    assert set(found) == set(expected)
    for key, (mean, level) in expected.items():
        assert found[key]["Predicted_Rate"] == pytest.approx(mean)
        assert found[key]["Priority_Level"] == level
    counts = {tuple(r)[:2]: tuple(r)[2:] for r in risk.priority_counts(table).collect()}
    for pair, found_counts in counts.items():
        levels = [level for key, (_, level) in expected.items() if key[:2] == pair]
        assert found_counts == tuple(levels.count(level) for level in (HIGH, MEDIUM, LOW))


def test_recommendations(case):
    cells, df = case
    few = [c for c in cells if c["Count"] == 5 and c["Sex"] == "Total"]
    table = risk.county_risk(df.filter("Count = 5 AND Sex = 'Total'"), ordered=False)
    screens = defaultdict(list)
    for (disease, year, county), (mean, level) in bands(few).items():
        screens[(disease, year)].append((-mean, county, level))
    expected = {}
    for screen, listed in screens.items():
        high = sorted(x for x in listed if x[2] == HIGH)[:5]
        medium = sorted(x for x in listed if x[2] == MEDIUM)[:3]
        action = "critical" if high else "reinforced" if medium else "none"
        expected[screen] = (action, [x[1] for x in (high or medium)] or [None])
    found = {}
    for r in risk.recommendations(table).collect():
        found.setdefault((r["Disease"], r["Year"]), (r["action"], []))[1].append(r["County"])
    assert found == expected
    assert {action for action, _ in expected.values()} >= {"critical", "reinforced"}


def test_grid(case):
    cells, df = case
    expected = {}
    for (county,), group in grouped(cells, "County").items():
        known = [c["Population"] for c in group if c["Population"] is not None]
        if county is not None:
            expected[county] = fmean(known) if known else None
    pairs = {(c["County"], c["Disease"]) for c in cells if c["County"] and c["Disease"]}
    for disease, places in (("A", {(county, "A") for county in expected}), (None, pairs)):
        found = forecast_grid(df, disease, [2020, 2021]).collect()
        assert sorted((r["County"], r["Disease"], r["Year"]) for r in found) == sorted(
            (*place, year) for place in places for year in (2020, 2021)
        )
        assert all(r["Population"] == pytest.approx(expected[r["County"]]) for r in found)
