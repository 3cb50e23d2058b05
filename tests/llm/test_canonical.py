import random

from pyspark.sql import functions as F

from sieveworks.llm import canonical

PLACES = "place_id long, city string, state string, state_code string, country string, country_code string, label string, other_names array<string>"
REF = [
    (1, "Eskaport", "Doria", "DI", "Norvania", "NV", "Eskaport, DI, Norvania", None), (2, "Eskaport", "Rosia", "RO", "Ardland", "AD", "Eskaport, RO, Ardland", None),
    (3, "Fort Calendale", "Orrshire", "OE", "Costa Brumal", "CB", "Fort Calendale, OE, Costa Brumal", ["Cruzeton"]), (4, "Brynühaven", "Orrshire", "OE", "Costa Brumal", "CB", "Brynühaven, OE, Costa Brumal", None),
]
CASES = [
    ("Eskaport/Rosia", 2), ("ESKAPORT, DI 12345", 1), ("Ft. Calendale (Hybrid)", 3), ("Greater  Cruzeton Area", 3), ("Brynuhaven HQ", 4), ("Brynühhaven", 4), ("CB-OE-Brynühaven", 4), ("12 Mill Lane, Brynühaven, Orrshire", 4),
    ("Remote", 0), ("Zelébburg", 0), ("Eskaport, QX", 0), ("Eskaport - Farland", 0), ("n/a", 0), ("x" * 5000, 0), ("Remote - Brynühaven, OE", 4), ("Costa Brumal > Fort Calendale", 3), ("Altstadt, Brynühaven, Costa Brumal", 4), ("Brynühaven, Old Quarter, OE", 4), ("Old Quarter, Brynühaven", 4),
]


def test_places(spark):
    ref = spark.createDataFrame(REF, PLACES)
    rows = [(i, v, "x") for i, (v, _) in enumerate(CASES)] + [(50, "Eskaport, DI, Norvania", "x"), (51, None, "x"), (52, "  ", "x"), (53, CASES[0][0], "x")]
    df = spark.createDataFrame(rows, "row_id long, location string, seg string")
    got = {r.row_id: r.ref_id for r in canonical.map_places(df, "row_id", "location", ref).collect()}
    assert got == {i: w for i, (_, w) in enumerate(CASES)} | {53: 2}
    assert canonical.map_places(df.filter("row_id < 0"), "row_id", "location", ref).collect() == []
    assert {r.ref_id for r in canonical.map_places(df, "row_id", "location", ref.filter("place_id < 0")).collect()} == {0}


EMPLOYMENT = "employment_id long, label string, meaning string"


def test_employment(spark):
    """Names in use are learnt from copies of the same record; what stands beside all labels names none."""
    ref = spark.createDataFrame([(1, "Full-time", ""), (2, "Part-time", ""), (3, "Contract", "")], EMPLOYMENT)
    cases = {"FULL_TIME": 1, "Full tmie": 1, "Regular full-time (40h)": 1, "50% position": 2, "50 % POSITION": 2, "pt": 2, "C2C contract": 3, "Vollzeit": 1, "permanent post, 38 hours, part time": 2, "Standard": 0, "--": 0, "Position type 7": 0}
    rows = [(i, v, None) for i, v in enumerate(cases)] + [(40, None, "g"), (41, "  ", "g"), (42, "Contract", "g")]
    n = 100
    for value, labels in (("50% position", ["Part-time"] * 5), ("pt", ["Part-time"] * 6), ("Vollzeit", ["Full-time"] * 9 + ["Contract"]), ("Standard", ["Full-time", "Part-time", "Contract"] * 3), ("rare", ["Contract"] * 2)):
        for k, label in enumerate(labels):
            rows += [(n, value, f"{value}{k}"), (n + 1, label, f"{value}{k}"), (n + 2, label, f"{value}{k}")]
            n += 3
    df = spark.createDataFrame(rows, "row_id long, employment_type string, g string")
    got = {r.row_id: r.ref_id for r in canonical.map_employment(df, "row_id", "employment_type", ref, [F.col("g")]).collect()}
    assert {i: got[i] for i in range(len(cases))} == dict(enumerate(cases.values())) and not {40, 41, 42} & set(got)
    assert {got[i] for i, v, _ in rows if v == "rare"} == {0}
    assert canonical.map_employment(df.filter("row_id < 0"), "row_id", "employment_type", ref, [F.col("g")]).collect() == []
    assert {r.ref_id for r in canonical.map_employment(df, "row_id", "employment_type", ref.limit(0), [F.col("g")]).collect()} == {0}


def test_join_equals_brute_force(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 7)))
    a, b = sorted({word() for _ in range(60)}), sorted({word() for _ in range(40)})
    da, db = spark.createDataFrame([(x,) for x in a], "x string"), spark.createDataFrame([(x,) for x in b], "y string")
    sets = {r.t: set(r.s) for r in spark.createDataFrame([(x,) for x in set(a) | set(b)], "t string").select("t", canonical.pairs_of(F.col("t")).alias("s")).collect()}
    want = {(x, y) for x in a for y in b if len(sets[x] & sets[y]) / len(sets[x] | sets[y]) >= 0.4}
    assert {(r.a, r.b) for r in canonical.jaccard_join(da, db, "x", "y", 0.4).collect()} == want
