from pyspark.sql import functions as F

from conftest import rows
from starloom.plans import constants as K
from starloom.plans import dims
from starloom.plans.generate import generate_members, hour_slots, impute_from_pool, incremental_load, last_slot

# The 21 seed people (first name, last name, birth year, title, party id).
PEOPLE = [
    ("João", "Silva", 1965, "Dr.", 1), ("Carlos", "Pereira", 1970, "Eng.", 2), ("Rafael", "Costa", 1982, None, 3),
    ("Miguel", "Fernandes", 1958, "Prof.", 4), ("Ana", "Santos", 1975, "Dra.", 5), ("Bruno", "Almeida", 1980, None, 6),
    ("Ricardo", "Neves", 1967, None, 7), ("Fernanda", "Martins", 1973, "Eng.", 8), ("Gustavo", "Lima", 1988, None, 9),
    ("Patricia", "Ramos", 1990, "Dra.", 10), ("Tiago", "Moreira", 1969, None, 11), ("Vasco", "Mendes", 1972, None, 12),
    ("Diogo", "Faria", 1960, "Dr.", 13), ("Helena", "Cruz", 1985, None, 14), ("Sofia", "Teixeira", 1978, "Prof.", 15),
    ("André", "Rodrigues", 1955, "Eng.", 16), ("Catarina", "Barros", 1992, None, 17), ("José", "Nogueira", 1983, None, 18),
    ("Mariana", "Henriques", 1976, "Dra.", 19), ("Filipe", "Coelho", 1991, None, 20), ("Eduardo", "Gomes", 1963, "Dr.", 21),
]


def _people(spark):
    data = [(i + 1, f, l, y, t, p) for i, (f, l, y, t, p) in enumerate(PEOPLE)]
    return spark.createDataFrame(data, "id int, first_name string, last_name string, birth_year int, title string, party_id int")


def _parties(spark):
    return spark.createDataFrame([(i, f" Party {i} ") for i in range(1, 22)], "id int, name string")


def test_orientation_fixture(spark):
    o = dims.orientation_frame(spark)
    counts = dict(o.groupBy("orientation").count().collect())
    assert counts == {"left": 7, "right": 5, "center": 9}


def test_dim_party_with_feed_names(spark):
    feed = spark.createDataFrame([("Zeta",), ("Alpha",), ("Alpha",), (None,)], "Party string")
    p = dims.dim_party(_parties(spark), feed)
    got = rows(p.where(F.col("party_id") > 1000), "party_id", "name", "orientation")
    assert got == [(1001, "Alpha", "unknown"), (1002, "Zeta", "unknown")]
    assert p.count() == 23
    assert sorted(r.party_tk for r in p.collect()) == list(range(1, 24))
    assert p.where("name = 'Party 1'").first().orientation == "left"


def test_dim_person_required_columns(spark):
    parties = dims.dim_party(_parties(spark))
    all_cols = ["person_id", "first_name", "last_name", "birth_year", "title"]
    strict = dims.dim_person(_people(spark), parties, "party_id", "party_tk", required=all_cols)
    relaxed = dims.dim_person(_people(spark), parties, "party_id", "party_tk")
    assert strict.count() == 11 and relaxed.count() == 21
    assert relaxed.where(F.col("party_id").isNull()).count() == 0


def test_dim_person_database_row_wins(spark):
    parties = dims.dim_party(_parties(spark))
    csv = spark.createDataFrame([(1, "Other", "Name", 1999, None, 2), (99, "New", "Person", 1990, None, 3)],
                                "id int, first_name string, last_name string, birth_year int, title string, party_id int")
    p = dims.dim_person(_people(spark), parties, "party_id", "party_tk", csv=csv)
    assert p.count() == 22
    assert p.where("person_id = 1").first().first_name == "João"


def test_dim_country_sources_loaded_and_regions(spark):
    db = spark.createDataFrame([(1, " brazil ", "south"), (2, "portugal", None), (None, "ghost", None),
                                (3, "Brazil", "north")], "id int, name string, region string")
    csv = spark.createDataFrame([("Brazil",), ("chile",), (" angola",)], "name string")
    loaded = spark.createDataFrame([(2,)], "country_id long")
    d = dims.dim_country(db, csv, loaded)
    got = {r.country_name: r for r in d.collect()}
    assert set(got) == {"Brazil", "Ghost", "Chile", "Angola"}   # Portugal already loaded
    assert got["Brazil"].country_id == 1 and got["Brazil"].region == "South"
    assert got["Chile"].country_id is None and got["Chile"].region in K.REGIONS
    assert sorted(r.country_tk for r in d.collect()) == [1, 2, 3, 4]
    again = {r.country_name: r.region for r in dims.dim_country(db, csv, loaded).collect()}
    assert again == {k: v.region for k, v in got.items()}      # region fill repeatable


def test_dim_date_parses_and_detects(spark):
    a = spark.createDataFrame([("2024-01-02 10:00:00",), ("2024-01-02 11:00:00",), ("bad",)], "time string")
    b = spark.createDataFrame([(2024,)], "x int").select(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("year"))
    d = dims.dim_date([a, b])
    assert rows(d, "date_tk", "year", "month", "day", "weekday") == [(1, 2024, 1, 1, "Monday"), (2, 2024, 1, 2, "Tuesday")]


def test_incremental_load_idempotent(spark):
    b1 = spark.createDataFrame([("b",), ("a",), ("a",)], "name string")
    b2 = spark.createDataFrame([("c",), ("a",), (None,)], "name string")
    t1 = incremental_load(None, b1, "name")
    t2 = incremental_load(t1, b2, "name")
    assert rows(t2) == [(1, "a"), (2, "b"), (3, "c")]
    t3 = incremental_load(t2, b2, "name")
    assert rows(t3) == rows(t2)


def test_generators(spark):
    parents = spark.createDataFrame([(i,) for i in range(1, 41)], "pid long")
    m = generate_members(parents, "pid", ["pid"])
    for r in m.collect():
        names = K.MALE_NAMES if r.gender == "M" else K.FEMALE_NAMES
        titles = K.TITLES_MALE if r.gender == "M" else K.TITLES_FEMALE
        assert r.first_name in names and r.title in titles and r.last_name in K.LAST_NAMES
        assert K.BIRTH_YEARS[0] <= r.birth_year <= K.BIRTH_YEARS[1]
    assert m.count() == 40
    filled = impute_from_pool(spark.createDataFrame([("x", None), ("y", "Keep")], "n string, r string"),
                              "r", "n", K.REGIONS, "region|")
    got = dict(filled.collect())
    assert got["y"] == "Keep" and got["x"] in K.REGIONS


def test_hour_slots(spark):
    import datetime as dt
    d = spark.createDataFrame([(dt.date(2024, 1, 1),)], "d date")
    s = hour_slots(d, "d")
    assert [r.slot_ts.hour for r in s.orderBy("slot_ts").collect()] == [18, 19, 20, 21, 22]
    assert last_slot(s).first().last_slot_ts.hour == 22


def test_dim_party_name_in_both_sources(spark):
    db = spark.createDataFrame([(1, "X"), (2, " X "), (1500, "Y")], "id int, name string")
    csv = spark.createDataFrame([("X",), ("Z",)], "Party string")
    got = rows(dims.dim_party(db, csv), "party_id", "name")
    assert got == [(1, "X"), (1500, "Y"), (1501, "Z")]   # one row per name, ids never clash


def test_dim_election_two_sources(spark):
    import datetime as dt
    dates = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 2)], "full_date date, date_tk long")
    countries = spark.createDataFrame([(7, 70)], "country_id long, country_tk long")
    schema = "election_id long, year string, country_id long"
    db = spark.createDataFrame([(1, "2024-01-01 00:00:00", 7), (1, "2024-01-02 00:00:00", 7), (2, "bad", 7), (3, "2024-01-01 00:00:00", None)], schema)
    csv = spark.createDataFrame([(1, "2024-01-01 00:00:00", 7), (4, "2024-01-02 00:00:00", 8)], schema)
    got = rows(dims.dim_election(db, dates, countries, csv=csv))
    assert got == [(1, 1, 1, 70), (2, 1, 2, 70), (3, 4, 2, None)]


def test_fact_keeps_every_feed_row_and_one_official(spark):
    import datetime as dt
    from starloom.plans.facts import fact_election_result
    t = dt.datetime(2024, 1, 1)
    feed = spark.createDataFrame([(1, 10, t, "aland", "X", 5), (2, 10, t, "aland", "X", 5), (3, 11, t, None, None, 6)],
                                 "fact_id long, election_id long, time timestamp_ntz, territory_name string, party string, votes long")
    election = spark.createDataFrame([(1, 10), (2, 10)], "election_tk long, election_id long")
    country = spark.createDataFrame([(1, "Aland"), (2, "Aland")], "country_tk long, country_name string")
    date = spark.createDataFrame([(dt.date(2024, 1, 1), 9)], "full_date date, date_tk long")
    party = spark.createDataFrame([("X", 4), ("X", 5)], "name string, party_tk long")
    history = spark.createDataFrame([(10, 3)], "election_id long, election_history_tk long")
    got = rows(fact_election_result(feed, election, country, date, party, history, ["votes"]))
    assert got == [(1, 1, 1, 9, 4, 3, 5, "preliminary"), (2, 1, 1, 9, 4, 3, 5, "official"), (3, None, None, 9, None, None, 6, "official")]
