"""Declared schemas of the star tables (keys bigint, measures typed)."""

from pyspark.sql import types as T

_L, _I, _D, _S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
_TS, _DT, _B = T.TimestampNTZType(), T.DateType(), T.BooleanType()


def _s(*cols):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


STAR_SCHEMAS = {
    "dim_country": _s(("country_tk", _L, False), ("country_id", _L, True), ("country_name", _S, False),
                      ("region", _S, True)),
    "dim_party": _s(("party_tk", _L, False), ("party_id", _I, True), ("name", _S, False),
                    ("orientation", _S, True)),
    "dim_person": _s(("person_tk", _L, False), ("person_id", _I, True), ("first_name", _S, False),
                     ("last_name", _S, False), ("birth_year", _I, False), ("title", _S, True),
                     ("party_id", _L, True)),
    "dim_date": _s(("date_tk", _L, False), ("full_date", _DT, True), ("year", _L, True), ("month", _L, True),
                   ("day", _L, True), ("weekday", _S, True)),
    "dim_election": _s(("election_tk", _L, False), ("election_id", _L, True), ("date_tk", _L, True),
                       ("country_tk", _L, True)),
    "dim_election_history": _s(("election_history_tk", _L, False), ("election_id", _L, True),
                               ("pre_blank_votes", _I, True), ("pre_null_votes", _I, True),
                               ("historical_turnout", _D, True), ("date_from", _TS, True),
                               ("date_to", _TS, True)),
    "fact_election_result": _s(("fact_id", _L, False), ("election_tk", _L, True), ("country_tk", _L, True),
                               ("date_tk", _L, True), ("party_tk", _L, True),
                               ("election_history_tk", _L, True), ("total_mandates", _I, True),
                               ("available_mandates", _I, True), ("num_parishes", _I, True),
                               ("num_parishes_approved", _I, True), ("blank_votes", _L, True),
                               ("blank_votes_percentage", _D, True), ("null_votes", _L, True),
                               ("null_votes_percentage", _D, True), ("voters_percentage", _D, True),
                               ("subscribed_voters", _L, True), ("total_voters", _L, True),
                               ("mandates", _I, True), ("votes", _L, True), ("percentage", _D, True),
                               ("valid_votes_percentage", _D, True), ("final_mandates", _I, True),
                               ("result_type", _S, True)),
}
