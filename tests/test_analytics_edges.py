import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from qalake.functions.pg import rounded_ratio
from qalake.plans import answers, content, timeline, users, votes

POSTS = ("id int, post_type_id int, accepted_answer_id int, parent_id int, creation_date timestamp_ntz, "
         "score int, view_count int, body string, owner_user_id int, last_editor_user_id int, "
         "last_activity_date timestamp_ntz, title string, tags string, answer_count int, "
         "closed_date timestamp_ntz, community_owned_date timestamp_ntz")


def post(id, type_=1, acc=None, parent=None, ts=None, score=0, owner=None, body="", last=None):
    ts = ts or dt.datetime(2020, 1, 1)
    return (id, type_, acc, parent, ts, score, 1, body, owner, None, last or ts, "t", None, 0, None, None)


def test_rounded_ratio_half_away_from_zero(spark):
    df = spark.createDataFrame([(1, 8), (-1, 8), (2, 3), (5, 1000), (None, 3), (1, None)], "n long, d long")
    got = [r[0] for r in df.select(rounded_ratio(F.col("n"), F.col("d"), 2)).collect()]
    assert got == [0.13, -0.13, 0.67, 0.01, None, None]


def test_q02_no_answers_gives_one_row_with_nulls(spark):
    p = spark.createDataFrame([post(1, owner=3)], POSTS)
    r = answers.q02_unsung(p, me=7).collect()
    assert len(r) == 1 and r[0]["accepted_answers"] == 0 and r[0]["percentage_unscored"] is None


def test_q02_integer_division(spark):
    rows = [post(1, acc=2, owner=3), post(2, 2, parent=1, owner=7, score=0),
            post(3, acc=4, owner=3), post(4, 2, parent=3, owner=7, score=0),
            post(5, acc=6, owner=3), post(6, 2, parent=5, owner=7, score=None)]
    r = answers.q02_unsung(spark.createDataFrame(rows, POSTS), me=7).collect()[0]
    # 2 of 3 unscored: 2000 div 3 = 666 -> 66.6 ; NULL score counts as scored
    assert (r["accepted_answers"], r["scored_answers"], r["unscored_answers"]) == (3, 1, 2)
    assert r["percentage_unscored"] == 66.6


def test_q05_zero_answers(spark):
    p = spark.createDataFrame([post(1, owner=3)], POSTS)
    with pytest.raises(Exception, match="division by zero"):
        answers.q05_accept_rate(p, me=7).collect()
    assert answers.q05_accept_rate(p, me=7, safe=True).collect()[0][0] is None


def test_q16_bounds_are_inclusive(spark):
    end = dt.datetime(2020, 12, 31, 12)
    rows = [post(100, ts=end),  # newest id: the end
            post(1, ts=end - dt.timedelta(days=30)),  # on the bound of windows 1 and 2
            post(2, 2, parent=1, ts=end - dt.timedelta(days=15)),
            post(3, ts=end - dt.timedelta(days=360)),  # last bound: window 12 only
            post(4, ts=end - dt.timedelta(days=361)),  # outside
            post(5, ts=end + dt.timedelta(days=1))]   # after the end, still a lower id
    out = timeline.q16_monthly_totals(spark.createDataFrame(rows, POSTS)).collect()
    assert len(out) == 12
    by_start = {r["start"]: (r["total_questions"], r["total_answers"]) for r in out}
    assert by_start[end - dt.timedelta(days=30)] == (2, 1)
    assert by_start[end - dt.timedelta(days=60)] == (1, 0)
    assert by_start[end - dt.timedelta(days=360)] == (1, 0)
    assert sum(q for q, _ in by_start.values()) == 4


def _brute_q22(rows, percent):
    order = sorted(rows, key=lambda r: (0 if r[2] is None else 1, -(r[2] or 0), r[0]))
    total = sum(r[2] for r in rows if r[2] is not None)
    run = None
    for rank, (i, name, rep) in enumerate(order, 1):
        if rep is not None:
            run = (run or 0) + rep
        if run is not None and run * 100 >= total * percent:
            return (rep, i, name, total, rank)
    return None


@pytest.mark.parametrize("percent", [0, 10, 50, 99, 100])
def test_q22_two_phase_equals_window(spark, percent):
    rnd = random.Random(percent)
    rows = [(i, f"u{i}", None if i % 17 == 0 else rnd.choice([1, 1, 1, 2, 5, 10, 101, 500]))
            for i in rnd.sample(range(1, 400), 150)]
    df = spark.createDataFrame(rows, "id int, display_name string, reputation int")
    got = users.q22_elite_users(df, percent=percent, id_bucket=8).collect()
    exp = _brute_q22(rows, percent)
    assert [tuple(r) for r in got] == ([exp] if exp else [])


def test_q25_zero_days_is_error(spark):
    u = spark.createDataFrame([(1, 6000, dt.datetime(2020, 1, 1))], "id int, reputation int, creation_date timestamp_ntz")
    p = spark.createDataFrame([post(1, ts=dt.datetime(2020, 1, 1, 5))], POSTS)
    with pytest.raises(Exception, match="division by zero"):
        users.q25_rising_stars(u, p).collect()
    assert users.q25_rising_stars(u, p, safe=True).collect()[0]["rep_per_day"] is None


def test_q26_null_owner_is_a_group(spark):
    p = spark.createDataFrame([post(1, owner=None), post(2, owner=None), post(3, owner=5)], POSTS)
    v = spark.createDataFrame([(i, pid, 9) for i, pid in enumerate([1, 2, 2, 3])],
                              "id int, post_id int, vote_type_id int")
    got = {r["user_id"]: r["bounties_won"] for r in votes.q26_bounties_won(p, v).collect()}
    assert got == {None: 3, 5: 1}


def test_q27_sunday_first(spark):
    sun, mon = dt.datetime(2024, 1, 7), dt.datetime(2024, 1, 8)
    p = spark.createDataFrame([post(1, ts=mon), post(2, ts=sun)], POSTS)
    v = spark.createDataFrame([(1, 1, 2), (2, 2, 2), (3, 2, 3)], "id int, post_id int, vote_type_id int")
    out = votes.q27_votes_by_weekday(p, v).collect()
    assert [r["day"] for r in out] == ["Sunday", "Monday"]
    assert out[0]["ratio"] == 1.0 and out[1]["ratio"] is None


def test_q29_absent_side_is_null(spark):
    p = spark.createDataFrame([post(1, ts=dt.datetime(2020, 1, 5))], POSTS)
    v = spark.createDataFrame([(1, 1, 9, dt.datetime(2020, 2, 1), 50)],
                              "id int, post_id int, vote_type_id int, creation_date timestamp_ntz, bounty_amount int")
    out = [tuple(r) for r in votes.q29_bounties_by_month(p, v).collect()]
    assert out == [(2020, 1, None, None, 1), (2020, 2, 1, 50, None)]


def test_q30_site_as_like_pattern(spark):
    u = spark.createDataFrame([(1, "https://a!.b/"), (2, None)], "id int, website_url string")
    end = dt.datetime(2020, 5, 31)
    p = spark.createDataFrame([post(10, body="see a.b", owner=3, last=end),
                               post(11, body="see a.b", owner=1, last=end),
                               post(12, body="see a.b", owner=3, last=dt.datetime(2020, 3, 30))], POSTS)
    c = spark.createDataFrame([(1, 12, "a.b!", dt.datetime(2020, 4, 1), 4)],
                              "id int, post_id int, text string, creation_date timestamp_ntz, user_id int")
    got = [r["post_id"] for r in content.q30_vanity_search(u, p, c, me=1).collect()]
    assert got == [10, 12]
    assert content.q30_vanity_search(u, p, c, me=2).count() == 0


def test_q08_null_scores_tie(spark):
    p = spark.createDataFrame([post(1), post(2, 2, parent=1, owner=7, score=None),
                               post(3, 2, parent=1, owner=9, score=4)], POSTS)
    r = answers.q08_rival_comparison(p, me=7, rival=9).collect()
    assert [(x["winner"], x["question"]) for x in r] == [("Tie", 1)]


def test_q30_wildcards_and_escapes(spark):
    from qalake.plans.content import _pg_like_to_spark
    assert _pg_like_to_spark("a!%b_c!!d!x\\") == "a\\%b_c!dx\\\\"
    with pytest.raises(ValueError):
        _pg_like_to_spark("abc!")
    u = spark.createDataFrame([(1, "http://a_c/")], "id int, website_url string")
    end = dt.datetime(2020, 5, 31)
    p = spark.createDataFrame([post(10, body="see abc", owner=3, last=end),
                               post(11, body="see a_c", owner=3, last=end),
                               post(12, body="see ac", owner=3, last=end)], POSTS)
    c = spark.createDataFrame([], "id int, post_id int, text string, creation_date timestamp_ntz, user_id int")
    got = sorted(r["post_id"] for r in content.q30_vanity_search(u, p, c, me=1).collect())
    assert got == [10, 11]
