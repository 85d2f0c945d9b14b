import datetime
import random

from chatterscope.operators import spans


def test_spans_by_plain_sets(spark):
    rng = random.Random(2)
    start = datetime.datetime(2024, 2, 1, 5)
    rows = [(start + datetime.timedelta(days=rng.choice([0, 1, 2, 5, 9])), f"u{rng.randrange(9000)}") for _ in range(20000)]
    rows += [(None, "x"), (start, None)]
    posts = spark.createDataFrame(rows, "ts timestamp, username string")
    seen = {}
    for ts, user in rows:
        if ts and user:
            seen.setdefault(ts.date(), set()).add(user)
    got = {r["day"]: r for r in spans.unique_users_by_span(posts, 3).collect()}
    assert sorted(got) == sorted(map(str, seen))
    for day in seen:
        users = set().union(*(u for d, u in seen.items() if 0 <= (day - d).days < 3))
        assert got[str(day)]["users"] == len(users)
        assert abs(got[str(day)]["estimate"] - len(users)) <= spans.error_bound() * len(users)
    sketches = spans.user_sketches(posts)
    (whole,) = spans.unique_users(sketches, min(seen), max(seen)).collect()
    every = len(set().union(*seen.values()))
    assert abs(whole["users"] - every) <= spans.error_bound() * every
    none = spans.unique_users(sketches, datetime.date(1999, 1, 1), datetime.date(1999, 1, 2)).collect()
    assert none[0]["users"] == 0
    assert spans.unique_users_by_span(posts.limit(0)).count() == 0
