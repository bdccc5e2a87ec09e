"""No rule is lost to a bound of number or length."""

import itertools

from turnloom.llm import urlrules as U

SCHEMA = "page_id bigint, url string, html string"


def frames(spark, rows):
    return spark.createDataFrame([(i, u, None) for i, (u, _) in enumerate(rows)], SCHEMA), spark.createDataFrame([(i, b) for i, (_, b) in enumerate(rows) if b is not None], "page_id bigint, blocked int")


def test_many_redundant_sets_leave_room_for_weaker_rules(spark):
    # each of 20 hosts shares 12 tokens of its own; a rule of less confidence comes after all their subsets
    rows = [(f"http://h{chr(97 + h)}.org/" + "/".join(f"{chr(97 + h)}{chr(97 + i)}" for i in range(11)), 1) for h in range(20) for _ in range(20)]
    rows += [("http://weak.net/w", int(i % 10 > 0)) for i in range(200)] + [(f"http://good{i % 3}.com/g", 0) for i in range(1500)]
    rows += [("http://weak.net/w", None), ("http://other.net/ta", None)]
    for most in (U.BROADCAST_RULES, 0):
        got = [r["mined"] for r in sorted(U.judge_urls(*frames(spark, rows), most=most).collect())]
        assert all(got[:600]) and not any(got[600:2100]) and got[2100:] == [True, True]


def test_a_rule_of_five_tokens(spark):
    # keys a to e are bad only all together: each four of them are as often good
    keys = [c for n in (4, 5) for c in itertools.combinations("abcde", n) for _ in range(60 if n == 4 else 100)]
    rows = [("http://x.org/?" + "&".join(f"{k}=1" for k in c), int(len(c) == 5)) for c in keys]
    five = tuple(f"key={k}" for k in "abcde")
    pages, bad = frames(spark, rows)
    learnt = [set(r) for r in U.mine(pages, bad)]
    assert set(five) in learnt
    for most in (U.BROADCAST_RULES, 0):
        assert {r["page_id"] for r in U.judge_urls(pages, bad, most=most).where("mined").collect()} == {i for i, (_, b) in enumerate(rows) if any(r <= set(U.tokens(rows[i][0])) for r in learnt)}
