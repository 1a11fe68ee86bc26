"""Noun analyzer: the cheapest way through a lattice of dictionary words."""

from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vitrine.functions import Lexicon, lattice_analyzer, noun_tokens
from vitrine.plans import gold

WORDS = [
    ("게임", "NNG", 1000), ("재미", "NNG", 1200), ("정말", "MAG", 800), ("그래픽", "NNG", 1000), ("최고", "NNG", 900), ("스토리", "NNG", 1000),
    ("이", "JKS", 500), ("가", "JKS", 500), ("은", "JX", 500), ("있", "VA", 700), ("좋", "VA", 700), ("다", "EF", 300), ("아요", "EF", 400),
    ("게", "NNB", 3000), ("임", "NNB", 3000), ("다", "EF", 9000), (None, "NNG", 1), ("", "NNG", 1), ("두 말", "NNG", 1), ("없", None, 1), ("무", "NNG", None),
]
JOINS = [("NNG", "JKS", -400), ("NNG", "JX", -400), ("", "JKS", 4000), ("JKS", "EF", 3000)]
#: Recorded reviews and their nouns; a name that is in no dictionary ends before its particle.
REVIEWS = {
    "게임이 정말 재미있다": ["게임", "재미"],
    "그래픽은최고": ["그래픽", "최고"],
    "스토리가 좋아요 스토리": ["스토리", "스토리"],
    "엘든링이 최고다!! GOTY 2022": ["엘든링", "최고"],
    "": [],
    " \n": [],
}


def ways(lexicon, run):
    """Costs of all ways through a run."""
    edges = list(lexicon.edges(run))

    def walk(at, tag, cost):
        if at == len(run):
            yield cost + lexicon.joins.get((tag, ""), 0)
        for start, end, t, c in edges:
            if start == at:
                yield from walk(end, t, cost + c + lexicon.joins.get((tag, t), 0))

    return list(walk(0, "", 0))


LETTERS = st.text("가나다a1!", min_size=1, max_size=6)
TAGS, COSTS = st.sampled_from(["NNG", "JX", "SL", "SN"]), st.integers(-2000, 9000)


@settings(max_examples=150, deadline=None)
@given(words=st.lists(st.tuples(LETTERS, TAGS, COSTS), max_size=10), joins=st.lists(st.tuples(st.sampled_from(["", "NNG", "JX", "SL"]), st.sampled_from(["", "NNG", "JX", "SN"]), COSTS), max_size=6), run=LETTERS)
def test_cheapest_of_all_ways(words, joins, run):
    lexicon = Lexicon(words, joins)
    cost, path = lexicon.path(run)
    assert cost == min(ways(lexicon, run)) and "".join(form for form, _ in path) == run
    at, tag, total = 0, "", 0
    for form, t in path:
        total += min(c for s, e, u, c in lexicon.edges(run) if (s, e, u) == (at, at + len(form), t)) + lexicon.joins.get((tag, t), 0)
        at, tag = at + len(form), t
    assert total + lexicon.joins.get((tag, ""), 0) == cost


def test_ties_and_long_runs():
    assert Lexicon([("가", "B", 5), ("가", "A", 5)]).path("가") == (5, [("가", "A")])
    assert Lexicon([("가", "A", 5), ("가가", "A", 10)]).path("가가") == (10, [("가가", "A")])
    assert Lexicon([("가", "A", 5), ("가나", "B", 10), ("나", "B", 5)]).path("가나") == (10, [("가나", "B")])
    long = Lexicon(WORDS[:14]).path("게임이" * 30_000)[1]
    assert len(long) == 60_000 and set(long) == {("게임", "NNG"), ("이", "JKS")}
    assert len(Lexicon([]).path("가" * 20_001)[1]) == 2501 and Lexicon([]).path("a" * 50_000)[1] == [("a" * 50_000, "SL")]


def test_reviews(spark):
    words, joins = spark.createDataFrame(WORDS, "form string, tag string, cost int"), spark.createDataFrame(JOINS, "left string, right string, cost int")
    nouns = noun_tokens(lattice_analyzer(words, joins))
    df = spark.createDataFrame([(t,) for t in [*REVIEWS, None]], "t string")
    assert {r["t"]: r["n"] for r in df.select("t", nouns("t").alias("n")).collect()} == {**REVIEWS, None: []}
    T = datetime(2025, 4, 9)
    lake = spark.createDataFrame([(1, "korean", t, T) for t in REVIEWS] + [(1, "english", "게임", T)], "appid int, language string, review string, timestamp_created timestamp")
    rows = gold.korean_review_tokens(lake, nouns, top_n=10).collect()
    assert {r["morpheme"]: (r["frequency"], r["review_appearances"]) for r in rows} == {"게임": (1, 1), "재미": (1, 1), "그래픽": (1, 1), "최고": (2, 2), "스토리": (2, 1), "엘든링": (1, 1)}


def test_bounds(spark):
    words = spark.createDataFrame(WORDS, "form string, tag string, cost int")
    with pytest.raises(ValueError, match="1 are allowed"):
        lattice_analyzer(words, max_words=1)
    with pytest.raises(ValueError, match="no words"):
        lattice_analyzer(words.limit(0))
