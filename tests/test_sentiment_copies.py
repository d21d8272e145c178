import pytest

from citysignal.operators import sentiment


def test_a_repeated_message_scores_as_one(spark):
    lexicon = spark.createDataFrame([("bad", -1.0), ("fine", 0.5)], "word string, valence double")
    once = [(1, "bad bad fine"), (2, None), (3, "")]
    score = lambda rows: {
        r.id: (r.matches, r.valence, r.compound)
        for r in sentiment.score_text(
            spark.createDataFrame(rows, "id long, text string"), lexicon, id="id"
        ).collect()
    }
    assert score(once) == score(once * 2) and score(once)[1][:2] == (3, -1.5)


LEXICON = [("bad", -1.0), ("fine", 0.5), ("l'été", 0.25)] + [(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}", i / 100) for i in range(300)]


def test_rows_are_scored_in_place(spark):
    """Every row by its own text, whatever its id; the same numbers as by joining the lexicon."""
    lexicon = spark.createDataFrame(LEXICON, "word string, valence double")
    rows = [(1, "bad BAD fine"), (1, "fine"), (1, "fine"), (2, None), (3, ""), (4, "L'été wab wzz " * 2000), (None, "bad")]
    docs = spark.createDataFrame(rows, "id long, text string")
    scored = sentiment.score_rows(docs, lexicon)
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
    got = sorted(((r.id, r.matches, r.valence, r.compound) for r in scored.collect()), key=repr)
    joined = sentiment.score_text(docs, lexicon, id="id").collect()
    assert len(got) == 7 and {g for g in got} == {(r.id, r.matches, r.valence, r.compound) for r in joined}
    assert [g[1:3] for g in got if g[0] == 1] == [(1, 0.5), (1, 0.5), (3, -1.5)]


def test_large_lexicons_are_not_made_constants(spark):
    lexicon = spark.createDataFrame(LEXICON, "word string, valence double")
    docs = spark.createDataFrame([(1, "bad")], "id long, text string")
    with pytest.raises(ValueError, match="score_text"):
        sentiment.score_rows(docs, lexicon, most=10)
    empty = lexicon.limit(0)
    assert [r.matches for r in sentiment.score_rows(docs, empty).collect()] == [0]
