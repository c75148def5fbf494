"""Items of very different lengths in one index."""

import random

import brute
from termlode.llm import decontaminate

DICE = random.Random(5)
LONG = " ".join(f"term{DICE.randrange(900)}" for _ in range(1500)) + ". The end of it."
SHORT = "Which of the seven rivers runs past the old mill? Severn."


def found_of(spark, rows, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    leaks = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()}
    clean = {r["doc_id"] for r in decontaminate.decontaminate(docs, bench).collect()}
    assert clean == {i for i, _ in rows} - {i for i, _ in leaks}
    return leaks


def test_answer_must_lie_within_the_items_own_length(spark):
    question, answer = SHORT.split("? ")
    rows = [
        (1, f"{question} {'noise ' * 800}{answer}"),
        (2, f"{'noise ' * 1490}{question} {answer} {'noise ' * 800}"),
        (3, f"{'noise ' * 700}{answer} {'noise ' * 20}{question}"),
        (4, "noise " * 33 + LONG),
    ]
    items = [(7, SHORT), (8, LONG)]
    assert found_of(spark, rows, items) == {(2, 7), (4, 8)}
    assert brute.leaks(rows[:3], items[:1]) == {(2, 7)}


def test_mixed_lengths_equal_brute_force(spark):
    items = [
        (k, " ".join(f"w{k}x{j % 17}" for j in range(8 + 5 * k)) + f". Ans{k} is{k} so{k}.") for k in range(8)
    ]
    rows = []
    for i in range(80):
        k = i % 8
        question, answer = items[k][1].split(". ")
        words = question.split()
        for _ in range(DICE.randrange(3)):
            words[DICE.randrange(len(words))] = "other"
        gap = DICE.choice([0, 0, 1, 2, 5, 30])
        parts = [*words, *["gap"] * gap, *answer.split()]
        rows.append((i, " ".join(["n"] * DICE.randrange(60) + parts + ["n"] * DICE.randrange(60))))
    expected = brute.leaks(rows, items)
    assert 0 < len(expected) < len(rows)
    assert found_of(spark, rows, items) == expected
