"""Leaked items, against a plain search."""

import random
from collections import Counter

import pytest
from foliant.llm import leakage as op


def text(rng, n, pool=400):
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        k = rng.randrange(1, len(words) - 1)
        how = rng.randrange(3)
        words[k : k + 1] = [] if how == 0 else ["zz", words[k]] if how == 1 else [f"y{k}"]
    return words


def brute(item, doc, unit):
    for s in range(len(item) - unit.run + 1):
        row = [0] * (len(doc) + 1)
        for a in item[s : s + unit.run]:
            new = [row[0] + 1]
            for j, b in enumerate(doc):
                new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
            row = new
        if min(row) <= unit.edits:
            return True
    return False


def test_index_loses_nothing():
    rng = random.Random(8)
    items = [(k, text(rng, rng.choice([5, 12, 13, 40, 80]), 60)) for k in range(40)]
    index, strict = op.Index(items, op.WORDS, whole=False), op.Index(items, op.WORDS)
    hits = 0
    for _ in range(300):
        _, own = items[rng.randrange(40)]
        start = rng.randrange(max(1, len(own) - 16))
        part = edited(rng, own[start : start + 16], rng.randrange(5)) if len(own) >= 5 else own
        doc = text(rng, rng.randrange(60), 60) + part + text(rng, rng.randrange(60), 60)
        want = {k for k, u in items if len(u) >= 12 and brute(u, doc, op.WORDS)}
        assert index.leaks(doc) == want
        assert strict.leaks(doc) <= want
        hits += len(want)
    assert hits > 60


def brute_whole(item, doc, unit):
    """From each match on, all alignments that end with a match, of any length."""
    for s in range(len(item)):
        for j in (j for j, b in enumerate(doc) if b == item[s]):
            row = list(range(len(doc) - j + 1))
            row = [99, *row[:-1]]
            for length, a in enumerate(item[s + 1 :], 2):
                new = [99]
                for i, b in enumerate(doc[j:], 1):
                    if a == b and length >= unit.run and row[i - 1] <= unit.edits:
                        return True
                    new.append(min(row[i - 1] + (a != b), row[i] + 1, new[-1] + 1))
                row = new
                if min(row) > unit.edits:
                    break
    return False


@pytest.mark.parametrize("unit", [op.WORDS, op.CHARS])
def test_whole_runs_are_those_of_the_rule(unit):
    rng = random.Random(11)
    items = [(k, text(rng, rng.choice([12, 13, 24, 25, 40, 60]), 60)) for k in range(30)]
    index, counts = op.Index(items, unit), Counter()
    for _ in range(250):
        _, own = items[rng.randrange(30)]
        n = unit.run + rng.randrange(-2, 3)
        start = rng.randrange(max(1, len(own) - n))
        part = edited(rng, own[start : start + n], rng.randrange(unit.edits + 2))
        doc = text(rng, rng.randrange(50), 60) + part + text(rng, rng.randrange(50), 60)
        want = {k for k, u in items if brute_whole(u, doc, unit)}
        assert index.leaks(doc) == want
        counts[bool(want)] += 1
    assert min(counts[True], counts[False]) > 40


@pytest.mark.parametrize("altered", [(2,), (3, 10), (2, 11), (2, 3)])
def test_edits_near_the_ends_of_a_run(altered):
    item = [f"w{k}" for k in range(40)]
    run = [f"y{k}" if k in altered else u for k, u in enumerate(item[5:17], 1)]
    assert op.Index([(1, item)], op.WORDS).leaks(["x"] * 30 + run + ["x"] * 20) == {1}


def test_ends_of_a_run():
    item = [f"w{k}" for k in range(40)]
    index = op.Index([(1, item), (2, item[::-1])], op.WORDS)
    assert index.leaks(item[5:16] + ["x"] * 20) == set()  # eleven words
    assert index.leaks(["x"] * 30 + item[5:17] + ["x"] * 20) == {1}
    assert index.leaks(item[5:10] + ["y"] + item[11:16] + ["y"] + item[17:22]) == {1}
    assert index.leaks(item[5:10] + item[11:15] + ["y"] + item[15:18]) == {1}


def test_search_is_the_plain_sum():
    rng = random.Random(3)
    index = op.Index([(k, text(rng, 40, 30)) for k in range(60)], op.Unit(6, 1, 1))
    for _ in range(100):
        terms = set(op.grams(text(rng, 12, 30), 1))
        score = {}
        for t in terms:
            for k, x in index.postings.get(t, ()):
                score[k] = score.get(k, 0) + x
        assert sorted(index.search(terms)) == sorted(k for k, x in score.items() if x >= 1 - 1e-9)


def test_documents(spark):
    item = "Le meunier pesait chaque carnet gris derrière la forge, parce que l'été durait encore au bord du canal."
    ja = "庭師は温室で湿った練習帳を貸し、硝子屋は二百枚の札を縫い、やがて納屋に封筒を置いた。"
    messy = item.upper().replace("É", "E").replace(" ", "\n", 3).replace("carnet", "car-\nnet")
    docs = [
        (1, f"Avant. {messy} Après.", 1), (2, " ".join(item.split()[:11]), 1), (3, None, 1), (4, "", 1), (5, "x " * 60_000 + item, 1), (5, "x " * 60_000 + item, 1),
        (6, "前に" + ja[4:34].replace("練", "土") + "後に", 1), (7, ja[:20], 1),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id int")
    i = spark.createDataFrame([(10, item, "a"), (11, ja, "a"), (12, None, "a"), (13, "too short", "a"), (10, item, "b")], "item_id long, item_text string, text string")
    assert sorted(map(tuple, op.leaked_items(d, i).collect())) == [(1, 10), (5, 10), (5, 10), (6, 11)]
    assert op.leaked_items(d.limit(0), i).collect() == [] and op.leaked_items(d, i.limit(0)).collect() == []
