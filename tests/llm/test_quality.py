import random
import re

import pytest
from pyspark.sql import functions as F

from quillspark.llm import quality
from quillspark.llm.quality import BAD, GOOD, fit_rules, fit_votes, judge, keep_good, measures


def brute(text):
    """The base measures, counted word by word."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    repeated = {
        j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)
    }
    seen, lines = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        lines,
        len(repeated),
    )


def texts():
    rng = random.Random(4)
    odd = [None, "", " \t", "a", "a\n\na\n \na", "é漢 👍 x y z\x1cw", "a b c d e " * 40, "##|| <>"]
    odd += ["\n".join(rng.choices(["x y", "z", "", " "], k=9)) for _ in range(20)]
    return odd + [" ".join(rng.choices("abc", k=rng.randrange(40))) for _ in range(60)]


def test_measures_equal_brute_force(documents):
    rows = list(enumerate(texts())) + [(None, "x"), (1, ""), (7000, " ".join(str(i) for i in range(7000)) + " 1 2 3 4 5")]
    docs = documents(*rows).withColumn("m", measures(F.col("text"))).select("doc_id", "m.*")
    got = [(r.doc_id, *list(r)[1:6]) for r in docs.collect()]
    assert sorted(got, key=repr) == sorted(((i, *brute(t)) for i, t in rows), key=repr)


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rng.choice(["tree", "house", "water", "walks", "green"]) + str(rng.randrange(50)) for _ in range(60)]
        if i % 10 == 0:
            words = [w + "###" for w in words]
        if i % 10 == 1:
            words = [x for w in words for x in (w, "|")]
        rows.append((i, " ".join(words)))
    return rows


def test_junk_is_rejected_and_prose_stays(documents):
    docs = documents(*corpus(), (9000, "too short"), (9001, None))
    measured = docs.select("doc_id", measures(F.col("text")).alias("m"))
    verdicts = {r.doc_id: r for r in judge(measured, "m", fit_rules(measured, "m")).collect()}
    assert all(verdicts[i].kept == (i % 10 > 1) for i in range(600))
    assert verdicts[9000].base_failed and not verdicts[9001].kept
    kept = keep_good(docs.withColumn("m", F.lit("clash")))
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(600) if i % 10 > 1]
    assert kept.columns == [*docs.columns, "m"]


def test_no_documents(documents):
    assert keep_good(documents()).count() == 0


def test_posterior_follows_bayes():
    model = fit_votes({(GOOD, GOOD): 90, (BAD, BAD): 9, (0, BAD): 1}, 2)
    (g1, b1), (g2, b2) = model.chances

    def chance(pair, vote):
        return pair[0] if vote == GOOD else pair[1] if vote == BAD else 1 - sum(pair)

    for votes in [(GOOD, GOOD), (BAD, BAD), (0, BAD), (BAD, GOOD)]:
        good = model.prior * chance(g1, votes[0]) * chance(g2, votes[1])
        bad = (1 - model.prior) * chance(b1, votes[0]) * chance(b2, votes[1])
        assert model.posterior(votes) == pytest.approx(good / (good + bad), rel=1e-6)
    assert model.posterior((GOOD, GOOD)) > 0.9 and model.posterior((BAD, BAD)) < 0.1


def test_accuracies_are_recovered():
    """Votes drawn from known chances: the model finds them without labels."""
    rng = random.Random(2)
    truth = [((0.9, 0.02), (0.3, 0.6)), ((0.8, 0.05), (0.2, 0.7)), ((0.85, 0.03), (0.4, 0.5))]
    counts = {}
    for _ in range(40_000):
        good = rng.random() < 0.85
        votes = []
        for pair in truth:
            up, down = pair[0] if good else pair[1]
            x = rng.random()
            votes.append(GOOD if x < up else BAD if x < up + down else 0)
        counts[tuple(votes)] = counts.get(tuple(votes), 0) + 1
    model = fit_votes(counts, 3)
    assert model.prior == pytest.approx(0.85, abs=0.03)
    for got, want in zip(model.chances, truth):
        assert got[0] == pytest.approx(want[0], abs=0.04) and got[1] == pytest.approx(want[1], abs=0.08)


def test_column_and_model_agree(documents):
    docs = documents(*corpus(50))
    measured = docs.select("doc_id", measures(F.col("text")).alias("m"))
    model = fit_rules(measured, "m")
    votes = F.array(*[r.vote(F.col("m")) for r in quality.RULES])
    rows = measured.select(votes.alias("v"), quality.quality(F.col("m"), model).alias("q")).collect()
    assert all(r.q == pytest.approx(model.posterior(r.v), rel=1e-6) for r in rows)


def test_columns_of_the_added_names(documents):
    docs = documents((1, "these are some plain words of a good document that says what it says " * 3), (2, None))
    clash = docs.withColumns({"quality": F.lit("x"), "kept": F.lit("y"), "_measures": F.lit("z"), "n_words": F.lit(-1)})
    assert keep_good(clash).columns == clash.columns
    rows = clash.withColumn("m", measures(F.col("text")))
    judged = judge(rows, "m", fit_rules(rows, "m"))
    assert len(set(judged.columns)) == len(judged.columns)
    assert {r.doc_id: (r.n_words, r.kept) for r in judged.collect()}[2] == (0, False)
