import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.llm import language
from quillspark.llm.language import (
    build_model,
    calibrate,
    entropies,
    identify,
    learn_languages,
    ngram_keys,
    symbols,
)
from quillspark.llm.queries import LLM_QUERIES
from quillspark.llm.sampling import first_rows, hash_sample

FOLDER = "/root/testdata/sf0.01"


def model_of(*samples):
    parts = []
    for i, (_, text) in enumerate(samples):
        flat, offsets, _ = symbols([text])
        keys, counts = np.unique(ngram_keys(flat, offsets), return_counts=True)
        parts.append((np.full(len(keys), i), keys, counts))
    return build_model(tuple(np.concatenate(x) for x in zip(*parts)), [n for n, _ in samples])


def kneser_ney(text, last, context, order):
    """Interpolated Kneser-Ney written out over dictionaries, for one language."""
    padded = "   " + text
    grams = {order: {}}
    for i in range(len(text)):
        g = padded[i : i + order]
        grams[order][g] = grams[order].get(g, 0) + 1
    for n in range(order - 1, 0, -1):
        grams[n] = {}
        for g in grams[n + 1]:
            grams[n][g[1:]] = grams[n].get(g[1:], 0) + 1
    alphabet = len(grams[1]) + 1

    def discount(n):
        once = sum(c == 1 for c in grams[n].values())
        twice = sum(c == 2 for c in grams[n].values())
        return once / (once + 2 * twice) if once and twice else 0.5

    def probability(n, before):
        if n == 0:
            return 1 / alphabet
        lower = probability(n - 1, before[1:])
        following = {g: c for g, c in grams[n].items() if g[:-1] == before}
        if not following:
            return lower
        total, d = sum(following.values()), discount(n)
        own = max(following.get(before + last, 0) - d, 0) / total
        return own + d * len(following) / total * lower

    return probability(order, context)


def test_probabilities_are_interpolated_kneser_ney():
    text = "the then there that other he her tree thee "
    model = model_of(("en", text))
    for context, last in [("  t", "h"), ("the", "n"), ("the", "r"), ("xyz", "e"), (" th", "x"), ("qth", "e")]:
        keys = 0
        for c in context + last:
            keys = keys << 16 | ord(c)
        got = np.exp(model.log_probabilities(np.array([keys], np.uint64))[0, 0])
        if last in text:
            assert got == pytest.approx(kneser_ney(text, last, context, 4), rel=1e-4)
        else:
            assert 0 < got < 0.1


def test_probabilities_sum_to_one():
    model = model_of(("a", "abc abd aab bca "), ("b", "ddd dcd ccd "))
    alphabet = np.array([ord(c) for c in "abcd "], np.uint64)
    for context in ("abc", "  d", "zzz"):
        packed = np.uint64(0)
        for c in context:
            packed = (packed << np.uint64(16)) | np.uint64(ord(c))
        total = np.exp(model.log_probabilities((packed << np.uint64(16)) | alphabet)).sum(axis=0)
        assert (total <= 1.0001).all() and (total > 0.7).all()


def test_symbols_fold_letters_and_runs():
    flat, offsets, filled = symbols(["A, b\n12c", "", " 12 ", "Éx", "\U00010400z"])
    assert "".join(map(chr, flat[: offsets[1]])) == "a b c "
    assert filled.tolist() == [True, False, False, True, True]
    assert flat[offsets[4]] == language.FAR


def test_texts_without_letters_are_undetermined(documents):
    model = learn_languages(documents((1, "hello there", "en"), (2, "guten tag", "de")))
    docs = documents((1, None), (2, ""), (3, "12 !?"), (4, "the hello"), (None, "tag"), (4, "the hello"))
    got = identify(docs.withColumn("score", F.lit("clash")), model).collect()
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and all(r.score == 0 for r in got[:3])
    assert [r.lang_pred for r in got[3:]] == ["en", "de", "en"]
    assert all(0 <= r.score <= 1 and r.rejected == (r.score < 0.5) for r in got)


def test_nothing_to_learn_from(documents):
    assert learn_languages(documents()) is None
    assert learn_languages(documents((1, None, "en"), (2, "x", None))) is None
    assert {r.lang_pred for r in identify(documents((1, "abc")), None).collect()} == {"und"}


def test_a_single_language_and_long_texts(documents):
    model = learn_languages(documents((1, "abc " * 50_000, "en")))
    calibrate(model, documents((2, "abc", "en"), (3, None, "en")))
    got = identify(documents((1, "abc " * 100_000), (2, "漢")), model).collect()
    assert [r.lang_pred for r in got] == ["en", "en"]


def test_count_cutoff_bounds_the_model(documents):
    docs = documents((1, "aaaa bbbb aaaa " * 20 + "xyzw", "en"))
    assert len(learn_languages(docs, max_ngrams=9).orders[-1].keys) <= 9


def test_samples_are_bounded_and_repeatable(spark):
    rows = spark.range(5000).select("id", F.lit("the same text").alias("text"))

    def sample(rows, most):
        return first_rows(hash_sample(rows, most, "id"), most, "id")

    first = sample(rows, 300).collect()
    assert len(first) == 300 == len(set(first))
    assert sorted(first) == sorted(sample(rows.repartition(7), 300).collect())
    assert sample(rows, 9000).count() == 5000
    assert "text" not in str(sample(rows, 300)._jdf.queryExecution().executedPlan()).split("Scan")[0]


def test_held_out_accuracy(spark):
    rows = LLM_QUERIES["op6_language"](spark, FOLDER).join(
        spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang"), "doc_id"
    )
    out = rows.where("held_out").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.avg("score").alias("score")).first()
    assert out.n > 100 and out.right > 0.98 and out.score > 0.9


def test_lowest_entropy_wins():
    model = model_of(("de", "der die das und ist nicht " * 9), ("en", "the and that is not of " * 9))
    h, n = entropies(model, ["und das ist", "and that is", ""])
    assert h.argmin(axis=1).tolist()[:2] == [0, 1] and n.tolist()[2] == 0


def rare_language(documents):
    """Two large languages whose n-grams are frequent and one of a single short text."""
    return documents(
        *((i, f"the and that is not of {chr(97 + i % 26)}the hello", "en") for i in range(60)),
        *((100 + i, f"der die das und ist nicht {chr(97 + i % 26)}wer guten tag", "de") for i in range(60)),
        (900, "kia ora koutou katoa", "mi"),
    )


def test_a_rare_language_stays_in_a_large_model(documents):
    docs = rare_language(documents)
    model = learn_languages(docs, max_ngrams=50)
    assert model.langs == ["de", "en", "mi"]
    calibrate(model, docs)
    texts = documents((1, "ora koutou"), (1, "ora koutou"), (2, "hello that"), (3, "12"), (4, None), (5, "nicht"))
    got = sorted((r.doc_id, r.lang_pred) for r in identify(texts, model).collect())
    assert got == [(1, "mi"), (1, "mi"), (2, "en"), (3, "und"), (4, "und"), (5, "de")]


def test_joined_and_shipped_models_agree(documents):
    docs = rare_language(documents)
    shipped, joined = learn_languages(docs), learn_languages(docs, max_ngrams=50)
    assert shipped.tables is None and joined.tables is not None
    assert joined.unseen == pytest.approx(shipped.unseen, rel=1e-4)
    for n, level in enumerate(shipped.orders, 1):
        rows = joined.tables.logs[n - 1].collect()
        assert sorted(np.uint64(r.key & (2**64 - 1)) for r in rows) == level.keys.tolist()
        for r in rows:
            at = np.searchsorted(level.keys, np.uint64(r.key & (2**64 - 1)))
            for lang, log in r.logs.items():
                assert log == pytest.approx(level.logs[at, lang], abs=1e-4)
    texts = documents((1, "the ora tagx"), (2, "zq 漢字 \U00010400"), (3, "und hello katoa " * 500), (4, "!"))
    a, b = ({r.doc_id: r for r in identify(texts, m).collect()} for m in (shipped, joined))
    for i in a:
        assert a[i].lang_pred == b[i].lang_pred and a[i].score == pytest.approx(b[i].score, abs=1e-3)
