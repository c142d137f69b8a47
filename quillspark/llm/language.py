"""Language identification by interpolated Kneser-Ney models of characters.

One model per language counts n-grams of folded characters. All models share sorted arrays of
packed n-grams, each with a row of log probabilities (a column per language), so a text is
scored by binary searches alone. A model of too many n-grams for that stays in tables, built in
Spark, and texts are scored by joins with them; no n-gram is left out either way. The language
of lowest cross-entropy per character wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.sampling import first_rows, hash_sample
from quillspark.llm.words import plain_texts, slices
from quillspark.session import store

ORDER = 4
BLANK = 0x20
#: Letters beyond the basic plane share one symbol.
FAR = 0xFFFF
#: Most n-grams of a model that is sent to the workers; a larger one is joined.
MAX_NGRAMS = 1_000_000
#: Most rows that calibration is fitted on.
CALIBRATION_ROWS = 20_000
_LANE = np.uint64(16)


def _symbols() -> np.ndarray:
    """Code point to symbol: a letter's lower case (one code point), blank for all else."""
    table = np.full(0x10000, BLANK, np.uint16)
    for code in range(0x10000):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


_TABLE = _symbols()


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts, n + 1 offsets, and which texts have a letter.

    A text is its letters with single blanks around every run of them; one without letters
    gives nothing.
    """
    codes = np.frombuffer("".join(t + "\n" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    near = codes < 0x10000
    folded = _TABLE[np.where(near, codes, 0)]
    if not near.all():
        far = np.flatnonzero(~near)
        letters = [chr(c).isalpha() for c in codes[far].tolist()]
        folded[far] = np.where(letters, FAR, BLANK)
    ends = np.cumsum([len(t) + 1 for t in texts])
    heads = ends - [len(t) + 1 for t in texts]
    blank = folded == BLANK
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]  # the first blank after letters
    keep[heads] = ~blank[heads]  # a text begins as after a blank
    kept = np.concatenate([[0], np.cumsum(keep)])
    offsets = np.concatenate([kept[heads], [kept[-1]]]).astype(np.int64)
    return folded[keep], offsets, np.diff(offsets) > 0


def ngram_keys(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each symbol, it and the ORDER - 1 before it packed in 64 bits; blanks before a text."""
    wide = flat.astype(np.uint64)
    place = np.arange(len(flat)) - np.repeat(offsets[:-1], np.diff(offsets))
    keys = wide.copy()
    for back in range(1, ORDER):
        earlier = np.full(len(flat), BLANK, np.uint64)
        earlier[back:] = wide[: len(flat) - back]
        earlier[place < back] = BLANK
        keys |= earlier << np.uint64(16 * back)
    return keys


def count_ngrams(rows: DataFrame) -> DataFrame:
    """(lang, key, n): occurrences of each n-gram of the highest order in rows (text, lang)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(parts) -> tuple[np.ndarray, np.ndarray]:
            keys = np.concatenate([k for k, _ in parts])
            counts = np.concatenate([c for _, c in parts])
            distinct, place = np.unique(keys, return_inverse=True)
            return distinct, np.bincount(place, counts, len(distinct)).astype(np.int64)

        def batch(lang: str) -> pa.RecordBatch:
            keys, counts = merged(held.pop(lang))
            columns = [pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(counts)]
            return pa.RecordBatch.from_arrays(columns, ["lang", "key", "n"])

        for rows_ in batches:
            langs = np.array(rows_.column(1).to_pylist(), dtype=object)
            for start, stop in slices(rows_.column(0)):
                texts = plain_texts(rows_.column(0).slice(start, stop - start)).to_pylist()
                here = langs[start:stop]
                for lang in sorted(set(here.tolist())):
                    flat, offsets, _ = symbols([t for t, x in zip(texts, here) if x == lang])
                    parts = held.setdefault(lang, [])
                    parts.append(np.unique(ngram_keys(flat, offsets), return_counts=True))
                    if len(parts) > 8:
                        held[lang] = parts = [merged(parts)]
                    if sum(len(k) for k, _ in parts) > 1_000_000:
                        yield batch(lang)
        for lang in list(held):
            yield batch(lang)

    parts = rows.select("text", "lang").mapInArrow(run, "lang string, key bigint, n bigint")
    return parts.groupBy("lang", "key").agg(F.sum("n").alias("n"))


@dataclass
class Order:
    """n-grams of one order, sorted, with a row of log probabilities each; and their contexts
    (n - 1 symbols), sorted, with the log weight of backing off."""

    keys: np.ndarray
    logs: np.ndarray
    contexts: np.ndarray
    backoff: np.ndarray


@dataclass
class JoinedModel:
    """A model as tables, from order 1 to ORDER, a row per n-gram: (key, logs: a map from the
    number of each language that has it to its log probability), and per context (context,
    backoff: such a map of log weights; none at order 1)."""

    logs: list[DataFrame] = field(default_factory=list)
    backoff: list[DataFrame | None] = field(default_factory=list)


@dataclass
class LanguageModel:
    langs: list[str]
    orders: list[Order]  # from 1 to ORDER
    unseen: np.ndarray  # log probability of a symbol no text has had, per language
    bias: float = 0.0
    slopes: tuple[float, float] = (10.0, 0.0)
    tables: JoinedModel | None = None  # all n-grams, if they are joined; ``orders`` is empty then

    def log_probabilities(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Rows of log probabilities of the last symbol of each packed n-gram."""
        if order == 0:
            return np.broadcast_to(self.unseen, (len(keys), len(self.langs)))
        level = self.orders[order - 1]
        keys = keys & np.uint64((1 << (16 * order)) - 1)
        place = np.minimum(np.searchsorted(level.keys, keys), len(level.keys) - 1)
        out = level.logs[place]
        missing = np.flatnonzero(level.keys[place] != keys)
        if len(missing):
            lost = keys[missing]
            lower = self.log_probabilities(lost, order - 1).copy()
            context = lost >> _LANE
            at = np.minimum(np.searchsorted(level.contexts, context), len(level.contexts) - 1)
            known = level.contexts[at] == context
            lower[known] += level.backoff[at[known]]
            out[missing] = lower
        return out


def _discount(counts: np.ndarray) -> float:
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return once / (once + 2 * twice) if once and twice else 0.5


def build_model(grams: list[tuple[str, int, int]] | tuple, langs: list[str]) -> LanguageModel:
    """Interpolated Kneser-Ney models from arrays (language number, key, count).

    The highest order uses counts; a lower one counts in how many contexts of the next higher
    order its n-gram stands. Each order has one discount per language.
    """
    lang, key, count = grams
    size = len(langs)
    per_lang = []
    for i in range(size):
        keys, counts = key[lang == i], count[lang == i]
        order = np.argsort(keys)
        levels = {ORDER: (keys[order], counts[order])}
        for n in range(ORDER - 1, 0, -1):
            shorter = levels[n + 1][0] & np.uint64((1 << (16 * n)) - 1)
            levels[n] = np.unique(shorter, return_counts=True)
        per_lang.append(levels)
    alphabet = len(np.unique(np.concatenate([p[1][0] for p in per_lang]))) + 1
    unseen = np.zeros(size)
    orders: list[Order] = []
    model = LanguageModel(langs, orders, unseen)
    for n in range(1, ORDER + 1):
        facts = []
        for levels in per_lang:
            keys, counts = levels[n]
            contexts, inverse = np.unique(keys >> _LANE, return_inverse=True)
            d = _discount(counts)
            totals = np.bincount(inverse, counts, len(contexts))
            kinds = np.bincount(inverse, minlength=len(contexts))
            facts.append((keys, counts, contexts, inverse, d, totals, d * kinds / np.maximum(totals, 1)))
        if n == 1:
            for i, f in enumerate(facts):
                weight = f[6][0] if len(f[6]) else 1.0
                unseen[i] = np.log(weight / alphabet)
            base = 1.0 / alphabet
        keys = np.unique(np.concatenate([f[0] for f in facts]))
        contexts = np.unique(np.concatenate([f[2] for f in facts]))
        lower = model.log_probabilities(keys, n - 1) if n > 1 else np.full((len(keys), size), np.log(base))
        logs = np.empty((len(keys), size), np.float32)
        backoff = np.zeros((len(contexts), size), np.float32)
        for i, (own, counts, ctx, inverse, d, totals, weights) in enumerate(facts):
            if len(ctx):
                backoff[np.searchsorted(contexts, ctx), i] = np.log(weights)
            at = np.searchsorted(contexts, keys >> _LANE)
            probability = np.exp(lower[:, i] + backoff[at, i])
            probability[np.searchsorted(keys, own)] += np.maximum(counts - d, 0) / totals[inverse]
            logs[:, i] = np.log(probability)
        if n == 1:
            backoff[:] = 0  # unseen symbols have their own value
        orders.append(Order(keys, logs, contexts, backoff))
    return model


def _last(key: str, order: int) -> Column:
    """The last ``order`` symbols of a packed n-gram."""
    return F.col(key) if order == ORDER else F.col(key).bitwiseAND((1 << (16 * order)) - 1)


def _by_language(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """(key, map from language to value)."""
    entries = F.map_from_entries(F.collect_list(F.struct("lang", value)))
    return store(rows.groupBy(key).agg(entries.alias(name)), name)


def build_tables(counts: DataFrame, langs: list[str]) -> LanguageModel:
    """The model of ``build_model`` from a table (language number, key, n), in Spark throughout;
    to the driver come one row per order and language."""
    spark = counts.sparkSession
    levels = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):
        shorter = levels[n + 1].select("lang", _last("key", n).alias("key"))
        levels[n] = store(shorter.groupBy("lang", "key").agg(F.count(F.lit(1)).alias("n")), "ngrams")
    alphabet = levels[1].select("key").distinct().count() + 1
    unseen = np.zeros(len(langs))
    tables = JoinedModel()
    lower = None
    for n in range(1, ORDER + 1):
        once, twice = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        least = F.when((once > 0) & (twice > 0), once / (once + 2 * twice)).otherwise(0.5)
        discounts = levels[n].groupBy("lang").agg(least.alias("d")).collect()
        discounts = spark.createDataFrame([tuple(r) for r in discounts], "lang int, d double")
        grams = levels[n].withColumn("context", F.shiftrightunsigned("key", 16))
        contexts = grams.groupBy("lang", "context").agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")
        )
        contexts = contexts.join(F.broadcast(discounts), "lang")
        contexts = contexts.withColumn("weight", F.col("d") * F.col("kinds") / F.col("total"))
        contexts = store(contexts, "contexts")
        grams = grams.join(contexts, ["lang", "context"])
        if n == 1:
            for r in contexts.collect():  # the empty context, once per language
                unseen[r.lang] = np.log(r.weight / alphabet)
            below = F.lit(1.0 / alphabet)
        else:
            grams = grams.withColumn("shorter", _last("key", n - 1)).join(lower, ["lang", "shorter"])
            below = F.col("below")
        seen = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")
        grams = grams.select("lang", "key", (seen + F.col("weight") * below).alias("p"))
        grams = store(grams, "probabilities")
        lower = grams.select("lang", F.col("key").alias("shorter"), F.col("p").alias("below"))
        logs = grams.select("lang", "key", F.log("p").alias("log"))
        tables.logs.append(_by_language(logs, "key", "log", "logs"))
        weights = contexts.select("lang", "context", F.log("weight").alias("log"))
        tables.backoff.append(_by_language(weights, "context", "log", "backoff") if n > 1 else None)
    keys, logs = np.empty(0, np.uint64), np.empty((0, len(langs)), np.float32)
    none = Order(keys, logs, keys, logs)
    return LanguageModel(langs, [none] * ORDER, unseen, tables=tables)


def learn_languages(rows: DataFrame, max_ngrams: int = MAX_NGRAMS) -> LanguageModel | None:
    """Model from all rows (text, lang) whose language is known; None if there are none.

    n-grams are counted in the tasks and added up by a shuffle, and all of them make the model.
    Up to ``max_ngrams`` of them come to the driver and, as the model, to the workers; more stay
    in tables. Both give the same probabilities.
    """
    known = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = store(count_ngrams(known), "ngrams")
    langs = sorted((r.lang for r in counts.select("lang").distinct().collect()), key=str.encode)
    if not langs:
        return None
    number = {x: i for i, x in enumerate(langs)}
    if counts.count() > max_ngrams:
        numbers = rows.sparkSession.createDataFrame(list(number.items()), "name string, number int")
        named = counts.join(F.broadcast(numbers), F.col("lang") == F.col("name"))
        return build_tables(named.select(F.col("number").alias("lang"), "key", "n"), langs)
    table = counts.toArrow()
    coded = table["lang"].combine_chunks().dictionary_encode()
    names = np.array([number[x] for x in coded.dictionary.to_pylist()])
    return build_model(
        (
            names[coded.indices.to_numpy()],
            table["key"].to_numpy().view(np.uint64),
            table["n"].to_numpy(),
        ),
        langs,
    )


def entropies(model: LanguageModel, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy per symbol of each text and language (nats), and the texts' symbols."""
    flat, offsets, filled = symbols(texts)
    out = np.zeros((len(texts), len(model.langs)))
    counts = np.diff(offsets)
    if len(flat):
        logs = model.log_probabilities(ngram_keys(flat, offsets))
        sums = np.add.reduceat(logs, offsets[:-1][filled], axis=0, dtype=np.float64)
        out[filled] = -sums / counts[filled, None]
    return out, counts


_SCORED = "struct<best: int, margin: double, symbols: bigint>"


def _joined_scores(rows: DataFrame, tables: JoinedModel, unseen: np.ndarray) -> DataFrame:
    """(_row, _s) of rows (_row, text) that have a letter, by joins with all n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(1), 1 << 20):
                texts = plain_texts(batch.column(1).slice(start, stop - start)).to_pylist()
                flat, offsets, _ = symbols(texts)
                keys, counts = ngram_keys(flat, offsets), np.diff(offsets)
                owner = np.repeat(batch.column(0).slice(start, stop - start).to_numpy(), counts)
                order = np.lexsort((keys, owner))
                owner, keys = owner[order], keys[order]
                first = np.ones(len(keys), bool)
                first[1:] = (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])
                heads = np.flatnonzero(first)
                times = np.diff(np.append(heads, len(keys)))
                columns = [pa.array(owner[heads]), pa.array(keys[heads].view(np.int64)), pa.array(times)]
                yield pa.RecordBatch.from_arrays(columns, ["_row", "key", "n"])

    used = store(rows.select("_row", "text").mapInArrow(run, "_row bigint, key bigint, n bigint"), "used")
    keys = used.select("key").distinct()
    for n in range(1, ORDER + 1):
        keys = keys.withColumn("_at", _last("key", n)).withColumn("_c", F.shiftrightunsigned("_at", 16))
        logs = tables.logs[n - 1].select(F.col("key").alias("_at"), F.col("logs").alias(f"_l{n}"))
        keys = keys.join(logs, "_at", "left")
        if n > 1:
            weights = tables.backoff[n - 1]
            weights = weights.select(F.col("context").alias("_c"), F.col("backoff").alias(f"_w{n}"))
            keys = keys.join(weights, "_c", "left")
    value = F.get(F.lit(unseen.tolist()), F.col("lang"))
    for n in range(1, ORDER + 1):
        if n > 1:
            value += F.coalesce(F.try_element_at(F.col(f"_w{n}"), F.col("lang")), F.lit(0.0))
        value = F.coalesce(F.try_element_at(F.col(f"_l{n}"), F.col("lang")), value)
    numbers = F.explode(F.sequence(F.lit(0), F.lit(len(unseen) - 1))).alias("lang")
    keys = keys.select("*", numbers).select("key", "lang", value.alias("log"))
    sums = used.join(keys, "key").groupBy("_row", "lang").agg(
        F.sum(F.col("n") * F.col("log")).alias("log"), F.sum("n").alias("symbols")
    )
    pair = F.struct((-F.col("log") / F.col("symbols")).alias("h"), "lang")
    best = sums.groupBy("_row").agg(F.array_sort(F.collect_list(pair)).alias("h"), F.max("symbols").alias("symbols"))
    first, second = F.get("h", F.lit(0)), F.get("h", F.lit(1))
    margin = F.coalesce(second["h"] - first["h"], F.lit(1.0))
    scored = F.struct(first["lang"].alias("best"), margin.alias("margin"), "symbols")
    return best.select("_row", scored.cast(_SCORED).alias("_s"))


def _with_scores(rows: DataFrame, model: LanguageModel) -> DataFrame:
    """Add ``_s``: best language, margin and symbols of ``text``."""
    if model.tables is None:
        return rows.withColumn("_s", _scores(rows, model)(F.col("text")))
    # generated row numbers are fixed by storing them
    rows = store(rows.withColumn("_row", F.monotonically_increasing_id()), "texts")
    scored = _joined_scores(rows, model.tables, model.unseen)
    none = F.struct(F.lit(-1).alias("best"), F.lit(0.0).alias("margin"), F.lit(0).alias("symbols"))
    rows = rows.join(scored, "_row", "left").drop("_row")
    return rows.withColumn("_s", F.coalesce("_s", none.cast(_SCORED)))


def _scores(df: DataFrame, model: LanguageModel):
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(_SCORED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        for texts in batches:
            best, margin, length = [], [], []
            for start, stop in slices(texts, 1 << 20):
                part = plain_texts(texts.slice(start, stop - start)).to_pylist()
                h, n = entropies(known, part)
                order = np.sort(h, axis=1)
                best.append(np.where(n > 0, h.argmin(axis=1), -1))
                gap = order[:, 1] - order[:, 0] if h.shape[1] > 1 else np.ones(len(part))
                margin.append(gap)
                length.append(n)
            none = np.empty(0)
            yield pa.StructArray.from_arrays(
                [
                    pa.array(np.concatenate([none, *best]).astype(np.int32)),
                    pa.array(np.concatenate([none, *margin])),
                    pa.array(np.concatenate([none, *length]).astype(np.int64)),
                ],
                ["best", "margin", "symbols"],
            )

    return run


def calibrate(model: LanguageModel, rows: DataFrame, most: int = CALIBRATION_ROWS) -> None:
    """Fit the chance of being right to the margin, by penalised Newton steps on at most ``most``
    rows (text, lang) that the model hasn't learnt from, those with the smallest hashes of their
    doc_id, or of their text if they have none."""
    key = "doc_id" if "doc_id" in rows.columns else "text"
    known = rows.where(F.col("lang").isNotNull())
    known = hash_sample(known, most, key).select("text", "lang", "_place")
    scored = _with_scores(known, model).where("_s.best >= 0")
    scored = scored.select("_place", "lang", "_s.best", "_s.margin", "_s.symbols")
    data = first_rows(scored, most, "lang", "best", "margin", "symbols").collect()
    x = np.array([(1.0, r.margin, r.margin * np.log1p(r.symbols)) for r in data]).reshape(-1, 3)
    y = np.array([model.langs[r.best] == r.lang for r in data], float)
    b = start = np.array([0.0, 1.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        w = p * (1 - p) + 1e-9
        gradient = x.T @ (y - p) - 0.05 * (b - start)
        step = np.linalg.solve(x.T @ (x * w[:, None]) + 0.05 * np.eye(3), gradient)
        b = b + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    model.bias, model.slopes = float(b[0]), (float(b[1]), float(b[2]))


def identify(docs: DataFrame, model: LanguageModel | None, reject: float = 0.5) -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1) and ``rejected`` from ``text`` alone.

    A null text, and one without a letter, is ``und`` with score 0; so is every text if the
    model is None. ``rejected`` marks texts whose score, the calibrated chance that the
    prediction is right, is under ``reject``. Equal entropies go to the language first in order.
    Whole texts are scored; columns of these names are replaced. No shuffle, but for a model
    that is joined: then the rows are stored once with a number of their own.
    """
    rows = docs.drop("lang_pred", "score", "rejected")
    if model is None:
        return rows.withColumns(
            {"lang_pred": F.lit("und"), "score": F.lit(0.0), "rejected": F.lit(True)}
        )
    names = F.array(*[F.lit(x) for x in model.langs])
    rows = _with_scores(rows, model)
    margin, length = F.col("_s.margin"), F.col("_s.symbols")
    a, b = model.slopes
    odds = F.lit(model.bias) + margin * a + margin * F.log1p(length.cast("double")) * b
    found = F.col("_s.best") >= 0
    score = F.when(found, 1 / (1 + F.exp(-odds))).otherwise(0.0)
    return rows.withColumns(
        {
            "lang_pred": F.when(found, F.get(names, F.col("_s.best"))).otherwise(F.lit("und")),
            "score": score,
            "rejected": score < reject,
        }
    ).drop("_s")
