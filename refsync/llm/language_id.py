"""Language identification as inference in a mixture of languages.

Each learned language is a distribution over letter n-grams. A document is a mixture of them: expectation-maximisation
estimates the proportions from the n-grams' likelihoods under each language. Which languages take part is chosen by
penalised likelihood: from the most likely single language on, a language joins if the best mixture with it raises the
log-likelihood by more than `PENALTY` * log(n-grams). The predicted language is the one with the largest proportion, the
score is that proportion.

The model is learned from counts over all training rows: tasks count the n-grams of each language into `BUCKETS`
buckets and send sums, so the driver receives at most languages * buckets numbers. Whole texts are counted, in slices.

Nulls: a null text, or one without a letter, gets `und` with score 0; rows with a null language teach nothing. If there
is nothing to learn from, all rows get `und`. Equal likelihoods go to the language that comes first by name. Repeated
rows are predicted each; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refsync.llm import textops

BUCKETS = 1 << 14
SIZES = (1, 2, 3)
SMOOTHING = 0.05
PENALTY = 4.0
STEPS = 25
UNKNOWN = "und"
SLICE_BYTES = 1 << 18
_STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _letters() -> np.ndarray:
    flags = np.zeros(0x110000, bool)
    flags[[i for i in range(0x110000) if chr(i).isalpha()]] = True
    return flags


_is_letter: np.ndarray | None = None


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket, count) of the n-grams of letters of each text, and no others.

    A run of other characters counts as one blank; every text begins and ends with one.
    """
    global _is_letter
    if _is_letter is None:
        _is_letter = _letters()
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("\n".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    letter = _is_letter[points]
    kept = letter.copy()
    kept[1:] |= letter[:-1]  # the first of a run of others stands for the run
    kept[0] = True
    place = np.flatnonzero(kept)
    symbol = np.where(letter[place], points[place], 0).astype(np.uint64)
    owner = np.searchsorted(ends, place)  # the text that the character belongs to; its last blank goes with it
    rows, buckets = [], []
    value = np.zeros(len(symbol), np.uint64)
    for size in SIZES:
        value = value[: len(symbol) - size + 1] if size > 1 else value
        value = textops.mix(value + symbol[size - 1 :] * _STEP[0] + _STEP[1])
        last = owner[size - 1 :]
        first = owner[: len(value)] if size > 1 else owner
        first = np.where(symbol[: len(value)] == 0, last, first)  # a blank at the end of a text also begins the next
        some = (first == last) & ((symbol[: len(value)] != 0) | (size > 1))
        rows.append(last[some])
        buckets.append((value[some] % np.uint64(BUCKETS)).astype(np.int64))
    key = np.concatenate(rows) * BUCKETS + np.concatenate(buckets)
    key, count = np.unique(key, return_counts=True)
    return key // BUCKETS, key % BUCKETS, count


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _text_slices(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) in slices of bounded size; null is empty. Long texts are alone in their slice."""
    data, offsets = textops.text_buffers(column)
    for first, last in textops.slices(offsets, SLICE_BYTES):
        yield first, [data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace") for i in range(first, last)]


def count_grams(labelled: DataFrame) -> DataFrame:
    """(lang, bucket, n) of a table of (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for first, texts in _text_slices(batch.column(1)):
                row, bucket, count = grams(texts)
                own = langs[first : first + len(texts)]
                for lang in set(own):
                    if lang not in total:
                        total[lang] = np.zeros(BUCKETS, np.int64)
                    some = (own == lang)[row]
                    total[lang] += np.bincount(bucket[some], count[some], BUCKETS).astype(np.int64)
        for lang, counts in total.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(counts[used])], ["lang", "bucket", "n"])

    counts = labelled.mapInArrow(run, "lang string, bucket bigint, n bigint")
    return counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Log-likelihoods of the buckets under each language, and the inference of mixtures."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        smoothed = counts + SMOOTHING
        self.likelihood = (smoothed / smoothed.sum(axis=1, keepdims=True)).T.copy() if langs else np.zeros((BUCKETS, 0))
        self.log = np.log(self.likelihood)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """(language, proportion) of each text."""
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        lettered = np.flatnonzero([has_letter(t) for t in texts])
        if not len(lettered) or not self.langs:
            return langs, scores
        row, bucket, count = grams([texts[i] for i in lettered])
        starts = np.searchsorted(row, np.arange(len(lettered)))
        counts = count.astype(np.float64)
        total = np.add.reduceat(counts, starts)
        single = np.add.reduceat(self.log[bucket] * counts[:, None], starts, axis=0)
        mixture = np.zeros((len(lettered), len(self.langs)))
        mixture[np.arange(len(lettered)), single.argmax(axis=1)] = 1
        best = single.max(axis=1)
        active = np.arange(len(lettered))
        # languages join one at a time while the penalised likelihood rises; only texts that took one go on
        for _ in range(len(self.langs) - 1):
            active, mixture, best = self._extend(active, mixture, best, row, bucket, counts, starts, total)
            if not len(active):
                break
        chosen = mixture.argmax(axis=1)
        for i, place in enumerate(lettered.tolist()):
            langs[place] = self.langs[chosen[i]]
        scores[lettered] = mixture.max(axis=1)
        return langs, np.clip(scores, 0, 1)

    def _extend(self, active, mixture, best, row, bucket, counts, starts, total):
        """Let the language with the steepest rise of the likelihood join, where that can pay, and fit the mixture.

        The log-likelihood is concave, so a language whose slope on entering is below the penalty cannot earn it.
        """
        ends = np.append(starts, len(row))

        def rows_of(texts):
            sizes = ends[texts + 1] - ends[texts]
            first = np.cumsum(sizes) - sizes
            own = np.repeat(ends[texts] - first, sizes) + np.arange(sizes.sum())
            return self.likelihood[bucket[own]], counts[own], np.repeat(np.arange(len(texts)), sizes), first

        penalty = PENALTY * np.log(total + 1)
        likelihood, weight, of, first = rows_of(active)
        now = mixture[active]
        mixed = np.einsum("ij,ij->i", likelihood, now[of])
        slope = np.add.reduceat(likelihood * (weight / mixed)[:, None], first, axis=0) - total[active][:, None]
        slope[now > 0] = -np.inf
        joining = slope.argmax(axis=1)
        viable = slope.max(axis=1) > penalty[active]
        active, now, joining = active[viable], now[viable], joining[viable]
        if not len(active):
            return active, mixture, best
        likelihood, weight, of, first = rows_of(active)
        trial = now * 0.8
        trial[np.arange(len(active)), joining] = 0.2
        for _ in range(STEPS):
            mixed = np.einsum("ij,ij->i", likelihood, trial[of])
            trial = trial * np.add.reduceat(likelihood * (weight / mixed)[:, None], first, axis=0) / total[active][:, None]
        mixed = np.einsum("ij,ij->i", likelihood, trial[of])
        reached = np.add.reduceat(np.log(mixed) * weight, first)
        taken = reached - best[active] > penalty[active]
        mixture[active[taken]] = trial[taken]
        best[active[taken]] = reached[taken]
        return active[taken], mixture, best


def train(labelled: DataFrame) -> Model:
    """Model from a table of (lang, text), without null languages."""
    rows = count_grams(labelled).toPandas()
    langs = sorted(rows["lang"].unique())
    counts = np.zeros((len(langs), BUCKETS))
    for i, lang in enumerate(langs):
        own = rows[rows["lang"] == lang]
        counts[i, own["bucket"].to_numpy()] = own["n"].to_numpy()
    return Model(langs, counts)


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`docs`, or its columns `keep`, with lang_pred and score (columns of these names are replaced)."""
    names = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    # the text goes to the tasks once, also where it is one of the columns to keep
    source = docs.select(*names) if text in names else docs.select(*names, docs[text].alias("__text"))
    at = names.index(text) if text in names else len(names)
    model_of = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for _, texts in _text_slices(batch.column(at)):
                lang, score = model_of.value.predict(texts)
                langs += lang
                scores.append(score)
            columns = [*batch.columns[: len(names)], pa.array(langs, pa.string()), pa.array(np.concatenate([np.zeros(0), *scores]))]
            yield pa.RecordBatch.from_arrays(columns, [*names, "lang_pred", "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[: len(names)])
    return source.mapInArrow(run, f"{fields}, lang_pred string, score double")


def fold(doc_id: Column) -> Column:
    """Fold 0, 1 or 2 of a document; null ids are in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3, F.lit(0))


def train_on_folds(docs: DataFrame, held_out: int | None = 1) -> Model:
    """Model from the documents (doc_id, text, lang) outside the held-out fold."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if held_out is not None:
        known = known.filter(fold(F.col("doc_id")) != held_out)
    return train(known.select("lang", "text"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; fold 1 is held out from learning."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train_on_folds(docs)
    return predict(docs.withColumn("held_out", fold(F.col("doc_id")) == 1), model, keep=["doc_id", "held_out"])


QUERIES = {"op3_language_id": op3_language_id}
SQL: dict[str, str] = {}
