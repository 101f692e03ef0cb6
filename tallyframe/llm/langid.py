"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is a bag of hashed byte n-grams of its lower-cased letters. Each n-gram has a small
embedding; the mean of them goes through a linear layer and a softmax. The model is fitted
on the driver by stochastic gradient descent in numpy, on a sample of labelled documents
whose size is bounded by ``sample_rows`` and ``sample_chars``, both parameters; each
language gets an equal share, chosen by a hash of the id. Everything else covers all rows.

Embedding and linear layer are multiplied once after training, so that a prediction adds up
one short row per n-gram of the whole text. Scores are probabilities calibrated by a
temperature, and ``rejected`` marks documents whose score is below a threshold; both are
fitted on a part of the sample that training does not see. The threshold lies below the score
of all but ``reject_share`` of the rightly classified calibration texts, and never above
``REJECT_BELOW``, where even the best guess is more likely wrong than right.

Defined results: a null text, and a text without a letter, gets ``und``, score 0 and
``rejected``. Labels that are null or empty are not learned from. More labels than
``max_languages`` are an error; none is dropped. Without any labelled text
every document is ``und``, and only those without a letter are rejected. Repeated rows are predicted each. Prediction has no shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import arrow_rows, text_batches

UNKNOWN = "und"
GRAMS = (1, 2, 3, 4)
BUCKET_BITS = 16
WIDTH = 16
REJECT_BELOW = 0.4
MAX_LANGUAGES = 200

SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
    ("rejected", pa.bool_()),
])


def letter_bytes() -> np.ndarray:
    """Byte to the byte it is hashed as: letters lower-cased, everything else a space."""
    fold = np.full(256, 32, np.uint8)
    fold[0x80:] = np.arange(0x80, 0x100)
    fold[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
    fold[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
    return fold


FOLD = letter_bytes()


def has_letter(text: str) -> bool:
    """Whether a text holds a letter; number signs such as fractions are none."""
    return any(map(str.isalpha, text))


def gram_buckets(text: bytes) -> np.ndarray:
    """Bucket of every n-gram of a text, all lengths of GRAMS one after another."""
    padded = np.concatenate([[32], FOLD[np.frombuffer(text, np.uint8)], [32]]).astype(np.uint32)
    packed, found = np.zeros_like(padded), []
    for length in range(1, max(GRAMS) + 1):
        if len(padded) < length:
            break
        packed = (packed[:len(padded) - length + 1] << np.uint32(8)) | padded[length - 1:]
        if length in GRAMS:
            mixed = (packed + np.uint32(length)) * np.uint32(2654435761)
            found.append(mixed >> np.uint32(32 - BUCKET_BITS))
    return np.concatenate(found)


def softmax(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(axis=-1, keepdims=True)
    powers = np.exp(logits)
    return powers / powers.sum(axis=-1, keepdims=True)


@dataclass
class LanguageModel:
    """A fitted model: one row of class weights per bucket, and the calibration."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, text: str) -> np.ndarray:
        grams = gram_buckets(text.encode("utf-8"))
        return np.array([
            np.take(row, grams).sum(dtype=np.float64) for row in self.weights
        ]) / len(grams) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, probability, rejected) of one whole text."""
        if not text or not has_letter(text):
            return UNKNOWN, 0.0, True
        if not self.languages:
            return UNKNOWN, 0.0, False
        chances = softmax(self.logits(text) / self.temperature)
        best = int(chances.argmax())
        score = float(chances[best])
        return self.languages[best], score, score < self.threshold


def fit(
    texts: list[str], labels: list[str], epochs: int = 5, rate: float = 2.0,
    reject_share: float = 0.001, seed: int = 7,
) -> LanguageModel:
    """Train on four fifths of the texts and calibrate on the rest."""
    languages = sorted(set(labels))
    classes = np.array([languages.index(label) for label in labels], np.int64)
    buckets, count = 1 << BUCKET_BITS, len(languages)
    if not languages:
        return LanguageModel([], np.zeros((0, buckets), np.float32), np.zeros(0))
    chance = np.random.default_rng(seed)
    bags = [
        np.unique(gram_buckets(text.encode("utf-8")), return_counts=True) for text in texts
    ]
    order = chance.permutation(len(texts))
    held = order[: len(order) // 5]
    train = order[len(order) // 5:]
    embedding = chance.uniform(-1, 1, (buckets, WIDTH)).astype(np.float32) / WIDTH
    linear = np.zeros((WIDTH, count))
    bias = np.zeros(count)
    steps, step = max(1, epochs * len(train)), 0
    for _ in range(epochs):
        for i in chance.permutation(train):
            grams, counts = bags[i]
            share = (counts / counts.sum()).astype(np.float32)
            hidden = share @ embedding[grams]
            error = softmax(hidden @ linear + bias)
            error[classes[i]] -= 1
            pace = rate * (1 - step / steps)
            back = linear @ error
            linear -= pace * np.outer(hidden, error)
            bias -= pace * 0.1 * error
            embedding[grams] -= (pace * 10 * share[:, None] * back[None, :]).astype(np.float32)
            step += 1
    weights = (embedding @ linear).T.astype(np.float32).copy()
    model = LanguageModel(languages, weights, bias)
    calibrate(model, [texts[i] for i in held], classes[held], reject_share)
    return model


def calibrate(model: LanguageModel, texts: list[str], classes: np.ndarray, share: float) -> None:
    """Temperature of least log loss, then the threshold, on texts not trained on."""
    lettered = [i for i, text in enumerate(texts) if has_letter(text)]
    if not lettered:
        return
    logits = np.array([model.logits(texts[i]) for i in lettered])
    truth = classes[lettered]
    def loss(heat: float) -> float:
        return -np.log(softmax(logits / heat)[np.arange(len(truth)), truth] + 1e-12).mean()
    model.temperature = float(min(np.geomspace(0.05, 5, 60), key=loss))
    chances = softmax(logits / model.temperature)
    right = np.sort(chances.max(axis=1)[chances.argmax(axis=1) == truth])
    if len(right):
        model.threshold = min(REJECT_BELOW, 0.9 * float(right[int(share * len(right))]))


def fit_language_model(
    docs: DataFrame, trainable: Column, sample_rows: int = 4000, sample_chars: int = 4_000_000,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    max_languages: int = MAX_LANGUAGES,
) -> LanguageModel:
    """Fit on at most ``sample_rows`` rows for which ``trainable`` holds.

    Rows are chosen per language by a hash of the id, so the sample does not depend on
    how the table is partitioned; of a longer text a run of ``sample_chars / sample_rows``
    characters is learned from, whose place follows from the same hash, which bounds what comes to
    the driver. The table is read twice, to count the labels and to draw the sample, however many
    labels there are. Every label is learned;
    more than ``max_languages`` of them raise a ValueError, as the model and the number of
    samples drawn grow with them.
    """
    chars = max(1, sample_chars // sample_rows)
    turn = F.xxhash64(F.col(id_col).cast("string"))
    body = F.col(text_col).cast("string")
    place = F.pmod(turn, F.greatest(F.length(body) - chars, F.lit(0)) + 1) + 1
    rows = docs.where(trainable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
                      & (F.length(F.trim(F.col(lang_col))) > 0)).select(
        F.col(lang_col).cast("string").alias("lang"), turn.alias("turn"),
        F.substring(body, place.cast("int"), F.lit(chars)).alias("text"),
    )
    kinds = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang")
    kinds = kinds.limit(max_languages + 1).collect()
    if len(kinds) > max_languages:
        raise ValueError(
            f"{lang_col!r} has more than {max_languages} labels; raise max_languages or merge them"
        )
    if not kinds:
        return fit([], [])
    share = math.ceil(sample_rows / len(kinds))
    bounds = []
    for kind in kinds:
        # twice the share by hash range on average, then the smallest hashes
        part = min(1.0, 2 * share / kind["count"] + 0.01)
        bound = min(int(-(1 << 63) + part * (1 << 64)), (1 << 63) - 1)
        bounds += [F.lit(kind["lang"]), F.lit(bound)]
    few = rows.where(F.col("turn") <= F.create_map(*bounds)[F.col("lang")])
    ranked = few.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy("turn", "text"))
    )
    sampled = ranked.where(F.col("rank") <= share).select("lang", "text")
    found = sorted((r["lang"], r["text"]) for r in sampled.collect())
    return fit([text for _, text in found], [lang for lang, _ in found])


def predict_languages(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Predicted language of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: buckets x languages

    def predict(batches):
        fitted = shared.value
        for ids, texts in text_batches(batches):
            rows = [fitted.predict(text) for text in texts]
            yield arrow_rows(
                SCHEMA, doc_id=ids, lang_pred=[r[0] for r in rows],
                score=[r[1] for r in rows], rejected=[r[2] for r in rows],
            )

    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).mapInArrow(predict, "doc_id long, lang_pred string, score double, rejected boolean")


def predicted_language(
    docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Rows of ``docs`` whose language is not rejected, with ``lang_col`` as predicted.

    All columns pass through unchanged but for ``lang_col``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        fitted = shared.value
        for batch in batches:
            found = [fitted.predict(text.as_py()) for text in batch.column(text_col)]
            place = batch.schema.get_field_index(lang_col)
            columns = list(batch.columns)
            columns[place] = pa.array([f[0] for f in found], batch.schema.field(place).type)
            labelled = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield labelled.filter(pa.array([not f[2] for f in found], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
