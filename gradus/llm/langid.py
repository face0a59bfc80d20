"""Language of a text: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradus.llm.base import broadcast_if_small, draw, trainable

UNKNOWN = "und"
ORDERS = (1, 2, 3)
BITS = 16

# Labelled documents of each language that a training reads, at most about so many.
TRAINING_DOCUMENTS = 4000

# A text fits a language if its mean log-probability per n-gram is at most FIT_MARGIN below nearly all
# training documents; a text of n n-grams may be FIT_SHORT / sqrt(n) further below.
FIT_QUANTILE = 0.001
FIT_MARGIN = 1.0
FIT_SHORT = 8.0

# Characters that are hashed at once.
SLICE = 400_000

MULTIPLIERS = (np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35), np.uint32(0x27D4EB2F))

# Between two texts in one array of characters.
BORDER = 0


def letter_table() -> np.ndarray:
    """Which code points below 65536 are letters; higher ones are told apart one by one."""
    return np.frombuffer(bytes(chr(i).isalpha() for i in range(1 << 16)), bool)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def features(texts: list[str], letters: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Buckets of the n-grams of several texts, for each order, and the text of each n-gram's end.

    Letters are lower-cased; what stands between them counts as one space.
    Buckets of one order follow those of the order before. N-grams that would
    reach over the border of two texts are left out.
    """
    joined = "\0".join(t.replace("\0", " ") for t in texts).lower()
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    known = letters[np.minimum(codes, 0xFFFF)]
    high = codes > 0xFFFF
    if high.any():
        known[high] = [chr(c).isalpha() for c in codes[high]]
    codes = np.where(known | (codes == BORDER), codes, np.uint32(32))
    spaced = codes == 32
    keep = ~(spaced[1:] & spaced[:-1])
    codes = codes[np.concatenate(([True], keep))] if codes.size else codes
    text_of = np.cumsum(codes == BORDER)
    inside = codes != BORDER
    buckets, owners = [], []
    mixed = np.zeros(codes.size, np.uint32)
    for k, order in enumerate(ORDERS):
        # the hash of the last ``order`` characters, from the hash of the last ``order - 1``
        shifted = mixed[:-1] if k else mixed
        mixed = (shifted + codes[k:] + np.uint32(order)) * MULTIPLIERS[k]
        mixed ^= mixed >> np.uint32(15)
        whole = inside[k:] if not k else inside[k:] & whole[:-1]
        buckets.append((mixed[whole] >> np.uint32(32 - BITS)).astype(np.int64) + (k << BITS))
        owners.append(text_of[k:][whole])
    return buckets, owners


def slices(text: str) -> list[str]:
    """Pieces of a long text; a cut counts as the border of a text."""
    return [text[k : k + SLICE] for k in range(0, len(text), SLICE)] or [""]


@dataclass
class LanguageModel:
    """Log-probabilities (language, bucket) and log-priors, languages in order of name.

    ``least_fit`` is the mean log-probability per n-gram that nearly all training documents of a language reach.
    """

    languages: list[str]
    weights: np.ndarray
    priors: np.ndarray
    least_fit: np.ndarray | None = None

    def log_scores(self, texts: list[str], letters: np.ndarray) -> np.ndarray:
        """Joint log-probability of each text and language."""
        return self.scores_and_sizes(texts, letters)[0]

    def scores_and_sizes(self, texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Joint log-probability of each text and language, and the number of n-grams of each text."""
        sizes = np.zeros(len(texts), np.int64)
        total = np.tile(self.priors, (len(texts), 1))
        buckets, owners = features(texts, letters)
        for bucket, owner in zip(buckets, owners):
            if bucket.size:
                sizes += np.bincount(owner, minlength=len(texts))
                first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
                for k in range(len(self.languages)):
                    total[owner[first], k] += np.add.reduceat(self.weights[k][bucket], first)
        return total, sizes

    def fits(self, best: int, score: float, size: int) -> bool:
        """Whether a text of ``size`` n-grams and that log-probability under its best language is in that language."""
        if self.least_fit is None or not size:
            return True
        return score / size >= self.least_fit[best] - FIT_MARGIN - FIT_SHORT / np.sqrt(size)


def train_language_model(
    docs: DataFrame, usable: Column | None = None, documents: int = TRAINING_DOCUMENTS, smoothing: float = 0.5
) -> LanguageModel:
    """Count n-grams of labelled documents by language and normalise them.

    Reads rows with a language and a text for which ``usable`` holds (default: rows
    outside the held-out fold); of a language with many rows about ``documents``,
    chosen by a hash of the id. A table without such rows gives a model without languages.
    """
    usable = trainable(F.col("doc_id")) if usable is None else usable
    labelled = docs.select("doc_id", "text", "lang").where(usable & F.col("lang").isNotNull())
    rows = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    share = docs.sparkSession.createDataFrame(
        [(lang, documents / n) for lang, n in rows.items()], "lang string, share double"
    )
    sample = labelled.join(broadcast_if_small(share), "lang").where(draw(F.lit(7), F.col("doc_id")) < F.col("share"))

    def count(batches):
        letters, sums = letter_table(), {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                own = sums.setdefault(lang, np.zeros(len(ORDERS) << BITS, np.int64))
                for piece in slices(text or ""):
                    for bucket in features([piece], letters)[0]:
                        np.add.at(own, bucket, 1)
        for lang, own in sums.items():
            seen = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * seen.size, pa.string()), pa.array(seen), pa.array(own[seen])],
                ["lang", "bucket", "n"],
            )

    counted = sample.select("text", "lang").mapInArrow(count, "lang string, bucket long, n long")
    counts = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows)
    width = 1 << BITS
    table = np.zeros((len(languages), len(ORDERS) << BITS))
    place = {lang: k for k, lang in enumerate(languages)}
    table[counts["lang"].map(place).to_numpy(int), counts["bucket"].to_numpy(int)] = counts["n"]
    plain = table.copy()
    for k in range(len(ORDERS)):
        part = table[:, k * width : (k + 1) * width]
        part += smoothing
        np.log(part / part.sum(axis=1, keepdims=True), out=part)
    total = sum(rows.values())
    priors = np.array([np.log(rows[lang] / total) for lang in languages])
    return LanguageModel(languages, table, priors, _least_fit(sample, place, plain, smoothing))


def _least_fit(sample: DataFrame, place: dict[str, int], table: np.ndarray, smoothing: float) -> np.ndarray:
    """The least mean log-probability per n-gram of the training documents of each language, but for the last few.

    Each document is judged by the counts of the others, so a language known from few documents gets a low one.
    """
    sums = table.reshape(len(place), len(ORDERS), 1 << BITS).sum(2)
    shared = sample.sparkSession.sparkContext.broadcast((place, table, sums))

    def judge(batches):
        letters, (places, counts, sums) = letter_table(), shared.value
        for batch in batches:
            langs, fits = [], []
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                buckets = [features([piece], letters)[0] for piece in slices(text or "")]
                score, size, k = 0.0, 0, places[lang]
                for order in range(len(ORDERS)):
                    own, n = np.unique(np.concatenate([b[order] for b in buckets]), return_counts=True)
                    rest = sums[k, order] - n.sum() + smoothing * (1 << BITS)
                    score += float((n * np.log((counts[k][own] - n + smoothing) / rest)).sum())
                    size += int(n.sum())
                if size and has_letter(text):
                    langs.append(lang)
                    fits.append(score / size)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(fits, pa.float64())], ["lang", "fit"])

    least = np.full(len(place), -np.inf)
    if place:
        for lang, own in sample.select("text", "lang").mapInArrow(judge, "lang string, fit double").toPandas().groupby("lang"):
            least[place[lang]] = np.quantile(own["fit"], FIT_QUANTILE, method="lower")
    return least


def predict_language(
    docs: DataFrame, model: LanguageModel, names: tuple[str, str] = ("lang_pred", "score"), keep_text: bool = False,
    fits: str | None = None,
) -> DataFrame:
    """The likeliest language of every whole text.

    Adds ``lang_pred`` and ``score`` (posterior probability, 0 to 1), or as ``names``
    calls them; further columns stay, the text only if asked for. A text that is null or has no letter, and any
    text under a model without languages, gets ``und`` and score 0. Ties go to
    the first language by name. Columns named like the results are replaced. ``fits`` names
    a further column that tells whether the text is as likely as texts of that language are.
    """
    docs = docs.drop(*names, *([fits] if fits else []))
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights, model.priors, model.least_fit))
    rest = [f for f in docs.schema if keep_text or f.name != "text"]

    def run(batches):
        known, letters = LanguageModel(*shared.value), letter_table()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            lang, score, fit = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
            sizes = np.zeros(len(texts), np.int64)
            found = np.tile(known.priors, (len(texts), 1))
            group, size = [], 0
            rows = [k for k, t in enumerate(texts) if known.languages and has_letter(t)]
            for k in rows:
                for piece in slices(texts[k]):
                    if size + len(piece) > SLICE and group:
                        _add(known, letters, group, found, sizes)
                        group, size = [], 0
                    group.append((k, piece))
                    size += len(piece)
            if group:
                _add(known, letters, group, found, sizes)
            for k in rows:
                best = int(found[k].argmax())
                lang[k] = known.languages[best]
                score[k] = float(1.0 / np.exp(found[k] - found[k][best]).sum())
                fit[k] = bool(known.fits(best, found[k][best] - known.priors[best], sizes[k]))
            more = [pa.array(fit, pa.bool_())] if fits else []
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in rest), pa.array(lang, pa.string()), pa.array(score, pa.float64()), *more],
                [*(f.name for f in rest), *names, *([fits] if fits else [])],
            )

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), f"`{names[0]}` string, `{names[1]}` double"])
    schema += f", `{fits}` boolean" if fits else ""
    return docs.mapInArrow(run, schema)


def _add(
    model: LanguageModel, letters: np.ndarray, group: list[tuple[int, str]], found: np.ndarray, sizes: np.ndarray
) -> None:
    scores, more = model.scores_and_sizes([piece for _, piece in group], letters)
    np.add.at(found, [k for k, _ in group], scores - model.priors)
    np.add.at(sizes, [k for k, _ in group], more)


def drop_unidentified(docs: DataFrame, model: LanguageModel, least_score: float = 0.5) -> DataFrame:
    """The documents in a language that is likelier than ``least_score`` and that they fit; all columns stay.

    The posterior says only which known language is nearest. A text in none of them, or of stray
    letters, is told by its mean log-probability per n-gram, see ``LanguageModel.fits``.
    Works in one pass: the verdict comes with the row, so ids may be null or repeated. Null, empty
    and letterless texts go. Columns may have any names.
    """
    # The columns go by their places meanwhile.
    plain = [c if c == "text" else f"c{k}" for k, c in enumerate(docs.columns)]
    found = predict_language(docs.toDF(*plain), model, keep_text=True, fits="fits")
    known = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score) & F.col("fits")
    return found.where(known).select(*plain).toDF(*docs.columns)


__all__ = ["LanguageModel", "drop_unidentified", "predict_language", "train_language_model"]
