"""Operator 3: toxicity (method: convolutional text classifier over hashed word embeddings, trained in numpy).

A word's embedding is the sum of the table rows of the word and of its prefixes. Filters of several widths run over
the embeddings, each filter's largest value in the text is kept, and a linear layer scores them. The score is scaled
so that 0.7 is the threshold of the text's language, which is guessed from the text itself. Only the filters learn from a
bounded sample; the thresholds come from counts over all labelled rows that are not held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdwise.llm.common import blocks, bounded_batches, held_out, may_contain, membership_bits, text_buffer
from holdwise.llm.features import WordHash, segments

BITS, DIM, FILTERS, WIDTHS = 16, 12, 8, (1, 2, 3)
#: The training sample of the filters: at most so many rows of each label, and only texts of at most so many bytes.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_BYTES = 2000, 4000, 24_000
EPOCHS, BATCH, RATE = 6, 64, 0.08
#: Languages that may have a threshold of their own: the most frequent of the sample.
LANGUAGES = 32
#: Rejected from this score on.
THRESHOLD = 0.7
#: Logits are counted in so many bins per unit, up to this size.
LOGIT_BINS, LOGIT_LIMIT = 64, 60
BLOCK_BYTES, CHUNK_WORDS = 1_000_000, 50_000
#: Bytes of the sample that the driver hashes at once.
FIT_BYTES = 100_000


@dataclass
class ToxicModel:
    """Filters already applied to the embedding table: row r of ``table`` holds r's share in every filter position."""

    table: np.ndarray  # 2**BITS x (sum(WIDTHS) * FILTERS)
    bias: np.ndarray
    weight: np.ndarray
    offset: float
    language: np.ndarray  # 2**BITS x languages: log-probability of a word's row
    cut: np.ndarray  # per language: the logit that is the threshold
    slope: float

    def logits(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Raw logit and guessed language of each text, given the table rows of its words."""
        n_docs, n = len(counts), len(ids)
        end = np.repeat(np.cumsum(counts), counts)
        doc = np.repeat(np.arange(n_docs), counts)
        pooled = np.zeros((n_docs, len(WIDTHS) * FILTERS), np.float32)
        spoken = np.zeros((n_docs, self.language.shape[1]), np.float32)
        for s in range(0, n, CHUNK_WORDS):  # a chunk sees the words after it that its filters reach
            e = min(n, s + CHUNK_WORDS)
            far = min(n, e + max(WIDTHS) - 1)
            part = self.table[ids[s:far, 0]]
            for k in range(1, ids.shape[1]):
                part += self.table[ids[s:far, k]]
            part = np.append(part, np.zeros((max(WIDTHS) - 1, part.shape[1]), np.float32), axis=0)
            column, out = 0, []
            for width in WIDTHS:
                total = np.zeros((e - s, FILTERS), np.float32)
                for j in range(width):
                    inside = (np.arange(s, e) + j < end[s:e])[:, None]
                    total += part[j : j + e - s, column : column + FILTERS] * inside
                    column += FILTERS
                out.append(total)
            here, at = np.unique(doc[s:e], return_index=True)
            best = np.maximum.reduceat(np.concatenate(out, axis=1) + self.bias, at, axis=0)
            pooled[here] = np.maximum(pooled[here], best)
            spoken[here] += np.add.reduceat(self.language[ids[s:e, 0]], at, axis=0)
        return pooled @ self.weight + self.offset, spoken.argmax(axis=1)

    def scores(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        logit, language = self.logits(ids, counts)
        z = self.slope * (logit.astype(np.float64) - self.cut[language]) + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Trainer:
    """Gradient descent (Adagrad) on the log-loss; only the positions that win a filter's maximum get gradients."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.rng = rng
        self.p = {"E": rng.normal(0, 0.01, (1 << BITS, DIM)), "b": np.zeros(len(WIDTHS) * FILTERS), "u": np.abs(rng.normal(0, 0.3, len(WIDTHS) * FILTERS)), "c": np.full(1, -1.0)}
        self.p |= {f"W{w}": rng.normal(0, 0.4, (w, DIM, FILTERS)) for w in WIDTHS}
        for w in WIDTHS:
            self.p[f"W{w}"][:, 0] = np.abs(self.p[f"W{w}"][:, 0])
        self.seen = {k: np.full_like(v, 1e-2) for k, v in self.p.items()}

    def start(self, ids: np.ndarray, counts: np.ndarray, y: np.ndarray) -> None:
        """Begin the first dimension with how surely a table row tells the labels apart, so that filters find such words."""
        offsets = np.append(0, np.cumsum(counts))
        n, share = len(y), y.mean()
        for k in range(ids.shape[1]):
            all_docs, bad_docs = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS)
            for i, j in blocks(offsets, CHUNK_WORDS):  # a document's words lie in one block
                doc = np.repeat(np.arange(i, j), counts[i:j])
                pair = np.unique(doc * np.int64(1 << BITS) + ids[offsets[i] : offsets[j], k])
                row, label = pair & ((1 << BITS) - 1), y[pair >> BITS]
                all_docs += np.bincount(row, minlength=1 << BITS)
                bad_docs += np.bincount(row, label, minlength=1 << BITS)
            rate = (bad_docs + share) / (all_docs + 1)
            gain = bad_docs * np.log(rate / share) + (all_docs - bad_docs) * np.log((1 - rate) / (1 - share))
            strength = np.sqrt(2 * np.maximum(gain, 0)) * np.sign(rate - share)
            strength = np.sign(strength) * np.maximum(np.abs(strength) - np.sqrt(2 * np.log(n)), 0)  # what chance gives is nothing
            self.p["E"][:, 0] += np.clip(strength / 4, -2, 2)

    def step(self, ids: np.ndarray, counts: np.ndarray, y: np.ndarray, rate: float) -> None:
        p = self.p
        starts = np.cumsum(counts) - counts
        stops = starts + counts
        n, docs = len(ids), len(counts)
        x = np.append(p["E"][ids].sum(axis=1), np.zeros((max(WIDTHS), DIM)), axis=0)
        stop_of = np.repeat(stops, counts)
        pooled, where = [], []
        for w in WIDTHS:
            conv = np.zeros((n, FILTERS))
            for j in range(w):
                conv += (x[j : j + n] @ p[f"W{w}"][j]) * (np.arange(n) + j < stop_of)[:, None]
            best = np.maximum.reduceat(conv, starts, axis=0)
            place = np.zeros((docs, FILTERS), np.int64)
            row, column = np.nonzero(conv == np.repeat(best, counts, axis=0))
            place[np.repeat(np.arange(docs), counts)[row], column] = row
            pooled.append(best)
            where.append(place)
        raw = np.concatenate(pooled, axis=1) + p["b"]
        act = np.maximum(raw, 0)
        prob = 1 / (1 + np.exp(-np.clip(act @ p["u"] + p["c"], -30, 30)))
        err = (prob - y) / docs
        grad = {"u": act.T @ err, "c": np.array([err.sum()])}
        back = np.outer(err, p["u"]) * (raw > 0)
        grad["b"] = back.sum(axis=0)
        rows, values = [], []
        for k, w in enumerate(WIDTHS):
            g, at = back[:, k * FILTERS : (k + 1) * FILTERS], where[k]
            dw = np.zeros_like(p[f"W{w}"])
            for j in range(w):
                ok = (at + j < stops[:, None]) & (g != 0)
                gj = g * ok
                dw[j] = np.einsum("bfd,bf->df", x[at + j], gj)
                d, f = np.nonzero(ok)
                rows.append(at[d, f] + j)
                values.append(gj[d, f][:, None] * p[f"W{w}"][j].T[f])
            grad[f"W{w}"] = dw
        for k, g in grad.items():
            self.seen[k] += g * g
            p[k] -= rate * g / np.sqrt(self.seen[k])
        rows = np.concatenate(rows)
        if len(rows):
            touched, inverse = np.unique(ids[rows], return_inverse=True)
            total = np.zeros((len(touched), DIM))
            np.add.at(total, inverse.reshape(-1), np.repeat(np.concatenate(values), ids.shape[1], axis=0))
            self.seen["E"][touched] += total * total
            p["E"][touched] -= rate * total / np.sqrt(self.seen["E"][touched])

    def fit(self, ids: np.ndarray, counts: np.ndarray, y: np.ndarray) -> None:
        starts = np.cumsum(counts) - counts
        usable = np.flatnonzero(counts)
        self.start(ids, counts, y)
        unseen = np.ones(1 << BITS, bool)
        unseen[ids] = False
        self.p["E"][unseen] = 0  # words that were never seen say nothing
        for epoch in range(EPOCHS):
            order = self.rng.permutation(usable)
            for k in range(0, len(order), BATCH):
                pick = order[k : k + BATCH]
                rows = np.concatenate([np.arange(starts[d], starts[d] + counts[d]) for d in pick])
                self.step(ids[rows], counts[pick], y[pick], RATE * (1 - epoch / (EPOCHS + 1)))

    def model(self) -> ToxicModel:
        p = self.p
        table = np.concatenate([(p["E"] @ p[f"W{w}"][j]).astype(np.float32) for w in WIDTHS for j in range(w)], axis=1)
        return ToxicModel(table, p["b"].astype(np.float32), p["u"].astype(np.float32), float(p["c"][0]), np.zeros((1 << BITS, 1), np.float32), np.zeros(1), 1.0)


def language_table(ids: np.ndarray, counts: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """Log-probability of each table row in each language of the sample."""
    own = np.repeat(lang, counts)
    known = own >= 0
    size = max(1, int(lang.max(initial=-1)) + 1)
    table = np.zeros((1 << BITS, size))
    np.add.at(table, (ids[known, 0], own[known]), 1)
    return np.log((table + 0.1) / (table.sum(axis=0) + 0.1 * len(table))).astype(np.float32)


def best_cut(value: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> float:
    """The logit that separates the counted labels with the best F1; near the middle of the gap if several do."""
    used = np.flatnonzero(clean + toxic)[::-1]
    value, clean, toxic = value[used], clean[used], toxic[used]
    hits = np.cumsum(toxic)
    f1 = 2 * hits / (np.cumsum(clean + toxic) + toxic.sum())
    k = int(np.argmax(f1))
    return float(0.45 * value[k] + 0.55 * value[min(k + 1, len(value) - 1)])


def train(sample: pd.DataFrame) -> ToxicModel | None:
    """Fit the filters on rows of (text, lang, toxic); None unless both labels occur. The cuts are set by ``set_cuts``."""
    y = sample["toxic"].to_numpy().astype(np.float64)
    if len(set(y)) < 2:
        return None
    data, offsets = text_buffer(pa.array(sample["text"], pa.large_string()))
    ids, counts = WordHash(BITS).all_ids(data, offsets, FIT_BYTES)
    del data
    often = sample["lang"].value_counts().sort_index().sort_values(ascending=False, kind="stable").index[:LANGUAGES]
    lang, _ = pd.factorize(sample["lang"].where(sample["lang"].isin(often)))
    trainer = Trainer()
    trainer.fit(ids, counts, y)
    model = trainer.model()
    model.language = language_table(ids, counts, lang)
    model.cut = np.zeros(model.language.shape[1])
    return model


def set_cuts(model: ToxicModel, counts: pd.DataFrame) -> None:
    """Choose the cuts from counts per (language, bin, toxic, fitted); ``n`` is the number of rows.

    Rows that were not fitted tell the logits; the fitted ones, of which each class has another share, only count in the
    weights of the classes, so that these keep the ratio of all rows. Fitted rows tell the logits if no others do.
    """
    first = -LOGIT_LIMIT * LOGIT_BINS
    table = np.zeros((2, 2, model.language.shape[1], 2 * LOGIT_LIMIT * LOGIT_BINS + 1))  # fitted, toxic, language, bin
    np.add.at(table, tuple(counts[c].to_numpy(np.int64) - (first if c == "bin" else 0) for c in ("fitted", "toxic", "language", "bin")), counts["n"].to_numpy(np.float64))
    value = (np.arange(table.shape[-1]) + first + 0.5) / LOGIT_BINS
    free = table[0] if table[0].sum(axis=(1, 2)).all() else table.sum(axis=0)
    weight = table.sum(axis=(0, 2, 3)) / np.maximum(free.sum(axis=(1, 2)), 1)
    clean, toxic = free[0] * weight[0], free[1] * weight[1]
    whole = best_cut(value, clean.sum(axis=0), toxic.sum(axis=0))
    model.cut = np.full(len(model.cut), whole)
    for k in range(len(model.cut)):
        few = min(free[0, k].sum(), free[1, k].sum())
        if few:  # the fewer rows tell, the closer to the cut of all languages
            model.cut[k] = (few * best_cut(value, clean[k], toxic[k]) + 10 * whole) / (few + 10)
    spread = abs((toxic.sum(axis=0) @ value) / toxic.sum() - (clean.sum(axis=0) @ value) / clean.sum())
    model.slope = float(np.clip(8 / max(spread, 1e-3), 0.2, 5))


def known_labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(id, toxic) of the labels that are not held out: a label per id, however often it is given."""
    known = labels.where(F.col(label_col).isin(0, 1)).where(~held_out(F.col(id_col), 3, 1)).select(F.col(id_col).alias("id"), F.col(label_col).alias("toxic"))
    return known.where("id is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))


def labelled_logits(df: DataFrame, known: DataFrame, model: ToxicModel, fitted: set, id_col: str, text_col: str) -> pd.DataFrame:
    """Counts of all labelled rows per (language, bin, toxic, fitted). Texts are scored where they lie; only bins are joined."""
    known = known.withColumn("id", F.col("id").cast(df.schema[id_col].dataType))  # equal ids have equal hashes
    bits = np.frombuffer(membership_bits(known, F.xxhash64("id")), np.uint8)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null").where(~held_out(F.col("id"), 3, 1)).withColumn("hash", F.xxhash64("id"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), *[T.StructField(c, T.IntegerType()) for c in ("language", "bin")]])

    def task(batches):
        hashing = WordHash(BITS)
        for batch in batches:
            batch = batch.filter(pa.array(may_contain(bits, batch.column(2).to_numpy(zero_copy_only=False))))
            data, offsets = text_buffer(batch.column(1))
            language, place = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int32)
            for i, j in blocks(offsets, BLOCK_BYTES):
                logit, language[i:j] = model.logits(*hashing.ids(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
                place[i:j] = np.floor(np.clip(logit, -LOGIT_LIMIT, LOGIT_LIMIT) * LOGIT_BINS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(language), pa.array(place)], ["id", "language", "bin"])

    binned = bounded_batches(rows).select("id", "text", "hash").mapInArrow(task, schema)
    used = df.sparkSession.createDataFrame([(i,) for i in fitted], T.StructType([T.StructField("id", rows.schema["id"].dataType)]))
    used = used.select("id", F.lit(1).alias("fitted"))
    # at most languages x bins x 4 rows reach the driver, whatever the size of the table
    joined = binned.join(known, "id").join(F.broadcast(used), "id", "left").withColumn("fitted", F.coalesce("fitted", F.lit(0)))
    return joined.groupBy("language", "bin", F.col("toxic").cast("int").alias("toxic"), "fitted").agg(F.count(F.lit(1)).alias("n")).toPandas()


def learned(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, label_col: str) -> ToxicModel | None:
    sample = labelled_sample(df, labels, id_col, text_col, lang_col, label_col)
    check = np.arange(len(sample)) % 5 == 0  # rows come in the order of a hash: these are not fitted, however few rows there are
    fit = sample if len(set(sample["toxic"][check])) < 2 or len(set(sample["toxic"][~check])) < 2 else sample[~check]
    model = train(fit)
    if model is not None:
        set_cuts(model, labelled_logits(df, known_labels(labels, id_col, label_col), model, set(fit["id"]), id_col, text_col))
    return model


def labelled_sample(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, label_col: str) -> pd.DataFrame:
    """At most ``SAMPLE_TOXIC`` + ``SAMPLE_CLEAN`` rows (text, lang, label), chosen by a hash of the id."""
    known = known_labels(labels, id_col, label_col)
    picked = None
    for value, limit in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN)):
        one = known.where(F.col("toxic") == value).orderBy(F.xxhash64("id"), "id").limit(limit)
        picked = one if picked is None else picked.union(one)
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    texts = texts.where(F.octet_length("text") <= SAMPLE_BYTES)
    rows = texts.join(F.broadcast(picked), "id").dropDuplicates(["id"])  # the broadcast side is bounded by the limits
    return rows.select("id", "text", "lang", "toxic").toPandas().sort_values("id", key=lambda s: pd.util.hash_array(s.to_numpy()), kind="stable")


def toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic") -> DataFrame:
    """Score every whole text for toxicity; returns ``id_col``, ``held_out``, ``score`` (0 to 1) and ``predicted``.

    The filters learn from a bounded sample of labelled rows that are not held out (crc32 of the id modulo 3 is not
    1), the thresholds from all of these rows; ``predicted`` is 1 from a score of 0.7 on. Null and empty texts get the score of a text without words;
    null ids are scored and not held out; rows that repeat are scored each. Without labels of both kinds every score
    is 0. An empty table gives no rows. Other columns are not read and may have any name.
    """
    model = learned(df, labels, id_col, text_col, lang_col, label_col)
    scored = _scored(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), model).drop("text")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id"), 3, 1).alias("held_out"), "score", rejected().cast("int").alias("predicted"))


def rejected():
    return F.col("score") >= THRESHOLD


def _scored(rows: DataFrame, model: ToxicModel | None) -> DataFrame:
    """(id, text, score) of every row (id, text)."""
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("text", T.StringType()), T.StructField("score", T.DoubleType())])

    def task(batches):
        hashing = WordHash(BITS)
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            score = np.zeros(batch.num_rows)
            for i, j in blocks(offsets, BLOCK_BYTES):
                if model:
                    score[i:j] = model.scores(*hashing.ids(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], ["id", "text", "score"])

    return bounded_batches(rows).select("id", "text").mapInArrow(task, schema)


def drop_toxic(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic") -> DataFrame:
    """The rows of ``df``, all columns, that ``toxicity`` does not reject.

    Null and empty texts are scored as texts without words; rows that repeat, or have a null id, are judged each by
    their text. Without labels of both kinds, and of an empty table, no row is rejected. Columns may have any name.
    """
    model = learned(df, labels, id_col, text_col, lang_col, label_col)
    others = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text_col])
    clean = _scored(df.select(others.alias("id"), F.col(text_col).alias("text")), model).where(~rejected())
    return clean.select(*[F.col("text").alias(c) if c == text_col else F.col(f"id.`{c}`").alias(c) for c in df.columns])
