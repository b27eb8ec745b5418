"""Operator 7: personal data (method: candidate gradient boosting).

Base spans are what the kinds' exact patterns and checks find; they always count. Generators with high recall propose
further spans, which may overlap; boosted trees judge each by its format and context, and calibrated thresholds per
kind select those that are redacted besides the base spans.

The trees need no labelled table. Every base span counts as personal data, shown without the mark of its format (no
'+', spelled signs, other separators). Harmless are proposed spans that fail their kind's check or stand in a clearly
other context (version, date, part of a longer run), and look-alikes: numbers that pass a check by chance and words
around "at" and "dot", set into the documents' own prose at hashed places. The trees alone judge what is proposed, also
what resembles the harmless ones. They are fitted on a bounded sample; the thresholds come from counts over all documents.
"""

from __future__ import annotations

import random
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdwise.llm.boosting import Trees, fit_logistic, fit_trees
from holdwise.llm.common import bounded_batches, text_buffer

# The kinds in order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
EMAIL_REST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}|[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")

#: The training sample: documents, and bytes of the largest text that is used for training.
SAMPLE_DOCS, SAMPLE_BYTES = 4000, 24_000
#: Precision that a threshold must reach on the labelled spans of all documents, and the bins of their probabilities.
PRECISION, BINS = 0.98, 1000
#: Look-alikes tried for each base span.
LOOK_ALIKES = 4
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Generators: number-like clusters, addresses that spell out or bracket their signs.
CLUSTER = re.compile(r"[+(]?[0-9][0-9\x20()./-]{5,}[0-9]")
SPELLED_MARK = re.compile(rb"(?i)at[)\]}]|[\x20]dot[\x20]|[(\[{]dot|[(\[]\.[)\]]|[0-9] \. ?[0-9]")
SPELLED = re.compile(r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{2,64} ?[(\[{]at[)\]}] ?[a-z0-9-]+(?: ?(?:[(\[{]dot[)\]}]|\.) ?[a-z0-9-]+)+|(?<![a-z0-9._%+-])[a-z0-9._%+-]{2,64} at [a-z0-9-]+(?: dot [a-z0-9-]+)+")
SPELLED_IP = re.compile(r"(?i)(?<![0-9])[0-9]{1,3}(?:(?: ?(?:[(\[{](?:dot|\.)[)\]}]|\.) ?| dot )[0-9]{1,3}){3}(?![0-9])")
SPELLED_AT = re.compile(r"(?i) ?[(\[{]at[)\]}] ?| at ")
SPELLED_DOT = re.compile(r"(?i) ?[(\[{](?:dot|\.)[)\]}] ?| (?:dot|\.) ")
EMAIL_WHOLE = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+\Z")
#: Contexts and formats of numbers that are nobody's: a word before, dates, ISBNs, plain numbers.
OTHER_WORD = re.compile(r"(?i)(?<![a-z])(?:versions?|ver|v|releases?|build|revision|rev|licen[cs]e|isbn(?:-1[03])?|issn|doi|serial|invoice|order|sku|token|commit)(?:\x20(?:number|nr|no|id))?[\x20.:=#]*\Z")
DATE = re.compile(r"(?<![0-9])(?:(?:19|20)[0-9]{2}[-./\x20][0-9]{1,2}[-./\x20][0-9]{1,2}|[0-9]{1,2}[-./\x20][0-9]{1,2}[-./\x20](?:19|20)[0-9]{2})(?![0-9])")
PLAIN_NUMBER = re.compile(r"[0-9]+(?:\.[0-9]+)?\Z|[0-9]{1,3}(?:[\x20.][0-9]{3}){2,}\Z|[0-9]+(?:\.[0-9]+){3}\Z")
CALL_WORD = re.compile(r"(?i)(?<![a-z])(?:tel|telephone|telefon|phone|call|fax|mobile?|sms|cell)(?:\x20(?:number|nr|no))?[\x20.:=#]*\Z")
CONTEXT = re.compile(r"(?i)(tel|phone|call|fax|mobil|sms)|(mail|contact|write)|(card|visa|credit|iban|account|pay)|(ip|host|server|address|addr)|(version|license|isbn|issn|doi|nr|id)")
HEXLIKE = frozenset("0123456789abcdefABCDEF")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def small(part: str) -> bool:
    """A number of at most 255, however many zeros lead it."""
    part = part.lstrip("0")
    return len(part) <= 3 and (not part or int(part) <= 255)


def emails(text: str):
    """Leftmost non-overlapping matches of ``local@host.host``: a match starts where the characters before @ do."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        found = EMAIL_REST.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Exact spans of all kinds, by start and kind. A match that fails its kind's check is dropped without a retry."""
    out = [(0, s, e) for s, e in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if "." in m.group() and all(map(small, m.group().split("."))):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                out.append((3, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], s[0], s[2]))


def candidates(text: str) -> list[Span]:
    """Proposed spans of all kinds; they may overlap each other and base spans."""
    out = set()
    for m in CLUSTER.finditer(text):
        s, e = m.span()
        pieces = [(s, e)]
        groups = [(s + d.start(), s + d.end()) for d in DIGITS.finditer(m.group())]
        if len(groups) > 1:  # without the first group, without the last one
            first = groups[1][0]
            pieces += [(first - (text[first - 1] == "("), e), (s, groups[-2][1])]
        for a, b in pieces:
            part = text[a:b]
            n = sum(map(str.isdigit, part))
            if part.count(".") == 3 and part.replace(".", "").isdigit():
                out.add((1, a, b))
            if 12 <= n <= 19:
                out.add((2, a, b))
            if 7 <= n <= 15:
                out.add((3, a, b))
    if "@" in text:
        for s, e in emails(text):
            out.add((0, s, e))
    low = text.lower()
    if "at)" in low or "at]" in low or "at}" in low or (" at " in low and " dot " in low):
        out.update((0, m.start(), m.end()) for m in SPELLED.finditer(text))
    if any(mark in low for mark in ("[.]", "(.)", " . ", "dot")):
        out.update((1, m.start(), m.end()) for m in SPELLED_IP.finditer(text))
    return sorted(out)


def passes(span: Span, text: str) -> bool:
    """The check of the span's kind, whatever marks and separators it is written with."""
    kind, s, e = span
    part = text[s:e]
    if kind == 0:
        return EMAIL_WHOLE.match(SPELLED_DOT.sub(".", SPELLED_AT.sub("@", part))) is not None
    if kind == 1:
        parts = SPELLED_DOT.sub(".", part).split(".")
        return len(parts) == 4 and all(x.isdigit() and small(x) for x in parts)
    digits = "".join(DIGITS.findall(part))
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 9 <= len(digits) <= 15


def elsewhere(span: Span, text: str) -> bool:
    """The span clearly is something else: part of a longer run, after a word like version, a date or a plain number."""
    kind, s, e = span
    part, before, after = text[s:e], text[max(0, s - 24) : s], text[e : e + 2]
    if kind == 0:
        return False
    if before[-1:].isalnum() or after[:1].isalnum() or OTHER_WORD.search(before):
        return True
    if (before[-1:] in (".", "-", "/", ",") and before[-2:-1].isdigit()) or (after[:1] in (".", "-", "/", ",") and after[1:].isdigit()):
        return True
    if kind != 3:
        return False
    digits = "".join(DIGITS.findall(part))
    if DATE.search(part) or (len(digits) == 13 and digits[:3] in ("978", "979")):
        return True
    return PLAIN_NUMBER.match(part) is not None and not CALL_WORD.search(before)


def harmless(span: Span, text: str) -> bool:
    return not passes(span, text) or elsewhere(span, text)


def hidden(text: str, span: Span) -> list[tuple[str, Span]]:
    """A base span in its context, written without the marks that made it a base span, in several ways."""
    kind, s, e = span
    part, before, after = text[s:e], text[max(0, s - 26) : s], text[e : e + 3]
    groups = DIGITS.findall(part)
    if kind == 0:
        local, host = part.split("@", 1)
        ways = [f"{local} (at) {host}", f"{local}[at]{host}", f"{local} at {host.replace('.', ' dot ')}"]
        ways += [f"{local}{a}{host.replace('.', d)}" for a, d in (("(at)", "(dot)"), (" (at) ", " (dot) "), (" [at] ", " [dot] "), ("[at]", "[dot]"))]
    elif kind == 1:
        ways = [part, *[d.join(groups) for d in ("[.]", "(.)", " . ", "[dot]", " dot ")]]
    elif kind == 2:
        digits = "".join(groups)
        fours = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        ways = [part, digits, *[d.join(fours) for d in (".", "/", "  ", " - ")]]
    else:
        ways = [part[1:], *[d.join(groups) for d in "- ."]]
        if len(groups) > 2 and sum(map(len, groups[1:])) >= 9:
            ways += [part[part.index(groups[0]) + len(groups[0]) :].lstrip(" .-)"), *[d.join(groups[1:]) for d in "- ."]]
        if CALL_WORD.search(before):
            ways.append("".join(groups))
    return [(before + w + after, (kind, len(before), len(before) + len(w))) for w in dict.fromkeys(ways)]


def look_alikes(text: str, base: list[Span]) -> list[tuple[str, Span]]:
    """For each base span, spans of its kind that pass its check but are nobody's, in prose of the text without digits.

    Places and digits come from a hash of the span and of its place.
    """
    out = []
    for kind, s, e in base:
        rnd = random.Random(zlib.crc32(f"{kind}:{s}:{text[s:e]}".encode()))
        for _ in range(LOOK_ALIKES):
            at = text.find(" ", rnd.randrange(len(text)))
            before, after = text[max(0, at - 26) : at + 1], text[at : at + 3]
            if at < 1 or len(after) < 3 or any(c.isdigit() or c in "@+" for c in before + after) or CONTEXT.search(before[-14:]):
                continue
            part = look_alike(kind, rnd, text)
            span = (kind, len(before), len(before) + len(part))
            if part and passes(span, before + part + after):
                out.append((before + part + after, span))
    return out


def look_alike(kind: int, rnd: random.Random, text: str) -> str:
    """Something that reads like a kind: counts and scores, numbered sections, codes, words around "at" and "dot"."""
    if kind == 0:
        words = [w for w in text[: 1 << 12].split() if w.isascii() and w.isalpha()]
        return "{} at {} dot {}".format(*(rnd.choice(words) for _ in range(3))) if words else ""
    if kind == 1:
        return rnd.choice([" . ", ". ", " ."]).join(str(rnd.randint(0, 20)) for _ in range(4))
    if kind == 2:
        sizes = rnd.choice([(3, 5, 4), (5, 5, 5), (2, 4, 4, 4), (4, 4, 4, 4), (6, 3, 6)])
        first = rnd.choice("0127893456")
        digits = first + "".join(rnd.choice("0123456789") for _ in range(sum(sizes) - 2))
        digits += next(d for d in "0123456789" if luhn(digits + d))
        cuts = [sum(sizes[:k]) for k in range(len(sizes) + 1)]
        return rnd.choice([".", "/", "  "]).join(digits[a:b] for a, b in zip(cuts, cuts[1:], strict=False))
    sizes = rnd.choice([(3, 3, 4), (3, 3, 4), (2,) * 5, (2,) * 6, (4, 3, 4), (3, 3, 3), (1, 2, 3, 4), (5, 5)])
    return rnd.choice([" ", " ", "  ", "/"]).join(str(rnd.randint(10 ** (n - 1), 10**n - 1)) for n in sizes)


def examples(text: str) -> list[tuple[list[float], int, float]]:
    """Features, label and weight of the labelled spans of a text; the ways to write one base span share its weight."""
    base, out = base_spans(text), []
    for b in base:
        ways = hidden(text, b)
        out += [(features(t, c), 1, 1 / len(ways)) for t, c in ways]
    out += [(features(t, c), 0, 1 / LOOK_ALIKES) for t, c in look_alikes(text, base)]
    return out + [(features(text, c), 0, 1.0) for c in open_candidates(text, base) if harmless(c, text)]


def open_candidates(text: str, base: list[Span]) -> list[Span]:
    """The proposed spans that touch no base span."""
    start, end = np.array([b[1] for b in base], np.int64), np.array([b[2] for b in base], np.int64)
    end = np.maximum.accumulate(end) if len(end) else end
    out = []
    for c in candidates(text):
        k = int(np.searchsorted(start, c[2])) - 1  # the last base span that starts before the end of c
        if k < 0 or end[k] <= c[1]:
            out.append(c)
    return out


#: Place of the kind among the features.
KIND = 10


def char_kind(c: str) -> int:
    return 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4


def features(text: str, span: Span) -> list[float]:
    """Format of the span, whether it passes its kind's check, and what stands around it."""
    kind, s, e = span
    part = text[s:e]
    groups = DIGITS.findall(part)
    sizes = [len(g) for g in groups] or [0]
    before, after = text[max(0, s - 24) : s], text[e : e + 2]
    word = CONTEXT.search(before.rstrip(" :=#")[-12:] + " ")
    hint = word.lastindex if word else 0
    near = text[max(0, s - 1) : s] + after[:1]
    digits = "".join(groups)
    return [
        bool(OTHER_WORD.search(before)), bool(CALL_WORD.search(before)), bool(DATE.search(part)), len(digits) == 13 and digits[:3] in ("978", "979"), bool(PLAIN_NUMBER.match(part)),
        before[-1:] in (".", "-", "/", ",") and before[-2:-1].isdigit(), after[:1] in (".", "-", "/", ",") and after[1:].isdigit(), part.count("["), part.count("  "), part.startswith("0"),
        kind, passes(span, text), e - s, sum(sizes), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1], part.count(" "), part.count("-"), part.count("."), part.count("("), part.count("/"),
        part[0] == "+", part[0] == "(", "@" in part, float(part[:1] in "3456"), float(groups[0][0]) if groups else -1, char_kind(text[s - 1 : s] if s else ""), char_kind(after[:1]),
        char_kind(after[1:2]), sum(c in HEXLIKE for c in near), hint, sum(map(str.isalpha, part)), len(set(part)),
    ]


@dataclass
class PiiModel:
    trees: Trees
    threshold: np.ndarray  # per kind; above 1: nothing is added


def train(rows: pd.DataFrame) -> PiiModel | None:
    """Fit on rows (features, label); None unless both labels occur."""
    if not len(rows) or rows["label"].nunique() < 2:
        return None
    x, y = np.array(rows["features"].tolist(), np.float64), rows["label"].to_numpy(np.float64)
    check = np.random.default_rng(1).random(len(y)) < 0.3
    if len(set(y[~check])) < 2 or len(set(y[check])) < 2:
        check[:] = True
        trees = fit_trees(x, y)
    else:
        trees = fit_trees(x[~check], y[~check])
    trees.platt = fit_logistic(trees.raw(x[check]), y[check])
    return PiiModel(trees, np.full(len(KINDS), 2.0))


def calibrated(model: PiiModel | None, texts: DataFrame) -> PiiModel | None:
    """Set each kind's threshold by the labelled spans of all documents (one ``text`` column), counted on executors."""
    if model is None:
        return None
    size = len(KINDS) * BINS

    def task(batches):
        total = np.zeros(2 * size)
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            for k in marked(data, offsets):
                found = examples(data[offsets[k] : offsets[k + 1]].tobytes().decode())
                if found:
                    x = np.array([f for f, _, _ in found], np.float64)
                    place = np.minimum((model.trees.probability(x) * BINS).astype(np.int64), BINS - 1) + BINS * x[:, KIND].astype(np.int64)
                    total += np.bincount(place + size * np.array([y for _, y, _ in found]), [w for _, _, w in found], 2 * size)
        here = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(total[here])], ["place", "weight"])

    counts = np.zeros(2 * size)
    rows = bounded_batches(texts).select("text").mapInArrow(task, "place long, weight double")
    for r in rows.groupBy("place").agg(F.sum("weight").alias("weight")).collect():  # at most 2 * kinds * BINS rows
        counts[r["place"]] = r["weight"]
    bad, good = counts.reshape(2, len(KINDS), BINS)
    for k in range(len(KINDS)):
        hits, errors = np.cumsum(good[k][::-1])[::-1], np.cumsum(bad[k][::-1])[::-1]  # from each bin on
        fine = np.flatnonzero((hits > 0) & (hits >= PRECISION * (hits + errors) - 1e-9))
        if len(fine):
            model.threshold[k] = max(0.5, fine[0] / BINS)
    return model


def chosen_spans(text: str, base: list[Span], model: PiiModel | None) -> list[Span]:
    """The base spans and the proposed ones that the model selects: best first, none that touches a chosen one."""
    if model is None:
        return base
    open_ = open_candidates(text, base)
    if not open_:
        return base
    p = model.trees.probability(np.array([features(text, c) for c in open_], np.float64))
    out, used = list(base), np.zeros(len(text), bool)
    for k in np.argsort(-p, kind="stable"):
        c = open_[k]
        if p[k] >= model.threshold[c[0]] and not used[c[1] : c[2]].any():
            used[c[1] : c[2]] = True
            out.append(c)
    return sorted(out, key=lambda s: (s[1], s[0], s[2]))


def sample_rows(df: DataFrame, id_col: str, text_col: str) -> pd.DataFrame:
    """Features and weak labels of the labelled spans of at most ``SAMPLE_DOCS`` documents, chosen by a hash of the id."""
    picked = df.select(F.col(id_col).alias("id")).where("id is not null").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS)
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.octet_length("text") <= SAMPLE_BYTES)
    texts = texts.join(F.broadcast(picked.distinct()), "id").dropDuplicates(["id"]).select("text")  # bounded by SAMPLE_DOCS

    def task(parts):
        for part in parts:
            rows = [(f, y) for text in part["text"] for f, y, _ in examples(text)]
            if rows:
                yield pd.DataFrame({"features": [[float(v) for v in f] for f, _ in rows], "label": pd.array([y for _, y in rows], "Int64")})

    return texts.mapInPandas(task, "features array<double>, label long").toPandas()


def learned(df: DataFrame, id_col: str, text_col: str) -> PiiModel | None:
    return calibrated(train(sample_rows(df, id_col, text_col)), df.select(F.col(text_col).alias("text")))


def marked(data: np.ndarray, offsets: np.ndarray) -> list[int]:
    """The texts that may hold a span: it has a digit, an @ or a spelled sign; most texts have none."""
    mark = (data == 0x40) | ((data >= 0x30) & (data <= 0x39))
    total = np.append(0, np.cumsum(mark))
    hit = total[offsets[1:]] > total[offsets[:-1]]
    spelled = np.array([m.start() for m in SPELLED_MARK.finditer(data.tobytes())], np.int64)
    hit[np.searchsorted(offsets, spelled, "right") - 1] = True
    return np.flatnonzero(hit).tolist()


def personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of personal data in every whole text: ``id_col``, ``base`` and ``spans`` (arrays of kind, start, end).

    Offsets are code points, the end excluded. ``base`` holds the exact spans by start and kind; ``spans`` these
    and the added ones, which touch no other. Null and empty texts have none. Null ids are kept, repeated rows are
    searched each, an empty table gives no rows. Other columns are not read and may have any name.
    """
    return _scan(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), learned(df, id_col, text_col)).withColumnRenamed("id", id_col)


SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _scan(rows: DataFrame, model: PiiModel | None, redact: bool = False) -> DataFrame:
    fields = [T.StructField("id", rows.schema["id"].dataType), T.StructField("base", SPAN), T.StructField("spans", SPAN)]
    fields = [T.StructField("id", rows.schema["id"].dataType), T.StructField("text", T.StringType())] if redact else fields
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def listed(spans):
        return [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in spans]

    def task(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            base, spans = [[]] * batch.num_rows, [[]] * batch.num_rows
            texts = batch.column(1).to_pylist() if redact else None
            for k in marked(data, offsets):
                text = data[offsets[k] : offsets[k + 1]].tobytes().decode()
                exact = base_spans(text)
                chosen = chosen_spans(text, exact, model)
                if redact:
                    texts[k] = redacted(text, chosen)
                else:
                    base[k], spans[k] = listed(exact), listed(chosen)
            columns = [pa.array(texts, pa.string())] if redact else [pa.array(base, arrow), pa.array(spans, arrow)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [f.name for f in fields])

    return bounded_batches(rows).select("id", "text").mapInArrow(task, T.StructType(fields))


def redacted(text: str, spans: list[Span]) -> str:
    """``text`` with each stretch of overlapping spans replaced by the name of its first kind."""
    out, at, k = [], 0, 0
    while k < len(spans):
        kind, start, end = spans[k]
        while k < len(spans) and spans[k][1] < end:
            end = max(end, spans[k][2])
            k += 1
        out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def redact_personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with the spans of ``personal_data`` replaced in ``text_col``; other columns and null texts stay as they are.

    Every row is redacted by its own text, also repeated ones and those with a null id. Columns may have any name.
    """
    model = learned(df, id_col, text_col)
    others = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text_col])
    out = _scan(df.select(others.alias("id"), F.col(text_col).alias("text")), model, redact=True)
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col(f"id.`{c}`").alias(c) for c in df.columns])


def joined(spans: str | Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
