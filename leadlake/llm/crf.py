"""Document quality by a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.session import bound_arrow_batches, materialise
from leadlake.llm.words import SEPARATOR, Words, codes_of, flat_bytes, per_text, portions, runs

#: The field is fitted on at most this many labelled documents of each class, and at most this many lines of them all.
TRAIN_DOCS, TRAIN_LINES = 3000, 200_000
STEPS, PENALTY = 120, 2.0

UPPER, DIGIT, SYMBOL, MARK, STOP, HIGH = (np.zeros(256, bool) for _ in range(6))
UPPER[0x41:0x5B] = DIGIT[0x30:0x3A] = True
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = MARK[[ord(c) for c in "!?:;=~_+^/\\@{}[]"]] = STOP[[ord(c) for c in ".!?"]] = True
HIGH[0xC0:] = True  # begins a character over U+007F

#: What is measured of a line; every measure but the first lies between 0 and about 1.
MEASURES = (
    "one", "log_chars", "log_words", "word_chars", "longest_word", "upper", "digits", "symbols", "marks", "high", "spaces", "one_char_words", "ends_stop", "starts_upper",
    "distinct_words", "as_word_before", "repeat_windows", "seen_line", "doc_words", "doc_distinct", "doc_repeats", "any_symbol", "any_mark", "mostly_upper",
)


def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def measures(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(measures of every line with a word, its characters, first line of each text and the end); a text without a word has one
    empty line."""
    w = Words(texts)
    raw, offsets = w.raw, w.offsets
    starts, ends = runs(raw != 0x0A, offsets)
    full = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
    starts, ends = starts[full], ends[full]
    owner = np.searchsorted(offsets, starts, "right") - 1
    empty = np.setdiff1d(np.arange(w.n), owner)
    starts, ends, owner = (np.concatenate(x) for x in ((starts, offsets[empty]), (ends, offsets[empty]), (owner, empty)))
    order = np.argsort(owner, kind="stable")
    starts, ends, owner = starts[order], ends[order], owner[order]
    n = len(starts)

    def of(flags: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(flags, dtype=np.int64))
        return total[ends] - total[starts]

    chars = of((raw & 0xC0) != 0x80)
    first, last = np.searchsorted(w.starts, starts), np.searchsorted(w.starts, ends)
    words = last - first
    line = np.repeat(np.arange(n), words)  # lines hold all words, in order
    codes, _ = w.codes()
    ids = codes.astype(np.int64)
    top = int(ids.max(initial=0)) + 1
    length = w.ends - w.starts

    def by_line(flags: np.ndarray) -> np.ndarray:
        return np.bincount(line, weights=flags, minlength=n)

    new = np.zeros(len(ids), bool)
    new[np.unique(line * top + ids, return_index=True)[1]] = True
    same = np.zeros(len(ids), bool)
    same[1:] = (ids[1:] == ids[:-1]) & (w.text[1:] == w.text[:-1])
    at = np.flatnonzero(w.text[:-2] == w.text[2:]) if len(ids) > 2 else np.zeros(0, np.int64)
    pair = np.unique(ids[at] * top + ids[at + 1], return_inverse=True)[1].astype(np.int64)
    triple = np.unique(pair * top + ids[at + 2], return_inverse=True)[1].astype(np.int64)
    _, inverse, times = np.unique(triple * max(w.n, 1) + w.text[at], return_inverse=True, return_counts=True)
    again = np.zeros(len(ids), bool)
    for k in range(3):
        again[at[times[inverse] > 1] + k] = True
    line_codes, _ = codes_of(raw, starts, ends)
    known = np.ones(n, bool)
    known[np.unique(owner * (int(line_codes.max(initial=0)) + 1) + line_codes, return_index=True)[1]] = False
    longest = np.zeros(n)
    np.maximum.at(longest, line, length)
    bounds = np.searchsorted(owner, np.arange(w.n + 1))
    doc_new = np.zeros(len(ids), bool)
    doc_new[np.unique(w.text * top + ids, return_index=True)[1]] = True
    doc = lambda flags: share(per_text(flags, w.first), w.counts)[owner]
    tail = np.where(words > 0, w.ends[np.maximum(last - 1, 0)] - 1, 0) if len(ids) else np.zeros(n, np.int64)
    head = np.where(words > 0, w.starts[np.minimum(first, max(len(ids) - 1, 0))], 0) if len(ids) else np.zeros(n, np.int64)
    some = words > 0
    at_byte = lambda table, where: table[raw[where]] & some if len(raw) else np.zeros(n, bool)
    upper, symbols, marks = of(UPPER[raw]), of(SYMBOL[raw]), of(MARK[raw])
    letters = chars - of(SEPARATOR[raw]) - symbols - marks - of(DIGIT[raw])
    columns = [
        np.ones(n), np.log1p(chars) / 8, np.log1p(words) / 6, share(by_line(length), words) / 12, np.log1p(longest) / 6, share(upper, letters), share(of(DIGIT[raw]), chars), share(symbols, words),
        share(marks, words), share(of(HIGH[raw]), chars), share(of(SEPARATOR[raw]), chars), share(by_line(length == 1), words), at_byte(STOP, tail), at_byte(UPPER, head), share(by_line(new), words),
        share(by_line(same), words), share(by_line(again), words), known & some, np.log1p(w.counts[owner]) / 10, doc(doc_new), doc(again), symbols * 20 > words, marks * 20 > words, upper * 2 > letters,
    ]
    return np.stack([np.minimum(c, 2).astype(np.float32) for c in columns], axis=1), chars, bounds


def in_context(own: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each line's measures, those of the lines before and after it in its text (zeros where there is none, the first measure
    tells), and how much each differs from the mean of the two."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[bounds[:-1]] = 0
    after[bounds[1:] - 1] = 0
    around = before[:, :1] + after[:, :1]
    mean = np.where(around > 0, (before + after) / np.maximum(around, 1), own)
    return np.concatenate([own, before, after, np.abs(own - mean)[:, 1:]], axis=1)


@dataclass
class Layout:
    """Lines of texts in the order of their places: ``rows[cuts[t]:cuts[t + 1]]`` are line t of the texts that have it, longest first."""

    rows: np.ndarray
    cuts: np.ndarray

    @classmethod
    def of(cls, bounds: np.ndarray) -> Layout:
        lengths = np.diff(bounds)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = bounds[:-1][order], lengths[order]
        have = len(lengths) - np.searchsorted(lengths[::-1], np.arange(int(lengths.max(initial=0))), "right")
        cuts = np.append(0, np.cumsum(have))
        place = np.repeat(np.arange(len(have)), have)
        return cls(starts[np.arange(cuts[-1]) - cuts[place]] + place, cuts)


def forward_backward(bias: np.ndarray, trans: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log P sums alpha and beta of each line and label, in layout order; log of each text's normaliser, longest text first).

    ``bias`` has each line's score of label 1 (label 0 scores 0), in layout order."""
    cuts, steps = layout.cuts, len(layout.cuts) - 1
    node = np.stack([np.zeros_like(bias), bias], axis=1)
    alpha, beta = node.copy(), np.zeros_like(node)
    for t in range(1, steps):
        a, b = cuts[t], cuts[t + 1]
        past = alpha[cuts[t - 1] : cuts[t - 1] + b - a]
        alpha[a:b] += np.logaddexp(past[:, :1] + trans[0], past[:, 1:] + trans[1])
    for t in range(steps - 2, -1, -1):
        a, b = cuts[t + 1], cuts[t + 2]
        ahead = beta[a:b] + node[a:b]
        beta[cuts[t] : cuts[t] + b - a] = np.logaddexp(ahead[:, :1] + trans[:, 0], ahead[:, 1:] + trans[:, 1])
    first = slice(0, cuts[1] if steps else 0)
    total = alpha[first] + beta[first]
    return alpha, beta, np.logaddexp(total[:, 0], total[:, 1])


@dataclass
class Field:
    """Weights of a line's features in context for label 1 (good), and transition scores [label before, label]."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    trans: np.ndarray

    def marginals(self, context: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """P(good) of every line, given all lines of its text."""
        layout = Layout.of(bounds)
        bias = (((context - self.mean) / self.scale) @ self.weights)[layout.rows]
        alpha, beta, _ = forward_backward(bias, self.trans, layout)
        total = alpha + beta
        out = np.empty(len(bias))
        out[layout.rows] = 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -700, 700)))
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        """The mean of P(good) over a text's lines, weighted by their characters (an empty text's one line counts as it is)."""
        own, chars, bounds = measures(texts)
        good = self.marginals(in_context(own, bounds), bounds)
        weight = np.maximum(chars, 1).astype(float)
        owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
        return np.bincount(owner, weights=weight * good, minlength=len(texts)) / np.bincount(owner, weights=weight, minlength=len(texts))


def minimise(value: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int, memory: int = 10) -> np.ndarray:
    """Limited-memory quasi-Newton descent with halved steps."""
    f, g = value(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, kept = -g, []
        for s, y in reversed(past):
            a = s @ d / (s @ y)
            d = d - a * y
            kept.append(a)
        if past:
            s, y = past[-1]
            d = d * (s @ y / (y @ y))
        for (s, y), a in zip(past, reversed(kept), strict=True):
            d = d + s * (a - y @ d / (s @ y))
        slope, step = g @ d, 1.0 if past else 1 / max(1.0, float(np.abs(g).sum()))
        while True:
            new_f, new_g = value(x + step * d)
            if new_f <= f + 1e-4 * step * slope or step < 1e-10:
                break
            step /= 2
        s, y = step * d, new_g - g
        done = f - new_f < 1e-7 * max(1.0, abs(f))
        x, f, g = x + s, new_f, new_g
        if done:
            break
        if s @ y > 1e-12:
            past = [*past[-memory + 1 :], (s, y)]
    return x


def fit(own: np.ndarray, bounds: np.ndarray, labels: np.ndarray, steps: int = STEPS, penalty: float = PENALTY) -> Field:
    """The field of greatest penalised likelihood, each line labelled as its text. Each text counts as one, whatever its length,
    and both classes count alike."""
    context = in_context(own, bounds).astype(np.float64)
    mean, scale = context.mean(axis=0), context.std(axis=0)
    mean[0], scale[0] = 0, 1
    scale[scale < 1e-6] = 1
    layout = Layout.of(bounds)
    x = ((context - mean) / scale)[layout.rows]
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    label = labels[order].astype(np.int64)
    sizes = np.bincount(label, minlength=2)
    weight = (len(label) / (2 * np.maximum(sizes, 1)))[label] / lengths[order]
    place = np.repeat(np.arange(len(layout.cuts) - 1), np.diff(layout.cuts))
    text = np.arange(len(x)) - layout.cuts[place]
    y, w = label[text], weight[text]
    later = np.flatnonzero(place > 0)
    before = layout.cuts[place[later] - 1] + text[later]
    width = x.shape[1]

    def value(p: np.ndarray) -> tuple[float, np.ndarray]:
        trans = p[width:].reshape(2, 2)
        bias = x @ p[:width]
        alpha, beta, z = forward_backward(bias, trans, layout)
        good = 1 / (1 + np.exp(np.clip((alpha + beta)[:, 0] - (alpha + beta)[:, 1], -700, 700)))
        gold = np.bincount(text, weights=y * bias, minlength=len(label)) + (lengths[order] - 1) * trans[label, label]
        node = np.stack([np.zeros_like(bias), bias], axis=1)
        pair = np.exp(alpha[before][:, :, None] + trans + (node + beta)[later][:, None, :] - z[text[later]][:, None, None])
        seen = np.zeros((2, 2))
        np.add.at(seen, (label, label), weight * (lengths[order] - 1))
        gradient = np.concatenate([x.T @ (w * (good - y)), (np.einsum("n,nij->ij", w[later], pair) - seen).ravel()])
        return float(weight @ (z - gold)) + penalty / 2 * float(p @ p), gradient + penalty * p

    p = minimise(value, np.zeros(width + 4), steps)
    return Field(mean, scale, p[:width], p[width:].reshape(2, 2))


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; a null id counts as empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", train_docs: int = TRAIN_DOCS, train_lines: int = TRAIN_LINES) -> Field:
    """A field fitted on labelled documents outside the held-out fold: of each class the ``train_docs`` with the least hashed ids,
    whole, as long as all have at most ``train_lines`` lines together. An id labelled or given twice counts once; null
    ids and labels don't count. Without documents of both classes all lines score 0.5."""
    known = labels.select(labels[f"`{id_col}`"].alias("id"), labels[f"`{label_col}`"].cast("int").alias("label")).filter(F.col("id").isNotNull() & F.col("label").isin(0, 1) & (fold_of(F.col("id")) != 1))
    drawn = None
    for k in (0, 1):  # bounded by train_docs each
        part = known.filter(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(train_docs)
        drawn = part if drawn is None else drawn.union(part)
    drawn = materialise(drawn.groupBy("id").agg(F.min("label").alias("label")), "crf-sample")
    texts = docs.select(docs[f"`{id_col}`"].alias("id"), F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")).alias("text")).join(F.broadcast(drawn), "id")  # at most 2 * train_docs ids
    texts = texts.groupBy("id", "label").agg(F.min("text").alias("text"))

    @F.arrow_udf("struct<lines: int, own: binary>")
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            lines, blobs = [], []
            for part in portions(batch) if len(batch) else ():
                own, _, bounds = measures(part)
                lines += np.diff(bounds).tolist()
                blobs += [own[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.StructArray.from_arrays([pa.array(lines, pa.int32()), pa.array(blobs, pa.binary())], ["lines", "own"])

    sample = materialise(texts.select("id", "label", measured("text").alias("m")).select("id", "label", "m.*"), "crf-lines")
    sizes = sample.select(F.xxhash64("id").alias("h"), "lines").collect()  # at most 2 * train_docs rows
    total, most = 0, None
    for r in sorted(sizes, key=lambda r: r.h):
        total += r.lines
        if total > train_lines:
            break
        most = r.h
    rows = sample.filter(F.xxhash64("id") <= most).orderBy("id").collect() if most is not None else []  # bounded by train_lines
    width = len(MEASURES)
    classes = {r.label for r in rows}
    if len(classes) < 2:
        full = 4 * width - 1
        return Field(np.zeros(full), np.ones(full), np.zeros(full), np.zeros((2, 2)))
    own = np.frombuffer(b"".join(bytes(r.own) for r in rows), np.float32).reshape(-1, width)
    return fit(own, np.append(0, np.cumsum([r.lines for r in rows])), np.array([r.label for r in rows]))


def classify(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus held_out, score and predicted, replacing columns of those names; one map over whole texts.

    score is the mean of the lines' P(good) by forward-backward, weighted by their characters; lines without a word aren't lines. A null or empty text is one empty line. Repeated rows get equal scores; extra columns pass through; an empty table
    gives an empty table. A text is one chain: its lines are held in one task (some 800 bytes a line)."""
    bound_arrow_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(field)  # some hundred numbers

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [shared.value.scores(part) for part in portions(batch)] if len(batch) else []
            yield pa.array(np.concatenate([np.zeros(0), *parts]), pa.float64())

    new = ("held_out", "score", "predicted")
    rest = [docs[f"`{c}`"] for c in docs.columns if c not in new]
    out = docs.select(*rest, (fold_of(docs[f"`{id_col}`"]) == 1).alias("held_out"), score(docs[f"`{text_col}`"].cast("string")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
