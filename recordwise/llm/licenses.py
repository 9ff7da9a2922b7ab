"""Licence scans with a trained paragraph classifier, confirmed by comparison with templates.

Each line of a document is a paragraph; one of more than ``WINDOW`` words is read in overlapping
windows, so a notice is not diluted however long the line is. A paragraph's features are its 1- to
3-grams of words, hashed, of unit length. A multinomial logistic regression over the licence
families and a class "unknown" is trained on the driver from the fixed texts in
``license_texts`` (varied by rule: surrounding words, cuts, lower case) and on a bounded sample of the
corpus' own paragraphs as unknown (``unknown_rows`` distinct lines, the smallest hashes). Its probabilities are
calibrated by a temperature that is fitted on a third of the training rows kept back.

A window may name several families. Those whose best template shares enough of its word pairs with the
window, and the most likely one, are taken one after the other, the likeliest first; each takes the words
that its template explains out of the window before the next one is looked for. A family is a prediction
when it is the most likely class, with at least ``least`` probability, of the window or of its own words and
those around them without the words of the others; it is confirmed when its template shared enough of the word pairs that were left to it. A
paragraph has one row per predicted family.

Defined cases: a NULL or empty text has no paragraph; lines without words are skipped but counted;
rows that repeat an id are scanned each; texts are read whole; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordwise.llm.license_texts import NAMES, NOTICES, OTHERS, TEXTS
from recordwise.llm.spans import U64, WORD, Prefix, buffer_of, mixed, runs, slices

DIMS_LOG2 = 16
WINDOW, OVERLAP = 60, 30
UNKNOWN_ROWS = 2_000
LEAST = 0.6
SHARED = 0.6
GAP = 3  # words between two pairs of one occurrence of a template
BEFORE, AFTER = 8, 12  # words around a notice, as in training
FAMILIES = ["unknown", *NAMES]


def units_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Windows of words: (row, paragraph, first word, last word + 1, word starts, word ends)."""
    starts, ends = runs(WORD[data], offsets)
    row = np.searchsorted(offsets, starts, "right") - 1
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    paragraph = lines[starts] - lines[offsets[row]]
    new = np.ones(len(starts), bool)
    new[1:] = (row[1:] != row[:-1]) | (paragraph[1:] != paragraph[:-1])
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(starts)))
    windows = np.maximum(1, -(-(sizes - OVERLAP) // (WINDOW - OVERLAP)))
    number = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    first = np.repeat(heads, windows) + number * (WINDOW - OVERLAP)
    last = np.minimum(first + WINDOW, np.repeat(heads + sizes, windows))
    return row[first], paragraph[first], first, last, starts, ends


def gram_columns(words: np.ndarray) -> list[np.ndarray]:
    """Hashed columns of the 1-, 2- and 3-grams that begin at each word."""
    columns, gram = [], words
    for n in (1, 2, 3):
        if n > 1:
            gram = mixed(gram[: len(words) - n + 1]) + words[n - 1 :]
        columns.append((mixed(gram + U64(n)) >> U64(64 - DIMS_LOG2)).astype(np.int64))
    return columns


def logits(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> tuple[tuple, np.ndarray]:
    """Units and their class scores: sums over the grams that the model knows, scaled to unit length."""
    units = units_of(data, offsets)
    _, _, first, last, starts, ends = units
    known = np.abs(weights[:-1]).sum(1) > 0
    total = np.tile(weights[-1], (len(first), 1))
    if not len(first):
        return units, total
    scale = 1.0 / np.sqrt(np.maximum(1, sum(np.maximum(0, last - first - n + 1) for n in (1, 2, 3))))
    words = Prefix(data).ranges(starts, ends)
    for n, columns in enumerate(gram_columns(words), 1):
        useful = np.flatnonzero(known[columns])  # most words of a corpus are in no licence
        low, high = np.searchsorted(useful, first), np.searchsorted(useful, np.maximum(first, last - n + 1))
        hits = high - low
        some = np.flatnonzero(hits)
        if len(some):
            at = np.repeat(low[some] - (np.cumsum(hits[some]) - hits[some]), hits[some]) + np.arange(hits[some].sum())
            sums = np.add.reduceat(weights[columns[useful[at]]], np.cumsum(hits[some]) - hits[some])
            total[some] += sums * scale[some, None]
    return units, total


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def training_texts(paragraphs: list[str]) -> tuple[list[str], np.ndarray]:
    """Texts and classes by rule; the corpus' paragraphs serve as unknown and as surroundings."""
    texts, classes = [], []
    around = [p.split() for p in paragraphs if 3 <= len(p.split())] or [["of"]]
    turn = 0

    def add(text: str, family: str) -> None:
        nonlocal turn
        before, after = around[turn % len(around)], around[(turn * 7 + 3) % len(around)]
        for variant in (text, text.lower(), " ".join([*before[-(turn % 9) :], text, *after[: turn % 13]])):
            texts.append(variant)
            classes.append(FAMILIES.index(family))
        turn += 1

    for family, names in NAMES.items():
        for name in names:
            for notice in NOTICES:
                add(notice.format(name), family)
        for whole in TEXTS[family]:
            words = whole.split()
            for size in (12, 20, 40, len(words)):
                for at in range(0, max(1, len(words) - size + 1), 6):
                    if at == 0 or size >= 20:
                        add(" ".join(words[at : at + size]), family)
    for _ in range(6):
        for other in OTHERS:
            add(other, "unknown")
    texts += paragraphs
    classes += [0] * len(paragraphs)
    return texts, np.array(classes)


def sparse_rows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of the features of whole texts of at most one window."""
    column = pa.array([" ".join(re.findall(r"\S+", t)[:WINDOW]).lower() for t in texts], pa.string())
    data, offsets = buffer_of(column)
    row, _, first, last, starts, ends = units_of(data, offsets)
    words = Prefix(data).ranges(starts, ends)
    rows, columns = [], []
    for n, at in enumerate(gram_columns(words), 1):
        count = np.maximum(0, last - first - n + 1)
        rows.append(np.repeat(row, count))
        columns.append(at[np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())])
    rows, columns = np.concatenate(rows), np.concatenate(columns)
    length = np.sqrt(np.maximum(1, np.bincount(rows, minlength=len(texts))))
    return rows, columns, 1.0 / length[rows]


def fit(texts: list[str], classes: np.ndarray, steps: int = 60) -> np.ndarray:
    """Weights (the bias last) by adaptive gradient descent, divided by the fitted temperature."""
    rows, columns, values = sparse_rows(texts)
    used, local = np.unique(columns, return_inverse=True)
    n, k, m = len(texts), len(FAMILIES), len(used)
    back = np.arange(n) % 3 == 2  # kept back for calibration
    target = np.eye(k)[classes]
    share = 1.0 / np.maximum(1, np.bincount(classes, minlength=k))[classes] * ~back
    order = np.argsort(local, kind="stable")
    heads = np.searchsorted(local[order], np.arange(m))
    by_row = np.argsort(rows, kind="stable")
    row_heads = np.searchsorted(rows[by_row], np.arange(n))
    w, bias = np.zeros((m, k)), np.zeros(k)
    squares, bias_squares = np.full((m, k), 1e-8), np.full(k, 1e-8)

    def scores() -> np.ndarray:
        summed = np.add.reduceat(w[local[by_row]] * values[by_row, None], row_heads)
        summed[np.bincount(rows, minlength=n) == 0] = 0
        return summed + bias

    for _ in range(steps):
        error = (softmax(scores()) - target) * share[:, None]
        gradient = np.add.reduceat(error[rows[order]] * values[order, None], heads) + 1e-5 * w
        squares += gradient**2
        w -= 0.5 * gradient / np.sqrt(squares)
        bias_squares += error.sum(0) ** 2
        bias -= 0.1 * error.sum(0) / np.sqrt(bias_squares)
    z = scores()[back]
    best = min((-np.mean(np.log(softmax(z / t)[np.arange(len(z)), classes[back]] + 1e-12)), t) for t in (0.25, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0))
    weights = np.zeros(((1 << DIMS_LOG2) + 1, k))
    weights[used], weights[-1] = w, bias
    return weights / best[1]


def background(documents: DataFrame, unknown_rows: int = UNKNOWN_ROWS, shortest: int = 20, longest: int = 2000) -> list[str]:
    """At most ``unknown_rows`` distinct lines of ``shortest`` to ``longest`` characters that name no licence, those of the smallest hashes.

    These bounds concern what the class "unknown" is fitted on, not what is searched.

    Hashes are made distinct first, which combines equal lines before they shuffle and moves no texts; then only the
    lines up to the last wanted hash are read.
    """
    lines = documents.select(F.explode(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n")).alias("line"))
    plain = lines.where(f"length(line) between {shortest} and {longest} and not lower(line) rlike 'licen|copyright|creative commons|cc by'")
    hashed = plain.select(F.xxhash64("line").alias("h"), "line")
    last = hashed.select("h").distinct().orderBy("h").limit(unknown_rows).agg(F.max("h")).first()[0]
    if last is None:
        return []
    sample = hashed.where(F.col("h") <= last).distinct().orderBy("h", "line").limit(unknown_rows)
    return [r["line"] for r in sample.collect()]


def train(documents: DataFrame, unknown_rows: int = UNKNOWN_ROWS) -> np.ndarray:
    """The model; from the corpus it takes the lines of ``background``."""
    return fit(*training_texts(background(documents, unknown_rows)))


def split_words(text: str) -> list[str]:
    return re.findall(r"\w+", text.lower())


def word_pairs(words: list[str | None]) -> set[tuple[str, str]]:
    """Pairs of neighbours; None stands where words were taken out."""
    return {p for p in zip(words, words[1:]) if None not in p}


def templates() -> dict[str, list[list[str]]]:
    """Words of each family's names and texts."""
    return {f: [split_words(t) for t in [*NAMES[f], *TEXTS[f]]] for f in NAMES}


def similarity(pairs: set[tuple[str, str]], total: int, known: list[set[tuple[str, str]]]) -> float:
    """Share of the best template's word pairs that are in ``pairs``, or of the window's ``total`` that a long template has."""
    return max(len(pairs & t) / min(len(t), max(total, 6)) for t in known) if pairs else 0.0


def occurrence(words: list[str | None], known: list[dict[tuple[str, str], list[int]]]) -> tuple[int, int]:
    """The run of words (first, last + 1) that follows one of the templates in order for the most pairs; (0, 0) without any."""
    best, place = 0, (0, 0)
    for template in known:
        begin = after = size = 0
        last = -1
        for k, pair in enumerate(zip(words, words[1:])):
            at = template.get(pair)
            if not at:
                continue
            later = next((a for a in at if a > last), None)
            if not size or later is None or k - after >= GAP:
                begin, size, later = k, 0, at[0]
            last, size, after = later, size + 1, k + 1
            if size > best:
                best, place = size, (begin, k + 2)
    return place


class Templates:
    """The templates in the forms that their comparisons need."""

    def __init__(self):
        words = templates()
        self.pairs = {f: [word_pairs(t) for t in ts] for f, ts in words.items()}
        self.places = {f: [self.indexed(t) for t in ts] for f, ts in words.items()}
        every = [p for f in NAMES for p in self.pairs[f]]
        plain = [p for p in sorted(set().union(*every)) if all(re.fullmatch("[a-z0-9]+", w) for w in p)]  # "_" parts words of bytes
        self.sizes = np.array([len(p) for p in every])
        self.skipped = self.sizes - np.array([len(p.intersection(plain)) for p in every])
        data, offsets = buffer_of(pa.array([w for p in plain for w in p], pa.string()))
        words_of = Prefix(data).ranges(offsets[:-1], offsets[1:])
        hashes = mixed(words_of[::2]) + words_of[1::2]
        order = np.argsort(hashes)
        self.hashes, self.member = hashes[order], np.array([[p in t for t in every] for p in plain], np.int16)[order]

    @staticmethod
    def indexed(words: list[str]) -> dict[tuple[str, str], list[int]]:
        places: dict[tuple[str, str], list[int]] = {}
        for k, pair in enumerate(zip(words, words[1:])):
            places.setdefault(pair, []).append(k)
        return places

    def likely(self, data: np.ndarray, first: np.ndarray, last: np.ndarray, starts: np.ndarray, ends: np.ndarray, shared: float) -> np.ndarray:
        """Marks the windows that may share enough of a template (a superset: repeated pairs count again)."""
        marked = np.zeros(len(first), bool)
        if len(starts) < 2:
            return marked
        words = Prefix(data).ranges(starts, ends)
        pairs = mixed(words[:-1]) + words[1:]
        at = np.minimum(np.searchsorted(self.hashes, pairs), len(self.hashes) - 1)
        useful = np.flatnonzero(self.hashes[at] == pairs)
        low, high = np.searchsorted(useful, first), np.searchsorted(useful, np.maximum(first, last - 1))
        hits = high - low
        some = np.flatnonzero(hits)
        for k in range(0, len(some), 1 << 14):
            part = some[k : k + (1 << 14)]
            heads = np.cumsum(hits[part]) - hits[part]
            place = np.repeat(low[part] - heads, hits[part]) + np.arange(hits[part].sum())
            counts = np.add.reduceat(self.member[at[useful[place]]], heads)
            fewest = shared * np.minimum(self.sizes, np.maximum(last[part] - first[part] - 1, 6)[:, None]) - self.skipped
            marked[part] = (counts >= fewest - 1e-9).any(1)
        return marked


def chances_of(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Class probabilities of texts of about one window; a text without words is unknown."""
    result = np.tile(np.eye(len(FAMILIES))[0], (len(texts), 1))
    data, offsets = buffer_of(pa.array(texts, pa.string()))
    if len(data):
        (row, *_), score = logits(data, offsets, weights)
        chances = softmax(score)
        for k in np.argsort(-chances[:, 0], kind="stable").tolist():  # the window that is least unknown comes last
            result[row[k]] = chances[k]
    return result


class Window:
    """One window's words, and the families that were found in it with the words they explain."""

    def __init__(self, words: list[str], chance: np.ndarray):
        self.words, self.chance, self.left = words, chance, list(words)
        self.total = len(word_pairs(words))
        self.found: dict[int, tuple[float, set[int]]] = {}

    def take(self, chance: np.ndarray, known: Templates, least: float, shared: float) -> bool:
        """Find the next family in what is left, given its class probabilities; False if there is none."""
        pairs = word_pairs(self.left)
        alike = {k: similarity(pairs, self.total, known.pairs[f]) for k, f in enumerate(FAMILIES) if k}
        wanted = [k for k, value in alike.items() if value >= shared]
        order = sorted(wanted, key=lambda k: (-chance[k], -alike[k], k))
        best = int(np.argmax(chance))
        if best and chance[best] >= least:
            order.insert(0, best)
        for k in order:
            begin, end = occurrence(self.left, known.places[FAMILIES[k]])
            value, places = self.found.get(k, (0.0, set()))
            self.found[k] = (max(value, alike[k]), places | {p for p in range(begin, end) if self.left[p] is not None})
            if begin < end:
                self.left[begin:end] = [None] * (end - begin)
                return True
        return False

    def alone(self, family: int) -> str:
        """The family's words and those around them, without the words that other families explain."""
        others = set().union(*(places for k, (_, places) in self.found.items() if k != family))
        near = {k for p in self.found[family][1] for k in range(p - BEFORE, p + AFTER + 1)}
        return " ".join(w for k, w in enumerate(self.words) if k in near and k not in others)


def families_of(windows: list[Window], known: Templates, weights: np.ndarray, least: float, shared: float) -> list[tuple[int, str, float, float]]:
    """(window, family, probability, similarity) of every predicted family, all windows scored together."""
    active, chances = windows, [w.chance for w in windows]
    while active:
        active = [w for w, chance in zip(active, chances) if w.take(chance, known, least, shared)]
        chances = chances_of([" ".join(x for x in w.left if x) for w in active], weights)
    tested = [(k, f, windows[k].chance) for k, w in enumerate(windows) for f in w.found]
    alone = chances_of([windows[k].alone(f) for k, f, _ in tested], weights)
    best: dict[tuple[int, int], float] = {}
    for k, f, chance in tested + [(k, f, chance) for (k, f, _), chance in zip(tested, alone)]:
        if int(np.argmax(chance)) == f and chance[f] >= least:
            best[k, f] = max(best.get((k, f), 0.0), float(chance[f]))
    return [(k, FAMILIES[f], chance, windows[k].found[f][0]) for (k, f), chance in best.items()]


def scan(documents: DataFrame, weights: np.ndarray, least: float = LEAST, shared: float = SHARED) -> DataFrame:
    """``doc_id, paragraph, family, probability, similarity, confirmed``: every predicted family of each paragraph, from its best window."""
    model = documents.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates()
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                data, offsets = buffer_of(part.column("text"))
                (row, paragraph, first, last, starts, ends), score = logits(data, offsets, model.value)
                hits = np.zeros(0, np.int64)
                if len(first):
                    hits = np.flatnonzero((score[:, 1:].max(1) > score[:, 0]) | known.likely(data, first, last, starts, ends, shared))
                raw, found = data.tobytes(), {}
                for at in range(0, len(hits), 4096):
                    some = hits[at : at + 4096]
                    windows = [
                        Window(split_words(raw[starts[first[k]] : ends[last[k] - 1]].decode("utf-8", "replace")), chance)
                        for k, chance in zip(some.tolist(), softmax(score[some]))
                    ]
                    for k, family, chance, alike in families_of(windows, known, model.value, least, shared):
                        place = (int(row[some[k]]), int(paragraph[some[k]]), family)
                        found[place] = max(found.get(place, (False, 0.0, 0.0)), (alike >= shared, chance, alike))
                ids = part.column("doc_id").to_pylist()
                rows = [(ids[r], p, family, chance, alike, confirmed) for (r, p, family), (confirmed, chance, alike) in sorted(found.items())]
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.bool_())
                names = ["doc_id", "paragraph", "family", "probability", "similarity", "confirmed"]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    text = F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return narrow.mapInArrow(run, "doc_id long, paragraph long, family string, probability double, similarity double, confirmed boolean")


def find_licenses(documents: DataFrame, unknown_rows: int = UNKNOWN_ROWS) -> DataFrame:
    """Train on the corpus' own background, then scan all documents."""
    return scan(documents, train(documents, unknown_rows))
