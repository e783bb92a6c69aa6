"""License scans: winnowed template fingerprints, then banded alignment.

Texts and templates are sequences of words (runs of letters and digits,
ASCII letters lower-cased).  Hashes of ``GRAM`` neighbouring words are
winnowed: of every ``WINDOW`` consecutive ones the smallest stays, so a run
of GRAM + WINDOW - 1 equal words always shares a fingerprint.  The
templates' fingerprints form an inverted index (its size follows the list of
templates); a document's fingerprints found in it pick candidates (template,
region of the text).  Each region is aligned with its template by a local
alignment banded around the diagonals of its hits, which reports the share
of the template's words that match (coverage) and the span in the text.
A template is named only where its identifying phrases (version, Lesser,
Affero, NC, SA, ND, "any later version") stand unbroken in the span.  Of
overlapping reports the one with most matched words, then the highest
coverage, stays.

The templates (``license_templates``) are whole texts of licences, and their
standard notices in all versions.

Defined cases: null and empty texts, and texts without a template, give no
rows; null doc_ids and repeated rows are scanned one by one; several
occurrences in one text give a row each; an empty table or no templates give
no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rewardseg.llm.common import byte_sizes, kept, slices, table
from rewardseg.llm.license_templates import TEMPLATES

GRAM, WINDOW = 3, 2
MIN_COVERAGE = 0.75
MATCH, MISMATCH, GAP = 2, -1, -1
LONG = 64     # words from which a template keeps only grams that it has once, and is aligned a row at a time
BEHIND = 8    # words after a span that can hold a phrase against it
SLICE_BYTES = 6_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def words_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of every word of a byte array."""
    inside = _WORD[raw]
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    ends = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
    if not len(starts):
        return np.empty(0, np.uint64), starts, ends
    place = np.arange(len(raw), dtype=np.uint64)
    place[starts[0]:] -= np.repeat(starts, np.diff(starts, append=len(raw))).astype(np.uint64)
    value = (_LOWER[raw].astype(np.uint64) + np.uint64(1)) * (_MIX * (place * np.uint64(2) + np.uint64(1)))
    value ^= value >> np.uint64(29)
    return np.add.reduceat(np.where(inside, value, np.uint64(0)), starts) * _MIX, starts, ends


def grams_of(words: np.ndarray) -> np.ndarray:
    n = max(0, len(words) - GRAM + 1)
    gram = np.zeros(n, np.uint64)
    for i in range(GRAM):
        gram = gram * np.uint64(1_000_003) + words[i:i + n]
    gram = gram * _MIX
    return gram ^ (gram >> np.uint64(31))


def winnow(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, fingerprint): the grams that are smallest in a window,
    within each text (``text`` numbers the words' texts)."""
    n = len(words) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    gram = grams_of(words)
    whole = text[:n] == text[GRAM - 1:]
    big = np.uint64(0xFFFFFFFFFFFFFFFF)
    gram = np.where(whole, gram, big)
    kept = np.zeros(n, bool)
    # windows reach over both ends of a text, so its first and last gram stay
    edge = np.full(WINDOW - 1, big)
    padded = np.concatenate([edge, gram, edge])
    windows = np.stack([padded[i:len(padded) - WINDOW + 1 + i] for i in range(WINDOW)])
    chosen = np.arange(windows.shape[1]) + np.argmin(windows, 0) - (WINDOW - 1)
    kept[chosen[(chosen >= 0) & (chosen < n)]] = True
    kept &= whole
    at = np.flatnonzero(kept)
    return at, gram[at]


def _run(phrase: str) -> bytes:
    return words_of(np.frombuffer(phrase.encode(), np.uint8))[0].tobytes()


def _stands(phrase: bytes, words: np.ndarray) -> bool:
    """Whether a run of words stands unbroken among the words."""
    raw, at = words.tobytes(), -1
    while (at := raw.find(phrase, at + 1)) >= 0:
        if at % 8 == 0:
            return True
    return False


class Index:
    """Inverted index of the templates' grams.  A template keeps all its
    grams, a long one those that it has once; the texts are winnowed."""

    def __init__(self, templates):
        self.names = [template[0] for template in templates]
        self.words = [words_of(np.frombuffer(template[1].encode(), np.uint8))[0] for template in templates]
        phrases = [template[2] if len(template) > 2 else () for template in templates]
        self.needed = [[_run(p) for p in own if not p.startswith("!")] for own in phrases]
        self.barred = [[_run(p[1:]) for p in own if p.startswith("!")] for own in phrases]
        grams, of, at = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i, words in enumerate(self.words):
            gram = grams_of(words)
            _, where, times = np.unique(gram, return_index=True, return_counts=True)
            place = np.sort(where[times == 1]) if len(words) > LONG else np.arange(len(gram))
            grams.append(gram[place])
            of.append(np.full(len(place), i))
            at.append(place)
        grams, of, at = np.concatenate(grams), np.concatenate(of), np.concatenate(at)
        order = np.lexsort((at, of, grams))
        self.grams, self.of, self.at = grams[order], of[order], at[order]

    def may_match(self, i: int, window: np.ndarray) -> bool:
        """Whether the template's phrases and enough of its words are there."""
        words = self.words[i]
        if len(window) < MIN_COVERAGE * len(words):
            return False
        if not all(_stands(phrase, window) for phrase in self.needed[i]):
            return False
        if len(words) <= LONG:
            return True
        (own, n), (there, m) = (np.unique(w, return_counts=True) for w in (words, window))
        both = np.intersect1d(own, there, assume_unique=True, return_indices=True)
        return np.minimum(n[both[1]], m[both[2]]).sum() >= MIN_COVERAGE * len(words)

    def named(self, i: int, window: np.ndarray, a: int, b: int) -> bool:
        """Whether the span a..b of the window has the template's name."""
        return (all(_stands(phrase, window[a:b]) for phrase in self.needed[i])
                and not any(_stands(phrase, window[a:b + BEHIND]) for phrase in self.barred[i]))

    def hits(self, at: np.ndarray, gram: np.ndarray):
        """(word position in the text, template, word position in it)."""
        low, high = (np.searchsorted(self.grams, gram, side) for side in ("left", "right"))
        n = high - low
        entry = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(at, n), self.of[entry], self.at[entry]


def align(template: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """Local alignment over the diagonals low..high (text - template
    position): (matched words, first and last + 1 word of the text).  A cell
    holds (score, matched words, first word) of the best alignment that ends
    there."""
    best = (0, 0, 0, 0)
    above: dict[int, tuple[int, int, int]] = {}
    for i, word in enumerate(template.tolist()):
        row: dict[int, tuple[int, int, int]] = {}
        for j in range(max(0, i + low), min(len(text), i + high + 1)):
            equal = int(text[j]) == word
            score, matched, first = above.get(j - 1, (0, 0, j))
            cell = (score + MATCH, matched + 1, first) if equal else (score + MISMATCH, matched, first)
            for beside in (above.get(j), row.get(j - 1)):
                if beside and (beside[0] + GAP, beside[1]) > cell[:2]:
                    cell = (beside[0] + GAP, beside[1], beside[2])
            if cell[:2] > (0, 0):
                row[j] = cell
                if equal and cell[:2] > best[:2]:
                    best = (*cell, j + 1)
        above = row
    return best[1], best[2], best[3]


_SCORE, _WORDS = 40, 20   # bits of a packed cell below the score, and below the matched words


def align_rows(template: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """``align`` with a row of the band at a time: a cell is one number
    (score, matched words, first word)."""
    one, none = np.int64(1) << _SCORE, np.int64(-1) << 62
    width = high - low + 1
    across = np.arange(width) * -GAP * one
    above = np.full(width, none)
    best, end = np.int64(0), 0
    for i, word in enumerate(template):
        place = np.arange(i + low, i + high + 1)
        inside = (place >= 0) & (place < len(text))
        if not inside.any():
            above = np.full(width, none)
            continue
        equal = inside & (text[np.clip(place, 0, len(text) - 1)] == word)
        cell = np.where(above > none, above, place) + np.where(equal, MATCH * one + (1 << _WORDS), MISMATCH * one)
        cell[:-1] = np.maximum(cell[:-1], np.where(above[1:] > none, above[1:] + GAP * one, none))
        cell = np.where(inside, cell, none // 2)
        cell = np.maximum.accumulate(cell + across) - across
        cell = np.where(inside & (cell >= 1 << _WORDS), cell, none)
        hit = np.where(equal, cell, none)
        at = int(np.argmax(hit))
        if hit[at] > none and hit[at] >> _WORDS > best >> _WORDS:
            best, end = hit[at], int(place[at]) + 1
        above = cell
    mask = (1 << _WORDS) - 1
    return int(best >> _WORDS) & mask, int(best) & mask, end


def scan_texts(texts: list[bytes], index: Index):
    """(text number, template, matched, coverage, start byte, end byte)."""
    joined = np.frombuffer(b"\0".join(texts), np.uint8)
    words, starts, ends = words_of(joined)
    if not len(words) or not len(index.grams):
        return []
    bounds = np.cumsum([len(t) + 1 for t in texts])
    text = np.searchsorted(bounds, starts, "right")
    at, of, there = index.hits(*winnow(words, text))
    found = []
    order = np.lexsort((at, of, text[at]))
    at, of, there = at[order], of[order], there[order]
    lo, last_end = 0, {}
    while lo < len(at):
        i, t = int(of[lo]), int(text[at[lo]])
        size = len(index.words[i])
        band = max(2, size // 8)
        hi = lo + 1
        # hits of one template on nearby diagonals, close to one another, are one region
        while (hi < len(at) and of[hi] == i and text[at[hi]] == t
               and at[hi] - at[hi - 1] <= size and abs((at[hi] - there[hi]) - (at[lo] - there[lo])) <= band):
            hi += 1
        diagonals = at[lo:hi] - there[lo:hi]
        first = max(int(diagonals.min()) - band, int(np.searchsorted(text, t, "left")))
        last = min(int(diagonals.max()) + size + band, int(np.searchsorted(text, t, "right")))
        window = words[first:last]
        seen = size > LONG and at[hi - 1] < last_end.get((t, i), 0)
        if not seen and index.may_match(i, window):
            method = align_rows if size > LONG else align
            matched, a, b = method(index.words[i], window, int(diagonals.min()) - band - first, int(diagonals.max()) + band - first)
            behind = words[first:min(last + BEHIND, int(np.searchsorted(text, t, "right")))]
            if matched >= MIN_COVERAGE * size and index.named(i, behind, a, b):
                base = int(bounds[t]) - len(texts[t]) - 1
                found.append((t, i, matched, matched / size, int(starts[first + a]) - base, int(ends[first + b - 1]) - base))
                last_end[t, i] = first + b
        lo = hi
    # of overlapping reports in a text the best stays; what is kept lies apart, so only neighbours can overlap
    best, spans = [], defaultdict(list)
    for report in sorted(found, key=lambda r: (r[0], -r[2], -r[3], r[4], r[1])):
        own, span = spans[report[0]], (report[4], report[5])
        at = bisect_left(own, span)
        if (at == 0 or own[at - 1][1] <= span[0]) and (at == len(own) or span[1] <= own[at][0]):
            own.insert(at, span)
            best.append(report)
    return best


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """doc_id, license, matched_words, coverage, start, end (code points of
    the text) and the matched text, one row per occurrence."""
    def run(batches):
        index = kept(("licenses", tuple(templates)), lambda: Index(templates))
        for batch in batches:
            ids, column = batch.column(0).to_pylist(), batch.column(1)
            for lo, hi in slices(byte_sizes(column), SLICE_BYTES):
                texts = [(t or "").encode() for t in column.slice(lo, hi - lo).to_pylist()]
                rows = []
                for t, i, matched, coverage, start, end in scan_texts(texts, index):
                    begin = len(texts[t][:start].decode())
                    span = texts[t][start:end].decode()
                    rows.append((ids[lo + t], index.names[i], matched, coverage, begin, begin + len(span), span))
                columns = list(zip(*rows)) if rows else [[]] * 7
                kinds = (pa.int64(), pa.string(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 ["doc_id", "license", "matched_words", "coverage", "start", "end", "span"])
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, license string, matched_words int, coverage double, start long, `end` long, span string"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
