"""Token ids of whole Arrow columns with the ``tokenizers`` library.

A byte-level BPE never merges across the start of `` word``: a space that
follows anything and precedes a non-space always opens a new pre-token.
So a text is cut there, each distinct piece of a batch is encoded once by
the library (and remembered in a bounded memo), and the ids are laid out by
array gathers.  Texts where a space stands before white space or at the
end are encoded whole, and so are all texts if the vocabulary file is not
of such a tokenizer.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, models, pre_tokenizers

from rewardseg.llm.common import kept

# A space before any white space or at the end: such texts are not cut.
_UNCUT = r" [\s\x0b\x1c-\x1f\x{85}\p{Z}]| \z"
MEMO_WORDS = 800_000
SLICE_BYTES = 12_000_000
LEARN_WORDS = 200
SPACE = "\u0120"         # how byte-level vocabularies write a space


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


# the characters that stand for the bytes 128 to 255 in byte-level vocabularies: printable Latin-1
# stands for itself, the others are numbered from 256 on, after the 33 bytes below 128 that are not printable
_PRINTABLE = [*range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHAR = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + 34 + i) for i, b in enumerate(
    [b for b in range(0x80, 0x100) if b not in set(_PRINTABLE)])}


def byte_letters(word: str) -> str:
    """How a byte-level vocabulary writes a word of letters."""
    return word.encode().decode("latin-1").translate(_BYTE_CHAR)


def cuts_at_spaces(tokenizer: Tokenizer) -> bool:
    """Whether the tokenizer is a byte-level BPE that opens a token at every
    space behind a character that is not white space."""
    before = tokenizer.pre_tokenizer
    return (isinstance(tokenizer.model, models.BPE) and tokenizer.normalizer is None and isinstance(before, pre_tokenizers.ByteLevel)
            and before.use_regex and not before.add_prefix_space and not any(
                t.normalized or t.lstrip or t.rstrip or " " in t.content for t in tokenizer.get_added_tokens_decoder().values()))


def byte_table(tokenizer: Tokenizer) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary."""
    code = {c: b for b, c in _BYTE_CHAR.items()} | {chr(b): b for b in range(0x21, 0x7F)} | {
        chr(256 + i): b for i, b in enumerate([*range(0x21), 0x7F])}
    vocab = tokenizer.get_vocab()
    out = [b""] * (max(vocab.values()) + 1)
    for entry, i in vocab.items():
        out[i] = bytes(code[c] for c in entry) if all(c in code for c in entry) else entry.encode()
    return out


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for ``count`` numbers, one run after another."""
    take = np.repeat((starts - np.cumsum(counts) + counts).astype(np.int32), counts)
    take += np.arange(len(take), dtype=np.int32)
    return take


class ColumnEncoder:
    """``encode(column)`` -> (ids of all texts end to end, ids per text)."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        self.tokenizer = Tokenizer.from_file(path)
        self.memo_words = memo_words
        self.by_word = cuts_at_spaces(self.tokenizer)
        vocab = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocab.values()) + 1, bool)
        self.opens[[i for token, i in vocab.items() if token.startswith(SPACE)]] = True
        single = {m: self.tokenizer.model.tokenize(m) for m in ".,!?;:"}
        self.marks = {m: t[0].id for m, t in single.items() if len(t) == 1}
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[bool, dict[str, int]] = {True: {}, False: {}}
        self.new: list[tuple[np.ndarray, np.ndarray]] = []
        self.pool = np.empty(0, np.uint32)
        self.starts = np.empty(0, np.int64)
        self.counts = np.empty(0, np.int64)
        self.hits = np.empty(0, np.int32)

    def _thin(self, room: int) -> None:
        """Make room: words that only one slice used go, or all of them."""
        kept = np.flatnonzero(self.hits > 1)
        if len(kept) + room > self.memo_words:
            return self._forget()
        place = np.full(len(self.hits), -1, np.int64)
        place[kept] = np.arange(len(kept))
        self.rows = {k: {w: int(place[r]) for w, r in known.items() if place[r] >= 0} for k, known in self.rows.items()}
        counts = self.counts[kept]
        self.pool = self.pool[_runs(self.starts[kept], counts)]
        self.starts, self.counts, self.hits = np.cumsum(counts) - counts, counts, np.ones(len(kept), np.int32)

    def vocab_size(self) -> int:
        return self.tokenizer.get_vocab_size()

    def _learn(self, words: list[str], spaced: bool) -> None:
        """Encode unseen words, each after a space or (``spaced`` false) at
        the start of a text.  A run of letters is one pre-token and goes to
        the library's BPE model as it is; letters with one punctuation mark
        behind are the ids of the letters and of the mark; other spaced
        words are encoded end to end, where only the first token of each
        begins with a space."""
        known = self.rows[spaced]
        letters, marked, other = [], [], []
        for w in words:
            if w.isalpha():
                letters.append(w)
            elif w[-1:] in self.marks and w[:-1].isalpha():
                marked.append(w)
            else:
                other.append(w)
        own = set(letters)
        letters += dict.fromkeys(w[:-1] for w in marked if w[:-1] not in known and w[:-1] not in own)
        if letters:
            bpe, lead = self.tokenizer.model.tokenize, SPACE if spaced else ""
            self._add(letters, spaced, [[t.id for t in bpe(lead + (w if w.isascii() else byte_letters(w)))] for w in letters])
        for i in range(0, len(other), LEARN_WORDS):
            part = other[i:i + LEARN_WORDS]
            if spaced and "" not in part:
                joined = self.tokenizer.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0]
                ids = np.array(joined.ids, np.uint32)
                begins = np.flatnonzero(self.opens[ids])
                if len(begins) == len(part):
                    self._place(part, spaced, ids, np.diff(begins, append=len(ids)))
                    continue
            lead = " " if spaced else ""
            self._add(part, spaced, [self.tokenizer.encode(lead + w, add_special_tokens=False).ids for w in part])
        self._settle()
        if marked:
            stems = np.fromiter((known[w[:-1]] for w in marked), np.int64, len(marked))
            counts = self.counts[stems] + 1
            ends = np.cumsum(counts)
            ids = np.empty(int(ends[-1]), np.uint32)
            is_mark = np.zeros(len(ids), bool)
            is_mark[ends - 1] = True
            ids[is_mark] = [self.marks[w[-1]] for w in marked]
            ids[~is_mark] = self.pool[_runs(self.starts[stems], counts - 1)]
            self._place(marked, spaced, ids, counts)
            self._settle()

    def _settle(self) -> None:
        """Append what was encoded to the arrays."""
        if self.new:
            ids, counts = (np.concatenate(x) for x in zip(*self.new))
            self.new = []
            self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(counts) - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.pool = np.concatenate([self.pool, ids])
            self.hits = np.concatenate([self.hits, np.zeros(len(counts), np.int32)])

    def _add(self, words: list[str], spaced: bool, each: list[list[int]]) -> None:
        self._place(words, spaced, np.fromiter(itertools.chain.from_iterable(each), np.uint32),
                    np.fromiter(map(len, each), np.int64, len(each)))

    def _place(self, words: list[str], spaced: bool, ids: np.ndarray, counts: np.ndarray) -> None:
        base = len(self.rows[True]) + len(self.rows[False])
        self.rows[spaced].update(zip(words, range(base, base + len(words))))
        self.new.append((ids, counts))

    def _rows_of(self, words: list[str], spaced: bool) -> np.ndarray:
        known = self.rows[spaced]
        missing = list(dict.fromkeys(w for w in words if w not in known))
        if missing:
            self._learn(missing, spaced)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        texts = pc.fill_null(column.cast(pa.large_string()), "")
        if not self.by_word:
            each = [e.ids for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.fromiter(itertools.chain.from_iterable(each), np.uint32), np.fromiter(map(len, each), np.int64, len(each))
        whole = pc.match_substring_regex(texts, _UNCUT).to_numpy(zero_copy_only=False)
        cut = pc.if_else(pa.array(whole), pa.scalar("", pa.large_string()), texts)
        pieces = pc.split_pattern(cut, " ")
        offsets = pieces.offsets.to_numpy()
        coded = pieces.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        if len(self.starts) + len(words) > self.memo_words:
            self._thin(len(words))
        opening = offsets[:-1] - offsets[0]
        firsts = [words[c] for c in codes[opening]]
        distinct = self._rows_of(words, True)
        rows = distinct[codes]
        rows[opening] = self._rows_of(firsts, False)
        self.hits[distinct] += 1
        counts = self.counts[rows]
        ids = self.pool[_runs(self.starts[rows], counts)]
        per_text = np.add.reduceat(counts, opening) if len(opening) else np.empty(0, np.int64)
        if not whole.any():
            return ids, per_text
        parts = np.split(ids, np.cumsum(per_text)[:-1])
        for i in np.flatnonzero(whole):
            parts[i] = np.array(self.tokenizer.encode(texts[int(i)].as_py(), add_special_tokens=False).ids, np.uint32)
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


def encoder(path: str, memo_words: int = MEMO_WORDS) -> ColumnEncoder:
    """The worker process's encoder for a vocabulary file (kept between tasks)."""
    return kept(("encoder", path, memo_words), lambda: ColumnEncoder(path, memo_words))


def with_end(ids: np.ndarray, per_text: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to every text's ids."""
    total = per_text + 1
    out = np.full(int(total.sum()), end_id, np.uint32)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(total) - 1] = False
    out[keep] = ids
    return out, total
